"""What a stream holds in its state, read from its checkpoint while it runs or after."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivermill.operators.orders import pending_details, pending_orders

# The sides of orders.order_wide_join: prefix of the columns there, and side of the state.
SIDES = {"info": ("i_", "right"), "detail": ("d_", "left")}


def join_state(spark: SparkSession, checkpoint: str, side: str, batch_id: int | None = None) -> DataFrame:
    """Headers (`info`) or lines (`detail`) that the order join holds after its last finished
    batch, or after `batch_id`. A header is held once for each salt and given once."""
    prefix, of_join = SIDES[side]
    reader = spark.read.format("statestore").option("joinSide", of_join)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    held = reader.load(checkpoint).select("value.*")
    if side == "info" and f"{prefix}salt" in held.columns:
        held = held.filter(F.col(f"{prefix}salt") == 0)
    return held.select(*[F.col(c).alias(c.removeprefix(prefix)) for c in held.columns if c != f"{prefix}salt"])


def held_pending(spark: SparkSession, checkpoint: str, side: str, batch_id: int | None = None) -> DataFrame:
    """Lines in the state whose header is not, or headers none of whose lines is."""
    headers, lines = (join_state(spark, checkpoint, s, batch_id) for s in ("info", "detail"))
    return pending_details(headers, lines) if side == "detail" else pending_orders(headers, lines)
