"""One row per key, and salting of hot keys.

First and last row per key are plain min / max aggregates over a struct, not a
window: each map task sends at most one row per key, so a key that holds a third of
the table costs its reducer one row per map task.
"""

from pyspark.sql import Column, DataFrame, functions as F


def _one_per_key(df: DataFrame, pick, keys, order_by) -> DataFrame:
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    row = pick(F.struct(*order_by, *rest)).alias("row")
    return df.groupBy(*keys).agg(row).select(
        *[c if c in keys else F.col("row")[c].alias(c) for c in df.columns]
    )


def first_by_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Smallest row per key; the remaining columns break ties, so it is repeatable."""
    return _one_per_key(df, F.min, keys, order_by)


def last_by_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Largest row per key; the remaining columns break ties, so it is repeatable."""
    return _one_per_key(df, F.max, keys, order_by)


def salt_of(columns: list[str], n: int) -> Column:
    """Bucket 0..n-1 of a row, the same on every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def every_salt(df: DataFrame, n: int, name: str = "salt") -> DataFrame:
    """n copies of each row, one per bucket: the other side of a salted join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def at_hand(stored: DataFrame, keys: DataFrame) -> DataFrame:
    """Stored rows whose key is among `keys`, whose columns are the key's, all distinct.

    A micro-batch's kept keys have a known size, so the planner broadcasts them while
    they are few and then skips the partitions of the stored rows that hold none.
    """
    side = keys.select(*[F.col(c).alias(f"wanted_{c}") for c in keys.columns])
    on = [F.col(c) == F.col(f"wanted_{c}") for c in keys.columns]
    return stored.join(side, on, "left_semi")
