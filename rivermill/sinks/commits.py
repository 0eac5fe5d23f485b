"""One commit for all that a micro-batch writes, and readers that see nothing else.

A job that is given a commit table puts a row there once every sink of the micro-batch is
written: facts, dimensions, unusable messages and ledger become visible together or not at
all. A batch that has its row is not sent again. Brokers cannot replace what was sent, so
messages carry the attempt they belong to; those of an attempt without a row do not count.

A commit table has one writer, which finishes its batches in their order.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rivermill.functions.keyed import every_salt
from rivermill.sources.stores import read_or_empty, write_batch

COMMIT = T.StructType(
    [
        T.StructField("producer", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
# Tasks for each input partition of `read_committed`.
DEALT = 8
HEADERS = "array<struct<key:string,value:binary>>"
# Message headers, and the types of their values.
STAMP = {"producer": "string", "attempt": "string", "batch_id": "bigint", "seq": "bigint"}


def new_attempt() -> str:
    return uuid.uuid4().hex


def commit(spark: SparkSession, path: str, producer: str, attempt: str, batch_id: int) -> None:
    """Make a batch visible. Call it when all its sinks are written."""
    row = spark.createDataFrame([(producer, attempt, batch_id)], COMMIT)
    write_batch(row.coalesce(1), path, batch_id)


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, COMMIT)


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    return not read_commits(spark, path).filter(F.col("batch_id") == batch_id).isEmpty()


def last_committed(spark: SparkSession, path: str) -> int:
    """The newest visible batch, or -1."""
    newest = read_commits(spark, path).agg(F.max("batch_id")).head()[0]
    return -1 if newest is None else newest


def visible(rows: DataFrame, commits: DataFrame) -> DataFrame:
    """Rows of a store, of committed batches only. A store is split by batch_id, so the folders
    of other batches are not read."""
    return rows.join(commits.select("batch_id"), "batch_id", "left_semi").select(*rows.columns)


def stamp(msgs: DataFrame, producer: str, attempt: str, batch_id: int) -> DataFrame:
    """Messages with headers that say which attempt at which batch sent them, and their place
    in it, which a task that runs again gives again."""
    values = {
        "producer": F.lit(producer),
        "attempt": F.lit(attempt),
        "batch_id": F.lit(str(batch_id)),
        "seq": F.monotonically_increasing_id().cast("string"),
    }
    headers = [F.struct(F.lit(name).alias("key"), v.cast("binary").alias("value")) for name, v in values.items()]
    return msgs.withColumn("headers", F.array(*headers))


def _header(name: str) -> Column:
    found = F.filter("headers", lambda h: h["key"] == name)
    return F.try_element_at(found, F.lit(1))["value"].cast("string").try_cast(STAMP[name])


def read_committed(msgs: DataFrame, commits: DataFrame, salt: int = 8) -> DataFrame:
    """Messages of committed attempts, each once, with their stamp as columns.

    A batch's messages are one key of the join: they are spread over `salt` buckets of their
    place. What a task sent again has the same place and the same text, and counts once; two
    different messages are never taken for one. Messages without a stamp belong to no batch
    and are left out. For batches of messages; a commit may come later than its messages.
    """
    named = msgs.withColumns({name: _header(name) for name in STAMP}).drop("headers")
    named = named.withColumn("salt", F.pmod(F.xxhash64("seq"), F.lit(salt)).cast("int"))
    asked = every_salt(commits.select(*COMMIT.names).distinct(), salt)
    kept = named.join(asked, [*COMMIT.names, "salt"], "left_semi").drop("salt")
    # Dealt by place before any task remembers a message, to tasks that follow the input: what one
    # of them holds stays bounded, however large a split or few the session's partitions.
    tasks = max(int(msgs.sparkSession.conf.get("spark.sql.shuffle.partitions")), DEALT * msgs.rdd.getNumPartitions())
    kept = kept.repartition(tasks, "topic", *STAMP)
    return kept.dropDuplicates(["topic", *STAMP, *[c for c in ("key", "value") if c in msgs.columns]])
