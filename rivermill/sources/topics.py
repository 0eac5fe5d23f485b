"""Message sources: topics, and directories of message files as their twins."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivermill import schemas as S


def kafka_options(
    topic: str, options: dict[str, str], starting_offsets: str | None = None
) -> dict[str, str]:
    """Options of a topic read: stored offsets if there are any, else the newest."""
    return {**options, "subscribe": topic, "startingOffsets": starting_offsets or "latest"}


def read_topic(
    spark: SparkSession,
    topic: str,
    options: dict[str, str],
    starting_offsets: str | None = None,
) -> DataFrame:
    """Streaming messages of a topic, with text key and value."""
    chosen = kafka_options(topic, options, starting_offsets)
    msgs = spark.readStream.format("kafka").options(**chosen).load()
    return msgs.select(
        *[F.col(f.name).cast(f.dataType) for f in S.MESSAGE]
    )


def stamped_options(topic: str, options: dict[str, str]) -> dict[str, str]:
    """Options of a read of all messages so far, with the headers that say who sent them."""
    return {**options, "subscribe": topic, "startingOffsets": "earliest", "includeHeaders": "true"}


def read_stamped_topic(spark: SparkSession, topic: str, options: dict[str, str]) -> DataFrame:
    """All messages of a topic with their headers, for `sinks.commits.read_committed`."""
    msgs = spark.read.format("kafka").options(**stamped_options(topic, options)).load()
    return msgs.select(*[F.col(f.name).cast(f.dataType) for f in S.MESSAGE], "headers")


def read_topic_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Streaming messages out of a directory of parquet message files, oldest first."""
    reader = spark.readStream.schema(S.MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


# Fixed values of the topic source: the newest and the oldest offset of a partition.
NEWEST, OLDEST = -1, -2


def starting_offsets(
    ledger: DataFrame,
    topic: str,
    group: str,
    partitions: list[int] | None = None,
    unknown: int = NEWEST,
) -> DataFrame:
    """One row with `starting_offsets`, the JSON a topic read starts from.

    The newest ledger row of each partition counts. No row comes out when the ledger
    has none for the topic and group. A topic read needs every partition named: those of
    `partitions` that the ledger does not know start at `unknown`. Partitions of a
    topic are few, rows are not: the first aggregate folds them before anything is gathered.
    """
    mine = ledger.filter((F.col("topic") == topic) & (F.col("group_id") == group))
    newest = mine.groupBy("topic", "partition").agg(
        F.max(F.struct("batch_id", "offset"))["offset"].alias("offset")
    )
    known = newest.withColumn("known", F.lit(True))
    if partitions:
        named = ledger.sparkSession.createDataFrame([(topic, p) for p in partitions], "topic string, partition int")
        named = named.withColumns({"offset": F.lit(unknown).cast("bigint"), "known": F.lit(False)})
        both = known.unionByName(named).groupBy("topic", "partition")
        known = both.agg(F.max(F.struct("known", "offset")).alias("last")).select("topic", "partition", "last.*")
    entries = F.array_sort(F.collect_list(F.struct(F.col("partition").cast("string"), "offset")))
    return (
        known.groupBy("topic")
        .agg(F.map_from_entries(entries).alias("offsets"), F.max("known").alias("any"))
        .filter("any")
        .select(F.to_json(F.create_map("topic", "offsets")).alias("starting_offsets"))
    )


def resume_point(
    ledger: DataFrame,
    topic: str,
    group: str,
    partitions: list[int] | None = None,
    unknown: int = NEWEST,
) -> str | None:
    """The JSON of `starting_offsets` as text, or None to start from the default."""
    found = starting_offsets(ledger, topic, group, partitions, unknown).head()
    return found.starting_offsets if found else None


def batch_offsets(msgs: DataFrame) -> DataFrame:
    """First offset and offset after the last, per topic and partition of a batch."""
    return msgs.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )
