"""Session settings the jobs are written for."""

import time

from pyspark.sql import SparkSession

# The files of a query's shuffles go when it ends, and not when the driver's heap is next collected.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SETTINGS = {
    # Days and hours are cut in the session time zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # State larger than memory: kept on disk, with only its changes checkpointed.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Of the files of a state it makes about two thirds of what the default one does.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    # About two thirds of what the default one makes of a join's changes.
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # A join has one store for a partition and not four; older checkpoints keep theirs.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # Tasks that write few topics or tables keep a file of each open; without, they sort their rows first, and spill.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    # Kept rows go to disk a hundred of these pieces at a time: 10,000 rows of texts each, as by default, fill an executor.
    "spark.sql.inMemoryColumnarStorage.batchSize": "1000",
    FREE: "true",
    # A join's state may only go once both inputs have passed it.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


# Without these a job gives other days or loses rows; the others are for size.
REQUIRED = ("spark.sql.session.timeZone", "spark.sql.streaming.multipleWatermarkPolicy")


def check(spark: SparkSession) -> None:
    """Fail where a session would cut other days or forget rows too early."""
    for key in REQUIRED:
        found = spark.conf.get(key, None)
        if found != SETTINGS[key]:
            raise ValueError(f"{key} must be {SETTINGS[key]!r}, not {found!r}")


# Seconds between two collections of the driver's heap, at the least.
FREE_EVERY = 20
_freed = {"at": 0.0}


def free_shuffles(spark: SparkSession, every: float = 0) -> None:
    """Free the shuffle files of all that is not referred to any more, at most once in `every` seconds.

    Those of a micro-batch, or of kept rows, go when the driver's heap is collected, which may be
    hours later: a driver that plans alone has little to collect.
    """
    if time.monotonic() - _freed["at"] >= every:
        spark.sparkContext._jvm.System.gc()
        _freed["at"] = time.monotonic()


def builder(app: str) -> SparkSession.Builder:
    made = SparkSession.builder.appName(app)
    for name, value in SETTINGS.items():
        made = made.config(name, value)
    return made
