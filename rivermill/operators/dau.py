"""First visit of each device per day."""

from pyspark.sql import DataFrame, functions as F

from rivermill.functions.keyed import first_by_key, salt_of
from rivermill.functions.scalars import day_of

VISIT = ["dt", "mid"]


def first_pages(page_log: DataFrame) -> DataFrame:
    """Pages that open a session. An empty last_page_id is not a missing one."""
    return page_log.filter("last_page_id IS NULL")


def daily_first_visit(
    df: DataFrame, bounded: bool = True, lateness: str = "1 day", salt: int = 1
) -> DataFrame:
    """First row per (dt, mid); adds dt.

    Batch: the earliest row by ts. Stream: the first row to arrive. A bounded stream
    forgets a device once the watermark has passed its visit by `lateness`, which must
    be at least one day so that the memory outlives the visit's day; rows later than
    that are dropped. `bounded=False` remembers for ever.

    `salt` > 1 first thins each device to at most one row per bucket, so that a hot
    device's rows are spread over that many stream tasks before they meet. In batch the
    map-side aggregate does this already.
    """
    dated = df.withColumn("dt", day_of("ts"))
    if not df.isStreaming:
        return first_by_key(dated, VISIT, ["ts"])
    if not bounded:
        thinned = dated
        if salt > 1:
            thinned = dated.withColumn("bucket", salt_of(df.columns, salt))
            thinned = thinned.dropDuplicates([*VISIT, "bucket"])
        return thinned.dropDuplicates(VISIT).select(*dated.columns)
    timed = dated.withColumn("visit_time", F.timestamp_millis("ts")).withWatermark(
        "visit_time", lateness
    )
    if salt > 1:
        timed = timed.withColumn("bucket", salt_of(df.columns, salt))
        timed = timed.dropDuplicatesWithinWatermark([*VISIT, "bucket"])
    return timed.dropDuplicatesWithinWatermark(VISIT).select(*dated.columns)


def rebuild_seen(visits: DataFrame, sink: DataFrame) -> DataFrame:
    """Rows whose (dt, mid) the sink does not hold yet.

    Give it the output of daily_first_visit: one row per key cannot be skewed, and
    dropping a whole key before or after picking its first row comes to the same.
    """
    seen = sink.select(F.col("dt").alias("seen_dt"), F.col("mid").alias("seen_mid"))
    on = F.col("dt").eqNullSafe(F.col("seen_dt")) & F.col("mid").eqNullSafe(
        F.col("seen_mid")
    )
    return visits.join(seen, on, "left_anti")


def observe_pages(page_log: DataFrame, name: str = "pages") -> DataFrame:
    """Same rows, with counts before and after first_pages as observed metrics."""
    return page_log.observe(
        name,
        F.count("*").alias("pages"),
        F.count_if(F.col("last_page_id").isNull()).alias("first_pages"),
    )


def observe_visits(visits: DataFrame, name: str = "visits") -> DataFrame:
    """Same rows, with their count after daily_first_visit as an observed metric."""
    return visits.observe(name, F.count("*").alias("first_visits"))


def stage_counts(page_log: DataFrame) -> DataFrame:
    """One row: pages, first_pages and first_visits, from one pass."""
    per_device = (
        page_log.groupBy(day_of("ts").alias("dt"), "mid")
        .agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("last_page_id").isNull()).alias("first_pages"),
        )
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return per_device.agg(
        total("pages"),
        total("first_pages"),
        F.count_if(F.col("first_pages") > 0).alias("first_visits"),
    )


def partition_counts(df: DataFrame) -> DataFrame:
    """Row count of every partition, to see how evenly a stage is spread."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count("*").alias("rows")
    )
