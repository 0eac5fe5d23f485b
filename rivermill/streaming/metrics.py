"""Counts that running queries observe, as a table."""

import threading

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQueryListener

from rivermill.sources.stores import next_batch, read_store, write_batch

METRICS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def metric_rows(observed: dict, query: str, batch_id: int) -> list[tuple]:
    """A row for each observed metric of a micro-batch; of a stage without rows there is none."""
    return [
        (query, stage, metric, value, batch_id)
        for stage, row in sorted(observed.items())
        for metric, value in row.asDict().items()
        if value is not None
    ]


class MetricTable(StreamingQueryListener):
    """Appends the observed metrics of every reported micro-batch to a table, once a batch.

    Queries that are not listed are left alone. One table has one writer: two queries that
    run at once need a table each. A batch that is run again replaces its rows.
    """

    def __init__(self, spark: SparkSession, path: str, names: list[str]):
        self.spark, self.path, self.names = spark, path, names
        self.base = next_batch(spark, path)
        self.ended = threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.name not in self.names:
            return
        batch_id = self.base + progress.batchId
        if rows := metric_rows(progress.observedMetrics, progress.name, batch_id):
            write_batch(self.spark.createDataFrame(rows, METRICS).coalesce(1), self.path, batch_id)

    def onQueryTerminated(self, event):
        self.ended.set()


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_store(spark, path, METRICS)
