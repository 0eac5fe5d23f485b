"""Offsets of finished micro-batches, noted as the queries report them."""

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from rivermill import schemas as S
from rivermill.sinks.topics import append_ledger, ledger_base, progress_rows


class OffsetLedger(StreamingQueryListener):
    """Appends the end offsets of every reported micro-batch to a ledger table.

    A query reports after its output is written and committed. The query's name is the
    consumer group; queries that are not listed are left alone. One ledger has one writer:
    two queries that run at once need a ledger each.
    """

    def __init__(self, spark: SparkSession, path: str, groups: list[str]):
        self.spark, self.path, self.groups = spark, path, groups
        self.base = ledger_base(spark, path)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.name not in self.groups:
            return
        entry = {
            "batchId": self.base + progress.batchId,
            "sources": [{"endOffset": s.endOffset} for s in progress.sources],
        }
        if rows := progress_rows([entry], progress.name):
            batch = self.spark.createDataFrame(rows, S.LEDGER)
            append_ledger(batch, self.path, entry["batchId"])

    def onQueryTerminated(self, event):
        pass
