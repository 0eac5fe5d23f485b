"""Run one of the four jobs: python -m rivermill <job> --help"""

import argparse

from pyspark.sql import functions as F

from rivermill import schemas as S
from rivermill.session import builder
from rivermill.sinks.commits import read_commits
from rivermill.sinks.topics import read_ledger
from rivermill.sources import tables
from rivermill.sources.topics import read_topic, read_topic_files, resume_point
from rivermill.streaming import jobs
from rivermill.streaming.ledger import OffsetLedger
from rivermill.streaming.metrics import MetricTable

TOPICS = {
    "log_split": [S.LOG_TOPIC],
    "change_split": [S.CHANGE_TOPIC],
    "dau": [S.PAGE_TOPIC],
    "order_wide": [S.ORDER_INFO_TOPIC, S.ORDER_DETAIL_TOPIC],
}


def arguments(argv=None):
    p = argparse.ArgumentParser(prog="rivermill")
    p.add_argument("job", choices=[*TOPICS, "compact"])
    p.add_argument("--checkpoint", help="checkpoint folder of the query")
    p.add_argument("--brokers", help="bootstrap servers; else --messages is read")
    p.add_argument("--messages", help="folder with one folder of message files per topic")
    p.add_argument("--rate", type=int, help="most offsets (or files) per micro-batch")
    p.add_argument("--out", help="folder for message files when there are no brokers")
    p.add_argument("--lists", help="table-list config (change_split)")
    p.add_argument("--dims", help="dimension store (change_split, dau, order_wide)")
    p.add_argument("--sink", help="document folder (dau, order_wide)")
    p.add_argument("--seen", help="pinned snapshot folder for a fresh checkpoint (dau)")
    p.add_argument("--bad-topic", default=S.BAD_TOPIC, help="topic for unusable messages")
    p.add_argument("--ledger", help="offset ledger folder")
    p.add_argument("--commits", help="commit table of the batches (log_split, change_split, compact)")
    p.add_argument("--metrics", help="table of the counts that a job observes (dau)")
    p.add_argument("--on-missing", default="null", choices=["null", "drop", "fail"])
    p.add_argument("--salt", type=int, default=8)
    p.add_argument("--as-of", help="date at which ages are taken; today by default")
    p.add_argument("--remember", action="store_true", help="keep devices in the state for ever (dau)")
    p.add_argument("--lateness", help="how far behind the newest message a row may be")
    p.add_argument("--retention", default="24 hours", help="how far apart a header and its lines arrive")
    p.add_argument("--partitions", type=int, help="partitions of the topics, named on a resume")
    p.add_argument("--kind", choices=["dau", "order_wide"], help="documents in --sink (compact)")
    p.add_argument("--delete", action="store_true", help="delete folded batches (compact)")
    p.add_argument("--once", action="store_true", help="stop when all input is read")
    a = p.parse_args(argv)
    if a.job != "compact" and not a.checkpoint:
        p.error("--checkpoint is required")
    if a.job == "compact" and a.sink and not a.kind:
        p.error("--kind says what --sink holds")
    return a


def sources(spark, a):
    """One stream per topic; each resumes alone from its own ledger rows."""
    for topic in TOPICS[a.job]:
        if not a.brokers:
            yield read_topic_files(spark, f"{a.messages}/{topic}", a.rate)
            continue
        options = {"kafka.bootstrap.servers": a.brokers}
        if a.rate:
            options["maxOffsetsPerTrigger"] = str(a.rate)
        start = None
        if a.ledger:
            named = list(range(a.partitions)) if a.partitions else None
            start = resume_point(read_ledger(spark, a.ledger), topic, a.job, named)
        yield read_topic(spark, topic, options, start)


def start(spark, a):
    target = {"kafka.bootstrap.servers": a.brokers} if a.brokers else {"path": a.out}
    common = {"name": a.job}
    if a.once:
        common["trigger"] = {"availableNow": True}
    # Message files have no topic offsets to report; their own are noted instead.
    by_message = a.ledger if a.job == "change_split" and not a.brokers else None
    if a.ledger and not by_message:
        spark.streams.addListener(OffsetLedger(spark, a.ledger, [a.job]))
    if a.metrics:
        spark.streams.addListener(MetricTable(spark, a.metrics, [a.job]))
    msgs = list(sources(spark, a))
    lookups = {"on_missing": a.on_missing, "salt": a.salt}
    lookups["as_of"] = F.lit(a.as_of).cast("date") if a.as_of else None
    if a.brokers:
        lookups["bad"] = target
    if a.job == "log_split":
        return jobs.run_log_split(
            *msgs, target, a.checkpoint, a.bad_topic, commits=a.commits, **common
        )
    if a.job == "change_split":
        return jobs.run_change_split(
            *msgs,
            a.lists,
            target,
            a.dims,
            a.checkpoint,
            by_message,
            a.job,
            bad_topic=a.bad_topic,
            commits=a.commits,
            **common,
        )
    if a.job == "dau":
        return jobs.run_dau(
            *msgs,
            a.dims,
            a.sink,
            a.checkpoint,
            a.seen,
            bounded=not a.remember,
            lateness=a.lateness or "1 day",
            **lookups,
            **common,
        )
    return jobs.run_order_wide(
        *msgs,
        a.dims,
        a.sink,
        a.checkpoint,
        a.retention,
        lateness=a.lateness,
        **lookups,
        **common,
    )


def compact(spark, a):
    """Fold the stores that are named; a reader then lists the snapshot and what came after.

    With --commits the committed batches of dimensions and ledger alone are folded."""
    commits = read_commits(spark, a.commits) if a.commits else None
    if a.sink and a.kind == "dau":
        tables.compact_docs(spark, a.sink, S.DAU_INFO, jobs.DAU_KEYS, delete=a.delete)
    elif a.sink:
        tables.compact_docs(
            spark, a.sink, S.ORDER_DOC, jobs.ORDER_KEYS, jobs.ORDER_LAST, delete=a.delete
        )
    if a.dims:
        tables.compact_dims(spark, a.dims, delete=a.delete, commits=commits)
    if a.ledger:
        tables.compact_ledger(spark, a.ledger, delete=a.delete, commits=commits)


def main(argv=None):
    a = arguments(argv)
    spark = builder(f"rivermill-{a.job}").getOrCreate()
    if a.job == "compact":
        compact(spark, a)
    else:
        start(spark, a).awaitTermination()


if __name__ == "__main__":
    main()
