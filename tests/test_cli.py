"""The four jobs chained from the command line, over message files."""

from types import SimpleNamespace

import pytest
from conftest import rows
from streams import append_file

import catalog as C
import fixtures as X
from rivermill import schemas as S
from rivermill.__main__ import arguments, main, sources
from rivermill.sources.tables import read_docs
from rivermill.streaming import jobs
from rivermill.streaming.ledger import OffsetLedger


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_from_raw_log_to_daily_devices(spark, sf, folder):
    append_file(X.raw_log(spark, sf), f"{folder}/in/{S.LOG_TOPIC}")
    append_file(X.dim_changes(spark, sf), f"{folder}/in/{S.CHANGE_TOPIC}")
    X.lists(spark).write.parquet(f"{folder}/lists")
    run = lambda job, *rest: main(
        [job, "--once", "--checkpoint", f"{folder}/ck_{job}", "--messages", f"{folder}/in", *rest]
    )
    run("log_split", "--out", f"{folder}/topics")
    run(
        "change_split", "--out", f"{folder}/facts", "--lists", f"{folder}/lists",
        "--dims", f"{folder}/dims", "--ledger", f"{folder}/ledger", "--commits", f"{folder}/commits",
    )
    assert spark.read.parquet(f"{folder}/commits").count() == 1
    pages = spark.read.parquet(f"{folder}/topics").filter(f"topic = '{S.PAGE_TOPIC}'")
    sent = pages.selectExpr(
        "key", "value", "topic", "0 AS partition", "0L AS offset",
        "timestamp_millis(cast(get_json_object(value, '$.ts') AS bigint)) AS timestamp",
    )
    append_file(sent, f"{folder}/in/{S.PAGE_TOPIC}")
    run("dau", "--dims", f"{folder}/dims", "--sink", f"{folder}/dau")
    stored = read_docs(spark, f"{folder}/dau", S.DAU_INFO, jobs.DAU_KEYS)
    assert rows(stored, "dt", "mid") == rows(C.visits(spark, sf), "dt", "mid")
    assert spark.read.parquet(f"{folder}/ledger").count() == 3


def test_order_job_runs(spark, sf, folder):
    day = "timestamp >= '1995-03-01' AND timestamp < '1995-03-20'"
    append_file(X.order_info_messages(spark, sf).filter(day), f"{folder}/{S.ORDER_INFO_TOPIC}")
    append_file(X.order_detail_messages(spark, sf).filter(day), f"{folder}/{S.ORDER_DETAIL_TOPIC}")
    main(
        ["order_wide", "--once", "--checkpoint", f"{folder}/ck", "--messages", folder,
         "--dims", f"{folder}/none", "--sink", f"{folder}/wide"]
    )
    stored = read_docs(spark, f"{folder}/wide", S.ORDER_WIDE, jobs.ORDER_KEYS)
    assert stored.count() > 0
    assert stored.filter("user_gender IS NOT NULL").count() == 0


def test_topics_of_each_job(spark, folder):
    for topic in (S.ORDER_INFO_TOPIC, S.ORDER_DETAIL_TOPIC):
        spark.createDataFrame([], S.MESSAGE).write.parquet(f"{folder}/{topic}")
    a = arguments(["order_wide", "--checkpoint", "c", "--messages", folder])
    assert len(list(sources(spark, a))) == 2


def test_listener_notes_listed_queries_only(spark, folder):
    listener = OffsetLedger(spark, f"{folder}/ledger", ["dau"])
    source = SimpleNamespace(endOffset='{"t":{"0":5}}')
    event = lambda name, *found: SimpleNamespace(
        progress=SimpleNamespace(name=name, batchId=1, sources=list(found))
    )
    listener.onQueryProgress(event("dau", source))
    listener.onQueryProgress(event("dau", SimpleNamespace(endOffset='{"logOffset":3}')))
    listener.onQueryProgress(event("other", source))
    stored = spark.read.schema(S.LEDGER).parquet(f"{folder}/ledger")
    assert rows(stored, *S.LEDGER.names) == [("t", "dau", 0, 5, 1)]
