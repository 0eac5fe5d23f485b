"""What grows with the input: parses, shuffles and the rows that one task holds."""

import datetime
import os
import time

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F
from streams import NOW, append_file, finish

import catalog as C
import fixtures as X
from rivermill import schemas as S
from rivermill.functions import parse
from rivermill.session import SETTINGS
from rivermill.sinks.topics import write_topic
from rivermill.sources.topics import read_topic_files
from rivermill.streaming import jobs

MESSAGE_VALUES = [
    '{"table": "a", "type": "insert", "data": {"id": 1}}',
    '{"table": "a", "type": "insert"}',
    '{"table": "a"}',
    "not json",
    None,
]


def test_changes_are_parsed_once_a_batch(spark, sf, tmp_path, monkeypatch):
    lists, out = f"{tmp_path}/lists", f"{tmp_path}/facts"
    X.lists(spark).write.parquet(lists)
    msgs = X.dim_changes(spark, sf)
    append_file(msgs.unionByName(msgs.limit(1).withColumn("value", F.lit("not json"))), f"{tmp_path}/in")
    calls = []

    def counted(name, function):
        def call(msgs):
            calls.append(name)
            return function(msgs)

        return call

    for name in ("read_change", "parse_change", "quarantine_change"):
        monkeypatch.setattr(jobs, name, counted(name, getattr(parse, name)), raising=False)
    finish(jobs.run_change_split(read_topic_files(spark, f"{tmp_path}/in"), lists, {"path": out}, f"{tmp_path}/dims", f"{tmp_path}/ck", trigger=NOW))
    assert calls == ["read_change"]
    bad = spark.read.parquet(out).filter(F.col("topic") == S.BAD_TOPIC)
    assert [r.value for r in bad.collect()] == ["not json"]


def test_unusable_changes_keep_their_text(spark):
    msgs = spark.createDataFrame([(str(n), v) for n, v in enumerate(MESSAGE_VALUES)], "key string, value string")
    kept = parse.narrow_change(parse.read_change(msgs))
    assert rows(parse.unusable_change(kept).select("key", "value")) == rows(parse.quarantine_change(msgs))
    parsed = parse.parse_change(msgs).drop("value")
    assert rows(parse.usable_change(kept).select(*parsed.columns)) == rows(parsed)
    assert parse.usable_change(kept).filter("value IS NOT NULL").isEmpty()


def test_the_row_text_of_a_fact_is_parsed_once(spark):
    values = ['{"id":1,"order_status":"F","total_amount":1.5,"x":null}', '{"name":"N","id":"2"}', "{}", "bad", None]
    facts = C._fact_fields(spark.createDataFrame([("t", v) for v in values], "topic string, value string"))
    assert "get_json_object" not in facts._jdf.queryExecution().optimizedPlan().toString()
    got = [tuple(r)[1:] for r in facts.collect()]
    assert got[:3] == [(1, "F", 1.5, None, 4), (2, "N", None, None, 2), (None, None, None, None, 0)]
    assert got[3][:4] == got[4][:4] == (None, None, None, None)


def test_a_job_keeps_a_file_of_each_fact_topic_open(spark):
    # Each listed table with each operation, and the bad one; with fewer a task sorts its rows.
    topics = len(S.OP_CODES) * len([k for k, _ in X.TABLE_LISTS if k == "fact"]) + 1
    assert int(SETTINGS.get("spark.sql.maxConcurrentOutputFileWriters", 0)) > topics


def test_slices_in_few_tasks_are_merged_without_a_shuffle(spark, tmp_path, monkeypatch):
    kept = f"{tmp_path}/kept"
    # Sixteen files, of which every other one holds rows of the first slice alone.
    spark.range(0, 1600, 1, 16).select("id", F.expr("if(id div 100 % 2 = 0, 0, id % 4)").cast("int").alias("slice")).write.parquet(kept)
    cutting = C._cutting(spark)
    some = lambda files: cutting.read.schema("id long, slice int").parquet(*files)
    msgs = some([kept])

    def refused(*args):
        raise AssertionError("shuffled")

    monkeypatch.setattr(type(msgs), "repartition", refused)
    files = C._write_slices(msgs, f"{tmp_path}/sent", some)
    assert files == 6
    for nth in range(4):
        assert len(spark.read.parquet(f"{tmp_path}/sent/slice={nth}").inputFiles()) == files
    assert rows(spark.read.parquet(f"{tmp_path}/sent"), "id", "slice") == rows(msgs, "id", "slice")


def _messages(spark, n, tasks):
    at = F.expr("timestamp_seconds(id)").alias("timestamp")
    cells = [F.col("id").cast("string").alias("value"), F.lit(0).alias("partition"), F.col("id").alias("offset"), at]
    return spark.range(0, n, 1, tasks).select(F.lit(None).cast("string").alias("key"), F.lit("t").alias("topic"), *cells)


def test_messages_of_a_stream_are_written_once_and_in_order(spark, monkeypatch):
    made = []

    def scratch(spark, name, new=C.scratch):
        made.append((name, new(spark, name)))
        return made[-1][1]

    monkeypatch.setattr(C, "scratch", scratch)
    monkeypatch.setattr(C, "_write_slices", None)
    C._sent(spark, _messages(spark, 4000, 6))
    kept = [name for name, at in made if os.path.exists(at) and not spark.read.parquet(at).isEmpty()]
    assert kept == ["messages"]
    path = dict(made)["messages"]
    dates, files = [], set()
    for nth in range(C.BATCHES):
        found = [x for x in os.listdir(f"{path}/slice={nth}") if x.endswith(".parquet")]
        files.add(len(found))
        dates.append({os.path.getmtime(f"{path}/slice={nth}/{x}") for x in found})
        got = spark.read.parquet(f"{path}/slice={nth}").select("offset")
        assert rows(got) == [(n,) for n in sorted(range(1000 * nth, 1000 * nth + 1000), key=str)]
    assert len(files) == 1 and all(max(a) < min(b) for a, b in zip(dates, dates[1:]))


@pytest.mark.parametrize("dated", [True, False])
def test_each_micro_batch_is_a_slice_of_the_messages(spark, monkeypatch, dated):
    if not dated:  # a store that keeps no dates: the slices are written one after the other
        deal = C._deal_slices
        monkeypatch.setattr(C, "_deal_slices", lambda msgs, path: deal(msgs, path) and None)
    (msgs,) = C._sent(spark, _messages(spark, 4000, 6).unionByName(_messages(spark, 10, 1)))
    batches, ck = [], C.scratch(spark, "ck")
    keep = lambda batch, n: batches.append(sorted(r.offset for r in batch.select("offset").collect()))
    finish(msgs.writeStream.option("checkpointLocation", ck).foreachBatch(keep).trigger(**NOW).start())
    assert batches == [sorted([*range(1000 * n, 1000 * n + 1000), *(range(10) if n == 0 else [])]) for n in range(4)]


def test_state_that_is_read_as_a_whole_is_kept_in_snapshots(spark, sf):
    ck = C._joining(spark, sf)
    names = [x for _, _, found in os.walk(f"{ck}/state") for x in found]
    assert not [x for x in names if x.endswith(".changelog")]
    assert [x for x in names if x.endswith(".zip")]


def test_shuffle_files_go_with_their_query(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    own = spark.newSession()
    for key, value in SETTINGS.items():
        own.conf.set(key, value)
    shuffles = lambda: {f.getName().split("_")[1] for f in _each(local.getAllFiles()) if f.getName().startswith("shuffle_")}
    before = shuffles()
    assert own.range(0, 1000, 1, 4).groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before


def _each(found):
    return [found.apply(n) for n in range(found.size())]


def test_a_task_holds_a_bounded_part_of_each_topic(spark, tmp_path):
    text = F.concat(*[F.sha2(F.concat("id", F.lit(n)), 512) for n in "abcd"])
    msgs = spark.range(0, 100_000, 1, 1).select(F.lit("t").alias("topic"), F.lit(None).cast("string").alias("key"), text.alias("value"))
    write_topic(msgs, {"path": f"{tmp_path}/out"})
    (at,) = [f"{d}/{x}" for d, _, found in os.walk(f"{tmp_path}/out") for x in found if x.endswith(".parquet")]
    meta = pq.read_metadata(at)
    held = [sum(meta.row_group(n).column(c).total_compressed_size for c in range(meta.num_columns)) for n in range(meta.num_row_groups)]
    assert len(held) > 1 and max(held) < 12 << 20


def test_a_task_holds_few_rows_of_a_kept_batch_while_it_moves_them_to_disk(spark):
    # A hundred pieces are held at a time there.
    assert int(SETTINGS.get("spark.sql.inMemoryColumnarStorage.batchSize", 10_000)) <= 1000


ORDER_VALUES = ['{"id": "1", "order_id": 2, "sku_num": 3}', '{"id": "x", "order_id": 2}', '{"order_id": 2}', '{"id": 1}', "not json", "{}", None]


@pytest.mark.parametrize("kind", ["info", "detail"])
def test_order_messages_that_are_read_once_are_usable_or_as_they_came(spark, kind):
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.MESSAGE)
    at = datetime.datetime(2024, 1, 1)
    msgs = spark.createDataFrame([("k", v, "t", 0, n, at) for n, v in enumerate(ORDER_VALUES)], fields)
    keep = ("partition", "offset") if kind == "detail" else ()
    read = parse.read_order(msgs, kind, keep)
    assert read.filter("(row IS NULL) = (message IS NULL)").isEmpty()
    wanted = parse.parse_order_info(msgs) if kind == "info" else parse.parse_order_detail(msgs, keep)
    got = read.filter("row IS NOT NULL").select("row.*")
    assert got.columns == wanted.columns and rows(got) == rows(wanted)
    assert rows(read.filter("message IS NOT NULL").select("message.*")) == rows(parse.quarantine_order(msgs, kind))


def test_order_messages_are_not_parsed_again_when_a_batch_is_stored(spark, sf, tmp_path, monkeypatch):
    bad = X.with_bad(X.order_detail_messages(spark, sf), "order_id")
    append_file(X.order_info_messages(spark, sf), f"{tmp_path}/info")
    append_file(bad, f"{tmp_path}/detail")
    dims, out = f"{tmp_path}/dims", f"{tmp_path}/out"
    C.write_dims(C._dim_rows(spark, sf), dims, 0)

    calls = []
    for name in ("parse_order_info", "parse_order_detail"):
        monkeypatch.setattr(jobs, name, lambda *a, f=getattr(parse, name), name=name: calls.append(name) or f(*a))
    streams = [read_topic_files(spark, f"{tmp_path}/{side}") for side in ("info", "detail")]
    finish(jobs.run_order_wide(*streams, dims, out, f"{tmp_path}/ck", trigger=NOW))
    assert calls == ["parse_order_info", "parse_order_detail"]
    unusable = parse.quarantine_order(bad, "detail")
    assert rows(spark.read.parquet(f"{out}_bad"), "value") == rows(unusable, "value")
