"""Streams over message files: equal to batch, restartable, replayable."""

import os
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F
from streams import NOW, append_file, finish, write_slices

import catalog as C
import fixtures as X
from rivermill import schemas as S
from rivermill.functions import parse
from rivermill.functions.keyed import last_by_key
from rivermill.functions.scalars import create_parts
from rivermill.operators import changes, dau, logs
from rivermill.operators.orders import merge_order_wide, order_wide_join
from rivermill.plans.wide_tables import dau_wide, order_dims
from rivermill.sinks import docs
from rivermill.sinks.docs import write_dims, write_docs
from rivermill.sinks.topics import read_ledger, write_topic
from rivermill.sources import pending
from rivermill.sources.stores import read_store, snapshot, split_columns, write_batch
from rivermill.sources.tables import (
    DIM_STORE,
    compact_dims,
    compact_docs,
    compact_ledger,
    read_dims,
    read_docs,
    read_provinces,
    read_users,
)
from rivermill.sources.state import join_state
from rivermill.sources.topics import read_topic_files, resume_point
from rivermill.streaming import jobs

KIND = "kind string, table string"
physical = lambda df: df._jdf.queryExecution().executedPlan().toString()
# One row per device and day in the DAU table whose columns do not depend on which of
# the day's pages arrived first.
STEADY = ["dt", "mid", "user_id", "province_name", "user_gender", "user_age"]


@pytest.fixture(scope="module")
def dims_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dims") / "store")
    rows_ = C._dim_rows(spark, "/root/testdata/sf0.001")
    write_dims(rows_, path, 0)
    return path


def as_of():
    return C.as_of()


def page_messages(spark, sf):
    value = X.page_log_messages(spark, sf)
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    return value.select(
        F.lit(None).cast("string").alias("key"),
        "value",
        F.lit(S.PAGE_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        ts.alias("offset"),
        F.timestamp_millis(ts).alias("timestamp"),
    )


def order_messages(spark, sf):
    return X.order_info_messages(spark, sf), X.order_detail_messages(spark, sf)


def run_dau(spark, tmp, dims_path, **options):
    return finish(
        jobs.run_dau(
            read_topic_files(spark, f"{tmp}/pages", 1),
            dims_path,
            f"{tmp}/dau",
            options.pop("checkpoint", f"{tmp}/ck"),
            as_of=as_of(),
            trigger=NOW,
            **options,
        )
    )


def stored_dau(spark, tmp):
    return read_docs(spark, f"{tmp}/dau", S.DAU_INFO, jobs.DAU_KEYS)


def test_log_split_equals_batch_across_a_restart(spark, sf, tmp_path):
    raw = X.raw_log(spark, sf)
    run = lambda: finish(
        jobs.run_log_split(
            read_topic_files(spark, f"{tmp_path}/log", 1),
            {"path": f"{tmp_path}/topics"},
            f"{tmp_path}/ck",
            bad_topic="BAD",
            trigger=NOW,
        )
    )
    write_slices(raw.filter("offset < 600"), f"{tmp_path}/log", 2)
    run()
    write_slices(raw.filter("offset >= 600"), f"{tmp_path}/log", 2)
    run()
    run()
    got = spark.read.parquet(f"{tmp_path}/topics").select("topic", "key", "value")
    assert rows(got) == rows(logs.fan_out(parse.parse_log(raw), "BAD"))


def test_change_split_follows_the_lists_and_keeps_a_ledger(spark, sf, tmp_path):
    lists, log, ledger = f"{tmp_path}/lists", f"{tmp_path}/log", f"{tmp_path}/ledger"
    msgs = X.dim_changes(spark, sf)
    first = F.col("offset") < X.SECOND_VERSION
    put = lambda *pairs: spark.createDataFrame(list(pairs), KIND).write.mode(
        "overwrite"
    ).parquet(lists)

    def run():
        finish(
            jobs.run_change_split(
                read_topic_files(spark, log, 1),
                lists,
                {"path": f"{tmp_path}/facts"},
                f"{tmp_path}/dims",
                f"{tmp_path}/ck",
                ledger_path=ledger,
                group="g",
                trigger=NOW,
            )
        )

    put(("dim", "user_info"))
    append_file(msgs.filter(first), log)
    run()
    assert rows(read_dims(spark, f"{tmp_path}/dims").select("table").distinct()) == [
        ("user_info",)
    ]
    put(("dim", "user_info"), ("fact", "user_info"))
    append_file(msgs.filter(~first), log)
    run()
    users = C._dim_rows(spark, sf).filter("table = 'user_info'")
    assert rows(read_dims(spark, f"{tmp_path}/dims"), "id", "data", "op") == rows(
        changes.upsert_dim(None, users), "id", "data", "op"
    )
    removed = changes.upsert_dim(None, users, deletes="remove")
    assert read_users(spark, f"{tmp_path}/dims", "remove").count() == removed.count()
    facts = spark.read.parquet(f"{tmp_path}/facts")
    second = changes.map_op(parse.parse_change(msgs.filter(~first)))
    assert rows(facts, "topic", "value") == rows(
        changes.route_facts(second, spark.createDataFrame([("user_info",)], "table string")),
        "topic",
        "value",
    )
    tops = msgs.groupBy("partition").agg((F.max("offset") + 1).alias("o")).collect()
    wanted = ",".join(f'"{r.partition}":{r.o}' for r in sorted(tops))
    point = resume_point(read_ledger(spark, ledger), S.CHANGE_TOPIC, "g")
    assert point == '{"ODS_BASE_DB":{' + wanted + "}}"
    assert resume_point(read_ledger(spark, ledger), S.CHANGE_TOPIC, "other") is None
    compact_ledger(spark, ledger, delete=True)
    assert resume_point(read_ledger(spark, ledger), S.CHANGE_TOPIC, "g") == point


@pytest.mark.parametrize("salt, bounded", [(1, True), (8, True), (8, False)])
def test_dau_stream_equals_batch(spark, sf, tmp_path, dims_path, salt, bounded):
    msgs = page_messages(spark, sf)
    write_slices(msgs, f"{tmp_path}/pages", 3)
    query = run_dau(spark, tmp_path, dims_path, salt=salt, bounded=bounded)
    batch = dau_wide(
        parse.parse_page_log(msgs),
        read_users(spark, dims_path),
        read_provinces(spark, dims_path),
        as_of(),
    )
    assert rows(stored_dau(spark, tmp_path), *STEADY) == rows(batch, *STEADY)
    kept = [p["observedMetrics"]["visits"].first_visits for p in query.recentProgress]
    assert sum(kept) == batch.count()
    seen = [p["observedMetrics"]["pages"] for p in query.recentProgress]
    assert sum(r.pages for r in seen) == msgs.count()
    assert sum(r.first_pages for r in seen) == dau.first_pages(
        parse.parse_page_log(msgs)
    ).count()


def test_fresh_checkpoint_emits_nothing_twice(spark, sf, tmp_path, dims_path):
    msgs = page_messages(spark, sf)
    cut = 1_705_000_000_000
    append_file(msgs.filter(F.col("offset") < cut), f"{tmp_path}/pages")
    run_dau(spark, tmp_path, dims_path, checkpoint=f"{tmp_path}/old")
    before = rows(stored_dau(spark, tmp_path))
    append_file(msgs.filter(F.col("offset") >= cut), f"{tmp_path}/pages")
    for _ in range(2):
        run_dau(
            spark,
            tmp_path,
            dims_path,
            checkpoint=f"{tmp_path}/new",
            seen_path=f"{tmp_path}/seen",
        )
    after = rows(stored_dau(spark, tmp_path))
    assert set(before) <= set(after)
    assert rows(stored_dau(spark, tmp_path), "dt", "mid") == rows(
        C.visits(spark, sf), "dt", "mid"
    )
    assert spark.read.parquet(f"{tmp_path}/dau").count() == len(after)
    assert spark.read.parquet(f"{tmp_path}/seen/visits").count() == len(before)


def test_fresh_checkpoint_replaces_no_stored_batch(spark, sf, tmp_path, dims_path):
    msgs = page_messages(spark, sf)
    days = (F.col("offset") >= 1_704_500_000_000) & (F.col("offset") < 1_705_000_000_000)
    odd = F.get_json_object("value", "$.user_id").cast("int") % 2 == 1
    for half, name in ((odd, "a"), (~odd, "b")):
        append_file(msgs.filter(days & half), f"{tmp_path}/{name}/pages")
        query = lambda: finish(
            jobs.run_dau(
                read_topic_files(spark, f"{tmp_path}/{name}/pages"),
                dims_path,
                f"{tmp_path}/dau",
                f"{tmp_path}/{name}/ck",
                salt=1,
                trigger=NOW,
            )
        )
        query()
    query()
    both = parse.parse_page_log(msgs.filter(days))
    batch = dau.daily_first_visit(dau.first_pages(both))
    assert batch.count() > 0
    assert rows(stored_dau(spark, tmp_path), "dt", "mid") == rows(batch, "dt", "mid")


def test_fresh_checkpoint_keeps_stored_dimensions(spark, sf, tmp_path):
    changes_ = X.dim_changes(spark, sf)
    X.lists(spark).write.parquet(f"{tmp_path}/lists")
    first = F.col("offset") < X.SECOND_VERSION
    for part, name in ((first, "a"), (~first, "b")):
        append_file(changes_.filter(part), f"{tmp_path}/{name}")
        finish(
            jobs.run_change_split(
                read_topic_files(spark, f"{tmp_path}/{name}"),
                f"{tmp_path}/lists",
                {"path": f"{tmp_path}/facts"},
                f"{tmp_path}/dims",
                f"{tmp_path}/ck_{name}",
                trigger=NOW,
            )
        )
    wanted = changes.upsert_dim(None, C._dim_rows(spark, sf))
    got = read_dims(spark, f"{tmp_path}/dims")
    assert rows(got, "dim_key", "op", "data") == rows(wanted, "dim_key", "op", "data")


def order_job(spark, tmp, dims_path, **options):
    return finish(
        jobs.run_order_wide(
            read_topic_files(spark, f"{tmp}/info", 1),
            read_topic_files(spark, f"{tmp}/detail", 1),
            dims_path,
            f"{tmp}/wide",
            f"{tmp}/ck",
            as_of=as_of(),
            trigger=NOW,
            **options,
        )
    )


def stored_orders(spark, tmp):
    docs = read_docs(
        spark, f"{tmp}/wide", S.ORDER_DOC, jobs.ORDER_KEYS, order_by=jobs.ORDER_LAST
    )
    return docs


def same_documents(stored, info, detail, dims_path):
    """One stored row per key: that of the line whose message arrived last."""
    spark = stored.sparkSession
    headers = create_parts(parse.parse_order_info(info))
    lines = parse.parse_order_detail(detail, ("partition", "offset"))
    wide = merge_order_wide(order_wide_join(headers, lines), place=True)
    wide = order_dims(
        wide, read_users(spark, dims_path), read_provinces(spark, dims_path), as_of()
    )
    last = last_by_key(wide, jobs.ORDER_KEYS, list(jobs.ORDER_LAST))
    assert rows(stored, *S.ORDER_DOC.names) == rows(last, *S.ORDER_DOC.names)


@pytest.mark.parametrize("salt", [1, 8])
def test_order_stream_equals_batch(spark, sf, tmp_path, dims_path, salt):
    info, detail = order_messages(spark, sf)
    write_slices(info, f"{tmp_path}/info", 3)
    write_slices(detail, f"{tmp_path}/detail", 3)
    query = order_job(spark, tmp_path, dims_path, salt=salt)
    same_documents(stored_orders(spark, tmp_path), info, detail, dims_path)
    dropped = [
        o["numRowsDroppedByWatermark"]
        for p in query.recentProgress
        for o in p["stateOperators"]
    ]
    assert sum(dropped) == 0


@pytest.mark.parametrize("first", ["info", "detail"])
def test_sides_in_different_batches_across_a_restart(spark, tmp_path, dims_path, first):
    at = lambda hour: f"2024-01-01 {hour:02d}:00:00"
    header = '{"id":1,"user_id":4,"province_id":7,"create_time":"2024-01-01 10:00:00"}'
    line = '{"id":11,"order_id":1,"sku_num":2,"create_time":"2024-01-01 10:01:00"}'
    hours = {"info": 10, "detail": 12} if first == "info" else {"info": 12, "detail": 10}
    made = {
        "info": message(spark, S.ORDER_INFO_TOPIC, header, at(hours["info"]), 0),
        "detail": message(spark, S.ORDER_DETAIL_TOPIC, line, at(hours["detail"]), 0),
    }
    empty = made["info"].limit(0)
    second = "detail" if first == "info" else "info"
    append_file(made[first], f"{tmp_path}/{first}")
    append_file(empty, f"{tmp_path}/{second}")
    order_job(spark, tmp_path, dims_path)
    assert stored_orders(spark, tmp_path).count() == 0
    append_file(made[second], f"{tmp_path}/{second}")
    order_job(spark, tmp_path, dims_path)
    order_job(spark, tmp_path, dims_path)
    assert rows(stored_orders(spark, tmp_path), "detail_id", "order_id", "create_date") == [
        (11, 1, "2024-01-01")
    ]


def message(spark, topic, value, when, n):
    return spark.range(1).select(
        F.lit(None).cast("string").alias("key"),
        F.lit(value).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(n).cast("bigint").alias("offset"),
        F.lit(when).cast("timestamp").alias("timestamp"),
    )


def order_message(spark, side, n, when):
    """Header n, or line n of order n."""
    value = {"info": f'{{"id":{n},"create_time":"{when}"}}', "detail": f'{{"id":{n},"order_id":{n},"create_time":"{when}"}}'}[side]
    return message(spark, {"info": S.ORDER_INFO_TOPIC, "detail": S.ORDER_DETAIL_TOPIC}[side], value, when, n)


@pytest.mark.parametrize("late", ["info", "detail", "both"])
def test_rows_behind_the_watermark_find_their_partners(spark, tmp_path, dims_path, late):
    """Order 1 is of the first day; the newest message is nine days on when the late side comes.
    A header that comes in time may still belong to a line that came late before."""
    old, new = "2024-01-01 10:00:00", "2024-01-10 10:00:00"
    batches = [{"info": [(9, new)], "detail": [(9, new)]}, {"info": [], "detail": []}, {"info": [(8, new)], "detail": [(8, new)]}]
    for side in ("info", "detail"):
        batches[1 if late in (side, "both") else 0][side].append((1, old))
    # The line is a day and an hour behind the newest, its header is not.
    batches[1]["detail"].append((2, "2024-01-09 09:00:00"))
    batches[2]["info"].append((2, "2024-01-09 10:30:00"))
    for k, batch in enumerate(batches):
        for side, made in batch.items():
            frame = order_message(spark, side, 0, old).limit(0)
            for n, when in made:
                frame = frame.unionByName(order_message(spark, side, n, when))
            append_file(frame, f"{tmp_path}/{side}")
        query = order_job(spark, tmp_path, dims_path, keep="30 days")
        if k == 1:
            assert sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"]) > 0
    assert rows(stored_orders(spark, tmp_path), "detail_id", "order_id") == [(1, 1), (2, 2), (8, 8), (9, 9)]


def test_kept_rows_expire(spark, tmp_path):
    path, headers = f"{tmp_path}/pending", lambda day: parse.parse_order_info(order_message(spark, "info", 1, f"2024-01-{day:02d} 10:00:00"))
    for batch, day in enumerate((1, 2, 9, 3)):
        newest = pending.newest_before(spark, path, batch)
        pending.put_pending(headers(day), path, "info", batch, newest, "24 hours")
        pending.put_mark(spark, path, batch, headers(day).agg(F.max(F.unix_micros("arrival"))).head()[0])
    pending.expire(spark, path, "150 hours")
    kept = spark.read.parquet(f"{path}/info").select("batch_id", "late").collect()
    assert sorted((r.batch_id, r.late) for r in kept) == [(2, "false"), (3, "true")]
    assert pending.newest_before(spark, path, 9) == 1_704_794_400_000_000


def test_devices_days_late_are_seen_once_and_state_ends(spark, sf, tmp_path, dims_path):
    """Messages in the order of a hash, over some days: every batch has rows days late."""
    msgs = page_messages(spark, sf)
    for k in range(3):
        append_file(msgs.filter(F.pmod(F.xxhash64("offset"), F.lit(3)) == k), f"{tmp_path}/pages")
    query = run_dau(spark, tmp_path, dims_path, salt=1)
    batch = dau_wide(parse.parse_page_log(msgs), read_users(spark, dims_path), read_provinces(spark, dims_path), as_of())
    assert rows(stored_dau(spark, tmp_path), *STEADY) == rows(batch, *STEADY)
    assert spark.read.parquet(f"{tmp_path}/dau").count() == batch.count()
    assert spark.read.parquet(f"{tmp_path}/dau_late/keys").count() > 0
    newest = batch.agg(F.max("dt")).head()[0]
    recent = batch.filter(F.datediff(F.lit(newest), "dt") <= 2).count()
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= recent < batch.count()


def test_a_day_has_one_file_unless_it_is_large(spark, tmp_path):
    few = spark.range(3000).select((F.col("id") % 300).cast("string").alias("dt"), "id").repartition(16)
    write_docs(few, f"{tmp_path}/few", ["dt", "id"], ["id"], 0, unique=True)
    files = lambda name: spark.read.parquet(f"{tmp_path}/{name}").select("dt", F.input_file_name().alias("f")).distinct().groupBy("dt").count()
    assert {r["count"] for r in files("few").collect()} == {1}
    hot = spark.range(4000).select(F.when(F.col("id") < 40, F.col("id").cast("string")).alias("dt"), "id")
    with_hot = docs.by_day(hot, "dt", file_rows=500)
    per_task = [r["count"] for r in with_hot.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) < 700 and len(per_task) == 8 + 8
    assert rows(with_hot) == rows(hot)
    placed, tasks = docs.day_tasks([(f"d{k}", 10) for k in range(1000)] + [("big", 2_500_000)], 8)
    assert tasks == 8 + 3 and placed[-1] == ("big", 8, 3)
    assert docs.day_tasks([], 8) == ([], 1)


def test_days_of_few_rows_share_their_month(spark, tmp_path):
    day = lambda n: F.date_add(F.lit("2023-12-01").cast("date"), F.expr(n)).cast("string")
    few = spark.range(3000).select(day("cast(id % 300 as int)").alias("dt"), "id").repartition(16)
    hot = spark.range(5000, 5600).select(day("7").alias("dt"), "id")
    made = few.unionByName(hot).unionByName(spark.range(2).select(F.lit(None).cast("string").alias("dt"), "id"))
    write_batch(docs.by_span(made, "dt", span_rows=500), f"{tmp_path}/docs", 0, "span")
    spans = spark.read.parquet(f"{tmp_path}/docs").select("span", F.input_file_name().alias("f")).distinct()
    assert sorted(r.span for r in spans.collect()) == sorted(["2023-12", "2023-12-08", "None", *[f"2024-{m:02d}" for m in range(1, 10)]])
    write_docs(few.filter("id < 300"), f"{tmp_path}/docs", ["dt", "id"], ["id"], 1, spans=True)
    row = made.schema
    assert rows(read_docs(spark, f"{tmp_path}/docs", row, ["dt", "id"])) == rows(made)
    for when in ("2023-12-08", "2024-01-31"):
        one = read_docs(spark, f"{tmp_path}/docs", row, ["dt", "id"], when)
        assert rows(one) == rows(made.filter(F.col("dt") == when))
        assert re.search(rf"PartitionFilters: \[span#\d+ IN \({when},{when[:7]}\)\]", physical(one))
    compact_docs(spark, f"{tmp_path}/docs", row, ["dt", "id"])
    assert rows(read_docs(spark, f"{tmp_path}/docs", row, ["dt", "id"])) == rows(made)


def test_a_store_begun_by_day_goes_on_by_day(spark, sf, tmp_path, dims_path):
    info, detail = order_messages(spark, sf)
    append_file(info.filter("offset < 200"), f"{tmp_path}/info")
    append_file(detail.filter("offset < 1600"), f"{tmp_path}/detail")
    first = spark.createDataFrame([("2000-01-01", 0, 0)], "create_date string, detail_id long, order_id long")
    write_docs(first, f"{tmp_path}/wide", jobs.ORDER_KEYS, ["order_id"], 0, day="create_date")
    order_job(spark, tmp_path, dims_path)
    assert split_columns(spark, f"{tmp_path}/wide") == ["create_date"]
    assert split_columns(spark, f"{tmp_path}/none") == []
    assert stored_orders(spark, tmp_path).count() > 1


def test_rows_in_time_are_not_joined_again(spark, tmp_path):
    """Without late rows no pair of the store is asked for."""
    at = "2024-01-01 10:00:00"
    made = {"info": parse.parse_order_info(order_message(spark, "info", 1, at)), "detail": parse.parse_order_detail(order_message(spark, "detail", 1, at))}
    for side, frame in made.items():
        pending.put_pending(frame, f"{tmp_path}/pending", side, 0, None, "24 hours")
    pairs = pending.late_pairs(spark, f"{tmp_path}/pending", 0, made["info"].schema, made["detail"].schema, "24 hours", 8)
    assert pairs.count() == 0 and "Exchange" not in physical(pairs) and "Join" not in physical(pairs)


def test_replayed_batch_changes_nothing(spark, sf, tmp_path):
    docs = C.visits(spark, sf)
    path = f"{tmp_path}/docs"
    row = docs.schema
    keys = ["dt", "mid"]
    part = F.col("dt") < "2024-01-10"
    write_docs(docs.filter(part), path, keys, ["ts"], 0)
    write_docs(docs.filter(~part), path, keys, ["ts"], 1)
    once = rows(read_docs(spark, path, row, keys))
    write_docs(docs.filter(~part), path, keys, ["ts"], 1)
    assert rows(read_docs(spark, path, row, keys)) == once == rows(docs)
    newer = docs.withColumn("page_id", F.lit("new"))
    write_docs(newer.filter(part), path, keys, ["ts"], 2)
    got = read_docs(spark, path, row, keys)
    assert rows(got) == rows(newer.filter(part).unionByName(docs.filter(~part)))
    assert read_docs(spark, path, row, keys, day="1999-01-01").count() == 0
    assert read_docs(spark, f"{path}_absent", row, keys).count() == 0


def test_two_checkpoints_write_one_folder(spark, sf, tmp_path):
    raw = X.raw_log(spark, sf)
    for name, part in (("a", "offset < 400"), ("b", "offset >= 400")):
        append_file(raw.filter(part), f"{tmp_path}/{name}/log")
        finish(
            jobs.run_log_split(
                read_topic_files(spark, f"{tmp_path}/{name}/log"),
                {"path": f"{tmp_path}/topics"},
                f"{tmp_path}/{name}/ck",
                trigger=NOW,
            )
        )
    got = spark.read.parquet(f"{tmp_path}/topics").select("topic", "key", "value")
    assert rows(got) == rows(logs.fan_out(parse.parse_log(raw), S.BAD_TOPIC))


def test_a_replay_after_a_list_change_leaves_nothing_stale(spark, tmp_path):
    rows_ = lambda *topics: spark.createDataFrame([(t, "v") for t in topics], "topic string, value string")
    target = {"path": f"{tmp_path}/topics"}
    write_topic(rows_("A", "B"), target, 7)
    write_topic(rows_("C"), target, 8)
    write_topic(rows_("A"), target, 7)
    assert rows(spark.read.parquet(target["path"]), "topic") == [("A",), ("C",)]


def test_unusable_messages_are_kept_apart(spark, sf, tmp_path, dims_path):
    pages = X.with_bad(page_messages(spark, sf), "mid")
    write_slices(pages, f"{tmp_path}/pages", 2)
    run_dau(spark, tmp_path, dims_path)
    stored = stored_dau(spark, tmp_path)
    assert stored.filter("mid IS NULL OR dt IS NULL").count() == 0
    good = dau.daily_first_visit(dau.first_pages(parse.parse_page_log(pages)))
    assert rows(stored, "dt", "mid") == rows(good, "dt", "mid")
    bad = spark.read.parquet(f"{tmp_path}/dau_bad")
    assert rows(bad, "value") == rows(parse.quarantine_page(pages), "value")
    info, detail = (X.with_bad(m, "id") for m in order_messages(spark, sf))
    few = "timestamp < '1995-04-01'"
    info, detail = info.filter(few), detail.filter(few)
    tmp = f"{tmp_path}/orders"
    write_slices(info, f"{tmp}/info", 2)
    write_slices(detail, f"{tmp}/detail", 2)
    order_job(spark, tmp, dims_path)
    same_documents(stored_orders(spark, tmp), info, detail, dims_path)
    wanted = parse.quarantine_order(info, "info").unionByName(parse.quarantine_order(detail, "detail"))
    assert rows(spark.read.parquet(f"{tmp}/wide_bad"), "value") == rows(wanted, "value")


def test_folded_stores_read_the_same(spark, sf, tmp_path):
    path, keys = f"{tmp_path}/docs", ["dt", "mid"]
    docs = C.visits(spark, sf)
    for batch in range(5):
        write_docs(docs.withColumn("page_id", F.lit(f"p{batch}")), path, keys, ["ts"], batch)
    before = rows(read_docs(spark, path, docs.schema, keys))
    assert compact_docs(spark, path, docs.schema, keys) == 4
    newest = snapshot(spark, path)
    text = read_docs(spark, path, docs.schema, keys)._jdf.queryExecution().executedPlan().toString()
    assert "batch_id#" in text and "> 4" in text  # folded batches are pruned by their folder
    assert spark.read.parquet(newest.path).count() == len(before)
    assert rows(read_docs(spark, path, docs.schema, keys)) == before
    write_docs(docs.limit(3).withColumn("page_id", F.lit("new")), path, keys, ["ts"], 5)
    compact_docs(spark, path, docs.schema, keys, delete=True)
    after = read_docs(spark, path, docs.schema, keys)
    assert after.count() == len(before) and after.filter("page_id = 'new'").count() == 3
    assert compact_docs(spark, f"{tmp_path}/none", docs.schema, keys) == -1
    dims = f"{tmp_path}/dims"
    routed = C._dim_rows(spark, sf)
    for batch in range(3):
        write_dims(routed, dims, batch)
    wanted = rows(read_dims(spark, dims), "dim_key", "op", "data")
    compact_dims(spark, dims, delete=True)
    assert rows(read_dims(spark, dims), "dim_key", "op", "data") == wanted


def test_a_lookup_reads_the_buckets_of_its_keys(spark, sf, tmp_path, dims_path):
    path = f"{tmp_path}/dims"
    write_dims(C._dim_rows(spark, sf), path, 0)
    assert compact_dims(spark, path) == 0
    assert snapshot(spark, path).buckets == 16
    every = read_users(spark, path)
    assert rows(every) == rows(read_users(spark, dims_path)) and every.count() > 100
    few = every.select("id").orderBy("id").limit(5)
    got = read_store(spark, path, DIM_STORE, few).filter("table = 'user_info'")
    read = got.select(F.input_file_name().alias("f")).distinct().count()
    assert 0 < read <= 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    asked = read_users(spark, path, ids=few)
    assert rows(asked) == rows(every.join(few, "id", "left_semi"))
    # Rows that came after the fold count too, whatever their bucket.
    write_dims(C._dim_rows(spark, sf).filter("id = '1'").withColumns({"op": F.lit("D"), "timestamp": F.lit("2030-01-01").cast("timestamp")}), path, 1)
    assert read_users(spark, path, "remove", ids=every.select("id").filter("id = '1'")).count() == 0


def test_a_join_has_one_store_for_a_partition(spark, sf):
    ck = C._joining(spark, sf)
    assert not os.path.exists(f"{ck}/state/0/0/left-keyToNumValues")
    assert join_state(spark, ck, "detail").count() == C.detail(spark, sf).count()


def test_every_slice_has_as_many_files(spark, tmp_path):
    # Twenty messages, all in one task, are a slice.
    msgs = spark.range(0, 4020, 1, 24).withColumn("slice", F.expr("if(id < 20, 3, id % 3)"))
    files = C._write_slices(msgs, f"{tmp_path}/sent")
    assert files == 18
    for nth in range(4):
        assert len(spark.read.parquet(f"{tmp_path}/sent/slice={nth}").inputFiles()) == files
    assert rows(spark.read.parquet(f"{tmp_path}/sent"), "id", "slice") == rows(msgs, "id", "slice")
