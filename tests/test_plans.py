"""The plans Spark makes of the operators, and hot keys."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

import catalog as C
import fixtures as X
from rivermill import schemas as S
from rivermill.functions import parse
from rivermill.functions.keyed import last_by_key
from rivermill.operators import dau, dims, logs, orders
from rivermill.sinks.docs import write_docs
from rivermill.sources.tables import read_docs


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set session values for one test."""
    before = {}

    def put(**values):
        for name, value in values.items():
            key = f"spark.sql.{name.replace('__', '.')}"
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def small_skew(conf):
    """Adaptive execution treats a partition of some kilobytes as skewed, nothing is broadcast."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
    )


@pytest.mark.parametrize("name", [n for n in C.queries() if not n.startswith("stream_")])
def test_no_python_and_no_all_pairs(spark, sf, name):
    text = plan(C.queries()[name](spark, sf))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert node not in text


def test_json_is_parsed_once(spark, sf, tmp_path):
    X.raw_log(spark, sf).write.parquet(f"{tmp_path}/log")
    log = parse.parse_log(spark.read.parquet(f"{tmp_path}/log"))
    for df in (logs.route_page(log), logs.route_start(log), logs.fan_out(log)):
        nodes = physical(df).splitlines()
        assert sum("from_json" in n for n in nodes) == 1
        assert "Exchange" not in physical(df)
        assert "ReadSchema: struct<value:string>" in physical(df)


def test_one_row_per_key_is_picked_before_the_shuffle(spark, sf, tmp_path):
    visits = C.page_log(spark, sf)
    visits.write.parquet(f"{tmp_path}/pages")
    text = physical(dau.daily_first_visit(spark.read.parquet(f"{tmp_path}/pages")))
    assert text.index("functions=[min(") < text.index("Exchange") < text.index("partial_min(")
    counts = physical(dau.stage_counts(spark.read.parquet(f"{tmp_path}/pages")))
    read = re.search(r"ReadSchema: struct<([^>]*)>", counts).group(1)
    assert sorted(f.split(":")[0] for f in read.split(",")) == ["last_page_id", "mid", "ts"]


def hot_lines(spark, n=30_000):
    """Lines of which a third belong to order 1, in several files' worth of partitions."""
    ids = spark.range(0, n, 1, 8)
    return ids.select(
        F.col("id"),
        F.expr("if(id % 3 = 0, 1, id)").alias("order_id"),
        F.lit(5).cast("bigint").alias("sku_id"),
        F.concat(F.lit("sku_"), F.sha2(F.col("id").cast("string"), 256)).alias("sku_name"),
        F.lit("2024-01-01 10:00:00").cast("timestamp").alias("arrival"),
    )


def headers_of(lines):
    return lines.select(F.col("order_id").alias("id"), "arrival").distinct()


def final_plan(df) -> tuple[list, str]:
    collected = rows(df)
    return collected, physical(df)


def test_hot_order_is_split(spark, small_skew):
    lines = hot_lines(spark)
    joined = orders.order_wide_join(headers_of(lines), lines).select(
        F.col("info.id").alias("header"), F.col("detail.id").alias("line"), "detail.sku_name"
    )
    got, text = final_plan(joined)
    assert len(got) == lines.count()
    assert "skew=true" in text


def test_hot_order_is_split_in_the_full_join(spark, small_skew):
    lines = hot_lines(spark)
    headers = headers_of(lines).filter("id % 5 <> 2").unionByName(
        spark.range(100_000, 100_050).select("id", F.lit(None).cast("timestamp").alias("arrival"))
    )
    joined = orders.order_batch_join(headers, lines)
    got, text = final_plan(joined.select("order_id", "info.id", "detail.id", "detail.sku_name"))
    full = headers.select(F.col("id").alias("header")).join(
        lines, F.col("header") == F.col("order_id"), "full_outer"
    )
    assert len(got) == full.count()
    assert "skew=true" in text


def test_pending_rows_are_merged(spark):
    lines = hot_lines(spark, 100)
    headers = headers_of(lines).filter("id % 2 = 1")
    pending = orders.pending_details(headers, lines)
    for df in (pending, orders.distinct_pending(pending), orders.pending_orders(headers, lines)):
        assert "Broadcast" not in physical(df)
    assert rows(pending, "id") == rows(lines.filter("order_id % 2 = 0"), "id")


@pytest.mark.parametrize("salt", [1, 4])
def test_headers_of_the_wide_join_are_merged(spark, salt):
    lines = hot_lines(spark, 100)
    joined = orders.order_wide_join(headers_of(lines), lines, salt=salt)
    assert "Broadcast" not in physical(joined)
    assert joined.count() == 100


def test_hot_and_missing_users_are_split(spark, small_skew):
    lines = hot_lines(spark)
    users = spark.range(0, 30_000, 1, 8).select(
        F.col("id").cast("string"), F.lit("F").alias("gender"), F.lit("2000-01-01").alias("birthday")
    )
    for hot in ("1", "null"):
        df = lines.withColumn("user_id", F.expr(f"if(id % 3 = 0, {hot}, id)").cast("string"))
        got, text = final_plan(
            dims.with_user_dim(df, users).select("id", "sku_name", "user_gender")
        )
        assert len(got) == lines.count()
        assert "skew=true" in text


@pytest.mark.parametrize("salt", [1, 7])
def test_salted_joins_lose_and_repeat_nothing(spark, salt):
    lines = hot_lines(spark, 3000)
    headers = headers_of(lines).filter("id % 2 = 1")
    got = orders.order_wide_join(headers, lines, salt=salt).select("detail.id", "info.id")
    plain = lines.join(headers.select(F.col("id").alias("h")), F.expr("order_id = h")).select(
        "id", "h"
    )
    assert rows(got) == rows(plain)


def test_hot_document_key(spark):
    docs = hot_lines(spark, 9000).withColumn("arrival", F.col("arrival") + F.expr(
        "make_dt_interval(0, 0, cast(id as int), 0)"
    ))
    last = last_by_key(docs, ["order_id"], ["arrival"])
    brute = docs.groupBy("order_id").agg(F.max("id").alias("id"))
    assert rows(last, "order_id", "id") == rows(brute)


def test_a_day_is_read_alone(spark, sf, tmp_path):
    visits = C.visits(spark, sf)
    path = f"{tmp_path}/docs"
    write_docs(visits, path, ["dt", "mid"], ["ts"], 0)
    one = read_docs(spark, path, visits.schema, ["dt", "mid"], "2024-01-05", ["page_id"])
    text = physical(one)
    assert re.search(r"PartitionFilters: \[isnotnull\(dt#\d+\), \(dt#\d+ = 2024-01-05\)\]", text)
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(f.split(":")[0] for f in read.split(",")) == ["mid", "page_id"]


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, sf, conf):
    assert "BroadcastHashJoin" in physical(C.q_dau_wide(spark, sf))
    conf(autoBroadcastJoinThreshold="-1")
    text = physical(C.q_dau_wide(spark, sf))
    assert "Broadcast" not in text
    assert "SortMergeJoin" in text


def test_wide_rows_have_their_types(spark, sf):
    assert C.q_order_wide(spark, sf).schema.simpleString() == S.ORDER_WIDE.simpleString()
    assert C.q_dau_wide(spark, sf).schema.simpleString() == S.DAU_INFO.simpleString()


def test_a_hot_province_is_salted(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="32")
    provinces = spark.range(50).select(
        F.col("id").cast("string"), *[F.lit("x").alias(c) for c in dims.PROVINCE_NAMES["dau"]]
    )
    rows_ = hot_lines(spark).withColumn("province_id", F.lit("7"))
    for salt, most in ((1, 30_000), (8, 12_000)):
        joined = dims.with_province_dim(rows_, provinces, salt=salt)
        text = physical(joined)
        assert ("row_salt" in text) == (salt > 1)
        sizes = dau.partition_counts(joined).agg(F.max("rows")).head()[0]
        assert sizes <= most
