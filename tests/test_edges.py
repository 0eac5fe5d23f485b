"""Hand-made rows for the corners of each rule."""

import json
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rivermill import schemas as S
from rivermill.functions import parse
from rivermill.functions.scalars import age_years, create_parts
from rivermill.operators import changes, dau, dims, logs, orders
from rivermill.operators.records import copy_matching, to_message

COMMON = {"ar": "1", "uid": "2", "mid": "m"}
PAGE = {"page_id": "p"}


def messages(spark, *values):
    texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, offset long")


def routed(spark, *values):
    out = logs.fan_out(parse.parse_log(messages(spark, *values)))
    return sorted(r.topic for r in out.collect())


def test_numbers_as_text_and_missing(spark):
    msgs = messages(
        spark,
        {"common": COMMON, "ts": "7", "page": {**PAGE, "during_time": "12"}},
        {"common": COMMON, "ts": 8, "page": PAGE},
        {"common": COMMON, "ts": 9, "page": {**PAGE, "during_time": "soon"}},
    )
    got = logs.route_page(parse.parse_log(msgs))
    assert rows(got, "ts", "during_time") == [(7, 12), (8, None), (9, None)]


def test_error_object_decides_routing(spark):
    page = {"common": COMMON, "page": PAGE, "ts": 1}
    assert routed(spark, {**page, "err": {}}) == [S.ERROR_TOPIC]
    assert routed(spark, {**page, "err": None}) == [S.PAGE_TOPIC]
    assert routed(spark, {"err": {"error_code": 3}}) == [S.ERROR_TOPIC]


def test_page_and_start_are_independent(spark):
    both = {"common": COMMON, "page": PAGE, "start": {"entry": "icon"}, "ts": 1}
    assert routed(spark, both) == [S.PAGE_TOPIC, S.START_TOPIC]
    assert routed(spark, {"common": COMMON, "ts": 1}) == []


def test_displays_and_actions_need_a_page(spark):
    lists = {"displays": [{"item": "1"}, {"item": "2"}], "actions": [{"ts": 5}]}
    assert routed(spark, {"common": COMMON, **lists, "ts": 1}) == []
    assert routed(spark, {"common": COMMON, "page": PAGE, **lists, "ts": 1}) == [
        S.ACTION_TOPIC,
        S.DISPLAY_TOPIC,
        S.DISPLAY_TOPIC,
        S.PAGE_TOPIC,
    ]
    empty = {"displays": [], "actions": None}
    assert routed(spark, {"common": COMMON, "page": PAGE, **empty, "ts": 1}) == [S.PAGE_TOPIC]


def test_error_text_is_unchanged(spark):
    text = '{ "ts": 1,  "err": {"b":1,"a":2}, "extra": [1, 2] }'
    log = parse.parse_log(messages(spark, text))
    assert rows(logs.route_error(log)) == [(text,)]
    assert rows(logs.fan_out(log), "value") == [(text,)]


def test_source_type_spellings(spark):
    msgs = messages(
        spark,
        {"common": COMMON, "page": {"soucre_type": "a"}, "ts": 1},
        {"common": COMMON, "page": {"source_type": "b"}, "ts": 2},
    )
    got = logs.route_page(parse.parse_log(msgs))
    assert rows(got, "sourceType") == [("a",), ("b",)]


def test_quarantine_takes_what_no_route_takes(spark):
    bad = [None, "", "not json {", "[1]", '{"common":{"ar":"1"', '{"page":{}}']
    good = ['{"common":{"ar":"1"}}', '{"err":{}}']
    msgs = messages(spark, *bad, *good)
    got = parse.quarantine(msgs)
    assert rows(got, "offset") == [(i,) for i in range(len(bad))]
    out = logs.fan_out(parse.parse_log(msgs), "BAD").filter("topic = 'BAD'")
    assert out.count() == len(bad)
    assert sum(r.value is None for r in out.collect()) == 1


def test_fan_out_equals_separate_routes(spark, sf):
    import fixtures as X

    log = parse.parse_log(X.raw_log(spark, sf))
    apart = (
        log.filter("err IS NOT NULL")
        .select(F.lit(S.ERROR_TOPIC).alias("topic"), F.lit(None).alias("key"), "value")
        .unionByName(to_message(logs.route_page(log), S.PAGE_TOPIC))
        .unionByName(to_message(logs.explode_displays(log), S.DISPLAY_TOPIC))
        .unionByName(to_message(logs.explode_actions(log), S.ACTION_TOPIC))
        .unionByName(to_message(logs.route_start(log), S.START_TOPIC))
    )
    assert rows(logs.fan_out(log)) == rows(apart)


def test_empty_last_page_is_not_a_first_page(spark):
    msgs = messages(spark, {"mid": "a", "ts": 1, "last_page_id": ""}, {"mid": "b", "ts": 2})
    got = dau.first_pages(parse.parse_page_log(msgs))
    assert rows(got, "mid") == [("b",)]


def test_same_device_on_both_sides_of_midnight(spark):
    midnight = 1_704_153_600_000  # 2024-01-02T00:00:00Z
    msgs = messages(
        spark,
        {"mid": "a", "ts": midnight - 1, "page_id": "x"},
        {"mid": "a", "ts": midnight, "page_id": "y"},
        {"mid": "a", "ts": midnight + 5, "page_id": "z"},
        {"ts": midnight + 6, "page_id": "no device"},
        {"ts": midnight + 7, "page_id": "no device either"},
    )
    got = dau.daily_first_visit(parse.parse_page_log(msgs))
    assert rows(got, "dt", "page_id") == [("2024-01-01", "x"), ("2024-01-02", "y")]
    # Pages without a device are no visit of anyone: they are set apart, unchanged.
    apart = parse.quarantine_page(msgs)
    assert rows(apart) == rows(msgs.filter("value LIKE '%no device%'"))


def test_rebuild_seen_also_matches_missing_device(spark):
    visits = spark.createDataFrame([("d", None), ("d", "a"), ("e", "a")], "dt string, mid string")
    sink = spark.createDataFrame([("d", None), ("e", "a")], "dt string, mid string")
    assert rows(dau.rebuild_seen(visits, sink)) == [("d", "a")]


def period_years(born: date, now: date) -> int:
    """java.time.Period.between(born, now).getYears() as its documentation states it."""
    months = (now.year - born.year) * 12 + now.month - born.month
    if months > 0 and now.day < born.day:
        months -= 1
    elif months < 0 and now.day > born.day:
        months += 1
    return int(months / 12)


@pytest.mark.parametrize(
    "born, now, years",
    [
        ("2000-02-29", "2001-02-28", 0),
        ("2000-02-29", "2001-03-01", 1),
        ("2000-02-29", "2004-02-29", 4),
        ("2000-06-01", "1999-12-01", 0),
        ("2030-06-15", "2022-06-20", -7),
        ("2030-06-15", "2022-06-15", -8),
        ("1990-01-01", "1990-01-01", 0),
        ("not a date", "2020-01-01", None),
    ],
)
def test_age_corners(spark, born, now, years):
    df = spark.createDataFrame([(born, now)], "b string, n string")
    assert df.select(age_years("b", F.col("n").cast("date"))).head()[0] == years


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.tuples(st.dates(date(1900, 1, 1), date(2100, 1, 1)),
                          st.dates(date(1900, 1, 1), date(2100, 1, 1))), min_size=40))
def test_age_property(spark, pairs):
    df = spark.createDataFrame(pairs, "b date, n date")
    got = df.select("b", "n", age_years("b", F.col("n"))).collect()
    assert [r[2] for r in got] == [period_years(r[0], r[1]) for r in got]


def test_create_parts(spark):
    df = spark.createDataFrame([("2024-03-04 05:06:07",), (None,)], "create_time string")
    assert rows(create_parts(df)) == [
        ("2024-03-04 05:06:07", "2024-03-04", "05"),
        (None, None, None),
    ]


def change(spark, *records):
    texts = [json.dumps(r) for r in records]
    return spark.createDataFrame(
        [(t, datetime(2024, 1, 1) + timedelta(seconds=i), 0, i) for i, t in enumerate(texts)],
        "value string, timestamp timestamp, partition int, offset long",
    )


def names(spark, *tables):
    return spark.createDataFrame([(t,) for t in tables], "table string")


def test_table_in_both_lists_goes_both_ways(spark):
    ops = changes.map_op(
        parse.parse_change(
            change(
                spark,
                {"table": "t", "type": "insert", "data": {"id": 1, "deep": {"x": [1]}}},
                {"table": "t", "type": "bootstrap-start", "data": {"id": 2}},
                {"table": "u", "type": "insert", "data": {"id": 3}},
            )
        )
    )
    facts = changes.route_facts(ops, names(spark, "t"))
    assert rows(facts, "topic", "value") == [("DWD_T_I", '{"id":1,"deep":{"x":[1]}}')]
    assert rows(changes.route_dims(ops, names(spark, "t")), "dim_key") == [("DIM:T:1",)]


def test_deletes(spark):
    ops = changes.map_op(
        parse.parse_change(
            change(
                spark,
                {"table": "t", "type": "insert", "data": {"id": 1, "v": 1}},
                {"table": "t", "type": "delete", "data": {"id": 1, "v": 2}},
                {"table": "t", "type": "update", "data": {"id": 2, "v": 3}},
            )
        )
    )
    routed_rows = changes.route_dims(ops, names(spark, "t"))
    kept = changes.upsert_dim(None, routed_rows)
    assert rows(kept, "id", "data") == [("1", '{"id":1,"v":2}'), ("2", '{"id":2,"v":3}')]
    assert rows(changes.upsert_dim(None, routed_rows, deletes="remove"), "id") == [("2",)]
    assert rows(changes.upsert_dim(None, routed_rows, table="other"), "id") == []
    assert rows(changes.upsert_dim(kept, routed_rows)) == rows(kept)
    with pytest.raises(ValueError):
        changes.upsert_dim(None, routed_rows, deletes="maybe")


def test_missing_dimension_rows(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "user_id string")
    users = spark.createDataFrame([("1", "F", "2000-01-01")], S.USER_INFO)
    when = F.lit("2024-01-01").cast("date")
    for salt in (1, 3):
        look = lambda how: dims.with_user_dim(df, users, as_of=when, on_missing=how, salt=salt)
        assert rows(look("null")) == [("1", "F", "24"), ("2", None, None), (None, None, None)]
        assert rows(look("drop")) == [("1", "F", "24")]
        with pytest.raises(PySparkException, match="no dimension row"):
            look("fail").collect()
    with pytest.raises(ValueError):
        dims.with_user_dim(df, users, on_missing="guess")


def test_copy_matching_needs_name_and_type(spark):
    src = spark.createDataFrame([("a", "b", 1)], "mid string, during_time string, ts long")
    got = copy_matching(src, S.DAU_INFO)
    assert got.schema.names == S.DAU_INFO.names
    assert rows(got, "mid", "during_time", "ts", "user_id") == [("a", 0, 1, None)]


def order_rows(spark, headers, lines):
    msg = lambda value, at: (json.dumps(value), at)
    frame = lambda items: spark.createDataFrame(items, "value string, timestamp timestamp")
    info = parse.parse_order_info(frame([msg(*h) for h in headers]))
    detail = parse.parse_order_detail(frame([msg(*l) for l in lines]))
    return info, detail


NOON = datetime(2024, 1, 1, 12)


def test_order_defaults_and_numeric_text(spark):
    info, detail = order_rows(
        spark,
        [({"id": "5", "user_id": 6}, NOON), ({"user_id": 7}, NOON)],
        [({"id": 1, "order_id": "5", "order_price": "2.5"}, NOON), ({"id": 2}, NOON)],
    )
    assert rows(info, "id", "user_id", "total_amount", "user_age") == [(5, 6, 0.0, 0)]
    # A line without an order is not a line of order 0.
    assert rows(detail, "id", "order_id", "order_price", "split_coupon_amount") == [
        (1, 5, 2.5, 0.0)
    ]


def test_retention_is_inclusive_both_ways(spark):
    day = timedelta(hours=24)
    second = timedelta(seconds=1)
    info, detail = order_rows(
        spark,
        [({"id": 1}, NOON)],
        [
            ({"id": 10, "order_id": 1}, NOON - day),
            ({"id": 11, "order_id": 1}, NOON + day),
            ({"id": 12, "order_id": 1}, NOON - day - second),
            ({"id": 13, "order_id": 1}, NOON + day + second),
        ],
    )
    for salt in (1, 5):
        joined = orders.order_wide_join(info, detail, salt=salt)
        assert rows(joined, "detail.id") == [(10,), (11,)]


def test_merged_create_time_is_the_lines(spark):
    info, detail = order_rows(
        spark,
        [
            ({"id": 1, "create_time": "2024-01-01 10:00:00", "total_amount": 9}, NOON),
            ({"id": 2, "create_time": "2024-01-02 11:00:00"}, NOON),
        ],
        [
            ({"id": 10, "order_id": 1, "create_time": "2024-01-03 12:00:00"}, NOON),
            ({"id": 11, "order_id": 1}, NOON),
            ({"id": 12, "order_id": 7}, NOON),
        ],
    )
    joined = orders.order_batch_join(create_parts(info), detail)
    merged = orders.merge_order_wide(joined)
    assert merged.schema.names == S.ORDER_WIDE.names
    assert rows(merged, "detail_id", "order_id", "create_time", "create_date", "total_amount") == [
        (0, 2, "2024-01-02 11:00:00", "2024-01-02", 0.0),
        (10, 1, "2024-01-03 12:00:00", "2024-01-01", 9.0),
        (11, 1, None, "2024-01-01", 9.0),
        (12, 7, None, None, 0.0),
    ]


def test_identical_pending_lines_collapse(spark):
    line = {"id": 1, "order_id": 3, "sku_id": 4}
    _, detail = order_rows(
        spark,
        [({"id": 9}, NOON)],
        [(line, NOON), (line, NOON + timedelta(hours=1)), ({**line, "sku_id": 5}, NOON)],
    )
    assert rows(orders.distinct_pending(detail), "id", "sku_id") == [(1, 4), (1, 5)]
