"""Input relations of the warehouse, derived by Spark from the base tables.

`FIXTURES.md` part B gives each rule. Every relation covers the whole base table, but for
the headers and users of lookups and joins: `misses` leaves some out, so that there are
rows without a partner. Base timestamps have no zone: the session's must be UTC.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivermill import schemas as S

AS_OF = "2024-02-01"


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by key, as a topic's partitions would give them."""
    return df.repartition(key)


def _text(sql: str):
    return F.expr(sql).cast("string")


def _envelope(df: DataFrame, topic: str, partition: str, offset: str, time: str) -> DataFrame:
    return df.select(
        F.lit(None).cast("string").alias("key"),
        "value",
        F.lit(topic).alias("topic"),
        F.expr(partition).cast("int").alias("partition"),
        F.expr(offset).cast("bigint").alias("offset"),
        F.expr(time).cast("timestamp").alias("timestamp"),
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(base(spark, sf_dir, "events"), "event_id").withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("int"),
            "ms": F.unix_millis(F.col("ts").cast("timestamp")),
        }
    )
    struct = lambda **cells: F.struct(*[c.alias(n) for n, c in cells.items()])
    kind = F.col("event_type")
    common = struct(
        ar=_text("user_id % 25"),
        uid=_text("user_id"),
        os=F.expr("concat('os_', user_id % 2)"),
        ch=F.expr("concat('ch_', event_id % 4)"),
        is_new=_text("event_id % 2"),
        md=F.expr("concat('md_', user_id % 7)"),
        mid=F.expr("concat('mid_', user_id)"),
        vc=F.expr("concat('v', event_id % 3)"),
        ba=F.expr("concat('ba_', user_id % 5)"),
    )
    page = struct(
        page_id=F.expr("concat('page_', k % 10)"),
        item=_text("k"),
        item_type=F.lit("sku"),
        during_time=F.expr("k * 100"),
        last_page_id=F.expr("if(k % 3 = 0, null, concat('page_', (k + 1) % 10))"),
        soucre_type=F.expr("concat('src_', k % 3)"),
    )
    start = struct(
        entry=F.lit("icon"),
        loading_time=F.expr("k * 10"),
        open_ad_id=F.expr("concat('ad_', k % 5)"),
        open_ad_ms=F.expr("k * 5"),
        open_ad_skip_ms=F.lit(0),
    )
    displays = F.expr(
        """transform(slice(array(0, 1, 2), 1, k % 4), i -> named_struct(
             'display_type', 'query', 'item', cast(k + i as string), 'item_type', 'sku',
             'pos_id', cast(i % 3 as string), 'order', cast(i + 1 as string)))"""
    )
    actions = F.expr(
        """transform(slice(array(0, 1), 1, k % 3), i -> named_struct(
             'action_id', concat('act_', i), 'item', cast(k as string),
             'item_type', 'sku', 'ts', ms + i))"""
    )
    record = struct(
        common=F.when(F.expr("event_id % 97 <> 1"), common),
        err=F.when(kind == "error", F.expr("named_struct('error_code', k, 'msg', 'e')")),
        page=F.when(kind.isin("view", "click", "purchase", "error"), page),
        start=F.when(
            (kind == "signup") | ((kind == "purchase") & F.expr("k % 10 = 0")), start
        ),
        displays=F.when((kind != "signup") & F.expr("k % 4 > 0 OR k % 8 = 0"), displays),
        actions=F.when(kind.isin("click", "purchase") & F.expr("k % 3 > 0"), actions),
        ts=F.col("ms"),
    )
    value = F.when(F.expr("event_id % 97 = 0"), "not json {").otherwise(F.to_json(record))
    return _envelope(
        events.withColumn("value", value), S.LOG_TOPIC, "event_id % 3", "event_id", "ts"
    )


def page_log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page topic as the log split writes it."""
    from rivermill.functions.parse import parse_log
    from rivermill.operators.logs import route_page

    pages = route_page(parse_log(raw_log(spark, sf_dir)))
    return pages.select(F.to_json(F.struct(*pages.columns)).alias("value"))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.expr("if(c_custkey % 2 = 0, 'M', 'F')").alias("gender"),
        F.expr(
            "cast(date_add(DATE'1950-01-01', cast(c_custkey * 7 % 20000 as int)) as string)"
        ).alias("birthday"),
    )


def user_info(spark: SparkSession, sf_dir: str, misses: bool = True) -> DataFrame:
    """Users as a dimension; for lookups every eleventh is left out to give misses."""
    rows = _users(spark, sf_dir)
    rows = rows.filter("id % 11 <> 3") if misses else rows
    return rows.withColumn("id", F.col("id").cast("string"))


def base_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir, "nation").select(
        _text("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.expr("concat('C-', n_nationkey)").alias("iso_code"),
        F.expr("concat('CN-', n_nationkey)").alias("iso_3166_2"),
        _text("n_nationkey * 100").alias("area_code"),
    )


_HEADER_TIME = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int), 0, 0)"
_TEXT_TIME = "yyyy-MM-dd HH:mm:ss"


def order_info(spark: SparkSession, sf_dir: str, misses: bool = True) -> DataFrame:
    """Order headers as database rows, plus `arrival`; for joins one in twenty is missing."""
    orders = spread(base(spark, sf_dir, "orders"), "o_orderkey")
    orders = orders.filter("o_orderkey % 20 <> 7") if misses else orders
    arrival = F.expr(_HEADER_TIME).cast("timestamp")
    amount = lambda name: F.lit(0.0).alias(name)
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.expr("o_custkey % 25").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        amount("activity_reduce_amount"),
        amount("coupon_reduce_amount"),
        F.col("o_totalprice").alias("original_total_amount"),
        amount("feight_fee"),
        amount("feight_fee_reduce"),
        F.date_format(arrival, _TEXT_TIME).alias("create_time"),
        arrival.alias("arrival"),
    )


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as database rows, plus `arrival` and the lines' own tie-break."""
    orders = base(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = spread(base(spark, sf_dir, "lineitem"), "l_orderkey").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    header = F.expr(_HEADER_TIME)
    late = F.expr("make_dt_interval(0, cast(l_partkey % 73 - 36 as int), 0, 0)")
    minutes = F.expr("make_dt_interval(0, 0, l_linenumber, 0)")
    return lines.select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.expr("concat('sku_', l_partkey)").alias("sku_name"),
        F.date_format((header + minutes).cast("timestamp"), _TEXT_TIME).alias("create_time"),
        F.col("l_extendedprice").alias("split_total_amount"),
        F.lit(0.0).alias("split_activity_amount"),
        F.lit(0.0).alias("split_coupon_amount"),
        (header + late).cast("timestamp").alias("arrival"),
        F.col("l_shipdate").cast("timestamp").alias("shipped"),
        F.col("l_suppkey").alias("supplier"),
    )


DETAIL_EXTRA = ["shipped", "supplier"]
DETAIL_ORDER = ["arrival", "shipped", "sku_id", "supplier", "order_price"]


def messages_of(rows: DataFrame, topic: str) -> DataFrame:
    """Order rows as messages whose timestamp is the row's arrival."""
    cells = [c for c in rows.columns if c not in ("arrival", *DETAIL_EXTRA)]
    timed = rows.withColumn("value", F.to_json(F.struct(*cells)))
    return _envelope(timed, topic, "id % 3", "id", "arrival")


def order_info_messages(spark: SparkSession, sf_dir: str, misses: bool = True) -> DataFrame:
    return messages_of(order_info(spark, sf_dir, misses), S.ORDER_INFO_TOPIC)


def with_bad(msgs: DataFrame, key: str) -> DataFrame:
    """The messages, every 97th of them cut short and every 89th without its key."""
    without = F.regexp_replace("value", f'"{key}":', f'"no_{key}":')
    cut = F.when(F.expr("offset % 97 = 0"), F.expr("left(value, 9)"))
    return msgs.withColumn("value", cut.when(F.expr("offset % 89 = 0"), without).otherwise(F.col("value")))


def order_detail_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(order_detail(spark, sf_dir), S.ORDER_DETAIL_TOPIC)


_CHANGE_TYPE = """case id % 10 when 0 then 'delete' when 1 then 'update'
  when 2 then 'bootstrap-insert' when 3 then 'bootstrap-start' else 'insert' end"""
_DAY = 86400
SECOND_VERSION = 10_000_000


def _changes(rows: DataFrame, table: str, shift: int = 0, later: int = 0) -> DataFrame:
    cells = [c for c in rows.columns if c not in ("arrival", *DETAIL_EXTRA)]
    record = F.struct(
        F.lit(table).alias("table"),
        F.expr(_CHANGE_TYPE).alias("type"),
        F.struct(*cells).alias("data"),
    )
    timed = rows.withColumn("value", F.to_json(record)).withColumn(
        "id", F.col("id").cast("bigint")
    )
    return _envelope(
        timed,
        S.CHANGE_TOPIC,
        "id % 3",
        f"id + {shift}",
        f"timestamp_seconds(unix_seconds(TIMESTAMP'2024-01-01 00:00:00') + id + {later})",
    )


def dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the dimension tables, with a second version of every fifth user."""
    users = _users(spark, sf_dir)
    again = users.filter("id % 5 = 0").withColumn(
        "gender", F.expr("if(gender = 'M', 'F', 'M')")
    )
    return (
        _changes(users, S.USER_TABLE)
        .unionByName(_changes(base_province(spark, sf_dir), S.PROVINCE_TABLE))
        .unionByName(_changes(again, S.USER_TABLE, SECOND_VERSION, _DAY))
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = base(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")
    )
    return (
        _changes(order_info(spark, sf_dir, misses=False), "order_info")
        .unionByName(_changes(order_detail(spark, sf_dir), "order_detail"))
        .unionByName(_changes(region, "region"))
        .unionByName(dim_changes(spark, sf_dir))
    )


# Which tables are facts and which are dimensions. One is both.
TABLE_LISTS = [
    ("fact", "order_info"),
    ("fact", "order_detail"),
    ("fact", "base_province"),
    ("dim", "user_info"),
    ("dim", "base_province"),
]


def table_list(spark: SparkSession, kind: str) -> DataFrame:
    rows = ", ".join(f"('{t}')" for k, t in TABLE_LISTS if k == kind)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(table)")


def lists(spark: SparkSession) -> DataFrame:
    """Both table lists as the config table holds them."""
    return spark.createDataFrame(TABLE_LISTS, S.TABLE_LIST)
