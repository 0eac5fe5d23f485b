"""The same results in DuckDB SQL, written from the base tables.

Nothing here parses the JSON that the Spark side builds and reads, so a parsing fault
shows as a difference.
"""

from fixtures import AS_OF, SECOND_VERSION, TABLE_LISTS

_EV = """ev AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         event_id % 97 AS bad
  FROM events)"""

_COMMON = """'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS user_id,
  CAST(user_id % 25 AS VARCHAR) AS province_id, 'ch_' || event_id % 4 AS channel,
  CAST(event_id % 2 AS VARCHAR) AS is_new, 'md_' || user_id % 7 AS model,
  'os_' || user_id % 2 AS operate_system, 'v' || event_id % 3 AS version_code,
  'ba_' || user_id % 5 AS brand"""

_LAST_PAGE = "CASE WHEN k % 3 <> 0 THEN 'page_' || (k + 1) % 10 END"
_PAGE = f"""'page_' || k % 10 AS page_id, {_LAST_PAGE} AS last_page_id,
  CAST(k AS VARCHAR) AS page_item, 'sku' AS page_item_type,
  k * 100 AS during_time, 'src_' || k % 3 AS "sourceType" """

_OK = "bad > 1"
_IS_PAGE = f"{_OK} AND event_type IN ('view', 'click', 'purchase')"
_IS_START = f"{_OK} AND (event_type = 'signup' OR event_type = 'purchase' AND k % 10 = 0)"
_IS_ERROR = "bad <> 0 AND event_type = 'error'"

_PAGES = f"""{_EV}, pages_ AS (
  SELECT {_COMMON}, {_PAGE}, ms AS ts FROM ev WHERE {_IS_PAGE})"""

_DT = "strftime(make_timestamp(ts * 1000), '%Y-%m-%d')"
_HR = "strftime(make_timestamp(ts * 1000), '%H')"
_FIRST = f"""{_PAGES}, visits AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, {_DT} AS dt,
           row_number() OVER (PARTITION BY {_DT}, mid ORDER BY ts) AS rn
    FROM pages_ WHERE last_page_id IS NULL)
  WHERE rn = 1)"""

# Independent of the month arithmetic; valid for birthdays in the past.
_BIRTHDAY = "DATE '1950-01-01' + CAST(c_custkey * 7 % 20000 AS INTEGER)"
_AGE = f"""CAST(year(DATE '{AS_OF}') - year({_BIRTHDAY})
  - CASE WHEN strftime(DATE '{AS_OF}', '%m%d') < strftime({_BIRTHDAY}, '%m%d')
         THEN 1 ELSE 0 END AS INTEGER)"""
_USERS = f"""users AS (
  SELECT c_custkey AS uid, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         {_AGE} AS age
  FROM customer WHERE c_custkey % 11 <> 3)"""

_DAU = f"""{_FIRST}, {_USERS}, dau AS (
  SELECT v.* EXCLUDE (last_page_id), u.gender AS user_gender,
         CAST(u.age AS VARCHAR) AS user_age, n.n_name AS province_name,
         'C-' || n.n_nationkey AS province_iso_code,
         'CN-' || n.n_nationkey AS province_3166_2,
         CAST(n.n_nationkey * 100 AS VARCHAR) AS province_area_code, {_HR} AS hr
  FROM visits v LEFT JOIN users u ON v.user_id = CAST(u.uid AS VARCHAR)
  LEFT JOIN nation n ON v.province_id = CAST(n.n_nationkey AS VARCHAR))"""

_ARRIVAL = "o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))"
_INFO = f"""info AS (
  SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status,
         o_custkey AS user_id, o_totalprice AS total_amount,
         CAST(0 AS DOUBLE) AS activity_reduce_amount,
         CAST(0 AS DOUBLE) AS coupon_reduce_amount,
         o_totalprice AS original_total_amount, CAST(0 AS DOUBLE) AS feight_fee,
         CAST(0 AS DOUBLE) AS feight_fee_reduce,
         strftime({_ARRIVAL}, '%Y-%m-%d %H:%M:%S') AS create_time, {_ARRIVAL} AS arrival
  FROM orders WHERE o_orderkey % 20 <> 7)"""
_ALL_INFO = _INFO.replace(" WHERE o_orderkey % 20 <> 7", "").replace("info AS", "all_info AS", 1)
_DETAIL = f"""detail AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS order_id,
         l_partkey AS sku_id, l_extendedprice AS order_price,
         CAST(l_quantity AS BIGINT) AS sku_num, 'sku_' || l_partkey AS sku_name,
         strftime({_ARRIVAL} + to_minutes(l_linenumber), '%Y-%m-%d %H:%M:%S')
           AS create_time,
         {_ARRIVAL} + to_hours(CAST(l_partkey % 73 - 36 AS INTEGER)) AS arrival,
         l_shipdate AS shipped, l_suppkey AS supplier
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_ORDERS = f"{_INFO}, {_DETAIL}"
_DETAIL_COLUMNS = """id, order_id, sku_id, order_price, sku_num, sku_name, create_time,
  order_price AS split_total_amount, CAST(0 AS DOUBLE) AS split_activity_amount,
  CAST(0 AS DOUBLE) AS split_coupon_amount"""
_LINE = "id, order_id, sku_id, order_price, sku_num, sku_name, create_time"
_WITHIN = """d.arrival BETWEEN i.arrival - INTERVAL 24 HOUR
  AND i.arrival + INTERVAL 24 HOUR"""

_TYPE = """CASE id % 10 WHEN 0 THEN 'delete' WHEN 1 THEN 'update'
  WHEN 2 THEN 'bootstrap-insert' WHEN 3 THEN 'bootstrap-start' ELSE 'insert' END"""
_OP = """CASE id % 10 WHEN 0 THEN 'D' WHEN 1 THEN 'U' WHEN 2 THEN 'BI' ELSE 'I' END"""
_DIM_CHANGES = f"""dim_changes AS (
  SELECT 'user_info' AS tbl, c_custkey AS id, c_custkey AS off,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS field FROM customer
  UNION ALL
  SELECT 'user_info', c_custkey, c_custkey + {SECOND_VERSION},
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END
  FROM customer WHERE c_custkey % 5 = 0
  UNION ALL
  SELECT 'base_province', n_nationkey, n_nationkey, n_name FROM nation)"""
_LATEST_USERS = f"""{_DIM_CHANGES}, latest AS (
  SELECT id, arg_max(field, off) AS gender FROM dim_changes
  WHERE tbl = 'user_info' AND id % 10 <> 3 GROUP BY id),
  ages AS (SELECT c_custkey AS id, {_AGE} AS age FROM customer)"""
_CHANGES = f"""{_ALL_INFO}, {_DETAIL}, {_DIM_CHANGES}, changes AS (
  SELECT 'order_info' AS tbl, id, id AS off, order_status AS field FROM all_info
  UNION ALL SELECT 'order_detail', id, id, sku_name FROM detail
  UNION ALL SELECT 'region', r_regionkey, r_regionkey, r_name FROM region
  UNION ALL SELECT * FROM dim_changes)"""
_DIM_KEY = "'DIM:' || upper(tbl) || ':' || id"


def _listed(kind: str) -> str:
    return ", ".join(f"'{t}'" for k, t in TABLE_LISTS if k == kind)


def _latest_dims(extra: str) -> str:
    return f"""WITH {_DIM_CHANGES}
      SELECT {_DIM_KEY} AS dim_key, {_OP} AS op, off AS "offset", field FROM (
        SELECT *, row_number() OVER (PARTITION BY tbl, id ORDER BY off DESC) AS rn
        FROM dim_changes WHERE id % 10 <> 3) WHERE rn = 1 {extra}"""


def _wide(info: str = "i", detail: str = "d") -> str:
    """Line and header columns of the order wide table."""
    i, d = info, detail
    return f"""{d}.id AS detail_id, {d}.order_id, {d}.sku_id, {d}.order_price,
      {d}.sku_num, {d}.sku_name, {d}.order_price AS split_total_amount,
      CAST(0 AS DOUBLE) AS split_activity_amount,
      CAST(0 AS DOUBLE) AS split_coupon_amount, {i}.province_id, {i}.order_status,
      {i}.user_id, {i}.total_amount, {i}.activity_reduce_amount,
      {i}.coupon_reduce_amount, {i}.original_total_amount, {i}.feight_fee,
      {i}.feight_fee_reduce, CAST(NULL AS VARCHAR) AS expire_time,
      CAST(NULL AS VARCHAR) AS refundable_time, {d}.create_time,
      CAST(NULL AS VARCHAR) AS operate_time,
      strftime({i}.arrival, '%Y-%m-%d') AS create_date,
      strftime({i}.arrival, '%H') AS create_hour"""


_ORDER_DIMS = """n.n_name AS province_name,
  CAST(n.n_nationkey * 100 AS VARCHAR) AS province_area_code,
  'CN-' || n.n_nationkey AS province_3166_2_code,
  'C-' || n.n_nationkey AS province_iso_code, u.age AS user_age,
  u.gender AS user_gender"""
ORDER_WIDE = f"""WITH {_ORDERS}, {_USERS}
  SELECT {_wide()}, {_ORDER_DIMS}
  FROM detail d JOIN info i ON d.order_id = i.id AND {_WITHIN}
  LEFT JOIN users u ON i.user_id = u.uid
  LEFT JOIN nation n ON i.province_id = n.n_nationkey"""

_NO_DIMS = """CAST(NULL AS VARCHAR) AS province_name,
  CAST(NULL AS VARCHAR) AS province_area_code,
  CAST(NULL AS VARCHAR) AS province_3166_2_code,
  CAST(NULL AS VARCHAR) AS province_iso_code, CAST(0 AS INTEGER) AS user_age,
  CAST(NULL AS VARCHAR) AS user_gender"""
_MERGED = f"""WITH {_ORDERS}
  SELECT * EXCLUDE (header_id, header_time) REPLACE (
    coalesce(detail_id, 0) AS detail_id, coalesce(order_id, header_id) AS order_id,
    coalesce(sku_id, 0) AS sku_id, coalesce(order_price, 0) AS order_price,
    coalesce(sku_num, 0) AS sku_num,
    coalesce(split_total_amount, 0) AS split_total_amount,
    coalesce(province_id, 0) AS province_id, coalesce(user_id, 0) AS user_id,
    coalesce(total_amount, 0) AS total_amount,
    coalesce(activity_reduce_amount, 0) AS activity_reduce_amount,
    coalesce(coupon_reduce_amount, 0) AS coupon_reduce_amount,
    coalesce(original_total_amount, 0) AS original_total_amount,
    coalesce(feight_fee, 0) AS feight_fee,
    coalesce(feight_fee_reduce, 0) AS feight_fee_reduce,
    coalesce(create_time, header_time) AS create_time)
  FROM (
    SELECT {_wide()}, {_NO_DIMS}, i.id AS header_id, i.create_time AS header_time
    FROM detail d FULL JOIN info i ON d.order_id = i.id)"""

_DISPLAYS = f"""SELECT {_COMMON}, {_PAGE}, 'query' AS display_type,
    CAST(k + i AS VARCHAR) AS display_item, 'sku' AS display_item_type,
    CAST(i + 1 AS VARCHAR) AS display_order, CAST(i % 3 AS VARCHAR) AS display_pos_id,
    ms AS ts
  FROM (SELECT *, unnest(range(k % 4)) AS i FROM ev WHERE {_IS_PAGE})"""
_ACTIONS = f"""SELECT {_COMMON}, {_PAGE}, 'act_' || i AS action_id,
    CAST(k AS VARCHAR) AS action_item, 'sku' AS action_item_type, ms + i AS action_ts,
    ms AS ts
  FROM (SELECT *, unnest(range(k % 3)) AS i FROM ev
        WHERE {_OK} AND event_type IN ('click', 'purchase'))"""
_STARTS = f"""SELECT {_COMMON}, 'icon' AS entry, 'ad_' || k % 5 AS open_ad_id,
    k * 10 AS loading_time_ms, k * 5 AS open_ad_ms, CAST(0 AS BIGINT) AS open_ad_skip_ms,
    ms AS ts
  FROM ev WHERE {_IS_START}"""

FAN_OUT = f"""WITH {_EV}
  SELECT 'DWD_ERROR_LOG_TOPIC' AS topic,
         CASE WHEN bad <> 1 THEN 'mid_' || user_id END AS mid,
         CAST(NULL AS VARCHAR) AS page_id, CAST(NULL AS VARCHAR) AS item, ms AS ts
  FROM ev WHERE {_IS_ERROR}
  UNION ALL
  SELECT 'DWD_PAGE_LOG_TOPIC', 'mid_' || user_id, 'page_' || k % 10, NULL, ms
  FROM ev WHERE {_IS_PAGE}
  UNION ALL
  SELECT 'DWD_PAGE_DISPLAY_TOPIC', mid, page_id, display_item, ts FROM ({_DISPLAYS})
  UNION ALL
  SELECT 'DWD_PAGE_ACTION_TOPIC', mid, page_id, action_id, ts FROM ({_ACTIONS})
  UNION ALL
  SELECT 'DWD_START_LOG_TOPIC', mid, NULL, open_ad_id, ts FROM ({_STARTS})"""

ROUTE_FACTS = f"""WITH {_CHANGES}, facts AS (
    SELECT 'order_info' AS tbl, id, order_status AS field, total_amount AS amount, create_time,
           CAST(11 AS INTEGER) AS fields FROM all_info
    UNION ALL
    SELECT 'order_detail', id, sku_name, order_price, create_time, CAST(10 AS INTEGER) FROM detail
    UNION ALL
    SELECT 'base_province', n_nationkey, n_name, NULL, NULL, CAST(5 AS INTEGER) FROM nation)
  SELECT 'DWD_' || upper(tbl) || '_' || {_OP} AS topic, id, field, amount, create_time, fields
  FROM facts WHERE id % 10 <> 3 AND tbl IN ({_listed("fact")})"""

_JSON_TEXT = " || ".join(
    [
        "'{\"mid\":\"' || mid || '\"'",
        *[
            f"',\"{c}\":\"' || {c} || '\"'"
            for c in (
                "user_id province_id channel is_new model operate_system version_code "
                "brand page_id"
            ).split()
        ],
        "coalesce(',\"last_page_id\":\"' || last_page_id || '\"', '')",
        *[f"',\"{c}\":\"' || {c} || '\"'" for c in ("page_item", "page_item_type")],
        "',\"during_time\":' || during_time",
        "',\"sourceType\":\"' || \"sourceType\" || '\"'",
        "',\"ts\":' || ts || '}'",
    ]
)

_OFFSETS = """SELECT CAST(event_id % 3 AS INTEGER) AS part, min(event_id) AS lo,
  max(event_id) + 1 AS hi FROM events GROUP BY 1"""


STAGE_COUNTS = f"""WITH {_PAGES}
          SELECT count(*) AS pages,
                 count(*) FILTER (WHERE last_page_id IS NULL) AS first_pages,
                 count(DISTINCT CASE WHEN last_page_id IS NULL
                                     THEN {_DT} || ' ' || mid END) AS first_visits
          FROM pages_"""


def oracle_sql() -> dict[str, str]:
    found = _oracles()
    # Message order changes no result.
    found["stream_order_late"], found["stream_dau_late"] = found["stream_order_wide"], found["stream_dau"]
    for name in ("pending_details", "pending_orders"):
        found[f"stream_{name}"] = found[name]
    return found


def _oracles() -> dict[str, str]:
    return {
        "parse_log": f"""WITH {_EV}
          SELECT event_id AS "offset",
            CASE WHEN {_OK} THEN 'mid_' || user_id END AS mid,
            CASE WHEN {_OK} THEN 'v' || event_id % 3 END AS vc,
            CASE WHEN bad <> 0 THEN ms END AS ts,
            CASE WHEN {_IS_ERROR} THEN 1 ELSE 0 END AS has_err,
            CASE WHEN bad <> 0 AND event_type <> 'signup' THEN 'page_' || k % 10 END
              AS page_id,
            CASE WHEN bad <> 0 AND event_type <> 'signup' THEN {_LAST_PAGE} END
              AS last_page_id,
            CASE WHEN bad <> 0 AND (event_type = 'signup'
              OR event_type = 'purchase' AND k % 10 = 0) THEN 'ad_' || k % 5 END
              AS open_ad_id,
            CAST(CASE WHEN bad = 0 OR event_type = 'signup' OR k % 8 = 4 THEN -1
              ELSE k % 4 END AS INTEGER) AS n_displays,
            CAST(CASE WHEN bad <> 0 AND event_type IN ('click', 'purchase')
              AND k % 3 > 0 THEN k % 3 ELSE -1 END AS INTEGER) AS n_actions
          FROM ev""",
        "parse_change": f"""WITH {_CHANGES}
          SELECT off AS "offset", tbl AS "table", {_TYPE} AS type, id, field
          FROM changes""",
        "quarantine": f"""WITH {_EV}
          SELECT 'ODS_BASE_LOG' AS topic, CAST(event_id % 3 AS INTEGER) AS partition,
                 event_id AS "offset", ms AS sent_ms
          FROM ev WHERE bad = 0 OR bad = 1 AND event_type <> 'error'""",
        "route_error": f"""WITH {_EV}
          SELECT k AS error_code, CASE WHEN bad <> 1 THEN 'mid_' || user_id END AS mid,
                 'page_' || k % 10 AS page_id, ms AS ts
          FROM ev WHERE {_IS_ERROR}""",
        "route_page": f"WITH {_PAGES} SELECT * FROM pages_",
        "route_start": f"WITH {_EV} {_STARTS}",
        "explode_displays": f"WITH {_EV} {_DISPLAYS}",
        "explode_actions": f"WITH {_EV} {_ACTIONS}",
        "fan_out": FAN_OUT,
        "to_message": f"""WITH {_PAGES}
          SELECT 'DWD_PAGE_LOG_TOPIC' AS topic, {_JSON_TEXT} AS value FROM pages_""",
        "map_op": f"""WITH {_CHANGES}
          SELECT off AS "offset", tbl AS "table", {_TYPE} AS type, {_OP} AS op
          FROM changes WHERE id % 10 <> 3""",
        "route_facts": ROUTE_FACTS,
        "route_dims": f"""WITH {_CHANGES}
          SELECT {_DIM_KEY} AS dim_key, CAST(id AS VARCHAR) AS id, {_OP} AS op,
                 off AS "offset", field
          FROM changes WHERE id % 10 <> 3 AND tbl IN ({_listed("dim")})""",
        "stream_log_split": FAN_OUT,
        "stream_change_facts": ROUTE_FACTS,
        "stream_change_commits": ROUTE_FACTS,
        "read_committed": FAN_OUT,
        "stream_change_dims": _latest_dims(""),
        "stream_dau": f"""WITH {_FIRST}, {_LATEST_USERS}
          SELECT dt, mid, user_id, l.gender AS user_gender,
                 CASE WHEN l.id IS NOT NULL THEN CAST(a.age AS VARCHAR) END AS user_age,
                 CASE WHEN n_nationkey % 10 <> 3 THEN n_name END AS province_name
          FROM visits v LEFT JOIN latest l ON v.user_id = CAST(l.id AS VARCHAR)
          LEFT JOIN ages a ON a.id = l.id
          LEFT JOIN nation ON v.province_id = CAST(n_nationkey AS VARCHAR)""",
        "stream_order_join": f"""WITH {_ORDERS}
          SELECT {_wide()}, {_NO_DIMS}
          FROM detail d JOIN info i ON d.order_id = i.id AND {_WITHIN}""",
        "stream_order_wide": f"""WITH {_ORDERS}, {_LATEST_USERS}
          SELECT detail_id, create_date, order_id, user_gender, user_age, province_name, line_ms
          FROM (
            SELECT d.id AS detail_id, strftime(i.arrival, '%Y-%m-%d') AS create_date, d.order_id,
                   l.gender AS user_gender,
                   CASE WHEN l.id IS NOT NULL THEN a.age END AS user_age,
                   CASE WHEN n_nationkey % 10 <> 3 THEN n_name END AS province_name,
                   epoch_ms(d.arrival) AS line_ms,
                   row_number() OVER (PARTITION BY d.id, strftime(i.arrival, '%Y-%m-%d')
                                      ORDER BY d.arrival DESC) AS rn
            FROM detail d JOIN info i ON d.order_id = i.id AND {_WITHIN}
            LEFT JOIN latest l ON i.user_id = l.id
            LEFT JOIN ages a ON a.id = l.id
            LEFT JOIN nation ON i.province_id = n_nationkey)
          WHERE rn = 1""",
        "quarantine_change": f"""WITH {_CHANGES}
          SELECT 'ODS_BASE_DB' AS topic, CAST(id % 3 AS INTEGER) AS partition, off AS "offset",
                 (epoch(TIMESTAMP '2024-01-01') + id + CASE WHEN off > {SECOND_VERSION} OR tbl = 'user_info' AND off <> id THEN 86400 ELSE 0 END)::BIGINT * 1000 AS sent_ms
          FROM changes WHERE off % 97 = 0 OR off % 89 = 0""",
        "quarantine_page": f"""WITH {_PAGES}
          SELECT ts FROM pages_ WHERE ts % 97 = 0 OR ts % 89 = 0""",
        "quarantine_order": f"""WITH {_ALL_INFO}, {_DETAIL}
          SELECT 'DWD_ORDER_INFO_I' AS topic, CAST(id % 3 AS INTEGER) AS partition,
                 id AS "offset", epoch_ms(arrival) AS sent_ms
          FROM all_info WHERE id % 97 = 0 OR id % 89 = 0
          UNION ALL
          SELECT 'DWD_ORDER_DETAIL_I', CAST(id % 3 AS INTEGER), id, epoch_ms(arrival)
          FROM detail WHERE id % 97 = 0 OR id % 89 = 0""",
        "order_wide_bad": f"""WITH {_ALL_INFO}, {_DETAIL}, {_USERS}
          SELECT d.id AS detail_id, d.order_id, d.sku_id, d.order_price, u.gender AS user_gender,
                 strftime(i.arrival, '%Y-%m-%d') AS create_date
          FROM detail d JOIN all_info i ON d.order_id = i.id AND {_WITHIN}
          LEFT JOIN users u ON i.user_id = u.uid
          WHERE d.id % 97 <> 0 AND d.id % 89 <> 0 AND i.id % 97 <> 0 AND i.id % 89 <> 0""",
        "dau_wide_bad": f"""WITH {_PAGES}, {_USERS}, good AS (
            SELECT *, {_DT} AS dt, row_number() OVER (PARTITION BY {_DT}, mid ORDER BY ts) AS rn
            FROM pages_ WHERE last_page_id IS NULL AND ts % 97 <> 0 AND ts % 89 <> 0)
          SELECT dt, mid, page_id, ts, u.gender AS user_gender
          FROM good LEFT JOIN users u ON user_id = CAST(u.uid AS VARCHAR) WHERE rn = 1""",
        "compact_docs": f"WITH {_DAU} SELECT * FROM dau",
        "compact_dims": _latest_dims(""),
        "upsert_dim": _latest_dims(""),
        "upsert_dim_remove": _latest_dims("AND id % 10 <> 0"),
        "with_user_dim": f"""WITH {_PAGES}, {_USERS}
          SELECT mid, user_id, ts, gender AS user_gender,
                 CAST(age AS VARCHAR) AS user_age
          FROM pages_ LEFT JOIN users ON user_id = CAST(uid AS VARCHAR)""",
        "with_user_dim_drop": f"""WITH {_INFO}, {_USERS}
          SELECT id, user_id, gender AS user_gender, age AS user_age
          FROM info JOIN users ON user_id = uid""",
        "with_province_dim": f"""WITH {_PAGES}
          SELECT mid, ts, province_id, n_name AS province_name,
                 'C-' || n_nationkey AS province_iso_code,
                 'CN-' || n_nationkey AS province_3166_2,
                 CAST(n_nationkey * 100 AS VARCHAR) AS province_area_code
          FROM pages_ LEFT JOIN nation ON province_id = CAST(n_nationkey AS VARCHAR)""",
        "age_years": f"""SELECT CAST(c_custkey AS VARCHAR) AS id,
            strftime({_BIRTHDAY}, '%Y-%m-%d') AS birthday, {_AGE} AS age
          FROM customer""",
        "time_parts": f"WITH {_PAGES} SELECT mid, ts, {_DT} AS dt, {_HR} AS hr FROM pages_",
        "create_parts": f"""WITH {_ALL_INFO}
          SELECT id, create_time, strftime(arrival, '%Y-%m-%d') AS create_date,
                 strftime(arrival, '%H') AS create_hour
          FROM all_info""",
        "parse_page_log": f"WITH {_PAGES} SELECT * FROM pages_",
        "first_pages": f"WITH {_PAGES} SELECT * FROM pages_ WHERE last_page_id IS NULL",
        "daily_first_visit": f"WITH {_FIRST} SELECT * FROM visits",
        "dau_wide": f"WITH {_DAU} SELECT * FROM dau",
        "rebuild_seen": f"""WITH {_FIRST}
          SELECT dt, mid, ts, page_id FROM visits v
          WHERE NOT EXISTS (SELECT 1 FROM visits s WHERE s.page_id < 'page_5'
                            AND s.dt = v.dt AND s.mid = v.mid)""",
        "read_sink_field": f"WITH {_FIRST} SELECT mid FROM visits WHERE dt = '2024-01-10'",
        "split_by_day": f"""WITH {_FIRST}
          SELECT 'dau_info_' || dt AS index_name, count(*) AS docs FROM visits GROUP BY 1""",
        "stage_counts": STAGE_COUNTS,
        "stream_stage_counts": STAGE_COUNTS,
        "partition_counts": f"""WITH {_FIRST}
          SELECT 'before' AS stage, CAST(ts % 5 AS INTEGER) AS partition, count(*) AS rows
          FROM pages_ GROUP BY ts % 5
          UNION ALL SELECT 'after', CAST(ts % 3 AS INTEGER), count(*) FROM visits GROUP BY ts % 3""",
        "parse_order_info": f"""WITH {_ALL_INFO}
          SELECT * REPLACE (epoch_ms(arrival) AS arrival),
                 CAST(NULL AS VARCHAR) AS expire_time,
                 CAST(NULL AS VARCHAR) AS refundable_time,
                 CAST(NULL AS VARCHAR) AS operate_time,
                 CAST(NULL AS VARCHAR) AS create_date,
                 CAST(NULL AS VARCHAR) AS create_hour, {_NO_DIMS}
          FROM all_info""",
        "parse_order_detail": f"""WITH {_DETAIL}
          SELECT {_DETAIL_COLUMNS}, epoch_ms(arrival) AS arrival FROM detail""",
        "order_batch_join": f"""WITH {_ORDERS}
          SELECT coalesce(d.order_id, i.id) AS order_id, i.id AS header_id,
                 i.total_amount, d.id AS line_id, d.order_price
          FROM detail d FULL JOIN info i ON d.order_id = i.id""",
        "order_wide_join": f"""WITH {_ORDERS}
          SELECT i.id AS header_id, d.id AS line_id, d.sku_id, d.order_price,
                 epoch_ms(i.arrival) AS header_ms, epoch_ms(d.arrival) AS line_ms
          FROM detail d JOIN info i ON d.order_id = i.id AND {_WITHIN}""",
        "order_wide_join_salted": f"""WITH {_ORDERS}
          SELECT i.id AS header_id, d.id AS line_id, d.order_price
          FROM detail d JOIN info i ON d.order_id = i.id AND {_WITHIN}""",
        "pending_details": f"""WITH {_ORDERS}
          SELECT {_LINE} FROM detail d
          WHERE NOT EXISTS (SELECT 1 FROM info i WHERE i.id = d.order_id)""",
        "pending_orders": f"""WITH {_ORDERS}
          SELECT id, user_id, total_amount, create_time FROM info i
          WHERE NOT EXISTS (SELECT 1 FROM detail d WHERE d.order_id = i.id)""",
        "distinct_pending": f"""WITH {_ORDERS}
          SELECT DISTINCT {_LINE} FROM detail d
          WHERE NOT EXISTS (SELECT 1 FROM info i WHERE i.id = d.order_id)""",
        "copy_matching": f"""WITH {_PAGES}
          SELECT * EXCLUDE (last_page_id), CAST(NULL AS VARCHAR) AS user_gender,
                 CAST(NULL AS VARCHAR) AS user_age, CAST(NULL AS VARCHAR) AS province_name,
                 CAST(NULL AS VARCHAR) AS province_iso_code,
                 CAST(NULL AS VARCHAR) AS province_3166_2,
                 CAST(NULL AS VARCHAR) AS province_area_code,
                 CAST(NULL AS VARCHAR) AS dt, CAST(NULL AS VARCHAR) AS hr
          FROM pages_""",
        "merge_order_wide": _MERGED,
        "order_wide": ORDER_WIDE,
        "upsert_docs": f"""WITH {_DETAIL}
          SELECT id, sku_id, order_price, sku_num, epoch_ms(arrival) AS line_ms FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY arrival DESC,
              shipped DESC, sku_id DESC, supplier DESC, order_price DESC) AS rn
            FROM detail) WHERE rn = 1""",
        "starting_offsets": f"""SELECT '{{"ODS_BASE_LOG":{{'
            || string_agg('"' || part || '":' || hi, ',' ORDER BY part) || ',"3":-1}}}}'
            AS starting_offsets
          FROM ({_OFFSETS})""",
        "batch_offsets": f"""SELECT 'ODS_BASE_LOG' AS topic, part AS partition,
            lo AS from_offset, hi AS until_offset FROM ({_OFFSETS})""",
        "offset_ledger": f"""SELECT 'ODS_BASE_LOG' AS topic, 'log_split' AS group_id,
            part AS partition, hi AS "offset", CAST(7 AS BIGINT) AS batch_id
          FROM ({_OFFSETS})""",
    }
