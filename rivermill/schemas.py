"""Row types and the names that other systems rely on."""

from pyspark.sql import types as T

# Topics, operation codes and table names of the warehouse.
LOG_TOPIC = "ODS_BASE_LOG"
CHANGE_TOPIC = "ODS_BASE_DB"
PAGE_TOPIC = "DWD_PAGE_LOG_TOPIC"
DISPLAY_TOPIC = "DWD_PAGE_DISPLAY_TOPIC"
ACTION_TOPIC = "DWD_PAGE_ACTION_TOPIC"
START_TOPIC = "DWD_START_LOG_TOPIC"
ERROR_TOPIC = "DWD_ERROR_LOG_TOPIC"
FACT_TOPIC_PREFIX = "DWD"
ORDER_INFO_TOPIC = "DWD_ORDER_INFO_I"
ORDER_DETAIL_TOPIC = "DWD_ORDER_DETAIL_I"
# Where messages go that cannot be used.
BAD_TOPIC = "DWD_BAD_RECORD"
USER_TABLE = "user_info"
PROVINCE_TABLE = "base_province"
OP_CODES = {
    "bootstrap-insert": "BI",
    "insert": "I",
    "update": "U",
    "delete": "D",
}


STR, LONG, INT, DBL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


# The row types below, field by field.
def _row(spec: str) -> T.StructType:
    """'name:type' pairs; a bare name is a string."""
    kinds = {"": STR, "long": LONG, "int": INT, "double": DBL}
    fields = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        fields.append(T.StructField(name, kinds[kind]))
    return T.StructType(fields)


MESSAGE = T.StructType(
    [
        T.StructField("key", STR),
        T.StructField("value", STR),
        T.StructField("topic", STR),
        T.StructField("partition", INT),
        T.StructField("offset", LONG),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Numeric leaves are read as text and cast afterwards: a log may hold 12 or "12".
RAW_LOG = T.StructType(
    [
        T.StructField("common", _row("ar uid os ch is_new md mid vc ba")),
        T.StructField("ts", STR),
        T.StructField("err", STR),
        T.StructField(
            "page",
            _row("page_id item item_type during_time last_page_id soucre_type source_type"),
        ),
        T.StructField(
            "displays", T.ArrayType(_row("display_type item item_type pos_id order"))
        ),
        T.StructField("actions", T.ArrayType(_row("action_id item item_type ts"))),
        T.StructField(
            "start", _row("entry open_ad_id loading_time open_ad_ms open_ad_skip_ms")
        ),
    ]
)

# `data` stays text: its shape differs per table.
CHANGE = _row("type table data")

_COMMON = "mid user_id province_id channel is_new model operate_system version_code brand"
_PAGE = f"{_COMMON} page_id last_page_id page_item page_item_type during_time:long sourceType"

PAGE_LOG = _row(f"{_PAGE} ts:long")
PAGE_DISPLAY_LOG = _row(
    f"{_PAGE} display_type display_item display_item_type display_order display_pos_id ts:long"
)
PAGE_ACTION_LOG = _row(
    f"{_PAGE} action_id action_item action_item_type action_ts:long ts:long"
)
START_LOG = _row(
    f"{_COMMON} entry open_ad_id loading_time_ms:long open_ad_ms:long open_ad_skip_ms:long ts:long"
)
DAU_INFO = _row(
    f"{_COMMON} page_id page_item page_item_type sourceType during_time:long "
    "user_gender user_age province_name province_iso_code province_3166_2 "
    "province_area_code dt hr ts:long"
)

_ORDER_AMOUNTS = (
    "total_amount:double activity_reduce_amount:double coupon_reduce_amount:double "
    "original_total_amount:double feight_fee:double feight_fee_reduce:double"
)
_ORDER_DIMS = (
    "create_date create_hour province_name province_area_code province_3166_2_code "
    "province_iso_code user_age:int user_gender"
)
ORDER_INFO = _row(
    f"id:long province_id:long order_status user_id:long {_ORDER_AMOUNTS} "
    f"expire_time refundable_time create_time operate_time {_ORDER_DIMS}"
)
ORDER_DETAIL = _row(
    "id:long order_id:long sku_id:long order_price:double sku_num:long sku_name "
    "create_time split_total_amount:double split_activity_amount:double "
    "split_coupon_amount:double"
)
ORDER_WIDE = _row(
    "detail_id:long order_id:long sku_id:long order_price:double sku_num:long sku_name "
    "split_total_amount:double split_activity_amount:double split_coupon_amount:double "
    f"province_id:long order_status user_id:long {_ORDER_AMOUNTS} "
    f"expire_time refundable_time create_time operate_time {_ORDER_DIMS}"
)

USER_INFO = _row("id gender birthday")
BASE_PROVINCE = _row("id name iso_code iso_3166_2 area_code")

TABLE_LIST = _row("kind table")
# When and where an order line arrived; the last one to arrive counts.
LINE_PLACE = ["arrival", "partition", "offset"]
ORDER_DOC = T.StructType(
    [
        *ORDER_WIDE.fields,
        T.StructField("line_arrival", T.TimestampType()),
        T.StructField("line_partition", T.IntegerType()),
        T.StructField("line_offset", T.LongType()),
    ]
)
LEDGER = _row("topic group_id partition:int offset:long batch_id:long")
