"""JSON text of a message -> typed columns.

The parse sits in a generator (`inline` of a one-element array). Catalyst pushes
filters on parsed fields through a plain projection and would then parse the text
once per filtered field; it does not push them through a generator.
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivermill import schemas as S

_NUMERIC = (T.LongType, T.IntegerType, T.DoubleType)


def _fields(msgs: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    return msgs.select(*keep, F.inline(F.array(F.from_json("value", schema))))


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def number(text: Column | str, to: str = "bigint") -> Column:
    """Number held as JSON number or numeric text; NULL when it is neither."""
    return (F.col(text) if isinstance(text, str) else text).try_cast(to)


def parse_log(msgs: DataFrame) -> DataFrame:
    """Envelope columns plus common, ts, err, page, displays, actions, start."""
    return _fields(msgs, S.RAW_LOG, *msgs.columns).withColumn("ts", number("ts"))


def quarantine(msgs: DataFrame) -> DataFrame:
    """Messages no route can take: not parseable, or neither `err` nor `common`."""
    bad = _fields(msgs, S.RAW_LOG, *msgs.columns).filter("err IS NULL AND common IS NULL")
    return bad.select(*msgs.columns)


_CHANGE_KEYS = "type IS NOT NULL AND table IS NOT NULL"


def read_change(msgs: DataFrame) -> DataFrame:
    """Envelope columns plus type, table and data (the row's JSON text) of all messages, parsed once."""
    return _fields(msgs, S.CHANGE, *msgs.columns)


def narrow_change(read: DataFrame) -> DataFrame:
    """The rows of `read_change` with the text of unusable messages alone: the others are in their columns."""
    return read.withColumn("value", F.when(~F.expr(_CHANGE_KEYS), F.col("value")))


def usable_change(read: DataFrame) -> DataFrame:
    """The messages of `read_change` that name a table and a change type."""
    return read.filter(_CHANGE_KEYS)


def unusable_change(read: DataFrame) -> DataFrame:
    """The others, which name no table or no change type, or are not JSON."""
    return read.filter(f"NOT ({_CHANGE_KEYS})")


def parse_change(msgs: DataFrame) -> DataFrame:
    """Envelope columns plus type, table and data of usable changes."""
    return usable_change(read_change(msgs))


def quarantine_change(msgs: DataFrame) -> DataFrame:
    """Messages that name no table or no change type, or are not JSON."""
    return unusable_change(read_change(msgs)).select(*msgs.columns)


def _typed_row(
    msgs: DataFrame, schema: T.StructType, zero: bool, *keep: str, needs: tuple[str, ...]
) -> DataFrame:
    text = _fields(msgs, _as_text(schema), *keep).filter(_usable(schema, needs))
    return text.select(*keep, *_cells(schema, zero))


def _cells(schema: T.StructType, zero: bool) -> list[Column]:
    """The typed fields of a record that was parsed as text."""

    def cell(field):
        if not isinstance(field.dataType, _NUMERIC):
            return F.col(field.name)
        value = number(field.name, field.dataType.simpleString())
        if zero:
            value = F.coalesce(value, F.lit(0).cast(field.dataType))
        return value.alias(field.name)

    return [cell(f) for f in schema]


def _usable(schema: T.StructType, needs: tuple[str, ...]) -> Column:
    """Whether a record parsed and holds its keys, in their types."""
    found = F.lit(True)
    for name in needs:
        kind = schema[name].dataType
        value = number(name, kind.simpleString()) if isinstance(kind, _NUMERIC) else F.col(name)
        found = found & value.isNotNull()
    return found


def _unusable(msgs: DataFrame, schema: T.StructType, needs: tuple[str, ...]) -> DataFrame:
    text = msgs.select(
        F.struct(*msgs.columns).alias("msg"),
        F.inline(F.array(F.from_json("value", _as_text(schema)))),
    )
    return text.filter(~_usable(schema, needs)).select("msg.*")


# Without these a page has no visit, a header no order and a line no place.
PAGE_KEYS, INFO_KEYS, DETAIL_KEYS = ("mid", "ts"), ("id",), ("id", "order_id")


def parse_page_log(msgs: DataFrame) -> DataFrame:
    """PAGE_LOG rows of the messages that hold a device and a time."""
    return _typed_row(msgs, S.PAGE_LOG, False, needs=PAGE_KEYS)


def quarantine_page(msgs: DataFrame) -> DataFrame:
    """The other messages, unchanged."""
    return _unusable(msgs, S.PAGE_LOG, PAGE_KEYS)


def _order_row(
    msgs: DataFrame, schema: T.StructType, needs: tuple[str, ...], keep: tuple[str, ...]
) -> DataFrame:
    # Order rows default a missing number to 0; their clock is the message timestamp.
    timed = msgs.withColumn("arrival", F.col("timestamp"))
    rows = _typed_row(timed, schema, True, "arrival", *keep, needs=needs)
    return rows.select(*schema.names, "arrival", *keep)


def parse_order_info(msgs: DataFrame) -> DataFrame:
    """ORDER_INFO columns plus `arrival` of the messages that hold an id."""
    return _order_row(msgs, S.ORDER_INFO, INFO_KEYS, ())


def parse_order_detail(msgs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """ORDER_DETAIL columns plus `arrival` (and `keep` of the envelope) of the messages
    that hold an id and an order's id."""
    return _order_row(msgs, S.ORDER_DETAIL, DETAIL_KEYS, keep)


def read_order(msgs: DataFrame, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """All messages of kind 'info' or 'detail', parsed once: `row`, as `parse_order_info` or
    `parse_order_detail` gives it, or `message`, unchanged, of those that cannot be used."""
    schema, needs = (S.ORDER_INFO, INFO_KEYS) if kind == "info" else (S.ORDER_DETAIL, DETAIL_KEYS)
    text = msgs.select(
        F.struct(*msgs.columns).alias("message"),
        F.inline(F.array(F.from_json("value", _as_text(schema)))),
    )
    envelope = [F.col("message.timestamp").alias("arrival"), *[F.col(f"message.{c}").alias(c) for c in keep]]
    row, usable = F.struct(*_cells(schema, True), *envelope), _usable(schema, needs)
    return text.select(F.when(usable, row).alias("row"), F.when(~usable, F.col("message")).alias("message"))


def quarantine_order(msgs: DataFrame, kind: str) -> DataFrame:
    """The other messages of kind 'info' or 'detail', unchanged."""
    if kind == "info":
        return _unusable(msgs, S.ORDER_INFO, INFO_KEYS)
    return _unusable(msgs, S.ORDER_DETAIL, DETAIL_KEYS)


def parse_dim(dims: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """Rows of one dimension table out of the (table, id, data) store."""
    rows = dims.filter(F.col("table") == table)
    return rows.select(F.inline(F.array(F.from_json("data", schema))))
