"""Behaviour-log split: one raw record -> error, page, display, action, start rows."""

from pyspark.sql import Column, DataFrame, functions as F

from rivermill import schemas as S
from rivermill.functions.parse import number

# Raw field -> column, in column order.
COMMON_FIELDS = {
    "mid": "mid",
    "uid": "user_id",
    "ar": "province_id",
    "ch": "channel",
    "is_new": "is_new",
    "md": "model",
    "os": "operate_system",
    "vc": "version_code",
    "ba": "brand",
}
PAGE_FIELDS = {
    "page_id": "page_id",
    "last_page_id": "last_page_id",
    "item": "page_item",
    "item_type": "page_item_type",
}
DISPLAY_FIELDS = {
    "display_type": "display_type",
    "item": "display_item",
    "item_type": "display_item_type",
    "order": "display_order",
    "pos_id": "display_pos_id",
}
ACTION_FIELDS = {
    "action_id": "action_id",
    "item": "action_item",
    "item_type": "action_item_type",
}
START_TEXT_FIELDS = {"entry": "entry", "open_ad_id": "open_ad_id"}
START_NUMBER_FIELDS = {
    "loading_time": "loading_time_ms",
    "open_ad_ms": "open_ad_ms",
    "open_ad_skip_ms": "open_ad_skip_ms",
}

_USABLE = "err IS NULL AND common IS NOT NULL"


def _renamed(struct: str, fields: dict[str, str]) -> list[Column]:
    return [F.col(struct)[raw].alias(name) for raw, name in fields.items()]


def _common() -> list[Column]:
    return _renamed("common", COMMON_FIELDS)


def _page() -> list[Column]:
    page = F.col("page")
    # Senders spell the source field both ways.
    source = F.coalesce(page["soucre_type"], page["source_type"])
    return _renamed("page", PAGE_FIELDS) + [
        number(page["during_time"]).alias("during_time"),
        source.alias("sourceType"),
    ]


def _display() -> list[Column]:
    return _renamed("display", DISPLAY_FIELDS)


def _action() -> list[Column]:
    return _renamed("action", ACTION_FIELDS) + [
        number(F.col("action")["ts"]).alias("action_ts")
    ]


def _start() -> list[Column]:
    start = F.col("start")
    return _renamed("start", START_TEXT_FIELDS) + [
        number(start[raw]).alias(name) for raw, name in START_NUMBER_FIELDS.items()
    ]


def project_common(log: DataFrame) -> DataFrame:
    """Replace `common` by its renamed fields."""
    return log.select(*_common(), *[c for c in log.columns if c != "common"])


def project_page(log: DataFrame) -> DataFrame:
    """Replace `page` by its renamed fields."""
    return log.select(*[c for c in log.columns if c != "page"], *_page())


def route_error(log: DataFrame) -> DataFrame:
    """Whole original text of every record that carries `err`."""
    return log.filter("err IS NOT NULL").select("value")


def route_page(log: DataFrame) -> DataFrame:
    pages = log.filter(_USABLE).filter("page IS NOT NULL")
    return project_page(project_common(pages)).select(*S.PAGE_LOG.names)


def route_start(log: DataFrame) -> DataFrame:
    """Independent of route_page: a record may give both."""
    starts = log.filter(_USABLE).filter("start IS NOT NULL")
    return starts.select(*_common(), *_start(), "ts")


def explode_displays(log: DataFrame) -> DataFrame:
    """One row per display of a page record; none for a missing or empty array."""
    pages = log.filter(_USABLE).filter("page IS NOT NULL")
    shown = pages.select("common", "page", "ts", F.explode("displays").alias("display"))
    return shown.select(*_common(), *_page(), *_display(), "ts").select(
        *S.PAGE_DISPLAY_LOG.names
    )


def explode_actions(log: DataFrame) -> DataFrame:
    """One row per action of a page record; none for a missing or empty array."""
    pages = log.filter(_USABLE).filter("page IS NOT NULL")
    acted = pages.select("common", "page", "ts", F.explode("actions").alias("action"))
    return acted.select(*_common(), *_page(), *_action(), "ts").select(
        *S.PAGE_ACTION_LOG.names
    )


def fan_out(log: DataFrame, bad_topic: str | None = None) -> DataFrame:
    """(topic, key, value) of every message a raw record gives, in one narrow pass.

    A record is first turned into an array of small pieces, one per message, holding
    only what that message needs beyond the shared fields; each exploded piece is
    then rendered once. `bad_topic` also emits records that no route can take.
    """
    kinds = {f.name: f.dataType for f in S.RAW_LOG}
    cells = {
        "raw": "string",
        "display": kinds["displays"].elementType,
        "action": kinds["actions"].elementType,
        "start": kinds["start"],
    }

    def piece(topic, **given):
        held = [
            (given[c] if c in given else F.lit(None)).cast(t).alias(c)
            for c, t in cells.items()
        ]
        return F.struct(F.lit(topic).alias("topic"), *held)

    def one(condition, *args, **given):
        return F.when(condition, F.array(piece(*args, **given)))

    usable = F.expr(_USABLE)
    paged = usable & F.col("page").isNotNull()
    raw = F.col("value")
    parts = [
        one(F.col("err").isNotNull(), S.ERROR_TOPIC, raw=raw),
        one(paged, S.PAGE_TOPIC),
        F.when(
            paged,
            F.transform("displays", lambda d: piece(S.DISPLAY_TOPIC, display=d)),
        ),
        F.when(
            paged, F.transform("actions", lambda a: piece(S.ACTION_TOPIC, action=a))
        ),
        one(usable & F.col("start").isNotNull(), S.START_TOPIC, start=F.col("start")),
    ]
    if bad_topic is not None:
        unusable = F.col("err").isNull() & F.col("common").isNull()
        parts.append(one(unusable, bad_topic, raw=raw))
    none = F.array(piece("")).cast("array<" + _piece_type(cells) + ">")
    none = F.slice(none, 1, 0)
    pieces = F.concat(*[F.coalesce(p, none) for p in parts])
    return log.select("common", "page", "ts", F.inline(pieces)).select(
        "topic", F.lit(None).cast("string").alias("key"), _rendered().alias("value")
    )


def _piece_type(cells) -> str:
    held = ",".join(
        f"{c}:{t if isinstance(t, str) else t.simpleString()}" for c, t in cells.items()
    )
    return f"struct<topic:string,{held}>"


def _rendered() -> Column:
    """Message text of an exploded piece; null fields are left out of the JSON."""
    text = lambda *groups: F.to_json(F.struct(*[c for g in groups for c in g], F.col("ts")))
    topic = F.col("topic")
    return (
        F.when(topic == S.PAGE_TOPIC, text(_common(), _page()))
        .when(topic == S.DISPLAY_TOPIC, text(_common(), _page(), _display()))
        .when(topic == S.ACTION_TOPIC, text(_common(), _page(), _action()))
        .when(topic == S.START_TOPIC, text(_common(), _start()))
        .otherwise(F.col("raw"))
    )
