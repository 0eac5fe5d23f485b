"""The four jobs: pure operators wired to sources and sinks.

Each returns a started query; the caller waits for it. The default trigger is a
micro-batch every five seconds, tests pass `availableNow=True`. Output comes before the
checkpoint's commit and is keyed by batch or document id, so a replay repeats nothing.
Messages that cannot be used go, as they came, to the topic S.BAD_TOPIC.
"""

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rivermill import schemas as S
from rivermill.functions.keyed import at_hand
from rivermill.functions.parse import (
    narrow_change,
    parse_log,
    parse_order_detail,
    parse_order_info,
    parse_page_log,
    quarantine_page,
    read_change,
    read_order,
    unusable_change,
    usable_change,
)
from rivermill.functions.scalars import create_parts
from rivermill.operators import dau, orders
from rivermill.operators.changes import map_op, route_dims, route_facts
from rivermill.operators.logs import fan_out
from rivermill.plans.wide_tables import dau_dims, order_dims
from rivermill.session import FREE_EVERY, check, free_shuffles
from rivermill.sinks.commits import commit, is_committed, new_attempt, stamp
from rivermill.sinks.docs import write_dims, write_docs
from rivermill.sinks.topics import append_ledger, ledger_base, offset_ledger, write_topic
from rivermill.sources.pending import expire, is_late, late_pairs, newest_before, put_mark, put_pending
from rivermill.sources.stores import first_batch, read_or_empty, read_store, split_columns, write_batch
from rivermill.sources.tables import doc_schema, read_docs, read_provinces, read_table_list, read_users

EVERY_FIVE_SECONDS = {"processingTime": "5 seconds"}
DAU_KEYS = ["dt", "mid"]
ORDER_KEYS = ["create_date", "detail_id"]
# What orders two stored rows of one order line: the arrival of the line's message.
ORDER_LAST = tuple(f"line_{c}" for c in S.LINE_PLACE)
_RAW = "raw_message"
RAW = T.StructType([T.StructField("kind", T.StringType()), *S.MESSAGE.fields])


def run_log_split(
    msgs: DataFrame,
    target: dict[str, str],
    checkpoint: str,
    bad_topic: str = S.BAD_TOPIC,
    commits: str | None = None,
    name: str | None = None,
    trigger: dict = EVERY_FIVE_SECONDS,
) -> StreamingQuery:
    """Raw behaviour logs -> the five detail topics and the bad one, one pass, no shuffle.

    With `commits`, the path of a commit table, messages are stamped and a batch counts
    once all of it is sent.
    """
    first = first_batch(msgs.sparkSession, checkpoint, *_folder(target), *_paths(commits))

    def split(batch: DataFrame, batch_id: int) -> None:
        def send(stamped: Callable[[DataFrame], DataFrame]) -> None:
            write_topic(stamped(fan_out(parse_log(batch), bad_topic)), target, first + batch_id)

        _once(batch.sparkSession, commits, name or "log_split", first + batch_id, send)

    return _each_batch(msgs, split, checkpoint, name, trigger)


def run_change_split(
    msgs: DataFrame,
    lists_path: str,
    target: dict[str, str],
    dims_path: str,
    checkpoint: str,
    ledger_path: str | None = None,
    group: str = "change_split",
    bad_topic: str = S.BAD_TOPIC,
    commits: str | None = None,
    name: str | None = None,
    trigger: dict = EVERY_FIVE_SECONDS,
) -> StreamingQuery:
    """Database changes -> fact topics and the dimension store.

    The table lists are read anew for every micro-batch, so routing changes without a
    restart. The batch is parsed once and kept so for its uses, with the text of unusable messages
    alone. With `commits`, the path of a commit table,
    facts, dimensions, bad messages and ledger of a batch have one number, and readers that
    ask for committed batches see all four or none.
    """
    spark = msgs.sparkSession
    first = first_batch(spark, checkpoint, dims_path, *_folder(target), *_paths(commits, commits and ledger_path))
    base = first
    if ledger_path and not commits:
        base = first_batch(spark, f"{checkpoint}/ledger", ledger_path)

    def split(batch: DataFrame, batch_id: int) -> None:
        _once(batch.sparkSession, commits, group, first + batch_id, lambda stamped: send(batch, batch_id, stamped))

    def send(batch: DataFrame, batch_id: int, stamped: Callable[[DataFrame], DataFrame]) -> None:
        spark = batch.sparkSession
        rows = narrow_change(read_change(batch)).persist()
        try:
            rows.count()  # parsed here; two scans at once would each begin to
            changes = map_op(usable_change(rows))
            facts = read_table_list(spark, lists_path, "fact")
            dims = read_table_list(spark, lists_path, "dim")
            sent = route_facts(changes, facts).unionByName(_bad_messages(unusable_change(rows), bad_topic))
            write_topic(stamped(sent), target, first + batch_id)
            write_dims(route_dims(changes, dims), dims_path, first + batch_id)
            if ledger_path:
                append_ledger(offset_ledger(rows, group, base + batch_id), ledger_path, base + batch_id)
        finally:
            rows.unpersist()

    return _each_batch(msgs, split, checkpoint, name, trigger)


LATE_KEYS = T.StructType(
    [*[T.StructField(c, T.StringType()) for c in DAU_KEYS], T.StructField("batch_id", T.LongType())]
)
PINNED = T.StructType([T.StructField("path", T.StringType())])


def pin_seen(spark: SparkSession, sink_path: str, pinned_path: str) -> DataFrame:
    """(dt, mid) of the visits stored so far, written once.

    A restart finds the finished snapshot by its marker row, which is written last, and
    uses it again, so that a replayed batch is never compared with its own output.
    """
    where = f"{pinned_path}/visits"
    if read_or_empty(spark, f"{pinned_path}/marker", PINNED).head() is None:
        stored = read_docs(spark, sink_path, S.DAU_INFO, DAU_KEYS, columns=DAU_KEYS)
        stored.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(where)
        marker = spark.createDataFrame([(where,)], PINNED)
        marker.write.mode("overwrite").parquet(f"{pinned_path}/marker")
    return spark.read.schema("mid string, dt string").parquet(where)


def _needed_users(rows: DataFrame, dims_path: str) -> DataFrame:
    """The user dimension as it stands, for the users of a micro-batch only."""
    ids = rows.select(F.col("user_id").cast("string").alias("id")).distinct()
    return read_users(rows.sparkSession, dims_path, ids=ids)


def run_dau(
    msgs: DataFrame,
    dims_path: str,
    sink_path: str,
    checkpoint: str,
    seen_path: str | None = None,
    as_of: Column | None = None,
    on_missing: str = "null",
    bounded: bool = True,
    lateness: str = "1 day",
    salt: int = 8,
    bad: dict[str, str] | None = None,
    name: str | None = None,
    trigger: dict = EVERY_FIVE_SECONDS,
) -> StreamingQuery:
    """Page log -> first visit per device and day -> DAU_INFO documents.

    Dimensions are read as they stand when the micro-batch is written. `seen_path`, for
    a fresh checkpoint over a sink that already has rows, holds the pinned snapshot.
    Unusable messages go to `bad`, by default message files beside the sink.

    The state forgets a device `lateness` after its visit. No row is too late: later ones are
    compared with the stored documents of their days, and the keys that they add, kept
    beside the sink, with the visits that still come in time. With `bounded` off devices
    are remembered for ever instead.
    """
    spark = msgs.sparkSession
    bad, late_path = bad or {"path": f"{sink_path}_bad"}, f"{sink_path}_late"
    pages = dau.observe_pages(parse_page_log(msgs))
    visits = dau.observe_visits(
        dau.daily_first_visit(dau.first_pages(pages), bounded, lateness, salt)
    )
    seen = pin_seen(spark, sink_path, seen_path) if seen_path else None
    first = first_batch(spark, checkpoint, sink_path, *_folder(bad))

    def late_visits(rows: DataFrame, opened: DataFrame, newest: int, earlier: Column) -> DataFrame:
        """First visits too late for the state, of devices not stored for their day."""
        late = dau.daily_first_visit(opened.filter(is_late(F.timestamp_millis("ts"), newest, lateness)))
        days = [r.dt for r in late.select("dt").distinct().collect()]
        stored = read_store(rows.sparkSession, sink_path, doc_schema(S.DAU_INFO))
        late = dau.rebuild_seen(late, stored.filter(F.col("dt").isin(days) & earlier))
        # Those that the state still took are among the rows.
        return dau.rebuild_seen(late, rows)

    def write(rows: DataFrame, batch_id: int) -> None:
        new = rows if seen is None else dau.rebuild_seen(rows, at_hand(seen, rows.select(*DAU_KEYS)))
        wide = dau_dims(
            new,
            _needed_users(rows, dims_path),
            read_provinces(rows.sparkSession, dims_path),
            as_of,
            on_missing,
            salt,
        )
        write_docs(wide, sink_path, DAU_KEYS, ["ts"], batch_id, day="dt", unique=True)

    def store(rows: DataFrame, raw: Callable[[str], DataFrame], batch_id: int) -> None:
        spark = rows.sparkSession
        newest = newest_before(spark, late_path, batch_id) if bounded else None
        opened = dau.first_pages(parse_page_log(raw("page")))
        if newest is None:
            write(rows, batch_id)
        else:
            earlier = F.col("batch_id") < batch_id
            late = late_visits(rows, opened, newest, earlier).persist()
            try:
                write_batch(late.select(*DAU_KEYS), f"{late_path}/keys", batch_id)
                added = read_or_empty(spark, f"{late_path}/keys", LATE_KEYS).filter(earlier)
                write(dau.rebuild_seen(rows, added).unionByName(late), batch_id)
            finally:
                late.unpersist()
        if bounded:
            put_mark(spark, late_path, batch_id, opened.agg(F.max(F.col("ts") * 1000)).head()[0])

    both = _with_raw(visits, {"page": msgs})
    return _each_batch(both, _apart(store, {"page": quarantine_page}, bad, first), checkpoint, name, trigger)


def run_order_wide(
    info_msgs: DataFrame,
    detail_msgs: DataFrame,
    dims_path: str,
    sink_path: str,
    checkpoint: str,
    retention: str = "24 hours",
    as_of: Column | None = None,
    on_missing: str = "null",
    salt: int = 8,
    lateness: str | None = None,
    pending: str | None = None,
    keep: str = "7 days",
    bad: dict[str, str] | None = None,
    name: str | None = None,
    trigger: dict = EVERY_FIVE_SECONDS,
) -> StreamingQuery:
    """Order headers and lines, in whichever order they arrive -> ORDER_WIDE documents.

    Dimensions are added after the join, so the join state holds narrow headers and a
    restart is not needed to see new dimension rows. Of several rows of an order line the
    one whose message arrived last counts.

    State is kept for `retention` and `lateness` (by default the same again). No row is too
    late for a document: headers and lines are also kept in `pending` (by default beside
    the sink), where rows that the state has no partners for any more find them, until all
    rows of their batch are `keep` behind the newest.
    """
    spark = info_msgs.sparkSession
    bad = bad or {"path": f"{sink_path}_bad"}
    pending, delay = pending or f"{sink_path}_pending", lateness or retention
    place = tuple(S.LINE_PLACE[1:])
    headers, lines = create_parts(parse_order_info(info_msgs)), parse_order_detail(detail_msgs, place)
    joined = orders.order_wide_join(headers, lines, retention, salt, lateness)
    first = first_batch(spark, checkpoint, sink_path, *_folder(bad))
    # A store that was begun by day goes on by day.
    spans = "create_date" not in split_columns(spark, sink_path)

    def store(batch: DataFrame, read: Callable[[str], DataFrame], batch_id: int) -> None:
        spark = batch.sparkSession
        newest = newest_before(spark, pending, batch_id)
        new = {"info": create_parts(read("info")), "detail": read("detail")}
        for side, rows in new.items():
            put_pending(rows, pending, side, batch_id, newest, delay)
        if newest is not None:
            late = late_pairs(spark, pending, batch_id, new["info"].schema, new["detail"].schema, retention, salt)
            batch = batch.unionByName(late)
        rows = orders.merge_order_wide(batch, place=True)
        wide = order_dims(
            rows,
            _needed_users(rows, dims_path),
            read_provinces(spark, dims_path),
            as_of,
            on_missing,
            salt,
        )
        write_docs(wide, sink_path, ORDER_KEYS, list(ORDER_LAST), batch_id, day="create_date", spans=spans)
        arrivals = new["info"].select("arrival").unionByName(new["detail"].select("arrival"))
        put_mark(spark, pending, batch_id, arrivals.agg(F.max(F.unix_micros("arrival"))).head()[0])
        expire(spark, pending, keep)

    both = _with_read(joined, {"info": read_order(info_msgs, "info"), "detail": read_order(detail_msgs, "detail", place)})
    unusable = {side: lambda msgs: msgs for side in ("info", "detail")}
    return _each_batch(both, _apart(store, unusable, bad, first, read=True), checkpoint, name, trigger)


def _folder(target: dict[str, str]) -> list[str]:
    return _paths(target.get("path"))


def _paths(*paths: str | None) -> list[str]:
    return [p for p in paths if p]


def _once(spark: SparkSession, commits: str | None, producer: str, batch_id: int, send: Callable) -> None:
    """Send a batch unless it is committed, and commit it when all of it is written."""
    if commits is None:
        send(lambda msgs: msgs)
    elif not is_committed(spark, commits, batch_id):
        attempt = new_attempt()
        send(lambda msgs: stamp(msgs, producer, attempt, batch_id))
        commit(spark, commits, producer, attempt, batch_id)


def _bad_messages(msgs: DataFrame, topic: str = S.BAD_TOPIC) -> DataFrame:
    return msgs.select(F.lit(topic).alias("topic"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def _with_raw(rows: DataFrame, msgs: dict[str, DataFrame]) -> DataFrame:
    """Rows of the job and, in the same micro-batches, the messages they come from."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.MESSAGE]
    both = rows.withColumn(_RAW, F.lit(None).cast(RAW))
    for kind, frame in msgs.items():
        message = F.struct(F.lit(kind).alias("kind"), *fields)
        both = both.unionByName(frame.select(message.alias(_RAW)), allowMissingColumns=True)
    return both


def _with_read(rows: DataFrame, read: dict[str, DataFrame]) -> DataFrame:
    """Rows of the job and, in the same micro-batches, what `read_order` gives of the messages they
    come from: a row of each that can be used, without its text, and the others as they came."""
    both = rows.withColumn(_RAW, F.lit(None).cast(RAW))
    for kind, frame in read.items():
        fields = [F.col("message")[f.name].cast(f.dataType).alias(f.name) for f in S.MESSAGE]
        message = F.when(F.col("message").isNotNull(), F.struct(F.lit(kind).alias("kind"), *fields))
        found = frame.select(message.alias(_RAW), F.col("row").alias(f"{_RAW}_{kind}"))
        both = both.unionByName(found, allowMissingColumns=True)
    return both


def _apart(store: Callable, unusable: dict[str, Callable], bad: dict[str, str], first: int, read: bool = False) -> Callable:
    """Store the rows of a micro-batch, and send the messages that cannot be used to `bad`.

    `store` is given the messages of a kind, or with `read` the rows read of them (`_with_read`).
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        # Kept, because running the batch again would run its stateful steps again.
        kept = batch.persist()

        def raw(kind: str) -> DataFrame:
            of_kind = F.col(f"{_RAW}.kind") == kind
            return kept.filter(of_kind).select(*[F.col(_RAW)[c].alias(c) for c in S.MESSAGE.names])

        def rows_read(kind: str) -> DataFrame:
            return kept.filter(F.col(f"{_RAW}_{kind}").isNotNull()).select(f"{_RAW}_{kind}.*")

        own = [c for c in kept.columns if c.startswith(_RAW)]
        of_job = functools.reduce(Column.__and__, [F.col(c).isNull() for c in own])
        try:
            if kept.isEmpty():  # a batch that only moved the watermark
                return
            store(kept.filter(of_job).drop(*own), rows_read if read else raw, first + batch_id)
            messages = [_bad_messages(find(raw(kind))) for kind, find in unusable.items()]
            write_topic(functools.reduce(DataFrame.unionByName, messages), bad, first + batch_id)
        finally:
            kept.unpersist()

    return both


def _each_batch(df, store, checkpoint, name, trigger):
    check(df.sparkSession)

    def stored(batch: DataFrame, batch_id: int) -> None:
        free_shuffles(batch.sparkSession, FREE_EVERY)  # of the batches before
        store(batch, batch_id)

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(stored)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger).start()
