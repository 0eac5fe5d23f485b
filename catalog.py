"""The registered queries: each runs one operator or job over whole tables."""

import contextlib
import functools
import tempfile

from pyspark.sql import SparkSession, functions as F, types as T

import fixtures as X
from rivermill import schemas as S
from rivermill.functions import parse
from rivermill.functions.scalars import age_years, create_parts, time_parts
from rivermill.operators import changes, dau, dims, logs, orders
from rivermill.operators.records import copy_matching, to_message
from rivermill.plans.wide_tables import dau_wide, order_wide
from rivermill.sinks.docs import split_by_day, upsert_docs, write_dims, write_docs
from rivermill.sinks.commits import HEADERS, commit, last_committed, read_commits, read_committed, stamp, visible
from rivermill.sinks.topics import message_columns, offset_ledger, write_topic
from rivermill.session import FREE, FREE_EVERY, SETTINGS, free_shuffles
from rivermill.sources.state import held_pending
from rivermill.sources.tables import compact_dims, compact_docs, read_dims, read_docs, read_sink_field
from rivermill.sources.topics import batch_offsets, read_topic_files, starting_offsets
from rivermill.streaming import jobs
from rivermill.streaming.jobs import DAU_KEYS
from rivermill.streaming.metrics import MetricTable, read_metrics

ALL_INPUT = {"availableNow": True}
PARTITIONS = "spark.sql.shuffle.partitions"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def as_of():
    return F.lit(X.AS_OF).cast("date")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder: in the shared one the cluster names, else a local one for tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        run = spark.sql("SELECT uuid()").head()[0]
        return f"{shared.rstrip('/')}/{name}-{run}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{name}-") + "/out"


def log(spark, d):
    return parse.parse_log(X.raw_log(spark, d))


def page_log(spark, d):
    return parse.parse_page_log(X.page_log_messages(spark, d))


def info(spark, d, misses=True):
    return parse.parse_order_info(X.order_info_messages(spark, d, misses))


def detail(spark, d):
    return parse.parse_order_detail(X.order_detail_messages(spark, d))


def ops(spark, d):
    return changes.map_op(parse.parse_change(X.change_log(spark, d)))


def visits(spark, d):
    return dau.daily_first_visit(dau.first_pages(page_log(spark, d)))


def _ms(column):
    return F.unix_millis(column)


# -- behaviour logs


def q_parse_log(spark, d):
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    return log(spark, d).select(
        "offset",
        F.col("common.mid").alias("mid"),
        F.col("common.vc").alias("vc"),
        "ts",
        F.col("err").isNotNull().cast("int").alias("has_err"),
        F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"),
        F.col("start.open_ad_id").alias("open_ad_id"),
        F.when(F.col("displays").isNull(), -1).otherwise(n("displays")).alias("n_displays"),
        F.when(F.col("actions").isNull(), -1).otherwise(n("actions")).alias("n_actions"),
    )


def q_quarantine(spark, d):
    return _places(parse.quarantine(X.raw_log(spark, d)))


def _places(msgs):
    return msgs.select("topic", "partition", "offset", _ms("timestamp").alias("sent_ms"))


def q_quarantine_change(spark, d):
    return _places(parse.quarantine_change(X.with_bad(X.change_log(spark, d), "table")))


def q_quarantine_page(spark, d):
    msgs = X.with_bad(_page_messages(spark, d), "mid")
    return parse.quarantine_page(msgs).select(F.col("offset").alias("ts"))


def _bad_orders(spark, d):
    return (
        X.with_bad(X.order_info_messages(spark, d, misses=False), "id"),
        X.with_bad(X.order_detail_messages(spark, d), "order_id"),
    )


def q_quarantine_order(spark, d):
    headers, lines = _bad_orders(spark, d)
    bad = parse.quarantine_order(headers, "info").unionByName(parse.quarantine_order(lines, "detail"))
    return _places(bad)


def q_order_wide_bad(spark, d):
    """The wide table where some messages are unusable: they take no part."""
    headers, lines = _bad_orders(spark, d)
    users, provinces = X.user_info(spark, d), X.base_province(spark, d)
    wide = order_wide(parse.parse_order_info(headers), parse.parse_order_detail(lines), users, provinces, as_of())
    return wide.select("detail_id", "order_id", "sku_id", "order_price", "user_gender", "create_date")


def q_dau_wide_bad(spark, d):
    pages = parse.parse_page_log(X.with_bad(_page_messages(spark, d), "mid"))
    wide = dau_wide(pages, X.user_info(spark, d), X.base_province(spark, d), as_of())
    return wide.select("dt", "mid", "page_id", "ts", "user_gender")


def q_route_error(spark, d):
    field = lambda path: F.get_json_object("value", path)
    return logs.route_error(log(spark, d)).select(
        field("$.err.error_code").cast("bigint").alias("error_code"),
        field("$.common.mid").alias("mid"),
        field("$.page.page_id").alias("page_id"),
        field("$.ts").cast("bigint").alias("ts"),
    )


def q_fan_out(spark, d):
    return _message_fields(logs.fan_out(log(spark, d)))


def _message_fields(msgs):
    field = lambda path: F.get_json_object("value", path)
    return msgs.select(
        "topic",
        F.coalesce(field("$.mid"), field("$.common.mid")).alias("mid"),
        field("$.page_id").alias("page_id"),
        F.coalesce(field("$.display_item"), field("$.action_id"), field("$.open_ad_id")).alias(
            "item"
        ),
        field("$.ts").cast("bigint").alias("ts"),
    )


def q_to_message(spark, d):
    pages = logs.route_page(log(spark, d))
    return to_message(pages, S.PAGE_TOPIC).select("topic", "value")


# -- database changes


def _change_field():
    """One field of the row text, another one per table."""
    paths = {
        "order_info": "$.order_status",
        "order_detail": "$.sku_name",
        "user_info": "$.gender",
        "base_province": "$.name",
        "region": "$.name",
    }
    found = F
    for table, path in paths.items():
        found = found.when(F.col("table") == table, F.get_json_object("data", path))
    return found


def _change_id():
    return F.get_json_object("data", "$.id").cast("bigint")


def q_parse_change(spark, d):
    return parse.parse_change(X.change_log(spark, d)).select(
        "offset",
        "table",
        "type",
        _change_id().alias("id"),
        _change_field().alias("field"),
    )


def q_map_op(spark, d):
    return ops(spark, d).select("offset", "table", "type", "op")


def q_route_facts(spark, d):
    return _fact_fields(changes.route_facts(ops(spark, d), X.table_list(spark, "fact")))


def _fact_fields(msgs):
    # One parse of the row's text gives all of its fields.
    parsed = msgs.select("topic", F.from_json("value", "map<string,string>").alias("row"))
    field = lambda name: F.col("row")[name]
    return parsed.select(
        "topic",
        field("id").cast("bigint").alias("id"),
        F.coalesce(field("order_status"), field("sku_name"), field("name")).alias("field"),
        F.coalesce(field("total_amount"), field("order_price")).cast("double").alias("amount"),
        field("create_time").alias("create_time"),
        F.size("row").alias("fields"),
    )


def q_route_dims(spark, d):
    return changes.route_dims(ops(spark, d), X.table_list(spark, "dim")).select(
        "dim_key", "id", "op", "offset", _change_field().alias("field")
    )


def _dim_rows(spark, d):
    parsed = changes.map_op(parse.parse_change(X.dim_changes(spark, d)))
    return changes.route_dims(parsed, X.table_list(spark, "dim"))


def _upserted(spark, d, deletes):
    rows = _dim_rows(spark, d)
    first = F.col("offset") < X.SECOND_VERSION
    return changes.upsert_dim(rows.filter(first), rows.filter(~first), deletes=deletes).select(
        "dim_key", "op", "offset", _change_field().alias("field")
    )


def q_upsert_dim(spark, d):
    return _upserted(spark, d, "keep")


def q_upsert_dim_remove(spark, d):
    return _upserted(spark, d, "remove")


# -- dimensions and scalars


def q_with_user_dim(spark, d):
    return dims.with_user_dim(
        page_log(spark, d), X.user_info(spark, d), as_of=as_of()
    ).select("mid", "user_id", "ts", "user_gender", "user_age")


def q_with_user_dim_drop(spark, d):
    return dims.with_user_dim(
        info(spark, d),
        X.user_info(spark, d),
        as_of=as_of(),
        on_missing="drop",
        age_type="int",
        salt=4,
    ).select("id", "user_id", "user_gender", "user_age")


def q_with_province_dim(spark, d):
    return dims.with_province_dim(page_log(spark, d), X.base_province(spark, d)).select(
        "mid", "ts", "province_id", *dims.PROVINCE_NAMES["dau"].values()
    )


def q_age_years(spark, d):
    return X.user_info(spark, d, misses=False).select(
        "id", "birthday", age_years("birthday", as_of()).alias("age")
    )


def q_time_parts(spark, d):
    return time_parts(page_log(spark, d)).select("mid", "ts", "dt", "hr")


def q_create_parts(spark, d):
    return create_parts(info(spark, d, misses=False)).select("id", "create_time", "create_date", "create_hour")


# -- daily active devices


def q_dau_wide(spark, d):
    return dau_wide(
        page_log(spark, d), X.user_info(spark, d), X.base_province(spark, d), as_of()
    )


def q_rebuild_seen(spark, d):
    rows = visits(spark, d)
    seen = rows.filter(F.col("page_id") < "page_5").select("dt", "mid")
    return dau.rebuild_seen(rows, seen).select("dt", "mid", "ts", "page_id")


def _stored_dau(spark, d):
    path = scratch(spark, "dau_docs")
    write_docs(q_dau_wide(spark, d), path, DAU_KEYS, ["ts"], 0, "dt")
    return path


def q_read_sink_field(spark, d):
    path = _stored_dau(spark, d)
    return read_sink_field(spark, path, S.DAU_INFO, DAU_KEYS, "2024-01-10", "mid")


def q_partition_counts(spark, d):
    """Rows of each partition before and after the dedup, dealt out by time."""
    dealt = lambda df, n: df.repartitionById(n, F.pmod("ts", F.lit(n)).cast("int"))
    counted = lambda df, n, stage: dau.partition_counts(dealt(df, n)).select(
        F.lit(stage).alias("stage"), "partition", "rows"
    )
    before = counted(page_log(spark, d), 5, "before")
    return before.unionByName(counted(visits(spark, d), 3, "after"))


def q_split_by_day(spark, d):
    rows = split_by_day(q_dau_wide(spark, d), "dt", "dau_info")
    return rows.groupBy("index_name").agg(F.count("*").alias("docs"))


# -- orders


def q_order_batch_join(spark, d):
    return orders.order_batch_join(info(spark, d), detail(spark, d)).select(
        "order_id",
        F.col("info.id").alias("header_id"),
        F.col("info.total_amount").alias("total_amount"),
        F.col("detail.id").alias("line_id"),
        F.col("detail.order_price").alias("order_price"),
    )


def q_order_wide_join(spark, d):
    return orders.order_wide_join(info(spark, d), detail(spark, d)).select(
        F.col("info.id").alias("header_id"),
        F.col("detail.id").alias("line_id"),
        F.col("detail.sku_id").alias("sku_id"),
        F.col("detail.order_price").alias("order_price"),
        _ms("info.arrival").alias("header_ms"),
        _ms("detail.arrival").alias("line_ms"),
    )


def q_order_wide_join_salted(spark, d):
    return orders.order_wide_join(info(spark, d), detail(spark, d), salt=4).select(
        F.col("info.id").alias("header_id"),
        F.col("detail.id").alias("line_id"),
        F.col("detail.order_price").alias("order_price"),
    )


LINE = ["id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "create_time"]


def q_pending_details(spark, d):
    return orders.pending_details(info(spark, d), detail(spark, d)).select(*LINE)


def q_pending_orders(spark, d):
    return orders.pending_orders(info(spark, d), detail(spark, d)).select(
        "id", "user_id", "total_amount", "create_time"
    )


def q_distinct_pending(spark, d):
    pending = orders.pending_details(info(spark, d), detail(spark, d))
    # Some lines are delivered again, later.
    again = pending.filter("id % 3 = 0").withColumn("arrival", F.expr("arrival + INTERVAL 1 HOUR"))
    return orders.distinct_pending(pending.unionByName(again)).select(*LINE)


def q_merge_order_wide(spark, d):
    joined = orders.order_batch_join(create_parts(info(spark, d)), detail(spark, d))
    return orders.merge_order_wide(joined)


def q_order_wide(spark, d):
    return order_wide(
        info(spark, d),
        detail(spark, d),
        X.user_info(spark, d),
        X.base_province(spark, d),
        as_of(),
    )


def q_upsert_docs(spark, d):
    lines = X.order_detail(spark, d)
    late = F.col("arrival") >= F.lit("1997-01-01").cast("timestamp")
    return upsert_docs(lines.filter(~late), lines.filter(late), ["id"], X.DETAIL_ORDER).select(
        "id", "sku_id", "order_price", "sku_num", _ms("arrival").alias("line_ms")
    )


# -- offsets and counts


def q_starting_offsets(spark, d):
    msgs = X.raw_log(spark, d)
    ledger = offset_ledger(msgs.filter("offset % 2 = 0"), "log_split", 0).unionByName(
        offset_ledger(msgs, "log_split", 1)
    )
    # The topic has one more partition, which never had a message.
    return starting_offsets(ledger, S.LOG_TOPIC, "log_split", [0, 1, 2, 3])


# -- streams: message files in, all input read, results read back


# Micro-batches of a stream of message files, and the least files that each of them reads.
BATCHES, FILES = 4, 4
# Row groups of 8 MB: several tasks of a micro-batch can read one file.
_MESSAGE_FILES = {"compression": "zstd", "parquet.block.size": 8 << 20}
# A task keeps a file of each slice open, without a sort of its messages, and shuffle files go with the write.
_ONE_PASS = {key: SETTINGS[key] for key in ("spark.sql.maxConcurrentOutputFileWriters", FREE)}


def _sent(spark, *frames, mixed=False):
    """Each frame as a stream of message files, cut into BATCHES micro-batches by time, or by
    the hash of the messages if `mixed`.

    All streams are in one session with the jobs' settings; the number of shuffle
    partitions is the caller's.
    """
    own = spark.newSession()
    for key, value in [*SETTINGS.items(), (PARTITIONS, spark.conf.get(PARTITIONS))]:
        own.conf.set(key, value)
    streams = []
    for msgs in frames:
        path = scratch(spark, "messages")
        msgs = msgs.select(*[F.col(f.name).cast(f.dataType) for f in S.MESSAGE])
        at = F.unix_micros("timestamp")
        if mixed:
            slice_ = F.pmod(F.xxhash64("offset", "value"), F.lit(BATCHES)).cast("int")
        else:
            with _settings(spark, _ONE_PASS):
                lo, hi = msgs.agg(F.min(at), F.max(at)).head()
            width = ((hi or 0) - (lo or 0)) // BATCHES + 1
            slice_ = F.floor((at - F.lit(lo or 0)) / width).cast("int")
        files = _deal_slices(msgs.withColumn("slice", slice_), path)
        if files is None:
            cutting, whole, path = _cutting(spark), path, scratch(spark, "messages")
            sliced = T.StructType([*S.MESSAGE.fields, T.StructField("slice", T.IntegerType())])
            some = lambda files, whole=whole: cutting.read.schema(sliced).option("basePath", whole).parquet(*files)
            files = _write_slices(some([whole]), path, some)
        streams.append(read_topic_files(own, f"{path}/slice=*", files))
    free_shuffles(spark)
    return streams


@contextlib.contextmanager
def _settings(spark, settings):
    """The session with these settings, for a while."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _deal_slices(msgs, path) -> int | None:
    """Write the slices of the messages in one pass, each task into a file for each slice, and
    give the number of files of each: the same for all, as a slice with fewer gets files without rows.

    The stream reads the oldest file first, so the files of a slice are dated later than those of the one
    before. None where the file system does not keep such dates.
    """
    spark = msgs.sparkSession
    with _settings(spark, _ONE_PASS):
        msgs.filter("slice IS NOT NULL").write.options(**_MESSAGE_FILES).partitionBy("slice").parquet(path)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    named = [(x.getPath().getName(), x.getPath()) for x in fs.listStatus(root)]
    of = {int(name.removeprefix("slice=")): at for name, at in named if name.startswith("slice=")}
    if not of:  # no messages: one file without rows
        spark.createDataFrame([], S.MESSAGE).coalesce(1).write.parquet(f"{path}/slice=0")
        return 1
    parts = lambda at: [x for x in fs.listStatus(at) if x.getPath().getName().endswith(".parquet")]
    files = max(len(parts(at)) for at in of.values())
    if any(len(parts(at)) < files for at in of.values()):
        none = scratch(spark, "none")
        spark.createDataFrame([], S.MESSAGE).coalesce(1).write.parquet(none)
        (empty,) = parts(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(none))
        copy = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy
        for at in of.values():
            for n in range(files - len(parts(at))):
                to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at, f"none-{n}.parquet")
                copy(fs, empty.getPath(), fs, to, False, spark.sparkContext._jsc.hadoopConfiguration())
    newest = max(x.getModificationTime() for at in of.values() for x in parts(at)) // 1000
    for nth, at in of.items():
        dated = (newest - len(of) + sorted(of).index(nth)) * 1000
        for x in parts(at):
            fs.setTimes(x.getPath(), dated, -1)
        if any(x.getModificationTime() != dated for x in parts(at)):
            return None
    return files


def _cutting(spark):
    """A session whose reads have a task for each file, or for each 128 MB of a larger one."""
    found = spark.newSession()
    for key in ("maxPartitionBytes", "openCostInBytes"):
        found.conf.set(f"spark.sql.files.{key}", "128m")
    found.conf.set(PARTITIONS, spark.conf.get(PARTITIONS))
    return found


def _write_slices(msgs, path, some=None) -> int:
    """Write the slices of the messages one after the other, which the stream reads in that
    order, and give the number of files of each: the same for all, more for more messages.

    `some` reads the messages of some of their files, for messages out of files: a slice is
    read out of those that hold rows of it, so that its tasks can be merged without a shuffle.
    """
    spark = msgs.sparkSession
    where = [F.input_file_name().alias("file"), F.spark_partition_id().alias("task")]
    held = msgs.select("slice", *where).filter("slice IS NOT NULL").groupBy("slice", "file", "task").count().collect()
    counts, tasks, of = {}, {}, {}
    for r in held:
        counts[r.slice] = counts.get(r.slice, 0) + r["count"]
        tasks.setdefault(r.slice, set()).add(r.task)
        of.setdefault(r.slice, set()).add(r.file)
    usual = sorted(map(len, tasks.values()))[(len(tasks) - 1) // 2] if tasks else 1
    files = max(1, min([max(FILES, usual * 3 // 4), *counts.values()]))
    for nth in sorted(counts) or [0]:
        rows = some(sorted(of[nth])) if some and nth in of else msgs
        part, at = rows.filter(F.col("slice") == nth).drop("slice"), f"{path}/slice={nth}"
        write = lambda df: df.write.mode("overwrite").options(**_MESSAGE_FILES).parquet(at)
        enough = len(tasks.get(nth, ())) >= files
        if enough:
            write(part.coalesce(files))
        if not enough or len(spark.read.parquet(at).inputFiles()) != files:
            # A task without rows writes no file: these have as many tasks as rows at the least.
            few = counts.get(nth, 0) < 1000 * files
            write((part.coalesce(1) if few else part).repartition(files))
    return files


def _run(query, least=BATCHES):
    """Wait until all input is read, and see that it came in several micro-batches."""
    while not query.awaitTermination(FREE_EVERY):
        free_shuffles(SparkSession.active())
    ran = [p for p in query.recentProgress if p.numInputRows]
    if len(ran) < min(least, 2):
        raise RuntimeError(f"{len(ran)} micro-batches ran")


def _page_messages(spark, d):
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    return X.page_log_messages(spark, d).select(
        F.lit(None).cast("string").alias("key"),
        "value",
        F.lit(S.PAGE_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        ts.alias("offset"),
        F.timestamp_millis(ts).alias("timestamp"),
    )


def q_stream_log_split(spark, d):
    out, ck = scratch(spark, "topics"), scratch(spark, "ck")
    (msgs,) = _sent(spark, X.raw_log(spark, d))
    _run(jobs.run_log_split(msgs, {"path": out}, ck, trigger=ALL_INPUT))
    schema = "key string, value string, topic string, batch_id long"
    sent = spark.read.schema(schema).parquet(out)
    return _message_fields(sent.filter(F.col("topic") != S.BAD_TOPIC))


def _change_split(spark, d):
    lists, out, stored = (scratch(spark, n) for n in ("lists", "facts", "dims"))
    X.lists(spark).write.parquet(lists)
    (msgs,) = _sent(spark, X.change_log(spark, d))
    _run(
        jobs.run_change_split(
            msgs, lists, {"path": out}, stored, scratch(spark, "ck"), trigger=ALL_INPUT
        )
    )
    return out, stored


def q_read_committed(spark, d):
    """Messages of a batch that was sent in part, then whole, and some of it by two tasks."""
    topic, commits = scratch(spark, "topic"), scratch(spark, "commits")
    msgs = logs.fan_out(log(spark, d))
    failed = stamp(msgs.filter(F.col("topic") == S.PAGE_TOPIC), "log_split", "failed", 0)
    message_columns(failed).write.parquet(f"{topic}/sent=0")
    message_columns(stamp(msgs, "log_split", "whole", 0)).write.parquet(f"{topic}/sent=1")
    twice = spark.read.parquet(f"{topic}/sent=1").filter(F.col("topic") == S.DISPLAY_TOPIC)
    twice.write.parquet(f"{topic}/sent=2")
    commit(spark, commits, "log_split", "whole", 0)
    sent = spark.read.schema(f"topic string, key string, value string, headers {HEADERS}").parquet(topic)
    return _message_fields(read_committed(sent, read_commits(spark, commits)))


def q_stream_change_commits(spark, d):
    """Facts of the committed batches, where one more batch failed after its facts were written."""
    lists, out, stored, commits = (scratch(spark, n) for n in ("lists", "facts", "dims", "commits"))
    X.lists(spark).write.parquet(lists)
    (msgs,) = _sent(spark, X.change_log(spark, d))
    ck = scratch(spark, "ck")
    _run(jobs.run_change_split(msgs, lists, {"path": out}, stored, ck, commits=commits, trigger=ALL_INPUT))
    schema = f"key string, value string, headers {HEADERS}, topic string, batch_id long"
    # In the job's session, whose settings hold for what a job writes.
    sent = msgs.sparkSession.read.schema(schema).parquet(out)
    write_topic(sent, {"path": out}, last_committed(spark, commits) + 1)
    return _fact_fields(visible(spark.read.schema(schema).parquet(out), read_commits(spark, commits)))


def q_stream_change_facts(spark, d):
    facts, _ = _change_split(spark, d)
    schema = "key string, value string, topic string, batch_id long"
    return _fact_fields(spark.read.schema(schema).parquet(facts))


def q_stream_change_dims(spark, d):
    _, stored = _change_split(spark, d)
    return read_dims(spark, stored).select(
        "dim_key", "op", "offset", _change_field().alias("field")
    )


def q_stream_dau_late(spark, d):
    """The same visits from messages in the order of a hash: most come days late."""
    return q_stream_dau(spark, d, mixed=True)


def q_stream_dau(spark, d, mixed=False):
    out, stored = scratch(spark, "dau"), scratch(spark, "dims")
    write_dims(_dim_rows(spark, d), stored, 0)
    (msgs,) = _sent(spark, _page_messages(spark, d), mixed=mixed)
    ck = scratch(spark, "ck")
    _run(jobs.run_dau(msgs, stored, out, ck, as_of=as_of(), trigger=ALL_INPUT))
    # Columns that do not depend on which page of the day arrived first.
    return read_docs(spark, out, S.DAU_INFO, DAU_KEYS).select(
        "dt", "mid", "user_id", "user_gender", "user_age", "province_name"
    )


def q_stream_stage_counts(spark, d):
    """Counts of the stages of a running job, summed over the table of its micro-batches."""
    out, stored, path = (scratch(spark, n) for n in ("dau", "dims", "metrics"))
    write_dims(_dim_rows(spark, d), stored, 0)
    (msgs,) = _sent(spark, _page_messages(spark, d))
    own = msgs.sparkSession
    table = MetricTable(own, path, ["dau"])
    own.streams.addListener(table)
    try:
        ck = scratch(spark, "ck")
        _run(jobs.run_dau(msgs, stored, out, ck, as_of=as_of(), name="dau", trigger=ALL_INPUT))
        if not table.ended.wait(120):
            raise RuntimeError("the listener has not heard of the query's end")
    finally:
        own.streams.removeListener(table)
    total = lambda name: F.sum(F.when(F.col("metric") == name, F.col("value"))).alias(name)
    return read_metrics(spark, path).agg(total("pages"), total("first_pages"), total("first_visits"))


def q_stream_order_join(spark, d):
    out = scratch(spark, "joined")
    headers, lines = _sent(
        spark, X.order_info_messages(spark, d), X.order_detail_messages(spark, d)
    )
    headers = create_parts(parse.parse_order_info(headers))
    lines = parse.parse_order_detail(lines)
    wide = orders.merge_order_wide(orders.order_wide_join(headers, lines, salt=2))
    writer = wide.writeStream.option("checkpointLocation", scratch(spark, "ck"))
    _run(writer.format("parquet").option("path", out).trigger(**ALL_INPUT).start())
    return spark.read.schema(S.ORDER_WIDE).parquet(out)


def _joining(spark, d):
    """Checkpoint of the order join over all headers and lines, none of which has expired."""
    ck = scratch(spark, "ck")
    headers, lines = _sent(
        spark, X.order_info_messages(spark, d), X.order_detail_messages(spark, d)
    )
    # Read as a whole right after: out of snapshots, without going over the changes of all batches again.
    headers.sparkSession.conf.set(CHANGELOG, "false")
    # Files that a later batch's state has merged go while the query runs.
    headers.sparkSession.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    joined = orders.order_wide_join(
        parse.parse_order_info(headers), parse.parse_order_detail(lines), "10000 days", salt=2
    )
    writer = joined.writeStream.option("checkpointLocation", ck).format("noop")
    _run(writer.trigger(**ALL_INPUT).start())
    return ck


def q_stream_pending_details(spark, d):
    return held_pending(spark, _joining(spark, d), "detail").select(*LINE)


def q_stream_pending_orders(spark, d):
    return held_pending(spark, _joining(spark, d), "info").select(
        "id", "user_id", "total_amount", "create_time"
    )


def _order_docs(spark, d, mixed=False):
    """Documents of the order job over all headers and lines."""
    out, stored = scratch(spark, "orders"), scratch(spark, "dims")
    write_dims(_dim_rows(spark, d), stored, 0)
    headers, lines = _sent(
        spark, X.order_info_messages(spark, d), X.order_detail_messages(spark, d), mixed=mixed
    )
    _run(
        jobs.run_order_wide(
            headers, lines, stored, out, scratch(spark, "ck"), as_of=as_of(), trigger=ALL_INPUT
        )
    )
    return out


def q_stream_order_late(spark, d):
    """The same documents from messages in the order of a hash: most come years late."""
    return q_stream_order_wide(spark, d, mixed=True)


def q_stream_order_wide(spark, d, mixed=False):
    cells = ["detail_id", "create_date", "order_id", "user_gender", "user_age", "province_name"]
    path, columns = _order_docs(spark, d, mixed), [*cells, "line_arrival"]
    docs = read_docs(spark, path, S.ORDER_DOC, jobs.ORDER_KEYS, columns=columns, order_by=jobs.ORDER_LAST)
    return docs.select(*cells, _ms("line_arrival").alias("line_ms"))


def q_compact_docs(spark, d):
    """Two batches of documents, the second over the first, folded into a snapshot."""
    path, row = scratch(spark, "docs"), S.DAU_INFO
    wide = q_dau_wide(spark, d)
    write_docs(wide.withColumn("page_id", F.lit("old")), path, DAU_KEYS, ["ts"], 0)
    write_docs(wide, path, DAU_KEYS, ["ts"], 1)
    compact_docs(spark, path, row, DAU_KEYS)
    return read_docs(spark, path, row, DAU_KEYS)


def q_compact_dims(spark, d):
    path = scratch(spark, "dims")
    rows = _dim_rows(spark, d)
    first = F.col("offset") < X.SECOND_VERSION
    write_dims(rows.filter(first), path, 0)
    compact_dims(spark, path)
    write_dims(rows.filter(~first), path, 1)
    compact_dims(spark, path)
    return read_dims(spark, path).select("dim_key", "op", "offset", _change_field().alias("field"))


def _in_utc(query):
    """Queries cut days in UTC, whatever zone the caller's session had."""

    @functools.wraps(query)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        # Thousands of daily folders are listed by few tasks and not by one each.
        spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "32")
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    return {name: _in_utc(query) for name, query in _queries().items()}


def _queries() -> dict:
    return {
        "parse_log": q_parse_log,
        "parse_change": q_parse_change,
        "quarantine": q_quarantine,
        "route_error": q_route_error,
        "route_page": lambda s, d: logs.route_page(log(s, d)),
        "route_start": lambda s, d: logs.route_start(log(s, d)),
        "explode_displays": lambda s, d: logs.explode_displays(log(s, d)),
        "explode_actions": lambda s, d: logs.explode_actions(log(s, d)),
        "fan_out": q_fan_out,
        "to_message": q_to_message,
        "map_op": q_map_op,
        "route_facts": q_route_facts,
        "route_dims": q_route_dims,
        "upsert_dim": q_upsert_dim,
        "upsert_dim_remove": q_upsert_dim_remove,
        "with_user_dim": q_with_user_dim,
        "with_user_dim_drop": q_with_user_dim_drop,
        "with_province_dim": q_with_province_dim,
        "age_years": q_age_years,
        "time_parts": q_time_parts,
        "create_parts": q_create_parts,
        "parse_page_log": page_log,
        "first_pages": lambda s, d: dau.first_pages(page_log(s, d)),
        "daily_first_visit": visits,
        "dau_wide": q_dau_wide,
        "rebuild_seen": q_rebuild_seen,
        "read_sink_field": q_read_sink_field,
        "split_by_day": q_split_by_day,
        "stage_counts": lambda s, d: dau.stage_counts(page_log(s, d)),
        "partition_counts": q_partition_counts,
        "parse_order_info": lambda s, d: info(s, d, misses=False).withColumn("arrival", _ms("arrival")),
        "parse_order_detail": lambda s, d: detail(s, d).withColumn("arrival", _ms("arrival")),
        "order_batch_join": q_order_batch_join,
        "order_wide_join": q_order_wide_join,
        "order_wide_join_salted": q_order_wide_join_salted,
        "pending_details": q_pending_details,
        "pending_orders": q_pending_orders,
        "distinct_pending": q_distinct_pending,
        "copy_matching": lambda s, d: copy_matching(page_log(s, d), S.DAU_INFO),
        "merge_order_wide": q_merge_order_wide,
        "order_wide": q_order_wide,
        "upsert_docs": q_upsert_docs,
        "starting_offsets": q_starting_offsets,
        "batch_offsets": lambda s, d: batch_offsets(X.raw_log(s, d)),
        "stream_log_split": q_stream_log_split,
        "stream_change_facts": q_stream_change_facts,
        "stream_change_dims": q_stream_change_dims,
        "stream_dau": q_stream_dau,
        "stream_order_join": q_stream_order_join,
        "stream_order_wide": q_stream_order_wide,
        "stream_order_late": q_stream_order_late,
        "stream_pending_details": q_stream_pending_details,
        "stream_pending_orders": q_stream_pending_orders,
        "stream_dau_late": q_stream_dau_late,
        "stream_stage_counts": q_stream_stage_counts,
        "stream_change_commits": q_stream_change_commits,
        "read_committed": q_read_committed,
        "quarantine_change": q_quarantine_change,
        "quarantine_page": q_quarantine_page,
        "quarantine_order": q_quarantine_order,
        "order_wide_bad": q_order_wide_bad,
        "dau_wide_bad": q_dau_wide_bad,
        "compact_docs": q_compact_docs,
        "compact_dims": q_compact_dims,
        "offset_ledger": lambda s, d: offset_ledger(X.raw_log(s, d), "log_split", 7),
    }
