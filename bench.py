"""Times the headline queries and the four jobs' batch plans; prints one JSON line.

`python bench.py name ...` times other registered queries instead. Queries start from the base tables, so their time includes deriving the messages. The
`job_*` entries run over messages staged beforehand and show the operators alone.
"""

import json
import os
import sys
import tempfile
import time

import catalog
import fixtures as X
from rivermill.functions import parse
from rivermill.operators import changes, logs
from rivermill.plans.wide_tables import dau_wide, order_wide
from rivermill.session import builder
from rivermill.sinks.docs import upsert_docs

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


# Queries that run once are streams; the others run twice and the better time counts.
HEADLINE = (
    "parse_log fan_out route_facts upsert_dim daily_first_visit stage_counts dau_wide "
    "order_batch_join order_wide_join order_wide upsert_docs read_sink_field "
    "stream_log_split stream_change_facts stream_dau stream_order_join stream_order_wide"
).split()


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def stage(spark, folder):
    made = {
        "raw_log": X.raw_log(spark, SF_DIR),
        "page_log": X.page_log_messages(spark, SF_DIR),
        "change_log": X.change_log(spark, SF_DIR),
        "info": X.order_info_messages(spark, SF_DIR),
        "detail": X.order_detail_messages(spark, SF_DIR),
        "lines": X.order_detail(spark, SF_DIR),
        "users": X.user_info(spark, SF_DIR),
        "provinces": X.base_province(spark, SF_DIR),
    }
    for name, df in made.items():
        # Several files, as a topic's partitions would give.
        df.repartition(int(CPUS)).write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in made}


def jobs(spark, at):
    as_of = catalog.as_of()

    def log_split():
        drain(logs.fan_out(parse.parse_log(at["raw_log"]), "BAD"))

    def change_split():
        ops = changes.map_op(parse.parse_change(at["change_log"])).persist()
        drain(changes.route_facts(ops, X.table_list(spark, "fact")))
        drain(changes.upsert_dim(None, changes.route_dims(ops, X.table_list(spark, "dim"))))
        ops.unpersist()

    def dau():
        pages = parse.parse_page_log(at["page_log"])
        drain(dau_wide(pages, at["users"], at["provinces"], as_of))

    def orders():
        info = parse.parse_order_info(at["info"])
        detail = parse.parse_order_detail(at["detail"])
        drain(order_wide(info, detail, at["users"], at["provinces"], as_of))

    def upsert():
        drain(upsert_docs(None, at["lines"], ["id"], X.DETAIL_ORDER))

    return {
        "job_log_split": log_split,
        "job_change_split": change_split,
        "job_dau": dau,
        "job_order_wide": orders,
        "job_upsert_docs": upsert,
    }


def main():
    spark = (
        builder("bench")
        .master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    runs = jobs(spark, stage(spark, folder))
    every = catalog.queries()
    for name in sys.argv[1:] or HEADLINE:
        query = every[name]
        runs[name] = lambda query=query: drain(query(spark, SF_DIR))
    took = {}
    for name, run in runs.items():
        best = None
        for _ in range(1 if name.startswith("stream_") else 2):
            started = time.perf_counter()
            run()
            seconds = time.perf_counter() - started
            best = seconds if best is None else min(best, seconds)
        took[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
