"""Topic options, offsets and the ledger. No connector is installed, so none is run."""

from conftest import rows

import fixtures as X
from rivermill import schemas as S
from rivermill.sinks.topics import (
    SEND_OPTIONS,
    append_ledger,
    ledger_base,
    message_columns,
    offset_ledger,
    progress_ledger,
)
from rivermill.sources.topics import OLDEST, kafka_options, resume_point, starting_offsets


def test_read_options():
    given = {"kafka.bootstrap.servers": "h:1"}
    assert kafka_options("t", given) == {**given, "subscribe": "t", "startingOffsets": "latest"}
    assert kafka_options("t", given, '{"t":{"0":3}}')["startingOffsets"] == '{"t":{"0":3}}'


def test_send_options():
    assert SEND_OPTIONS == {"kafka.acks": "all", "kafka.enable.idempotence": "true"}


def test_keyed_and_unkeyed_messages(spark):
    keyed = spark.createDataFrame([("t", "k", "v", 1)], "topic string, key string, value string, x int")
    assert message_columns(keyed).columns == ["topic", "key", "value"]
    assert message_columns(keyed.drop("key")).columns == ["topic", "value"]


def test_ledger_newest_row_counts(spark):
    ledger = spark.createDataFrame(
        [
            ("t", "g", 0, 5, 1),
            ("t", "g", 0, 9, 3),
            ("t", "g", 0, 7, 2),
            ("t", "g", 10, 4, 1),
            ("t", "other", 0, 99, 9),
            ("u", "g", 0, 1, 1),
        ],
        S.LEDGER,
    )
    assert resume_point(ledger, "t", "g") == '{"t":{"0":9,"10":4}}'
    assert starting_offsets(ledger, "none", "g").count() == 0


def test_ledger_replay_replaces(spark, sf, tmp_path):
    rows_ = offset_ledger(X.raw_log(spark, sf), "g", 4)
    for _ in range(2):
        append_ledger(rows_, f"{tmp_path}/ledger", 4)
    stored = spark.read.schema(S.LEDGER).parquet(f"{tmp_path}/ledger")
    assert rows(stored, *S.LEDGER.names) == rows(rows_)


def test_ledger_out_of_progress(spark):
    progress = [
        {"batchId": 2, "sources": [{"endOffset": '{"t":{"0":5,"1":6}}'}]},
        {"batchId": 3, "sources": [{"endOffset": {"t": {"0": 8}}}, {"endOffset": '{"logOffset":1}'}]},
        {"batchId": 4, "sources": [{"endOffset": None}]},
    ]
    assert rows(progress_ledger(spark, progress, "g")) == [
        ("t", "g", 0, 5, 2),
        ("t", "g", 0, 8, 3),
        ("t", "g", 1, 6, 2),
    ]


def test_rows_of_a_fresh_checkpoint_count_as_newest(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    row = lambda offset, batch: spark.createDataFrame([("t", "g", 0, offset, batch)], S.LEDGER)
    assert ledger_base(spark, path) == 0
    append_ledger(row(50, 7), path, 7)
    base = ledger_base(spark, path)
    append_ledger(row(20, base), path, base)
    assert (base, ledger_base(spark, path)) == (8, 9)
    stored = spark.read.schema(S.LEDGER).parquet(path)
    assert resume_point(stored, "t", "g") == '{"t":{"0":20}}'


def test_partitions_without_rows_are_named(spark):
    ledger = spark.createDataFrame([("t", "g", 1, 5, 1), ("t", "g", 1, 6, 2)], S.LEDGER)
    assert resume_point(ledger, "t", "g", [0, 1, 2]) == '{"t":{"0":-1,"1":6,"2":-1}}'
    assert resume_point(ledger, "t", "g", [0, 1], OLDEST) == '{"t":{"0":-2,"1":6}}'
    assert resume_point(ledger, "t", "other", [0, 1]) is None
