"""One commit for all sinks of a batch, stamped messages, and observed counts as a table."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from streams import NOW, append_file, finish

import catalog as C
import fixtures as X
from rivermill import schemas as S
from rivermill.sinks import commits as K
from rivermill.sinks.docs import write_dims
from rivermill.sources.stores import fold, read_store
from rivermill.sources.topics import read_topic_files, stamped_options
from rivermill.streaming import jobs
from rivermill.streaming.metrics import metric_rows

SENT = f"key string, value string, headers {K.HEADERS}, topic string, batch_id long"
MESSAGES = "topic string, key string, value string"


def messages(spark, *values):
    return spark.createDataFrame([("t", None, v) for v in values], MESSAGES)


def commits_of(spark, *committed):
    return spark.createDataFrame(list(committed), K.COMMIT)


def test_an_attempt_without_a_commit_does_not_count(spark):
    failed = K.stamp(messages(spark, "a"), "p", "first", 7)
    whole = K.stamp(messages(spark, "a", "b"), "p", "second", 7)
    sent = failed.unionByName(whole)
    assert K.read_committed(sent, commits_of(spark)).count() == 0
    got = K.read_committed(sent, commits_of(spark, ("p", "second", 7)))
    assert rows(got, "value", "batch_id") == [("a", 7), ("b", 7)]
    # Another producer's batch of that number is not this one.
    assert K.read_committed(sent, commits_of(spark, ("q", "second", 7))).count() == 0


@pytest.mark.parametrize("salt", [1, 8])
def test_what_a_task_sent_again_counts_once_and_equal_messages_all_count(spark, salt):
    once = K.stamp(messages(spark, "a", "a", None, "b").coalesce(1), "p", "x", 0)
    sent = once.unionByName(once)
    got = K.read_committed(sent, commits_of(spark, ("p", "x", 0), ("p", "x", 0)), salt)
    assert rows(got, "value") == [(None,), ("a",), ("a",), ("b",)]


def test_the_same_place_with_another_text_is_another_message(spark):
    one, other = (K.stamp(messages(spark, v).coalesce(1), "p", "x", 0) for v in ("a", "b"))
    got = K.read_committed(one.unionByName(other), commits_of(spark, ("p", "x", 0)))
    assert rows(got, "value") == [("a",), ("b",)]


def test_unstamped_and_odd_headers_belong_to_no_batch(spark):
    none = F.lit(None).cast(K.HEADERS)
    odd = F.array(F.struct(F.lit("batch_id").alias("key"), F.lit("x").cast("binary").alias("value")))
    plain = messages(spark, "a")
    sent = plain.withColumn("headers", none).unionByName(plain.withColumn("headers", odd))
    assert K.read_committed(sent, commits_of(spark, ("p", "x", 0))).count() == 0


def test_headers_are_asked_of_the_topic():
    given = stamped_options("t", {"kafka.bootstrap.servers": "h:1"})
    assert given["includeHeaders"] == "true" and given["startingOffsets"] == "earliest"


def test_a_failure_between_two_sinks_shows_neither(spark, sf, tmp_path, monkeypatch):
    lists, out, dims, ledger, commits = (f"{tmp_path}/{n}" for n in ("lists", "facts", "dims", "ledger", "commits"))
    X.lists(spark).write.parquet(lists)
    msgs = X.change_log(spark, sf)
    for nth in range(2):
        append_file(msgs.filter(F.col("offset") % 2 == nth), f"{tmp_path}/in")

    def run():
        stream = read_topic_files(spark, f"{tmp_path}/in", 1)
        return jobs.run_change_split(stream, lists, {"path": out}, dims, f"{tmp_path}/ck", ledger, commits=commits, trigger=NOW)

    def failing(rows_, path, batch_id):
        if batch_id == 1:
            raise RuntimeError("the second sink is down")
        write_dims(rows_, path, batch_id)

    monkeypatch.setattr(jobs, "write_dims", failing)
    with pytest.raises(Exception, match="second sink is down"):
        finish(run())
    facts = spark.read.schema(SENT).parquet(out)
    assert {r.batch_id for r in facts.select("batch_id").distinct().collect()} == {0, 1}
    done = K.read_commits(spark, commits)
    assert {r.batch_id for r in K.visible(facts, done).select("batch_id").distinct().collect()} == {0}
    assert {r.batch_id for r in read_store(spark, ledger, S.LEDGER, commits=done).collect()} == {0}

    monkeypatch.setattr(jobs, "write_dims", write_dims)
    finish(run())
    done = K.read_commits(spark, commits)
    facts = K.visible(spark.read.schema(SENT).parquet(out), done)
    assert rows(C._fact_fields(facts)) == rows(C.q_stream_change_facts(spark, sf))
    assert {r.batch_id for r in read_store(spark, ledger, S.LEDGER, commits=done).collect()} == {0, 1}
    # The commit names the attempt whose messages are there.
    assert K.read_committed(facts, done).count() == facts.count()


def test_a_committed_batch_is_not_sent_again(spark, sf, tmp_path):
    out, commits = f"{tmp_path}/topics", f"{tmp_path}/commits"
    sent = []
    for _ in range(2):
        jobs._once(spark, commits, "p", 3, lambda stamped: sent.append(stamped))
    assert len(sent) == 1 and K.is_committed(spark, commits, 3) and not K.is_committed(spark, commits, 2)
    assert K.last_committed(spark, out) == -1 and K.last_committed(spark, commits) == 3


def test_folding_leaves_out_what_is_not_committed(spark, tmp_path):
    path, commits = f"{tmp_path}/ledger", f"{tmp_path}/commits"
    for n in range(3):
        jobs.append_ledger(spark.createDataFrame([("t", "g", 0, n, n)], S.LEDGER), path, n)
    for n in (0, 2):
        K.commit(spark, commits, "g", "x", n)
    K.commit(spark, f"{tmp_path}/other", "g", "x", 0)
    done = K.read_commits(spark, commits)
    assert fold(spark, path, S.LEDGER, lambda df: df, commits=K.read_commits(spark, f"{tmp_path}/other")) == 0
    assert rows(read_store(spark, path, S.LEDGER, commits=done), "offset") == [(0,), (2,)]
    assert fold(spark, path, S.LEDGER, lambda df: df, commits=done) == 2
    assert rows(read_store(spark, path, S.LEDGER, commits=done), "offset") == [(0,), (2,)]


def test_a_batch_without_counts_has_no_rows(spark):
    row = spark.createDataFrame([(2, None)], "a long, b long").head()
    assert metric_rows({"s": row}, "q", 4) == [("q", "s", "a", 2, 4)]
    assert metric_rows({}, "q", 4) == []
