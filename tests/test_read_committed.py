"""The read of committed messages holds no more of a large input in one task."""

import pytest

from rivermill.sinks import commits as K


@pytest.mark.parametrize("tasks", [2, 8])
def test_the_read_of_committed_messages_is_dealt_by_its_input(spark, tasks):
    msgs = spark.range(0, 400, 1, tasks).selectExpr("'t' AS topic", "cast(NULL AS string) AS key", "cast(id AS string) AS value")
    sent = K.stamp(msgs, "p", "x", 0)
    got = K.read_committed(sent.unionByName(sent), spark.createDataFrame([("p", "x", 0)], K.COMMIT))
    assert got.rdd.getNumPartitions() >= 2 * tasks * K.DEALT
    assert got.count() == 400
