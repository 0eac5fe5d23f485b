"""Message files for file streams, cut in time order."""

import time

from pyspark.sql import functions as F

from rivermill import schemas as S

NOW = {"availableNow": True}


def write_slices(msgs, path, n):
    """n files, each later in message time than the one before."""
    msgs = msgs.select(*[F.col(f.name).cast(f.dataType) for f in S.MESSAGE]).persist()
    lo, hi = msgs.agg(
        F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))
    ).head()
    width = (hi - lo) // n + 1
    for i in range(n):
        part = msgs.filter(
            (F.unix_micros("timestamp") >= lo + i * width)
            & (F.unix_micros("timestamp") < lo + (i + 1) * width)
        )
        append_file(part, path)
    msgs.unpersist()


def append_file(msgs, path):
    """One more file, with a modification time of its own."""
    picked = msgs.select(*[F.col(f.name).cast(f.dataType) for f in S.MESSAGE])
    picked.coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)


def finish(query):
    query.awaitTermination(180)
    assert not query.isActive
    return query
