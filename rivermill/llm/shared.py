"""Shared folder for intermediate tables, and text batches as numpy arrays.

Words are maximal runs of bytes other than space and 0x09-0x0D. These are single bytes in
UTF-8, so word boundaries are found on bytes, a batch of texts at a time.
"""

from __future__ import annotations

import atexit
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text that are turned into arrays at once; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Words of more bytes are hashed one by one.
LANE_BYTES = 256


# -- intermediate tables -------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Where it is unset, a local session gets a temporary folder; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="rivermill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when this driver ends."""
    path = f"{shared_dir(spark)}/rivermill/{uuid.uuid4().hex}-{name}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if spark.sparkContext._jsc is None or jvm is None:
        return
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: it cuts the lineage, survives
    lost executors, and gives the planner true sizes."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- Bloom filters of bounded size ---------------------------------------------------

#: Bits of a filter for each key, and the most that it has in all (32 MB).
BITS_PER_KEY, MOST_BITS = 16, 1 << 28
#: Bits in one row of a broadcast filter; all bits of a key lie in the same row.
PART_BITS = 1 << 16
SEEDS = (11, 23, 47)


def bloom_parts(keys: int, most_bits: int = MOST_BITS) -> int:
    return min(most_bits, BITS_PER_KEY * keys) // PART_BITS + 1


def bloom_part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def bloom_bits(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(s)), F.lit(PART_BITS)).cast("int") for s in SEEDS])


def pack_bloom(bits: DataFrame) -> DataFrame:
    """(part, flags): the set bits (part, bit) packed in longs, a row of 8 KB for each part."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(PART_BITS, np.uint8)
        flags[group["bit"].to_numpy()] = 1
        return pd.DataFrame({"part": [key[0]], "flags": [np.packbits(flags, bitorder="little").view("<i8")]})

    return materialise(bits.groupBy("part").applyInPandas(pack, "part int, flags array<bigint>"), "filter")


def in_bloom(bits: Column, flags: Column) -> Column:
    """Whether all bits are set; false where the part has no flags."""
    found = F.lit(True)
    for i in range(len(SEEDS)):
        found = found & (F.getbit(F.get(flags, F.shiftright(bits[i], 6)), bits[i] % 64) == 1)
    return F.coalesce(found, F.lit(False))


def split_by_keys(df: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among keys, rows whose key is not), without a shuffle of df.

    keys has one column. Its Bloom filter is broadcast, of at most MOST_BITS bits: beyond
    that more rows count as maybe, so an exact join of those has to follow at any size.
    """
    name = keys.columns[0]
    parts = bloom_parts(keys.count())
    marked = keys.select(bloom_part(F.col(name), parts).alias("part"), F.explode(bloom_bits(F.col(name))).alias("bit"))
    bloom = pack_bloom(marked.distinct())
    both = df.join(F.broadcast(bloom), bloom_part(key, parts) == bloom["part"], "left")
    maybe = in_bloom(bloom_bits(key), bloom["flags"])
    columns = [df[c] for c in df.columns]
    return both.filter(maybe).select(*columns), both.filter(~maybe).select(*columns)


def grouped(rows: DataFrame, key: str, solve: Callable[[pa.Table], Sequence[np.ndarray | pa.Array]], schema: str) -> DataFrame:
    """Apply solve, from a table to arrays, to the rows of each key, which lie together in a
    task and pass it one key after the other."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solved(table: pa.Table) -> pa.RecordBatch:
            out = solve(table)
            return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out], names)

        for batch in batches:
            keys = batch.column(key).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(lo, hi - lo)
                if held and held[0].column(key)[0].as_py() != part.column(key)[0].as_py():
                    yield solved(pa.Table.from_batches(held).combine_chunks())
                    held = []
                if len(part):
                    held.append(part)
        if held:
            yield solved(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def words_in(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# -- batches of texts ----------------------------------------------------------------


@dataclass
class Texts:
    """Some texts end to end: text i has words first[i] to first[i+1], word w has bytes
    start[w] to end[w] of data."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode("utf-8")

    def without(self, left_out: np.ndarray) -> Texts:
        """The same texts, those that are left out being without words."""
        sizes = np.diff(self.first)
        kept = ~np.repeat(left_out, sizes)
        first = np.concatenate([[0], np.cumsum(np.where(left_out, 0, sizes))])
        return Texts(self.data, self.offsets, self.start[kept], self.end[kept], first)

    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes; words of up to eight bytes with the same
        length never share one."""
        return self._chained([_STEP])[0]

    def word_names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of each word, a name of 128 bits together."""
        first, second = self._chained([_STEP, _BASE])
        return first, second

    def distinct_words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different words: the first hash of each in ascending order, its second hash, a
        word that has them; and of every word which of these it is."""
        names, checks = self.word_names()
        keys, at, which = np.unique(names, return_index=True, return_inverse=True)
        if not np.array_equal(checks, checks[at][which]):  # two words share half a name
            order = np.lexsort((checks, names))
            new = np.ones(len(order), bool)
            new[1:] = (names[order][1:] != names[order][:-1]) | (checks[order][1:] != checks[order][:-1])
            at, which = order[new], np.empty(len(order), np.int64)
            which[order] = np.cumsum(new) - 1
            keys = names[at]
        return keys, checks[at], at, which

    def _chained(self, factors: list[np.uint64]) -> list[np.ndarray]:
        """A hash for each factor: eight bytes after the other are added and mixed in."""
        size = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        lanes = np.ndarray((len(self.data) + 1,), "<u8", buffer=padded, strides=(1,))
        with np.errstate(over="ignore"):
            out = [mix(size.astype(np.uint64) * f + np.uint64(1)) for f in factors]
            which, at = np.arange(len(size)), 0
            while len(which):
                lane = lanes[self.start[which] + at] & _LOW_BYTES[np.minimum(size[which] - at, 8)]
                for h, f in zip(out, factors, strict=True):
                    h[which] = mix((h[which] ^ lane) * f)
                at += 8
                which = which[size[which] > at]
                if at == LANE_BYTES:
                    break
        for w in which.tolist():  # the rest of a very long word
            word = self.data[self.start[w] : self.end[w]].tobytes()
            for k, h in enumerate(out):
                h[w] = np.frombuffer(hashlib.blake2b(word, digest_size=16).digest(), np.uint64)[k]
        return out

    def spans(self, lo: np.ndarray, hi: np.ndarray) -> list[bytes]:
        """The bytes from the start of word lo to the end of word hi - 1."""
        data = self.data.tobytes()
        return [data[a:b] for a, b in zip(self.start[lo].tolist(), self.end[hi - 1].tolist(), strict=True)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words, by the run's first word; runs cross texts."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = words[:n].copy()
        for i in range(1, size):
            acc *= _STEP
            acc += words[i : i + n]
        return mix(acc)


def whole_grams(first: np.ndarray, size: int) -> np.ndarray:
    """Which word positions start a run of `size` words inside one text."""
    last = np.repeat(first[1:], np.diff(first))
    return np.arange(first[-1]) + size <= last


def split_words(data: np.ndarray, offsets: np.ndarray) -> Texts:
    n = len(data)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)
    before[1:] = space[:-1]
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    start = np.flatnonzero(~space & (before | edge[:n]))
    end = np.flatnonzero(~space & (after | edge[1:])) + 1
    return Texts(data, offsets, start, end, np.searchsorted(start, offsets))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Parts (from row, to row, Texts) of a string column; a null counts as an empty text.
    A part has `most` bytes or one row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.cast(pa.string()).fill_null("")
    _, at, data = column.buffers()
    ends = np.frombuffer(at, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, split_words(raw[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo])
        lo = hi


def lists(first: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Values as one list for each text; first has their bounds."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def clean_words(texts: Texts) -> Texts:
    """The words in lower case (ASCII) and without ASCII punctuation at their ends; words of
    nothing else are left out."""
    data = texts.data.copy()
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    solid = (data >= 128) | ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122))
    places = np.arange(len(data))
    last = np.maximum.accumulate(np.where(solid, places, -1)) if len(data) else places
    nxt = np.minimum.accumulate(np.where(solid, places, len(data))[::-1])[::-1] if len(data) else places
    start, end = nxt[texts.start], last[texts.end - 1] + 1
    kept = start < end
    whose = np.repeat(np.arange(len(texts)), np.diff(texts.first))[kept]
    return Texts(data, texts.offsets, start[kept], end[kept], np.searchsorted(whose, np.arange(len(texts) + 1)))
