"""Token ids in files of directly addressable codes.

A file is a sequence of blocks. A block has a header, the ids and positions of its
documents, and the token ids in levels of eight bits: level 0 has the low byte of every
id; a bitmap says which ids go on, and level 1 has the next byte of those alone. A rank
directory counts the set bits before every 512th, so the place of any id in the next
level is one look-up and a few bit counts, and any id can be read without its neighbours.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Texts, materialise, slices
from .token_counts import known_pieces, load

MAGIC = b"RMDAC1\x00\x00"
HEAD = np.dtype([("magic", "S8"), ("bytes", "<u8"), ("docs", "<u8"), ("ids", "<u8"), ("levels", "<u8")])
#: Ids in a block, about; bits for each entry of the rank directory.
BLOCK_IDS, RANK_BITS = 1 << 19, 512
#: Bytes of text that are encoded at once; one longer text makes a part of its own.
SLICE_BYTES = 1 << 19
#: Pieces that a worker remembers, beside the blocks that it builds.
REMEMBERED = 400_000
#: Text bytes that go to one file, about.
FILE_BYTES = 24 << 20
#: Bytes that begin a character other than white space, whatever follows them.
BEGINS = np.zeros(256, bool)
BEGINS[33:127] = BEGINS[0xC3:0xE0] = BEGINS[0xE4:0xF5] = True


# -- the code ------------------------------------------------------------------------


def pack(ids: np.ndarray) -> tuple[bytes, int]:
    """Levels of ids, end to end: count, low bytes, bitmap, rank directory."""
    out, levels, left = [], 0, ids.astype(np.uint64)
    while levels == 0 or len(left):
        more = left > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
        per = np.bitwise_count(bits.view(np.uint64)).reshape(-1, RANK_BITS // 64).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(per)]).astype("<u4")
        out += [np.array([len(left)], "<u8").tobytes(), (left & np.uint64(255)).astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]
        left, levels = left[more] >> np.uint64(8), levels + 1
    return b"".join(out), levels


class Codes:
    """The ids of a block; `codes[at]` gives those at any positions."""

    def __init__(self, data: bytes, at: int, levels: int) -> None:
        self.levels = []
        for _ in range(levels):
            n = int(np.frombuffer(data, "<u8", 1, at)[0])
            low = np.frombuffer(data, np.uint8, n, at + 8)
            size = -(-n // RANK_BITS) * (RANK_BITS // 8)
            bits = np.frombuffer(data, np.uint8, size, at + 8 + n)
            ranks = np.frombuffer(data, "<u4", size // (RANK_BITS // 8) + 1, at + 8 + n + size)
            self.levels.append((low, bits, ranks))
            at += 8 + n + size + ranks.nbytes

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        ids, whose = np.zeros(len(at), np.uint64), np.arange(len(at))
        for level, (low, bits, ranks) in enumerate(self.levels):
            ids[whose] |= low[at].astype(np.uint64) << np.uint64(8 * level)
            on = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            at, whose = at[on], whose[on]
            if not len(at):
                break
            at = rank(bits, ranks, at)
        return ids

    def span(self, lo: int, hi: int) -> np.ndarray:
        """The ids from lo to hi, whose places in each level lie together."""
        ids, whose = np.zeros(hi - lo, np.uint32), slice(None)
        for level, (low, bits, ranks) in enumerate(self.levels):
            ids[whose] |= low[lo:hi].astype(np.uint32) << np.uint32(8 * level)
            if level + 1 == len(self.levels) or lo == hi:
                break
            on = np.flatnonzero(np.unpackbits(bits[lo >> 3 : -(-hi // 8)], bitorder="little")[lo & 7 : (lo & 7) + hi - lo])
            if not len(on):
                break
            whose = on if level == 0 else whose[on]
            lo = int(rank(bits, ranks, np.array([lo]))[0])
            hi = lo + len(on)
        return ids


def rank(bits: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bits are set before each place."""
    words = bits.view("<u8")
    per = RANK_BITS // 64
    found = ranks[at // RANK_BITS].astype(np.int64)
    word, first = at >> 6, at // RANK_BITS * per
    for k in range(per - 1):
        inside = first + k < word
        found[inside] += np.bitwise_count(words[(first + k)[inside]]).astype(np.int64)
    below = words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
    return found + np.bitwise_count(below).astype(np.int64)


def block(doc_ids: np.ndarray, known: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """known: whether a document's id is not null."""
    codes, levels = pack(ids)
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
    body = doc_ids.astype("<i8").tobytes() + known.astype(np.uint8).tobytes() + starts.tobytes() + codes
    head = np.zeros(1, HEAD)
    head[0] = (MAGIC, HEAD.itemsize + len(body), len(doc_ids), len(ids), levels)
    return head.tobytes() + body


def blocks(content: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Codes]]:
    """Of each block of a file: document ids, which are known, positions, and the codes."""
    at = 0
    while at < len(content):
        head = np.frombuffer(content, HEAD, 1, at)[0]
        if head["magic"] != MAGIC.rstrip(b"\x00"):
            raise ValueError("not a block of token ids")
        n, p = int(head["docs"]), at + HEAD.itemsize
        doc_ids, known, starts = np.frombuffer(content, "<i8", n, p), np.frombuffer(content, np.uint8, n, p + 8 * n), np.frombuffer(content, "<u8", n + 1, p + 9 * n)
        yield doc_ids, known == 1, starts.astype(np.int64), Codes(content, p + 9 * n + 8 * (n + 1), int(head["levels"]))
        at += int(head["bytes"]) + 1  # Spark's writer ends each block with a line end


# -- writing and reading -------------------------------------------------------------


def pieces(texts: Texts, special: list[bytes]) -> Texts:
    """The texts cut before each space that begins a word. No token of byte-level BPE reaches
    across such a place; texts that hold a special token's string are left whole."""
    data, size = texts.data, len(texts.data)
    cut = np.zeros(size + 1, bool)
    cut[: size - 1] = (data[:-1] == 32) & BEGINS[data[1:]] if size else False
    cut[np.maximum(texts.offsets[1:] - 1, 0)] = False
    whole = data.tobytes()
    for mark in special:
        at = whole.find(mark)
        while at >= 0:
            k = int(np.searchsorted(texts.offsets, at, "right"))
            cut[texts.offsets[k - 1] : texts.offsets[k]] = False
            at = whole.find(mark, at + 1)
    cut[texts.offsets] = True
    start = np.flatnonzero(cut[:size])
    return Texts(data, texts.offsets, start, np.append(start[1:], size)[: len(start)], np.searchsorted(start, texts.offsets))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, files: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append end_id, and write the ids in ascending order of doc_id.

    tokenizer is the path of a byte-level BPE .json file. A null text is empty and gives
    end_id alone. Null ids come first; rows with the same id are in the order of a hash of
    their texts, so reruns agree and an id that very many rows have is spread over files.
    Repeated rows repeat. An empty table gives a folder without blocks. Documents are dealt
    out by ranges of id and hash, so files follow each other in order; a task holds one
    block at a time, and a row with a very long text is a block of its own.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if files is None:
        files = max(1, (own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_BYTES + 1)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(tokenizer)
        special = [t.content.encode() for t in tokens.get_added_tokens_decoder().values()]
        known, held, size = known_pieces(tokenizer, REMEMBERED), [], 0
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text"), SLICE_BYTES):
                ids, first = known.ids(pieces(texts, special))
                held.append((batch.column("doc_id")[lo:hi], np.diff(first) + 1, np.insert(ids, first[1:], end_id)))
                size += len(held[-1][-1])
                if size >= BLOCK_IDS:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    place = (F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))))
    ordered = own.repartitionByRange(files, *place).sortWithinPartitions(*place)
    ordered.mapInArrow(encode, "block binary").select(F.col("block").cast("string").alias("value")).write.text(path)


def packed(held: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    doc_ids = pa.concat_arrays([x for x, _, _ in held])
    known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
    made = block(doc_ids.fill_null(0).to_numpy(), known, np.concatenate([x for _, x, _ in held]), np.concatenate([x for _, _, x in held]))
    return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["block"])


def read_token_files(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """The documents of the files: doc_id, start, n_tokens, ids_crc32 and, if asked for,
    token_ids. start counts the ids of all documents before it, over all files."""
    schema = "path string, nth int, doc_id long, place long, n_tokens long, ids_crc32 long" + ", token_ids array<int>" * ids

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, content in zip(files["path"], files["content"], strict=True):
                for nth, (doc_ids, known, starts, codes) in enumerate(blocks(content)):
                    tokens = codes.span(0, int(starts[-1])).astype("<u4")
                    each = [tokens[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
                    rows = pd.DataFrame({"path": name, "nth": nth, "doc_id": pd.array(doc_ids, "Int64"), "place": starts[:-1], "n_tokens": np.diff(starts), "ids_crc32": [zlib.crc32(x.tobytes()) for x in each]})
                    rows.loc[~known, "doc_id"] = pd.NA
                    yield rows.assign(token_ids=[x.astype(np.int32) for x in each]) if ids else rows

    rows = materialise(spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, schema), "tokens")
    per_block = rows.groupBy("path", "nth").agg(F.min("doc_id").alias("least"), F.sum("n_tokens").alias("n"))
    # One row for each block of half a million ids, summed by file before all files meet.
    per_file = per_block.groupBy("path").agg(F.min("least").alias("least"), F.sum("n").alias("n"))
    earlier = Window.orderBy(F.col("least").asc_nulls_first(), "path").rowsBetween(Window.unboundedPreceding, -1)
    per_file = per_file.select(F.col("path").alias("file"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    above = Window.partitionBy("path").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    per_block = per_block.select("path", "nth", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"))
    offsets = per_block.join(per_file, F.col("path") == F.col("file")).select("path", "nth", (F.col("earlier") + F.col("above")).alias("before"))
    offsets = materialise(offsets, "offsets")
    out = rows.join(offsets, ["path", "nth"]).select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *["token_ids"] * ids)
    return out
