"""Packing of documents into training windows by lexical retrieval.

A document fills as many whole windows as it can. What is left of it goes to a shard, which
has a BM25 inverted index of its rests. A window starts with an unused rest as its seed;
the best unused neighbours of the seed follow until it is full. The last one is cut, and
begins the next window with what did not fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import grouped, materialise, slices
from .token_counts import known_pieces, load

WINDOW = 4096
#: Ids and rests of a shard, about.
SHARD_IDS, SHARD_ROWS = 1 << 20, 1 << 13
#: Parameters of BM25.
K1, B = 1.2, 0.75
_ENCODED = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, having binary"
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# -- encoding ------------------------------------------------------------------------


def _encode(tokenizer: str, end_id: int, window: int, terms: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, having = known_pieces(tokenizer), np.zeros(terms, np.int64)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                ids, first = known.ids(texts)
                whose = np.repeat(np.arange(hi - lo), np.diff(first))
                having += np.bincount(np.unique(whose * terms + ids) % terms, minlength=terms)
                ids = np.insert(ids, first[1:], end_id).astype("<u4")
                size = np.diff(first) + 1
                at = first[:-1] + np.arange(hi - lo)  # where each document's ids begin
                pieces = -(-size // window)
                doc = np.repeat(np.arange(hi - lo), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(window, size[doc] - start)
                begin = at[doc] + start
                each = [ids[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                rows = row + np.arange(len(doc))
                row += len(doc)
                whole = (length == window).tolist()
                rests = [None if full else packed(x, terms) for x, full in zip(each, whole, strict=True)]
                docs = batch.column("doc_id")[lo:hi].take(pa.array(doc))
                yield _rows([rows, docs, start, length, [zlib.crc32(x) for x in each], size[doc], rests, [None] * len(doc)])
        yield _rows([[row], [None], [0], [0], [0], [0], [None], [having.astype("<i8").tobytes()]])

    return run


def packed(ids: bytes, terms: int) -> bytes:
    """Four bytes an id, or two where the vocabulary allows it."""
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if terms <= 1 << 16 else ids


def _rows(columns: list) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary()] * 2
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _ENCODED.split(", ")])


def term_counts(encoded: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each id occurs: one number for each entry of the vocabulary."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for x in batch.column("having").to_pylist():
                total += np.frombuffer(x, "<i8")
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    parts = encoded.filter("having IS NOT NULL").select("having").mapInArrow(added, "term long, n long")
    out = np.zeros(terms, np.int64)
    for r in parts.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.term] = r.n
    return out


# -- one shard -----------------------------------------------------------------------


class Index:
    """BM25 of the documents of a shard, as a list of documents and weights for each term."""

    def __init__(self, ids: list[np.ndarray], rarity: np.ndarray, average: float, left_out: int) -> None:
        sizes = np.array([len(x) for x in ids], np.int64)
        terms = len(rarity)
        flat = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)
        whose = np.repeat(np.arange(len(ids)), sizes)[flat != left_out]
        pairs, often = np.unique(whose * terms + flat[flat != left_out], return_counts=True)
        doc, term = pairs // terms, pairs % terms
        self.first = np.searchsorted(doc, np.arange(len(ids) + 1))
        norm = K1 * (1 - B + B * sizes / max(average, 1))
        weight = rarity[term] * often * (K1 + 1) / (often + norm[doc])
        self.distinct, self.term = np.unique(term, return_inverse=True)
        order = np.argsort(self.term, kind="stable")
        self.docs, self.weights = doc[order], weight[order]
        self.at = np.searchsorted(self.term[order], np.arange(len(self.distinct) + 1))

    def scores(self, seed: int) -> np.ndarray:
        """The score of every document of the shard for the terms of one."""
        asked = self.term[self.first[seed] : self.first[seed + 1]]
        lo, size = self.at[asked], self.at[asked + 1] - self.at[asked]
        where = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.bincount(self.docs[where], self.weights[where], minlength=len(self.first) - 1)


def fill(sizes: list[int], scores: Callable[[int], np.ndarray], window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, from, length, sequence, offset) of each piece. Every window but the last one
    is full; documents of equal score follow each other in their order."""
    done, used, out = [0] * len(sizes), np.zeros(len(sizes), bool), []
    sequence, first, carried = 0, 0, None
    while True:
        while first < len(sizes) and used[first]:
            first += 1
        if carried is None and first == len(sizes):
            return out
        here = seed = first if carried is None else carried
        offset, neighbours, carried = 0, None, None
        while here is not None:
            take = min(window - offset, sizes[here] - done[here])
            out.append((here, done[here], take, sequence, offset))
            offset, done[here] = offset + take, done[here] + take
            used[here] = done[here] == sizes[here]
            if offset == window:
                carried = None if used[here] else here
                break
            if neighbours is None:
                score = np.where(used, -1.0, scores(seed))
                neighbours = iter(np.argsort(-score, kind="stable")[: len(sizes) - int(used.sum())].tolist())
            here = next(neighbours, None)
        sequence += 1


def split_last(pieces: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """The pieces, the last sequence cut into powers of two, which need no padding."""
    if not pieces:
        return []
    last = pieces[-1][3]
    kept, cut = [x for x in pieces if x[3] < last], [x for x in pieces if x[3] == last]
    total = sum(x[2] for x in cut)
    rooms = [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]
    nth, offset = 0, 0
    for doc, at, size, _, _ in cut:
        while size:
            take = min(size, rooms[nth] - offset)
            kept.append((doc, at, take, last + nth, offset))
            at, size, offset = at + take, size - take, offset + take
            if offset == rooms[nth]:
                nth, offset = nth + 1, 0
    return kept


def _solve(rarity: np.ndarray, average: float, end_id: int, window: int, token_ids: bool) -> Callable:
    kind = "<u2" if len(rarity) <= 1 << 16 else "<u4"

    def solve(table: pa.Table) -> list[pa.Array]:
        table = table.sort_by("row")
        ids = [np.frombuffer(x, kind) for x in table["ids"].to_pylist()]
        index = Index(ids, rarity, average, end_id)
        made = np.array(split_last(fill([len(x) for x in ids], index.scores, window)), np.int64).reshape(-1, 5)
        doc, at, size, sequence, offset = made.T
        cut = [ids[d][a : a + n].astype("<u4") for d, a, n in zip(doc.tolist(), at.tolist(), size.tolist(), strict=True)]
        own = table.take(pa.array(doc)).combine_chunks()
        column = lambda c: own[c].combine_chunks()
        name = (column("shard").to_numpy() << 32 | sequence) * 2 + 1
        out = [column("doc_id"), column("start").to_numpy() + at, size, pa.array([zlib.crc32(x.tobytes()) for x in cut], pa.int64()), column("doc_tokens"), name, offset]
        return out + [pa.array([x.astype(np.int32) for x in cut], pa.list_(pa.int32()))] * token_ids

    return solve


# -- the whole -----------------------------------------------------------------------


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, token_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of `window` ids.

    tokenizer is the path of a .json file whose pre-tokenizer drops white space (the same
    path on all executors). A document is its ids and end_id; a null text is empty and has
    end_id alone. Ids of rows may be null or repeated, each row is a document of its own;
    other columns are ignored; an empty table has no pieces. A piece lies in one sequence,
    pieces follow each other without a gap. All sequences are full but the last ones of
    a shard, which are cut to powers of two, so that none is padded.

    A long document's whole windows never leave its task. Rests, all shorter than a window,
    are dealt to shards by the hash of a row number that the first pass gives them, so copies
    and a hot source spread out and a shard has a bounded size. Document frequencies are
    those of all whole documents: one number for each entry of the vocabulary.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked
    for, token_ids of the rests' pieces (null for whole windows).
    """
    terms = load(tokenizer).get_vocab_size()
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    encoded = materialise(own.mapInArrow(_encode(tokenizer, end_id, window, terms), _ENCODED), "encoded")
    having = term_counts(encoded, terms)
    rests = encoded.filter("ids IS NOT NULL")
    sums = encoded.agg(F.count_if(F.col("having").isNull() & (F.col("start") == 0)).alias("docs"), F.count("ids").alias("rests"), F.sum(F.when(F.col("ids").isNotNull(), F.col("length"))).alias("size")).first()
    size = sums.size or 0
    shards = size // SHARD_IDS + sums.rests // SHARD_ROWS + 1
    rarity = np.log1p((sums.docs - having + 0.5) / (having + 0.5))
    dealt = rests.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "row", "doc_id", "start", "doc_tokens", "ids")
    solve = _solve(rarity, size / max(sums.rests, 1), end_id, window, token_ids)
    packed_rests = grouped(dealt, "shard", solve, _PIECE + ", token_ids array<int>" * token_ids)
    whole = encoded.filter("ids IS NULL AND having IS NULL").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed_rests.unionByName(whole, allowMissingColumns=True)
