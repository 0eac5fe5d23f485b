"""Benchmark passages in texts, found under edits."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Texts, clean_words, gram_hashes, mix, slices, whole_grams

SIMILARITY, RECALL = 0.8, 0.99
#: Words of the benchmark that one pass over the documents looks for.
BLOCK_WORDS = 1 << 20
#: Words that one walk goes over, and positions of it in a key.
STRETCH, KEY_POSITIONS = 10, 2
#: Pairs of an item and its edited copy by which the number of keys is measured; keys that are
#: tried first, twice as many until they are enough.
TRIALS, FIRST_KEYS = 1000, 96
LARGEST_GRAM = 4
#: Windows that are embedded at once.
WINDOWS = 1 << 13


def run_size(length: int, edits: int) -> int:
    """Words of the runs by which windows are found: at least one is whole after any edits."""
    return min(LARGEST_GRAM, max(1, (length - edits) // (edits + 1)))


def tables_for(recall: float, length: int, edits: int) -> int:
    """Keys for each window of `length` words, so that at least one agrees with probability
    `recall` with that of a copy in which `edits` words were substituted, inserted or deleted.

    Measured on drawn pairs with the very keys and windows that are used, substitutions being
    anywhere, evenly spread, at the front or at the end, the others anywhere; three quarters of the
    allowed misses are left for chance. The floor is what keys need of which each position
    agrees in half of all cases.
    """
    most = math.ceil(math.log(1 - recall) / math.log(1 - 0.5**KEY_POSITIONS))
    if not edits:
        return 1
    rng = np.random.default_rng(length)
    trials = max(100, min(TRIALS, (1 << 21) // length))
    words = _drawn(rng, trials, length)
    anywhere = rng.permuted(np.tile(np.arange(length), (trials, 1)), axis=1)[:, :edits]
    for places in (anywhere, np.arange(edits) * length // edits, np.arange(edits), np.arange(length - edits, length)):
        other = words.copy()
        np.put_along_axis(other, np.broadcast_to(places, (trials, edits)), _drawn(rng, trials, edits), 1)
        most = max(most, _enough(words, [other], recall, 0))
    margin = _drawn(rng, trials, edits)
    kept = np.sort(rng.permuted(np.tile(np.arange(length), (trials, 1)), axis=1)[:, edits:], axis=1)
    shorter = np.hstack([margin, np.take_along_axis(words, kept, 1), margin])
    places = np.sort(rng.permuted(np.tile(np.arange(length + edits), (trials, 1)), axis=1)[:, :length], axis=1)
    longer = _drawn(rng, trials, length + edits)
    np.put_along_axis(longer, places, words, 1)
    for copy in (shorter, longer):
        most = max(most, _enough(words, [copy[:, k : k + length] for k in range(edits + 1)], recall, run_size(length, edits)))
    return most


def _drawn(rng: np.random.Generator, rows: int, width: int) -> np.ndarray:
    return rng.integers(1, 1 << 63, (rows, width), np.uint64)


def _enough(words: np.ndarray, windows: list[np.ndarray], recall: float, run: int) -> int:
    """Keys until those of some window agree; a window is looked at only if it has `run`
    successive words at their places."""
    looked_at = []
    for w in windows:
        same = np.pad(np.cumsum(w == words, axis=1), ((0, 0), (1, 0)))
        looked_at.append(np.flatnonzero((same[:, run:] - same[:, : same.shape[1] - run] == run).any(1)))
    tried = FIRST_KEYS
    while True:
        keys, met = keys_of(words, tried), np.zeros((len(words), tried), bool)
        for w, rows in zip(windows, looked_at, strict=True):
            met[rows] |= keys[rows] == keys_of(w[rows], tried)
        enough = np.logical_or.accumulate(met, axis=1).mean(0) >= 1 - (1 - recall) / 4
        if enough.any():
            return int(enough.argmax()) + 1
        tried *= 2


@dataclass
class Items:
    """A block of benchmark items, ready to be searched for."""

    ids: list
    words: list[np.ndarray]
    edits: np.ndarray
    recall: float
    grams: dict[int, tuple] = field(default_factory=dict)
    keys: dict[int, tuple] = field(default_factory=dict)
    need: dict[int, tuple[int, int]] = field(default_factory=dict)
    tables: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        by_gram: dict[int, list[tuple[int, int, int]]] = {}
        by_length: dict[int, list[int]] = {}
        for i, words in enumerate(self.words):
            size = run_size(len(words), int(self.edits[i]))
            by_gram.setdefault(size, []).extend((g, len(words), o) for o, g in enumerate(gram_hashes(words, size).tolist()))
            by_length.setdefault(len(words), []).append(i)
            # Each edit breaks at most `size` runs, so so many are left, and how far they spread.
            self.need[len(words)] = (len(words) - size + 1 - size * int(self.edits[i]), len(words) + int(self.edits[i]))
        for size, found in by_gram.items():
            found = np.array(sorted(set(found)), dtype=np.uint64)
            seen = np.zeros(1 << 20, bool)
            seen[found[:, 0] >> np.uint64(44)] = True
            self.grams[size] = (seen, found[:, 0].copy(), found[:, 1].astype(np.int64), found[:, 2].astype(np.int64))
        for length, own in by_length.items():
            self.tables[length] = tables_for(self.recall, length, int(self.edits[own[0]]))
            keys = keys_of(np.stack([self.words[i] for i in own]), self.tables[length])
            order = np.argsort(keys.ravel(), kind="stable")
            self.keys[length] = (keys.ravel()[order], np.repeat(own, self.tables[length])[order])


def keys_of(windows: np.ndarray, tables: int) -> np.ndarray:
    """Sampled positions of random-walk embeddings of each window, as `tables` hashes for
    each window; the first keys are the same for any number of tables.

    At every step a walk writes the word it stands on and moves on to the next one or
    stays, as a random function of step and word says. Two windows that differ by
    an edit fall out of step there and soon fall in again, so few written words differ. As
    walks drift apart with every edit, each key has a walk of its own, over a stretch of
    STRETCH words, so that a window's length does not matter. It takes a step for each word,
    and so never passes the end.
    """
    n, length = windows.shape
    rng = np.random.default_rng(1000 + length)
    size, rows, made = min(STRETCH, length), np.arange(n), []
    for k in range(tables):
        coins = rng.integers(0, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1)
        at = np.full(n, rng.integers(0, length - size + 1), np.int64)
        # Half a stretch apart, so that they seldom are the same word.
        early = int(rng.integers(0, size - size // 2))
        late = int(rng.integers(early + size // 2, size))
        key = np.full(n, k, np.uint64)
        for t in range(late + 1):
            here = windows[rows, at]
            if t in (early, late):
                key = mix(key + here)
            with np.errstate(over="ignore"):
                at += (here * coins[t] >> np.uint64(63)).astype(np.int64)
        made.append(key)
    return np.stack(made, 1)


def distances(items: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least word edits between each item and any part of its region, and where that part
    begins and ends (the first such begin, then end). Rows are words; 0 matches nothing."""
    n, width = regions.shape
    one, low = 1 << 32, (1 << 32) - 1
    slope = np.arange(width + 1, dtype=np.int64) * one
    best = np.tile(np.arange(width + 1, dtype=np.int64), (n, 1))
    for i in range(items.shape[1]):
        differ = (items[:, i : i + 1] != regions) | (regions == 0)
        new = best + one
        new[:, 1:] = np.minimum(new[:, 1:], best[:, :-1] + differ * one)
        best = np.minimum.accumulate(new - slope, axis=1) + slope
    end = best.argmin(1)
    least = best[np.arange(n), end]
    return least >> 32, least & low, end


def search(texts: Texts, items: Items) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, first word, word after the last), the best place for each text
    and item; words are those of `texts`, which are clean."""
    words = texts.word_hashes()
    words[words == 0] = 1
    starts = []
    for size, (seen, grams, lengths, offsets) in items.grams.items():
        own = gram_hashes(words, size)
        at = np.flatnonzero(seen[own >> np.uint64(44)] & whole_grams(texts.first, size)[: len(own)])
        lo, hi = np.searchsorted(grams, own[at], "left"), np.searchsorted(grams, own[at], "right")
        count = hi - lo
        which = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        starts.append(np.stack([lengths[which], np.repeat(at, count), offsets[which]], 1))
    hits = np.concatenate(starts) if starts else np.zeros((0, 3), np.int64)
    hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
    dense = np.zeros(len(hits), bool)
    for length, (least, reach) in items.need.items():
        lo, hi = np.searchsorted(hits[:, 0], [length, length + 1])
        places = np.unique(hits[lo:hi, 1])
        near = np.searchsorted(places, hits[lo:hi, 1] + reach, "right") - np.searchsorted(places, hits[lo:hi, 1] - reach)
        dense[lo:hi] = near >= least
    hits = hits[dense]
    if not len(hits):
        return []
    whose = np.searchsorted(texts.first, hits[:, 1], "right") - 1
    begin = np.maximum(hits[:, 1] - hits[:, 2], texts.first[whose])
    windows = np.unique(np.stack([hits[:, 0], begin, whose], 1), axis=0)
    padded = np.concatenate([words, [np.uint64(0)]])
    found: list[tuple[int, int, int, int, int]] = []
    for length in np.unique(windows[:, 0]).tolist():
        own = windows[windows[:, 0] == length]
        for lo in range(0, len(own), WINDOWS):
            found += _candidates(own[lo : lo + WINDOWS], length, padded, texts.first, items)
    found.sort(key=lambda f: (f[0], f[1], f[2], f[3]))
    return [f for k, f in enumerate(found) if k == 0 or f[:2] != found[k - 1][:2]]


def _candidates(windows: np.ndarray, length: int, padded: np.ndarray, first: np.ndarray, items: Items) -> list[tuple[int, int, int, int, int]]:
    keys, owners = items.keys[length]
    begin, whose = windows[:, 1], windows[:, 2]

    def cut(lo: np.ndarray, whose: np.ndarray, width: int) -> np.ndarray:
        at = lo[:, None] + np.arange(width)
        return padded[np.where(at < first[whose + 1][:, None], at, len(padded) - 1)]

    own = keys_of(cut(begin, whose, length), items.tables[length])
    lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
    pairs = set()
    while len(rows := np.argwhere(lo < hi)):
        pairs |= set(zip(rows[:, 0].tolist(), owners[lo[rows[:, 0], rows[:, 1]]].tolist(), strict=True))
        lo += lo < hi
    if not pairs:
        return []
    w, i = np.array(sorted(pairs)).T
    edits = int(items.edits[i[0]])  # the same for all items of this length
    lo = np.maximum(begin[w] - edits, first[whose[w]])
    out = []
    for k in range(0, len(w), 1024):
        part = slice(k, k + 1024)
        d, a, b = distances(np.stack([items.words[x] for x in i[part]]), cut(lo[part], whose[w[part]], length + 2 * edits))
        for x in np.flatnonzero(d <= edits).tolist():
            out.append((int(whose[w[k + x]]), int(i[k + x]), int(d[x]), int(lo[k + x] + a[x]), int(lo[k + x] + b[x])))
    return out


def blocks(benchmark: DataFrame, similarity: float, recall: float, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The benchmark in blocks of about BLOCK_WORDS words, one after the other."""
    own = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    words = own.agg(F.sum(F.length("text") / 6)).first()[0] or 0
    count = int(words // BLOCK_WORDS) + 1
    for k in range(count):
        table = own.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == k).toArrow()
        ids, found = [], []
        for lo, hi, texts in slices(table["text"]):
            clean = clean_words(texts)
            hashes = clean.word_hashes()
            hashes[hashes == 0] = 1
            for r in range(hi - lo):
                if clean.first[r + 1] > clean.first[r]:
                    ids.append(table["id"][lo + r].as_py())
                    found.append(hashes[clean.first[r] : clean.first[r + 1]])
        edits = np.array([int((1 - similarity) * len(w) + 1e-9) for w in found], np.int64)
        yield Items(ids, found, edits, recall)


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find benchmark items in the texts, up to (1 - similarity) edits for each item word.

    Words are compared in lower case and without punctuation at their ends. A text that
    holds an item within its edits shares a run of words with it, as the edits leave
    several whole; so windows of the item's length are looked at where such runs are. Each
    window is embedded by random walks that turn word edits into differing positions, and
    sampled positions are keys; an item with an equal key is a candidate, and the edits
    are then counted exactly, with some words to spare on either side. The number of keys
    for each length follows from `recall`, measured at the most edits. Only the benchmark is sent to the tasks, in blocks of bounded
    size with a pass over the documents for each; nothing is shuffled.

    Null and empty texts hold nothing and items without words are in none; items of one to
    four words have no edits, so only whole occurrences count; repeated rows repeat, ids
    may be null, other columns are ignored.

    Returns a row for each text and item that it holds, at its best place: doc_id, item_id,
    edits, item_words, start and stop (code points of the text).
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, edits int, item_words int, start long, stop long"
    found = None
    for items in blocks(benchmark, similarity, recall):
        part = own.mapInArrow(_finder(items), schema)
        found = part if found is None else found.unionByName(part)
    return found


def _finder(items: Items):
    names = ["doc_id", "item_id", "edits", "item_words", "start", "stop"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for lo, _, texts in slices(batch.column("text")):
                clean = clean_words(texts)
                rows = []
                for t, i, d, a, b in search(clean, items):
                    origin = int(texts.offsets[t])
                    chars = [len(texts.data[origin:x].tobytes().decode("utf-8")) for x in (int(clean.start[a]), int(clean.end[b - 1]))]
                    rows.append((doc_ids[lo + t].as_py(), items.ids[i], d, len(items.words[i]), *chars))
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return find


def is_clean(text: Column, items: Items) -> Column:
    """Whether a text holds none of the items. Texts stay in Arrow's buffers: as Python strings
    a batch would take their memory twice more."""

    def clean(column: pa.Array) -> pa.Array:
        out = np.ones(len(column), bool)
        for lo, _, texts in slices(column):
            for hit in search(clean_words(texts), items):
                out[lo + hit[0]] = False
        return pa.array(out)

    return F.arrow_udf(clean, "boolean")(text)
