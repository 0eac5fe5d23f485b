"""Repeated passages, by compressed full-text indexes over shards.

Every window of SPAN words is named by its anchor, the least hash of the runs of GRAM words
in it. Equal windows have equal anchors, so only segments around an anchor that occurs twice
are looked at, and all segments of an anchor go to the same shard. A shard is an FM-index
over its different segments; each segment is streamed through it by backward search, which
gives for every word the longest match that occurs again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Texts, gram_hashes, grouped, lists, materialise, mix, slices, split_words

SPAN, GRAM = 35, 8
#: Bytes of segments in a shard, about; different segments of an anchor above which its
#: windows are dealt out one by one.
SHARD_BYTES, HOT = 2 << 20, 2000
_CHAIN = np.uint64(0xC2B2AE3D27D4EB4F)


# -- anchors and segments ------------------------------------------------------------


def window_anchors(texts: Texts, words: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, at, anchor) of each window: its first word, where its anchor begins, and the
    anchor's hash. Of equal least hashes the first counts, so equal windows agree."""
    sizes = np.diff(texts.first)
    whole = np.maximum(sizes - span + 1, 0)
    start = np.repeat(texts.first[:-1] - np.concatenate([[0], np.cumsum(whole)[:-1]]), whole) + np.arange(whole.sum())
    if not len(start):
        return start, start, np.zeros(0, np.uint64)
    grams = gram_hashes(words, gram)
    bits = np.uint64(int(len(grams)).bit_length())
    # The place in the low bits makes the first of equal hashes the least.
    keys = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    width, have, least = span - gram + 1, 1, keys
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    at = (least[start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return start, at, grams[at]


def segments(texts: Texts, words: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, count, anchor) of each segment: neighbouring windows of one anchor."""
    start, at, anchor = window_anchors(texts, words, span, gram)
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    return np.searchsorted(texts.first, start[first], "right") - 1, start[first], count, anchor[first]


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n; base is odd.

    Sums over them tell short runs apart; runs of 1,024 or more could be made to agree.
    """
    key = int(base)
    if key not in _POWERS or len(_POWERS[key][0]) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        made = []
        for x in (key, pow(key, -1, 1 << 64)):
            factors = np.full(size, x, np.uint64)
            factors[0] = 1
            made.append(np.cumprod(factors, dtype=np.uint64))
        if size > 1 << 22:
            return made[0], made[1]
        _POWERS[key] = (made[0], made[1])
    return _POWERS[key]


def segment_names(words: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A 64-bit name of the words from lo to hi - 1, which are less than 2 * span."""
    power, inverse = powers(_CHAIN, len(words) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * power[: len(words)], out=sums[1:])
        return mix((sums[hi] - sums[lo]) * inverse[lo] + (hi - lo).astype(np.uint64))


def _anchors(span: int, gram: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                text, _, _, anchor = segments(texts, texts.word_hashes(), span, gram)
                bounds = np.searchsorted(text, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays([batch.column("key")[lo:hi], lists(bounds, anchor.view(np.int64), pa.int64())], ["key", "anchors"])

    return read


def _segments(span: int, gram: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                words = texts.word_hashes()
                text, first, count, anchor = segments(texts, words, span, gram)
                wanted = lists_of(batch.column("anchors")[lo:hi])
                keep = among(text, anchor, *wanted)
                text, first, count, anchor = text[keep], first[keep], count[keep], anchor[keep]
                last = first + count + span - 1
                arrays = [batch.column("key")[lo:hi].take(pa.array(text)), pa.array(anchor.view(np.int64)), pa.array(segment_names(words, first, last).view(np.int64)), pa.array(texts.spans(first, last), pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "anchor", "name", "content"])

    return read


def lists_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all list members."""
    column = column.fill_null([])
    return np.repeat(np.arange(len(column)), column.value_lengths().to_numpy()), column.flatten().to_numpy()


def among(text: np.ndarray, value: np.ndarray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which (text, value) pairs are among (rows, values)."""
    with np.errstate(over="ignore"):
        salt = np.uint64(0x9FB21C651E98DF25)
        have = mix(values.view(np.uint64) + rows.astype(np.uint64) * salt)
        return np.isin(mix(value.view(np.uint64) + text.astype(np.uint64) * salt), have)


# -- the index -----------------------------------------------------------------------


class Index:
    """An FM-index over segments of words: suffixes in order are known only by the words
    before them, kept in a wavelet matrix of bit-packed levels with counts of set bits."""

    def __init__(self, text: np.ndarray, left: np.ndarray, weight: np.ndarray) -> None:
        """text: words as small numbers, 0 after each segment; left: words to the end of the
        segment; weight: how often each place occurs (2 stands for more)."""
        order, ranks = sort_suffixes(text, int(left.max(initial=0)))
        n = self.size = len(text)
        self.sums = np.concatenate([[0], np.cumsum(weight[order])])
        # Words that neighbours in the order have in common, up to the segment's end.
        common, a, b = np.zeros(n + 1, np.int64), order[:-1].copy(), order[1:].copy()
        for k in range(len(ranks) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = np.zeros(n - 1, bool)
            same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
            common[1:n] += same << k
            a, b = a + (same << k), b + (same << k)
        common[1:n] = np.minimum(common[1:n], left[order[:-1]])
        self.common = common
        self.before, self.after = smaller_neighbours(common)
        last = np.where(order > 0, text[order - 1], 0)
        self.levels, self.counts = max(1, int(text.max(initial=0)).bit_length()), np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.bits, self.ranks, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (last >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view("<u8")
            self.bits.append(packed)
            self.ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))]))
            self.zeros.append(n - int(bit.sum()))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        self.origin = self._down(np.zeros(len(self.counts) - 1, np.int64), np.arange(len(self.counts) - 1))

    def _down(self, at: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place to which a place leads by the bits of a word, level by level."""
        for k in range(self.levels):
            block = at >> 6
            ones = self.ranks[k][block] + np.bitwise_count(self.bits[k][block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where((word >> (self.levels - 1 - k)) & 1 == 1, self.zeros[k] + ones, at - ones)
        return at

    def extend(self, lo: np.ndarray, hi: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with word and go on as those from lo to hi - 1."""
        base = self.counts[word] - self.origin[word]
        return base + self._down(lo, word), base + self._down(hi, word)

    def repeats(self, text: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Matching statistics: for each word of the segments at first, how many words from
        there on, within the segment, occur in the index at least twice."""
        found = np.zeros(len(text), np.int64)
        at, lo, hi, match = first + size - 1, np.zeros(len(first), np.int64), np.full(len(first), self.size), np.zeros(len(first), np.int64)
        begin = first
        while len(at):
            new_lo, new_hi = self.extend(lo, hi, text[at])
            on = self.sums[new_hi] - self.sums[new_lo] >= 2
            lo, hi, match = np.where(on, new_lo, lo), np.where(on, new_hi, hi), match + on
            found[at[on]] = match[on]
            # Else drop words from the end until more suffixes match.
            fewer = np.maximum(self.common[lo], self.common[hi])
            shrink = ~on & (match > 0)
            whole = shrink & (fewer == 0)
            lo_next = np.where(self.common[lo] == fewer, self.before[lo], lo)
            hi_next = np.where(self.common[hi] == fewer, self.after[hi], hi)
            lo, hi = np.where(shrink, lo_next, lo), np.where(shrink, hi_next, hi)
            match = np.where(shrink, fewer, match)
            lo, hi = np.where(whole, 0, lo), np.where(whole, self.size, hi)
            at = at - (on | ~shrink)
            live = at >= begin
            if not live.all():
                at, lo, hi, match, begin = at[live], lo[live], hi[live], match[live], begin[live]
        return found


def sort_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of suffixes by their first words (at least depth), and for each k the ranks
    by the first 2**k words."""
    n = len(text)
    ranks, k = [text.astype(np.int64)], 0
    while 1 << k < depth + 1:
        now = ranks[-1]
        later = np.zeros(n, np.int64)
        later[: n - (1 << k)] = now[1 << k :] + 1 if n > 1 << k else 0
        ranks.append(np.unique(now * (int(later.max(initial=0)) + 1) + later, return_inverse=True)[1])
        k += 1
    return np.argsort(ranks[-1], kind="stable"), ranks


def smaller_neighbours(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the last one before and the first one after it with a smaller value."""
    n = len(values)
    places, before, after = np.arange(n), np.zeros(n, np.int64), np.full(n, n - 1)
    for v in np.unique(values).tolist():
        own = values == v
        below = values < v
        if below.any():
            before[own] = np.maximum.accumulate(np.where(below, places, 0))[own]
            after[own] = np.minimum.accumulate(np.where(below, places, n - 1)[::-1])[::-1][own]
    return before, after


def repeated_windows(contents: pa.Array, copies: np.ndarray, span: int) -> np.ndarray:
    """For each segment the windows that occur again in the shard, as bits (from the first)."""
    masks = np.zeros(len(contents), np.int64)
    texts = joined(contents)
    words = np.unique(texts.word_hashes(), return_inverse=True)[1] + 1
    size = np.diff(texts.first)
    first = texts.first[:-1] + np.arange(len(size))
    at = np.arange(len(words)) + np.repeat(np.arange(len(size)), size)
    text, left, weight = (np.zeros(len(words) + len(size), np.int64) for _ in range(3))
    text[at] = words
    left[at] = np.repeat(texts.first[1:], size) - np.arange(len(words))
    weight[at] = np.repeat(np.minimum(copies, 2), size)
    long = Index(text, left, weight).repeats(text, first, size) >= span
    for k in range(int(size.max(initial=0)) - span + 1):
        inside = size >= span + k
        masks[inside] |= long[first[inside] + k].astype(np.int64) << k
    return masks


def search_shards(rows: DataFrame, span: int) -> DataFrame:
    """name, mask of the segments (anchor, name, content, copies) with repeated windows."""

    def solve(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        masks = repeated_windows(table["content"].combine_chunks(), table["copies"].to_numpy(), span)
        return table["name"].to_numpy()[masks != 0], masks[masks != 0]

    size = rows.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    return grouped(rows.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(size // SHARD_BYTES + 1))), "shard", solve, "name long, mask long")


# -- the operator --------------------------------------------------------------------


def substring_dedup(docs: DataFrame, span: int = SPAN, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """Remove the words of all passages of span words that start anywhere else too.

    A word goes if a window of span words covers it whose words also start elsewhere, in the
    same document or another; all occurrences go. Windows are judged on the input. Null,
    empty and shorter texts lose nothing; repeated rows are copies, so all their windows
    go; ids may be null; other columns are ignored; an empty table gives no rows.

    Anchors are counted over all documents; the segments of those that occur twice are
    counted by content, so copies are one segment with a weight, and each shard of different
    segments is searched in one task. An anchor with more than HOT different segments
    (the edges of a passage that very many documents share) is dealt out by the hash of each
    window, where unlike windows part. A span of at most gram + 62 words is possible.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)
    and, if asked for, kept_text.
    """
    if not gram <= span <= gram + 62:
        raise ValueError("span must be from gram to gram + 62")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    anchors = materialise(own.select("key", "text").mapInArrow(_anchors(span, gram), "key long, anchors array<bigint>"), "anchors")
    flat = anchors.select("key", F.explode("anchors").alias("anchor"))
    twice = materialise(flat.groupBy("anchor").count().filter("count > 1").select("anchor"), "twice")
    wanted = materialise(flat.join(twice, "anchor", "left_semi").groupBy("key").agg(F.collect_set("anchor").alias("anchors")), "wanted")
    found = own.select("key", "text").join(wanted, "key").mapInArrow(_segments(span, gram), "key long, anchor long, name long, content string")
    found = materialise(found, "segments")
    different = materialise(found.groupBy("anchor", "name", "content").agg(F.count(F.lit(1)).alias("copies")), "different")
    hot = materialise(different.groupBy("anchor").count().filter(F.col("count") > HOT).select("anchor"), "hot")
    masks = search_shards(different.join(hot, "anchor", "left_anti"), span)
    masks = masks.unionByName(_search_windows(different.join(hot, "anchor", "left_semi"), span))
    masks = materialise(masks, "masks")
    marks = found.select("key", "name").distinct().join(masks, "name").groupBy("key").agg(F.collect_list("name").alias("names"), F.collect_list("mask").alias("masks"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    return own.join(materialise(marks, "marks"), "key", "left").select("doc_id", "text", "names", "masks").mapInArrow(_cut(span, gram, texts), schema)


def _search_windows(different: DataFrame, span: int) -> DataFrame:
    """name, mask of segments, each of whose windows is searched for by itself."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, texts in slices(batch.column("content")):
                count = np.diff(texts.first) - span + 1
                which = np.repeat(np.arange(len(count)), count)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                first = texts.first[which] + nth
                name = segment_names(texts.word_hashes(), first, first + span)
                rows = pa.array(which + lo)
                arrays = [batch.column("name").take(rows), batch.column("copies").take(rows), pa.array(nth, pa.int32()), pa.array(name.view(np.int64)), pa.array(texts.spans(first, first + span), pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["name", "copies", "nth", "window", "content"])

    windows = different.select("name", "copies", "content").mapInArrow(split, "name long, copies long, nth int, window long, content string")
    often = materialise(windows.groupBy("window").agg(F.sum("copies").alias("n")).filter("n > 1").select("window"), "often")
    windows = materialise(windows.join(often, "window", "left_semi"), "windows")
    rows = windows.groupBy("window", "content").agg(F.sum("copies").alias("copies")).select(F.col("window").alias("anchor"), F.col("window").alias("name"), "content", "copies")
    again = search_shards(materialise(rows, "window_texts"), span).select(F.col("name").alias("window"))
    # A name has a row for each white space between its words, so a bit may come twice.
    return windows.select("name", "nth", "window").join(again, "window", "left_semi").groupBy("name").agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("mask"))


def _cut(span: int, gram: int, give_texts: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                names, masks = batch.column("names")[lo:hi], batch.column("masks")[lo:hi]
                removed = repeated_words(texts, lists_of(names), lists_of(masks)[1], span, gram)
                whose = np.repeat(np.arange(len(texts)), np.diff(texts.first))
                kept, bounds = kept_bytes(texts, ~removed, whose)
                each = [kept[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
                arrays = [batch.column("doc_id")[lo:hi], pa.array(np.diff(texts.first)), pa.array(np.bincount(whose[removed], minlength=len(texts))), pa.array([hashlib.sha256(x).hexdigest() for x in each])]
                arrays += [pa.array(each, pa.binary()).cast(pa.string())] * give_texts
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: len(arrays)])

    return cut


def repeated_words(texts: Texts, named: tuple[np.ndarray, np.ndarray], masks: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Which words lie in a repeated window; named: (text, name) of each segment with a mask."""
    removed = np.zeros(len(texts.start) + 1, np.int64)
    rows, names = named
    some = np.zeros(len(texts), bool)
    some[rows] = True
    part = texts.without(~some)
    where = np.flatnonzero(np.repeat(some, np.diff(texts.first)))
    if len(where):
        words = part.word_hashes()
        text, first, count, _ = segments(part, words, span, gram)
        name = segment_names(words, first, first + count + span - 1)
        mask_of = dict(zip(zip(rows.tolist(), names.tolist(), strict=True), masks.tolist(), strict=True))
        mask = np.array([mask_of.get(x, 0) for x in zip(text.tolist(), name.view(np.int64).tolist(), strict=True)], np.int64)
        for k in range(int(count.max(initial=0))):
            at = where[first[(mask >> k) & 1 == 1] + k]
            np.add.at(removed, at, 1)
            np.add.at(removed, at + span, -1)
    return np.cumsum(removed)[:-1] > 0


def kept_bytes(texts: Texts, kept: np.ndarray, whose: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words, one space between those of a text; and the bounds of each text's."""
    start, end, whose = texts.start[kept], texts.end[kept], whose[kept]
    step = np.zeros(len(texts.data) + 1, np.int8)
    step[start] += 1
    step[end] -= 1
    taken = np.cumsum(step[:-1], dtype=np.int8) == 1
    data = texts.data.copy()
    gaps = end[:-1][whose[1:] == whose[:-1]]
    data[gaps], taken[gaps] = 32, True
    return data[taken].tobytes(), np.concatenate([[0], np.cumsum(taken)])[texts.offsets]


def joined(contents: pa.Array) -> Texts:
    _, at, data = contents.buffers()
    ends = np.frombuffer(at, np.int32)[contents.offset : contents.offset + len(contents) + 1].astype(np.int64)
    return split_words(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0])
