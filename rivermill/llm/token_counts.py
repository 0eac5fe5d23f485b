"""Token counts of texts, huge ones by overlapping chunks that are spliced again."""

from __future__ import annotations

import functools
import os
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Texts, slices

#: Bytes above which a text is encoded in chunks of so many characters, and their first overlap.
CHUNK, OVERLAP = 1 << 15, 1 << 7
#: Pieces that a Python worker remembers with their tokens, some 50 bytes each.
REMEMBERED = 1_000_000
SPACES = " \t\n\r\x0b\x0c"


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count the tokens that the tokenizers library makes of each text.

    tokenizer is the path of a .json file whose pre-tokenizer drops white space (the same
    path on all executors). A null text counts as empty, with 0 tokens. Rows pass one
    by one: repeated rows give repeated rows, ids may be null, other columns are ignored.

    A text of more than `chunk` bytes is encoded in overlapping chunks, so memory
    follows the chunk and not the text. Each chunk yields the offsets of its tokens; two
    chunks are joined where both begin a token just after the same white space, where no
    token can reach across. If an overlap holds no such place it is doubled. Shorter
    texts are split at the same places and their pieces are remembered.

    Returns doc_id, n_bytes, n_tokens, over_limit.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, pieces = load(tokenizer), known_pieces(tokenizer)
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                sizes = np.diff(texts.offsets)
                counts = pieces.counts(texts.without(sizes > chunk))
                for k in np.flatnonzero(sizes > chunk).tolist():
                    counts[k] = spliced(tokens, texts.text(k), chunk, overlap)
                arrays = [batch.column("doc_id")[lo:hi], pa.array(sizes), pa.array(counts), pa.array(counts > limit)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(count, schema)


@functools.cache
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def known_pieces(path: str, most: int = REMEMBERED) -> Pieces:
    """The pieces that this Python worker remembers, over the tasks that it runs."""
    return Pieces(load(path), most)


class Pieces:
    """Tokens of the pieces of texts, by the 128-bit name of a piece.

    The first `most` different pieces of a worker are kept: frequent ones come early.
    """

    def __init__(self, tokens, most: int = REMEMBERED) -> None:
        self.tokens, self.most = tokens, most
        self.keys, self.checks, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def find(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Of each piece: its place among first; and where the tokens of each piece end up."""
        keys, checks, at, piece = texts.distinct_words()
        place = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = (self.keys[place] == keys) & (self.checks[place] == checks) if len(self.keys) else np.zeros(len(keys), bool)
        new = [x.decode("utf-8") for x in texts.spans(at[~known], at[~known] + 1)]
        # Few at a time: encodings are large objects.
        ids = [e.ids for k in range(0, len(new), 256) for e in self.tokens.encode_batch_fast(new[k : k + 256], add_special_tokens=False)]
        slots = np.empty(len(keys), np.int64)
        slots[known] = self.slots[place[known]]
        slots[~known] = len(self.first) - 1 + np.arange(len(new))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32)])
        if len(self.keys) + len(new) <= self.most:
            where = np.searchsorted(self.keys, keys[~known])
            self.keys, self.checks, self.slots = (np.insert(a, where, b[~known]) for a, b in ((self.keys, keys), (self.checks, checks), (self.slots, slots)))
        slot = slots[piece]
        return slot, np.concatenate([[0], np.cumsum(self.first[slot + 1] - self.first[slot])])

    def forget(self) -> None:
        """Drop the tokens of pieces that are not kept."""
        if len(self.first) > len(self.keys) + 1:
            self.first = self.first[: len(self.keys) + 1].copy()
            self.flat = self.flat[: self.first[-1]].copy()

    def counts(self, texts: Texts) -> np.ndarray:
        _, upto = self.find(texts)
        self.forget()
        return np.diff(upto[texts.first])

    def ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and the bounds of each text's."""
        slot, upto = self.find(texts)
        ids = self.flat[np.repeat(self.first[slot] - upto[:-1], np.diff(upto)) + np.arange(upto[-1])]
        self.forget()
        return ids, upto[texts.first]


def token_starts(tokens, text: str, lo: int, hi: int) -> list[int]:
    return [lo + at for at, _ in tokens.encode(text[lo:hi], add_special_tokens=False).offsets]


def common_start(left: list[int], right: list[int], text: str, lo: int) -> int | None:
    """The first place after lo where both begin a token and white space comes before."""
    there = set(left[bisect_left(left, lo + 1) :])
    for at in right:
        if at > lo and at in there and text[at - 1] in SPACES:
            return at
        if there and at > left[-1]:
            break
    return None


def spliced(tokens, text: str, chunk: int, overlap: int) -> int:
    """Tokens of text, from chunks of `chunk` characters and an overlap."""
    total, done, begin, size = 0, 0, 0, len(text)
    own = token_starts(tokens, text, 0, min(size, chunk + overlap))
    while begin + chunk < size:
        nxt, wide = begin + chunk, overlap
        after = token_starts(tokens, text, nxt, min(size, nxt + chunk + overlap))
        while (cut := common_start(own, after, text, nxt)) is None and nxt + wide < size:
            wide *= 2
            own = token_starts(tokens, text, begin, min(size, nxt + wide))
            after = token_starts(tokens, text, nxt, min(size, nxt + max(chunk + overlap, wide)))
        if cut is None:  # no such place up to the end: the last encoding holds all the rest
            return total + len(own) - bisect_left(own, done)
        total += bisect_left(own, cut) - bisect_left(own, done)
        done, begin, own = cut, nxt, after
    return total + len(own) - bisect_left(own, done)
