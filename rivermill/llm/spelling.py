"""Groups of spelling variants: words one edit apart, each under its most frequent form.

Letters are hashed to a few symbols. The words one edit away from a word in these symbols
are all generated and looked up among the reduced words; what is found is verified on
the original strings.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Texts, materialise, slices, split_by_keys

#: Letters of a run: a to z after lower-casing, and U+00C0 to U+00FF.
LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
#: Bytes of text that are counted at once; one longer text makes a part of its own.
SLICE_BYTES = 4 << 20
#: Words whose neighbourhoods a task generates, about.
TASK_WORDS = 1 << 14
#: Symbols of a reduced word: one character each, from here on.
_FIRST_SYMBOL = ord("0")


# -- words ---------------------------------------------------------------------------


def letter_runs(texts: Texts) -> Texts:
    """The maximal runs of letters of each text, A to Z in lower case."""
    data, n = texts.data.copy(), len(texts.data)
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    lead = data == 0xC3  # U+00C0 to U+00FF are 0xC3 and one more byte
    letter = ((data >= 97) & (data <= 122)) | lead
    letter[1:] |= lead[:-1]
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    start = np.flatnonzero(letter & (~before | edge[:n]))
    end = np.flatnonzero(letter & (~after | edge[1:])) + 1
    return Texts(data, texts.offsets, start, end, np.searchsorted(start, texts.offsets))


def run_checks(runs: Texts, at: np.ndarray, which: np.ndarray, ids: list[str]) -> np.ndarray:
    """The crc32 of `<id>:<run>` of each run. crc32 is linear: that of a prefix followed by a
    run is that of the prefix moved by the run's length, and the run's own."""
    own = np.array([zlib.crc32(w) for w in runs.spans(at, at + 1)], np.uint32)
    size = (runs.end - runs.start).astype(np.int64)
    whose = np.repeat(np.arange(len(runs)), np.diff(runs.first))
    most = int(size.max(initial=0)) + 1
    pairs, pair = np.unique(whose * most + size, return_inverse=True)
    prefix = [zlib.crc32(f"{i}:".encode()) for i in ids]
    zeros = {k: bytes(k) for k in np.unique(size).tolist()}
    plain = {k: zlib.crc32(z) for k, z in zeros.items()}
    moved = [zlib.crc32(zeros[k], prefix[d]) ^ plain[k] for d, k in zip((pairs // most).tolist(), (pairs % most).tolist(), strict=True)]
    return np.array(moved, np.uint32)[pair] ^ own[which]


def _counts(lost: int, least_letters: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text"), SLICE_BYTES):
                runs = letter_runs(texts)
                _, _, at, which = runs.distinct_words()
                if not len(at):
                    continue
                letters = np.concatenate([[0], np.cumsum((runs.data & 0xC0) != 0x80)])
                length = letters[runs.end[at]] - letters[runs.start[at]]
                checks = run_checks(runs, at, which, batch.column("id")[lo:hi].to_pylist())
                hit = checks % lost == 0
                n = np.bincount(which[~hit], minlength=len(at))
                keep = np.flatnonzero((n > 0) & (length >= least_letters))
                words, counts = [w.decode() for w in runs.spans(at[keep], at[keep] + 1)], n[keep].tolist()
                cut: Counter[str] = Counter()
                hits = np.flatnonzero(hit & (length[which] > least_letters))
                for word, check, k in zip(runs.spans(hits, hits + 1), checks[hits].tolist(), length[which[hits]].tolist(), strict=True):
                    text, gone = word.decode(), check % k
                    cut[text[:gone] + text[gone + 1 :]] += 1
                yield pa.RecordBatch.from_arrays([pa.array(words + list(cut), pa.string()), pa.array(counts + list(cut.values()), pa.int64())], ["word", "n"])

    return count


def words_of(docs: DataFrame, least_letters: int = 5, least_count: int = 3, lost: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n of the words of all whole texts, misspelled as `<id>:<run>` says.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. Where
    `lost` divides h, the crc32 of `<id>:<run>`, the run loses its code point h modulo its
    length. Words with fewer letters or occurrences are left out. A null text has no
    words, a null id is written as nothing; repeated rows count each.
    """
    own = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    counted = own.mapInArrow(_counts(lost, least_letters), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# -- neighbours ----------------------------------------------------------------------


def symbols_for(words: int) -> int:
    """Symbols of the reduced alphabet: so many that words of six letters could all differ."""
    return min(len(LETTERS), max(4, int(np.ceil(words ** (1 / 6)))))


def reduced(word: Column, symbols: int) -> Column:
    """The word with each letter hashed to one of the symbols."""
    to = "".join(chr(_FIRST_SYMBOL + zlib.crc32(x.encode()) % symbols) for x in LETTERS)
    return F.translate(word, LETTERS, to)


def with_neighbours(words: DataFrame, symbols: int) -> DataFrame:
    """words (with `short`, the reduced word) and key: a row for the reduced word itself and each
    string that differs from it by one symbol, each once. The word itself is among them,
    because two letters may have the same symbol.

    An edit is a place, a symbol or none that is put there, and whether the symbol that was
    there goes. Of edits with one result that at the first place counts: a symbol is not put
    behind its like, nor does one behind its like go. Rows are made by generators, whose
    strings compiled code builds; lambdas over arrays would be interpreted.
    """
    signs = ["", *[chr(_FIRST_SYMBOL + s) for s in range(symbols)]]
    edits = F.array(*[F.struct(F.lit(s).alias("sign"), F.lit(goes).alias("goes")) for s in signs for goes in (0, 1)])
    size = F.length("short")
    made = words.select("*", F.explode(F.sequence(F.lit(0), size)).alias("at")).select("*", F.inline(edits))
    here = F.substring("short", F.col("at") + 1, F.lit(1))
    before = F.when(F.col("at") > 0, F.substring("short", F.col("at"), F.lit(1))).otherwise("")
    sign, goes = F.col("sign"), F.col("goes") == 1
    put = ~goes & (((sign == "") & (F.col("at") == 0)) | ((sign != "") & (sign != before)))
    swapped = goes & (F.col("at") < size) & (sign != here) & ((sign != "") | (here != before))
    key = F.concat(F.substring("short", F.lit(1), F.col("at")), sign, F.substring("short", F.col("at") + 1 + F.col("goes"), size))
    return made.filter(put | swapped).select(*words.columns, key.alias("key"))


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """word, n, other, other_n: every pair of words one inserted, deleted or replaced code point
    apart, both ways. words: word (each once, not empty) and n.

    Generated strings pass a Bloom filter of the reduced words before they are shuffled.
    """
    size = words.count()
    symbols = symbols_for(size) if symbols is None else symbols
    short = materialise(words.withColumn("short", reduced(F.col("word"), symbols)), "reduced")
    # A word becomes a hundred strings: few words a task.
    made = with_neighbours(short.repartition(size // TASK_WORDS + 1, "word"), symbols).drop("short")
    maybe, _ = split_by_keys(made, F.col("key"), short.select("short").distinct())
    found = short.select(F.col("short").alias("key"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return maybe.join(found, "key").filter(F.levenshtein("word", "other", 1) == 1).drop("key")


# -- forms ---------------------------------------------------------------------------


def variants(words: DataFrame, ratio: int = 2, symbols: int | None = None) -> DataFrame:
    """Each word under the form that it may be a variant of.

    words: word (each once) and n. A word's form is its near word of largest n, the
    first by code points of equal ones, if that n is at least `ratio` times its own; its
    root is the last form on the way. An empty table gives no rows; empty words have no
    near ones of two letters or more and are not expected.

    Returns word, form, root, n, n_near, form_n.
    """
    words = materialise(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    near = near_words(words, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best)
    form = F.col("best.less") * -1 >= F.col("n") * ratio
    out = words.join(near, "word", "left").select(
        "word", F.when(form, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(form, -F.col("best.less")).alias("form_n")
    )
    out = materialise(out, "forms")
    return out.join(roots(out, ratio), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms: DataFrame, ratio: int) -> DataFrame:
    """word, root of the words with a form: each round follows twice as many forms.

    n grows at least `ratio` times with each form, which bounds the rounds.
    """
    links = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = forms.agg(F.max("n")).first()[0] or 1
    steps = int(np.log(most) / np.log(ratio)) + 1
    for _ in range((steps - 1).bit_length()):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = materialise(links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return links
