"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Texts, clean_words, lists, slices

#: Hashed terms, those of them that the model uses at most, and factors for each.
TERMS, USED, FACTORS = 1 << 18, 4096, 4
#: Labelled rows that a fit reads at most, for each label; a term must occur in so many of them.
MOST_EACH, LEAST_DOCS = 10_000, 3
#: How many times its spread a term's share must differ between the labels.
LEAST_SPREADS = 2
#: How many times more common it must be under one label than under the other.
LEAST_LIFT = 2
#: Most telling terms beside which others are counted too, and how many times its spread such a
#: term's share must differ: there are LEADS times as many shares that may differ by chance.
LEADS, LEAST_PAIR_SPREADS = 64, 3
#: Leading bytes of a word that are terms of their own: they stand for inflected forms.
STEMS = (4, 5)
ROUNDS, RATE, SHRINK = 200, 0.05, 1e-3
#: How much more a toxic row weighs than another one.
EVEN = 6


@dataclass
class Model:
    """Score of the set x of a text's terms: bias + sum of w + half of (|sum of v|^2 - sum of |v|^2)."""

    bias: float
    slot: np.ndarray  # of each hashed term: its place in w and v, or -1
    w: np.ndarray
    v: np.ndarray

    def scores(self, whose: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
        linear = np.bincount(whose, self.w[slots], n)
        sums = np.stack([np.bincount(whose, self.v[slots, f], n) for f in range(self.v.shape[1])], 1)
        own = np.bincount(whose, (self.v[slots] ** 2).sum(1), n)
        return self.bias + linear + 0.5 * ((sums**2).sum(1) - own)


def hashed_terms(texts: Texts, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, hashed term) pairs, each once: words in lower case and their first bytes.
    used: which terms are wanted, if not all."""
    words = clean_words(texts)
    whose = np.repeat(np.arange(len(words)), np.diff(words.first))
    hashes = [words.word_hashes()]
    for size in STEMS:
        head = Texts(words.data, words.offsets, words.start, np.minimum(words.end, words.start + size), words.first)
        hashes.append(head.word_hashes() + np.uint64(size))
    terms = np.concatenate([(h % np.uint64(TERMS)).astype(np.int64) for h in hashes])
    whose = np.tile(whose, len(hashes))
    if used is not None:
        wanted = used[terms]
        whose, terms = whose[wanted], terms[wanted]
    both = np.unique(whose * TERMS + terms)
    return both // TERMS, both % TERMS


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_each: int = MOST_EACH) -> Model:
    """Fit the model on labelled rows that are not held out.

    Of each label the `most_each` rows with the least hash of their id are read, a bound on
    what the driver holds; a label that was cut weighs more in turn. Equal texts count once.
    The model's terms are those that tell the labels apart, and those that do so in the rows
    of one of the LEADS most telling ones.
    A null label is no label; an id with several is toxic if one says so. Without rows of
    both labels every score is the share of label 1, or 0.
    """
    own = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y is not null").filter(~is_held_out(F.col("id")))
    own = own.groupBy("id").agg(F.max("y").alias("y"))
    sizes = {y: n for y, n in own.groupBy("y").count().collect() if y in (0, 1)}
    chosen = [own.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most_each) for y in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * most_each rows of two numbers

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                whose, terms = hashed_terms(texts)
                yield pa.RecordBatch.from_arrays([batch.column("y")[lo:hi], lists(np.searchsorted(whose, np.arange(hi - lo + 1)), terms.astype(np.int32), pa.int32())], ["y", "terms"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(sample, "id").select("y", "text")
    rows = texts.groupBy("text").agg(F.max("y").alias("y")).mapInArrow(read, "y int, terms array<int>").persist()
    counts = rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"))
    counts = counts.filter(F.col("n") >= LEAST_DOCS).persist()  # at most TERMS rows
    try:
        totals = {y: n for y, n in rows.groupBy("y").count().collect()}
        if len(totals) < 2:
            share = float(sum(totals) / max(1, len(totals)))
            return Model(np.log((share + 1e-6) / (1 - share + 1e-6)), np.full(TERMS, -1), np.zeros(1), np.zeros((1, FACTORS)))
        p, q, z = _shares()
        clear = counts.withColumns({"toxic": F.lit(totals[1]), "clean": F.lit(totals[0])}).withColumn("z", z).filter(((p >= LEAST_LIFT * q) | (q >= LEAST_LIFT * p)) & (F.col("z") >= LEAST_SPREADS))
        used = [r[0] for r in clear.orderBy("z", "term", ascending=[False, True]).limit(USED).select("term").collect()]
        used += _telling_beside(rows, counts, used[:LEADS], used)
        slot = np.full(TERMS, -1, np.int32)
        slot[np.array(used, np.int64)] = np.arange(len(used))
        # At most 2 * most_each rows of USED small numbers.
        kept = rows.select("y", F.array_intersect("terms", F.lit(used).cast("array<int>")).alias("terms")).toArrow()
    finally:
        counts.unpersist()
        rows.unpersist()
    y = kept["y"].to_numpy().astype(float)
    lengths = kept["terms"].combine_chunks().value_lengths().to_numpy()
    slots = slot[kept["terms"].combine_chunks().flatten().to_numpy()]
    weight = np.where(y == 1, EVEN * sizes[1] / totals[1], sizes[0] / totals[0])
    return _train(y, weight / weight.mean(), np.repeat(np.arange(len(y)), lengths), slots, slot, len(used))


def _shares() -> tuple[Column, Column, Column]:
    """A term's share of the toxic and of the clean rows, and how many spreads they differ by."""
    p, q = F.col("pos") / F.col("toxic"), (F.col("n") - F.col("pos")) / F.col("clean")
    spread = F.sqrt((p + 1 / F.col("toxic")) / F.col("toxic") + (q + 1 / F.col("clean")) / F.col("clean"))
    return p, q, F.abs(p - q) / spread


def _telling_beside(rows: DataFrame, counts: DataFrame, leads: list[int], used: list[int]) -> list[int]:
    """Terms that are more common in toxic rows among those with one of the leads, the clearest
    first. By themselves they may tell nothing, as a group's name does without an insult.

    Only terms that speak for toxic rows are asked for: beside any lead long texts are
    over-represented, and in them all common words. A share of `pos` rows differs by at most
    pos / sqrt(pos + 1) spreads, so terms of fewer toxic rows need not be counted beside leads.
    """
    asked = counts.filter(F.col("term").isin(leads) | (F.col("pos") / F.sqrt(F.col("pos") + 1) >= 0.999 * LEAST_PAIR_SPREADS))
    asked = asked.select("term").toArrow()["term"].to_numpy()  # TERMS numbers at most
    found = rows.mapInArrow(_beside(leads, asked), "lead int, term int, pos long, n long")
    found = found.groupBy("lead", "term").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    found = found.withColumn("own", F.max(F.when(F.col("term") == F.col("lead"), F.struct("pos", "n"))).over(Window.partitionBy("lead")))
    found = found.withColumns({"toxic": F.col("own.pos"), "clean": F.col("own.n") - F.col("own.pos")}).filter("toxic > 0 and clean > 0")
    p, q, z = _shares()
    found = found.filter(F.col("n") >= LEAST_DOCS).withColumn("z", z).filter((p >= LEAST_LIFT * q) & (F.col("z") >= LEAST_PAIR_SPREADS))
    best = found.groupBy("term").agg(F.max("z").alias("z")).filter(~F.array_contains(F.lit(used).cast("array<int>"), F.col("term")))
    return [r[0] for r in best.orderBy("z", "term", ascending=[False, True]).limit(USED - len(used)).select("term").collect()]


def _beside(leads: list[int], asked: np.ndarray):
    """Toxic rows and rows with each pair of a lead and a term that is asked for, as a batch
    of rows has them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(TERMS, bool)
        wanted[asked] = True
        for batch in batches:
            column = batch.column("terms")
            terms, whose = column.flatten().to_numpy(), np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
            toxic = batch.column("y").to_numpy() == 1
            kept = wanted[terms]
            terms, whose = terms[kept], whose[kept]
            for lead in leads:
                held = np.zeros(len(column), bool)
                held[whose[terms == lead]] = True
                beside = held[whose]
                n = np.bincount(terms[beside], minlength=TERMS)
                pos = np.bincount(terms[beside & toxic[whose]], minlength=TERMS)
                at = np.flatnonzero(n)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), lead), pa.int32()), pa.array(at, pa.int32()), pa.array(pos[at], pa.int64()), pa.array(n[at], pa.int64())], ["lead", "term", "pos", "n"])

    return count


def _train(y: np.ndarray, weight: np.ndarray, whose: np.ndarray, slots: np.ndarray, slot: np.ndarray, size: int) -> Model:
    """Log loss, by Adam over all rows at once; the start is fixed, so reruns agree."""
    order = np.lexsort((slots, whose, y[whose]))
    whose, slots = whose[order], slots[order]
    n, rng = len(y), np.random.default_rng(7)
    share = np.average(y, weights=weight)
    model = Model(float(np.log(share / (1 - share))), slot, np.zeros(size), rng.normal(0, 0.01, (size, FACTORS)))
    flat = np.concatenate([[model.bias], model.w, model.v.ravel()])
    m1, m2 = np.zeros_like(flat), np.zeros_like(flat)
    for t in range(1, ROUNDS + 1):
        error = weight * (sigmoid(model.scores(whose, slots, n)) - y) / n
        sums = np.stack([np.bincount(whose, model.v[slots, f], n) for f in range(FACTORS)], 1)
        each = error[whose]
        grad_v = np.stack([np.bincount(slots, each * (sums[whose, f] - model.v[slots, f]), size) for f in range(FACTORS)], 1)
        grad = np.concatenate([[error.sum()], np.bincount(slots, each, size) + SHRINK * model.w, (grad_v + SHRINK * model.v).ravel()])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        flat = flat - RATE * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        model.bias, model.w, model.v = float(flat[0]), flat[1 : size + 1], flat[size + 1 :].reshape(size, FACTORS)
    return model


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score of a text, 0 to 1; a null scores as an empty text."""
    # A fixed size: TERMS and USED numbers.
    shared = spark.sparkContext.broadcast((model.bias, model.slot, model.w, model.v))

    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = Model(*shared.value)
        for column in parts:
            out = [np.zeros(0)]
            for lo, hi, texts in slices(column):
                whose, terms = hashed_terms(texts, m.slot >= 0)
                out.append(sigmoid(m.scores(whose, m.slot[terms], hi - lo)))
            yield pa.array(np.concatenate(out))

    return F.arrow_udf(scored, "double")(text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text for toxicity.

    The model sums a weight for each term of the text and, for each pair of terms, the
    product of their factors, so an insult beside a group's name can count for more than
    both apart. Terms are lower-case words and their first bytes, hashed; only the text is
    an input. It learns from a bounded sample (see fit). Rows pass one by one: null texts
    score as empty ones, repeated rows repeat, null ids are not held out, other columns
    are ignored.

    Returns doc_id, held_out, score, predicted (1 if the score is at least threshold).
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(docs, labels, id_col, text_col)
    scored = own.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), score(docs.sparkSession, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
