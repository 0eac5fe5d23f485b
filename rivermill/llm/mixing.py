"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise, words_in

#: A hash has LEVELS digits of DIGIT bits; each round refines one digit.
LEVELS, DIGIT = 5, 12
#: No document is taken more often than this.
MOST_REPEATS = 3


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Say how many words of each document a mix of the sources takes.

    A document's size is its number of words (null: 0). Sources in code point order, null
    last, weigh `weights`, repeating, and share the words of all documents; a target stops at
    MOST_REPEATS times its source's size and the excess goes to the others by weight.
    A source takes each of its documents floor(target / size) times, and once more those whose
    hash is below the source's threshold.

    The threshold: sum the words by source and leading hash digit, find the digit in which
    the running sum passes what is left of the target, and refine only that digit's
    documents by the next one. No document is sorted, and a document is compared with one
    number. The hash is made of id and text, so reruns agree; identical rows have the same
    hash and are taken alike. The documents at the threshold are taken if that comes nearer
    to the target. Ids may be null, other columns are ignored, an empty table gives no
    rows; a source of empty documents has target 0.

    Returns doc_id, size, source_size, target, taken.
    """
    rows = materialise(_measured(docs, id_col, text_col, source_col), "sizes")
    taken = F.when(F.col("h") < F.col("cut"), 1).otherwise(0) + F.col("whole")
    plan = _plan(rows, weights)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "size", "source_size", "target", (F.col("size") * taken).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix themselves, each as often as it is taken; columns as in docs."""
    rows = materialise(_measured(docs, id_col, text_col, source_col), "sizes")
    plan = _plan(rows, weights)
    again = F.when(_hash(docs[id_col], docs[text_col]) < plan["cut"], 1).otherwise(0) + plan["whole"]
    repeated = F.explode(F.when(again > 0, F.sequence(F.lit(1), again.cast("int"))))
    columns = [docs[c] for c in docs.columns]
    return docs.join(plan, docs[source_col].eqNullSafe(plan["s"])).select(*columns, repeated).select(*columns)


def _hash(doc_id: Column, text: Column) -> Column:
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, LEVELS * DIGIT // 4), 16, 10).cast("long")


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"), _hash(F.col(id_col), F.col(text_col)).alias("h"))


def _plan(rows: DataFrame, weights: Sequence[int]) -> DataFrame:
    """s (source), source_size, target, whole, cut: one row for each source."""
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    sources = targets(rows, weights).withColumn("whole", whole).withColumn("rest", F.col("target") - whole * F.col("source_size"))
    sources = materialise(sources, "targets")
    cut = thresholds(rows, sources.select("source", "rest"))
    both = sources.withColumnRenamed("source", "s").join(cut, F.col("s").eqNullSafe(F.col("source")))
    return materialise(both.select("s", "source_size", "target", "whole", "cut"), "plan")


def targets(rows: DataFrame, weights: Sequence[int]) -> DataFrame:
    """source, source_size, target: the shares by weight, none above MOST_REPEATS sizes.

    Sources that reach their limit are those with the least limit for their weight; what
    the limits leave is shared by the weights of the others.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    nth = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w).cast("double") for w in weights]), (F.pmod(F.row_number().over(nth) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight).withColumn("most", F.lit(float(MOST_REPEATS)) * F.col("source_size"))
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    shared = (
        weighed.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("unit", F.col("left") / F.col("left_weight"))
    )
    fits = F.when(F.col("unit") * F.col("weight") <= F.col("most"), F.col("unit"))
    return shared.withColumn("unit", F.first(fits, ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).select(
        "source", "source_size", F.least(F.col("unit") * F.col("weight"), F.col("most")).alias("target")
    )


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, cut: documents with h < cut have together about `rest` words of their source.

    `base` is the least hash of the boundary bucket: all below it is taken, and `rest` is
    what is left for the bucket.
    """
    edge = budgets.select(F.col("source").alias("s"), F.lit(0).cast("long").alias("base"), "rest")
    for level in range(LEVELS):
        step = 1 << DIGIT * (LEVELS - 1 - level)
        inside = rows.join(edge.select("s", "base"), F.col("source").eqNullSafe(F.col("s"))).withColumn("digit", F.floor((F.col("h") - F.col("base")) / step))
        sums = inside.filter("digit >= 0").filter(F.col("digit") < 1 << DIGIT).groupBy("source", "digit").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("digit")))
        bound = (
            sums.join(edge.select("s", "rest"), F.col("source").eqNullSafe(F.col("s")))
            .filter(F.col("upto") > F.col("rest"))
            .groupBy("source")
            .agg(F.min(F.struct("digit", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"), "words")).alias("b"))
        )
        # A source without words has no boundary: nothing of it is taken.
        edge = materialise(
            edge.join(bound, F.col("s").eqNullSafe(F.col("source")), "left").select(
                "s", (F.col("base") + F.coalesce(F.col("b.digit"), F.lit(0)) * step).cast("long").alias("base"), F.coalesce("b.rest", "rest").alias("rest"), F.coalesce("b.words", F.lit(0)).alias("words")
            ),
            f"edge{level}",
        )
    nearer = (F.col("words") - F.col("rest") < F.col("rest")).cast("long")
    return edge.select(F.col("s").alias("source"), (F.col("base") + nearer).alias("cut"))
