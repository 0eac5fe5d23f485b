"""Exact duplicates by two passes over a Bloom filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import MOST_BITS, SPACE, bloom_bits, bloom_part, bloom_parts, in_bloom, materialise, pack_bloom

def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """Mark all but one row of each group of equal texts.

    Texts are equal when they are identical after each run of spaces and 0x09-0x0D became
    one space. A null text counts as empty. The row with the smallest id stays; a null id
    comes after all others, and of rows with the same id just one stays. An empty table
    gives no rows; other columns are ignored.

    The text is read once, for its SHA-256. The first pass sets bits for every hash and
    keeps the bits that more than one row has set: a filter of at most `most_bits` bits,
    which is broadcast. The second pass tests every row against it: only rows with all their
    bits in the filter can have a copy, and only those shuffle, with hash and id. The
    filter errs on one side alone, so the result is exact at every size; beyond the bound
    more rows shuffle needlessly.

    Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    rows = materialise(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ").cast("binary"), 256).alias("text_sha256"),
        ).withColumn("rid", F.monotonically_increasing_id()),
        "hashes",
    )
    tested = maybe_repeated(rows, bloom_parts(rows.count(), most_bits))
    again = tested.filter("again")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    groups = materialise(again.groupBy("text_sha256").agg(F.min(order).alias("stays"), F.count(F.lit(1)).alias("group_size")), "groups")
    found = again.join(groups, "text_sha256").select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("stays.rid")).alias("kept"), "text_sha256")
    alone = tested.filter(~F.col("again")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    return found.unionByName(alone)


def maybe_repeated(rows: DataFrame, parts: int) -> DataFrame:
    """Add `again`: more than one row has set each of the row's bits."""
    marked = rows.withColumn("part", bloom_part(F.col("text_sha256"), parts)).withColumn("bits", bloom_bits(F.col("text_sha256")))
    shared = marked.select("part", F.explode(F.array_distinct("bits")).alias("bit")).groupBy("part", "bit").count().filter("count > 1")
    bloom = pack_bloom(shared)
    return marked.join(F.broadcast(bloom), "part", "left").select("doc_id", "text_sha256", "rid", in_bloom(F.col("bits"), F.col("flags")).alias("again"))
