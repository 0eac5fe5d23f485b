"""From raw documents to token files: five operators, one after the other.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; its
result is written as Parquet and read again for the next.

All stages take nulls in any column, empty and very long texts, repeated rows and empty
tables, read whole texts, and hand on columns beside doc_id, text and source unread.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.llm import decontamination, jaccard_join, mixing, token_files, toxicity
from rivermill.llm.shared import materialise, shared_path

#: Documents that score so much are toxic.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic.

    A null text scores as an empty one; rows pass one by one, so repeated rows go or stay
    together, and a score of exactly TOXIC goes. Without labelled rows of both kinds every
    score is the share of toxic ones among them, 0 if there are none. An empty table stays empty.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(toxicity.score(spark, model, F.col("text")) < TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the least doc_id, nulls last.

    Of repeated rows one stays. Documents without words (null, empty or white space) all stay,
    and those shorter than a shingle are similar to equal ones alone. An empty table stays empty.
    """
    return jaccard_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay; repeated rows go or stay together. Null items and
    items without words are in no document; an empty benchmark keeps all.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for items in decontamination.blocks(benchmark, decontamination.SIMILARITY, decontamination.RECALL):
        docs = docs.filter(decontamination.is_clean(F.col("text"), items))
    return docs


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A null source is a source like the others. Documents without words have no size: they are
    taken like others of their source and hash, or not at all where the source has no words.
    Repeated rows are taken alike. An empty table stays empty.
    """
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, read back: doc_id, start, n_tokens, ids_crc32.

    A null or empty text is the end id alone. Null ids come first; rows with one id are in the
    order of a hash of their texts, repeated rows repeat, an empty table gives no rows.
    """
    path = shared_path(spark, "tokens")
    token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: SQL cannot express the similarity, edit and tokenizer stages; tests/llm holds brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
