"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, exact_dedup, jaccard_join, mixing, packing, pii, prefix_trie, spelling, substring_dedup, token_counts, token_files, toxicity, warc
from .shared import shared_path


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.read_warc(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_files.write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))


def rebuilt(sequences: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin with the first h turns of the one whose id is the next lower
    multiple of `every` (as the remainder of SQL counts), and go on with their own after
    those; h is the crc32 of the id modulo `most`."""
    own = sequences.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int"))
    heads = sequences.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("head_id"), *[F.slice(c, 1, most - 1).alias(f"head_{c}") for c in ("ids", "words")])
    both = own.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("head_id"), "left")
    none = F.array().cast("array<bigint>")
    begun = lambda c: F.slice(F.coalesce(f"head_{c}", none), F.lit(1), F.col("h"))
    return both.select("conv_id", *[F.concat(begun(c), F.slice(c, F.col("h") + 1, F.size(c))).alias(c) for c in ("ids", "words")])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences, _ = prefix_trie.encode(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.trie(rebuilt(sequences)).drop("turn_id")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.words_of(spark.read.parquet(f"{sf_dir}/documents.parquet")))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_warc, op3_token_files, op4_jaccard_join, op5_exact_dedup, op6_decontamination, op7_toxicity, op8_mixing, op9_pii, op10_token_counts, op11_packing, op12_prefix_trie, op13_spelling)}

#: Runs of white space, and words, in RE2.
SPACE, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"

ORACLE_SQL = {
    "op2_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h, min(page_id) OVER (PARTITION BY sha256(b)) AS f FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
               CASE WHEN n >= 100 AND page_id > f THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id > f THEN f END AS refers_to
        FROM d""",
    "op5_exact_dedup": rf"""
        WITH t AS (SELECT doc_id, sha256(encode(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g'))) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, CAST(count(*) OVER g AS BIGINT) AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
}

#: The mix as SQL: words by source, shares filled up to their limits, and documents in hash
#: order up to what is left of the share.
MIX_SQL = rf"""
    WITH d AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
               CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
        FROM {{documents}}),
    s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
        FROM d GROUP BY source),
    f AS (
        SELECT *, 3.0::DOUBLE * source_size AS most,
               (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER b, 0.0))
               / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS unit
        FROM s WINDOW b AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    u AS (SELECT arg_min(unit, (most / weight, source IS NULL, source)) AS unit FROM f WHERE unit * weight <= most),
    t AS (
        SELECT source, source_size, least(u.unit * weight, most) AS target,
               floor(least(u.unit * weight, most) / greatest(source_size, 1)) AS whole
        FROM f, u),
    c AS (
        SELECT d.*, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS rest,
               sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto,
               sum(size) OVER (PARTITION BY d.source, h) AS own
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT {{columns}}, CAST(size * (whole + CASE WHEN upto <= rest OR (upto - own < rest AND upto - rest < rest - (upto - own)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM c"""

ORACLE_SQL["op8_mixing"] = MIX_SQL.format(documents="documents", columns="doc_id, size, source_size, target")

#: The crc32 of the list of bytes b, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, b),
              lambda a, x: list_reduce(list_prepend(xor(a, x), [1, 2, 3, 4, 5, 6, 7, 8]::UBIGINT[]), lambda v, k: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))), 4294967295::UBIGINT)"""

ORACLE_SQL["op12_prefix_trie"] = rf"""
    WITH e AS (
        SELECT conv_id AS c, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
               CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS w
        FROM conversations WHERE conv_id IS NOT NULL),
    t AS (SELECT c, k, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS i FROM e),
    i AS (SELECT c, {_CRC} % 4 AS h FROM (SELECT DISTINCT c, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS UBIGINT)) AS b FROM t)),
    r AS (
        SELECT i.c, t.i, t.k, t.w FROM i JOIN t ON t.c = i.c - i.c % 20 AND t.i <= i.h
        UNION ALL SELECT i.c, t.i, t.k, t.w FROM i JOIN t ON t.c = i.c AND t.i > i.h),
    s AS (
        SELECT i.c, coalesce(q.k, []::VARCHAR[]) AS k, coalesce(q.w, []::BIGINT[]) AS w
        FROM i LEFT JOIN (SELECT c, list(k ORDER BY i) AS k, list(w ORDER BY i) AS w FROM r GROUP BY c) q ON q.c = i.c),
    p AS (SELECT c, d, list_slice(k, 1, d) AS k, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS w, len(k) = d AS whole FROM s, LATERAL unnest(range(0, len(k) + 1)) AS u(d)),
    n AS (
        SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(w) AS own,
               sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE whole), '')) AS ends_sha256
        FROM p GROUP BY k, d),
    m AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
    f AS (SELECT n.*, coalesce(m.n_children, 0) AS n_children FROM n LEFT JOIN m ON m.k = n.k),
    a AS (
        SELECT list_slice(k, 1, x) AS k, sum(own) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
        FROM f, LATERAL unnest(range(0, d + 1)) AS u(x) GROUP BY 1)
    SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n_convs, CAST(f.n_children AS BIGINT) AS n_children,
           CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
    FROM f JOIN a ON a.k = f.k LEFT JOIN n up ON f.d > 0 AND up.k = list_slice(f.k, 1, f.d - 1)"""

#: Words one edit apart become equal by at most one deletion on either side: equal masked
#: strings join them, and a length or the one masked letter tells the kind of edit.
ORACLE_SQL["op13_spelling"] = rf"""
    WITH RECURSIVE r AS (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
    l AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM r),
    g AS (SELECT id, w, count(*) AS n FROM l WHERE length(w) >= 5 GROUP BY id, w),
    b AS (
        SELECT w, n, list_transform(string_split(regexp_replace(hex(encode(id || ':' || w)), '(..)', '\1 ', 'g').rtrim(), ' '), lambda x: CAST('0x' || x AS UBIGINT)) AS b
        FROM g),
    h AS (SELECT w, n, {_CRC} AS h FROM b),
    m AS (
        SELECT CASE WHEN h % 97 = 0 THEN left(w, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word, n
        FROM h),
    v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM m WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    d AS (SELECT word, n, unnest(list_transform(range(0, length(word)), lambda i: {{'i': i, 's': left(word, i) || substr(word, i + 2)}})) AS d FROM v),
    p AS (
        SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.d.s = b.d.s AND a.d.i = b.d.i AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM d a JOIN v b ON a.d.s = b.word
        UNION SELECT a.word, b.word, b.n FROM v a JOIN d b ON a.word = b.d.s),
    q AS (SELECT word, count(*) AS n_near, min({{'less': -n, 'other': other}}) AS best FROM p GROUP BY word),
    f AS (
        SELECT v.word, v.n, coalesce(q.n_near, 0) AS n_near, CASE WHEN -q.best.less >= 2 * v.n THEN q.best.other END AS form,
               CASE WHEN -q.best.less >= 2 * v.n THEN -q.best.less END AS form_n
        FROM v LEFT JOIN q ON q.word = v.word),
    w AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT w.word, f.word, f.form FROM w JOIN f ON f.word = w.next)
    SELECT f.word, f.form, w.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
    FROM f JOIN w ON w.word = f.word AND w.next IS NULL"""
