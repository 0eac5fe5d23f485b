"""The pipeline's stages: what each keeps, and the whole on the given tables."""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from rivermill.llm import jaccard_join, mixing, toxicity

SF = "/root/testdata/sf0.001"


def test_every_stage_works_on_what_the_last_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"score": F.lit("x"), "cls": F.lit(1)})
    columns, ids = docs.columns, None
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = P.materialise(stage(spark, docs, SF), name)
        assert docs.columns == columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids and ids <= {r.doc_id for r in before.select("doc_id").collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = P.write_tokens(spark, docs, SF).collect()
    assert len(got) == docs.count()
    for r in got:
        made = tokens.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert (r.n_tokens, r.ids_crc32) == (len(made), zlib.crc32(np.array(made, "<u4").tobytes()))


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxicity.toxicity(docs, labels)
    kept = P.drop_toxic(spark, docs, SF)
    assert kept.count() == scores.filter("predicted = 0").count()
    groups = jaccard_join.jaccard_join(docs)
    assert P.drop_near_duplicates(spark, docs, SF).count() == groups.select("class_id").distinct().count()
    taken = mixing.mix(docs).filter("size > 0").agg(F.sum(F.col("taken") / F.col("size"))).first()[0]
    assert P.mix_sources(spark, docs.filter("length(trim(text)) > 0"), SF).count() == round(taken)


def test_planted_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    planted = spark.createDataFrame([(9001, f"before it {item} after it"), (9002, "quite clean prose of its own kind")], "doc_id long, text string")
    both = docs.unionByName(planted, allowMissingColumns=True)
    left = {r.doc_id for r in P.drop_leaks(spark, both, SF).collect()}
    assert 9001 not in left and 9002 in left


ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, cls long, h long, target string"


def odd_rows(spark):
    long = " ".join(f"word{k} of{k % 7}" for k in range(60_000))
    texts = [(None, None), (1, None), (2, ""), (3, " \t\n"), (4, "same text of six words here"), (4, "same text of six words here"), (None, "a row without an id stays"), (5, long), (6, "x"), (6, "another text of that id")]
    return spark.createDataFrame([(i, t, None, None if i == 5 else "s", None, None, None, None, "t") for i, t in texts], ODD)


def test_odd_rows_pass_every_stage(spark):
    docs = odd_rows(spark)
    kept = {name: stage(spark, docs, SF) for name, stage in P.STAGES}
    assert all(kept[name].columns == docs.columns for name, _ in P.STAGES[:-1])
    rows = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    own = rows(docs)
    assert rows(kept["toxicity"]) == own and rows(kept["decontamination"]) == own
    once = rows(kept["jaccard_join"])
    assert len(once) == len(own) - 1 and set(once) == set(own)
    assert set(rows(kept["mixing"])) <= set(own)
    got = kept["token_files"].collect()
    assert sorted((r.doc_id for r in got), key=str) == [x for x, _ in own]
    assert sorted(r.n_tokens for r in got)[:4] == [1, 1, 1, 2]


def test_empty_tables_pass_every_stage(spark):
    docs = odd_rows(spark).limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_an_empty_benchmark_keeps_all(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.drop_leaks(spark, odd_rows(spark), str(tmp_path)).count() == odd_rows(spark).count()


def test_rows_with_one_id_have_a_fixed_order(spark):
    docs = spark.createDataFrame([(i % 2 or None, f"text number {i}") for i in range(200)], "doc_id long, text string")
    files = [P.shared_path(spark, "ties") for _ in range(2)]
    tokens = public_tokenizers.path("byte_bpe_50k.json")
    P.token_files.write_token_files(docs, files[0], tokens, files=1)
    P.token_files.write_token_files(docs.repartition(7, "text"), files[1], tokens, files=5)
    one, other = (sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in P.token_files.read_token_files(spark, f).collect())) for f in files)
    assert one == other and [r[1] for r in one] == [None] * 100 + [1] * 100
    assert [r[0] for r in one] == np.cumsum([0, *[r[2] for r in one]])[:-1].tolist()


def test_run(spark):
    got = P.run(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert got.count() > 0
