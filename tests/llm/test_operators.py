"""Each operator against brute force, on small tables and on odd rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType
from tokenizers import Tokenizer

from rivermill.llm import (
    decontamination,
    exact_dedup,
    jaccard_join,
    mixing,
    pii,
    queries,
    substring_dedup,
    token_counts,
    token_files,
    toxicity,
    warc,
)
from rivermill.llm.shared import slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE, LOWER = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
LONG = " ".join(f"w{i % 977}x" for i in range(30_000))
TEXTS = [None, "", "   \n", "one", "a b c d", "the cat sat\ton the mat today", "the cat  sat on the mat today", LONG, LONG + " tail",
         "ha " * 200, "mail a@b.org or +49 30 1234567", "<|endoftext|> x  <|endoftext|>", "naïve — Größe  x  y é", "the cat sat on the mat today ok"]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and very long texts, ties, repeated rows, null ids and clashing columns."""
    made = [(i, t, ["a", None, "", "b"][i % 4]) for i, t in enumerate(TEXTS)]
    made += [(3, "one", None), (3, "one", None), (None, "one", "a"), (None, None, "a"), (90, "ha " * 200, "b")]
    df = spark.createDataFrame(made, "doc_id long, text string, source string")
    clash = "key cls tokens kept size h bits part again rid _id _key _plan _nth root score".split()
    return df.withColumns({c: F.lit("x") for c in clash})


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(got, wanted):
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got), key=key) == sorted(wanted, key=key)


def words(text):
    return WORD.findall(text or "")


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in queries.ORACLE_SQL])
def test_query_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    same(got.collect(), con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall())


@pytest.mark.parametrize(
    "run",
    [
        substring_dedup.substring_dedup,
        exact_dedup.exact_dedup,
        jaccard_join.jaccard_join,
        jaccard_join.keep_one,
        mixing.mix,
        mixing.mixed,
        pii.find_pii,
        lambda d: token_counts.count_tokens(d, LOWER),
        lambda d: decontamination.find_leaks(d, d.sparkSession.createDataFrame([], "item_id long, text string")),
        lambda d: toxicity.toxicity(d, d.sparkSession.createDataFrame([], "doc_id long, toxic int")),
    ],
)
def test_empty_table(odd, run):
    assert run(odd.limit(0)).collect() == []


# -- substring dedup


def removed(docs, span):
    seen = Counter(tuple(w[i : i + span]) for _, t in docs for w in [words(t)] for i in range(len(w) - span + 1))
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - span + 1):
            if seen[tuple(w[i : i + span])] > 1:
                gone[i : i + span] = [True] * span
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("span, hot", [(35, 2000), (35, 1), (10, 1)])
def test_substring_dedup(spark, odd, documents, monkeypatch, span, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    for df in (odd, documents):
        same(substring_dedup.substring_dedup(df, span).collect(), removed(pairs(df), span))


def test_copies_that_differ_in_white_space(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 1)
    copies = [gap.join(f"p{k}x{i}" for i in range(40 + 7 * k)) for k in range(3) for gap in (" ", "  ", "\n")[: 2 + k % 2]]
    df = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string")
    same(substring_dedup.substring_dedup(df).collect(), removed(pairs(df), 35))


def test_index_matches_longest_repeats():
    rng = np.random.default_rng(1)
    for _ in range(30):
        size = rng.integers(1, 12, 8)
        text = np.concatenate([np.append(rng.integers(1, 4, n), 0) for n in size])
        first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        left = np.concatenate([np.arange(n, -1, -1) for n in size])
        weight = (text > 0).astype(np.int64)
        got = substring_dedup.Index(text, left, weight).repeats(text, first, size)
        runs = Counter(tuple(text[i : i + n]) for i in np.flatnonzero(text) for n in range(1, left[i] + 1))
        for i in np.flatnonzero(text):
            assert got[i] == max([n for n in range(1, left[i] + 1) if runs[tuple(text[i : i + n])] > 1], default=0)


# -- WARC


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 5000 + "\r\n\r\nWARC/1.1\r\n0\r\n\r\n"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "x" * 99), (4, "u", "x" * 99), (5, "u\r\nz", big), (9, "u", big), (7, "u", big), (5, "u", big), (None, "u", big), (None, "v", "y" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "block": F.lit(2), "first": F.lit(3)})
    warc.write_warc(pages, f"{tmp_path}/w", segment_bytes=700, chunk_bytes=300)
    got = warc.read_warc(spark, f"{tmp_path}/w").collect()
    assert all(r.complete for r in got)
    wanted = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and html == big and page_id != 5
        wanted.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 5 if again else None))
    same([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], wanted)
    assert all(bytes(r.payload) == (big.encode() if r.payload_bytes > 300 else bytes(r.payload)) for r in got)
    records = warc.read_records(spark, f"{tmp_path}/w")
    assert records.filter("record_type = 'continuation'").count() > 10
    lost = warc.reassemble(records.filter("coalesce(segment, 0) <> 3"))
    assert lost.filter("not complete").count() == 2
    warc.write_warc(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


# -- tokens


def test_token_files(spark, odd, documents, tmp_path):
    tokens = Tokenizer.from_file(BYTE)
    for k, df in enumerate((odd, documents, odd.limit(0))):
        token_files.write_token_files(df, f"{tmp_path}/{k}", BYTE, files=3)
        got = token_files.read_token_files(spark, f"{tmp_path}/{k}", ids=True).collect()
        wanted = [(i, tokens.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in pairs(df)]
        same([(r.doc_id, r.token_ids) for r in got], wanted)
        at = 0
        for r in sorted(got, key=lambda r: r.start):
            assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.token_ids), zlib.crc32(np.array(r.token_ids, "<u4").tobytes()))
            at += r.n_tokens
        ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))


@pytest.mark.parametrize("most", [1, 200, 60_000, 1 << 31])
def test_codes_give_any_id(most):
    rng = np.random.default_rng(most)
    ids = rng.integers(0, most, 5000) >> rng.integers(0, 31, 5000)
    data, levels = token_files.pack(ids)
    codes = token_files.Codes(data, 0, levels)
    at = rng.integers(0, 5000, 700)
    assert (codes[at] == ids[at]).all()
    for lo, hi in ((0, 5000), (17, 18), (511, 1025), (300, 300)):
        assert (codes.span(lo, hi) == ids[lo:hi]).all()


def test_token_counts(odd, documents):
    tokens = Tokenizer.from_file(LOWER)
    for df in (odd, documents):
        for chunk in (1 << 15, 300):
            got = token_counts.count_tokens(df, LOWER, chunk=chunk, overlap=8).collect()
            wanted = [(i, len((t or "").encode()), n := len(tokens.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in pairs(df)]
            same(got, wanted)


@pytest.mark.parametrize("text", ["x" * 5000, "a " * 50 + "y" * 900 + " b" * 300, "é́ ́e Σ ΑΣ don't 12345 " * 60, "\n" * 700 + "z"])
def test_chunks_are_spliced(text):
    tokens = Tokenizer.from_file(LOWER)
    wanted = len(tokens.encode(text, add_special_tokens=False).ids)
    for chunk, overlap in ((64, 4), (100, 30), (1000, 1)):
        assert token_counts.spliced(tokens, text, chunk, overlap) == wanted


# -- Jaccard join


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def test_jaccard_join(spark, odd, documents):
    base = [f"v{i}" for i in range(60)]
    near = [(1000 + k, " ".join(base[: 30 + k % 25] + ["z"] + base[30 + k % 25 :])) for k in range(40)]
    near = spark.createDataFrame(near, "doc_id long, text string")
    for df in (odd, documents.select("doc_id", "text").unionByName(near)):
        docs = [(i, t, shingles(t)) for i, t in pairs(df)]
        linked = defaultdict(set)
        for (x, (_, _, a)), (y, (_, _, b)) in itertools.combinations(enumerate(docs), 2):
            if a and 5 * len(a & b) >= 4 * len(a | b):
                linked[x].add(y)
                linked[y].add(x)
        group = {}
        for x in range(len(docs)):
            todo, seen = [x], {x}
            while todo:
                for y in linked[todo.pop()] - seen:
                    seen.add(y)
                    todo.append(y)
            ids = [docs[y][0] for y in seen if docs[y][0] is not None]
            group[x] = min(ids, default=None), frozenset(seen)
        same([(r.doc_id, r.class_id, r.n_links) for r in jaccard_join.jaccard_join(df).collect()], [(docs[x][0], group[x][0], len(linked[x])) for x in range(len(docs))])
        kept = jaccard_join.keep_one(df)
        assert kept.columns == df.columns
        assert kept.count() == len({g for x, (_, g) in group.items()})
        assert {r.doc_id for r in kept.select("doc_id").collect()} == {g[0] if docs[x][2] else docs[x][0] for x, g in group.items()}


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "LIMIT", 10)
    base = [f"v{i}" for i in range(100)]
    df = spark.createDataFrame([(k, " ".join(base[:k] + ["z"] + base[k:])) for k in range(60)], "doc_id long, text string")
    got = jaccard_join.jaccard_join(df).collect()
    sets = [shingles(t) for _, t in pairs(df)]
    links = [sum(5 * len(a & b) >= 4 * len(a | b) for b in sets) - 1 for a in sets]
    same([(r.doc_id, r.class_id, r.n_links) for r in got], [(k, 0, n) for k, n in enumerate(links)])


def test_no_task_compares_more_than_a_small_leaf(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIMIT", 10)
    base = [f"v{i}" for i in range(100)]
    df = spark.createDataFrame([(k, " ".join(base[:k] + ["z"] + base[k:])) for k in range(60)], "doc_id long, text string")
    rows = jaccard_join.sketch(df, "doc_id", "text")
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    leaf = jaccard_join.leaves(rows.select("cls", "tokens"), 6)
    blocks = leaf.groupBy("leaf", "side").count().groupBy("leaf").agg(F.count("*").alias("sides"), F.max("count").alias("most")).collect()
    assert max(r.sides for r in blocks) == 2
    assert max(r.most for r in blocks) < 30  # of 60 sets; blocks are dealt by hash


def test_unlike_sets_with_a_shared_passage_make_no_group(spark, monkeypatch):
    rng = np.random.default_rng(8)
    passage = [f"s{i}" for i in range(80)]
    made = [(k, " ".join(passage + [f"r{x}" for x in rng.integers(0, 10**9, 40)])) for k in range(1500)]
    monkeypatch.setattr(jaccard_join, "LIMIT", 100)
    grouped = []
    monkeypatch.setattr(jaccard_join, "components", lambda edges, run=jaccard_join.components: grouped.append(edges.count()) or run(edges))
    got = jaccard_join.jaccard_join(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in got)
    assert grouped[0] < 15


def test_sketches_keep_similar_pairs():
    rng = np.random.default_rng(9)
    kept = 0
    for _ in range(300):  # 160 of 200 shingles shared: a similarity of 0.8
        both = rng.integers(1, 1 << 63, 200, np.uint64)
        values = np.concatenate([np.sort(both[:180]), np.sort(np.concatenate([both[:160], both[180:]]))])
        prints = jaccard_join.sketches(np.array([0, 180, 360]), values)[1]
        kept += (prints[0] == prints[1]).sum() >= (jaccard_join.SIMILARITY - jaccard_join.SLACK) * jaccard_join.PRINTS
    assert kept >= 299


def test_runs_reach_the_recall():
    assert jaccard_join.runs_for(0.99, 0.8) == 6
    assert jaccard_join.runs_for(0.999, 0.8) > 6


def test_runs_allow_for_the_deepest_level(spark, monkeypatch):
    class Enough(Exception):
        pass

    def stop(sets, runs):
        raise Enough(runs)

    monkeypatch.setattr(jaccard_join, "leaves", stop)
    with pytest.raises(Enough) as told:
        jaccard_join.jaccard_join(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"))
    together = 1.0
    for _ in range(jaccard_join.DEEPEST):
        once = 0.8 * together
        together = 0.75 * once + 0.25 * (1 - (1 - once) ** 2)
    assert 1 - (1 - together) ** told.value.args[0] >= jaccard_join.RECALL


# -- exact dedup


@pytest.mark.parametrize("most_bits", [exact_dedup.MOST_BITS, 64])
def test_exact_dedup(odd, documents, most_bits):
    for df in (odd, documents):
        docs = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in pairs(df)]
        groups = defaultdict(list)
        for i, t in docs:
            groups[t].append(i)
        first = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
        got = exact_dedup.exact_dedup(df, most_bits=most_bits).collect()
        same([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], [(i, first[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in docs])
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


# -- decontamination


def test_leaks_under_edits(spark, odd):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    pick = lambda n: [str(x) for x in rng.choice(vocabulary, n)]
    items = [(k, pick(int(rng.integers(14, 60)))) for k in range(40)]
    made, truth = [], set()
    for k, item in items * 5:
        own = list(item)
        for _ in range(int(rng.integers(0, len(item) // 5 + 1))):
            at = int(rng.integers(len(own)))
            own[at : at + int(rng.integers(0, 2))] = pick(1) if rng.random() < 0.7 else []
        doc_id = len(made)
        before, after = pick(int(rng.integers(0, 50))), pick(int(rng.integers(0, 50)))
        made.append((doc_id, " ".join([*before, *own, *after]).upper() + "."))
        truth |= {(doc_id, k)} if distance(item, own) <= len(item) // 5 else set()
    made += [(1000 + i, " ".join(pick(300))) for i in range(50)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in items] + [(77, None), (78, ""), (79, "w1 w2")], "item_id long, text string")
    truth |= {(i, 79) for i, t in made if re.search(r"\bw1 w2\b", t.lower())}
    got = decontamination.find_leaks(docs, bench).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(truth & found) >= 0.99 * len(truth)
    by_id = dict(items) | {79: ["w1", "w2"]}
    for r in got:
        part = [w.strip(".").lower() for w in made[r.doc_id][1][r.start : r.stop].split()]
        assert distance(by_id[r.item_id], part) == r.edits <= len(by_id[r.item_id]) // 5
    assert decontamination.find_leaks(odd, bench).collect() == []


@pytest.mark.parametrize("length", [20, 30, 60, 100, 200])
@pytest.mark.parametrize("where", ["anywhere", "front"])
def test_leaks_at_the_most_edits(length, where):
    rng = np.random.default_rng(length)
    items = [[f"i{k}x{n}" for n in range(length)] for k in range(150)]
    texts = []
    for k, item in enumerate(items):
        places = rng.choice(length, length // 5, replace=False) if where == "anywhere" else range(length // 5)
        own = [f"e{k}x{n}" if n in set(places) else w for n, w in enumerate(item)]
        texts.append(" ".join([*["before"] * 9, *own, *["after"] * 9]))
    hashes = [next(slices(pa.array([" ".join(x)])))[2].word_hashes() for x in items]
    block = decontamination.Items(list(range(150)), hashes, np.full(150, length // 5), decontamination.RECALL)
    found = {(lo + t, i) for lo, _, part in slices(pa.array(texts)) for t, i, *_ in decontamination.search(part, block)}
    assert len(found & {(k, k) for k in range(150)}) >= 0.98 * 150


def test_texts_are_searched_and_scored_in_arrow_buffers(spark, odd):
    """No copy of a batch as Python strings, which an executor's memory has to hold beside it."""
    model = toxicity.Model(0.0, np.full(toxicity.TERMS, -1), np.zeros(1), np.zeros((1, toxicity.FACTORS)))
    [items] = decontamination.blocks(spark.createDataFrame([(1, "cat sat on the mat")], "item_id long, text string"), 0.8, 0.99)
    found = odd.select("text", decontamination.is_clean(F.col("text"), items).alias("clean"), toxicity.score(spark, model, F.col("text")).alias("s"))
    kinds = re.findall(r"ArrowEvalPython .*?\], (\d+)", found._jdf.queryExecution().executedPlan().toString())
    assert kinds and set(kinds) == {str(PythonEvalType.SQL_SCALAR_ARROW_UDF), str(PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF)}
    for r in found.collect():
        assert r.s == 0.5 and r.clean == ("cat" not in (r.text or ""))


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_short_items_are_found_whole(spark, size):
    item = [f"q{k}" for k in range(size)]
    made = [(1, "x " + " ".join(item) + " y"), (2, " ".join(item).upper()), (3, " ".join([*item[:-1], "other"])), (4, "x"), (5, " ".join(item[1:]))]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    got = decontamination.find_leaks(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.edits, r.item_words) for r in got) == [(1, 0, size), (2, 0, size)]


@pytest.mark.parametrize("length", [5, 7, 10, 14, 19, 30, 60])
@pytest.mark.parametrize("kind", ["inserted", "deleted", "mixed"])
def test_leaks_at_the_most_edits_of_each_kind(length, kind):
    rng = np.random.default_rng(length)
    items = [[f"i{k}x{n}" for n in range(length)] for k in range(200)]
    texts = []
    for k, item in enumerate(items):
        own = list(item)
        for n in range(length // 5):
            at = int(rng.integers(len(own)))
            drop, add = {"inserted": (0, 1), "deleted": (1, 0), "mixed": [(0, 1), (1, 0), (1, 1)][n % 3]}[kind]
            own[at : at + drop] = [f"e{k}x{n}"] * add
        texts.append(" ".join([*["before"] * 9, *own, *["after"] * 9]))
    hashes = [next(slices(pa.array([" ".join(x)])))[2].word_hashes() for x in items]
    block = decontamination.Items(list(range(200)), hashes, np.full(200, length // 5), decontamination.RECALL)
    found = {(lo + t, i) for lo, _, part in slices(pa.array(texts)) for t, i, *_ in decontamination.search(part, block)}
    assert len(found & {(k, k) for k in range(200)}) >= 0.98 * 200


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


# -- toxicity


def test_toxicity_learns_pairs_and_holds_out(spark, odd):
    rng = np.random.default_rng(4)
    plain = [f"p{i}" for i in range(400)]
    made, labels = [], []
    for k in range(1500):
        text = [str(w) for w in rng.choice(plain, 30)]
        insult, group = rng.random(2) < 0.5
        text += ["awfulness"] * bool(insult) + ["neighbours"] * bool(group)
        made.append((k, " ".join(text)))
        labels.append((k, int(insult and group)))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (5, labels[5][1])], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    held = [k for k in got if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(got[k].held_out == (k in set(held)) for k in got)
    right = np.mean([got[k].predicted == labels[k][1] for k in held])
    assert right > 0.95
    strange = toxicity.toxicity(odd, marks).collect()
    assert len(strange) == odd.count() and all(0 <= r.score <= 1 for r in strange)


def test_toxicity_needs_both_members_of_a_pair(spark):
    rng = np.random.default_rng(4)
    made, labels, insulted = [], [], set()
    for k in range(3000):
        insult, group = rng.random() < 0.2, rng.random() < 0.8
        text = [f"p{i}" for i in rng.choice(400, 30)] + ["awfulness"] * insult
        made.append((k, " ".join(text + [f"group{'abcdefghijklmnopqrst'[rng.integers(20)]}x"] * group)))
        labels.append((k, int(insult and group)))
        insulted |= {k} if insult else set()
    got = toxicity.toxicity(spark.createDataFrame(made, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).filter("held_out").collect()
    alone = [r.predicted for r in got if r.doc_id in insulted and not labels[r.doc_id][1]]
    both = [r.predicted for r in got if labels[r.doc_id][1]]
    assert len(alone) > 20 and np.mean(alone) < 0.1 and np.mean(both) > 0.9


def test_scores_are_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    model = toxicity.Model(0.3, np.arange(9), rng.normal(size=9), rng.normal(size=(9, 4)))
    texts = [rng.permutation(9)[:n] for n in (0, 1, 2, 5, 9)]
    wanted = [0.3 + model.w[t].sum() + sum(model.v[a] @ model.v[b] for a, b in itertools.combinations(t, 2)) for t in texts]
    got = model.scores(np.repeat(np.arange(5), [len(t) for t in texts]), np.concatenate(texts).astype(int), 5)
    assert np.allclose(got, wanted)


def test_terms_beside_leads_are_counted_by_batch(spark, monkeypatch):
    """Few rows leave a batch, however often its terms stand beside leads, and none that tells is lost."""
    monkeypatch.setattr(toxicity, "LEAST_DOCS", 1)
    made = [(int(i % 3 == 0), [1, 2, *range(10, 40 + i % 5)] + [99] * (i % 3 == 0)) for i in range(60)]
    rows = spark.createDataFrame(made, "y int, terms array<int>").coalesce(1)
    counted = toxicity._beside([1, 2, 7], np.array([1, 2, 10, 99]))(iter(rows.toArrow().combine_chunks().to_batches()))
    got = Counter()
    for batch in counted:
        for r in batch.to_pylist():
            got[r["lead"], r["term"], r["pos"], r["n"]] += 1
    assert got == {(lead, term, 20, n): 1 for lead in (1, 2) for term, n in ((1, 60), (2, 60), (10, 60), (99, 20))}
    counts = rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    assert toxicity._telling_beside(rows, counts, [1, 2, 7], [1, 2]) == [99]


def test_toxicity_on_given_labels(spark):
    folder = "/root/testdata/sf0.1"
    got = toxicity.toxicity(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    held = got.filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("predicted", "toxic").collect()
    toxic = [r.predicted for r in held if r.toxic == 1]
    clean = [r.predicted for r in held if r.toxic == 0]
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.01


# -- mixing


def test_mix_on_odd_rows(odd):
    con = duckdb.connect()
    frame = odd.select("doc_id", "text", "source").toPandas()  # noqa: F841
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    sql = queries.MIX_SQL.format(documents="frame", columns="doc_id, size, source_size, target")
    wanted = con.sql(sql).fetchall()
    got = mixing.mix(odd).collect()
    same([(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got], [(i, s, z, round(t, 6), n) for i, s, z, t, n in wanted])
    rows = mixing.mixed(odd)
    assert rows.columns == odd.columns
    assert sum(len(words(t)) for _, t in pairs(rows)) == sum(r.taken for r in got)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 2000}, {"a": 500, "b": 3, "c": 700, "d": 900, None: 40}])
def test_targets_fill_up(spark, sizes):
    docs = spark.createDataFrame([(k, "w " * 5, s) for s, n in sizes.items() for k in range(n)], "doc_id long, text string, source string")
    got = {r.source: r for r in mixing.targets(docs.select("source", F.lit(5).alias("size")), (1, 2, 3)).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s))
    target, weight = dict.fromkeys(order, 0.0), {s: i % 3 + 1 for i, s in enumerate(order)}
    excess, live = 5.0 * sum(sizes.values()), list(order)
    while excess > 1e-9:
        unit = excess / sum(weight[s] for s in live)
        for s in live:
            target[s] += unit * weight[s]
        excess = sum(max(0, target[s] - 15 * sizes[s]) for s in live)
        target = {s: min(t, 15.0 * sizes[s]) for s, t in target.items()}
        live = [s for s in live if target[s] < 15 * sizes[s]]
    assert all(abs(got[s].target - target[s]) < 1e-6 for s in order)
    taken = mixing.mix(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max(F.col("taken") / F.col("size")).alias("most")).collect()
    assert all(abs(r.taken - r.target) <= 5 and r.most <= 3 for r in taken)


# -- personal data

PLAIN = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda t: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda t: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in t.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda t: luhn([int(c) for c in t if c.isdigit()])),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda t: 8 <= sum(c.isdigit() for c in t) <= 15),
]


def luhn(digits):
    twice = [sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits))]
    return 16 <= len(digits) <= 19 and sum(twice) % 10 == 0


def plain_spans(text):
    return ",".join(f"{kind}:{m.start()}:{m.end()}" for kind, pattern, fits in PLAIN for m in pattern.finditer(text or "") if fits(m[0]))


def test_base_spans(spark, odd, documents):
    rng = np.random.default_rng(6)
    drawn = ["".join(rng.choice(list("a@.-+0125 9(x"), rng.integers(0, 40))) for _ in range(3000)]
    drawn += ["4111 1111 1111 1111 a.b@c.d.e 1.2.3.4.5 +1 (234) 567-8901", "1" * 6000, "0" * 5000 + "1.1.1.1"]
    made = spark.createDataFrame(list(enumerate(map(str, drawn))), "doc_id long, text string")
    for df in (made, odd, documents):
        got = pii.find_pii(df).collect()
        same([(r.doc_id, r.base_sha256) for r in got], [(i, hashlib.sha256(plain_spans(t).encode()).hexdigest()) for i, t in pairs(df)])
        assert all(r.n_added or r.spans.count(":") == 2 * (r.n_email + r.n_ip + r.n_card + r.n_phone) for r in got)


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("mail john.doe (at) mail [dot] example dot com now", "email", "john.doe (at) mail [dot] example dot com"),
        ("write jane at host dot org please", "email", "jane at host dot org"),
        ("see jоhn@example.соm.", "email", "jоhn@example.соm"),
        ("call plus four nine one five one two three four five six", "phone", "plus four nine one five one two three four five six"),
        ("ip eins neun zwei punkt eins sechs acht punkt eins punkt zwei hier", "ip", "eins neun zwei punkt eins sechs acht punkt eins punkt zwei"),
        ("４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
        ("a​b@c.de", "email", "a​b@c.de"),
        ("from jоhn.smith@example.com to me", "email", "jоhn.smith@example.com"),
        ("first (dot) last@host.org", "email", "first (dot) last@host.org"),
        ("at john.doe@mail.example [dot] com", "email", "john.doe@mail.example [dot] com"),
        ("to john AT host DOT org now", "email", "john AT host DOT org"),
        ("ip 10 dot 1 dot 2 dot 3 here", "ip", "10 dot 1 dot 2 dot 3"),
        ("mail j o h n (at) host.org", "email", "j o h n (at) host.org"),
        ("we met at home and dot was one two three years old", None, None),
    ],
)
def test_disguises(text, kind, span):
    base, more = pii.spans(text)
    found = [(k, text[a:b]) for k, own in zip(pii.KINDS, more, strict=True) for a, b in own]
    if kind is None:
        assert found == [] and not any(base)
    else:
        assert (kind, span) in found


def thue_morse(a, b, levels=11):
    """Words that a polynomial with an odd base modulo 2**64 cannot tell apart."""
    for _ in range(levels):
        a, b = a + b, b + a
    return a, b


def test_words_made_to_collide_keep_apart(spark):
    words = [*thue_morse("a", "b", 10), *thue_morse("a", "c", 10), *thue_morse("a", "b"), "x" * 300, "x" * 299 + "y"]
    texts = next(slices(pa.array([" ".join(words)])))[2]
    assert len(set(texts.word_hashes().tolist())) == len(set(zip(*(x.tolist() for x in texts.word_names()), strict=True))) == len(words)
    rest = " ".join(f"own{i}" for i in range(34))
    docs = spark.createDataFrame([(i, f"{rest} {w}") for i, w in enumerate(words[:2])], "doc_id long, text string").coalesce(1)
    assert [r.n_removed for r in substring_dedup.substring_dedup(docs).collect()] == [0, 0]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").coalesce(1)
    lower = Tokenizer.from_file(LOWER)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, LOWER).collect()}
    assert got == {i: len(lower.encode(w, add_special_tokens=False).ids) for i, w in enumerate(words)}


def test_revisits_keep_their_own_payload_where_ids_repeat(spark, tmp_path):
    a, b = "a" * 200, "b" * 200
    pages = spark.createDataFrame([(1, "u", a), (1, "u", b), (3, "u", b)], "page_id long, url string, html string")
    warc.write_warc(pages, f"{tmp_path}/warc")
    got = warc.read_warc(spark, f"{tmp_path}/warc").collect()
    digest = {x: hashlib.sha256(x.encode()).hexdigest() for x in (a, b)}
    same([(r.page_id, r.payload_digest, r.payload.decode(), r.complete) for r in got], [(1, digest[a], a, True), (1, digest[b], b, True), (3, digest[b], b, True)])
