"""Spelling variants against brute force, with few and with many symbols."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rivermill.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            w = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n):
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(near[w]), form[w] and n[form[w]]))
    return sorted(rows)


def made(seed):
    """Words of few letters, so that many are near; a hot word, null and long texts, null ids."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abéß") for _ in range(rng.randint(4, 7))) for _ in range(120)]
    weighted = [w for k, w in enumerate(stems) for _ in range(1 + 600 // (k + 3))]
    rows = [(i, " ".join(rng.choice([str.upper, str.title, str])(rng.choice(weighted)) for _ in range(60))) for i in range(60)]
    rows += [(None, "word5word naïveté × ÷ naïveté naïveté Ārgh"), (7, None), (8, ""), (9, " . \n"), (7, rows[7][1]), (7, rows[7][1]), (61, "hotword " * 5000)]
    return rows


def test_words_equal_brute_force(spark, monkeypatch):
    rows = made(1)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "id", "key")})
    for size in (1 << 22, 100):
        monkeypatch.setattr(spelling, "SLICE_BYTES", size)
        assert {r.word: r.n for r in spelling.words_of(df).collect()} == brute_words(rows)


@pytest.mark.parametrize("symbols", [1, 4, 9, None])
def test_variants_equal_brute_force(spark, symbols):
    n = brute_words(made(2))
    assert sum(r[1] is not None for r in brute_variants(n)) > 20
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = sorted(tuple(r) for r in spelling.variants(words, symbols=symbols).collect())
    assert got == brute_variants(n)


def test_ties_and_long_ways_to_the_root(spark):
    """Each word has twice the n of the one before; two words tie for a form."""
    n = {"a" * (5 + k): 3 * 2**k for k in range(24)} | {"bbbbb": 3, "bbbbc": 9, "bbbba": 9}
    got = sorted(tuple(r) for r in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect())
    assert got == brute_variants(n)
    assert {r[0]: r[2] for r in got}["aaaaa"] == "a" * 28


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.words_of(docs)).collect() == []


@pytest.mark.parametrize("symbols", [1, 3])
def test_neighbours_come_once_each_as_rows(spark, symbols):
    """Without an array of them, which interpreted lambdas would fill."""
    signs, shorts = [chr(spelling._FIRST_SYMBOL + s) for s in range(symbols)], ["0", "00", "0000", "01210"[:3 + symbols // 2]]
    made = spelling.with_neighbours(spark.createDataFrame([(w,) for w in shorts], "short string"), symbols)
    wanted = set()
    for w in shorts:
        for i in range(len(w) + 1):
            wanted |= {(w, w), *((w, w[:i] + x + w[i:]) for x in signs), *((w, w[:i] + x + w[i + 1 :]) for x in ["", *signs] if i < len(w))}
    assert sorted(map(tuple, made.collect())) == sorted(wanted)
    assert "lambda" not in made._jdf.queryExecution().toString()
