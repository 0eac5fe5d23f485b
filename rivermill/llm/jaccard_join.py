"""Near duplicates by word shingles: a chosen-path similarity join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graphs import components
from .shared import WORD, Texts, gram_hashes, grouped, lists, materialise, mix, slices, split_by_keys, whole_grams

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.99
#: Sampled tokens that stand for a set: its least shingles under so many hash functions.
TOKENS = 64
#: A bucket of more sets is split again, up to DEEPEST times, which the join's runs allow for;
#: levels that runs_for counts if none are named.
LIMIT, DEEPEST, LEVELS = 512, 6, 4
#: Sets that are compared at once.
BLOCK = 512
#: Hash functions of a sketch, whose least shingles it keeps a byte of (those of the tokens come
#: first), and how much lower its estimate may be than SIMILARITY: 4.5 standard deviations.
PRINTS, SLACK = 192, 0.13
_SALTS = np.random.default_rng(5).integers(1, 1 << 62, PRINTS, np.uint64) * np.uint64(2) + np.uint64(1)


def runs_for(recall: float, similarity: float, levels: int = LEVELS) -> int:
    """Runs until a pair of that similarity shares a bucket with probability `recall`.

    In a run a bucket is split by one token, and every fourth time by a second; the pair
    goes on together where the token is the same.
    """
    together = 1.0
    for _ in range(levels):
        once = similarity * together
        together = 0.75 * once + 0.25 * (1 - (1 - once) ** 2)
    return math.ceil(math.log(1 - recall) / math.log(1 - together))


# -- sets ----------------------------------------------------------------------------


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(first, values): the set of word shingles of each text, sorted; a text of fewer
    than WORDS words is one shingle, and one without words has none."""
    words = texts.word_hashes()
    sizes = np.diff(texts.first)
    grams = gram_hashes(words, WORDS)
    whole = whole_grams(texts.first, WORDS)[: len(grams)]
    whose, values = np.repeat(np.arange(len(texts)), sizes)[: len(grams)][whole], grams[whole]
    short = np.flatnonzero((sizes > 0) & (sizes < WORDS))
    if len(short):
        alone = np.zeros(len(short), np.uint64)
        for k in range(WORDS - 1):
            more = sizes[short] > k
            alone[more] = mix(alone[more] + words[texts.first[short[more]] + k])
        whose, values = np.concatenate([whose, short]), np.concatenate([values, alone])
    order = np.lexsort((values, whose))
    whose, values = whose[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (whose[1:] != whose[:-1]) | (values[1:] != values[:-1])
    whose, values = whose[new], values[new]
    return np.searchsorted(whose, np.arange(len(texts) + 1)), values


def set_names(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; sets without members get 0."""
    some = first[1:] > first[:-1]
    name = np.zeros(len(some), np.uint64)
    if some.any():
        with np.errstate(over="ignore"):
            name[some] = mix(np.add.reduceat(mix(values), first[:-1][some]) + np.diff(first)[some].astype(np.uint64))
    return name


def sketches(first: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TOKENS sampled tokens of each set, and PRINTS bytes; those of sets without members are 0."""
    some = first[1:] > first[:-1]
    tokens, prints = np.zeros((len(some), TOKENS), np.uint32), np.zeros((len(some), PRINTS), np.uint8)
    if some.any():
        at = first[:-1][some]
        for k, salt in enumerate(_SALTS):
            with np.errstate(over="ignore"):
                least = np.minimum.reduceat((values * salt >> np.uint64(32)).astype(np.uint32), at)
            prints[some, k] = least.astype(np.uint8)
            if k < TOKENS:
                tokens[some, k] = least
    return tokens, prints


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, texts in slices(batch.column("text")):
            first, values = shingles(texts)
            tokens, prints = sketches(first, values)
            ends = pa.py_buffer((np.arange(hi - lo + 1) * PRINTS).astype(np.int32))
            arrays = [batch.column("doc_id")[lo:hi], batch.column("text_key")[lo:hi], pa.array(set_names(first, values).view(np.int64)), pa.array(np.diff(first), pa.int32())]
            arrays += [lists(np.arange(hi - lo + 1) * TOKENS, tokens.ravel().view(np.int32), pa.int32()), pa.Array.from_buffers(pa.binary(), hi - lo, [None, ends, pa.py_buffer(prints)])]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "cls", "n", "tokens", "prints"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, texts in slices(batch.column("text")):
            first, values = shingles(texts)
            yield pa.RecordBatch.from_arrays([pa.array(set_names(first, values).view(np.int64)), lists(first, values.view(np.int64), pa.int64())], ["cls", "members"])


# -- paths ---------------------------------------------------------------------------


def leaves(sets: DataFrame, runs: int) -> DataFrame:
    """leaf, cls, side: what is compared, the small buckets of all runs that hold more than one
    set, and large ones in pairs of blocks (side).

    A bucket is a path of tokens. Its own hash chooses which sampled tokens split it, so
    all its sets are split alike. Buckets of one set are dropped, those of up to LIMIT sets
    are leaves, larger ones are split again. A bucket that is still larger at the deepest level
    is dealt into blocks of about BLOCK sets, each pair of which is a leaf.
    """
    here = sets.select("cls", "tokens", F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("run")).select("cls", "tokens", F.xxhash64("run").alias("path"))
    done = None
    for level in range(DEEPEST):
        first = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(TOKENS)).cast("int")
        second = F.pmod(F.xxhash64("path", F.lit(2)), F.lit(TOKENS)).cast("int")
        twice = F.pmod(F.xxhash64("path", F.lit(3)), F.lit(4)) == 0
        chosen = F.explode(F.when(twice, F.array_distinct(F.array(first, second))).otherwise(F.array(first)))
        split = here.select("cls", "tokens", "path", chosen.alias("at")).select("cls", F.xxhash64("path", "at", F.element_at("tokens", F.col("at") + 1)).alias("path"))
        split = materialise(split, f"level{level}")
        sizes = materialise(split.groupBy("path").count().filter("count > 1"), f"sizes{level}")
        found = split.join(sizes.filter(F.col("count") <= LIMIT), "path", "left_semi").select(F.col("path").alias("leaf"), "cls", F.lit(0).alias("side"))
        done = found if done is None else done.unionByName(found)
        large = sizes.filter(F.col("count") > LIMIT)
        if level == DEEPEST - 1 or not large.limit(1).count():
            break
        here = split.join(large, "path", "left_semi").join(sets.select("cls", "tokens"), "cls")
    dealt = split.join(large.select("path", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "path")
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("path", F.least("side", "other"), F.greatest("side", "other"))
    return materialise(done.unionByName(dealt.select(pair.alias("leaf"), "cls", "side")), "leaves")


def _alike(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the sets of a leaf whose sketches say that they may be similar; of a pair
    of blocks, only sets of different blocks are compared."""
    cls, at = np.unique(table["cls"].to_numpy(), return_index=True)
    packed = table["prints"].combine_chunks()
    begin = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset]
    prints = np.frombuffer(packed.buffers()[2], np.uint8, len(packed) * PRINTS, begin).reshape(-1, PRINTS)[at]
    side = table["side"].to_numpy()[at]
    blocks = [np.flatnonzero(side == s) for s in np.unique(side)]
    mine, others = blocks[0], blocks[-1]
    root = np.arange(len(cls))
    for lo in range(0, len(mine), 256):
        for other in range(lo if others is mine else 0, len(others), 256):
            a, b = mine[lo : lo + 256], others[other : other + 256]
            same = np.zeros((len(a), len(b)), np.uint8)
            for k in range(PRINTS):
                same += prints[a, k, None] == prints[None, b, k]
            x, y = np.nonzero(same >= (SIMILARITY - SLACK) * PRINTS)
            merge(root, a[x], b[y])
    joined = root != np.arange(len(cls))
    return cls[joined], cls[root[joined]]


def merge(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Let root name the least member of each component, with edges x-y added."""
    while True:
        a, b = root[x], root[y]
        low = np.minimum(a, b)
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (root[root] != root).any():
            root[:] = root[root]
        if (root == before).all():
            return


# -- exact check ---------------------------------------------------------------------


def _links(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """cls, links, other: for the sets of a group, how many documents of other classes
    are similar, and the least similar class that is joined to it; part pairs a block of a
    large group with another one, and then only pairs across the two count."""
    cls, size, side = (table[c].to_numpy() for c in ("cls", "size", "side"))
    members = table["members"].combine_chunks()
    counts = members.value_lengths().to_numpy().astype(np.int64)
    ids = np.unique(members.flatten().to_numpy(), return_inverse=True)[1]
    whose = np.repeat(np.arange(len(cls)), counts)
    often = np.bincount(ids)
    wanted = often[ids] > 1
    ids, whose = (np.cumsum(often > 1) - 1)[ids[wanted]], whose[wanted]
    order = np.argsort(ids, kind="stable")
    ids, whose = ids[order], whose[order]
    n, most = len(cls), int(ids[-1]) + 1 if len(ids) else 0
    shared = np.zeros((n, n), np.float32)
    for lo in range(0, most, 4096):
        a, b = np.searchsorted(ids, [lo, lo + 4096])
        has = np.zeros((n, min(4096, most - lo)), np.float32)
        has[whose[a:b], ids[a:b] - lo] = 1
        shared += has @ has.T
    similar = (1 + SIMILARITY) * shared.astype(np.float64) >= SIMILARITY * (counts[:, None] + counts[None, :]) - 1e-6
    np.fill_diagonal(similar, False)
    if (side != side[0]).any():
        similar &= side[:, None] != side[None, :]
    links = similar @ size
    least, before = cls, None
    while before is None or (least != before).any():  # the least class goes from set to set
        before = least
        least = np.minimum(least, np.where(similar, least, np.iinfo(np.int64).max).min(1))
    found = np.flatnonzero(links > 0)
    return cls[found], links[found], least[found]


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, cls, n, tokens, prints of each document; cls names its set of shingles."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("text_key"))
    return materialise(own.mapInArrow(_sketch, "doc_id long, text_key long, cls long, n int, tokens array<int>, prints binary"), "sketches")


def similar_classes(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, recall: float) -> DataFrame:
    """cls, root, links of the classes that are similar to another one: the least class of
    their group, and how many documents of other classes each of their documents is similar to."""
    sets = materialise(rows.filter("n > 0").groupBy("cls", "tokens", "prints").agg(F.min(F.struct("doc_id", "text_key")).alias("one"), F.count(F.lit(1)).alias("size")), "classes")
    leaf = leaves(sets, runs_for(recall, SIMILARITY, DEEPEST))
    groups = components(grouped(leaf.join(sets.select("cls", "prints"), "cls"), "leaf", _alike, "a long, b long"))
    wanted = materialise(groups.join(sets.select("cls", "one", "size"), groups["node"] == F.col("cls")).select("cls", "root", "one.*", "size"), "wanted")
    # One document of each class is read again, for its whole set; of repeated rows one is left.
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("key"))
    # Most documents are near no other one: a filter lets them go before the shuffle.
    own, _ = split_by_keys(own, own["key"], wanted.select("text_key"))
    texts = own.join(wanted.select("doc_id", "text_key"), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left_semi")
    members = materialise(texts.select("text").mapInArrow(_sets, "cls long, members array<bigint>").dropDuplicates(["cls"]), "members")
    sizes = materialise(wanted.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "blocks")
    dealt = wanted.join(sizes, "root").withColumn("side", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    part = F.xxhash64("root", F.least("side", "other"), F.greatest("side", "other"))
    found = materialise(grouped(dealt.select("cls", "size", "side", part.alias("part")).join(members, "cls"), "part", _links, "cls long, links long, other long"), "links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    exact = components(found.select(F.col("cls").alias("a"), F.col("other").alias("b")))
    return materialise(exact.select(F.col("node").alias("cls"), "root").join(links, "cls").select("cls", "root", "links"), "similar")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def jaccard_join(docs: DataFrame, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Join documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

    Documents of one set of shingles form a class, and only one of each goes on. It is
    stood for by its least shingles under TOKENS hash functions. In each of several runs the
    classes are split by sampled tokens that they share, bucket by bucket, until buckets are
    small; there all sketches are compared, and those of buckets that no split parts in pairs of
    blocks of BLOCK sets. `recall` sets the number of runs. What is
    alike in any run forms groups, and within each group all sets are compared exactly, large
    groups in pairs of blocks of BLOCK sets, so counts of links are complete for a group.
    The work of that last step grows with the square of a group's different texts; no pairs
    are written, only counts and one edge for each set.

    A document without words has no shingles: it is alone, also beside its like. A text of
    one to four words is a single shingle. Ids may be null (class_id is then that of
    others in the group, else null), rows may repeat and count as copies; other columns are
    ignored; an empty table gives no rows.

    Returns doc_id, class_id (the least doc_id of all documents joined directly or through
    others), rep_id (the least doc_id with the same set), n_copies (other documents
    with the same set), n_links (all other documents that are similar, copies included).
    """
    rows = sketch(docs, id_col, text_col)
    named = rows.select("doc_id", "cls", "n")
    similar = similar_classes(docs, rows, id_col, text_col, recall)
    classes = named.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("size"))
    classes = materialise(classes.join(similar, "cls", "left").select("cls", "rep_id", "size", F.coalesce("root", "cls").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "named")
    roots = materialise(classes.groupBy("root").agg(F.min("rep_id").alias("class_id")), "roots")
    whole = materialise(classes.join(roots, "root").drop("root"), "whole")
    joined = named.filter("n > 0").join(whole, "cls").select("doc_id", "class_id", "rep_id", (F.col("size") - 1).alias("n_copies"), (F.col("links") + F.col("size") - 1).alias("n_links"))
    alone = named.filter("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("rep_id"), F.lit(0).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return joined.unionByName(alone)


def keep_one(docs: DataFrame, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group of similar ones: that with the least doc_id, nulls
    last. Repeated rows count as copies, so one of them stays; documents without words
    all stay. Columns are those of docs."""
    rows = sketch(docs, id_col, text_col)
    similar = similar_classes(docs, rows, id_col, text_col, recall)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    group = rows.filter("n > 0").join(similar.select("cls", "root"), "cls", "left").groupBy(F.coalesce("root", "cls").alias("root"))
    stays = materialise(group.agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("_n")).select(F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key"), "_n"), "stays")
    wordless = ~F.coalesce(docs[text_col], F.lit("")).rlike(WORD)

    def among(table: DataFrame) -> Column:
        return docs[id_col].cast("long").eqNullSafe(table["_id"]) & (text_key(docs[text_col]) == table["_key"])

    # Documents alone in their group pass straight through; only the others meet `stays`.
    grouped_rows = rows.filter("n > 0").select("doc_id", F.col("text_key").alias("_key"))
    lone = stays.filter("_n = 1")
    many = grouped_rows.join(lone, grouped_rows["doc_id"].eqNullSafe(lone["_id"]) & (grouped_rows["_key"] == lone["_key"]), "left_anti")
    maybe, straight = split_by_keys(docs.filter(~wordless), text_key(docs[text_col]), materialise(many.select("_key"), "many"))
    kept = maybe.join(stays, among(stays), "left_semi")
    repeated = rows.filter("n > 0").groupBy("doc_id", "text_key").count().filter("count > 1").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    repeated = materialise(repeated, "repeated")
    if repeated.limit(1).count():
        once = kept.join(repeated, among(repeated), "left_semi").dropDuplicates([id_col, text_col])
        kept = kept.join(repeated, among(repeated), "left_anti").unionByName(once)
    kept = kept.unionByName(straight)
    return kept.unionByName(docs.filter(wordless))
