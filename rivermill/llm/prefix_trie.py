"""Trie of conversations: a node for each distinct beginning, and what it would save.

Turns get numbers from a dictionary. Distinct sequences of numbers are dealt out by range,
so a shard holds neighbours in order, and each shard builds a ternary search tree of its
own. A node whose sequences reach over a shard's edge lies on the path of the neighbouring
shard's nearest sequence; such nodes are summed over the shards, all others are whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import grouped, materialise, words_in

#: Turns of distinct sequences in a shard, about.
SHARD_TURNS = 1 << 16
#: Conversations that end alike are listed in runs of 2 ** RUN_BITS ids, one behind the other.
RUN_BITS = 12
_TOTALS = "n long, children long, leaves long, saved long"
_NODE = f"name binary, parent binary, up array<binary>, parent_least long, turn_id long, depth long, words long, least long, ending string, {_TOTALS}"


# -- sequences -----------------------------------------------------------------------


def encode(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(sequences, dictionary) of a table with a row for each turn.

    sequences: conv_id, ids and words, the dictionary number and the words of each turn in
    the order of turn numbers, null first. Turns with the same number, repeated rows
    among them, all count; they are ordered by their digest. A null role or text is empty.
    Rows without an id belong to no conversation and are left out; other columns are
    ignored. A conversation's numbers, not its texts, are held as one row.

    dictionary: digest and turn_id of each different (role, text).
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"), words_in(text).alias("words"))
    turns = materialise(turns, "turns")
    dictionary = materialise(turns.select("digest").distinct().withColumn("turn_id", F.monotonically_increasing_id()), "dictionary")
    place = F.struct("turn", "digest", "turn_id", "words")
    listed = turns.join(dictionary, "digest").groupBy("conv_id").agg(F.sort_array(F.collect_list(place)).alias("t"))
    return listed.select("conv_id", F.col("t.turn_id").alias("ids"), F.col("t.words").alias("words")), dictionary


# -- one shard -----------------------------------------------------------------------


class TernaryTree:
    """Sequences of numbers: a node has lower and higher siblings and its first child.

    Node 0 is the root; a node's number is above its parent's.
    """

    def __init__(self) -> None:
        self.symbol, self.words, self.parent, self.depth = [-1], [0], [-1], [0]
        self.low, self.high, self.child = [-1], [-1], [-1]

    def __len__(self) -> int:
        return len(self.symbol)

    def _new(self, symbol: int, words: int, parent: int) -> int:
        self.symbol.append(symbol)
        self.words.append(words)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for side in (self.low, self.high, self.child):
            side.append(-1)
        return len(self.symbol) - 1

    def insert(self, ids: Sequence[int], words: Sequence[int]) -> int:
        """The node where the sequence ends."""
        symbol, low, high, child, parent = self.symbol, self.low, self.high, self.child, 0
        for s, w in zip(ids, words, strict=True):
            at = child[parent]
            if at < 0:
                at = child[parent] = self._new(s, w, parent)
            while symbol[at] != s:
                side = low if s < symbol[at] else high
                if side[at] < 0:
                    side[at] = self._new(s, w, parent)
                at = side[at]
            parent = at
        return parent

    def path(self, ids: Sequence[int]) -> Iterator[int]:
        """The nodes of the longest beginning of the sequence that the tree has."""
        at = 0
        yield at
        for s in ids:
            at = self.child[at]
            while at >= 0 and self.symbol[at] != s:
                at = self.low[at] if s < self.symbol[at] else self.high[at]
            if at < 0:
                return
            yield at


def balanced(ids: list[list[int]], words: list[list[int]]) -> tuple[TernaryTree, list[int]]:
    """A tree of the sequences, the median of each range before its halves, so that siblings
    stay balanced; and the node where each ends."""
    order = sorted(range(len(ids)), key=ids.__getitem__)
    tree, ends, ranges = TernaryTree(), [0] * len(ids), [(0, len(ids))]
    while ranges:
        lo, hi = ranges.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            ends[order[mid]] = tree.insert(ids[order[mid]], words[order[mid]])
            ranges += [(lo, mid), (mid + 1, hi)]
    return tree, ends


def solve(table: pa.Table) -> list[pa.Array]:
    """Nodes of a shard's sequences. Rows with n = 0 are the neighbours' nearest sequences: nodes
    on their paths are shared with other shards and hold what this one adds to them."""
    own = table.filter(pc.greater(table["n"], 0))
    near = table.filter(pc.equal(table["n"], 0))
    tree, ends = balanced(own["ids"].to_pylist(), own["words"].to_pylist())
    size = len(tree)
    shared = [False] * size
    for ids in near["ids"].to_pylist():
        for at in tree.path(ids):
            shared[at] = True
    n, least, ending = [0] * size, [None] * size, [None] * size
    for at, count, first, name in zip(ends, own["n"].to_pylist(), own["least"].to_pylist(), own["ending"].to_pylist(), strict=True):
        n[at], least[at], ending[at] = count, first, name
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for at in range(size - 1, -1, -1):  # children come after their parent
        if not shared[at]:
            leaves[at] += children[at] == 0
            saved[at] += (n[at] - 1) * tree.words[at]
        up = tree.parent[at]
        if up >= 0:
            n[up] += n[at]
            least[up] = least[at] if least[up] is None else min(least[up], least[at])
            children[up] += not shared[at]
            leaves[up] += leaves[at] * (not shared[at])
            saved[up] += saved[at] * (not shared[at])
    names, above = shared_names(tree, shared)
    over = [tree.parent[at] for at in range(size)]
    parent_least = [least[up] if up >= 0 and not shared[up] else None for up in over]
    parent = [names.get(up) for up in over]
    up = [above.get(at) for at in range(size)]
    columns = [[names.get(at) for at in range(size)], parent, up, parent_least, tree.symbol, tree.depth, tree.words, least, ending, n, children, leaves, saved]
    kinds = [pa.binary(), pa.binary(), pa.list_(pa.binary()), *[pa.int64()] * 5, pa.string(), *[pa.int64()] * 4]
    return [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]


def shared_names(tree: TernaryTree, shared: list[bool]) -> tuple[dict[int, bytes], dict[int, list[bytes]]]:
    """Of each shared node: a 128-bit name of its path, and the names 1, 2, 4, ... above it."""
    states, names, above = {}, {}, {}
    for at in range(len(tree)):
        if shared[at]:
            state = states[tree.parent[at]].copy() if at else hashlib.blake2b(digest_size=16)
            state.update(b"%d," % tree.symbol[at])
            states[at], names[at] = state, state.digest()
            # 2 * k above a node is k above the one that lies k above it.
            above[at] = [tree.parent[at]] if at else []
            while at and len(above[above[at][-1]]) >= len(above[at]):
                above[at].append(above[above[at][-1]][len(above[at]) - 1])
    return names, {at: [names[x] for x in xs] for at, xs in above.items()}


# -- the trie ------------------------------------------------------------------------


def trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A node for each distinct beginning of the sequences, from the empty one.

    sequences: conv_id (each once), ids, words. An empty sequence ends at the root. An empty
    table has no nodes. Returns conv_id (the least member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (what members beyond the first repeat, over
    the subtree), ends_sha256 (of the ids of members that end here) and turn_id, the
    dictionary number of the last turn (-1 at the root).

    Equal sequences are counted before they are dealt out, and a beginning that very many
    share is cut wherever a range ends. The ids that end at one node are listed in
    bounded runs and hashed one run after the other, without holding them.
    """
    members = materialise(sequences.select("conv_id", "ids", "words", F.md5(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ending")), "members")
    distinct = materialise(members.groupBy("ending").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("ids").alias("ids"), F.first("words").alias("words")), "sequences")
    shards = (distinct.agg(F.sum(F.size("ids"))).first()[0] or 0) // shard_turns + 1
    dealt = materialise(distinct.repartitionByRange(shards, "ids").withColumn("shard", F.spark_partition_id()), "shards")
    nodes = materialise(grouped(dealt.unionByName(_neighbours(dealt), allowMissingColumns=True), "shard", solve, _NODE), "nodes")
    whole, shared = nodes.filter("name IS NULL"), _merged(nodes.filter("name IS NOT NULL"))
    above = shared.select(F.col("name").alias("parent"), F.col("least").alias("above"))
    below = whole.filter("parent IS NOT NULL").unionByName(shared.select(whole.columns)).join(above, "parent", "left").withColumn("parent_least", F.col("above"))
    every = whole.filter("parent IS NULL").unionByName(below.select(whole.columns))
    none = hashlib.sha256(b"").hexdigest()
    return every.join(ends(members), "ending", "left").select(
        F.col("least").alias("conv_id"), "depth", F.col("parent_least").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "turn_id",
    )


def _neighbours(dealt: DataFrame) -> DataFrame:
    """For each shard the last sequence before it and the first one after it."""
    bounds = dealt.groupBy("shard").agg(F.min("ids").alias("lo"), F.max("ids").alias("hi"))
    order = Window.orderBy("shard")  # a row for each shard
    near = bounds.select("shard", F.array(F.lag("hi").over(order), F.lead("lo").over(order)).alias("near"))
    return near.select("shard", F.explode("near").alias("ids")).filter("ids IS NOT NULL").withColumn("n", F.lit(0).cast("long"))


def _merged(parts: DataFrame) -> DataFrame:
    """Shared nodes: their parts summed, then the sums of the shared nodes below added by
    doubling steps, each round to twice the distance."""
    same = [F.first(c, ignorenulls=True).alias(c) for c in ("parent", "up", "turn_id", "depth", "words", "ending")]
    own = parts.groupBy("name").agg(*same, F.min("least").alias("least"), *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")])
    own = materialise(own, "shared")
    below = own.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("more"))
    own = own.join(below, "name", "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0))).drop("more")
    own = own.withColumns({"leaves": F.col("leaves") + (F.col("children") == 0).cast("long"), "saved": F.col("saved") + (F.col("n") - 1) * F.col("words")})
    own = materialise(own, "shared")
    for k in range(int(own.agg(F.max("depth")).first()[0] or 0).bit_length()):
        added = own.filter(F.size("up") > k).groupBy(F.col("up")[k].alias("name")).agg(F.sum("leaves").alias("more"), F.sum("saved").alias("most"))
        own = own.join(added, "name", "left").withColumns({"leaves": F.col("leaves") + F.coalesce("more", F.lit(0)), "saved": F.col("saved") + F.coalesce("most", F.lit(0))}).drop("more", "most")
        own = materialise(own, "shared")
    return own.withColumn("parent_least", F.lit(None).cast("long"))


def ends(members: DataFrame) -> DataFrame:
    """ending, ends_sha256: the hash of the ascending ids of members that end alike."""
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))
    runs = members.groupBy("ending", F.shiftright("conv_id", RUN_BITS).alias("run")).agg(F.concat_ws(",", ids).alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("ending").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if name == last:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((last, state.hexdigest()))
                last, state = name, hashlib.sha256(ids.encode())
            yield _pairs(done)
        if state is not None:
            yield _pairs([(last, state.hexdigest())])

    return runs.repartition("ending").sortWithinPartitions("ending", "run").select("ending", "ids").mapInArrow(hashed, "ending string, ends_sha256 string")


def _pairs(done: list[tuple[str, str]]) -> pa.RecordBatch:
    columns = [pa.array([x[k] for x in done], pa.string()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, ["ending", "ends_sha256"])
