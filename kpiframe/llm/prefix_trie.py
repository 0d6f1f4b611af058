"""Conversation prefix trie: double arrays per prefix shard, upper nodes merged.

A conversation is a sequence of turns ``(role, text)``; every distinct sequence
of its first d turns is a node. The nodes, with their aggregates, come about so:

1. Turns are reduced to two 64-bit hashes and a length, ordered, and given a
   128-bit name of the prefix that they end: the exclusive or of a hash of each
   turn and its place. A conversation is cut into slabs of neighbouring turns
   for this, whose sizes and names are then added up, so one that holds a third
   of all rows is many tasks' work. Equal conversations become one weighted one.
2. Prefixes of ``FIRST_CUT`` turns are shards. One with more than ``SHARD_ROWS``
   rows below it is cut at twice that depth, and so on. What lies below the cuts
   is dealt by shard. A task gives the turns of its shards dense ids, packs a
   trie into BASE and CHECK arrays (the child of node s by turn c is slot
   ``BASE[s] + c``, and ``CHECK`` of that slot is s), walks all sequences
   through it, adding weights up at the nodes they pass, and sums subtrees.
3. Nodes above the cuts are shared by shards. Their members and children are
   grouped sums over the paths that lead to the shards. For sums over subtrees,
   every node counts on the path of its smallest member only; each path is summed
   from its end, and a node adds up the sums of its paths at its depth.
4. The ids that end at a node are sorted over all tasks, joined into pieces of
   ``PIECE`` ids, and the pieces of a node run through one SHA-256.

Turns are ordered by turn, null first; those with equal turns by the hashes of
role and text, so equal rows are turns one after the other. Defined cases: null
role or text is empty; rows with a null conv_id take no part; an empty table has
no nodes, not even a root; extra columns are not read. Text lengths are code
points. Two turns or prefixes that differ are told apart by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

FIRST_CUT = 6
SHARD_ROWS = 100_000
PIECE = 256
HEADS, BLOCK = 6, 100
#: Holes of the double array that a node with several children tries first.
TRIES = 64
FREE = -1
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, p1 long, p2 long, q1 long, q2 long, is_top boolean")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def ranked(conversations: DataFrame) -> DataFrame:
    """(conv_id, slab, rank, t1, t2, n): the turns, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = ["turn", "t1", "t2", "tie"]
    slabs = materialise(
        conversations.where("conv_id IS NOT NULL")
        .select(F.col("conv_id").cast("long"), "turn", F.xxhash64(F.lit(1), role, text).alias("t1"),
                F.xxhash64(F.lit(2), text, role).alias("t2"), F.length(text).cast("long").alias("n"),
                F.monotonically_increasing_id().alias("tie"))
        .repartitionByRange("conv_id", *order).withColumn("slab", F.spark_partition_id()))
    sizes = slabs.groupBy("conv_id", "slab").agg(F.count(F.lit(1)).alias("size"))
    places = sizes.select("conv_id", "slab", F.coalesce(F.sum("size").over(_before()), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "slab").orderBy(*order))
    return materialise(
        slabs.select("*", inside.alias("inside")).join(places, ["conv_id", "slab"])
        .select("conv_id", "slab", (F.col("before") + F.col("inside")).alias("rank"), "t1", "t2", "n"))


def _before():
    return Window.partitionBy("conv_id").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations of ranked turns: their rows by place, and their lengths."""
    return (turns.withColumnRenamed("rank", "pos"),
            turns.groupBy("conv_id").agg(F.max("rank").alias("length")))


def rebuilt(turns: DataFrame, heads: int = HEADS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The same where conversation c begins with the first h turns of
    c - c % block, h = crc32(c) % heads, instead of its own first h."""
    base = F.col("conv_id") - F.col("conv_id") % block
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    turn = F.struct("rank", "t1", "t2", "n")
    first = (turns.where((F.col("conv_id") % block == 0) & (F.col("rank") < heads))
             .groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("first")))
    none = F.array().cast("array<struct<rank:bigint,t1:bigint,t2:bigint,n:bigint>>")
    info = materialise(
        turns.groupBy("conv_id").agg(F.max("rank").alias("total")).select("*", base.alias("base"), h.alias("h"))
        .join(first, "base", "left")
        .select("conv_id", "h", "total", F.coalesce(F.slice("first", F.lit(1), F.col("h")), none).alias("given"))
        .select("*", F.size("given").alias("n_given")))
    own = (turns.join(info.select("conv_id", "h", "n_given"), "conv_id").where("rank > h")
           .select("conv_id", "slab", (F.col("rank") - F.col("h") + F.col("n_given")).alias("pos"), "t1", "t2", "n"))
    given = (info.select("conv_id", F.lit(-1).alias("slab"), F.posexplode("given").alias("at", "turn"))
             .select("conv_id", "slab", (F.col("at") + 1).cast("long").alias("pos"), "turn.t1", "turn.t2", "turn.n"))
    length = F.col("n_given") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    return own.unionByName(given), info.select("conv_id", length.alias("length"))


def prefixes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The rows and a textless one at place 0, each with its prefix's name
    (p1, p2), its parent's (q1, q2) and its conversation's length."""
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", F.lit(-1).alias("slab"), zero.alias("pos"), zero.alias("t1"), zero.alias("t2"),
                           zero.alias("n"))
    z = [F.when(F.col("pos") == 0, zero).otherwise(F.xxhash64(F.lit(i), "pos", "t1", "t2")).alias(f"z{i}") for i in (1, 2)]
    rows = rows.unionByName(roots).select("*", *z)
    slabs = rows.groupBy("conv_id", "slab").agg(F.bit_xor("z1").alias("a1"), F.bit_xor("z2").alias("a2"))
    offsets = (slabs.select("conv_id", "slab", *[F.coalesce(F.bit_xor(f"a{i}").over(_before()), zero).alias(f"b{i}")
                                                 for i in (1, 2)]).join(lengths, "conv_id"))
    run = (Window.partitionBy("conv_id", "slab").orderBy("pos")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    named = (rows.select("*", *[F.bit_xor(f"z{i}").over(run).alias(f"r{i}") for i in (1, 2)])
             .join(offsets, ["conv_id", "slab"]))
    p = [F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)]
    return materialise(named.select(
        "conv_id", "pos", "length", "t1", "t2", "n", p[0].alias("p1"), p[1].alias("p2"),
        p[0].bitwiseXOR(F.col("z1")).alias("q1"), p[1].bitwiseXOR(F.col("z2")).alias("q2")))


class DoubleArray:
    """A trie whose nodes are slots of BASE and CHECK; slot 0 is the root."""

    def __init__(self):
        self.base, self.check = np.zeros(1024, np.int64), np.full(1024, FREE, np.int64)
        self.check[0] = 0
        self.end, self.holes = 1, []

    def _reach(self, slot: int) -> None:
        if slot >= len(self.check):
            more = max(slot + 1 - len(self.check), len(self.check))
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, FREE, np.int64)])

    def _single(self, n: int) -> np.ndarray:
        """``n`` free slots, holes first."""
        taken = self.holes[:n]
        del self.holes[:n]
        fresh = np.arange(self.end, self.end + n - len(taken))
        self.end += len(fresh)
        self._reach(self.end)
        return np.concatenate([np.array(taken, np.int64), fresh])

    def _several(self, codes: np.ndarray) -> np.ndarray:
        """Free slots for codes, apart as the codes are: the first fit among
        some holes, else behind all."""
        reach = codes - codes[0]
        for hole in self.holes[:TRIES]:
            slots = hole + reach
            self._reach(int(slots[-1]))
            if (self.check[slots] == FREE).all():
                break
        else:
            slots = self.end + reach
            self._reach(int(slots[-1]))
        used = set(slots.tolist())
        if slots[0] < self.end:
            self.holes = [x for x in self.holes if x not in used]
        if slots[-1] >= self.end:
            self.holes += [x for x in range(self.end, int(slots[-1])) if x not in used]
            self.end = int(slots[-1]) + 1
        return slots

    def pack(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Slots of children, given by ascending parent and code, of nodes that
        have none yet."""
        starts = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        sizes = np.diff(np.r_[starts, len(parents)])
        slots = np.empty(len(parents), np.int64)
        for start, size in zip(starts[sizes > 1], sizes[sizes > 1]):
            some = slice(start, start + size)
            slots[some] = self._several(codes[some])
            self.check[slots[some]] = parents[start]
        alone = starts[sizes == 1]
        slots[alone] = self._single(len(alone))
        self.check[slots] = parents
        self.base[parents[starts]] = slots[starts] - codes[starts]
        return slots

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of nodes by codes; all must be there."""
        to = self.base[nodes] + codes
        if (self.check[to] != nodes).any():
            raise KeyError("a sequence left the trie")
        return to


def _trie(c: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Nodes of the sequences of some shards; rows by conversation and place,
    the first of each being the shard's own node."""
    top = c["pos"] == c["cut"]
    start = np.flatnonzero(top)
    size = np.diff(np.r_[start, len(top)])
    # a shard stands for the turns above it
    turn = np.column_stack([top, np.where(top, c["p1"], c["t1"]), np.where(top, c["p2"], c["t2"])]).astype(np.int64)
    order = np.lexsort(turn.T)
    new = np.r_[True, (turn[order][1:] != turn[order][:-1]).any(axis=1)]
    turn_of = np.empty(len(order), np.int64)
    turn_of[order] = np.cumsum(new) - 1
    n_turns = int(new.sum())
    code = np.full(n_turns, -1, np.int64)  # dense ids, in the order of meeting, so that siblings are neighbours
    known, trie = 0, DoubleArray()
    state, levels = np.zeros(len(start), np.int64), []
    for level in range(int(size.max())):
        on = np.flatnonzero(size > level)
        pair, back = np.unique(state[on] * n_turns + turn_of[start[on] + level], return_inverse=True)
        parent, turns = np.divmod(pair, n_turns)
        _, met = np.unique(turns, return_index=True)
        met = turns[np.sort(met)]
        met = met[code[met] < 0]
        code[met] = np.arange(known, known + len(met))
        known += len(met)
        sort = np.lexsort((code[turns], parent))
        slots = np.empty(len(pair), np.int64)
        slots[sort] = trie.pack(parent[sort], code[turns][sort])
        state[on] = slots[back]
        levels.append(slots)

    n = len(trie.check)
    convs, children, leaves, row = (np.zeros(n, np.int64) for _ in range(4))
    first = np.full(n, np.iinfo(np.int64).max)
    state[:] = 0
    for level in range(len(levels)):
        on = np.flatnonzero(size > level)
        at = start[on] + level
        state[on] = trie.step(state[on], code[turn_of[at]])
        np.add.at(convs, state[on], c["w"][at])
        np.minimum.at(first, state[on], c["rep"][at])
        row[state[on]] = at
    nodes = np.concatenate(levels)
    parents = trie.check[nodes]
    np.add.at(children, parents, 1)
    leaves[nodes] = children[nodes] == 0
    saved = np.zeros(n, np.int64)
    saved[nodes] = (convs[nodes] - 1) * c["n"][row[nodes]]
    for slots in levels[:0:-1]:
        np.add.at(leaves, trie.check[slots], leaves[slots])
        np.add.at(saved, trie.check[slots], saved[slots])
    at, is_top = row[nodes], parents == 0
    return pa.RecordBatch.from_arrays([
        pa.array(first[nodes]), pa.array(c["pos"][at]), pa.array(first[parents], mask=is_top), pa.array(convs[nodes]),
        pa.array(children[nodes]), pa.array(leaves[nodes]), pa.array(saved[nodes]),
        *[pa.array(c[x][at]) for x in ("p1", "p2", "q1", "q2")], pa.array(is_top)],
        [x.split()[0] for x in NODE.split(", ")])


def _tries(batches):
    """Batches sorted by bin, each a few shards of bounded rows."""
    parts, at = [], None

    def done():
        table = pa.Table.from_batches(parts)
        return _trie({x: table[x].to_numpy() for x in table.column_names})

    for batch in batches:
        bins = batch["bin"].to_numpy()
        cuts = np.flatnonzero(bins[1:] != bins[:-1]) + 1
        for start, end in zip([0, *cuts], [*cuts, len(bins)]):
            if parts and bins[start] != at:
                yield done()
                parts = []
            at = bins[start]
            parts.append(batch.slice(start, end - start))
    if parts:
        yield done()


def _cuts(rows: DataFrame, first_cut: int, shard_rows: int) -> DataFrame:
    """(rep, cut, s1, s2): the shard of each conversation that reaches one."""
    found, depth, hot = None, first_cut, None
    while True:
        at = rows.where(F.col("pos") == depth).select("rep", "p1", "p2", (F.col("length") - depth + 1).alias("below"))
        if hot is not None:
            at = at.join(hot, "rep", "left_semi")
        weights = at.groupBy("p1", "p2").agg((F.sum("below") <= shard_rows).alias("fits"))
        dealt = materialise(at.join(weights, ["p1", "p2"]).select(
            "rep", F.lit(depth).cast("long").alias("cut"), F.col("p1").alias("s1"), F.col("p2").alias("s2"), "fits"))
        here = dealt.where("fits").drop("fits")
        found = here if found is None else found.unionByName(here)
        hot = dealt.where("NOT fits").select("rep")
        if hot.isEmpty():
            return found
        depth *= 2


def _upper(rows: DataFrame, cuts: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes above the cuts, and the tops with their parents."""
    zero = F.lit(0).cast("long")
    paths = tops.select(F.col("conv_id").alias("rep"), F.col("depth").alias("limit"), F.col("n_convs").alias("weight"),
                        F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    short = rows.where("pos = length").join(cuts, "rep", "left_anti").select(
        "rep", (F.col("length") + 1).alias("limit"), F.col("w").alias("weight"), zero.alias("leaves"), zero.alias("saved"))
    on_path = materialise(rows.join(paths.unionByName(short), "rep").where("pos < limit").select(
        "rep", "pos", "n", "p1", "p2", "q1", "q2", "weight", "leaves", "saved"))
    nodes = on_path.groupBy("p1", "p2", "q1", "q2", F.col("pos").alias("depth")).agg(
        F.min("rep").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("n").alias("n"))
    children = (nodes.where("depth > 0").select("q1", "q2").unionByName(tops.select("q1", "q2"))
                .groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("kids")))
    nodes = materialise(nodes.join(children, ["p1", "p2"], "left").select(
        *nodes.columns, F.coalesce("kids", zero).alias("n_children")))
    own = nodes.select(F.col("conv_id").alias("rep"), F.col("depth").alias("pos"),
                       ((F.col("n_convs") - 1) * F.col("n")).alias("own_saved"),
                       (F.col("n_children") == 0).cast("long").alias("own_leaf"))
    below = Window.partitionBy("rep").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = (
        on_path.join(own, ["rep", "pos"], "left")
        .select("p1", "p2", (F.sum(F.coalesce("own_saved", zero)).over(below) + F.col("saved")).alias("saved"),
                (F.sum(F.coalesce("own_leaf", zero)).over(below) + F.col("leaves")).alias("leaves"))
        .groupBy("p1", "p2").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves")))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "p1", "p2", "q1", "q2"]
    both = nodes.join(sums, ["p1", "p2"]).select(*columns).unionByName(tops.select(*columns))
    parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent"))
    return both.join(parents, ["q1", "q2"], "left").select(
        *columns, F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"))


def _pieces(batches):
    """Ids sorted by node as pieces of text that name their first id."""
    for batch in batches:
        p1, p2, ids = (batch[x].to_numpy() for x in ("p1", "p2", "conv_id"))
        cuts = np.flatnonzero((p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])) + 1
        bounds = [(a, min(a + PIECE, end)) for start, end in zip([0, *cuts], [*cuts, len(ids)])
                  for a in range(start, end, PIECE)]
        first = [a for a, _ in bounds]
        yield pa.RecordBatch.from_arrays([
            pa.array(p1[first]), pa.array(p2[first]), pa.array(ids[first]),
            pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in bounds])], ["p1", "p2", "first", "piece"])


def _digests(batches):
    """SHA-256 of each node's pieces, sorted by node and first id."""
    node, sha, done = None, None, []

    def rows():
        return pa.RecordBatch.from_pylist(done, pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("ends", pa.string())]))

    for batch in batches:
        for p1, p2, piece in zip(*(batch[x].to_pylist() for x in ("p1", "p2", "piece"))):
            if (p1, p2) == node:
                sha.update(b",")
            else:
                if node:
                    done.append({"p1": node[0], "p2": node[1], "ends": sha.hexdigest()})
                node, sha = (p1, p2), hashlib.sha256()
            sha.update(piece.encode())
        yield rows()
        done = []
    if node:
        done.append({"p1": node[0], "p2": node[1], "ends": sha.hexdigest()})
    yield rows()


def _ends(ends: DataFrame) -> DataFrame:
    """(p1, p2, ends): the digest of the sorted ids that end at a node."""
    pieces = (ends.select("p1", "p2", "conv_id").repartitionByRange("p1", "p2", "conv_id")
              .sortWithinPartitions("p1", "p2", "conv_id")
              .mapInArrow(_pieces, "p1 long, p2 long, first long, piece string"))
    return (pieces.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first")
            .mapInArrow(_digests, "p1 long, p2 long, ends string"))


def trie(rows: DataFrame, first_cut: int = FIRST_CUT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the sequences in ``rows``, made by ``prefixes``."""
    ends = rows.where("pos = length").select("p1", "p2", "conv_id")
    classes = ends.groupBy("p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("w"))
    one = materialise(rows.join(classes.select("conv_id", "w"), "conv_id").withColumnRenamed("conv_id", "rep"))
    cuts = _cuts(one, first_cut, shard_rows)
    spark = rows.sparkSession
    bins = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-one.count() // shard_rows))
    lower = materialise(
        one.join(cuts, "rep").where("pos >= cut").drop("length")
        .withColumn("bin", F.pmod(F.xxhash64("s1", "s2"), F.lit(bins)).cast("int")).drop("s1", "s2")
        .repartition(bins, "bin").sortWithinPartitions("bin", "rep", "pos").mapInArrow(_tries, NODE))
    nodes = lower.where("NOT is_top").drop("is_top").unionByName(
        _upper(one, cuts, lower.where("is_top")))
    return nodes.join(_ends(ends), ["p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, **options) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are."""
    return trie(prefixes(*as_they_are(ranked(conversations))), **options)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return trie(prefixes(*rebuilt(ranked(conversations.select("conv_id", "turn", "role", "text")))))


ORACLE = {"op12_prefix_trie": """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS r
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
           list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                    lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.*, (SELECT count(*) FROM t WHERE t.conv_id = c.base AND t.r <= c.h) AS given FROM c),
s AS (
  SELECT c.conv_id, t.r AS pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.r <= c.h
  UNION ALL
  SELECT b.conv_id, t.r - b.h + b.given, role, text FROM b JOIN t ON t.conv_id = b.conv_id AND t.r > b.h
  UNION ALL
  SELECT conv_id, 0, '', '' FROM c),
m AS (
  SELECT conv_id, pos, length(text) AS n, md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (
           PARTITION BY conv_id ORDER BY pos)) AS key, max(pos) OVER (PARTITION BY conv_id) AS last FROM s),
p AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY pos) AS up FROM m),
v AS (
  SELECT pos, key, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (pos = last), '')) AS ends
  FROM p GROUP BY pos, key),
k AS (SELECT v.*, (SELECT count(*) FROM v x WHERE x.pos = v.pos + 1 AND x.up = v.key) AS n_children FROM v),
z AS (
  SELECT p.pos, p.key, sum((k.n_convs - 1) * k.n) AS saved, count(*) FILTER (k.n_children = 0) AS n_leaves
  FROM k JOIN p ON p.conv_id = k.conv_id AND p.pos <= k.pos GROUP BY p.pos, p.key)
SELECT k.conv_id, k.pos::BIGINT AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, z.n_leaves,
       z.saved::BIGINT AS saved_tokens, k.ends AS ends_sha256
FROM k JOIN z ON z.pos = k.pos AND z.key = k.key LEFT JOIN v u ON u.pos = k.pos - 1 AND u.key = k.up"""}
