"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word shingles (lower-cased words of ``[^\\x20\\x09-\\x0D]+``,
five in a row; a shorter text is one shingle). The join links documents whose
sets have a Jaccard similarity of at least ``threshold``:

1. Every text is hashed once to its set's digest and ``BANDS`` MinHash bands.
   Documents with equal sets collapse to one node before anything is paired.
2. The smallest node of a band is its hub. Nodes that share bands are gathered
   around the smallest hub of theirs, and what is around one hub is cut into
   chunks of bounded documents and shingles, so a chunk holds neighbours.
3. Two chunks make a block if some band reaches into both; a set is sent to the
   blocks of its chunk and to no others, and every pair that shares a band is in
   exactly one block. In a block the MinHash values of a node and all
   others are compared ``STEP`` at a time; a pair is dropped as soon as the
   posterior probability (uniform prior) that it reaches the threshold falls
   below ``TOLERANCE``. The rest is verified on the whole shingle sets.
4. A block gives, per node, the number of its links, and a spanning forest of
   them instead of the pairs; components of the forests are the classes.

With 40 bands of 5 values a pair at the threshold shares no band with
probability 1.3e-7, and is pruned with about ``TOLERANCE`` a comparison.

Result: one row per document with ``class_id`` (the smallest doc_id of its
class) and ``n_links`` (other documents at or above the threshold, copies
included). Defined cases: texts without words (null, empty, spaces) have no
set, link to nothing and are classes of their own; rows that agree in doc_id
and text are copies of each other; null doc_ids are never a class_id unless a
class has no other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, fresh, materialise, row_key
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
STEP = 40
TOLERANCE = 1e-6
CHUNK_DOCS = 512
CHUNK_SHINGLES = 2_000_000
HASHES = BANDS * ROWS


def constants() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of the MinHash functions."""
    draw = np.random.default_rng(20_240)
    return (draw.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            draw.integers(0, 2**63, HASHES, dtype=np.uint64))


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(h))
    mixed = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        mixed = (mixed ^ h[k:k + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minhashes(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 32-bit minimum per hash function, over the whole set."""
    least = np.full(len(a), np.uint64(2**64 - 1))
    for at in range(0, len(found), 4096):
        part = found[at:at + 4096]
        least = np.minimum(least, (a[:, None] * part + b[:, None]).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def fewest_matches(threshold: float, tolerance: float, step: int = STEP) -> list[tuple[int, int]]:
    """(n, m): after n values a pair with fewer than m matches is dropped. With
    a uniform prior, P(J >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(step, HASHES + 1, step):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def _sets(docs: DataFrame, with_bands: bool) -> DataFrame:
    """(key, doc_id, digest, n_shingles, bands | shingles) of each row with words."""
    a, b = constants()
    extra = (T.StructField("bands", T.ArrayType(T.LongType())) if with_bands else T.StructField("shingles", T.BinaryType()))
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("doc_id", T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("n_shingles", T.LongType()), extra])
    pick = np.arange(HASHES, dtype=np.uint64).reshape(BANDS, ROWS) // np.uint64(ROWS)

    def bands(found: np.ndarray) -> list[int]:
        h = minhashes(found, a, b).reshape(BANDS, ROWS).astype(np.uint64)
        mixed = pick[:, 0].copy()
        for k in range(ROWS):
            mixed = (mixed ^ h[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(31)
        return mixed.view(np.int64).tolist()

    def run(batches):
        for batch in batches:
            keys, ids, texts = batch.columns
            for at in range(0, batch.num_rows, 512):
                rows = []
                for key, doc, text in zip(keys[at:at + 512], ids[at:at + 512], texts[at:at + 512]):
                    found = shingles(text.as_py())
                    if len(found):
                        data = found.tobytes()
                        rows.append((key.as_py(), doc.as_py(), hashlib.sha256(data).digest()[:16], len(found),
                                     bands(found) if with_bands else data))
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow)], names=schema.names)

    arrow = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("digest", pa.binary()),
                       ("n_shingles", pa.int64()),
                       ("bands", pa.list_(pa.int64())) if with_bands else ("shingles", pa.binary())])
    return docs.mapInArrow(run, schema)


def _compare(batches, threshold: float, checks: list[tuple[int, int]]):
    """Blocks of nodes (sorted by block) to (digest, other, links): the links
    of ``digest`` in the block, weighted by copies, or (other set) a link of
    the block's spanning forest."""
    a, b = constants()

    def pairs(rows: list[dict]):
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        sizes = np.array([len(s) for s in sets])
        mins = np.array([minhashes(s, a, b) for s in sets])
        copies, side = np.array([r["copies"] for r in rows]), np.array([r["side"] for r in rows])
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        marked = np.zeros(int(codes.max()) + 1, bool)
        links, root = np.zeros(len(rows), np.int64), list(range(len(rows)))
        cross = rows[0]["two"]

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for i in range(len(rows) - 1):
            if cross and side[i]:
                break  # sorted by side: only pairs across the two chunks
            left = np.arange(np.searchsorted(side, 1), len(rows)) if cross else np.arange(i + 1, len(rows))
            low, high = np.minimum(sizes[left], sizes[i]), np.maximum(sizes[left], sizes[i])
            left = left[low >= threshold * high]
            seen = 0
            agree = np.zeros(len(left), np.int64)
            for n, least in checks:
                if not len(left):
                    break
                agree += (mins[left, seen:n] == mins[i, seen:n]).sum(axis=1)
                left, agree, seen = left[agree >= least], agree[agree >= least], n
            if not len(left):
                continue
            own = codes[starts[i]:ends[i]]
            marked[own] = True
            flat = np.concatenate([codes[starts[j]:ends[j]] for j in left])
            both = np.add.reduceat(marked[flat].astype(np.int64), np.r_[0, np.cumsum(sizes[left])[:-1]])
            marked[own] = False
            near = left[both >= threshold * (sizes[left] + sizes[i] - both) - 1e-9]
            links[i] += copies[near].sum()
            links[near] += copies[i]
            for j in near.tolist():
                p, q = top(i), top(j)
                if p != q:
                    root[q] = p
                    yield rows[i]["digest"], rows[j]["digest"], 0
        for k in np.flatnonzero(links).tolist():
            yield rows[k]["digest"], None, int(links[k])

    def out(found: list[tuple]):
        columns = list(zip(*found)) if found else [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64()))],
            names=["digest", "other", "links"])

    block, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["a"], row["b"]) != block:
                if len(rows) > 1:
                    yield out(list(pairs(rows)))
                block, rows = (row["a"], row["b"]), []
            rows.append(row)
    if len(rows) > 1:
        yield out(list(pairs(rows)))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, doc_id, root, class_id, n_links) of each row with words; root names
    the class."""
    checks = fewest_matches(threshold, TOLERANCE)
    texts = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("doc_id").cast("long"), "text")
    rows = materialise(_sets(texts, True))
    nodes = rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"), F.min("key").alias("first_key"),
        F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    nodes = materialise(nodes.withColumn("node", F.xxhash64("digest")))

    banded = nodes.select("node", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last")
    shared = materialise(banded.join(hubs.drop("last"), "band"))
    around = shared.groupBy("node").agg(F.min("hub").alias("around"))
    near = nodes.drop("bands").join(around, "node")
    cuts = near.groupBy("around").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / CHUNK_DOCS), F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES)).cast("int").alias("cuts"))
    members = materialise(near.join(cuts, "around").withColumn(
        "chunk", F.xxhash64("around", F.pmod(F.hash("digest"), "cuts"))).drop("around", "cuts", "n_shingles"))
    reach = materialise(shared.join(members.select("node", "chunk"), "node").select("band", "chunk").distinct())
    met = materialise(
        reach.withColumnRenamed("chunk", "a").join(reach.withColumnRenamed("chunk", "b"), "band").where("a <= b")
        .select("a", "b").distinct())
    own = ["first_key", "digest", "copies", "a", "b"]
    dealt = (
        members.withColumnRenamed("chunk", "a").join(met, "a").select(*own, F.lit(0).alias("side"), (F.col("a") != F.col("b")).alias("two"))
        .unionByName(members.withColumnRenamed("chunk", "b").join(met.where("a <> b"), "b")
                     .select(*own, F.lit(1).alias("side"), F.lit(True).alias("two"))))
    # members grow with the corpus: always a merge join, whatever their size is now
    wanted = members.select(F.col("first_key").alias("key")).hint("merge")
    sets = _sets(texts.join(wanted, "key", "left_semi"), False)
    sets = sets.select("digest", "shingles").dropDuplicates(["digest"])
    blocks = (dealt.join(sets, "digest").select("a", "b", "side", "two", "digest", "copies", "shingles")
              .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
              .sortWithinPartitions("a", "b", "side", "digest"))
    found = materialise(blocks.mapInArrow(lambda it: _compare(it, threshold, checks),
                                          "digest binary, other binary, links bigint"))

    roots = components(found.where("other is not null").select(F.col("digest").alias("u"), F.col("other").alias("v")))
    totals = found.where("other is null").groupBy("digest").agg(F.sum("links").alias("links"))
    named = (nodes.select("digest", "copies", "first_id")
             .join(roots.withColumnRenamed("node", "digest"), "digest", "left")
             .join(totals, "digest", "left").withColumn("root", F.coalesce("root", "digest")))
    ids = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    by_digest = named.join(ids, "root").select(
        "digest", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.select("key", "doc_id", "digest").join(by_digest, "digest").drop("digest")


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, n_links."""
    found = classes(docs, threshold).select("key", "class_id", "n_links").dropDuplicates(["key"])
    return (docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key")).join(found, "key", "left")
            .select("doc_id", F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The document with the smallest doc_id of each class, columns as they
    were; of several rows of that id, the one with the smallest row key."""
    key, lead, place = fresh("_key", docs), fresh("_lead", docs), fresh("_place", docs)
    found = materialise(classes(docs, threshold).where("n_links > 0").select("key", "doc_id", "root"))
    leads = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("lead"))
    linked = (found.select("key", "root").dropDuplicates(["key"]).join(leads, "root")
              .select(F.col("key").alias(key), (F.col("key") == F.col("lead.key")).alias(lead)))
    rows = docs.withColumn(key, row_key(F.col("doc_id"), F.col("text"))).join(linked, key, "left")
    once = F.row_number().over(Window.partitionBy(key).orderBy(lead))
    return (rows.where(F.coalesce(lead, F.lit(True)))
            .withColumn(place, F.when(F.col(lead), once).otherwise(1)).where(F.col(place) == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir))


ORACLE = {"op8_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE k >= 0.8 * (p.n + q.n - k)),
reach AS (
  SELECT x AS doc_id, x AS seen FROM (SELECT DISTINCT x FROM links)
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.seen)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(m.n_links, 0)::BIGINT AS n_links
FROM documents d
LEFT JOIN (SELECT doc_id, min(seen) AS class_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
LEFT JOIN (SELECT x, count(*) AS n_links FROM links GROUP BY x) m ON m.x = d.doc_id"""}
