"""Hard-negative mining by products in a residue number system.

Vectors are made whole numbers, ``floor(256 * x)``. A score is the inner product
of an anchor and a row. It is exact: the residues of both modulo a few primes
below 1024, centred on zero, are multiplied as float32 matrices (at most 64
products of at most 510 * 510 are added, under 2**24, so no sum is rounded), and
the signed score is put together from them by Chinese remaindering. As many
primes are taken as the largest squared length in the table needs.

Anchors are dealt into blocks that fit a task, rows into slabs that stream
through one; every pair of a block and a slab is a cell. A first pass over the
cells finds each anchor's positives, its first ``POSITIVES`` other rows of the
same label. A second pass selects, for each positive, the first ``NEGATIVES``
rows of another label whose score lies in the window of ``LOW`` to ``HIGH``
hundredths of the positive's score. A cell keeps the first few rows per anchor
or window and no more; a window over all cells ranks what they kept. All pairs
are scored, none is emitted beyond that.

A row is copied once per block of anchors and an anchor once per slab, so what
is shuffled does not depend on how labels or vectors repeat. Blocks and slabs
are dealt by a row number given when the table is written once, hence evenly.

Order: higher score first, then smaller vec_id (null ids last), then row number.
Defined cases: rows with a null label, a null vector or any null or non-finite
component take no part; rows with equal ids are rows of their own, each an
anchor if its id is one (a row is only ever left out as its own positive); a
null id is no anchor; vectors of unequal length count as followed by zeros, so
an empty one scores 0; positives with a negative score have an empty window;
tables without anchors give an empty result; scores beyond ``MOST`` would not
fit the window test in a long, such a table is refused with a ValueError.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
ANCHOR_EVERY = 100
MOST = 2**56
#: Values of an anchor block, of a matrix of scores, and products added in float32.
BLOCK_VALUES, SCORES, ADDED = 1 << 20, 1 << 20, 64
#: Rows that one task streams past its block, about: at most, and at least unless there are fewer.
SLAB_ROWS, LEAST_ROWS = 1 << 22, 1024
LEAST = -(2**63)


def primes(bound: int) -> list[int]:
    """Primes below 1024, largest first, that tell all of -bound..bound apart."""
    found, product = [], 1
    for p in range(1023, 2, -2):
        if product > 2 * bound:
            break
        if all(p % d for d in range(3, math.isqrt(p) + 1, 2)):
            found.append(p)
            product *= p
    return found


def residues(whole: np.ndarray, moduli: list[int]) -> list[np.ndarray]:
    """Centred residues of whole float64 numbers, as float32 by modulus."""
    out = []
    for p in moduli:
        r = np.fmod(whole, p)  # exact at any size
        r[r > p // 2] -= p
        r[r < -(p // 2)] += p
        out.append(r.astype(np.float32))
    return out


def products(a: list[np.ndarray], b: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Exact int64 scores of the rows of ``a`` with those of ``b``."""
    score, product = None, 1
    for p, x, y in zip(moduli, a, b):
        r = np.zeros((len(x), len(y)), np.float32)
        for k in range(0, x.shape[1], ADDED):
            part = x[:, k:k + ADDED] @ y[:, k:k + ADDED].T
            r += part - np.float32(p) * np.rint(part / np.float32(p))
        r = r.astype(np.int64)
        if score is not None:
            r = (r - score) % p * pow(product, -1, p)
        digit = (r + p // 2) % p - p // 2
        score = digit if score is None else score + product * digit
        product *= p
    return score


def whole_numbers(vectors: pa.Array, dims: int) -> np.ndarray:
    """float64 matrix of floor(256 * x), shorter rows followed by zeros."""
    lengths = np.asarray(vectors.value_lengths(), np.int64)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = np.floor(SCALE * vectors.flatten().to_numpy().astype(np.float64))
    return out


def first_of(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's first ``k`` scores, higher ones and then
    lower columns first; ``LEAST`` is no score."""
    if scores.shape[1] > k:
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, [-k]]
        above, level = scores > edge, scores == edge
        room = k - above.sum(axis=1, keepdims=True)
        taken = above | (level & (np.cumsum(level, axis=1) <= room))
        taken &= scores > LEAST
    else:
        taken = scores > LEAST
    return np.nonzero(taken)


class Kept:
    """The first ``k`` rows per target over all batches of a slab."""

    def __init__(self, k: int):
        self.k = k
        self.parts = [np.zeros((0, 5), np.int64)]

    def add(self, target, score, ids) -> None:
        """``ids`` has a null flag, vec_id and row number by row."""
        self.parts.append(np.column_stack([target, score, ids]))
        if sum(map(len, self.parts[1:])) > len(self.parts[0]) + SCORES // 8:
            self.shrink()

    def shrink(self) -> np.ndarray:
        every = np.concatenate(self.parts)
        # ~score reverses the order of int64 without overflow
        every = every[np.lexsort((every[:, 4], every[:, 3], every[:, 2], ~every[:, 1], every[:, 0]))]
        first = np.r_[True, every[1:, 0] != every[:-1, 0]] if len(every) else np.zeros(0, bool)
        start = np.maximum.accumulate(np.where(first, np.arange(len(every)), 0))
        self.parts = [every[np.arange(len(every)) - start < self.k]]
        return self.parts[0]


class Cell:
    """One block of anchors, to which the rows of a slab come in batches."""

    def __init__(self, anchors: list[dict], k: int, dims: int, moduli: list[int]):
        self.dims, self.moduli, self.kept = dims, moduli, Kept(k)
        self.rows = np.array([a["row"] for a in anchors], np.int64)
        self.labels = np.array([a["label"] for a in anchors], np.int64)
        # targets: the anchors themselves, or their windows (anchor, place, low, high)
        self.windows = None
        if anchors and anchors[0]["windows"] is not None:
            self.windows = np.array([(i, w["place"], w["low"], w["high"]) for i, a in enumerate(anchors)
                                     for w in a["windows"]], np.int64).reshape(-1, 4)
        vectors = pa.array([a["embedding"] for a in anchors], pa.list_(pa.float64()))
        self.parts = residues(whole_numbers(vectors, dims), moduli)

    def add(self, batch: pa.RecordBatch) -> None:
        null = np.asarray(batch["vec_id"].is_null()).astype(np.int64)
        ids = np.column_stack([null, batch["vec_id"].fill_null(0).to_numpy(), batch["row"].to_numpy()])
        order = np.lexsort(ids.T[::-1])
        ids, labels = ids[order], batch["label"].to_numpy()[order]
        rows = residues(whole_numbers(batch["embedding"], self.dims)[order], self.moduli)
        step = max(1, SCORES // max(1, len(ids)))
        targets = len(self.rows) if self.windows is None else len(self.windows)
        for at in range(0, targets, step):
            some = slice(at, at + step)
            if self.windows is None:
                scores = products([p[some] for p in self.parts], rows, self.moduli)
                fits = (self.labels[some, None] == labels) & (self.rows[some, None] != ids[:, 2])
            else:
                anchor, _, low, high = self.windows[some].T
                own, back = np.unique(anchor, return_inverse=True)
                scores = products([p[own] for p in self.parts], rows, self.moduli)[back]
                fits = (self.labels[anchor][:, None] != labels) & (scores >= low[:, None]) & (scores <= high[:, None])
            target, column = first_of(np.where(fits, scores, LEAST), self.kept.k)
            self.kept.add(target + at, scores[target, column], ids[column])

    def result(self):
        kept = self.kept.shrink()
        anchor, place = kept[:, 0], np.zeros(len(kept), np.int64)
        if self.windows is not None:
            anchor, place = self.windows[kept[:, 0], 0], self.windows[kept[:, 0], 1]
        yield pa.RecordBatch.from_arrays([
            pa.array(self.rows[anchor]), pa.array(place), pa.array(kept[:, 1]),
            pa.array(kept[:, 3], mask=kept[:, 2] == 1), pa.array(kept[:, 4])], ["anchor", "place", "score", "id", "row"])


def _scored(batches, k: int, dims: int, moduli: list[int]):
    """Batches sorted by cell, a cell's anchors before its rows."""
    cell, anchors, at = None, [], None
    for batch in batches:
        cells, kinds = batch["cell"].to_numpy(), batch["is_row"].to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, len(cells)]):
            if cells[start] != at:
                if cell:
                    yield from cell.result()
                cell, anchors, at = None, [], cells[start]
            part = batch.slice(start, end - start)
            if not kinds[start]:
                anchors += part.to_pylist()
            elif anchors:
                cell = cell or Cell(anchors, k, dims, moduli)
                cell.add(part)
    if cell:
        yield from cell.result()


class Miner:
    """Scores of the anchors among ``vectors`` (vec_id, embedding, label) with
    all of them."""

    def __init__(self, vectors: DataFrame, anchor_every: int = ANCHOR_EVERY):
        fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        self.vectors = materialise(
            vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
            .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"),
                    F.col("label").cast("long"), "embedding"))
        self.is_anchor = F.col("vec_id") % anchor_every == 0
        squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.abs(x.cast("double")) * SCALE + 1, 2))
        rows, anchors, dims, square = self.vectors.agg(
            F.count(F.lit(1)), F.count_if(self.is_anchor), F.max(F.size("embedding")), F.max(squares)).first()
        self.dims, bound = max(1, dims or 0), (square or 0) * (1 + 1e-6) + 1
        if not bound <= MOST:
            raise ValueError(f"scores up to {bound:.3g} do not fit: they may be at most {MOST}")
        self.moduli = primes(int(bound))
        spark = vectors.sparkSession
        self.blocks = max(1, -(-anchors * self.dims // BLOCK_VALUES))
        wanted = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // self.blocks)
        self.slabs = max(1, -(-rows // SLAB_ROWS), min(wanted, -(-rows // LEAST_ROWS)))

    def first(self, anchors: DataFrame, k: int) -> DataFrame:
        """(anchor, place, score, id, row): what the cells keep of the scores of
        ``anchors``, rows of the table with their ``windows`` or null."""
        blocks, slabs, dims, moduli = self.blocks, self.slabs, self.dims, self.moduli
        deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        rows = self.vectors.select("*", F.lit(True).alias("is_row"), F.lit(None).cast(
            anchors.schema["windows"].dataType).alias("windows"), each(blocks).alias("block"), deal(slabs).alias("slab"))
        mine = anchors.select(*self.vectors.columns, F.lit(False).alias("is_row"), "windows",
                              deal(blocks).alias("block"), each(slabs).alias("slab"))
        cells = (rows.unionByName(mine).withColumn("cell", F.col("block") * slabs + F.col("slab"))
                 .drop("block", "slab").repartition(blocks * slabs, "cell").sortWithinPartitions("cell", "is_row"))
        return cells.mapInArrow(lambda it: _scored(it, k, dims, moduli),
                                "anchor long, place long, score long, id long, row long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for ``vectors`` with columns vec_id, embedding, label."""
    miner = Miner(vectors, anchor_every)
    anchors = miner.vectors.where(miner.is_anchor)
    window = "array<struct<place:long,low:long,high:long>>"
    found = miner.first(anchors.withColumn("windows", F.lit(None).cast(window)), positives)
    best = materialise(
        _ranked(found, positives).where("score >= 0").withColumnRenamed("anchor", "row_")
        .join(anchors.select(F.col("row").alias("row_"), F.col("vec_id").alias("anchor_id")), "row_")
        .select(F.col("row_").alias("anchor"), F.col("rank").cast("long").alias("place"), "anchor_id",
                F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # 100 * s >= low * p and 100 * s <= high * p, for whole s
    windows = best.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct(
        "place", F.expr(f"({low} * positive_score + 99) div 100").alias("low"),
        F.expr(f"({high} * positive_score) div 100").alias("high"))).cast(window).alias("windows"))
    picked = _ranked(miner.first(anchors.join(windows, "row"), negatives), negatives)
    return picked.join(best, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.col("label").cast("long")
    return mine(vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)))


ORACLE = {"op11_hard_negatives": """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id, s.other AS negative_id, p.positive_score, s.score AS negative_score,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other))::INTEGER AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10"""}
