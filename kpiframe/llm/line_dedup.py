"""Line dedup with levelled sorted runs.

A store of line hashes is a list of runs, each a table bucketed and sorted by
hash, in which no hash occurs twice over all runs. A batch of documents is
reduced to its distinct hashes with the smallest doc_id holding each, which are
merge-anti-joined with every run in turn: the batch is dealt and sorted by hash
once, the runs are read where their buckets lie and in the order they were
written in (``as_written``). What remains is new and is written once, from
where the merge leaves it, as a run of level 0; when a level has ``fanout`` runs
they are merged bucket by bucket into one of the next level. The last batch
becomes no run, as no batch reads it. A line whose hash is in an older run, or
whose holder in its own batch is another document, goes.

Each table has a file per bucket, so few are written: a batch's new hashes, the
merges, and the lines to drop of all batches together (``as_files``: runs are
dealt anew there, for a line that many documents share is split among tasks
only if both sides are). There are as many buckets as the lines fill
(``dealt_to``), at most the session's shuffle partitions.

``dedup`` feeds documents in ascending doc_id, in batches cut at quantiles of
doc_id, so the first holder is the smallest doc_id.

Keys: the line with SPACES stripped at both ends and A-Z lower-cased; keys
under 10 code points are never dropped. Hashes are 128 bits wide.

Defined cases: null or empty text is one empty line, kept as an empty text; a
null doc_id counts as one document larger than all others; rows with the same
doc_id are one document; a text that loses all lines becomes empty; an empty
table gives an empty result. Other columns are carried along untouched.
"""

from __future__ import annotations

import string
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, documents, fresh, materialise, row_key

LEAST_CHARS = 10
BATCHES = 4
FANOUT = 2
BUCKET_LINES = 2**18
LAST_ID = 2**63 - 1


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def lowered(bare: Column) -> Column:
    """A-Z lower-cased, code point for code point. ``translate`` makes a string of
    each character, so it gets only lines in which ``lower`` might change others."""
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


#: Spark takes a bucket's order from its one file, and keeps buckets whole where
#: a plan has neither join nor aggregate, only if the first two say so. The last
#: keeps shuffles at one partition per bucket.
AS_WRITTEN = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
              "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
              "spark.sql.adaptive.coalescePartitions.enabled": "false"}
AS_FILES = {"spark.sql.sources.bucketing.enabled": "false"}


@contextmanager
def _planned_with(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def as_written(spark: SparkSession):
    """What is planned inside reads bucketed tables by bucket and in order."""
    return _planned_with(spark, AS_WRITTEN)


def as_files(spark: SparkSession):
    """What is planned inside reads bucketed tables as if they had no buckets."""
    return _planned_with(spark, AS_FILES)


def dealt_to(spark: SparkSession, n: int):
    """Inside, ``n`` lines are dealt to a partition, and so to a file of each table,
    per BUCKET_LINES, but to no more than the session's and no fewer than its cores."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(-(-n // BUCKET_LINES), spark.sparkContext.defaultParallelism)
    return _planned_with(spark, {"spark.sql.shuffle.partitions": str(min(most, wanted))})


class LineRuns:
    """The store. ``add`` takes the (hash, first) rows of a batch and returns,
    of each hash that no run has, the smallest; after the last batch none is
    added. What it returns can be read until ``close``."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.tables: list[str] = []

    def _write(self, df: DataFrame) -> str:
        """One file per bucket, as ``df`` is dealt by hash."""
        name = f"llm_lines_{uuid.uuid4().hex}"
        self.tables.append(name)
        df.write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash").saveAsTable(name)
        return name

    def merged(self, one: str, other: str) -> DataFrame:
        """All rows of two runs, which share no hash: a merge of bucket k of
        both in task k, without a shuffle or a sort of either."""
        a, b = self.spark.table(one), self.spark.table(other).withColumnRenamed("first", "second")
        return a.join(b.hint("merge"), "hash", "full_outer").select("hash", F.coalesce("first", "second").alias("first"))

    def _put(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            merged = runs[0]
            for run in runs[1:]:
                with as_written(self.spark):
                    merged = self._write(self.merged(merged, run))
            self._put(merged, level + 1)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of a batch that no run has."""
        for run in (r for level in reversed(self.levels) for r in level):
            batch = batch.join(self.spark.table(run).select("hash").hint("merge"), "hash", "left_anti")
        return batch

    def add(self, batch: DataFrame, last: bool = False) -> DataFrame:
        new = self.unseen(batch.groupBy("hash").agg(F.min("first").alias("first")))
        with as_written(self.spark):
            if last:
                return materialise(new)
            run = self._write(new)
        self._put(run, 0)
        return self.spark.table(run)

    def close(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def hashed_lines(docs: DataFrame, holder: Column) -> DataFrame:
    """(row, place, holder, hash) of each line whose key is long enough. What is of
    the whole text is worked out in a select of its own, once per document: beside
    the explode Spark would carry the text along with each of its lines and hash it
    for each of them. A key has as many code points as the stripped line."""
    whole = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), holder.alias("holder"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return (whole.select("row", "holder", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
            .select("row", "holder", "place", stripped(F.col("line")).alias("bare"))
            .where(F.length("bare") >= LEAST_CHARS)
            .select("row", "place", "holder", F.unhex(F.md5(lowered(F.col("bare")))).alias("hash")))


def dropped_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(row, dropped): for each row that loses lines, their 0-based places."""
    spark = docs.sparkSession
    cuts = docs.select(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000)).first()[0] or []
    holder = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    batch = sum(((F.col("holder") > cut).cast("int") for cut in cuts), F.lit(0))
    lines = materialise(hashed_lines(docs, holder).withColumn("batch", batch), "batch")
    with dealt_to(spark, lines.count()):
        return _dropped(lines, len(cuts) + 1, fanout)


def _dropped(lines: DataFrame, batches: int, fanout: int) -> DataFrame:
    spark = lines.sparkSession
    runs, gone = LineRuns(spark, fanout), []
    try:
        for b in range(batches):
            own = lines.where(F.col("batch") == b)
            new = runs.add(own.select("hash", F.col("holder").alias("first")), last=b == batches - 1)
            gone.append(own.join(new, "hash", "left")
                        .where(F.col("first").isNull() | (F.col("first") != F.col("holder")))
                        .select("row", "place"))
        both = gone[0]
        for more in gone[1:]:
            both = both.unionByName(more)
        with as_files(spark):
            return materialise(both.groupBy("row").agg(F.collect_set("place").alias("dropped")))
    finally:
        runs.close()


def dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns plus a struct of n_lines, n_dropped and kept
    (the joined lines that stay); the struct's name is the last column."""
    row, lines, out = fresh("_row", docs), fresh("_lines", docs), fresh("_dedup", docs)
    gone = dropped_lines(docs, **options).select(F.col("row").alias(row), F.col("dropped").alias(out))
    columns = [c for c in docs.columns if c != "text"]
    split = docs.select(*columns, row_key(F.col("doc_id"), F.col("text")).alias(row),
                        F.split(F.coalesce("text", F.lit("")), "\n", -1).alias(lines))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(out))
    kept = F.when(F.col(out).isNull(), F.concat_ws("\n", F.col(lines))).otherwise(
        F.concat_ws("\n", F.transform(stay, lambda i: F.element_at(F.col(lines), i + 1))))
    return split.join(gone, row, "left").select(*columns, F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(out), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept")).alias(out))


def dedup_texts(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the deduplicated texts in place, columns as they were."""
    done = dedup(docs, **options)
    kept = F.col(f"{done.columns[-1]}.kept")
    new = {"text": kept, "n_chars": F.length(kept).cast("long")}
    return done.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup(documents(spark, sf_dir).select("doc_id", "text"))
    out = done.columns[-1]
    return done.select(
        "doc_id", F.col(f"{out}.n_lines"), F.col(f"{out}.n_dropped"),
        F.sha2(F.col(f"{out}.kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = {"op4_line_dedup": """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS place FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (
  SELECT k.doc_id, k.line, k.place, coalesce(f.first <> k.doc_id, false) AS gone
  FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""}
