"""Mixing sources to target weights.

Each document gets a hash-random key. Within its source, documents are ranged
by that key and a distributed prefix sum of their sizes gives every document
its place ``[start, start + size)`` in the source's random order. A source's
budget is cut out of that order exactly: whole epochs, then the documents whose
place lies before the rest of the budget, the last of them cut at the word
where the budget ends.

The prefix sum is hierarchical: the key's leading bits name a leaf (about
``LEAF_ROWS`` documents of an average source) and a middle node (``FAN``
leaves). Sums climb leaf -> middle -> source and offsets descend the same way,
so a source with a third of all rows is spread over its leaves; only the table
with one row per source passes through one task.

Defined cases: null text has size 0; a null source is a source of its own, the
last in order; a null doc_id hashes as an empty string; rows that share an id
have keys of their own by their texts, so an id that a third of all rows have is
spread like others; rows that agree in id and text share a key and are
interchangeable; documents without words are never taken; an
empty table gives an empty result; other columns of the input are carried only
where asked for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, WORD, documents, fresh, materialise

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = 17
LEAF_ROWS = 256
FAN = 256
KEY_BITS = 60


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                            F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(src, source_size) -> + target, budget.

    Weights repeat over the sources in code point order. With caps
    ``most * source_size``, the shares are ``min(cap, weight * level)`` where
    the level spends all words; the level is the largest of
    ``(total - caps of the k first filled) / weights of the others`` over k,
    sources ordered by ``cap / weight``.
    """
    by_name, by_ratio, all_rows = Window.orderBy("src"), Window.orderBy("ratio", "src"), Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    cap = F.lit(float(most)) * F.col("source_size")
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    others = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    share = F.least(F.col("cap"), F.col("weight") * F.max("level").over(all_rows))
    return (sources
            .withColumn("weight", weight.cast("double")).withColumn("cap", cap)
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("total", F.sum("source_size").over(all_rows))
            .withColumn("level", (F.col("total") - before) / others)
            .select("src", "source_size", F.round(share, 6).alias("target"))
            .withColumn("budget", F.round("target").cast("long")))


def plan(docs: DataFrame, carry: tuple[str, ...] = (), seed: int = SEED, weights: tuple[int, ...] = WEIGHTS,
         most: int = MOST_EPOCHS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, whole (copies
    taken entirely), part (words of one more, cut copy), taken; with ``carry``,
    also the struct ``row`` of those columns of ``docs``."""
    src = F.when(F.col("source").isNull(), "t").otherwise(F.concat(F.lit("s"), F.col("source")))
    rows = docs.select("doc_id", src.alias("src"), n_words(F.col("text")).alias("size"),
                       random_key(F.col("doc_id"), F.col("text"), seed).alias("key"),
                       *([F.struct(*[docs[c] for c in carry]).alias("row")] if carry else []))
    narrow = materialise(rows.drop("row"))
    bits = max(0, math.ceil(math.log2(max(1, narrow.count()) / LEAF_ROWS)))
    mid_bits = max(0, bits - int(math.log2(FAN)))

    def placed(df: DataFrame) -> DataFrame:
        return (df.withColumn("leaf", F.shiftright("key", KEY_BITS - bits))
                .withColumn("mid", F.shiftright("key", KEY_BITS - mid_bits)))

    leaves = placed(narrow).groupBy("src", "mid", "leaf").agg(F.sum("size").alias("words"))
    mids = leaves.groupBy("src", "mid").agg(F.sum("words").alias("words"))
    goal = targets(mids.groupBy("src").agg(F.sum("words").alias("source_size")), weights, most)

    def before(by: list[str], order: list[str], of: str) -> Column:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(of).over(w), F.lit(0)).cast("long")

    mids = (mids.withColumn("mid_start", before(["src"], ["mid"], "words"))
            .join(goal, "src").select("src", "mid", "mid_start", "source_size", "target", "budget"))
    leaves = (leaves.withColumn("in_mid", before(["src", "mid"], ["leaf"], "words"))
              .join(mids, ["src", "mid"])
              .select("src", "leaf", (F.col("mid_start") + F.col("in_mid")).alias("leaf_start"),
                      "source_size", "target", "budget"))
    start = F.col("leaf_start") + F.col("in_leaf")
    full = F.coalesce(F.expr("budget div nullif(source_size, 0)"), F.lit(0))
    rest = F.col("budget") - full * F.col("source_size")
    clip = F.least(F.greatest(rest - start, F.lit(0)), F.col("size"))
    whole = F.when(F.col("size") > 0, full + (clip == F.col("size")).cast("long")).otherwise(0)
    return (placed(rows if carry else narrow)
            .withColumn("in_leaf", before(["src", "leaf"], ["key", "doc_id", "size"], "size"))
            .join(leaves, ["src", "leaf"])
            .withColumn("whole", whole.cast("long"))
            .withColumn("part", F.when(clip < F.col("size"), clip).otherwise(0).cast("long"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("whole") * F.col("size") + F.col("part")).alias("taken"), "whole", "part",
                    *(["row"] if carry else [])))


def first_words(text: Column, k: Column) -> Column:
    """The text up to the end of its k-th word."""
    pieces = F.regexp_extract_all(text, F.lit(f"[{SPACES}]*{WORD}"), F.lit(0))
    return F.concat_ws("", F.slice(pieces, F.lit(1), k.cast("int")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each copy
    taken, and for each source at most one cut copy."""
    number = fresh("_copy", docs)
    planned = plan(docs, carry=tuple(docs.columns), **options)
    rows = planned.withColumn(number, F.explode(F.expr(
        "if(whole + if(part > 0, 1, 0) = 0, cast(array() as array<bigint>), sequence(1L, whole + if(part > 0, 1L, 0L)))")))
    cut = F.col(number) > F.col("whole")
    text = F.when(cut, first_words(F.col("row.text"), F.col("part"))).otherwise(F.col("row.text"))
    out = {"text": text, "n_chars": F.when(cut, F.length(text)).otherwise(F.col("row.n_chars"))}
    return rows.select(*[out.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = {"op1_mixing": f"""
WITH d AS (
  SELECT doc_id, coalesce(source, chr(1114111)) AS src, source IS NULL AS unnamed,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))),
                         1, {KEY_BITS // 4}))::BIGINT AS key
  FROM documents),
s AS (
  SELECT src, unnamed, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY unnamed, src) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM d GROUP BY src, unnamed),
filled AS (
  SELECT a.src, a.unnamed, a.source_size, a.weight, 3.0::DOUBLE * a.source_size AS cap,
         ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(3.0::DOUBLE * b.source_size) FILTER (
            3.0::DOUBLE * b.source_size / b.weight < 3.0::DOUBLE * a.source_size / a.weight), 0))
         / sum(b.weight) FILTER (3.0::DOUBLE * b.source_size / b.weight >= 3.0::DOUBLE * a.source_size / a.weight) AS level
  FROM s a, s b GROUP BY ALL),
t AS (
  SELECT src, unnamed, source_size,
         round(least(cap, weight * (SELECT max(level) FROM filled)), 6) AS target FROM filled),
p AS (
  SELECT d.*, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.src, d.unnamed ORDER BY key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.src = t.src AND d.unnamed = t.unnamed)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE
         (budget // source_size) * size + least(greatest(budget % source_size - start, 0), size) END)::BIGINT AS taken
FROM p"""}
