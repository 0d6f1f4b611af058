"""Quality rules with a bitmask ledger.

Every rule is evaluated once over the whole text. The ledger holds one row per
document: measurements and ``failed``, in which bit k says that rule k failed.
``stored_ledger`` writes it once, without the texts; all else reads that table.
A policy is a version, a mask of the rules it applies and how many of them a
document may fail; policies are applied to the ledger, and ablations (what a
policy would keep with one of its rules left out) are bitwise aggregates over
it, without reading any text again.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined cases: null text has no words; a
document without words fails ``few_words`` and no rule that divides by a count;
repeated rows are measured each for itself; an empty table gives an empty
ledger, and counts of 0 in ablations.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, fresh, materialise

#: Rules in the order of their bits: name and SQL condition of failing, with
#: measurements in braces.
RULES = (
    ("few_words", "{n_words} < 50"),
    ("repeated_windows", "100 * {n_repeat_words} > 50 * {n_words}"),
    ("symbols", "10 * {n_symbols} > 3 * {n_words}"),
    ("capitals", "2 * {n_upper} > {n_upper} + {n_lower}"),
    ("exclamations", "2 * {n_exclaim} > {n_words}"),
    ("short_words", "{word_chars} < 2 * {n_words}"),
    ("long_words", "{word_chars} > 30 * {n_words}"),
    ("dup_lines", "{n_lines} >= 10 and 2 * {n_dup_lines} > {n_lines}"),
    ("no_letters", "5 * ({n_upper} + {n_lower} + {n_wide}) < 2 * {word_chars}"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
            "n_lower", "n_wide", "n_exclaim")


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]
    may_fail: int = 0

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
CURRENT = Policy("v1", tuple(BIT))
#: One flaw is forgiven, but not a text that is too short or repeats itself.
LENIENT = Policy("v2", tuple(r for r in BIT if r not in BASE.rules), may_fail=1)


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, upto = 0, 0  # words before upto are counted
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(i, upto)
            upto = i + 3
    return total


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    space = int(seen[9:14].sum() + seen[32])
    points = len(data) - int(seen[128:192].sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (len(words), points - space, sum(int(seen[c]) for c in b"#*$%&|<>"), len(lines) - len(set(lines)),
            repeat_words(words), len(lines), int(seen[65:91].sum()), int(seen[97:123].sum()),
            int(seen[192:].sum()), int(seen[33]))


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns and, as last column, a struct of the
    measurements and ``failed``."""
    out = fresh("_ledger", docs)
    texts = docs.columns.index("text")
    kind = pa.struct([(m, pa.int64()) for m in MEASURES])

    def measured(batches):
        for batch in batches:
            rows = [measure(x.as_py()) for x in batch.column(texts)]
            found = pa.StructArray.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])

    measures = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    done = docs.mapInArrow(measured, T.StructType([*docs.schema.fields, T.StructField(out, measures)]))
    of = {m: f"`{out}`.{m}" for m in MEASURES}
    bits = " + ".join(f"if({sql.format(**of)}, {1 << k}L, 0L)" for k, (_, sql) in enumerate(RULES))
    return done.withColumn(out, F.struct(*[F.col(f"{out}.{m}") for m in MEASURES], F.expr(bits).alias("failed")))


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The ledger by doc_id, as a table of its own: doc_id, measurements, failed."""
    done = ledger(docs.select("doc_id", "text"))
    return materialise(done.select("doc_id", f"{done.columns[-1]}.*"))


def fails(failed: Column, policy: Policy) -> Column:
    return F.bit_count(failed.bitwiseAND(F.lit(policy.mask))) > policy.may_fail


def ablations(failed_by_doc: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """One row: documents, kept, and for each rule r of the policy ``r_failed``
    (fail it), ``r_only`` (fail nothing else of the policy, so that leaving it
    out would keep them), plus the masks of rules that failed anywhere."""
    own = F.col("failed").bitwiseAND(F.lit(policy.mask))
    count = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")
    return failed_by_doc.agg(
        F.count(F.lit(1)).alias("documents"), count(~fails(F.col("failed"), policy)).alias("kept"),
        F.coalesce(F.bit_or(own), F.lit(0)).alias("any_failed"),
        *[count(own.bitwiseAND(F.lit(BIT[r])) != 0).alias(f"{r}_failed") for r in policy.rules],
        *[count(own == BIT[r]).alias(f"{r}_only") for r in policy.rules])


def keep(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The documents that the policy keeps, columns as they were."""
    done = ledger(docs)
    return done.where(~fails(F.col(f"{done.columns[-1]}.failed"), policy)).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("failed")
    return stored_ledger(documents(spark, sf_dir)).select(
        "doc_id", *MEASURES[:5], fails(failed, BASE).alias("base_failed"), (~fails(failed, CURRENT)).alias("kept"),
        (~fails(failed, BASE) & ~fails(failed, LENIENT)).alias("kept_v2"), failed.alias("failed_rules"))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy costs, over all documents."""
    return ablations(stored_ledger(documents(spark, sf_dir)))


_LEDGER = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
one AS (SELECT doc_id, unnest(words) AS a, unnest(range(1, len(words) + 1)) AS i FROM w),
three AS (
  SELECT doc_id, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c
  FROM one WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM three WHERE c IS NOT NULL) WHERE n > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT line) AS u FROM (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.n - lines.u, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lines.n, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
         length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS n_wide,
         length(t) - length(replace(t, '!', '')) AS n_exclaim
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id LEFT JOIN lines ON lines.doc_id = w.doc_id),
f AS (
  SELECT *, (1 * (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
    + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (n_upper > n_lower)::INT + 16 * (2 * n_exclaim > n_words)::INT
    + 32 * (word_chars < 2 * n_words)::INT + 64 * (word_chars > 30 * n_words)::INT
    + 128 * (n_lines >= 10 AND 2 * n_dup_lines > n_lines)::INT
    + 256 * (5 * (n_upper + n_lower + n_wide) < 2 * word_chars)::INT)::BIGINT AS failed_rules FROM m)
"""
ORACLE = {
    "op6_quality_rules": _LEDGER + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, failed_rules = 0 AS kept,
       failed_rules & 3 = 0 AND bit_count(failed_rules) <= 1 AS kept_v2, failed_rules
FROM f""",
    "quality_ablations": _LEDGER + "SELECT count(*) AS documents, count(*) FILTER (failed_rules = 0) AS kept, "
    "bit_or(failed_rules) AS any_failed, " + ", ".join(
        f"count(*) FILTER (failed_rules & {1 << k} <> 0) AS {r}_failed, count(*) FILTER (failed_rules = {1 << k}) AS {r}_only"
        for k, r in enumerate(("few_words", "repeated_windows", "symbols", "capitals", "exclamations", "short_words",
                               "long_words", "dup_lines", "no_letters"))) + " FROM f",
}
