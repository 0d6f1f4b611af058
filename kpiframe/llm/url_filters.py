"""URL filters: prefix rules, and a Bloom filter cascade of listed domains.

Rules ``(verdict, host, path)`` fit their host and all its subdomains where the
url's path starts with the rule's; the longest rule (host and path together)
wins. Urls that no rule fits are judged by a list of domains: a url is blocked
if its host, or a domain above it, is listed.

The list is not joined to the pages. Its universe are all keys the corpus can
ask for: every host of the pages and every domain above one. Level 0 of the
cascade is a Bloom filter of the listed keys; level 1 holds the unlisted keys
of the universe that level 0 lets through, level 2 the listed keys that level 1
lets through, and so on until nothing wrong is left. The first level that
rejects a key decides: an even level says unlisted, an odd one listed, and the
parity of the last level decides for what passes all. Over the universe that is
exact, so every page is judged by bit tests inside its own scan.

The levels travel as literals while they are at most ``MOST_BITS`` together.
Beyond that the keys are dealt to shards by hash, each with a cascade of that
size, and the distinct hosts meet the rows of their shards.

Everything is DataFrame expressions. The driver sees the words of the filters
of an unsharded cascade, at most ``MOST_BITS`` bits, and counts.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased, ports and user names included. Path: then up to ``?``, ``#`` or
the end; it may be empty and then fits no rule. Defined cases: a url that is
null or has no ``://`` has an empty host and path, no rule, and is allowed;
hosts of more than 253 characters are no domain names and never listed, though
rules fit them; repeated rows and null ids are judged like others; an empty
table or list works; null and empty listed keys are ignored; other columns are
carried along.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, materialise

#: (verdict, host, path); fixed values.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A domain is listed if its first label is one of these words or has one between hyphens.
BLOCKED_WORDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam", "xxx")
BITS_PER_KEY = 10
HASHES = 7
MOST_BITS = 1 << 23
MOST_HOST = 253


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def keys_of(host: Column) -> Column:
    """The host and every domain above it, e.g. a.b.c, b.c and c."""
    labels = F.split(host, r"\.", -1)
    return F.when((host == "") | (F.length(host) > MOST_HOST), F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)),
                    lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def universe(pages: DataFrame) -> DataFrame:
    """(key): every key that a url of the pages asks for."""
    hosts = pages.select(host_and_path(F.col("url"))[0].alias("host")).distinct()
    return hosts.select(F.explode(keys_of(F.col("host"))).alias("key")).distinct()


def _places(key: Column, level: int, bits: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(level * HASHES + i), key), bits) for i in range(HASHES)]


def _passes(key: Column, level: int, bits: Column, words: Column) -> Column:
    test = F.lit(True)
    for place in _places(key, level, bits):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        test = test & (word.bitwiseAND(_bit(place)) != 0)
    return test


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def _bits_for(keys: Column) -> Column:
    return (F.ceil(keys * BITS_PER_KEY / 64) * 64).cast("long")


class Cascade:
    """Levels over ``keys`` (key, listed): the distinct keys of a universe."""

    def __init__(self, keys: DataFrame, most_bits: int = MOST_BITS):
        self.spark = keys.sparkSession
        keys = materialise(keys)
        listed, every = keys.agg(F.coalesce(F.count_if("listed"), F.lit(0)), F.count(F.lit(1))).first()
        # The levels shrink geometrically; half the room is left to those after the first.
        self.shards = max(1, -(-2 * max(listed, every // 100) * BITS_PER_KEY // most_bits))
        self.levels: list[DataFrame] = []
        keys = keys.select("key", "listed", self.shard("key").alias("shard"))
        side = {0: keys.where("listed"), 1: keys.where("NOT listed")}
        while not side[len(self.levels) % 2].isEmpty():
            level = len(self.levels)
            self.levels.append(self._level(side[level % 2], level))
            other = 1 - level % 2
            side[other] = materialise(
                side[other].join(F.broadcast(self.levels[level]) if self.shards == 1 else self.levels[level], "shard")
                .where(_passes(F.col("key"), level, F.col("bits"), F.col("words")))
                .select("key", "listed", "shard"))
        self.literals = [self._literal(level) for level in self.levels] if self.shards == 1 else None

    def shard(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(-1), F.col(key)), F.lit(self.shards)).cast("int")

    def _level(self, keys: DataFrame, level: int) -> DataFrame:
        """(shard, bits, words): one row per shard, its words as an array."""
        sizes = materialise(keys.groupBy("shard").agg(_bits_for(F.count(F.lit(1))).alias("bits")))
        words = (
            keys.join(sizes, "shard")
            .select("shard", "bits", F.explode(F.array(*_places(F.col("key"), level, F.col("bits")))).alias("place"))
            .groupBy("shard", "bits", F.shiftright("place", 6).cast("int").alias("w"))
            .agg(F.bit_or(_bit(F.col("place"))).alias("word"))
            .groupBy("shard", "bits").agg(F.map_from_entries(F.collect_list(F.struct("w", "word"))).alias("of")))
        return materialise(words.select("shard", "bits", F.transform(
            F.sequence(F.lit(0), (F.col("bits") / 64).cast("int") - 1),
            lambda w: F.coalesce(F.element_at("of", w), F.lit(0).cast("long"))).alias("words")))

    def _literal(self, level: DataFrame) -> tuple[Column, Column]:
        """Bits and words as constants; the words are folded from one string."""
        row = level.select("bits", F.array_join(F.col("words").cast("array<string>"), ",").alias("words")).first()
        return F.lit(row["bits"]).cast("long"), F.split(F.lit(row["words"]), ",").cast("array<bigint>")

    def lists(self, key: Column, of=None) -> Column:
        """Whether ``key``, of the universe, is listed; ``of`` gives a level's
        bits and words, by default the literals."""
        of = of or (lambda level: self.literals[level])
        found = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            found = F.when(_passes(key, level, *of(level)), found).otherwise(F.lit(level % 2 == 1))
        return found

    def listed_hosts(self, hosts: DataFrame) -> DataFrame:
        """(host): those of distinct ``hosts`` with a listed key, by shards."""
        keys = hosts.select("host", F.explode(keys_of(F.col("host"))).alias("key"))
        keys = keys.select("*", self.shard("key").alias("shard"))
        for n, level in enumerate(self.levels):
            keys = keys.join(level.select("shard", F.struct("bits", "words").alias(f"level{n}")), "shard", "left")
        empty = F.lit(64).cast("long"), F.array_repeat(F.lit(0).cast("long"), 1)

        def of(n: int) -> tuple[Column, Column]:
            level = F.col(f"level{n}")
            return F.coalesce(level["bits"], empty[0]), F.coalesce(level["words"], empty[1])

        return keys.where(self.lists(F.col("key"), of)).select("host").distinct()


def _rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        name = F.when(fits, domain + start).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, most_bits: int = MOST_BITS) -> DataFrame:
    """``pages`` with its columns plus a struct of host, path, rule and verdict
    as the last column. ``listed`` has the blocked domains in ``key``."""
    known = listed.where("key <> ''").select("key", F.lit(True).alias("listed")).distinct()
    cascade = Cascade(universe(pages).join(known, "key", "left")
                      .select("key", F.coalesce("listed", F.lit(False)).alias("listed")), most_bits)
    out, url = fresh("_judged", pages), host_and_path(F.col("url"))
    done = pages.select("*", F.struct(url[0].alias("host"), url[1].alias("path")).alias(out))
    host, path = F.col(f"{out}.host"), F.col(f"{out}.path")
    if cascade.shards == 1:
        is_listed = F.exists(keys_of(host), lambda key: cascade.lists(key))
    else:
        name, flag = fresh("_host", done), fresh("_listed", done)
        hosts = cascade.listed_hosts(pages.select(url[0].alias("host")).distinct())
        done = (done.withColumn(name, host)
                .join(hosts.select(F.col("host").alias(name), F.lit(True).alias(flag)), name, "left"))
        is_listed = F.coalesce(F.col(flag), F.lit(False))
    rule, verdict = _rule(host, path, rules)
    judged = F.struct(host.alias("host"), path.alias("path"), rule.alias("rule"), F.coalesce(
        verdict, F.when(is_listed, "block").otherwise("allow")).alias("verdict"))
    return done.select(*[F.col(f"`{c}`") for c in pages.columns], judged.alias(out))


def blocked_words(keys: DataFrame, words=BLOCKED_WORDS) -> DataFrame:
    """(key): the domains whose first label holds a blocked word."""
    return keys.where(F.col("key").rlike(rf"^([^.]*-)?({'|'.join(words)})(-[^.]*)?(\.|$)"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages under ``RULES``, and where none fits under the list of those
    domains of the corpus that carry a blocked word."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    done = judge(pages, blocked_words(universe(pages)))
    return done.select("page_id", f"{done.columns[-1]}.*")


ORACLE = {"op13_url_filters": """
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p),
u AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, '.' || host AS sub FROM u),
f AS (
  SELECT page_id, host, path, CASE
    WHEN suffix(sub, '.example.org') AND prefix(path, '/en/1') THEN 'example.org/en/1'
    WHEN suffix(sub, '.example.org') AND prefix(path, '/es/') THEN 'example.org/es/'
    WHEN suffix(sub, '.com') AND prefix(path, '/fr/') THEN 'com/fr/'
    WHEN suffix(sub, '.com') AND prefix(path, '/de/') THEN 'com/de/'
    WHEN suffix(sub, '.org') AND prefix(path, '/') THEN 'org/' END AS rule FROM r)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|porn|spam|xxx)([.-]|$)') AND length(host) <= 253
  THEN 'block' ELSE 'allow' END AS verdict
FROM f"""}
