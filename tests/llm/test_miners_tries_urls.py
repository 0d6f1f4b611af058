"""Hard negatives, prefix tries and URL filters against brute force and on edge cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiframe.llm import hard_negatives, prefix_trie, url_filters

EXTRA = ("row", "rep", "slab", "bin", "host", "path", "key", "cell", "_judged", "windows")


def clashing(df):
    """With extra columns whose names the operators use themselves."""
    return df.select("*", *[F.lit(7).alias(c) for c in EXTRA if c not in df.columns])


# -- hard negatives ---------------------------------------------------------------------------
VECTORS = "vec_id bigint, embedding array<double>, label int"


def slow_mine(rows, anchor_every):
    whole = [(i, v, [math.floor(256 * x) for x in e], n) for n, (i, e, v) in enumerate(rows)
             if v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for aid, alabel, a, an in whole:
        if aid is None or aid % anchor_every:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a, b)), i, label, n) for i, label, b, n in whole),
                        key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for p in [s for s in scored if s[2] == alabel and s[3] != an][:5]:
            fits = [s for s in scored if s[2] != alabel and 30 * p[0] <= 100 * s[0] <= 90 * p[0]][:10]
            out += [(aid, p[1], r, s[1], p[0], s[0]) for r, s in enumerate(fits, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("scale", [1.0, 30.0, 40_000.0])
def test_hard_negatives_are_the_slow_ones(spark, scale):
    rnd = random.Random(int(scale))
    rows = [(i, [rnd.gauss(0.3, 1) * scale for _ in range(9)], rnd.randint(0, 2)) for i in range(300)]
    rows += [(i, rows[4][1], 1) for i in range(300, 340)]  # ties
    rows += [rows[10], rows[20], rows[20], (None, rows[4][1], 0), (400, [], 1), (410, [0.5] * 4, 2), (420, None, 1),
             (430, [1.0] * 9, None), (440, [1.0, None], 1), (450, [float("nan")] * 9, 1), (460, [float("inf")], 0)]
    df = clashing(spark.createDataFrame(rows, VECTORS))
    got = [tuple(r) for r in hard_negatives.mine(df, anchor_every=10).collect()]
    want = slow_mine(rows, 10)
    assert len(want) > 500 and sorted(got, key=str) == want


def test_many_blocks_and_slabs_give_the_same(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(i, [rnd.random() for _ in range(5)], rnd.randint(0, 3)) for i in range(200)]
    df = spark.createDataFrame(rows, VECTORS).cache()
    want = slow_mine(rows, 4)
    for values, least in ((20, 5), (1 << 20, 10**6)):
        monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", values)
        monkeypatch.setattr(hard_negatives, "LEAST_ROWS", least)
        monkeypatch.setattr(hard_negatives, "SCORES", 64)
        assert sorted(map(tuple, hard_negatives.mine(df, anchor_every=4).collect()), key=str) == want


def test_scores_are_exact_up_to_the_limit():
    rnd = np.random.default_rng(5)
    for size, dims in ((2.0**8, 64), (2.0**20, 130), (2.0**23.5, 200)):
        a, b = (np.floor(rnd.uniform(-size, size, (7, dims))) for _ in range(2))
        bound = int(dims * size * size) + 1
        assert bound <= hard_negatives.MOST
        moduli = hard_negatives.primes(bound)
        got = hard_negatives.products(hard_negatives.residues(a, moduli), hard_negatives.residues(b, moduli), moduli)
        exact = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert got.tolist() == exact


def test_scores_beyond_the_limit_are_refused_and_empty_tables_work(spark):
    with pytest.raises(ValueError):
        hard_negatives.mine(spark.createDataFrame([(0, [1e9], 1)], VECTORS))
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS)).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(0, [1.0], 1)], VECTORS)).collect() == []


# -- prefix tries -----------------------------------------------------------------------------
TURNS = "conv_id bigint, turn bigint, role string, text string"


def slow_trie(sequences):
    """Nodes of {conv_id: [(role, text), ...]} by walking every prefix."""
    members, nodes = {}, []
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        kids = [below(k) for k in children.get(p, [])]
        own = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        return sum(k[0] for k in kids) or 1, own + sum(k[1] for k in kids)

    for p, who in members.items():
        leaves, saved = below(p)
        ends = ",".join(map(str, sorted(c for c in who if len(sequences[c]) == len(p))))
        nodes.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children.get(p, [])), leaves,
                      saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(nodes, key=str)


def by_turn(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            out.setdefault(c, []).append((role or "", text or ""))
    return out


def slow_rebuilt(sequences):
    out = {}
    for c, turns in sequences.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = sequences.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def conversations(seed, n=150):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-40, 420), n):
        # turns with gaps, few different texts, so that prefixes meet
        rows += [(c, t * 3, rnd.choice(["u", "a", None]), rnd.choice(["x", "yé", "", None, "z" * 40]) if rnd.random() < 0.8 else str(c))
                 for t in range(rnd.choice([1, 2, 3, 5, 7, 8, 20]))]
    for c in range(500, 540):  # copies
        rows += [(c, None if t == 0 else t, "u", f"copy {t}") for t in range(9)]
    rows += [(700, t, "u", "long") for t in range(400)] + [(701, t, "u", "long") for t in range(390)]
    rows += [(None, 1, "u", "no id"), (800, 5, "u", "twice"), (800, 5, "u", "twice"), (800, 6, "u", "w " * 60_000)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_rows": 20}, {"shard_rows": 400, "first_cut": 1}])
def test_trie_is_the_slow_one(spark, options):
    rows = conversations(len(options))
    got = prefix_trie.prefix_trie(clashing(spark.createDataFrame(rows, TURNS)), **options)
    assert sorted(map(tuple, got.collect()), key=str) == slow_trie(by_turn(rows))


def test_rebuilt_trie_is_the_slow_one(spark):
    rows = conversations(9)
    turns = prefix_trie.ranked(clashing(spark.createDataFrame(rows, TURNS)))
    got = prefix_trie.trie(prefix_trie.prefixes(*prefix_trie.rebuilt(turns)), shard_rows=60)
    assert sorted(map(tuple, got.collect()), key=str) == slow_trie(slow_rebuilt(by_turn(rows)))


def test_empty_and_turnless_conversations(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    # h of 10 is 1 or more and conversation 0 is absent, so what is left of 10 is turnless
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6)
    turns = prefix_trie.ranked(spark.createDataFrame([(c, 0, "u", "hello")], TURNS))
    got = [tuple(r) for r in prefix_trie.trie(prefix_trie.prefixes(*prefix_trie.rebuilt(turns))).collect()]
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_ends_in_many_pieces(spark):
    rows = [(c, 0, "u", "same") for c in range(3000)]
    got = {r.depth: r for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()}
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    assert (got[0].n_convs, got[1].n_convs, got[1].saved_tokens) == (3000, 3000, 2999 * 4)


def test_double_array_keeps_all_children_apart():
    rnd = random.Random(2)
    trie, want, level = prefix_trie.DoubleArray(), {}, [0]
    for _ in range(6):
        pairs = sorted({(p, c) for p in level for c in rnd.sample(range(60), rnd.choice([0, 1, 1, 2, 9]))})
        if not pairs:
            break
        parents, codes = (np.array(x) for x in zip(*pairs))
        slots = trie.pack(parents, codes)
        want |= dict(zip(pairs, slots.tolist()))
        level = slots.tolist()
    assert len(set(want.values())) == len(want) and 0 not in want.values()
    for (p, c), slot in want.items():
        assert trie.step(np.array([p]), np.array([c]))[0] == slot
    with pytest.raises(KeyError):
        trie.step(np.array([0]), np.array([10**9 % 60 + 61]))


# -- URL filters ------------------------------------------------------------------------------
URLS = [None, "", "no scheme", "http://A.Example.ORG/en/12?x", "http://example.org", "http://example.org/es/", "http://example.org/es",
        "https://notexample.org/es/", "http://u:p@x.com:80/fr/1#t", "http://x.com/de/://y.net/", "http://x.com?/de/", "://", "://a.org/",
        "http://spam-farm.x.net/a", "http://deep.spam-farm.x.net", "http://x.net/spam", "http://nospam.net/", "http://SPAM.de/ß\n/2",
        "http://" + "a." * 130 + "spam.net/", "http://" + "b" * 100_000 + ".net/" + "p" * 100_000, "http://é.spam/"]
PAGES = "page_id bigint, url string"


def slow_judge(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for verdict, domain, start in url_filters.RULES:
        if ("." + host).endswith("." + domain) and path.startswith(start) and (not best or len(domain + start) > len(best[0])):
            best = (domain + start, verdict)
    labels = host.split(".")
    keys = {".".join(labels[i:]) for i in range(len(labels))} if len(host) <= 253 else set()
    return host, path, best and best[0], best[1] if best else "block" if keys & listed else "allow"


@pytest.mark.parametrize("most_bits", [1 << 23, 64])
def test_urls_are_judged_as_slowly(spark, most_bits):
    rows = [(i % 15 or None, u) for i, u in enumerate(URLS + URLS[5:9])] + [(i, f"http://h{i}.net/{i}") for i in range(2000)]
    listed = {"spam-farm.x.net", "net.", "absent.org", "spam.net", "spam.de"} | {f"h{i}.net" for i in range(0, 2000, 3)}
    pages = clashing(spark.createDataFrame(rows, PAGES))
    given = spark.createDataFrame([(k,) for k in [*listed, "", "spam.de", None]], "key string")
    done = url_filters.judge(pages, given, most_bits=most_bits)
    assert done.columns[:-1] == pages.columns
    got = sorted(((r["page_id"], r["url"], *r[done.columns[-1]]) for r in done.collect()), key=str)
    assert got == sorted(((i, u, *slow_judge(u, listed)) for i, u in rows), key=str)


def test_cascade_has_levels_and_is_exact(spark):
    keys = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = url_filters.Cascade(keys)
    assert len(cascade.levels) >= 2
    wrong = keys.where(cascade.lists(F.col("key")) != F.col("listed"))
    assert wrong.count() == 0


def test_empty_pages_and_lists(spark):
    none = spark.createDataFrame([], "key string")
    assert url_filters.judge(spark.createDataFrame([], PAGES), none).collect() == []
    done = url_filters.judge(spark.createDataFrame([(1, "http://a.net/")], PAGES), none)
    assert done.first()[done.columns[-1]]["verdict"] == "allow"


def test_url_filters_run_no_python(spark):
    from kpiframe.plans.inspect import explain_text
    text = explain_text(url_filters.op13_url_filters(spark, "/root/testdata/sf0.001"))
    assert not any(x in text for x in ("Python", "Arrow", "Join"))


def test_blocked_words_are_whole(spark):
    keys = ["spam.a", "spam-x.a", "x-spam", "x-spam-y.b", "nospam.a", "a.spam", "spamx", "x-pills"]
    got = url_filters.blocked_words(spark.createDataFrame([(k,) for k in keys], "key string"))
    assert {r.key for r in got.collect()} == {"spam.a", "spam-x.a", "x-spam", "x-spam-y.b", "x-pills"}
