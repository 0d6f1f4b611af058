"""The pipeline's stages, each against brute force on its own input."""

import hashlib
import os
import re
from collections import Counter

import corpus_pipeline as pipeline
from kpiframe.llm import jaccard_join, mixing, quality_rules
from kpiframe.llm.common import documents, materialise

SMALL = "/root/testdata/sf0.001"


def test_every_stage_on_its_input(spark):
    docs = documents(spark, SMALL)
    start = {r["doc_id"]: r for r in docs.collect()}
    names = [name for name, _ in pipeline.STAGES]
    step = dict(pipeline.STAGES)

    def run(name, df):
        out = materialise(step[name](spark, df, SMALL))
        return out, out.collect()

    kept, rows = run(names[0], docs)
    fine = lambda t: not any(eval(sql.format(**dict(zip(quality_rules.MEASURES, quality_rules.measure(t)))))
                             for _, sql in quality_rules.RULES)
    assert {r["doc_id"] for r in rows} == {i for i, r in start.items() if fine(r["text"])}

    lines, rows = run(names[1], kept)
    first = {}
    for r in sorted(kept.collect(), key=lambda r: r["doc_id"]):
        for line in r["text"].split("\n"):
            first.setdefault(line.strip(" \t\x0b\x0c\r").lower(), r["doc_id"])
    for r in rows:
        stay = [x for x in start[r["doc_id"]]["text"].split("\n")
                if len(x.strip(" \t\x0b\x0c\r")) < 10 or first[x.strip(" \t\x0b\x0c\r").lower()] == r["doc_id"]]
        assert r["text"] == "\n".join(stay) and r["n_chars"] == len(r["text"])

    alone, rows = run(names[2], lines)
    sets = {r["doc_id"]: set(jaccard_join.shingles(r["text"]).tolist()) for r in lines.collect()}
    ids = sorted(sets)
    lowest = {i: i for i in ids}
    for _ in range(5):
        for i in ids:
            for j in ids:
                if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    lowest[i] = lowest[j] = min(lowest[i], lowest[j])
    assert {r["doc_id"] for r in rows} == {i for i in ids if lowest[i] == i}
    assert alone.columns == docs.columns

    mixed, rows = run(names[3], alone)
    assert mixed.columns == docs.columns and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in alone.collect()}

    last, rows2 = run(names[4], mixed)
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in rows2) == sorted(
        (r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows)


def test_run_is_the_stages(spark):
    assert pipeline.run(spark, SMALL).count() > 0
    assert os.path.basename(pipeline.__file__) == "corpus_pipeline.py"


def plain_mix(rows):
    """(doc_id, text) of every copy; rows of (doc_id, source, text)."""
    words = lambda t: re.findall(r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+", t or "")
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s))
    weights = {s: mixing.WEIGHTS[k % len(mixing.WEIGHTS)] for k, s in enumerate(sources)}
    sizes = {s: sum(len(words(t)) for _, x, t in rows if x == s) for s in sources}
    goal, free, left = {}, set(sources), sum(sizes.values())
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        full = {s for s in free if share[s] > mixing.MOST_EPOCHS * sizes[s]}
        goal.update({s: mixing.MOST_EPOCHS * sizes[s] for s in full} if full else share)
        left -= sum(mixing.MOST_EPOCHS * sizes[s] for s in full)
        free = free - full if full else set()
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    key = lambda i, t: int(md5(f"{mixing.SEED}:{'' if i is None else i}:{md5(t or '')}")[:15], 16)
    out = []
    for s in sources:
        order = sorted((key(i, t), i, len(words(t)), t) for i, x, t in rows if x == s)
        budget = round(goal[s])
        while budget and sizes[s]:
            for _, i, size, text in order:
                if size and budget >= size:
                    out.append((i, text))
                elif size and budget:
                    out.append((i, "".join(words(text)[:budget])))
                budget -= min(size, budget)
    return out


def test_mix_and_run_are_plain_python(spark):
    stages = dict(pipeline.STAGES)
    mixed = stages["mixing sources to target weights"](spark, documents(spark, SMALL), SMALL).collect()
    rows = [(r["doc_id"], r["source"], r["text"]) for r in documents(spark, SMALL).collect()]
    assert Counter((r["doc_id"], r["text"]) for r in mixed) == Counter(plain_mix(rows))
    source = {i: s for i, s, _ in rows}
    assert Counter(r["source"] for r in mixed) == Counter(source[i] for i, _ in plain_mix(rows))
    full = {(i, t) for i, _, t in rows}
    assert all(r["n_chars"] == len(r["text"]) for r in mixed if (r["doc_id"], r["text"]) not in full)

    kept = sorted((i, s, t) for i, s, t in rows if not any(
        eval(sql.format(**dict(zip(quality_rules.MEASURES, quality_rules.measure(t))))) for _, sql in quality_rules.RULES))
    first, left = {}, []
    for i, s, t in kept:
        stay = []
        for line in t.split("\n"):
            bare = line.strip(" \t\x0b\x0c\r")
            if len(bare) < 10 or first.setdefault(bare.lower(), i) == i:
                stay.append(line)
        left.append((i, s, "\n".join(stay)))
    sets = [set(jaccard_join.shingles(t).tolist()) for *_, t in left]
    lowest = list(range(len(left)))
    for _ in range(5):
        for a, one in enumerate(sets):
            for b, two in enumerate(sets):
                if one and two and len(one & two) >= 0.8 * len(one | two):
                    lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    want = plain_mix([r for k, r in enumerate(left) if lowest[k] == k])
    got = pipeline.run(spark, SMALL).collect()
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in got) == Counter(
        (i, hashlib.sha256(t.encode()).hexdigest()) for i, t in want)
