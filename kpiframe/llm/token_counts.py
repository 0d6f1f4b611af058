"""Token counts with the whole-token shortcut.

``prove_whole`` finds, before any text is read, the vocabulary strings that
the merges turn back into their one token when they stand alone. A pre-token
among them counts 1 without merging; only the others are merged, distinct ones
together, by the merge rounds of ``bpe``. Special tokens in a text count 1.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
are counted each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .bpe import GROUP_BYTES, BpeTable, Encoder, _mapped, path_of
from .common import documents, worker_state

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024


def prove_whole(bpe: BpeTable) -> frozenset[str]:
    """The vocabulary strings (valid UTF-8) that encode alone as one token."""
    tokens = [bpe.tokens[i] for i in bpe.vocab_ids.tolist()]
    ids, ends = bpe.merge(tokens)
    counts = np.diff(np.r_[0, ends])
    whole = (counts == 1) & (ids[np.maximum(ends - 1, 0)] == bpe.vocab_ids)
    strings = (tokens[k].decode("utf-8", "ignore") for k in np.flatnonzero(whole))
    return frozenset(s for s, k in zip(strings, np.flatnonzero(whole)) if s.encode("utf-8") == tokens[k])


class Counter(Encoder):
    """Texts to token counts; the cache is bounded and changes no result."""

    nothing = 0

    def __init__(self, path: str):
        super().__init__(path)
        self.whole = prove_whole(self.table)

    def learn(self, new: set[str]) -> None:
        shortcut = {c for c in new if c in self.whole or c in self.table.special}
        self.known.update(dict.fromkeys(shortcut, 1))
        found = {c: self.cut(c) for c in new - shortcut}
        words = [w for w in set().union(*found.values()) if w not in self.whole]
        _, ends = self.table.merge([w.encode("utf-8") for w in words])
        of = dict(zip(words, np.diff(np.r_[0, ends]).tolist()))
        for c, ws in found.items():
            self.known[c] = sum(of.get(w, 1) for w in ws)  # 1: a whole token

    def __call__(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        for where, chunks, numbers, ends in self.chunks.distinct(texts):
            self.meet(chunks)
            counts = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
            upto = np.r_[0, np.cumsum(counts[numbers])][np.r_[0, ends]]
            for k, n in zip(where, np.diff(upto).tolist()):
                out[k] = n
        return out


def counter(path: str) -> Counter:
    kept = worker_state()
    if ("counter", path) not in kept:
        kept["counter", path] = Counter(path)
    return kept["counter", path]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    def counted(texts):
        n = counter(path)(texts)
        return [[len(t.encode("utf-8")) for t in texts], n, [x > limit for x in n]]

    return _mapped(docs, [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                          T.StructField("over_limit", T.BooleanType())], counted, group_bytes)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), path_of(VOCABULARY))
