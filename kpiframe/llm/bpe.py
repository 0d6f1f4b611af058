"""BPE encoding and decoding by batched numpy merge rounds.

The tokenizer file gives byte symbols, a vocabulary and ranked merges. Texts
are cut into pre-tokens; the distinct ones that a worker has not met are merged
together: their symbols lie in one flat array, each round looks every adjacent
pair up by binary search in the sorted pair keys, and every word merges the
pairs of its lowest rank. All its places of that rank are merged at once where
no pair that contains the new symbol has a lower rank (``whole_round``), else
only the leftmost, which is the order of the tokenizers library.

Special tokens in a text become their ids, as the library does by default, and
letters, numbers and spaces are those of the library (``PreTokens``).

Defined cases: null and empty texts have no ids and decode to ""; ids outside
the vocabulary are skipped when decoding and broken UTF-8 becomes U+FFFD;
repeated rows are encoded each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import documents, groups_of, worker_state

VOCABULARY = "byte_bpe_50k.json"
#: The pre-tokenizer's pattern; fixed by the file format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.int64(2**62)
GROUP_BYTES = 4_000_000
CACHE_ENTRIES = 400_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class BpeTable:
    """Vocabulary and merges of a tokenizer file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        alphabet = byte_alphabet()
        value = {c: b for b, c in enumerate(alphabet)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [b""] * self.size
        for token, i in vocab.items():
            self.tokens[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.vocab_ids = np.array(sorted(vocab.values()), np.int64)
        self.byte_ids = np.array([vocab[c] for c in alphabet], np.int64)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        into = np.array([vocab[a + b] for a, b in merges], np.int64)
        rank = np.arange(len(merges), dtype=np.int64)
        lowest = np.full(self.size, NONE)  # of the pairs that contain a symbol
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        self.whole_round = lowest[into] > rank
        self.into = into
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank = keys[order], rank[order]

    def ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rank of the pair that starts at each place ``at``, or NONE."""
        nxt = np.minimum(at + 1, len(symbols) - 1)
        key = symbols[at] * self.size + symbols[nxt]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[found] == key) & (nxt > at) & (word[at] == word[nxt]), self.key_rank[found], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word ends in it."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = self.ranks(symbols, word, np.arange(len(symbols)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, first)
            over = least == NONE
            sizes = np.diff(np.r_[first, len(symbols)])
            least = np.repeat(least, sizes)
            if over.any():
                over = np.repeat(over, sizes)
                done.append((word[over], symbols[over]))
                go = ~over
                symbols, word, rank, least = symbols[go], word[go], rank[go], least[go]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == least)
            # of touching places every second one, counted from the left
            runs = np.r_[True, (np.diff(hit) > 1) | (word[hit[1:]] != word[hit[:-1]])]
            start = hit[runs][np.cumsum(runs) - 1]
            hit = hit[(hit - start) % 2 == 0]
            alone = ~self.whole_round[rank[hit]]
            if alone.any():
                hit = hit[~alone | np.r_[True, word[hit[1:]] != word[hit[:-1]]]]
            symbols[hit] = self.into[rank[hit]]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            symbols, word, rank = symbols[stay], word[stay], rank[stay]
            at = hit - np.arange(len(hit))  # only pairs with a new symbol have changed
            rank[at] = self.ranks(symbols, word, at)
            at = at[at > 0] - 1
            rank[at] = self.ranks(symbols, word, at)
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word = np.concatenate([w for w, _ in done])
        symbols = np.concatenate([s for _, s in done])[np.argsort(word, kind="stable")]
        return symbols, np.cumsum(np.bincount(word, minlength=len(words)))


def table(path: str) -> BpeTable:
    kept = worker_state()
    if ("bpe", path) not in kept:
        kept["bpe", path] = BpeTable(path)
    return kept["bpe", path]


class Chunker:
    """Cuts texts where pre-tokens always end: before a space that a visible
    character follows, and around special tokens."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.mark = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.odd = re.compile(r" (?!\S)")
        self.space = re.compile(r" (?=\S)")

    def __call__(self, text: str) -> list[str]:
        if self.mark and any(s in text for s in self.special):
            return [c for part in self.mark.split(text) if part
                    for c in ([part] if part in self.special else self.plain(part))]
        return self.plain(text) if text else []

    def plain(self, text: str) -> list[str]:
        first, *rest = self.space.split(text) if self.odd.search(text) else text.split(" ")
        return [*([first] if first else []), *map(" ".__add__, rest)]

    def distinct(self, texts: list[str]):
        """Two parts of the texts, each as (places of its texts, distinct chunks,
        the chunks' numbers in the order of the texts, and where each text ends
        in them). Arrow splits the texts in which every space is one to cut at."""
        special = list(self.special)
        odd = [self.odd.search(t) is not None or any(s in t for s in special) for t in texts]
        where = [k for k, o in enumerate(odd) if not o]
        if where:
            cut = pc.split_pattern(pa.array([texts[k] for k in where], pa.large_string()), " ")
            ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))
            flat = cut.flatten()
            coded = flat.dictionary_encode()
            numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.r_[0, ends[:-1]]  # a text's first chunk follows no space
            first = flat.take(pa.array(at)).dictionary_encode()
            numbers[at] = first.indices.to_numpy(zero_copy_only=False) + len(coded.dictionary)
            yield where, [*map(" ".__add__, coded.dictionary.to_pylist()), *first.dictionary.to_pylist()], numbers, ends
        where = [k for k, o in enumerate(odd) if o]
        if where:
            cut = [self(texts[k]) for k in where]
            known = {c: k for k, c in enumerate(dict.fromkeys(c for chunks in cut for c in chunks))}
            yield where, list(known), np.array([known[c] for chunks in cut for c in chunks], np.int64), np.cumsum([*map(len, cut)])


class PreTokens:
    """The pre-tokens of a chunk; a chunk of letters alone is one.

    What is a letter, a number or a space depends on the Unicode version, and
    Python's, the regex module's and the tokenizers library's differ. Each code
    point beyond ASCII is asked of the library's pre-tokenizer when it is first
    met; a chunk with one that is of another class there is cut by the library."""

    def __init__(self):
        from tokenizers import pre_tokenizers

        self.find = regex.compile(PATTERN).findall
        self.kind = regex.compile(r"(?P<L>\p{L})|(?P<N>\p{N})|(?P<S>\s)").match
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        self.agreed: set[str] = set()
        self.odd: set[str] = set()

    def agrees(self, c: str) -> bool:
        theirs = next((kind for before, kind in (("a", "L"), ("1", "N"), ("!", None)) if len(self.library(before + c)) == 1), "S")
        found = self.kind(c)
        return (found and found.lastgroup) == theirs and c.isalpha() == (theirs == "L")

    def __call__(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            met = set(chunk) - self.agreed
            if met:
                good = {c for c in met - self.odd if c.isascii() or self.agrees(c)}
                self.agreed |= good
                self.odd |= met - good
                if met - good:
                    return [chunk[a:b] for _, (a, b) in self.library(chunk)]
        return [chunk] if (chunk[1:] if chunk[0] == " " else chunk).isalpha() else self.find(chunk)


class Encoder:
    """Texts to ids. The cache of chunks is bounded and emptied when full; it
    changes no result."""

    nothing = b""

    def __init__(self, path: str):
        self.table = table(path)
        self.chunks = Chunker(self.table.special)
        self.cut = PreTokens()
        self.known: dict[str, bytes] = {}

    def learn(self, new: set[str]) -> None:
        found = {c: self.cut(c) for c in new if c not in self.table.special}
        words = list(set().union(*found.values()))
        ids, ends = self.table.merge([w.encode("utf-8") for w in words])
        data = ids.astype("<u4").tobytes()
        ends = (ends * 4).tolist()
        of = {w: data[a:b] for w, a, b in zip(words, [0, *ends], ends)}
        for c, ws in found.items():
            self.known[c] = of[c] if len(ws) == 1 else b"".join(map(of.__getitem__, ws))
        for c in new & self.table.special.keys():
            self.known[c] = np.array([self.table.special[c]], "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        """For each text, its ids as little-endian unsigned 32-bit integers."""
        out = [b""] * len(texts)
        for where, chunks, numbers, ends in self.chunks.distinct(texts):
            self.meet(chunks)
            found = list(map(self.known.__getitem__, chunks))
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            ids = np.frombuffer(b"".join(found), "<u4")
            many = sizes[numbers]
            upto = np.r_[0, np.cumsum(many)]
            places = np.repeat((np.cumsum(sizes) - sizes)[numbers] - upto[:-1], many) + np.arange(upto[-1])
            data, at = ids[places].tobytes(), (upto[np.r_[0, ends]] * 4).tolist()
            for k, a, b in zip(where, at, at[1:]):
                out[k] = data[a:b]
        return out

    def meet(self, chunks: list[str]) -> None:
        """Learn the chunks that are not known."""
        new = set(chunks) - self.known.keys()
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known, new = {}, set(chunks)
        self.learn(new - {""})
        self.known[""] = self.nothing


def encoder(path: str) -> Encoder:
    kept = worker_state()
    if ("encoder", path) not in kept:
        kept["encoder", path] = Encoder(path)
    return kept["encoder", path]


def decode(ids: bytes, path: str) -> str:
    bpe = table(path)
    values = np.frombuffer(ids, "<u4")
    if len(values) and values.max() >= bpe.size:
        values = values[values < bpe.size]
    return b"".join(map(bpe.tokens.__getitem__, values.tolist())).decode("utf-8", "replace")


def path_of(vocabulary: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def _mapped(docs: DataFrame, columns: list[T.StructField], of, group_bytes: int) -> DataFrame:
    """``docs`` (doc_id, text) with columns that ``of(texts)`` gives as lists."""
    schema = T.StructType([docs.schema["doc_id"], *columns])

    def run(batches):
        for rows in groups_of(batches, group_bytes, lambda r: len(r["text"] or "") + 64):
            found = of([r["text"] or "" for r in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["doc_id"] for r in rows], kind), *map(pa.array, found)], names=schema.names)

    kind = to_arrow_type(schema["doc_id"].dataType)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers."""
    return _mapped(docs, [T.StructField("ids", T.BinaryType())],
                   lambda texts: [encoder(path)(texts)], group_bytes)


def round_trip(docs: DataFrame, path: str, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def both(texts):
        ids = encoder(path)(texts)
        return [[len(x) // 4 for x in ids], [sha(x) for x in ids],
                [sha(decode(x, path).encode("utf-8")) for x in ids]]

    return _mapped(docs, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                          T.StructField("decoded_sha256", T.StringType())], both, group_bytes)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), path_of(VOCABULARY))
