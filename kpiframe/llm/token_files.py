"""Token-ID files with a shared zstandard dictionary.

A dataset is a folder of three Parquet tables, so that any file system Spark
knows can hold it:

* ``dictionary``: one row, the dictionary trained on serialized id arrays of a
  bounded sample (``SAMPLE_DOCS`` documents, ``SAMPLE_BYTES`` of each), its
  sha256, and the bytes of an id (2 or 4, little-endian);
* ``blocks``: in ascending doc_id order, one row per block of documents: the
  separately compressed documents one after another (``payload``), the offset
  index (``offsets``, one more than documents), ``doc_ids``, ``n_tokens`` and
  the dictionary's hash, checked on every read;
* ``index``: for each block the number of ids before it.

``read`` gives all documents, ``fetch`` some of them: it reads the blocks whose
id range may hold them and decompresses only their frames.

Defined cases: null text is an empty text and holds only the end id; rows with
a null doc_id come first; rows that share a doc_id are all kept, ordered by
their texts' hash; tables too small to train a dictionary use the sample itself
as one; an empty table gives an empty dataset and an empty result.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import path_of
from .common import documents, groups_of, scratch, worker_state

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 32_768
LEVEL = 3
BLOCK_BYTES = 1_000_000
GROUP_BYTES = 8_000_000
CACHE_ENTRIES = 1_200_000
SLICE = 5000
JOINED = 100
#: Marks that follow words; none of them begins a contraction or a special token.
MARKS = b".,;:!?*#$%&"

DICTIONARY = "dictionary binary, dict_sha256 string, id_bytes int"
BLOCKS = ("file int, block int, first_doc bigint, last_doc bigint, dict_sha256 string, doc_ids array<bigint>, "
          "n_tokens array<bigint>, offsets array<bigint>, payload binary")


class WordTokenizer:
    """The tokenizers library behind a cache by stretches without white space,
    which this file's pre-tokenizer never joins. The cache is bounded: it has
    two halves, and when the newer one is full the older one goes.

    Words that are one pre-token each are handed to the library joined by
    spaces; where the file marks the ends of words, the ids are cut there.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.width = 2 if len(vocabulary) <= 65_536 else 4
        self.kind = f"<u{self.width}"
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if mark and token.endswith(mark)]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def cut(self, texts: list[str]) -> pa.LargeListArray:
        """The texts' stretches, empty ones at their ends included; A-Z are
        lowered as the library would, but not where that could make a special
        token."""
        data = pa.array(texts, pa.large_string())
        return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(data, "<|"), data, pc.ascii_lower(data)))

    def library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, new: list[bytes]) -> None:
        """Put ``new`` into the cache."""
        words, others = [], []
        for c in new:
            (words if is_letters(c) else others).append(c)
        for at in range(0, len(words), SLICE):  # the library's results are large
            part = words[at:at + SLICE]
            ids = np.concatenate(self.library([
                b" ".join(part[k:k + JOINED]).decode("utf-8") for k in range(0, len(part), JOINED)]))
            ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * self.width).tolist()
            if len(ends) != len(part):
                others += part
                continue
            data = ids.tobytes()
            self.known.update((c, data[a:b]) for c, a, b in zip(part, [0, *ends], ends))
        for at in range(0, len(others), SLICE):
            part = others[at:at + SLICE]
            self.known.update((c, x.tobytes()) for c, x in zip(part, self.library([c.decode("utf-8") for c in part])))

    def learn(self, new: set[bytes]) -> None:
        # what stays letters when normalised, and a run of marks after it, are two pre-tokens
        marked = {}
        for c in new:
            if c[-1] in MARKS:
                letters = c.rstrip(MARKS)
                if is_letters(letters):
                    marked[c] = letters, c[len(letters):]
        plain = (new - marked.keys()).union(*marked.values()) - self.known.keys()
        again = plain & self.older.keys()
        self.known.update((c, self.older[c]) for c in again)
        self.encode(list(plain - again))
        self.known.update((c, self.known[a] + self.known[b]) for c, (a, b) in marked.items())

    def __call__(self, texts: list[str]) -> list[bytes]:
        """For each text, its ids. Distinct stretches are looked up once, and
        their ids gathered into the texts' order."""
        cut = self.cut(texts)
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
        new = set(distinct) - self.known.keys()
        if len(self.known) + len(new) > CACHE_ENTRIES // 2:
            self.known, self.older, new = {}, self.known, set(distinct)
        self.learn(new - {b""})
        self.known[b""] = b""
        found = list(map(self.known.__getitem__, distinct))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        ids = np.frombuffer(b"".join(found), self.kind)
        word = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.r_[0, np.cumsum(sizes[word])]
        places = np.repeat((np.cumsum(sizes) - sizes)[word] - ends[:-1], sizes[word]) + np.arange(ends[-1])
        bounds = np.r_[0, np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))]
        data, at = ids[places].tobytes(), (ends[bounds] * self.width).tolist()
        return [data[a:b] for a, b in zip(at, at[1:])]


def is_letters(word: bytes) -> bool:
    """Whether the normalised word is one pre-token of letters."""
    if word.isascii():
        return word.isalpha()
    return unicodedata.normalize("NFC", word.decode("utf-8")).lower().isalpha()


def tokenizer(path: str) -> WordTokenizer:
    kept = worker_state()
    if ("words", path) not in kept:
        kept["words", path] = WordTokenizer(path)
    return kept["words", path]


def _packed(docs: DataFrame, path: str, end_id: int, columns: str, of) -> DataFrame:
    """doc_id and what ``of(ids, width)`` gives for each document."""
    def run(batches):
        for rows in groups_of(batches, GROUP_BYTES, lambda r: len(r["text"] or "") + 64):
            tok = tokenizer(path)
            end = np.array([end_id], f"<u{tok.width}").tobytes()
            found = [of(x + end, tok.width) for x in tok([r["text"] or "" for r in rows])]
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": r["doc_id"], **x} for r, x in zip(rows, found)], schema=kind)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = f"doc_id bigint, {columns}"
    kind = to_arrow_schema(_parse_datatype_string(schema))
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def train(docs: DataFrame, path: str, end_id: int) -> tuple[bytes, int]:
    """The dictionary and the bytes of an id."""
    spread = 1_000_000
    share = min(spread, spread * SAMPLE_DOCS // max(1, docs.count()) + 1)
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(spread)) < share).limit(2 * SAMPLE_DOCS)
    rows = _packed(some, path, end_id, "ids binary, width int",
                   lambda ids, width: {"ids": ids[:SAMPLE_BYTES], "width": width}).collect()
    samples = sorted(bytes(r["ids"]) for r in rows)
    width = rows[0]["width"] if rows else tokenizer(path).width
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes(), width
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:], width


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write them as a dataset."""
    spark = docs.sparkSession
    data, width = train(docs, path, end_id)
    digest = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(bytearray(data), digest, width)], DICTIONARY).coalesce(1).write.parquet(f"{folder}/dictionary")

    def laid_out(batches):
        """The rows of one block after another: doc_id, n_tokens, frame."""
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data)).compress
        end = np.array([end_id], f"<u{width}").tobytes()
        rows, size = [], 0
        for texts in groups_of(batches, GROUP_BYTES, lambda r: len(r["text"] or "") + 64):
            for r, ids in zip(texts, tokenizer(path)([r["text"] or "" for r in texts])):
                frame = compress(ids + end)
                rows.append({"doc_id": r["doc_id"], "n_tokens": len(ids) // width + 1, "frame": frame})
                size += len(frame) + 24
                if size >= BLOCK_BYTES:
                    yield rows
                    rows, size = [], 0
        if rows:
            yield rows

    def blocks(batches):
        # encoded, compressed and laid out by one worker: a second one would
        # hold another tokenizer and cache
        file, block = TaskContext.get().partitionId(), 0
        for rows in laid_out(batches):
            yield pa.RecordBatch.from_pylist([{
                "file": file, "block": block, "first_doc": rows[0]["doc_id"], "last_doc": rows[-1]["doc_id"],
                "dict_sha256": digest, "doc_ids": [r["doc_id"] for r in rows],
                "n_tokens": [r["n_tokens"] for r in rows],
                "offsets": np.cumsum([0, *(len(r["frame"]) for r in rows)]).tolist(),
                "payload": b"".join(r["frame"] for r in rows)}], schema=kind)
            block += 1

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_schema(_parse_datatype_string(BLOCKS))
    # texts are dealt before they are encoded: dealing by range samples its
    # input first, and would encode everything twice
    (docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).repartitionByRange("doc_id", "tie")
     .sortWithinPartitions("doc_id", "tie").drop("tie").mapInArrow(blocks, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks"))

    sizes = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").select(
        "file", "block", F.expr("aggregate(n_tokens, 0L, (a, x) -> a + x)").alias("ids"))
    before = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = sizes.groupBy("file").agg(F.sum("ids").alias("ids")).select(
        "file", before(Window.orderBy("file")).alias("file_start"))
    (sizes.withColumn("in_file", before(Window.partitionBy("file").orderBy("block"))).join(files, "file")
     .select("file", "block", (F.col("file_start") + F.col("in_file")).cast("long").alias("block_start"))
     .write.parquet(f"{folder}/index"))


def _decoded(spark: SparkSession, folder: str, blocks: DataFrame, wanted: frozenset | None, columns: str, of) -> DataFrame:
    """start_in_block, doc_id, n_tokens and what ``of(ids as uint32)`` gives."""
    row = spark.read.schema(DICTIONARY).parquet(f"{folder}/dictionary").first()
    data, digest, kind_of_id = bytes(row["dictionary"]), row["dict_sha256"], f"<u{row['id_bytes']}"
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError(f"{folder}: the dictionary does not have its hash")

    def run(batches):
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        for batch in batches:
            for b in range(batch.num_rows):
                r = {c: batch.column(c)[b].as_py() for c in batch.schema.names}
                if r["dict_sha256"] != digest:
                    raise ValueError(f"block {r['block']} of file {r['file']} needs dictionary {r['dict_sha256']}")
                rows, start, payload = [], 0, memoryview(r["payload"])
                for k, (doc, n) in enumerate(zip(r["doc_ids"], r["n_tokens"])):
                    if wanted is None or doc in wanted:
                        ids = np.frombuffer(unpack.decompress(payload[r["offsets"][k]:r["offsets"][k + 1]]), kind_of_id)
                        rows.append({"file": r["file"], "block": r["block"], "doc_id": doc, "in_block": start,
                                     "n_tokens": n, **of(ids.astype("<u4"))})
                    start += n
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = f"file int, block int, doc_id bigint, in_block bigint, n_tokens bigint, {columns}"
    kind = to_arrow_schema(_parse_datatype_string(schema))
    index = spark.read.schema("file int, block int, block_start bigint").parquet(f"{folder}/index")
    return (blocks.mapInArrow(run, schema).join(index, ["file", "block"])
            .withColumn("start", F.col("block_start") + F.col("in_block")).drop("file", "block", "block_start", "in_block"))


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_tokens, ids (uint32 little-endian), start of every document."""
    return _decoded(spark, folder, _blocks(spark, folder), None, "ids binary", lambda ids: {"ids": ids.tobytes()})


def fetch(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The rows of ``read`` for these documents only."""
    near = F.lit(False)
    for d in doc_ids:
        near = near | ((F.col("first_doc") <= d) & (F.col("last_doc") >= d))
    return _decoded(spark, folder, _blocks(spark, folder).where(near | F.col("first_doc").isNull()),
                    frozenset(doc_ids), "ids binary", lambda ids: {"ids": ids.tobytes()})


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    write(documents(spark, sf_dir), folder, path_of(VOCABULARY))
    return _decoded(spark, folder, _blocks(spark, folder), None, "ids_crc32 bigint",
                    lambda ids: {"ids_crc32": zlib.crc32(ids.tobytes())}).select(
        "doc_id", "start", "n_tokens", "ids_crc32")
