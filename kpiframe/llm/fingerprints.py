"""Document fingerprints of statistically improbable features.

A feature is a window of ``WINDOW`` bytes. Its entropy, in thousandths of the
most it can have, gives its rarity: the further from what windows of running
text have (``TYPICAL``), the rarer; windows of almost one byte are never
chosen. Within every ``SPAN`` neighbouring windows the rarest, leftmost first,
gets a vote, and windows with ``VOTES`` votes are the document's features. Texts
too short to hold several such windows are described by narrower ones
(``NARROW``), by their bytes: under 64 windows of 4 bytes, from 32 to 511 windows
of 8, from 256 on windows of ``WINDOW``. The ranges overlap twofold, so that a
text and its edited text have windows of one width in common. Each feature
sets five bits of a Bloom filter of ``FILTER_BITS``; a filter that has
``FILTER_FEATURES`` features is closed and the next one chained to it.

Two fingerprints are compared filter by filter: the bits two filters share,
less what chance would give, over the most they could share; every filter of
the shorter chain counts with its best partner, and the mean is the likeness.

A fingerprint is text: per filter its feature count, a colon and its bits in
base64, filters joined by a dot. Equal texts have equal fingerprints.

``neighbours`` gives every document its next one in descending doc_id. Quantiles
of doc_id, and of the texts' hashes where many rows share one id or have none,
cut the documents into buckets; the first document of each bucket is
copied to the end of the one before, so a bucket holds all that its documents
need, texts are shuffled once, and no order is made in one task.

Defined cases: null text is an empty text with an empty fingerprint, alike only
to empty ones; texts shorter than the narrowest window are one feature, padded
with zeros; texts without a chosen window use their rarest; a null doc_id comes last in
the order; rows with equal ids are ordered by their texts; a single document is
its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, materialise

WINDOW = 64
SPAN = 64
VOTES = 16
TYPICAL = 660
WEAKEST = 100
FILTER_BITS = 2048
FILTER_FEATURES = 160
CHANCE = 0.3
PIECE = 1 << 20
#: width, span, votes, typical entropy; bytes of a text from and below which it is used.
NARROW = ((4, 1, 1, 900, 0, 64), (8, 8, 2, 900, 32, 512))
#: Texts of fewer bytes have no features of ``WINDOW``.
LONG = 256

_N = np.arange(WINDOW + 1)
#: n log2 n in 2**-20 bits, so that sums are exact however they are ordered.
_NLOGN = np.r_[0, np.rint(_N[1:] * np.log2(_N[1:]) * 2**20)].astype(np.int64)
_MIX = (np.arange(1, WINDOW // 8 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def rarities(data: np.ndarray, window: int = WINDOW, typical: int = TYPICAL) -> np.ndarray:
    """For each window of the bytes, how common it is: the rarest are lowest."""
    n = len(data) - window + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    if n > PIECE:
        return np.concatenate([rarities(data[at:at + PIECE + window - 1], window, typical) for at in range(0, n, PIECE)])
    # places of each byte value, in order; how many of it lie within a window
    order = np.argsort(data, kind="stable")
    key = data[order].astype(np.int64) * (2 * len(data) + 2 * window) + order
    ahead = np.empty(len(data), np.int64)  # occurrences of data[i] in data[i:i + window]
    ahead[order] = np.searchsorted(key, key + window) - np.arange(len(data))
    behind = np.empty(len(data), np.int64)  # in data[i - window + 1:i + 1]
    behind[order] = np.arange(len(data)) - np.searchsorted(key, key - window + 1) + 1
    start = _NLOGN[np.bincount(data[:window], minlength=256)].sum()
    # the leaving byte is taken off first, then the entering one is counted
    leaving, entering = ahead[:n - 1], behind[window:]
    change = _NLOGN[leaving - 1] - _NLOGN[leaving] + _NLOGN[entering] - _NLOGN[entering - 1]
    total = np.cumsum(np.r_[start, change])
    entropy = np.rint((np.log2(window) - total / 2**20 / window) / np.log2(window) * 1000).astype(np.int32)
    return np.where(entropy < WEAKEST, 2000, 1000 - np.abs(entropy - typical)).astype(np.int32)


def chosen(rank: np.ndarray, span: int = SPAN, votes_needed: int = VOTES) -> np.ndarray:
    """Places of the windows with enough votes; the rarest if none has them."""
    n = len(rank)
    if not n:
        return np.zeros(0, np.int64)
    least = rank.astype(np.int64) * (n + 1) + np.arange(n)
    if n > span:
        wide = 1
        while wide < span:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
    else:
        least = np.full(1, least.min())
    winners = least % (n + 1)
    winners = winners[rank[winners] < 2000]
    places, votes = np.unique(winners, return_counts=True)
    strong = places[votes >= votes_needed]
    return strong if len(strong) else places[:1]


def digest(data: bytes, rank: np.ndarray) -> str:
    """The fingerprint of a text's bytes with the rarities of its windows."""
    if not data:
        return ""
    features = []
    for width, span, votes, typical, least, below in NARROW:
        if least <= len(data) < below:
            raw = np.frombuffer(data.ljust(width, b"\0"), np.uint8)
            places = chosen(rarities(raw, width, typical), span, votes)
            # padded to the wide windows' size; the width keeps features of two widths apart
            narrow = np.zeros((max(1, len(places)), WINDOW), np.uint8)
            narrow[:, :width] = np.lib.stride_tricks.sliding_window_view(raw, width)[places if len(places) else [0]]
            narrow[:, -1] = width
            features.append(narrow)
    if len(data) >= LONG:
        places = chosen(rank)
        raw = np.frombuffer(data, np.uint8)
        features.append(np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[places if len(places) else [0]])
    parts = np.ascontiguousarray(np.concatenate(features)).view("<u8")
    mixed = parts.copy()
    mixed ^= mixed >> np.uint64(32)
    mixed = (mixed * _MIX).sum(axis=1, dtype=np.uint64)
    for _ in range(2):
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    bits = (mixed[:, None] >> (np.arange(5, dtype=np.uint64) * np.uint64(11))) & np.uint64(FILTER_BITS - 1)
    chain = []
    for first in range(0, len(parts), FILTER_FEATURES):
        filled = np.zeros(FILTER_BITS, bool)
        filled[bits[first:first + FILTER_FEATURES].ravel().astype(np.int64)] = True
        count = min(FILTER_FEATURES, len(parts) - first)
        chain.append(f"{count}:{base64.b64encode(np.packbits(filled).tobytes()).decode()}")
    return ".".join(chain)


def fingerprint(text: str | None) -> str:
    data = (text or "").encode("utf-8", "surrogatepass")
    return digest(data, rarities(np.frombuffer(data, np.uint8)))


def _filters(print_: str) -> np.ndarray:
    chain = [base64.b64decode(f.split(":")[1]) for f in print_.split(".")]
    return np.unpackbits(np.frombuffer(b"".join(chain), np.uint8).reshape(len(chain), -1), axis=1).astype(np.float32)


def likeness(one: str, two: str) -> float:
    """0 (no more alike than by chance) to 1, symmetric."""
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    a, b = sorted((_filters(one), _filters(two)), key=lambda f: (len(f), f.tobytes()))
    shared = a @ b.T
    fa, fb = a.sum(axis=1)[:, None], b.sum(axis=1)[None, :]
    most, chance = np.minimum(fa, fb), fa * fb / FILTER_BITS
    cutoff = chance + CHANCE * (most - chance)
    return float(np.clip((shared - cutoff) / np.maximum(most - cutoff, 1e-9), 0, 1).max(axis=1).mean())


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the next text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _described(rows):
    """Rows in order, the last of each bucket a copy, to result rows."""
    def ranks(data: bytes) -> np.ndarray:
        return rarities(np.frombuffer(data, np.uint8))

    ahead = None
    for bucket, copy, doc_id, text in rows:
        text = text or ""
        data = text.encode("utf-8", "surrogatepass")
        rank = ranks(data)
        now = (bucket, doc_id, text, data, rank, digest(data, rank))
        if ahead is not None and ahead[0] == bucket:
            yield _row(ahead, now)
        ahead = None if copy else now


def _row(one, following) -> dict:
    _, doc_id, text, data, rank, print_ = one
    _, _, next_text, _, next_rank, next_print = following
    new = edited(text, next_text)
    new_data = new.encode("utf-8", "surrogatepass")
    head = len(text[:len(text) - len(text) // 3].encode("utf-8", "surrogatepass"))
    # windows within the head or within the piece put in are known already
    left = rank[:max(0, head - WINDOW + 1)]
    right = next_rank[:max(0, len(new_data) - head - WINDOW + 1)]
    middle = np.frombuffer(new_data, np.uint8)[len(left):len(new_data) - len(right)]
    new_rank = np.concatenate([left, rarities(middle), right])
    new_print = digest(new_data, new_rank[:max(0, len(new_data) - WINDOW + 1)])
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(new_data).hexdigest(),
            "fingerprint": print_, "edited_fingerprint": new_print,
            "near_edited": likeness(print_, new_print), "near_next": likeness(print_, next_print)}


def _cuts(rows: DataFrame, parts: int) -> list[tuple[int, int]]:
    """Upper bounds (place, tie) of about equal buckets, ascending. A place
    that several quantiles fall on, which rows with one doc_id or none share, is
    cut at quantiles of its own ties."""
    grid = [k / parts for k in range(1, parts)]
    many = Counter(rows.select(F.percentile_approx("place", grid, 10_000)).first()[0] or [])
    hot = [p for p, times in many.items() if times > 1]
    cuts = {(p, 2**63 - 1) for p in many}
    if hot:
        for r in rows.where(F.col("place").isin(hot)).groupBy("place").agg(
                F.percentile_approx("tie", grid, 10_000).alias("ties")).collect():
            times = many[r["place"]]
            cuts |= {(r["place"], r["ties"][k * len(grid) // (times + 1)]) for k in range(1, times + 1)}
    return sorted(cuts)


def neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, its edited text and its next document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    rows = docs.select(F.col("doc_id").cast("long"), "text", place.alias("place"))
    order = F.xxhash64("text")
    cuts = _cuts(rows.select("place", order.alias("tie")), parts) if parts > 1 else []
    # buckets descend: 0 holds the largest ids
    bucket = F.lit(len(cuts)) - F.coalesce(F.array_size(F.filter(
        F.array(*[F.struct(F.lit(p).alias("place"), F.lit(t).alias("tie")) for p, t in cuts])
        .cast("array<struct<place:bigint,tie:bigint>>"), lambda c: c < F.struct(F.col("place"), order.alias("tie")))), F.lit(0))
    rows = rows.withColumn("bucket", bucket)
    lead = materialise(rows.select("bucket", "place", order.alias("tie")).groupBy("bucket").agg(
        F.max(F.struct("place", "tie")).alias("lead")))
    starts = {r["bucket"]: (r["lead"]["place"], r["lead"]["tie"]) for r in lead.collect()}
    filled = sorted(starts)
    before = {b: filled[k - 1] for k, b in enumerate(filled)}  # the first bucket follows the last
    firsts = spark.createDataFrame(
        [(b, before[b], *starts[b]) for b in filled], "bucket int, goes_to int, place bigint, tie bigint")
    copies = (rows.withColumn("tie", order).join(F.broadcast(firsts), ["bucket", "place", "tie"])
              .dropDuplicates(["bucket"]).select("doc_id", "text", "place", "tie", F.col("goes_to").alias("bucket"),
                                                 F.lit(True).alias("copy")))
    every = rows.select("doc_id", "text", "place", order.alias("tie"), "bucket", F.lit(False).alias("copy")).unionByName(copies)

    def run(batches):
        found = []
        for row in _described(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))):
            found.append(row)
            if len(found) >= 500:
                yield pa.RecordBatch.from_pylist(found, schema=kind)
                found = []
        yield pa.RecordBatch.from_pylist(found, schema=kind)

    kind = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                      ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                      ("near_edited", pa.float64()), ("near_next", pa.float64())])
    return (every.repartitionByRange(max(parts, len(cuts) + 1), "bucket")
            .sortWithinPartitions("bucket", "copy", F.desc("place"), F.desc("tie"))
            .select("bucket", "copy", "doc_id", "text").mapInArrow(
                run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                     "edited_fingerprint string, near_edited double, near_next double"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(documents(spark, sf_dir))
