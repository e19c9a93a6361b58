"""Importance resampling towards a target by bit-sliced sums (operator 12).

Features are hashed into buckets; a bucket's gain tells how much more often it
stands in the target texts than in the documents, as a floored logarithm. A
document's weight is the floored mean gain of its features. The sum behind it
is exact and bit-sliced: the document's bucket counts are held as bit planes
(plane j has bit j of every bucket's count, one bit a bucket), the gains as
planes of their magnitudes, positive and negative ones apart. Each pair of
planes is ANDed, the set bits are counted, and the counts are added with their
power of two and sign.

Gumbel noise from a hash of doc_id makes the best scores a draw without
replacement. Ranks come from one range shuffle by score and doc_id: rows are
numbered within their range and ranges get offsets, so no task sees more than
its range, whatever is tied.

Every text is read whole. What reaches the driver is one row a bucket and one
a range. A null or empty text has no words, no features and weight 0. A row
without a doc_id has no score and is never drawn, nor counted among the
documents to draw from; repeated rows are counted and drawn each. Empty tables
give gains of an empty corpus and no rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.llm.common import read, shared
from racelens.llm.licences import words

BUCKETS = 10_000
SCALE = 1_000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25
CACHE = 500_000


class _Hashed(dict):
    """crc32 of each word, and the word with a blank before it; at most CACHE are kept."""

    def __missing__(self, word: bytes) -> tuple[int, bytes]:
        if len(self) > CACHE:
            self.clear()
        found = self[word] = (zlib.crc32(word), b" " + word)
        return found


def feature_buckets(text: str | None, hashed: _Hashed, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Words of a text, and the bucket of each of its one- and two-word features."""
    found = words(text or "")
    if not found:
        return 0, np.zeros(0, np.int64)
    single, spaced = zip(*map(hashed.__getitem__, found), strict=True)
    # the checksum of "a b" goes on from that of "a"
    double = map(zlib.crc32, spaced[1:], single)
    crc = np.concatenate([np.fromiter(single, np.int64, len(found)), np.fromiter(double, np.int64, len(found) - 1)])
    return len(found), crc % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts, a bucket each; tasks add up their own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, total = _Hashed(), np.zeros(buckets, np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                total += np.bincount(feature_buckets(text, hashed, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    counts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket at most
        out[r.bucket] = r.n
    return out


def gains(documents: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * ln((t + 1)(S + B) / ((s + 1)(T + B)))) of every bucket."""
    b = len(documents)
    all_s, all_t = float(documents.sum() + b), float(target.sum() + b)
    return np.array([math.floor(scale * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in zip(documents.tolist(), target.tolist(), strict=True)], np.int64)


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative numbers, lowest first: rows of 64-bit words."""
    bits = max(1, int(values.max(initial=0)).bit_length())
    rows = np.packbits((values >> np.arange(bits)[:, None] & 1).astype(np.uint8), axis=1)
    return np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8)))).view(np.uint64)


class GainPlanes:
    """Signed gains as bit planes, and exact sums over bucket counts."""

    def __init__(self, gain: np.ndarray):
        up, down = _planes(np.maximum(gain, 0)), _planes(np.maximum(-gain, 0))
        self.buckets = len(gain)
        self.planes = np.concatenate([up, down])
        self.weights = np.concatenate([1 << np.arange(len(up), dtype=np.int64), -(1 << np.arange(len(down), dtype=np.int64))])

    def total(self, found: np.ndarray) -> int:
        """Sum of the gains of a document's feature buckets."""
        if not len(found):
            return 0
        counts = _planes(np.bincount(found, minlength=self.buckets))
        return sum((int(np.bitwise_count(plane & self.planes).sum(axis=1, dtype=np.int64) @ self.weights)) << j for j, plane in enumerate(counts))


def noise(doc_id: int, seed: int = SEED, scale: int = SCALE) -> int:
    h = int(hashlib.sha256(b"%d:%d" % (seed, doc_id)).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def importance(documents: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced, hashed = GainPlanes(gain), _Hashed()
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                n, found = feature_buckets(text, hashed, len(gain))
                weight = sliced.total(found) // len(found) if len(found) else 0
                rows.append((doc_id, n, len(found), weight, None if doc_id is None else weight + noise(doc_id, seed)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def draw(spark: SparkSession, scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Adds rank: 1, 2, 3 ... for the drawn share of the rows with enough words, best scores first; null for all others."""
    scored = shared(spark, scored, "importance")
    fit = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the id holds the range and the place in it; written once, as range bounds are sampled
    ordered = scored.where(fit).repartitionByRange(ranges, F.desc("score"), "doc_id").sortWithinPartitions(F.desc("score"), "doc_id", "n_features")
    ordered = shared(spark, ordered.withColumn("at", F.monotonically_increasing_id()), "importance-order")
    ordered = ordered.withColumn("range", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND((1 << 33) - 1) + 1)
    sizes = sorted((r["range"], r["n"]) for r in ordered.groupBy("range").agg(F.count("*").alias("n")).collect())  # a row a range
    drawn = percent * sum(n for _, n in sizes) // 100
    offsets, before = [], 0
    for key, n in sizes:
        offsets.append((key, before))
        before += n
    offsets = spark.createDataFrame(offsets, "range long, offset long")
    rank = F.col("place") + F.col("offset")
    ranked = ordered.join(F.broadcast(offsets), "range").withColumn("rank", F.when(rank <= drawn, rank))
    rest = scored.where(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*scored.columns, "rank").unionByName(rest)


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    gain = gains(bucket_counts(documents), bucket_counts(read(spark, sf_dir, "benchmark")))
    return draw(spark, importance(documents, gain)).select("doc_id", "n_features", "weight", "score", "rank")
