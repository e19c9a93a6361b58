"""Toxicity by compression distance (operator 8).

Two zstandard dictionaries are trained, one on windows of ordinary text and
one on windows of toxic text. A window is a word with blanks around it; the
difference of its compressed lengths behind the ordinary dictionary and behind
both is its gain, positive where the toxic one explains it better. A window
holds its word several times: both sides then take the compressed form, and
the gain is what the first occurrence costs. Training is done in two rounds: the first toxic dictionary sees all
windows of toxic texts; windows that are found in toxic texts far more often
than in ordinary ones (LIFT) train the second. The test beside it, that the
first round gives no negative gain, leaves out next to none, so in effect the
classifier is a list of words picked by label lift, and the compressed length
says whether a word is in it. README has the figures of separate dictionaries
on windows of several words, which do not tell the labels apart here.

The score of a text comes from the number of its distinct windows whose gain
reaches a threshold, against the number of all, by a logistic curve. Threshold and curve
are calibrated on the training rows. Only texts are inputs.

The fit reads at most SAMPLE labelled rows (chosen by a hash of doc_id, the
held-out fifth never among them) and of each at most WORDS distinct windows;
the first two dictionaries are trained on SAMPLE_BYTES of each side, about a
hundred times their size, as the trainer advises.
Every text is scored whole. Null and empty texts have no windows and get the
curve's value there. Without rows of both labels the score is the share of
toxic rows (0 without any).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.llm.common import read

SAMPLE = 20_000
WORDS = 3_000
SAMPLE_BYTES = 12_000_000
ORDINARY_BYTES, TOXIC_BYTES = 112_640, 8_192
TIMES = 2
LEVEL = 19
LIFT = 4.0
CACHE = 500_000
TOKENS = re.compile(rb"[0-9a-z\x80-\xff]+")


def windows(text: str | None) -> list[bytes]:
    """Words of a whole text: runs of letters and digits, A-Z lower-cased, other alphabets as they are."""
    return TOKENS.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _window(word: bytes) -> bytes:
    return b" " + (word + b" ") * TIMES


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    try:
        return zstd.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-size:]


class Compressor:
    """Compressed lengths behind the content of dictionaries, without headers.

    The content alone is used, not the dictionary's literal statistics: these
    differ by sample and would shift the lengths of words that are in neither.
    """

    def __init__(self, content: bytes):
        params = zstd.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstd.FORMAT_ZSTD1_MAGICLESS)
        given = {}
        if len(content) >= 8:
            given["dict_data"] = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            given["dict_data"].precompute_compress(compression_params=params)
        self.compress = zstd.ZstdCompressor(compression_params=params, **given).compress


class Model:
    """Dictionaries, threshold and curve; small enough to go with the tasks."""

    def __init__(self, ordinary: bytes, toxic: bytes, threshold: int = 1, weights: tuple = (0.0, 0.0, 0.0)):
        self.ordinary, self.toxic, self.threshold, self.weights = ordinary, toxic, threshold, weights

    def gains(self) -> _Gains:
        return _Gains(Compressor(self.ordinary).compress, Compressor(self.ordinary + self.toxic).compress)

    def score(self, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        a, b, c = self.weights
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(counts) + c * np.log1p(sizes), -30, 30)))


class _Gains(dict):
    """Gain of each word window, computed at its first use; at most CACHE are kept."""

    def __init__(self, ordinary, toxic):
        super().__init__()
        self.ordinary, self.toxic = ordinary, toxic

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        w = _window(word)
        gain = self[word] = len(self.ordinary(w)) - len(self.toxic(w))
        return gain

    def features(self, distinct: Collection[bytes], threshold: int) -> tuple[int, int]:
        """Distinct windows at or over the threshold, and all distinct windows."""
        return sum(g >= threshold for g in map(self.__getitem__, distinct)), len(distinct)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by Newton steps with a small ridge; x has a column of ones."""
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
    return w


def _samples_of(texts: list[bytes]) -> list[bytes]:
    """Windows of 24 words to train a dictionary on, SAMPLE_BYTES of them at most."""
    out, size = [], 0
    for text in texts:
        if size >= SAMPLE_BYTES:
            break
        t = text.split()
        out += [b" " + b" ".join(t[i : i + 24]) + b" " for i in range(0, len(t), 24)]
        size += len(text)
    return out


def fit(texts: list[bytes], labels: np.ndarray) -> Model:
    """A model from the windows of training texts (distinct ones, blank-separated) and their labels (0, 1).

    A text is split when it is looked at, so that only one is held as words."""
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1:
        return Model(b"", b"", 1, (30.0 if share else -30.0, 0.0, 0.0))
    sides = [[t for t, y in zip(texts, labels, strict=True) if y == side] for side in (0, 1)]
    model = Model(_dictionary(_samples_of(sides[0]), ORDINARY_BYTES), _dictionary(_samples_of(sides[1]), ORDINARY_BYTES // 4))
    gains = model.gains()
    found: list[dict[bytes, int]] = [{}, {}]
    for side in (1, 0):
        for t in sides[side]:
            for w in t.split():
                if side or w in found[1]:  # words of ordinary texts alone are never picked
                    found[side][w] = found[side].get(w, 0) + 1
    n0, n1 = map(len, sides)
    kept = []
    for w, k in found[1].items():
        other = found[0].get(w, 0)
        p = (k + other) / (n0 + n1)
        lift = (k / n1 - other / n0) / np.sqrt(p * (1 - p) * (1 / n0 + 1 / n1) + 1e-12)
        if lift >= LIFT and k >= 3 and k / n1 > 2 * other / n0 and gains[w] >= 0:
            kept.append((lift, w, k))
    kept.sort(key=lambda x: (-x[0], x[1]))
    rare = [_window(w) for _, w, k in kept for _ in range(min(k, 50))]
    model.toxic = _dictionary(rare, TOXIC_BYTES) if rare else b""
    gains = model.gains()
    levels = range(1, 13)
    reached = np.zeros((len(texts), len(levels) + 1))
    for row, t in zip(reached, texts, strict=True):
        values = np.fromiter(map(gains.__getitem__, t.split()), np.int64)
        row[:-1], row[-1] = [(values >= threshold).sum() for threshold in levels], len(values)
    best = None
    for i, threshold in enumerate(levels):
        x = np.column_stack([np.ones(len(texts)), np.log1p(reached[:, [i, -1]])])
        w = _logistic(x, labels)
        p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-6, 1 - 1e-6)
        loss = -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()
        if best is None or loss < best[0] - 1e-9:
            best = (loss, threshold, tuple(map(float, w)))
    model.threshold, model.weights = best[1], best[2]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text in b.column(0).to_pylist():
            distinct = sorted(set(windows(text)), key=hash_of)[:WORDS]
            out.append(b" ".join(distinct))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), b.column(1)], names=["words", "toxic"])


def hash_of(word: bytes) -> int:
    return zlib.crc32(word)


def train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fits on a bounded sample of labelled rows that are not held out."""
    marked = labels.where("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("double").alias("toxic"))
    # the sample is chosen by id before any text is read
    chosen = marked.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most SAMPLE rows of two numbers: a proven bound
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic").mapInArrow(_samples, "words binary, toxic double").toArrow()
    rows = sorted(set(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)))  # copies count once
    return fit([w for w, _ in rows], np.array([y for _, y in rows]))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    ordinary, toxic, threshold, weights = model.ordinary, model.toxic, model.threshold, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(ordinary, toxic, threshold, weights)
        gains = own.gains()
        for b in batches:
            x = np.array([gains.features(set(windows(t)), threshold) for t in b.column(1).to_pylist()], float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own.score(x[:, 0], x[:, 1]))], names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = score(docs, train(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
