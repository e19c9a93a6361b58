"""Vector tables: valid rows, classes of equal vectors, bounded training samples, k-means."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000


def usable(embedding: str) -> Column:
    """True for a vector without null or non-finite components that is not empty and not zero."""
    x = F.col(embedding)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & ~odd & F.exists(x, lambda v: v != 0), F.lit(False))


def with_common_length(df: DataFrame, embedding: str) -> DataFrame:
    """The rows whose vectors have the length that most of them have (ties: the smaller)."""
    sizes = df.groupBy(F.size(embedding).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return df.where(F.size(embedding) == (sizes[0].d if sizes else 0))


def packed(df: DataFrame, embedding: str) -> str:
    """numpy type that holds the components of an array column without loss."""
    return "f4" if dict(df.dtypes)[embedding] == "array<float>" else "f8"


def sample(df: DataFrame, id_column: str, vector: str, limit: int = SAMPLE) -> np.ndarray:
    """At most `limit` vectors, chosen by a hash of their ids: the training sample of an index."""
    rows = df.select(vector, F.xxhash64(id_column).alias("h"), id_column).orderBy("h", id_column).limit(limit).toArrow()
    return matrix(rows.column(0).combine_chunks())


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column of vectors of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of every row (ties: the smaller index)."""
    half = (centres**2).sum(axis=1) / 2
    return np.concatenate([np.argmin(half - x[s : s + 4096] @ centres.T, axis=1) for s in range(0, len(x), 4096)]) if len(x) else np.empty(0, int)


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Lloyd's k-means from k rows drawn with a fixed seed; empty clusters keep their centre."""
    k = max(1, min(k, len(x)))
    centres = x[np.sort(np.random.default_rng(seed).choice(len(x), k, replace=False))].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Consecutive rows with equal first `keys` columns, of batches sorted by them."""
    key, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield rows
                key, rows = row[:keys], []
            rows.append(row)
    if rows:
        yield rows


def blocks(rows: Column | str, size: int) -> Column:
    return F.ceil(F.col(rows) / size).cast("int") if isinstance(rows, str) else F.ceil(rows / size).cast("int")
