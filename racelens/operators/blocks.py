"""Rows of the grid packed into blocks of columns.

What evaluates the grid reads its rows several times, and all of a row's
numbers each time. A block holds BLOCK_ROWS rows in one row of a few binary
columns, so that a reading hands bytes to the tasks and not every number by
itself. Rows stand by falling count of leading splits, then by fold; a split's
column ends with the last row that has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelens.functions.names import gender_code
from racelens.operators.grid import fold_of, prefix_complete_len
from racelens.session import scratch_path

BLOCK_ROWS = 50_000      # finishers of a block
BLOCK_COLUMNS = "n long, by_lead array<long>, sizes array<long>, fold binary, lead binary, age binary, gender binary, secs binary"
_SCHEMA = pa.schema([("n", pa.int64()), ("by_lead", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                     *[(c, pa.binary()) for c in ("fold", "lead", "age", "gender", "secs")]])


@dataclass
class Block:
    fold: np.ndarray
    lead: np.ndarray         # falling
    age: np.ndarray
    gender: np.ndarray
    v: np.ndarray            # splits x rows, NaN where a row has none


def _last_split(splits: list[str]):
    """Place of a row's last non-null split, from 1 (0: none)."""
    expr = F.lit(0)
    for i, s in enumerate(splits, start=1):
        expr = F.when(F.col(f"`{s}`").isNotNull(), F.lit(i)).otherwise(expr)
    return expr


def leading_rows(wide: DataFrame, splits: list[str], row_key: str = "finisher_id") -> DataFrame:
    """(fold, lead, age, gender, v) of every row that can be a complete case; v are its splits up to the last one it has."""
    v = F.slice(F.array(*[F.col(f"`{s}`").cast("double") for s in splits]), F.lit(1), _last_split(splits)) if splits \
        else F.array().cast("array<double>")
    return wide.select(fold_of(F.col(row_key)).alias("fold"), prefix_complete_len(splits).cast("int").alias("lead"),
                       F.col("age").cast("double").alias("age"), gender_code(F.col("gender")).cast("double").alias("gender"),
                       v.alias("v")).filter("age is not null and lead > 0")


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches, BLOCK_ROWS rows at a time (the last one fewer)."""
    held, n = [], 0
    for b in batches:
        while n + b.num_rows >= BLOCK_ROWS:
            yield pa.Table.from_batches([*held, b.slice(0, BLOCK_ROWS - n)])
            b = b.slice(BLOCK_ROWS - n)
            held, n = [], 0
        if b.num_rows:
            held.append(b)
            n += b.num_rows
    if n:
        yield pa.Table.from_batches(held)


def _pack(batches: Iterator[pa.RecordBatch], splits: int) -> Iterator[pa.RecordBatch]:
    for t in _held(batches):
        fold, lead, age, gender = (c.to_numpy() for c in t.columns[:4])
        order = np.lexsort((fold, -lead))
        lists = t.column("v").combine_chunks()
        length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(order)), length)
        at = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        v = np.full((splits, len(order)), np.nan)
        v[at, row] = lists.flatten().to_numpy(zero_copy_only=False)     # a null is a NaN
        v, length = v[:, order], length[order]
        sizes = [int(np.flatnonzero(length > i)[-1]) + 1 if (length > i).any() else 0 for i in range(splits)]
        yield pa.RecordBatch.from_pylist([{
            "n": len(order), "by_lead": np.bincount(lead, minlength=splits + 1).tolist(), "sizes": sizes,
            "fold": fold[order].astype(np.int8).tobytes(), "lead": lead[order].astype(np.int32).tobytes(),
            "age": age[order].astype(np.float64).tobytes(), "gender": gender[order].astype(np.float64).tobytes(),
            "secs": b"".join(v[i, :k].tobytes() for i, k in enumerate(sizes))}], _SCHEMA)


def packed(rows: DataFrame, splits: int) -> DataFrame:
    """Rows as ``leading_rows`` gives them, with so many splits, as blocks."""
    return rows.mapInArrow(lambda b: _pack(b, splits), BLOCK_COLUMNS)


def stored(blocks: DataFrame) -> DataFrame:
    path = scratch_path(blocks.sparkSession, "grid-blocks")
    blocks.write.parquet(path)
    return blocks.sparkSession.read.schema(blocks.schema).parquet(path)


def read_blocks(batches: Iterator[pa.RecordBatch], splits: int) -> Iterator[Block]:
    """The blocks of a task, their first ``splits`` splits."""
    for b in batches:
        for r in range(b.num_rows):
            col = {name: b.column(i)[r] for i, name in enumerate(b.schema.names)}
            n = col["n"].as_py()
            secs = np.frombuffer(col["secs"].as_buffer())
            v, at = np.full((splits, n), np.nan), 0
            for i, k in enumerate(col["sizes"].as_py()[:splits]):
                v[i, :k] = secs[at : at + k]
                at += k
            yield Block(np.frombuffer(col["fold"].as_buffer(), np.int8).astype(np.int64), np.frombuffer(col["lead"].as_buffer(), np.int32),
                        np.frombuffer(col["age"].as_buffer()), np.frombuffer(col["gender"].as_buffer()), v)


def leading_counts(blocks: DataFrame) -> DataFrame:
    """Rows by their count of leading splits: (_L, n)."""
    return (blocks.select(F.posexplode("by_lead").alias("_L", "n")).filter("n > 0").groupBy("_L").agg(F.sum("n").alias("n")))
