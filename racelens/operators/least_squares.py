"""Least squares on every feature of T3, for all pairs and folds of the interpolation grid (M3).

Features of a pair (target, position): all splits up to the position but the
target, age and gender. They are taken as legs (differences of consecutive
splits), which span the same models and are far better conditioned than the
running times; the two legs around the target enter by their sum. The fit is
of the target's own leg, and the prediction adds the split before it.

One pass over the packed rows adds up one Gram matrix per (fold, count of
leading splits). A position's matrix is the sum of those with more leading
splits, cut to its legs; every target, and every fold by leaving its matrix
out, is solved from it in one batch per position. So a row is read once
however many pairs it belongs to, and what is shuffled are matrices: legs +
3 squared numbers per (fold, leading count) and task.

A feature that adds nothing to those before it (a constant one, or one too
many for the rows) gets weight 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelens.operators.blocks import leading_rows, packed, read_blocks
from racelens.operators.grid import N_FOLDS, Pair

FINAL = -1          # the fold name of the model of all rows; also its place, the last one
TOLERANCE = 1e-9    # share of a feature's own sum of squares that must be left of it


def centres(wide: DataFrame, splits: list[str]) -> tuple[float, float]:
    """Mean first leg and mean age: any shift gives the same fit, these keep the sums small (one row)."""
    r = wide.agg(F.avg(F.col(f"`{splits[0]}`").cast("double")), F.avg(F.col("age").cast("double"))).first()
    return float(r[0] or 0.0), float(r[1] or 0.0)


def pair_features(legs: Column, age: Column, gender: Column, t: Column, p: Column, centre: tuple[float, float]) -> Column:
    """Feature vector of a pair row: 1, age, gender, the legs but the two around the target, their sum."""
    leg, mid = F.lit(centre[0]), F.lit(centre[1])
    kept = F.concat(F.slice(legs, F.lit(1), t), F.slice(legs, t + 3, p - t - 1))
    both = F.get(legs, t) + F.get(legs, t + 1) - 2 * leg
    return F.concat(F.array(F.lit(1.0), age - mid, gender), F.transform(kept, lambda x: x - leg), F.array(both))


def _gram(batches: Iterator[pa.RecordBatch], n: int, centre: tuple[float, float]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for b in read_blocks(batches, n):
        group = b.fold * (n + 1) + b.lead            # rows of a (fold, lead) stand side by side
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for at, end in zip(starts, [*starts[1:], len(group)], strict=True):
            f, m = divmod(int(group[at]), n + 1)
            if m > 1:
                legs = np.nan_to_num(np.diff(b.v[:m, at:end], axis=0, prepend=0.0) - centre[0])
                part = np.vstack([np.ones(end - at), b.age[at:end] - centre[1], b.gender[at:end], legs])
                sums[f, m] = sums.get((f, m), 0) + part @ part.T
    yield _rows([(f, m, g) for (f, m), g in sorted(sums.items())])


_GRAM = "fold int, lead int, gram binary"
_MODEL = "pair_id int, fold int, n_train long, beta array<double>"


def _rows(found: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f for f, _, _ in found], pa.int32()), pa.array([m for _, m, _ in found], pa.int32()),
                                       pa.array([np.ascontiguousarray(g).tobytes() for _, _, g in found], pa.binary())], names=["fold", "lead", "gram"])


def _matrix(blob: bytes) -> np.ndarray:
    flat = np.frombuffer(blob)
    return flat.reshape(int(round(len(flat) ** 0.5)), -1)


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weights of a batch of normal equations by symmetric elimination; pivots below the tolerance are left out."""
    m = np.concatenate([a, b[:, :, None]], axis=2)
    own = np.einsum("kii->ki", a).copy()
    used = np.zeros(own.shape, bool)
    for j in range(a.shape[1]):
        pivot = m[:, j, j]
        use = (pivot > TOLERANCE * own[:, j]) & (own[:, j] > 0)
        row = m[:, j, :] / np.where(use, pivot, 1.0)[:, None]
        step = m[:, :, j, None] * row[:, None, :]
        step[:, j, :] = m[:, j, :] - row
        m = np.where(use[:, None, None], m - step, m)
        used[:, j] = use
    return np.where(used, m[:, :, -1], 0.0)


def fold_models(wide: DataFrame, splits: list[str], pairs: list[Pair], centre: tuple[float, float],
                row_key: str = "finisher_id") -> DataFrame:
    """(pair_id, fold, n_train, beta): for every pair and fold the model of the OTHER folds' complete rows,
    and under fold FINAL the model of all of them."""
    return models_of(packed(leading_rows(wide, splits, row_key), len(splits)), len(splits), pairs, centre)


def models_of(blocks: DataFrame, n: int, pairs: list[Pair], centre: tuple[float, float]) -> DataFrame:
    """``fold_models`` of packed rows, with ``n`` splits."""
    ids = {(p.t_idx, p.p_idx): p.pair_id for p in pairs}
    parts = blocks.mapInArrow(lambda b: _gram(b, n, centre), _GRAM)

    def add(key, table):
        grams = [_matrix(x) for x in table.column("gram").to_pylist()]
        return pa.Table.from_batches([_rows([(key[0].as_py(), key[1].as_py(), np.sum(grams, axis=0))])])

    sums = parts.groupBy("fold", "lead").applyInArrow(add, _GRAM)

    def position(key, table):
        p = key[0].as_py()
        folds = np.zeros((N_FOLDS, p + 4, p + 4))
        for f, x in zip(table.column("fold").to_pylist(), table.column("gram").to_pylist(), strict=True):
            folds[f] += _matrix(x)[: p + 4, : p + 4]
        whole = folds.sum(axis=0)
        rest = np.concatenate([whole - folds, whole[None]])
        names = [f for f in range(N_FOLDS) if folds[f, 0, 0] > 0 and rest[f, 0, 0] > 0] + [FINAL]
        out = []
        for t in range(p):
            # columns of this pair from the legs: all but the target's two, then their sum
            mix = np.zeros((p + 4, p + 3))
            kept = [0, 1, 2] + [3 + i for i in range(p + 1) if i not in (t, t + 1)]
            mix[kept, range(len(kept))] = 1
            mix[[3 + t, 4 + t], -1] = 1
            beta = solve(mix.T @ rest @ mix, rest[:, 3 + t] @ mix)
            out += [(ids[t, p], f, int(round(rest[f, 0, 0])), beta[f].tolist()) for f in names]
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())], strict=True)],
                        names=["pair_id", "fold", "n_train", "beta"])

    served = sums.select("fold", "gram", F.explode(F.sequence(F.lit(1), F.col("lead") - 1)).alias("position"))
    return served.groupBy("position").applyInArrow(position, _MODEL)


def predict(rows: DataFrame, models: DataFrame, centre: tuple[float, float], keys: list[str]) -> DataFrame:
    """Adds ``pred`` to the rows that have a model; rows carry ``z`` and ``base`` (the split before the target).
    The models are broadcast: their size is bounded by the grid, n(n-1)/2 x K rows."""
    dot = F.aggregate(F.zip_with("z", "beta", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return rows.join(F.broadcast(models), keys).withColumn("pred", F.col("base") + F.lit(centre[0]) + dot).drop("z")


def cv_predict(rows: DataFrame, models: DataFrame, centre: tuple[float, float]) -> DataFrame:
    """M3: out-of-fold predictions of all folds pooled."""
    return predict(rows, models, centre, ["pair_id", "fold"])
