"""Error summaries (E1, E3, M4) of a whole grid without a row per pair and finisher.

``summaries`` reads the packed grid rows a few times and never expands them: a
task scores a block for one pair after the other and keeps sums per (pair,
fold) and counts of values per (pair, measure). Sums and counts are added up by
Spark, so what is shuffled is bounded by the grid and the bins, not by the rows.

1. n, sums, least and largest error; counts per bin of the values' first bits
   (errors are not negative, so the bits of a double sort as its value does);
2. sums of deviations from the means; counts of the rest of the bits, of the
   values in bins that hold a wanted order statistic alone. A bin with more
   than ``MAX_BIN`` values is cut into bins once more before.

The last counts are of whole values: the order statistics are exact, equal
values are one row, and the quantiles interpolate between them at (n-1)p as
Spark's ``percentile`` does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from racelens.operators.evaluate import ERROR_PERCENTILES, REL_EPS
from racelens.operators.blocks import read_blocks
from racelens.operators.grid import Pair
from racelens.session import scratch_path

FIRST_SHIFT, NEXT_SHIFT = 44, 22     # bits left out of the first and the second bins
MAX_BIN = 1_000_000                  # values of a bin that are counted one by one
MERGE_AFTER = 16                     # blocks whose counts a task keeps apart
MEASURES = {0: ERROR_PERCENTILES, 1: (0.5, 0.95)}    # of the error and of the relative error (%)

# (values, lead, age, gender, fold) of a block, most leading splits first -> (pair_id, rows' folds, y, pred) for every pair
Score = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]

_PART = "pair_id int, part int, bin long, n long, sums array<double>"
_SCHEMA = pa.schema([("pair_id", pa.int32()), ("part", pa.int32()), ("bin", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.float64()))])


def least_squares_score(pairs: list[Pair], models: dict[tuple[int, int], np.ndarray], centre: tuple[float, float], folds: int) -> Score:
    """Out-of-fold predictions of the interpolation grid: ``models`` are the weights of every (pair, fold), as in ``least_squares``."""
    grid = []
    for p in pairs:
        have = np.array([(p.pair_id, f) in models for f in range(folds)])
        if have.any():
            beta = np.array([models.get((p.pair_id, f), np.zeros(p.p_idx + 3)) for f in range(folds)])
            grid.append((p.pair_id, p.t_idx, p.p_idx, have, beta))
    leg, mid = centre

    def score(v, lead, age, gender, fold):
        legs = np.diff(v, axis=0, prepend=0.0)
        for pair_id, t, p, have, beta in grid:
            at = slice(0, np.searchsorted(-lead, -p))     # rows with more than p leading splits come first
            if not have.all():
                at = np.flatnonzero(have[fold[at]])
            f = fold[at]
            if not len(f):
                continue
            z = [age[at] - mid, gender[at], *[legs[i, at] - leg for i in range(p + 1) if i not in (t, t + 1)],
                 legs[t, at] + legs[t + 1, at] - 2 * leg]
            dot = beta[f, 0]
            for j, x in enumerate(z, start=1):
                dot = dot + x * beta[f, j]
            yield pair_id, f, v[t, at], ((v[t - 1, at] if t else 0.0) + leg) + dot
    return score


def line_score(pairs: list[Pair], lines: dict[int, tuple[float, float]]) -> Score:
    """Predictions of the prediction grid by each pair's (slope, intercept) on the last split of its prefix."""
    def score(v, lead, age, gender, fold):
        for p in pairs:
            if p.pair_id in lines:
                slope, intercept = lines[p.pair_id]
                at = np.flatnonzero((lead > p.p_idx) & ~np.isnan(v[p.t_idx]))
                if len(at):
                    yield p.pair_id, fold[at], v[p.t_idx, at], intercept + slope * v[p.p_idx, at]
    return score


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    bins, place = np.unique(np.concatenate([b for b, _ in parts]), return_inverse=True)
    n = np.zeros(len(bins), np.int64)
    np.add.at(n, place, np.concatenate([c for _, c in parts]))
    return bins, n


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    least = key.min()
    if (span := int(key.max() - least) + 1) > 4 * len(key):
        return np.unique(key, return_counts=True)
    n = np.bincount(key - least, minlength=span)
    found = np.flatnonzero(n)
    return found + least, n[found]


def _pass(blocks: DataFrame, splits: int, score: Score, shift: int, held: dict[tuple[int, int], np.ndarray] | None, held_shift: int,
          means: dict[int, tuple[float, float]] | None) -> DataFrame:
    """One reading of the blocks: sums (with a null bin) and the counts per bin, one row each and task, stored.

    ``held`` are the bins whose values count (None: all); ``means`` are the pairs' means of y and of the error (None: first reading)."""
    def run(batches):
        sums: dict[tuple[int, int], list] = {}
        counts: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for b in read_blocks(batches, splits):
            for pair_id, fold, y, pred in score(b.v, b.lead, b.age, b.gender, b.fold):
                e = y - pred
                ae, rel = np.abs(e), np.abs(e / (y + REL_EPS)) * 100
                if means is None:
                    measured = [y, ae, e * e, rel]
                    n, of_fold = np.bincount(fold), np.array([np.bincount(fold, x) for x in measured])
                    most, least = ae.max(), ae.min()      # of the pair, with each of its folds
                    for f in np.flatnonzero(n):
                        s = sums.setdefault((pair_id, int(f)), [0, np.zeros(4), -np.inf, np.inf])
                        s[0] += int(n[f])
                        s[1] += of_fold[:, f]
                        s[2], s[3] = max(s[2], most), min(s[3], least)
                elif pair_id in means:
                    my, ma = means[pair_id]
                    s = sums.setdefault((pair_id, 0), [0, np.zeros(3)])
                    s[0] += len(y)
                    s[1] += [np.abs(y - my).sum(), np.square(y - my).sum(), np.square(ae - ma).sum()]
                for part, x in ((0, ae), (1, rel)):
                    key = np.ascontiguousarray(x).view(np.int64)
                    if held is not None:
                        want = held.get((pair_id, part))
                        if want is None:
                            continue
                        bins = key >> held_shift
                        key = key[want[np.minimum(np.searchsorted(want, bins), len(want) - 1)] == bins]
                    if len(key):
                        kept = counts.setdefault((pair_id, part), [])
                        kept.append(_counted(key >> shift))
                        if len(kept) >= MERGE_AFTER:
                            kept[:] = [_merged(kept)]
        keys = sorted(sums)
        found = [[s[0], [*s[1], *s[2:]]] for s in map(sums.get, keys)]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                                          pa.nulls(len(keys), pa.int64()), pa.array([n for n, _ in found], pa.int64()),
                                          pa.array([[float(x) for x in s] for _, s in found], pa.list_(pa.float64()))], schema=_SCHEMA)
        for (pair_id, part), kept in sorted(counts.items()):
            bins, n = _merged(kept)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bins), pair_id, np.int32)), pa.array(np.full(len(bins), part, np.int32)),
                                              pa.array(bins), pa.array(n.astype(np.int64)), pa.nulls(len(bins), pa.list_(pa.float64()))], schema=_SCHEMA)

    path = scratch_path(blocks.sparkSession, "grid-errors")
    blocks.mapInArrow(run, _PART).write.parquet(path)
    return blocks.sparkSession.read.schema(_PART).parquet(path)


def _sums(parts: DataFrame, keys: list[str], added: int, ends: bool = False) -> list:
    """Sums per key, collected: a row per pair (and fold)."""
    at = lambda i: F.col("sums")[i]
    aggs = [F.sum("n").alias("n"), *[F.sum(at(i)).alias(f"s{i}") for i in range(added)]]
    if ends:
        aggs += [F.max(at(added)).alias("most"), F.min(at(added + 1)).alias("least")]
    return parts.filter("bin is null").groupBy(*keys).agg(*aggs).collect()


def _located(parts: DataFrame, wanted: dict[tuple[int, int, int], tuple[int, int]], up: int) -> dict[tuple[int, int, int], tuple[int, int, int]]:
    """For every wanted (pair, measure, rank), known to lie in a bin with so many values below: its finer bin,
    the values below that, and in it. ``up`` leads from a finer bin to its bin (one row per wanted rank is collected)."""
    spark = parts.sparkSession
    ranks = spark.createDataFrame([(*k, *v) for k, v in wanted.items()], "pair_id int, part int, rank long, held long, below long")
    held = F.shiftright("bin", up) if up < 64 else F.lit(0).cast("long")
    bins = parts.filter("bin is not null").groupBy("pair_id", "part", held.alias("held"), "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("pair_id", "part", "held").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("upto", F.sum("n").over(w))
    found = bins.join(F.broadcast(ranks), ["pair_id", "part", "held"]).filter(
        (F.col("rank") >= F.col("below") + F.col("upto") - F.col("n")) & (F.col("rank") < F.col("below") + F.col("upto")))
    return {(r["pair_id"], r["part"], r["rank"]): (r["bin"], r["below"] + r["upto"] - r["n"], r["n"]) for r in found.collect()}


def summaries(blocks: DataFrame, splits: int, score: Score) -> tuple[DataFrame, DataFrame]:
    """Of every scored pair of packed rows with so many splits: what ``evaluate.summaries`` gives, and (pair_id, mae_folds_mean, mae_folds_std, k) of M4."""
    spark = blocks.sparkSession
    first = _pass(blocks, splits, score, FIRST_SHIFT, None, 64, None)
    per_fold: dict[int, list] = {}
    for r in _sums(first, ["pair_id", "part"], 4, ends=True):
        per_fold.setdefault(r["pair_id"], []).append(r)
    n = {p: sum(r["n"] for r in f) for p, f in per_fold.items()}
    total = {p: [sum(r[f"s{i}"] for r in f) / n[p] for i in range(4)] for p, f in per_fold.items()}

    ranks = {(p, part, j): (int(np.floor((n[p] - 1) * q)), (n[p] - 1) * q) for p in n for part, probs in MEASURES.items() for j, q in enumerate(probs)}
    wanted = {(p, part, k): (0, 0) for (p, part, _), (low, _) in ranks.items() for k in (low, min(low + 1, n[p] - 1))}
    place = _located(first, wanted, 64)
    shift, spread = FIRST_SHIFT, None
    while shift:
        finer = 0 if shift == NEXT_SHIFT or max((c for _, _, c in place.values()), default=0) <= MAX_BIN else NEXT_SHIFT
        held: dict[tuple[int, int], np.ndarray] = {}
        for (p, part, _), (b, _, _) in place.items():
            held.setdefault((p, part), []).append(b)
        held = {k: np.unique(np.array(b, np.int64)) for k, b in held.items()}
        means = {p: (t[0], t[1]) for p, t in total.items()} if spread is None else {}
        parts = _pass(blocks, splits, score, finer, held, shift, means) if place else first
        if spread is None:
            spread = {r["pair_id"]: [r[f"s{i}"] / r["n"] for i in range(3)] for r in _sums(parts, ["pair_id"], 3)}
        place = _located(parts, {k: (b, below) for k, (b, below, _) in place.items()}, shift - finer)
        shift = finer

    value = {k: float(np.array([b], np.int64).view(np.float64)[0]) for k, (b, _, _) in place.items()}

    def quantile(p: int, part: int, j: int) -> float:
        low, at = ranks[p, part, j]
        a, b = value[p, part, low], value[p, part, min(low + 1, n[p] - 1)]
        return a if a == b else a + (at - low) * (b - a)

    out, folds = [], []
    for p, by_fold in sorted(per_fold.items()):
        _, mae, mse, mape = total[p]
        naive, var_y, var_ae = spread[p]
        out.append((p, n[p], mae, naive, float(mse ** 0.5), 1 - mse / var_y if var_y > 0 else None, max(r["most"] for r in by_fold),
                    min(r["least"] for r in by_fold), float(var_ae ** 0.5), mape, *[[quantile(p, part, j) for j in range(len(probs))] for part, probs in MEASURES.items()]))
        mean = [r["s1"] / r["n"] for r in by_fold]
        folds.append((p, float(np.mean(mean)), float(np.std(mean)), len(mean)))
    return (spark.createDataFrame(out, "pair_id int, n long, mae double, mae_naive double, rmse double, r2 double, max_error double, "
                                       "min_error double, std_error double, mape double, errors array<double>, relative array<double>"),
            spark.createDataFrame(folds, "pair_id int, mae_folds_mean double, mae_folds_std double, k long"))
