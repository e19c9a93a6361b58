"""The grid's error summaries without expanded rows: the same numbers as over the expanded ones."""

import random

from racelens.operators import evaluate as E
from racelens.operators import grid_errors as GE
from racelens.operators import models as M
from racelens.operators.training import InterpolationRun, PredictionRun


def _wide(spark, n=900):
    rnd = random.Random(4)
    rows = []
    for i in range(n):
        legs = [1000.0 + (rnd.gauss(0, 60) if i % 3 else 0.0) for _ in range(1 + i % 4)]     # a third of the rows are equal
        secs = [sum(legs[:k + 1]) if k < len(legs) else None for k in range(4)]
        rows.append((i, f"a{i % 97}", None if i % 11 == 0 else "M" if i % 2 else "female", None if i % 13 == 0 else 20 + i % 40, *secs))
    return spark.createDataFrame(rows, "finisher_id long, athlete_id string, gender string, age int, "
                                       "km_5 double, km_10 double, km_15 double, km_20 double")


def _same(got, want):
    got, want = ({r["pair_id"]: r.asDict() for r in df.collect()} for df in (got, want))
    assert set(got) == set(want) and got
    for p, w in want.items():
        for c, x in w.items():
            pairs = zip(got[p][c], x, strict=True) if isinstance(x, list) else [(got[p][c], x)]
            assert all(a == b or abs(a - b) < 1e-7 * max(1.0, abs(b)) for a, b in pairs), (p, c)


def test_interpolation_grid(spark, monkeypatch):
    wide = _wide(spark)
    for limit in (GE.MAX_BIN, 0):       # 0: every bin is cut once more
        monkeypatch.setattr(GE, "MAX_BIN", limit)
        run = InterpolationRun(wide)
        _same(run.summary, E.summaries(run.cv_rows, exact="exact"))
        _same(run.fold_errors, M.fold_mae(run.cv_rows))


def test_prediction_grid(spark):
    run = PredictionRun(_wide(spark))
    _same(run.summary, E.summaries(run.predictions.filter("holdout"), exact="exact"))


def test_evaluation_makes_no_row_per_pair_and_finisher(spark):
    """The expanded grid is neither built nor stored for an evaluation."""
    run = InterpolationRun(_wide(spark))
    assert run.evaluation.count() == 6
    assert "cv_rows" not in run.__dict__ and "cv" not in run.__dict__
    pred = PredictionRun(_wide(spark))
    assert pred.gates.count() == 6 and "predictions" not in pred.__dict__


def test_no_rows(spark):
    run = InterpolationRun(_wide(spark, n=8))
    assert run.gates.count() == 0 and run.evaluation.count() == 0


def test_counted_bins():
    """Dense and sparse keys, as np.unique gives them."""
    import numpy as np
    rng = np.random.default_rng(3)
    for key in (rng.integers(0, 50, 1000), rng.integers(0, 2**60, 1000), np.array([7]), np.array([0, 2**62])):
        for got, want in zip(GE._counted(key), np.unique(key, return_counts=True), strict=True):
            assert (got == want).all()
