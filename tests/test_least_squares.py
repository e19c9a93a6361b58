"""Least squares on all features of T3, for all pairs and folds from Gram matrices."""

import numpy as np
from conftest import SF_SMALL

from racelens.operators import least_squares as LS
from racelens.plans.queries_train import TCtx

GENDER = {"F": 1, "FEMALE": 1}


def test_every_fold_model_against_a_plain_solve(spark):
    """Out-of-fold predictions equal those of numpy's least squares on the raw splits, age and gender."""
    run = TCtx(spark, SF_SMALL).interp
    wide = {r["finisher_id"]: r for r in run.wide.collect()}
    rows = run.cv.select("pair_id", "row_key", "fold", "y", "pred", "n_train").collect()
    fold = {(r["row_key"]): r["fold"] for r in rows}
    pairs = {p.pair_id: p for p in run.pairs}
    by = {}
    for r in rows:
        by.setdefault(r["pair_id"], []).append(r)
    assert len(by) > 20
    for pid, found in by.items():
        p = pairs[pid]
        x = np.array([[1.0] + [wide[r["row_key"]][f] for f in p.features[:-2]] + [wide[r["row_key"]]["age"], GENDER.get(wide[r["row_key"]]["gender"], 0)] for r in found], float)
        y, f = np.array([r["y"] for r in found]), np.array([r["fold"] for r in found])
        assert (y == [wide[r["row_key"]][p.target] for r in found]).all()
        scale = np.abs(x).max(axis=0)
        for k in set(f):
            train = f != k
            if train.sum() < 2 * x.shape[1]:
                continue   # next to no rows left: the plain solve is not exact there
            beta = np.linalg.lstsq(x[train] / scale, y[train], rcond=None)[0]
            got = np.array([r["pred"] for r in found])[~train]
            assert np.allclose(x[~train] / scale @ beta, got, atol=1e-4), (pid, k)
            assert {r["n_train"] for r, m in zip(found, ~train) if m} == {train.sum()}
    assert len(set(fold.values())) == 5


def test_useless_features_get_no_weight():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 3))
    z = np.column_stack([np.ones(50), np.full(50, 3.0), x[:, 0], 2 * x[:, 0], x[:, 1]])
    y = 1 + x[:, 0] - 4 * x[:, 1]
    beta = LS.solve((z.T @ z)[None], (z.T @ y)[None])[0]
    assert beta[1] == 0 and beta[3] == 0 and np.allclose(z @ beta, y)
    assert (LS.solve(np.zeros((2, 3, 3)), np.ones((2, 3))) == 0).all()


def test_wide_table_is_not_expanded_for_the_fit(spark):
    run = TCtx(spark, SF_SMALL).interp
    plan = LS.fold_models(run.wide, run.splits, run.pairs, run.centre)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("MapInArrow"):]
    assert "Generate" not in before and "Exchange" not in before.split("Scan")[0]
