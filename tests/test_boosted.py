"""fit_boosted fits every pair of the grid that meets min_samples."""

from conftest import SF_SMALL
from pyspark.sql import functions as F


def test_every_trained_pair_is_fitted(spark, monkeypatch):
    from racelens.operators import grid as G
    from racelens.operators import models as M
    from racelens.plans import queries_train as Q
    monkeypatch.setattr(M, "GBT_INTERP", dict(M.GBT_INTERP, maxIter=1, maxDepth=2))
    run = Q.TCtx(spark, SF_SMALL).interp
    assert run.min_samples == G.MIN_SAMPLES
    want = {r.pair_id: r.n_complete for r in run.counts.filter("trained").collect()}
    got = Q.q_fit_boosted(spark, SF_SMALL).groupBy("pair_id").agg(F.count("*").alias("n"), F.count("pred").alias("p")).collect()
    assert len(want) > 1
    assert {r.pair_id: (r.n, r.p) for r in got} == {i: (n, n) for i, n in want.items()}
