"""Counts of the grid without expanding it, on rows with gaps inside, repeated athletes and null ages."""

import random

from racelens.operators import grid as G
from racelens.operators.training import InterpolationRun, PredictionRun


def test_counts_with_interior_gaps(spark):
    rng = random.Random(8)
    names = ["km_5", "km_10", "km_15", "km_20", "km_25"]
    rows = [(i, str(rng.randrange(60)), rng.choice(["M", "F", None]), rng.choice([None, 30, 40, 50]),
             *[None if rng.random() < 0.25 else 1000.0 * (k + 1) + i for k in range(5)]) for i in range(400)]
    wide = spark.createDataFrame(rows, "finisher_id long, athlete_id string, gender string, age int, " + ", ".join(f"{n} double" for n in names))
    ages = [r for r in rows if r[3] is not None]
    full = lambda r, idx: all(r[4 + i] is not None for i in idx)
    run = InterpolationRun(wide)
    got = {r["pair_id"]: r["n_complete"] for r in run.counts.collect()}
    assert got == {p.pair_id: sum(full(r, p.required) for r in ages) for p in run.pairs}
    held = {r["athlete_id"]: r["h"] for r in wide.select("athlete_id", G.is_holdout(wide.athlete_id).alias("h")).distinct().collect()}
    run = PredictionRun(wide)
    sizes = {r["pair_id"]: tuple(r)[1:5] for r in run.sizes.collect()}
    for p in run.pairs:
        found = [r for r in ages if full(r, p.required)]
        train, test = ([r for r in found if held[r[1]] == h] for h in (False, True))
        assert sizes[p.pair_id] == (len(train), len(test), len({r[1] for r in train}), len({r[1] for r in test}))
    assert run.counts.filter("not trained").count() + run.trained.select("pair_id").distinct().count() == len(run.pairs)
