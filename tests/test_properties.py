"""Property tests (Hypothesis): one Spark job per generated batch."""

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from racelens.functions import names as N
from racelens.operators import evaluate as E

name_st = st.one_of(
    st.sampled_from(["half", "finish", "start", "HALF", "km_", "km_5_", "meta", "media", "salida"]),
    st.builds(lambda a, sep, b: f"km_{a}{sep}{b}", st.integers(0, 99), st.sampled_from(["", "_", ".", "__"]),
              st.sampled_from(["", "5", "25", "0975", "x"])),
    st.text(alphabet="km_.0123456789ahlf", max_size=8))


def py_distance(s):
    low = s.lower()
    if low in ("half", "finish", "start"):
        return {"half": 21.0975, "finish": 42.195, "start": 0.0}[low]
    m = re.match(r"^km_([0-9]*[._]?[0-9]+)$", low)
    return float(m.group(1).replace("_", ".")) if m else None


@settings(max_examples=5, deadline=None)
@given(st.lists(name_st, min_size=1, max_size=40))
def test_distance_matches_python(spark, names):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(names)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(N.split_distance(F.col("s"))).collect()]
    assert got == [py_distance(s) for s in names]


@settings(max_examples=5, deadline=None)
@given(st.lists(name_st, min_size=0, max_size=12))
def test_order_is_stable_permutation(spark, names):
    df = spark.createDataFrame([(names,)], "s array<string>")
    out = df.select(N.order_splits_array(F.col("s"))).first()[0]
    assert sorted(out) == sorted(names)
    assert out == N.order_split_names(names)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.floats(1, 1000), st.floats(1, 1000)), min_size=1, max_size=60))
def test_score_bounds(spark, rows):
    df = spark.createDataFrame([(p, y, q) for p, y, q in rows], "pair_id int, y double, pred double")
    for g in E.gate(df).collect():
        assert 0 <= g["score"] <= 100
        if g["approved"]:
            assert g["score"] == 100
        if not math.isinf(g["cv"]):
            assert g["cv"] >= 0
