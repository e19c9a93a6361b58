"""A subset of registered queries against their DuckDB oracle at sf0.001."""

import math

import pytest

from conftest import SF_SMALL

KEYS = ["split_distance", "split_plan", "history_adaptive", "training_table", "final_splits", "batch_outcomes",
        "error_metrics", "quality_score", "training_row_report", "coverage", "catalog_scan", "recursive_load"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 6) + 0.0)
    return None if v is None else repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as E
    df = E.queries()[key](spark, SF_SMALL)
    con = duck(SF_SMALL)
    res = con.execute(E.oracle_sql()[key])
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_key_has_builder_and_most_have_oracle():
    import __spark_entry__ as E
    from racelens.plans import all_oracle_sql, all_queries
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # the main library's keys; the training-data operators may be registered beside them
    q, o = set(all_queries()) & set(q), set(all_oracle_sql()) & set(o)
    assert len(q) >= 80
    rows_only = q - o
    assert rows_only <= {"fit_boosted", "reuse_if_exists", "manifest_read"}
