import numpy as np
import pytest

from racelens.llm import multi_index as I
from racelens.llm import pq_dedup as P

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, id int, list string"


@pytest.fixture(scope="module")
def table(spark):
    """Random vectors, a large group of near copies, exact copies and rows that take no part."""
    r = np.random.default_rng(3)
    x = r.normal(size=(900, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[200:400] = x[200] + r.normal(size=(200, 16)) * 0.045
    x[400:460] = x[40:100] + r.normal(size=(60, 16)) * 0.02
    x[500:600] = x[7]
    x[700:720] *= 3
    rows = [(i, [float(f) for f in v], int(i % 3 if i < 200 or i >= 600 else 1), "x", 1, None) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows += [(1000 + 20 * i, v, 1, None, None, None) for i, v in enumerate(odd)] + [(2000, rows[7][1], None, None, None, None), (None, rows[7][1], 1, None, None, None), rows[7], rows[9]]
    return spark.createDataFrame(rows, SCHEMA)


def good(rows):
    out = {}
    for r in rows:
        v = r.embedding
        if r.vec_id is not None and v and len(v) == 16 and all(f is not None and np.isfinite(f) for f in v) and any(v):
            out[r.vec_id] = (np.array(v, float), r.label)
    return out


def test_links_against_all_pairs(spark, table):
    rows = table.collect()
    ok = {i: x for i, x in good(rows).items() if x[1] is not None}
    ids = sorted(ok)
    x = np.array([ok[i][0] / np.linalg.norm(ok[i][0]) for i in ids])
    label = np.array([ok[i][1] for i in ids])
    link = (x @ x.T >= 0.93) & (label[:, None] == label[None]) & ~np.eye(len(ids), dtype=bool)
    comp = np.arange(len(ids))
    for _ in range(50):
        comp = np.minimum(comp, np.where(link, comp[None], len(ids)).min(axis=1))
    want = {i: (int(link[n].sum()), ids[comp[n]]) for n, i in enumerate(ids)}
    got = {}
    for r in P.embedding_near_duplicates(spark, table).collect():
        if r.vec_id is None:
            assert r.n_links == 0 and r.kept
        else:
            got[r.vec_id] = (r.n_links, r.component_id)
            assert r.kept == (r.vec_id == r.component_id)
    for r in rows:
        if r.vec_id is not None and r.vec_id not in want:
            assert got.pop(r.vec_id) == (0, r.vec_id)
    total, found = (sum(v[0] for v in d.values()) for d in (want, got))
    assert all(got[i][0] <= want[i][0] for i in want)
    assert found >= 0.995 * total and sum(got[i] == want[i] for i in want) >= 0.97 * len(want)


def test_neighbours_against_brute_force(spark, table):
    ok = good(table.collect())
    ids = np.array(sorted(ok))
    x = np.array([ok[i][0] for i in ids])
    got = {}
    for r in I.nearest_neighbours(spark, table).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    asked = [i for i in ids if i % 20 == 0]
    assert sorted(got) == asked
    hits = 0
    for q in asked:
        s = x @ ok[q][0]
        order = [n for n in np.lexsort((ids, -np.round(s, 12))) if ids[n] != q][:20]
        assert sorted(got[q]) == list(range(1, 21))
        hits += len({int(ids[n]) for n in order} & {v for v, _ in got[q].values()})
        scores = [got[q][k][1] for k in range(1, 21)]
        assert scores == sorted(scores, reverse=True)
        assert all(abs(ok[v][0] @ ok[q][0] - s) < 1e-12 for v, s in got[q].values())
    assert hits >= 0.9 * 20 * len(asked)
    # with every cell visited the answer is exact, ties included
    got = {(r.query_id, r["rank"]): r.vec_id for r in I.nearest_neighbours(spark, table, candidates=1.0).collect()}
    for q in asked:
        s = (x * ok[q][0]).sum(axis=1)
        order = [n for n in np.lexsort((ids, -s)) if ids[n] != q][:20]
        assert [got[q, k + 1] for k in range(20)] == [int(ids[n]) for n in order]


def test_few_and_no_rows(spark, table):
    few = table.where("vec_id in (0, 1, 2)")
    assert [(r["rank"], r.query_id) for r in I.nearest_neighbours(spark, few).orderBy("rank").collect()] == [(1, 0), (2, 0)]
    for fn in (I.nearest_neighbours, P.embedding_near_duplicates):
        assert fn(spark, table.limit(0)).count() == 0
        assert fn(spark, table.where("vec_id = 1000")).count() in (0, 1)


def test_links_in_a_low_dimensional_subspace(spark, monkeypatch):
    """Vectors near six main directions: every link is found, in one cell and over many."""
    r = np.random.default_rng(11)
    x = r.normal(size=(1500, 6)) @ r.normal(size=(6, 64)) + r.normal(size=(1500, 64)) * 0.1
    df = spark.createDataFrame([(i, v.tolist(), 1 + (i % 10 == 0)) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    u, label = x / np.linalg.norm(x, axis=1, keepdims=True), np.arange(1500) % 10 == 0
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None]) & ~np.eye(1500, dtype=bool)
    comp = np.arange(1500)
    for _ in range(100):
        comp = np.minimum(comp, np.where(link, comp[None], 1500).min(axis=1))
    assert link.sum() > 1000
    for block in (P.BLOCK, 100):
        monkeypatch.setattr(P, "BLOCK", block)
        got = {v.vec_id: (v.n_links, v.component_id) for v in P.embedding_near_duplicates(spark, df).collect()}
        assert got == {i: (int(link[i].sum()), int(comp[i])) for i in range(1500)}
