import random

import numpy as np

from racelens.llm import minhash as M


def brute(rows, k, percent):
    """doc_id -> (set size, smallest reachable doc_id), by comparing all pairs of literal shingle sets."""
    def shingles(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for s in "\t\n\v\f\r":
            w = w.replace(s, " ")
        w = [x for x in w.split(" ") if x]
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = sorted((root(i), root(j)))
                    comp[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_matches_all_pairs(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    assert got(M.near_duplicates(spark, d, 2, 80)) == brute(rows, 2, 80)


def test_chain_and_large_group(spark, docs):
    """Copies whose neighbours are similar while the ends are not, and a large group of near copies."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    chain = []
    for step in range(12):
        base = base[:]
        base[step * 5] = f"c{step}"
        chain.append(" ".join(base))
    hot = [f"h{i}" for i in range(120)]
    group = [" ".join(hot[:i] + [f"x{r.random()}"] + hot[i + 1:]) for i in (r.randrange(120) for _ in range(150))]
    texts = chain + group + group[:40]
    r.shuffle(texts)
    d = docs(texts)
    assert got(M.near_duplicates(spark, d, 2, 80)) == brute(list(enumerate(texts)), 2, 80)


def test_edge_rows(spark, docs):
    texts = [None, "", " \n", "one", "ONE", "two words", "Two  Words", "É x", "é x", "a " * 50_000, "a " * 49_000]
    out = got(M.near_duplicates(spark, docs(texts), 2, 80))
    assert out == brute(list(enumerate(texts)), 2, 80)
    assert out[0] == (0, 0) and out[1] == (0, 1) and out[4][1] == 3 and out[10][1] == 9
    d = spark.createDataFrame([(None, "one"), (3, "one"), (3, "one"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id, r.kept) for r in M.near_duplicates(spark, d).collect() if r.doc_id) == [(3, 3, True)] * 2
    assert sum(r.kept for r in M.near_duplicates(spark, d).collect()) == 4
    assert M.near_duplicates(spark, d.limit(0)).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert M.near_duplicates(spark, d.limit(0)).count() == 0


def test_estimate_follows_the_index():
    r = np.random.default_rng(1)
    for j in (0.3, 0.6, 0.8, 0.95):
        n = 2000
        both = r.integers(0, 2**63, int(2 * n * j / (1 + j)), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, r.integers(0, 2**63, n - len(both), dtype=np.uint64)])) for _ in "ab")
        a, b = (M._mix(x) for x in (a, b))
        est = M.jaccard_estimate(M.registers(a)[None], M.registers(b)[None], np.array([n]), np.array([n]))[0]
        assert abs(est - j) < 0.16
