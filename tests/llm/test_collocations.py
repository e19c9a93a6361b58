import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from racelens.llm import collocations as C


def brute(rows, least=100, depth=5, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, depth + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        c = {p: a for p, a in counts.items() if len(p) >= 2 and a >= least}
        covered = {(p[i : i + k], a) for p, a in c.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)}
        found = []
        for p, a in c.items():
            if (p, a) in covered:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


SCHEMA = "doc_id long, text string, lang string, word string, n string, shard string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, l, "x", "y", "z") for i, (l, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocab = ["a", "b", "Été", "d\x0be", "f", "G", "ß", "\x00z", "日本"]
    out = [(rng.choice(["en", "en", "en", None, "fr"]), rng.choice([" ", "\t ", "  "]).join(rng.choices(vocab, range(1, 10), k=rng.randint(0, 60))) + rng.choice([".", ",\n", "", " ?!"])) for _ in range(150)]
    out += [("en", None), (None, ""), ("xx", "only once"), ("und", "a b c d e f, a b c"), ("de", "ein satz der sich wiederholt. " * 400), ("de", "und noch ein satz")] + [("fr", "Copie exacte d'un texte: copie exacte")] * 120
    return out


@pytest.mark.parametrize("shard_words,least", [(2_000_000, 100), (300, 20), (1, 5)])
def test_brute_force(spark, rows, shard_words, least):
    got = sorted(tuple(r) for r in C.collocations(spark, table(spark, rows).repartition(3), least=least, shard_words=shard_words).collect())
    assert got == brute(rows, least) and len(got) > 5


def test_top_and_empty(spark, rows):
    d = table(spark, rows)
    got = sorted(tuple(r) for r in C.collocations(spark, d, least=5, top=3).collect())
    assert got == brute(rows, 5, top=3)
    assert C.collocations(spark, d.limit(0)).count() == 0
    assert C.collocations(spark, d, least=10**9).count() == 0


def test_whole_table_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(tuple(r) for r in C.op11_collocations(spark, sf).collect())
    docs = [(r.lang, r.text) for r in spark.read.parquet(sf + "/documents.parquet").collect()]
    assert got == brute(docs) and len(got) > 50
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    assert sorted(con.execute(C.ORACLE_SQL).fetchall()) == got


def test_index():
    """Intervals of every phrase, in both orders, against a plain search."""
    rng = np.random.default_rng(1)
    text = rng.integers(0, 5, 400)
    text[[0, -1]] = 0
    ahead, back = C.transform(text, 5), C.transform(text[::-1], 5)
    assert (np.bincount(ahead) == np.bincount(text)).all()
    lo, n = C.words_of(ahead)
    known = {(w,): (int(lo[w]), int(lo[w]), int(n[w])) for w in range(1, 5)}
    level = list(known)
    for m in range(2, 6):
        place, rplace, count = (np.array([known[p][j] for p in level]) for j in range(3))
        left = m % 2 == 0
        if left:
            p, s, n, a, b = C.extend(ahead, place, rplace, count, np.arange(len(level)))
        else:
            s, p, n, b, a = C.extend(back, rplace, place, count, np.arange(len(level)))
        new = [level[i] + (level[j][-1],) for i, j in zip(p, s)]
        assert len(set(new)) == len(new)
        grams = Counter(tuple(map(int, text[i : i + m])) for i in range(len(text) - m + 1))
        assert dict(zip(new, n.tolist())) == {g: k for g, k in grams.items() if 0 not in g}
        known = dict(zip(new, zip(a.tolist(), b.tolist(), n.tolist())))
        level = new


def test_packed_ids():
    for ids in (np.zeros(0, int), np.array([0, 1, 2**32 - 1]), np.arange(100_000)):
        assert (C.unpack_ids(C.pack_ids(ids)) == ids).all()


def test_packed_longs_and_buckets():
    rng = np.random.default_rng(2)
    for k in (0, 1, 5_000):
        a, b = rng.integers(-2**62, 2**62, k), np.arange(k)
        x, y = C.unpack_longs(C.pack_longs(a, b), 2)
        assert (x == a).all() and (y == b).all()
    at = C.bucket_of(np.repeat(np.arange(300), 300) << 33, np.tile(np.arange(300), 300) << 33, 90)
    sizes = np.bincount(at, minlength=90)
    assert len(sizes) == 90 and sizes.max() < 2 * sizes.mean()


def test_merge():
    """Counts added over shards, and the way back to each shard's own list."""
    import pyarrow as pa
    lists = {7: ([1, 3, 2], [5, 5, 9], [60, 99, 1]), 8: ([2, 1], [9, 5], [99, 40])}
    t = pa.table({"shard": list(lists), "bucket": [3, 3], "pairs": [C.pack_longs(*map(np.array, x)) for x in lists.values()]})
    rows = C._merge(t, 100).to_pylist()
    known = {r["id"]: (r["p"], r["s"], r["a"]) for r in rows if r["id"] is not None}
    assert sorted(known.values()) == [(1, 5, 100), (2, 9, 100)]
    for r in rows:
        if r["found"] is not None:
            p, s, _ = lists[r["shard"]]
            assert [(p[i], s[i]) for i in C.unpack_longs(r["found"], 2)[0]] == [known[x][:2] for x in C.unpack_longs(r["found"], 2)[1]]
    assert sorted(r["shard"] for r in rows if r["found"] is not None) == [7, 8]
    assert sorted(r["id"] is None for r in C._merge(t, 1000).to_pylist()) == []


def test_what_travels(spark, monkeypatch):
    """Texts and indexes meet their lists without an exchange, and rare phrases of frequent words stay at home."""
    made = []

    def recorded(write):
        def run(spark, df, name, *more):
            plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
            found = write(spark, df, name, *more)
            made.append((name, plan, found))
            return found
        return run

    monkeypatch.setattr(C, "shared", recorded(C.shared))
    if hasattr(C, "shared_by"):
        monkeypatch.setattr(C, "shared_by", recorded(C.shared_by))
    rng = random.Random(3)
    rows = [("en", " ".join(rng.choices([f"w{i}" for i in range(100)], k=100))) for _ in range(200)] + [("en", "often said")] * 100
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, levels = C.phrases(spark, table(spark, rows).repartition(3), shard_words=2_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "often said" in {r.phrase for r in levels[1].collect()}
    for name, plan, _ in made:
        above = []
        for line in plan if name in ("phrases-index", "phrases-step") else []:
            depth = len(re.match(r"[\s:+-]*", line)[0])
            above = [x for x in above if x[0] < depth] + [(depth, line)]
            if "FileScan" in line and re.search(r"\b(ids|ahead|back|places)#", line):
                assert not [x for _, x in above if "Exchange" in x]
    sent = [r.pairs for name, _, found in made if name in ("phrases-index", "phrases-step") and "pairs" in found.columns
            for r in found.where("pairs is not null").collect()]
    assert 0 < sum(C.unpack_longs(x, 3).shape[1] for x in sent) < 2_000     # of about 17,000
