import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from racelens.llm import importance as I

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(t)
    return len(w), Counter(zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])])


def brute(docs, target):
    """docs: (doc_id, text) rows."""
    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, c in found:
        s.update(c)
    for x in target:
        t.update(features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for i, n, c in found:
        m = sum(c.values())
        w = sum(gain[b] * k for b, k in c.items()) // m if m else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        rows.append([i, m, w, None if i is None else w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(fit[: 25 * len(fit) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(sf + "/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(sf + "/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in I.op12_importance_resample(spark, sf).collect()), key=str)
    assert got == brute(docs, target)
    assert sum(r[4] is not None for r in got) > 100


def run(spark, docs, target):
    gain = I.gains(I.bucket_counts(docs), I.bucket_counts(target))
    return sorted((tuple(r) for r in I.draw(spark, I.importance(docs, gain)).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_edge_rows(spark):
    long = "Wörter und words 42 " * 50_000
    rows = [(1, None), (2, ""), (3, "..."), (4, long), (None, long), (5, "one"), (6, "A b A b " * 30), (6, "A b A b " * 30), (6, "c d " * 30), (7, "\x00é!é")] + [(100 + i, "same text of ten words that all the copies share " * 3) for i in range(200)]
    target = [None, "", "words und Wörter", "a b"]
    schema = "doc_id long, text string, score string, rank string, n_words string"
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], schema)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    assert run(spark, docs, bench) == brute(rows, target)
    assert run(spark, docs.limit(0), bench) == []
    assert run(spark, docs, bench.limit(0)) == brute(rows, [])


def test_bit_sliced_sums():
    rng = np.random.default_rng(3)
    for gain in (rng.integers(-20000, 20000, 10000), np.zeros(10000, np.int64), np.full(10000, -1)):
        sliced = I.GainPlanes(gain)
        for found in (rng.integers(0, 10000, 5000), np.repeat(7, 100_001), rng.zipf(1.3, 3000) % 10000):
            assert sliced.total(found) == int(gain[found].sum())
