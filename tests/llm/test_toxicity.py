import zlib

import numpy as np

from racelens.llm import toxicity as T


def test_held_out_accuracy(spark):
    rows = T.op8_toxicity(spark, "/root/testdata/sf0.1").collect()
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    label = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    out = [r for r in rows if r.held_out and r.doc_id in label]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    y, p, s = (np.array(x) for x in zip(*((label[r.doc_id], r.predicted, r.score) for r in out)))
    print("accuracy", (y == p).mean(), "base", max(y.mean(), 1 - y.mean()), "precision", y[p == 1].mean(), "recall", p[y == 1].mean())
    assert (y == p).mean() > 0.93 and y[p == 1].mean() > 0.9
    pos, neg = s[y == 1], s[y == 0]
    assert ((pos[:, None] > neg[None]).mean() + (pos[:, None] == neg[None]).mean() / 2) > 0.7


def test_edge_rows(spark, docs):
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    texts = [("calm words about rivers and hills %d " % i) * 3 + ("horrible nonsense" if i % 3 == 0 else "") for i in range(60)] + [None, "", "horrible nonsense " * 50_000, "x"]
    d = docs(texts)
    got = {r.doc_id: r.score for r in T.score(d, T.train(d, labels)).collect()}
    assert len(got) == 64 and got[62] > 0.5 > got[60] and got[60] == got[61]
    none = T.train(d, labels.limit(0))
    assert all(r.score < 0.01 for r in T.score(d, none).collect())
    assert T.score(d.limit(0), none).count() == 0
    one = T.train(d, labels.where("toxic = 1"))
    assert all(r.score > 0.99 for r in T.score(d, one).collect())
    n = spark.createDataFrame([(None, "x"), (1, None), (1, None)], "doc_id long, text string")
    assert T.score(n, none).count() == 3
