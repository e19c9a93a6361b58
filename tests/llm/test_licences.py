import re

import duckdb

from racelens.llm import licences as L


def brute(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    split = lambda s: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", s)
    w = split(t)
    base = []
    for p, label in L.PHRASES.items():
        p = p.split()
        base += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    met = []
    for line in t.split("\n"):
        s = set(split(line))
        for words, label in L.TEMPLATES:
            x = set(words.split())
            if len(s & x) >= 0.8 * len(x) - 1e-9:
                met.append((label, len(s & x) / len(x)))
    at = [i for i, _ in base]
    score = 1.0 if base else max((c for _, c in met), default=0.0)
    return (len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({b for _, b in base})), ",".join(sorted({b for _, b in base} | {x for x, _ in met})), score)


CASES = [None, "", "MIT\nLicense", "the mit-license, CC-BY! cc by", "Released under MIT license.", "released by the license under mit", "Licensed under the Apache License, Version 9.9",
         "under the licensed version 2 0 license apache x", "all  RIGHTS\treserved", "rights all\nreserved", "éMIT license", "mit license mit license", "\x00\x1f`{~", "a " * 60_000 + "GNU General Public License"]


def test_cases(spark, docs):
    import racelens.llm.common
    d = docs(CASES)
    keep = racelens.llm.common.read
    L.read = lambda *a: d
    try:
        got = {r.doc_id: tuple(r)[1:] for r in L.op1_license_scan(spark, "").collect()}
        L.read = lambda *a: d.limit(0)
        assert L.op1_license_scan(spark, "").count() == 0
    finally:
        L.read = keep
    assert got == {i: brute(t) for i, t in enumerate(CASES)}


def test_whole_table_and_sql(spark):
    rows = {r.doc_id: tuple(r)[1:] for r in L.op1_license_scan(spark, "/root/testdata/sf0.01").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert rows == {i: brute(t) for i, t in texts.items()}
    assert sum(r[5] != "" for r in rows.values()) > 10
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    assert {r[0]: r[1:] for r in con.execute(L.ORACLE_SQL).fetchall()} == rows
