import hashlib
import random

from racelens.llm import line_dedup as D


def within_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    n = 0
    while n < len(a) and a[n] == b[n]:
        n += 1
    return a[n + 1:] == b[n + 1:] if len(a) == len(b) else a[n:] == b[n + 1:]


def brute(rows):
    """doc_id -> text without the lines that an earlier one equals or, among long ones, that have one within one edit."""
    seen, by_length, out = set(), {}, {}
    for i, text in sorted(r for r in rows if r[0] is not None):
        kept = []
        for line in (text or "").split("\n"):
            x = line.strip()
            if not x:
                kept.append(line)
                continue
            near = [y for n in (-1, 0, 1) for y in by_length.get(len(x) + n, ())] if len(x) >= D.MIN_CHARS else []
            if x not in seen and not any(within_one(x, y) for y in near):
                kept.append(line)
            if x not in seen:
                seen.add(x)
                if len(x) >= D.MIN_CHARS:
                    by_length.setdefault(len(x), []).append(x)
        out[i] = "\n".join(kept)
    return out


def check(spark, df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = {r.doc_id: r.text or "" for r in D.dedup_lines(spark, df).collect() if r.doc_id is not None}
    want = brute(rows)
    assert got == want
    return want, dict(rows)


def test_whole_table(spark):
    want, had = check(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert sum(want[i] != (had[i] or "") for i in want) > 20
    rows = D.op6_line_dedup(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: r.text_sha256 for r in rows} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    assert all(r.n_lines - r.n_dropped == len(want[r.doc_id].split("\n")) or r.n_lines == r.n_dropped for r in rows)


def test_one_edit_anywhere(spark, docs):
    r = random.Random(6)
    texts = []
    for n in (24, 25, 31, 32, 33, 47, 48, 49, 200):
        base = "".join(r.choice("abcdé ") for _ in range(n - 2))
        base = f"x{base}y"
        texts.append(base)
        for i in range(len(base)):
            texts.append(r.choice((base[:i] + "Z" + base[i + 1:], base[:i] + base[i + 1:], base[:i] + "Q" + base[i:])))
    texts += ["a" * 40, "a" * 41, "a" * 39, "a" * 20 + "b" + "a" * 20, "ab" * 20, "ba" * 20, "ab" * 20 + "a"]
    r.shuffle(texts)
    check(spark, docs(texts))


def test_shared_variants_and_edge_rows(spark, docs):
    numbered = [f"one of many lines with number {n % 10} at its middle" for n in range(400)]
    texts = [None, "", "short\nshort", "\n\n", "\n".join(numbered), *numbered[:30], "  " + numbered[0] + " \t", "the end of it is a very long one " + "word " * 30_000, "the end of it is a very long one " + "word " * 29_999 + "ward ", numbered[0] + "\n" + numbered[0]]
    want, _ = check(spark, docs(texts))
    assert want[2] == "short" and want[3] == "\n\n"
    d = spark.createDataFrame([(None, numbered[0], 1), (4, numbered[0], 2), (4, numbered[0], 3), (5, None, 4), (6, numbered[0], 5)], "doc_id long, text string, line int")
    got = sorted((r.line, r.text, r.n_dropped) for r in D.dedup_lines(spark, d).collect())
    assert got == [(1, numbered[0], 0), (2, numbered[0], 0), (3, numbered[0], 0), (4, None, 0), (5, "", 1)]
    assert D.dedup_lines(spark, d.limit(0)).count() == 0


def test_one_id_with_different_texts(spark):
    a, b = "a sentence that no other row has at all", "the second line that both rows have here"
    c = "something quite different in its first line"
    d = spark.createDataFrame([(1, f"{a}\n{b}"), (1, f"{c}\n{b}"), (1, f"{c}\n{b}"), (2, f"{c}\n{a}\nx")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_dropped) for r in D.dedup_lines(spark, d).collect())
    assert sum(n for _, _, n in got) in (3, 4)  # the later of both rows loses b; where that is the repeated row, twice
    assert [t for i, t, _ in got if i == 2] == ["x"]
    assert any(t.startswith(a) for _, t, _ in got) and any(t.startswith(c) for _, t, _ in got)


def test_equal_short_lines(spark, docs):
    """Equal lines go at any length, a short line one edit away and blank lines stay."""
    want, _ = check(spark, docs(["All rights reserved.\n}\n\nx", "  }\n\nAll rights reserved,", "x\nAll rights reserved.\nnew", "}"]))
    assert want == {0: "All rights reserved.\n}\n\nx", 1: "\nAll rights reserved,", 2: "new", 3: ""}
