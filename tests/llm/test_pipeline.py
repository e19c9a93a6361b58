"""Each stage against a brute-force version on its own input, and the whole run."""

import importlib.util
import os

import corpus_pipeline as C
import pytest
from tokenizers import Tokenizer

from racelens.llm import toxicity as T
from racelens.llm.bpe import vocabulary

SF = "/root/testdata/sf0.01"


def sibling(name):
    spec = importlib.util.spec_from_file_location(f"{name}_brute", os.path.join(os.path.dirname(__file__), f"{name}.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(C.COLUMNS)
    out = [docs]
    for name, stage in C.STAGES:
        out.append(C.shared(spark, stage(spark, out[-1], SF), "test-stage"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in C.STAGES] == ["toxicity", "line dedup", "minhash near-dedup", "best-fit packing"]


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == C.COLUMNS
    for df in stages[:3]:
        assert all(r.n_chars == len(r.text or "") for r in df.collect())


def test_toxicity(spark, stages):
    model = T.train(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    gains, want = model.gains(), {}
    for i, t in texts(stages[0]).items():
        n, size = gains.features(set(T.windows(t)), model.threshold)
        if model.score(n, size) < 0.5:
            want[i] = t
    assert texts(stages[1]) == want and len(want) < stages[0].count()


def test_line_dedup(stages):
    want = sibling("test_line_dedup").brute(list(texts(stages[1]).items()))
    had = texts(stages[1])
    assert texts(stages[2]) == {i: t for i, t in want.items() if t == (had[i] or "") or t.strip()}


def test_near_duplicates(stages):
    rows = texts(stages[2])
    want = sibling("test_minhash").brute(list(rows.items()), 5, 80)
    assert texts(stages[3]) == {i: t for i, t in rows.items() if want[i][1] == i}


def test_packing(spark, stages):
    sibling("test_packing").check(stages[4].collect(), texts(stages[3]), Tokenizer.from_file(vocabulary("byte_bpe_50k.json")))


def test_edge_rows(spark, docs):
    d = docs([None, "", "a line that stands here twice", "a line that stands here twice", "  \n", "x"]).select(C.COLUMNS)
    d = d.unionByName(spark.createDataFrame([(None, "a line that stands here twice", None, None, None)], d.schema))
    for name, stage in C.STAGES[:-1]:
        d = stage(spark, d, SF)
        assert d.columns == C.COLUMNS
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in d.collect()) == [(False, 0), (False, 1), (False, 2), (False, 4), (False, 5), (True, 0)]
    empty = d.limit(0)
    for name, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0
