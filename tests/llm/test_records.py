import glob
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from racelens.llm import records as R
from racelens.llm.bpe import vocabulary

PATH = vocabulary("word_bpe_49k.json")


def want(texts, library):
    out, at = [], 0
    for i, e in zip(texts, library.encode_batch([texts[i] or "" for i in texts], add_special_tokens=False)):
        ids = np.array([*e.ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_round_trip(spark, library):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in d.orderBy("doc_id").collect()}
    assert sorted(map(tuple, R.op10_token_records(spark, "/root/testdata/sf0.01").collect())) == want(texts, library)


def test_edge_rows_and_files(spark, docs, library, tmp_path):
    texts = [None, "", "É é́ ﬁ Straße İ", "a<|endoftext|>b <|startoftext|>", "x\x1cy\x85z w　v", "don't I'LL 'S", "日本 🎉 1234", "same", "same", "word, " * 30_000, "´ ́x"]
    d = docs(texts).repartition(5)
    manifest = R.write_records(spark, d, PATH, str(tmp_path / "f"))
    rows = sorted(R.read_records(spark, str(tmp_path / "f"), manifest).collect(), key=lambda r: r.start)
    assert [tuple(r[:4]) for r in rows] == want(dict(enumerate(texts)), library)
    assert not glob.glob(f"{tmp_path}/f/_attempt*")
    # a seek by the index finds the same record; a changed byte is seen
    f = sorted(glob.glob(f"{tmp_path}/f/*.rec"))[-1]
    data, index = open(f, "rb").read(), np.fromfile(f[:-3] + "idx", R.INDEX)
    doc_id, ids = R.parse(R.unframe(data, int(index["offset"][-1])))
    assert doc_id == 10 and list(ids) == list(rows[10].ids)
    for at in (0, 9, len(data) - 1, len(data) - 9):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            for o in index["offset"]:
                R.unframe(bytes(bad), int(o))
    empty = R.write_records(spark, d.limit(0), PATH, str(tmp_path / "e"))
    assert R.read_records(spark, str(tmp_path / "e"), empty).count() == 0
    n = spark.createDataFrame([(None, "x"), (None, None), (1, "y"), (1, "y")], "doc_id long, text string")
    manifest = R.write_records(spark, n, PATH, str(tmp_path / "n"))
    assert [r.doc_id for r in R.read_records(spark, str(tmp_path / "n"), manifest).orderBy("start").collect()] == [None, None, 1, 1]


def test_wide_ids():
    ids = np.array([70_000, 5], "<u4")
    assert R.parse(R.payload(3, ids.tobytes(), True))[1].tolist() == [70_000, 5]
    assert R.parse(R.payload(None, ids[1:].tobytes(), False)) [0] is None
