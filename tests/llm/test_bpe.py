import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from racelens.llm import bpe

PATH = bpe.vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(text):
    return np.frombuffer(bpe.encoder(PATH).encode(text), "<u4").tolist()


def merged(word, ranks):
    """Merges the pair of lowest rank, leftmost first, until none is left."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not found:
            return parts
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_small_automata_against_plain_merging():
    r = random.Random(2)
    for _ in range(300):
        tokens, rules = [b"a", b"b", b"c"], []
        for _ in range(r.randrange(1, 14)):
            u, v = r.choice(tokens), r.choice(tokens)
            if u + v not in tokens:
                tokens.append(u + v)
                rules.append((u, v))
        a = bpe.TokenAutomaton({t: i for i, t in enumerate(tokens)}, rules)
        for _ in range(60):
            w = bytes(r.choice(b"abc") for _ in range(r.randrange(1, 14)))
            assert [tokens[i] for i in a.encode(w)] == merged(w, {p: i for i, p in enumerate(rules)}), (rules, w)


def test_texts_against_the_library(spark, library):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["", " ", "  \n\n x\t\ty ", "don't I'll we've 'S", "a<|endoftext|>b <|endoftext|>", "  x\u0085y\x1cz\x1d", "日本語 ключ 𝔘𝔫𝔦 🎉👩‍👩‍👧", "é ́", "aaaaaaaaaaaaaaaaaaaaa" * 50, "1234 5 ½ ²", "\r\n \r\n", "﻿​", "x" * 30_000, "\x1d'll", " \x1c'll\x1f're"]
    r = random.Random(4)
    pool = "ab  \n\t'stré1² ́_-😀<|>"
    texts += ["".join(r.choice(pool) for _ in range(r.randrange(1, 40))) for _ in range(3000)]
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids(t) == e.ids, t[:80]
        assert bpe.encoder(PATH).decode(e.ids) == library.decode(e.ids, skip_special_tokens=False)


def test_query_and_edge_rows(spark, docs, library):
    d = docs([None, "", "Hello  world", "Hello  world"])
    texts = {r.doc_id: r.text for r in bpe.decode(bpe.encode(d, PATH), PATH).collect()}
    assert texts == {0: "", 1: "", 2: "Hello  world", 3: "Hello  world"}
    assert bpe.encode(d.limit(0), PATH).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    rows = bpe.op5_bpe(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        want = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == (hashlib.sha256(docs[r.doc_id].encode()).hexdigest() if docs[r.doc_id] else empty)
