import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from racelens.llm import packing as K
from racelens.llm.bpe import vocabulary

PATH = vocabulary("byte_bpe_50k.json")


def held(patterns):
    out = {}
    for p, n in patterns:
        for x, t in p:
            out[x] = out.get(x, 0) + t * n
    return out


def fewest(pieces, capacity):
    """Optimal number of bins by exhaustive search."""
    best = [len(pieces)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(pieces):
            best[0] = len(bins)
            return
        for n in {r: k for k, r in enumerate(bins) if r >= pieces[i]}.values():
            put(i + 1, [*bins[:n], bins[n] - pieces[i], *bins[n + 1:]])
        put(i + 1, [*bins, capacity - pieces[i]])
    put(0, [])
    return best[0]


def test_fewest_sequences_on_small_cases():
    r = random.Random(1)
    better = 0
    for _ in range(150):
        pieces = sorted((r.choice((r.randrange(1, 100), r.randrange(20, 50))) for _ in range(r.randrange(1, 11))), reverse=True)
        counts = {x: pieces.count(x) for x in pieces}
        fit, done = K.best_fit(counts, 100), K.complete_bins(counts, 100)
        for p in (fit, done):
            assert held(p) == counts and all(sum(x * t for x, t in q) <= 100 for q, _ in p)
        n = sum(m for _, m in done)
        assert K.bound(counts, 100) <= n
        assert n == fewest(pieces, 100)
        better += n < sum(m for _, m in fit)
    # a case where best-fit decreasing needs one sequence more
    counts = {51: 1, 27: 2, 26: 1, 23: 2, 25: 1, 48: 0, 49: 2}
    assert sum(m for _, m in K.complete_bins(counts, 100)) <= sum(m for _, m in K.best_fit({k: v for k, v in counts.items() if v}, 100))


def test_every_filling_is_tried():
    """Full sequences that the likely fillings miss, and all fillings against a brute-force list."""
    for sequences, times, lengths in ((3, 1, (59, 74, 119, 122, 138, 183, 187, 192, 198, 226, 278, 280, 309, 313, 322)),
                                      (4, 1, (59, 64, 67, 132, 177, 182, 214, 216, 228, 237, 242, 255, 298, 305, 310, 321, 326, 367))):
        counts = dict.fromkeys(lengths, times)
        assert sum(lengths) * times == sequences * 1000
        done = K.complete_bins(counts, 1000, 20_000)
        assert held(done) == counts and sum(n for _, n in done) == sequences
        assert all(sum(x * t for x, t in p) <= 1000 for p, _ in done)
    r = random.Random(2)
    for _ in range(60):
        counts = {x: r.randrange(1, 4) for x in r.sample(range(1, 30), r.randrange(1, 6))}
        lengths, room = sorted(counts, reverse=True), r.randrange(1, 70)
        chosen = [{}]
        for x in lengths:
            chosen = [{**c, x: t} for c in chosen for t in range(counts[x] + 1)]
        volume = lambda c: sum(x * t for x, t in c.items())
        want = [[x for x in lengths for _ in range(c[x])] for c in chosen if volume(c) <= room and all(c[x] == counts[x] or volume(c) + x > room for x in lengths)]
        got = [f for f in K.every_filling(room, lengths, counts) if f is not None]
        assert sorted(got) == sorted(want)


def test_large_counts_meet_the_bound():
    r = random.Random(3)
    counts = {x: r.randrange(1, 400) for x in range(1, 2049)}
    done = K.complete_bins(counts, 2048)
    assert held(done) == counts
    assert K.bound(counts, 2048) <= sum(n for _, n in done) <= sum(n for _, n in K.best_fit(counts, 2048))
    short = {x: n for x, n in counts.items() if x < 700}
    assert sum(n for _, n in K.complete_bins(short, 2048)) <= K.bound(short, 2048) + 1
    assert K.complete_bins({}, 10) == []


def check(rows, texts, library, capacity=2048):
    enc = {i: [*e.ids, 0] for (i, _), e in zip(texts.items(), library.encode_batch([t or "" for t in texts.values()], add_special_tokens=False))}
    got, bins = {}, {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        ids = enc[r.doc_id][r.start:r.start + r.length]
        assert len(ids) == r.length and zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, ids in enc.items():
        n = len(ids)
        head = n % capacity or capacity
        assert sorted(got[i]) == [(0, 0, head)] + [(k + 1, s, capacity) for k, s in enumerate(range(head, n, capacity))]
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    assert len(bins) <= -(-sum(map(len, enc.values())) // capacity) + 1


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_query(spark, library):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(K.op7_pack(spark, "/root/testdata/sf0.01").collect(), {r.doc_id: r.text for r in d.collect()}, library)


def test_edge_rows(spark, docs, library):
    texts = [None, "", "a b c", "a b c", "word " * 30_000, " x" * 2047, " x" * 2048]
    check(K.pack(spark, docs(texts), PATH).collect(), dict(enumerate(texts)), library)
    assert K.pack(spark, docs(texts).limit(0), PATH).count() == 0
    d = spark.createDataFrame([(None, "x"), (1, "y"), (1, "y")], "doc_id long, text string")
    rows = K.pack(spark, d, PATH).collect()
    assert len(rows) == 3 and sorted(r.offset for r in rows) == [0, 2, 4]
