"""Phrase collocations by an FM-index per shard over word ids (operator 11).

A shard holds about SHARD_WORDS words of one language, gathered by the task
that reads the texts, so no text is shuffled. Words are counted over all
shards first; rarer words than the least count cannot stand in a candidate and
become separators, as the ends of pieces are. The index of a shard is two
Burrows-Wheeler transforms of its word ids, of the text and of the text
reversed, from suffixes sorted by at least DEPTH words.

A phrase is held as two intervals that are kept in step: its place among the
suffixes of the text and, word order turned round, among those of the reversed
text. One transform extends it by each word before it, the other by each word
after it; both new intervals follow from counts within the old one. The levels
alternate: bigrams come from the left, three words from the right, and so on.
Where both parts of the new phrase, without its last and without its first
word, are frequent over all shards, its count goes out; counts are added
across shards, and only phrases that reach the least count over all of them
are extended further. So every count is exact, and what is shuffled shrinks
with the length.

Most phrases are rare, so counts go out in two passes. First each shard adds
up its phrases by slot, a hash of their parts, with one slot for every
WORDS_A_SLOT words of the whole text. A frequent phrase makes its slot reach
the least count over all shards; phrases of other slots stay at home.

Counts travel as packed lists: a shard deals its phrases out to buckets by a
hash of their two parts and sends one compressed list a bucket. There are as
many buckets as shards of full size in the text, a phrase stands at most once
in a shard, so a bucket's lists hold about one shard's words at any size. Back
to a shard go only places in its own lists and the new ids; the intervals stay
in one row of the shard. Texts, indexes and intervals are stored in buckets by
shard, so that they stay where they are when these lists come to them. With
very many shards the lists get short, down to one phrase each.

Each level is written to the shared folder and read from there. Phrases are
named by the ids of their two parts; the frequent ones carry the counts of
their prefixes and suffixes along, which are the l and r of their cuts, and
extensions with an equal count mark what they cover. Joins are left to Spark,
which broadcasts a side only where its size allows.

A null or empty text has no words; a null lang is `und`. Words are runs of
anything but blanks and tabs within a piece, A-Z lower-cased. doc_id is not
read; repeated rows count each. Languages without a candidate give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelens.llm.common import read, shared, shared_by

SHARD_WORDS = 2_000_000
WORDS_A_SLOT = 4
DEPTH = 5
LEAST = 100
TOP = 2_000
LISTS = 4_096

_END = b"\xff"  # stands in no UTF-8 text
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 255 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, with an end mark wherever a piece ends."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).replace(_END, b" " + _END + b" ").split()


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids as four byte planes, compressed."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstd.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack_ids(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstd.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def pack_longs(*columns: np.ndarray) -> bytes:
    """Equally long columns of longs as byte planes, compressed."""
    table = np.ascontiguousarray(np.stack(columns).astype("<i8")).view(np.uint8)
    planes = table.reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return zstd.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack_longs(blob: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(zstd.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8").reshape(columns, -1).astype(np.int64)


def bucket_of(p: np.ndarray, s: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a phrase, by a hash of the ids of its parts."""
    h = (p.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + s.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def pack_words(words: list[bytes]) -> bytes:
    return zstd.ZstdCompressor(level=3).compress(b" ".join(words))


def unpack_words(blob: bytes) -> list[bytes]:
    return zstd.ZstdDecompressor().decompress(blob).split(b" ")


# ------------------------------------------------------------------ shards

class _Shard(dict):
    """Word ids in order of appearance; 0 is the end mark."""

    def __init__(self):
        super().__init__({_END: 0})
        self.chunks, self.size = [], 0

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found

    def add(self, found: list[bytes]) -> None:
        if found:
            self.chunks += [np.fromiter(map(self.__getitem__, found), np.uint32, len(found)), np.zeros(1, np.uint32)]
            self.size += len(found)


TEXT_SCHEMA = "lang string, shard long, ids binary, words binary, counts binary, n long"


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """One row a shard: its ids, its words in order of id with their counts, and their number. The open shards of a task hold `size` words together."""
    schema = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("ids", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()), ("n", pa.int64())])
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 24
    open_shards: dict[str, _Shard] = {}

    def flush(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal number
        shard = open_shards.pop(lang)
        number += 1
        ids = np.concatenate(shard.chunks)
        counts = np.bincount(ids, minlength=len(shard))[1:]
        yield pa.RecordBatch.from_pylist([{"lang": lang, "shard": number, "ids": pack_ids(ids), "words": pack_words(list(shard)[1:]), "counts": pack_longs(counts), "n": int(counts.sum())}], schema)

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if lang not in open_shards:
                open_shards[lang] = _Shard()
            open_shards[lang].add(tokens(text))
            if sum(s.size for s in open_shards.values()) >= size:
                yield from flush(max(open_shards, key=lambda x: open_shards[x].size))
    for lang in list(open_shards):
        if open_shards[lang].size:
            yield from flush(lang)


DEALT_COLUMNS = "lang string, shard long, bucket long, words binary, counts binary"


def _deal(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The words of each shard (ids from 1) as one list a bucket, by a checksum of lang and word."""
    names = ["lang", "shard", "bucket", "words", "counts"]
    for b in batches:
        for lang, shard, words, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            words, (counts,) = unpack_words(words), unpack_longs(counts, 1)
            begin = zlib.crc32(lang.encode("utf-8", "surrogatepass") + b" ")
            at = np.fromiter((zlib.crc32(w, begin) for w in words), np.int64, len(words)) % buckets
            by = np.argsort(at, kind="stable")
            starts = np.flatnonzero(np.diff(at[by], prepend=-1))
            lists = [by[x:y] for x, y in zip(starts, [*starts[1:], len(by)], strict=True)]
            for i in range(0, len(lists), LISTS):
                part = lists[i : i + LISTS]
                k = len(part)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * k), pa.array([shard] * k, pa.int64()), pa.array([int(at[x[0]]) for x in part], pa.int64()), pa.array([pack_words([words[w] for w in x]) for x in part], pa.binary()), pa.array([pack_longs(x + 1, counts[x]) for x in part], pa.binary())], names=names)


WORD_SCHEMA = pa.schema([("shard", pa.int64()), ("found", pa.binary()), ("id", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("a", pa.int64())])
WORD_COLUMNS = "shard long, found binary, id long, lang string, word binary, a long"


def _merge_words(lists: pa.Table, least: int) -> pa.Table:
    """The frequent words of a bucket (id, lang, word, a) and, per shard that has any, its own ids of them and these."""
    bucket = lists.column("bucket")[0].as_py()
    rows = [lists.column(x).to_pylist() for x in ("lang", "shard", "words", "counts")]
    total: dict[str, Counter] = {}
    for lang, _, words, counts in zip(*rows, strict=True):
        sums = total.setdefault(lang, Counter())
        for word, n in zip(unpack_words(words), unpack_longs(counts, 2)[1].tolist(), strict=True):
            sums[word] += n
    known = {}
    out = []
    for lang, sums in sorted(total.items()):
        for word in sorted(w for w, n in sums.items() if n >= least):
            known[lang, word] = (bucket << 32) + len(known)
            out.append({"id": known[lang, word], "lang": lang, "word": word, "a": sums[word]})
    for lang, shard, words, counts in zip(*rows, strict=True):
        ids = np.array([known.get((lang, w), -1) for w in unpack_words(words)], np.int64)
        if (ids >= 0).any():
            out.append({"shard": shard, "found": pack_longs(unpack_longs(counts, 2)[0][ids >= 0], ids[ids >= 0])})
    return pa.Table.from_pylist(out, WORD_SCHEMA)


# ------------------------------------------------------------------- index

def transform(ids: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Burrows-Wheeler transform over suffixes sorted by their first `depth` words at least (ranks are doubled)."""
    rank, k = ids.astype(np.int64), 1
    while True:
        after = np.zeros_like(rank)
        after[:-k] = rank[k:]
        key = rank * (int(rank.max(initial=0)) + 1) + after
        order = np.argsort(key, kind="stable")
        k *= 2
        if k >= depth:
            return ids[order - 1]
        rank = np.empty_like(order)
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])


def words_of(bwt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and number of each word's suffixes."""
    n = np.bincount(bwt)
    return np.cumsum(n) - n, n


def extend(bwt: np.ndarray, lo: np.ndarray, other: np.ndarray, n: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Extends each phrase by every word before it (after it, with the transform and places of the reversed text).

    A phrase is its interval [lo, lo + n) in the order of `bwt`, the start
    `other` of its interval in the reversed order, and its id. Returns of each
    new phrase both of whose parts are given: the id of the part that holds the
    new word, the id of the extended part, n, and both new starts.
    """
    by = np.argsort(lo, kind="stable")
    lo, other, n, ids = lo[by], other[by], n[by], ids[by]
    begin = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(lo)), n)
    place = np.arange(len(owner)) - begin[owner] + lo[owner]
    word = bwt[place]
    key = owner * (int(bwt.max(initial=0)) + 1) + word
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(order) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(order)))
    first = order[starts]
    # where a suffix goes when the word before it is put in front: words in order, equal ones as they stood
    step = np.empty(len(bwt), np.int64)
    step[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    new_lo, new_other = step[place[first]], other[owner[first]] + starts - begin[owner[first]]
    at = np.searchsorted(lo, new_lo, "right") - 1
    keep = (word[first] != 0) & (at >= 0)
    keep[keep] = new_lo[keep] < lo[at[keep]] + n[at[keep]]
    return ids[at[keep]], ids[owner[first[keep]]], counts[keep], new_lo[keep], new_other[keep]


#: per shard a row with its index and the ids of its words, and one a bucket with the sums of its slots there
INDEX_SCHEMA = pa.schema([("shard", pa.int64()), ("ahead", pa.binary()), ("back", pa.binary()), ("names", pa.binary()), ("bucket", pa.int64()), ("marks", pa.binary())])
INDEX_COLUMNS = "shard long, ahead binary, back binary, names binary, bucket long, marks binary"
HEAVY_SCHEMA = pa.schema([("shard", pa.int64()), ("bucket", pa.int64()), ("found", pa.binary())])
HEAVY_COLUMNS = "shard long, bucket long, found binary"


def _marks(shard: int, buckets: int, slots: int, p: np.ndarray, s: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Occurrences of a shard's phrases by slot, a hash of their parts: one list a bucket of so many slots."""
    at, slot = np.unique(bucket_of(p, s, buckets * slots), return_inverse=True)
    sums = np.bincount(slot, n).astype(np.int64)
    starts = np.flatnonzero(np.diff(at // slots, prepend=-1))
    ends = np.append(starts[1:], len(at))
    for i in range(0, len(starts), LISTS):
        lists = [pack_longs(np.diff(at[x:y] % slots, prepend=0), sums[x:y]) for x, y in zip(starts[i : i + LISTS], ends[i : i + LISTS], strict=True)]
        k = len(lists)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(k, shard), pa.int64()), *(pa.nulls(k, pa.binary()) for _ in range(3)), pa.array(at[starts[i : i + LISTS]] // slots), pa.array(lists, pa.binary())], schema=INDEX_SCHEMA)


def _weigh(lists: pa.Table, least: int, slots: int) -> pa.Table:
    """The slots of a bucket that hold a frequent phrase or as many rare ones, per shard that has any: its own of them."""
    bucket, total, own = lists.column("bucket")[0].as_py(), np.zeros(slots, np.int64), []
    for x in lists.column("marks"):
        at, n = unpack_longs(x.as_py(), 2)
        own.append(np.cumsum(at))
        total[own[-1]] += n
    heavy = [at[total[at] >= least] for at in own]
    return pa.Table.from_pylist([{"shard": shard, "bucket": bucket, "found": pack_longs(np.diff(at, prepend=0))} for shard, at in zip(lists.column("shard").to_pylist(), heavy, strict=True) if len(at)], HEAVY_SCHEMA)


def _heavy(hits: pa.ListScalar, buckets: int, slots: int, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The phrases (p, s, ...) of a shard that lie in its slots given."""
    found = np.concatenate([x["bucket"].as_py() * slots + np.cumsum(unpack_longs(x["found"].as_py(), 1)[0]) for x in hits])
    keep = np.isin(bucket_of(*columns[:2], buckets * slots), found)
    return tuple(x[keep] for x in columns)


#: per shard a row with the intervals of its phrases, and one a bucket with the phrases dealt to it
STEP_SCHEMA = pa.schema([("shard", pa.int64()), ("starts", pa.binary()), ("places", pa.binary()), ("bucket", pa.int64()), ("pairs", pa.binary())])
STEP_COLUMNS = "shard long, starts binary, places binary, bucket long, pairs binary"


def _phrase_rows(shard: int, buckets: int, p: np.ndarray, s: np.ndarray, n: np.ndarray, lo: np.ndarray, rlo: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(p):
        return
    at = bucket_of(p, s, buckets)
    by = np.lexsort((lo, at))
    at, p, s, n, lo, rlo = (x[by] for x in (at, p, s, n, lo, rlo))
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    yield pa.RecordBatch.from_pylist([{"shard": shard, "starts": pack_longs(at[starts], starts), "places": pack_longs(np.diff(lo, prepend=0), rlo, n)}], STEP_SCHEMA)
    ends = np.append(starts[1:], len(at))
    for i in range(0, len(starts), LISTS):
        lists = [pack_longs(p[x:y], s[x:y], n[x:y]) for x, y in zip(starts[i : i + LISTS], ends[i : i + LISTS], strict=True)]
        k = len(lists)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(k, shard), pa.int64()), *(pa.nulls(k, pa.binary()) for _ in range(2)), pa.array(at[starts[i : i + LISTS]]), pa.array(lists, pa.binary())], schema=STEP_SCHEMA)


MERGED_SCHEMA = pa.schema([("shard", pa.int64()), ("bucket", pa.int64()), ("found", pa.binary()), ("id", pa.int64()), ("p", pa.int64()), ("s", pa.int64()), ("a", pa.int64())])
MERGED_COLUMNS = "shard long, bucket long, found binary, id long, p long, s long, a long"


def _merge(lists: pa.Table, least: int) -> pa.Table:
    """The frequent phrases of a bucket (id, p, s, a) and, per shard that has any, their places in its list and their ids."""
    bucket, shards = lists.column("bucket")[0].as_py(), lists.column("shard").to_pylist()
    parts = [unpack_longs(x.as_py(), 3) for x in lists.column("pairs")]
    p, s, n = np.concatenate(parts, axis=1)
    order = np.lexsort((s, p))
    p, s = p[order], s[order]
    new = np.concatenate([[True], (np.diff(p) != 0) | (np.diff(s) != 0)])
    first = np.flatnonzero(new)
    a = np.add.reduceat(n[order], first)
    keep = a >= least
    ids = np.where(keep, (bucket << 32) + np.cumsum(keep) - 1, -1)
    each = np.empty(len(p), np.int64)
    each[order] = ids[np.cumsum(new) - 1]
    k = int(keep.sum())
    out = [pa.RecordBatch.from_arrays([*(pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.binary())), *(pa.array(x[keep]) for x in (ids, p[first], s[first], a))], schema=MERGED_SCHEMA)]
    rows, begin = [], 0
    for shard, part in zip(shards, parts, strict=True):
        own = each[begin : begin + part.shape[1]]
        begin += part.shape[1]
        at = np.flatnonzero(own >= 0)
        if len(at):
            rows.append({"shard": shard, "bucket": bucket, "found": pack_longs(at, own[at])})
    out.append(pa.RecordBatch.from_pylist(rows, MERGED_SCHEMA))
    return pa.Table.from_batches(out, MERGED_SCHEMA)


def _pairs(ahead: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, ...]:
    """The bigrams of a shard (p, s, n and both starts); `names` are the ids of its words."""
    lo, n = words_of(ahead)
    lo, n = lo[1:], n[1:]
    return extend(ahead, lo, lo, n, names)


def _index(batches: Iterator[pa.RecordBatch], buckets: int, slots: int) -> Iterator[pa.RecordBatch]:
    """Index of each shard (one row), and its bigrams of frequent words by slot."""
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1)
            shard, ids = row.column(0)[0].as_py(), unpack_ids(row.column(1)[0].as_py())
            idx, names = np.concatenate([unpack_longs(x["found"].as_py(), 2) for x in row.column(2)[0]], axis=1)
            counts = np.bincount(ids, minlength=int(idx.max()) + 1)
            by = np.argsort(-counts[idx], kind="stable")  # small numbers for frequent words
            table = np.zeros(len(counts), np.int64)
            table[idx[by]] = np.arange(1, len(idx) + 1)
            text = np.concatenate([[0], table[ids]])
            text = text[np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])]  # one separator is as good as many
            if text[-1] != 0:
                text = np.append(text, 0)
            ahead, back = transform(text), transform(text[::-1])
            yield pa.RecordBatch.from_pylist([{"shard": shard, "ahead": pack_ids(ahead), "back": pack_ids(back), "names": pack_longs(names[by])}], INDEX_SCHEMA)
            yield from _marks(shard, buckets, slots, *_pairs(ahead, names[by])[:3])


def _bigrams(batches: Iterator[pa.RecordBatch], buckets: int, slots: int) -> Iterator[pa.RecordBatch]:
    """The bigrams of each shard in its heavy slots."""
    for b in batches:
        for i in range(b.num_rows):
            shard, ahead, names, heavy = (c[i] for c in b.columns)
            found = _pairs(unpack_ids(ahead.as_py()), unpack_longs(names.as_py(), 1)[0])
            yield from _phrase_rows(shard.as_py(), buckets, *_heavy(heavy, buckets, slots, *found))


def _longer(batches: Iterator[pa.RecordBatch], left: bool, buckets: int, slots: int) -> Iterator[pa.RecordBatch]:
    """The phrases of each shard, one word longer than those given: by slot, or with its heavy slots those in them."""
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1)
            shard, bwt = row.column(0)[0].as_py(), unpack_ids(row.column(1)[0].as_py())
            at, starts = unpack_longs(row.column(2)[0].as_py(), 2)
            lo, rlo, n = unpack_longs(row.column(3)[0].as_py(), 3)
            lo = np.cumsum(lo)
            places, ids = [], []
            for hit in row.column(4)[0]:
                place, found = unpack_longs(hit["found"].as_py(), 2)
                places.append(place + starts[np.searchsorted(at, hit["bucket"].as_py())])
                ids.append(found)
            place, names = np.concatenate(places), np.concatenate(ids)
            lo, rlo, n = lo[place], rlo[place], n[place]
            if left:
                p, s, n, lo, rlo = extend(bwt, lo, rlo, n, names)
            else:
                s, p, n, rlo, lo = extend(bwt, rlo, lo, n, names)
            if b.num_columns > 5:
                yield from _phrase_rows(shard, buckets, *_heavy(row.column(5)[0], buckets, slots, p, s, n, lo, rlo))
            else:
                yield from _marks(shard, buckets, slots, p, s, n)


# --------------------------------------------------------------- all shards

def phrases(spark: SparkSession, documents: DataFrame, least: int = LEAST, depth: int = DEPTH, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """Words of each lang (lang, n), and a table of the frequent phrases of each length.

    Columns: id, lang, phrase, last (its last word), a, pre and suf (counts of
    its prefixes and suffixes by length), p and s (ids of the parts without
    the last and without the first word).
    """
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    parts = max(texts.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    made = shared_by(spark, texts.mapInArrow(lambda b: _shards(b, shard_words), TEXT_SCHEMA), "phrases-shards", "shard", parts)
    totals = made.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0")
    words = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-words // shard_words))
    dealt = made.where("n > 0").select("lang", "shard", "words", "counts").mapInArrow(lambda b: _deal(b, buckets), DEALT_COLUMNS)
    found = shared(spark, dealt.groupBy("bucket").applyInArrow(lambda t: _merge_words(t, least), WORD_COLUMNS), "phrases-words")
    level = found.where("id is not null").select("id", "lang", F.col("word").cast("string").alias("phrase"), F.col("word").cast("string").alias("last"), "a", F.array("a").alias("pre"), F.array("a").alias("suf"), F.lit(None).cast("long").alias("p"), F.lit(None).cast("long").alias("s"))
    levels = [shared(spark, level, "phrases-1")]
    back = found.where("found is not null").repartition(parts, "shard").groupBy("shard").agg(F.collect_list(F.struct("found")).alias("found"))  # lists of one shard
    slots = -(-shard_words // WORDS_A_SLOT)
    index = made.where("ids is not null").select("shard", "ids").join(back, "shard").mapInArrow(lambda b: _index(b, buckets, slots), INDEX_COLUMNS)
    marks = index = shared_by(spark, index, "phrases-index", "shard", parts)
    side = index.where("ahead is not null").select("shard", "ahead", "names")
    for m in range(2, depth + 1):
        heavy = marks.where("marks is not null").select("shard", "bucket", "marks").groupBy("bucket").applyInArrow(lambda t: _weigh(t, least, slots), HEAVY_COLUMNS)
        heavy = shared(spark, heavy, "phrases-heavy").repartition(parts, "shard").groupBy("shard").agg(F.collect_list(F.struct("bucket", "found")).alias("heavy"))  # lists of one shard
        left = m % 2 == 0
        step = side.join(heavy, "shard").mapInArrow((lambda b: _bigrams(b, buckets, slots)) if m == 2 else (lambda b, left=left: _longer(b, left, buckets, slots)), STEP_COLUMNS)
        step = shared_by(spark, step, "phrases-step", "shard", parts)
        merged = step.where("pairs is not null").select("shard", "bucket", "pairs").groupBy("bucket").applyInArrow(lambda t: _merge(t, least), MERGED_COLUMNS)
        merged = shared(spark, merged, "phrases-merged")
        first = levels[-1].select(F.col("id").alias("p"), "lang", F.col("phrase").alias("begin"), "pre")
        rest = levels[-1].select(F.col("id").alias("s"), "last", "suf")
        level = merged.where("id is not null").select("id", "p", "s", "a").join(first, "p").join(rest, "s")
        level = level.select("id", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "a", F.concat("pre", F.array("a")).alias("pre"), F.concat("suf", F.array("a")).alias("suf"), "p", "s")
        levels.append(shared(spark, level, f"phrases-{m}"))
        if m < depth:
            left = m % 2 == 1
            back = merged.where("found is not null").repartition(parts, "shard").groupBy("shard").agg(F.collect_list(F.struct("bucket", "found")).alias("hits"))  # lists of one shard
            side = index.where("ahead is not null").select("shard", F.col("ahead" if left else "back").alias("bwt"))
            side = side.join(step.where("places is not null").select("shard", "starts", "places"), "shard").join(back, "shard")
            marks = shared(spark, side.mapInArrow(lambda b, left=left: _longer(b, left, buckets, slots), INDEX_COLUMNS), "phrases-marks")
    return totals, levels


def collocations(spark: SparkSession, documents: DataFrame, least: int = LEAST, depth: int = DEPTH, top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The best phrases of each lang: lang, rank, phrase, a, l, r, n, score."""
    totals, levels = phrases(spark, documents, least, depth, shard_words)
    kept = []
    for m, level in enumerate(levels[1:], 2):
        if m < depth:
            # counts only fall with the length, so a covering phrase of any length shows in one that is a word longer
            covers = levels[m].select(F.explode(F.array("p", "s")).alias("id"), "a").distinct()
            level = level.join(covers, ["id", "a"], "left_anti")
        kept.append(level.select("lang", "phrase", "a", "pre", "suf", F.lit(m).alias("m")))
    rows = kept[0]
    for x in kept[1:]:
        rows = rows.unionByName(x)
    wide = lambda c: c.cast("decimal(19,0)")
    rows = rows.join(totals, "lang").withColumn("top", F.lit(1000).cast("decimal(4,0)") * (wide(F.col("a")) * wide(F.col("n"))))
    rows = rows.withColumn("cuts", F.transform(F.sequence(F.lit(1), F.col("m") - 1), lambda k: F.struct(
        k.alias("k"), F.get("pre", k - 1).alias("l"), F.get("suf", F.col("m") - k - 1).alias("r"))))
    rows = rows.withColumn("cuts", F.expr("transform(cuts, x -> struct(top div (cast(x.l as decimal(19,0)) * cast(x.r as decimal(19,0))) as score, x.k as k, x.l as l, x.r as r))"))
    rows = rows.withColumn("cut", F.array_min("cuts")).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, read(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
  regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
grams AS ({' UNION ALL '.join(f"SELECT lang, {k} AS m, unnest(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS phrase FROM w WHERE len(w) >= {k}" for k in range(1, DEPTH + 1))}),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= {LEAST}),
inner_parts AS (SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM c, range(2, {DEPTH}) t(k), range(1, {DEPTH}) u(i) WHERE k < m AND i + k - 1 <= m),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM inner_parts p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 100 * c.a)),
cuts AS (SELECT kept.*, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM kept JOIN range(1, {DEPTH}) t(k) ON k < kept.m JOIN total USING (lang)
  JOIN f x ON x.lang = kept.lang AND x.phrase = array_to_string(w[1:k], ' ') JOIN f y ON y.lang = kept.lang AND y.phrase = array_to_string(w[k + 1:kept.m], ' ')),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best WHERE pick = 1)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {TOP}"""
