"""Near-duplicate documents by HyperMinHash (operator 3).

Every document becomes the set of its distinct word shingles. A signature has
BANDS x ROWS buckets; bucket i keeps the minimum of the i-th hash function,
stored as its count of leading zeros and the ten mantissa bits that follow
(two bytes). Bands of five registers give the candidates, an estimate of the
Jaccard index that is corrected for chance collisions of registers drops
those far below the threshold, and the full shingle sets confirm every link.

A pair at the threshold of 0.8 misses all 32 bands with probability 3e-6, and
the estimate drops it with less than 1e-8 (six standard deviations).

Groups of copies never become all pairs. Documents with equal sets share one
class. Inside a band's bucket every class meets only the smallest one (a
star); after these links are joined into components, members outside the
centre's component meet the members of other components, in blocks and on
full sets. No bucket is capped.

Rows with a null text or without words have an empty set and link with
nothing. A null doc_id takes no part in links and is kept. Rows that repeat a
doc_id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.llm.common import components, read, shared

BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
MANTISSA_BITS = 10
SIGMAS = 6.0
BLOCK = 128
WORD_CACHE = 400_000

_rng = np.random.default_rng(20_260_301)
_MULTIPLIERS = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_words: dict[bytes, int] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a whole text.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text
    with fewer than k words is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > WORD_CACHE:
        _words.clear()
    h = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        v = _words.get(w)
        if v is None:
            v = _words[w] = xxhash.xxh3_64_intdigest(w)
        h[i] = v
    n = max(1, len(words) - k + 1)
    out = np.full(n, min(k, len(words)), np.uint64)
    for j in range(min(k, len(words))):
        out = _mix(out * _MIX + h[j : j + n])
    return np.unique(out)


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (uint16) of a shingle set that is not empty."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(shingles), 512):
        np.minimum(low, (shingles[s : s + 512, None] * _MULTIPLIERS).min(axis=0), out=low)
    m, e = np.frexp((low >> np.uint64(11)).astype(np.float64))
    mantissa = np.clip((m * 2 - 1) * 2**MANTISSA_BITS, 0, 2**MANTISSA_BITS - 1).astype(np.uint16)
    return ((53 - e).astype(np.uint16) << MANTISSA_BITS) | mantissa


def _chance(sizes: int = 28) -> np.ndarray:
    """Chance that two registers of independent sets of 2^i and 2^j shingles are equal."""
    edges = np.concatenate([2.0 ** -(z + 1) * (1 + np.arange(2**MANTISSA_BITS) / 2**MANTISSA_BITS) for z in range(40)])
    width = np.repeat(2.0 ** -(np.arange(40) + 1.0 + MANTISSA_BITS), 2**MANTISSA_BITS)
    p = [np.exp(-(2.0**i) * edges) - np.exp(-(2.0**i) * (edges + width)) for i in range(sizes)]
    return np.array([[(a * b).sum() for b in p] for a in p])


CHANCE = _chance()


def jaccard_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Share of equal registers per row, corrected for chance collisions."""
    top = len(CHANCE) - 1
    i, j = (np.clip(np.round(np.log2(np.maximum(x, 1))).astype(int), 0, top) for x in (na, nb))
    c = CHANCE[i, j]
    return ((a == b).mean(axis=1) - c) / (1 - c)


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, n, d1, d2, sig = b.column(0), [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, k)
                n.append(len(s))
                raw = xxhash.xxh3_128_digest(s.tobytes())
                d1.append(int.from_bytes(raw[:8], "little", signed=True) if len(s) else None)
                d2.append(int.from_bytes(raw[8:], "little", signed=True) if len(s) else None)
                sig.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sig, pa.binary())], names=["doc_id", "n", "d1", "d2", "sig"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t, k).tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["id", "shingles"])

    return run


def _likely(threshold: float):
    floor = threshold - SIGMAS * (threshold * (1 - threshold) / REGISTERS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in (2, 3))
                keep = jaccard_estimate(x, y, b.column(4).to_numpy(), b.column(5).to_numpy()) >= floor
                yield b.select([0, 1]).filter(pa.array(keep))

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(docs: DataFrame, sigs: DataFrame, pairs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """Of the candidate pairs (a, b), those whose full sets meet the threshold."""
    spark = docs.sparkSession
    x = sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa"), F.col("n").alias("na"))
    y = sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb"), F.col("n").alias("nb"))
    near = pairs.join(x, "a").join(y, "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    near = near.select("a", "b", "sa", "sb", "na", "nb").mapInArrow(_likely(percent / 100), "a long, b long")
    near = shared(spark, near, f"{name}-likely")
    ids = near.select(F.explode(F.array("a", "b")).alias("id")).distinct().hint("merge")
    sets = docs.join(ids, docs.doc_id == ids.id, "left_semi").mapInArrow(_sets(k), "id long, shingles binary")
    sets = shared(spark, sets, f"{name}-sets")
    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    full = near.join(x, "a").join(y, "b").select("a", "b", "sa", "sb").mapInArrow(_confirm(percent), "a long, b long")
    return shared(spark, full, f"{name}-links")


def _blocks(percent: int):
    """Compares, per (key, member block, outsider block), outsiders with members of other parts.

    Reads rows sorted by block; a block holds at most a few hundred sets.
    Yields only links that join two parts, a spanning forest of the block.
    """

    def compare(rows: list[tuple]) -> list[tuple[int, int]]:
        members, outsiders = ([r for r in rows if r[0] == side] for side in (0, 1))
        if not members or not outsiders:
            return []
        sets = [np.frombuffer(r[3], np.uint64) for r in members]
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        sizes, root, out = np.array([len(x) for x in sets]), {}, []

        def find(p):
            while root.setdefault(p, p) != p:
                p = root[p]
            return p

        for _, i, part, raw in outsiders:
            x = np.frombuffer(raw, np.uint64)
            at = np.minimum(np.searchsorted(x, values), len(x) - 1)
            both = np.bincount(owner[x[at] == values], minlength=len(sets))
            for j in np.flatnonzero(100 * both >= percent * (sizes + len(x) - both)):
                p, q = find(part), find(members[j][2])
                if p != q:
                    root[p] = q
                    out.append((i, members[j][1]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def close():
            found = compare(rows)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        for b in batches:
            for k, mb, ob, *row in zip(*(b.column(c).to_pylist() for c in range(7)), strict=True):
                if (k, mb, ob) != key:
                    if rows:
                        yield close()
                    key, rows = (k, mb, ob), []
                rows.append(tuple(row))
        if rows:
            yield close()

    return run


def _cross_links(docs: DataFrame, buckets: DataFrame, groups: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between members of one bucket that the stars left in different components.

    Outsiders of a bucket (members outside the component of its star's centre)
    meet every member of another component, on full sets. The comparison runs
    in blocks of about BLOCK members by BLOCK outsiders, so a bucket of any
    size is spread over tasks and no pair is written unless it is a link.
    """
    spark = docs.sparkSession
    placed = buckets.join(groups, "id", "left").select("key", "lead", "id", F.coalesce("component", "id").alias("part"))
    placed = shared(spark, placed, "minhash-placed")
    own = placed.groupBy("key").agg(F.max(F.when(F.col("id") == F.col("lead"), F.col("part"))).alias("own"), F.count("*").alias("members"))
    sized = placed.join(own, "key").select("key", "id", "part", "members", (F.col("part") != F.col("own")).alias("out"))
    outsiders = sized.where("out").groupBy("key").agg(F.count("*").alias("outsiders"))
    # a bucket of two is settled by its star
    rows = sized.where("members > 2").join(outsiders, "key")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    spread = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    spot = lambda c: F.pmod(F.xxhash64("id"), blocks(c)).cast("int")
    members = rows.select("key", spot("members").alias("mb"), spread("outsiders").alias("ob"), F.lit(0).alias("side"), "id", "part")
    others = rows.where("out").select("key", spread("members").alias("mb"), spot("outsiders").alias("ob"), F.lit(1).alias("side"), "id", "part")
    rows = shared(spark, members.unionByName(others), "minhash-blocks")
    sets = docs.join(rows.select("id").distinct().hint("merge"), docs.doc_id == F.col("id"), "left_semi").mapInArrow(_sets(k), "id long, shingles binary")
    rows = rows.join(sets, "id").select("key", "mb", "ob", "side", "id", "part", "shingles")
    return shared(spark, rows.repartition("key", "mb", "ob").sortWithinPartitions("key", "mb", "ob").mapInArrow(_blocks(percent), "a long, b long"), "minhash-cross-links")


def near_duplicates(spark: SparkSession, documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of `documents`: doc_id, n_shingles, component_id, kept."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sigs = shared(spark, docs.mapInArrow(_signatures(k), "doc_id long, n long, d1 long, d2 long, sig binary"), "minhash-signatures")
    classes = sigs.where("doc_id is not null and n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    classes = shared(spark, classes, "minhash-classes")
    reps = sigs.where("doc_id is not null and n > 0").join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    reps = shared(spark, reps.dropDuplicates(["doc_id"]).select("doc_id", "n", "sig"), "minhash-representatives")

    width = 2 * ROWS
    bands = reps.select("doc_id", "sig", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    bands = bands.select(F.xxhash64("band", F.expr(f"substring(sig, band * {width} + 1, {width})")).alias("key"), F.col("doc_id").alias("id"))
    live = bands.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead <> last").drop("last")
    buckets = shared(spark, bands.join(live, "key"), "minhash-buckets")

    stars = buckets.where("lead <> id").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = _confirmed(docs, reps, stars, k, percent, "minhash-star")
    groups = components(spark, links, "minhash-star")

    more = _cross_links(docs, buckets, groups, k, percent)
    groups = components(spark, links.unionByName(more), "minhash-all")

    member = sigs.join(classes, ["d1", "d2"], "left").join(groups.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.least(F.coalesce("component", "rep", "doc_id"), F.col("doc_id"))
    return member.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, read(spark, sf_dir, "documents"), k=2, percent=80)
