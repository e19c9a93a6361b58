"""Line dedup by a deletion-neighbourhood join (operator 6).

A line is dropped if an earlier line, by (doc_id, row, place), is equal or lies
within one edit (a character put in, left out or replaced), white space at its
ends aside. Among lines shorter than MIN_CHARS only equal ones go: there, one
edit is another word. Blank lines stay.

Equal lines collapse first, to one class with its earliest place. Lines within
one edit share a variant: both without the same character at the same place
(replaced), or one without a character is the other. All variants of the edit
are emitted as hashed keys, equal keys are joined, the distance is verified on
the texts, and the earliest stays. A key that many lines share is settled by
its smallest place, never by pairs.

Variants are only emitted for lines that can have a partner. One edit leaves
all but one of SEGMENTS pieces of a line alone, so partners share the hash of
the line without that piece; a line without such a shared anchor has none, and
one with it emits the variants of that piece alone. Which anchors are shared
is counted over all lines. A bitmap of fixed size (BITMAP bits) of them goes
with the tasks to skip most other lines; the exact join follows.

Null doc_ids take no part and keep their lines; rows that repeat a doc_id and
its text are one document, rows of one doc_id with different texts are several,
ordered by the checksum of the text. A null text has no lines and stays null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.llm.common import read, shared

MIN_CHARS = 24  # for one edit; equal lines go at any length
SEGMENTS = 4
STEP = 16
BITMAP = 1 << 25
PAGE = 32_768  # bits of one bitmap of Spark's bitmap functions

_BASE = 0x9E3779B97F4A7C15


def filled(text: str | None) -> Iterator[tuple[int, str]]:
    """(place, line) of the lines that are not blank, ends stripped."""
    for n, line in enumerate((text or "").split("\n")):
        line = line.strip()
        if line:
            yield n, line


def _halves(lines: list[str]) -> np.ndarray:
    """Both halves of the hash of each line, as columns."""
    raw = b"".join([xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines])
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


def _signed(hashes: list[int]) -> pa.Array:
    return pa.array(np.array(hashes, np.uint64).view(np.int64))


def anchors(line: str) -> list[tuple[int, int, int]]:
    """(hash of the line without one piece, start and end of the piece), per piece.

    Pieces are cut by a base length, the length rounded down to STEP, so lines
    whose lengths differ by one share a base; at the step a line has both.
    """
    n, out = len(line), []
    raw = line.encode("utf-32-le", "surrogatepass")  # four bytes a character
    for base in {n - n % STEP, (n - 1) - (n - 1) % STEP}:
        for piece in range(SEGMENTS):
            head, end = piece * base // SEGMENTS, n - base + (piece + 1) * base // SEGMENTS
            key = raw[: 4 * head] + raw[4 * end :]  # base and piece, the seed, say where one part ends
            out.append((xxhash.xxh3_64_intdigest(key, base * SEGMENTS + piece), head, end))
    return out


def variants(line: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the line without character i, for start <= i < end, and with its place.

    Polynomial hashes of the parts before and behind i, put together.
    """
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = (codes + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    codes ^= codes >> np.uint64(32)
    n = len(codes)
    powers = np.cumprod(np.full(n + 1, _BASE, np.uint64)) * np.uint64(pow(_BASE, -1, 1 << 64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * powers[:n], dtype=np.uint64)])
    i = np.arange(start, end)
    # the part behind i moves one place to the front
    gone = sums[i] + (sums[n] - sums[i + 1]) * np.uint64(pow(_BASE, -1, 1 << 64))
    return _finish(gone, n - 1, 0), _finish(gone, n - 1, i + 1)


def whole(line: str) -> int:
    """Hash of a line as a variant of a longer one."""
    n = len(line)
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    codes = (codes + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    codes ^= codes >> np.uint64(32)
    powers = np.cumprod(np.full(n + 1, _BASE, np.uint64)) * np.uint64(pow(_BASE, -1, 1 << 64))
    return int(_finish(np.array([(codes * powers[:n]).sum(dtype=np.uint64)]), n, 0)[0])


def _finish(h: np.ndarray, length: int, place: int | np.ndarray) -> np.ndarray:
    mark = np.array([length], np.uint64) * np.uint64(0xA0761D6478BD642F) + np.atleast_1d(np.asarray(place, np.uint64)) * np.uint64(0xE7037ED1A0B428DB)
    h = h + mark
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).astype(np.int64)


LINE_SCHEMA = "h1 long, h2 long, doc_id long, row long, line int"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lines, places, owners, counts = [], [], [], []
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            before = len(lines)
            for n, line in filled(text):
                lines.append(line)
                places.append(n)
            if len(lines) > before:
                owners.append((doc, zlib.crc32(text.encode("utf-8", "surrogatepass"))))
                counts.append(len(lines) - before)
        if lines:
            own = np.repeat(np.array(owners, np.int64), counts, axis=0)
            columns = [*_halves(lines).T, *own.T]
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in columns), pa.array(places, pa.int32())], names=["h1", "h2", "doc_id", "row", "line"])


def _distinct(b: pa.RecordBatch) -> list[str]:
    """Lines of the batch that are long enough for one edit, each once."""
    return list({line for text in b.column(1).to_pylist() for _, line in filled(text) if len(line) >= MIN_CHARS})


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lines, keys, counts = _distinct(b), [], []
        for line in lines:
            own = anchors(line)
            keys += [a for a, _, _ in own]
            counts.append(len(own))
        yield pa.RecordBatch.from_arrays([_signed(keys), pa.array(np.repeat(_halves(lines)[:, 0], counts))], names=["anchor", "h"])


def _candidates(bitmap: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines, found, counts = [], [], []
            for line in _distinct(b):
                near = [x for x in anchors(line) if bitmap[x[0] % BITMAP >> 3] >> (x[0] & 7) & 1]
                if near:
                    lines.append(line)
                    found += near
                    counts.append(len(near))
            if lines:
                keys, starts, ends = zip(*found, strict=True)
                halves = np.repeat(_halves(lines), counts, axis=0)
                texts = pa.array(lines, pa.string()).take(pa.array(np.repeat(np.arange(len(lines)), counts)))
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in halves.T), _signed(keys), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), texts], names=["h1", "h2", "anchor", "start", "end", "text"])

    return run


def _variant_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, key, own): own marks the line itself among the longer lines that miss one character to it."""
    for b in batches:
        for h1, h2, start, end, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
            gone, placed = variants(line, start, end)
            keys = np.concatenate([np.unique(gone), placed, [whole(line)]])
            own = np.zeros(len(keys), bool)
            own[-1] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), h1)), pa.array(np.full(len(keys), h2)), pa.array(keys), pa.array(own)], names=["h1", "h2", "key", "own"])


def _bitmap(keys: DataFrame) -> bytes:
    """Bits of the anchors modulo BITMAP: at most BITMAP / PAGE rows of PAGE bits reach the driver."""
    bit = F.pmod("anchor", F.lit(BITMAP).cast("long"))
    pages = keys.select((bit / PAGE).cast("int").alias("page"), (bit % PAGE).alias("bit")).groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = bytearray(BITMAP // 8)
    for p in pages:
        out[p.page * PAGE // 8 : (p.page + 1) * PAGE // 8] = p.bits
    return bytes(out)


def _near(spark: SparkSession, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(h1, h2) of the classes with an earlier class within one edit."""
    live = docs.mapInArrow(_anchor_rows, "anchor long, h long").groupBy("anchor").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("anchor")
    live = shared(spark, live, "line-anchors")
    found = docs.mapInArrow(_candidates(_bitmap(live)), "h1 long, h2 long, anchor long, start int, end int, text string")
    found = found.dropDuplicates(["h1", "h2", "anchor"]).join(live, "anchor", "left_semi")
    found = shared(spark, found, "line-candidates")
    first = F.struct("doc_id", "row", "line", "h1", "h2")
    texts = found.dropDuplicates(["h1", "h2"]).select("h1", "h2", "text").join(classes, ["h1", "h2"])
    texts = shared(spark, texts.select("h1", "h2", "text", first.alias("first")), "line-texts")
    keys = found.select("h1", "h2", "start", "end", "text").mapInArrow(_variant_rows, "h1 long, h2 long, key long, own boolean").distinct()
    # a key of one line says nothing
    both = shared(spark, keys, "line-variants")
    many = both.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo <> hi").select("key")
    both = both.join(many, "key", "left_semi").join(texts.select("h1", "h2", "first"), ["h1", "h2"])
    both = shared(spark, both, "line-shared-variants")
    least = both.groupBy("key").agg(F.min(F.when(F.col("own"), F.col("first"))).alias("mine"), F.min(F.when(~F.col("own"), F.col("first"))).alias("other"))
    # replaced: all lines of the key are within one edit. Left out: the line itself against the longer ones.
    pairs = both.join(least, "key").withColumn("witness", F.when(F.col("own") | F.col("mine").isNull(), F.col("other")).otherwise(F.col("mine")))
    pairs = pairs.where(F.col("witness") < F.col("first")).select("h1", "h2", F.col("witness.h1").alias("w1"), F.col("witness.h2").alias("w2")).distinct()
    other = texts.select(F.col("h1").alias("w1"), F.col("h2").alias("w2"), F.col("text").alias("earlier"))
    checked = pairs.join(texts.select("h1", "h2", "text"), ["h1", "h2"]).join(other, ["w1", "w2"]).where(F.levenshtein("text", "earlier", 1) >= 0)
    return shared(spark, checked.select("h1", "h2").distinct(), "line-near")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = []
        for text, gone in zip(b.column("text").to_pylist(), b.column("_gone").to_pylist(), strict=True):
            if gone:
                gone = set(gone)
                text = "\n".join(line for n, line in enumerate(text.split("\n")) if n not in gone)
            texts.append(text)
        at = b.schema.get_field_index("text")
        yield b.set_column(at, "text", pa.array(texts, pa.string()))


def dedup_lines(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """All columns of `documents` with the remaining lines as text, and the count n_dropped.

    Columns of the input named _id, _row, _gone or n_dropped are left out.
    """
    documents = documents.drop("_id", "_row", "_gone", "n_dropped").withColumn("text", F.col("text").cast("string"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    lines = shared(spark, docs.mapInArrow(_lines, LINE_SCHEMA), "lines")
    place = F.struct("doc_id", "row", "line")
    classes = lines.groupBy("h1", "h2").agg(F.min(place).alias("at"), F.max(place).alias("last"))
    classes = shared(spark, classes.select("h1", "h2", "at.doc_id", "at.row", "at.line", (F.col("at") < F.col("last")).alias("copies")), "line-classes")
    near = _near(spark, docs, classes.drop("copies"))
    marked = classes.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("copies or near")
    marked = marked.select("h1", "h2", place.alias("at"), F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.join(marked, ["h1", "h2"]).where(F.col("near") | (place > F.col("at")))
    gone = gone.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.collect_set("line").alias("_gone"))
    same = (F.col("doc_id").cast("long") == F.col("_id")) & (F.crc32(F.col("text").cast("binary")) == F.col("_row"))
    rows = documents.join(gone.hint("merge"), same, "left").drop("_id", "_row")
    out = rows.mapInArrow(_without, rows.schema)
    return out.withColumn("n_dropped", F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long")).drop("_gone")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, n_chars and sha256 of what stays."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = dedup_lines(spark, docs.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")))
    text = F.coalesce("text", F.lit(""))
    return kept.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped", F.length(text).cast("long").alias("n_chars"), F.sha2(text.cast("binary"), 256).alias("text_sha256"))
