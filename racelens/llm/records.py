"""Token ids as length-delimited binary records (operator 10).

Format, all integers little-endian. A record file is a row of frames:

    u64 length | u32 masked crc of the length | payload | u32 masked crc of the payload

The mask turns the crc32 right by 15 bits and adds 0xA282EAD8, so a frame that
holds frames does not check by chance. A payload is

    u8 flags (1: doc_id is null, 2: ids take 4 bytes, else 2) | i64 doc_id | ids

Ids take two bytes where the vocabulary allows it. Beside each record file
stands an index: u64 offset of the frame | u32 payload length, per record, in
the order of the file. A reader can seek to any record by it, so shuffled
reads need no scan.

Files hold ranges of doc_id in ascending order (null first), one file per
Spark partition. A task writes to a name of its own attempt and renames at the
end, so a retry or a second attempt never leaves half a file. Files are opened
through the file system of their address (pyarrow.fs), by tasks only.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelens.llm.bpe import vocabulary
from racelens.llm.common import read, shared
from racelens.llm.words import encoder
from racelens.session import scratch_path

HEAD, START = "<QI", "<Bq"  # of a frame, of a payload
HEAD_SIZE, START_SIZE = struct.calcsize(HEAD), struct.calcsize(START)
INDEX = np.dtype([("offset", "<u8"), ("length", "<u4")])
BLOCK = 4096
END_ID = 2


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def payload(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    """`ids` are unsigned 32-bit; they are stored with two bytes each unless `wide`."""
    kept = ids if wide else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return struct.pack(START, (doc_id is None) | wide << 1, doc_id or 0) + kept


def parse(raw: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from(START, raw)
    return None if flags & 1 else doc_id, np.frombuffer(raw, "<u4" if flags & 2 else "<u2", offset=START_SIZE).astype("<u4")


def unframe(data: bytes, at: int = 0) -> bytes:
    """The payload of the frame at a place; ValueError if it is cut off or a checksum is wrong."""
    if len(data) < at + HEAD_SIZE:
        raise ValueError("frame is cut off")
    size, check = struct.unpack_from(HEAD, data, at)
    body = data[at + HEAD_SIZE : at + HEAD_SIZE + size]
    end = data[at + HEAD_SIZE + size : at + HEAD_SIZE + size + 4]
    if check != masked(data[at : at + 8]) or len(end) < 4 or struct.unpack("<I", end)[0] != masked(body):
        raise ValueError("checksum of a frame is wrong")
    return body


def _open(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(address if ":" in address else f"file://{address}")


def _write(folder: str, path: str, end_id: int):
    """Each partition becomes one record file with its index; yields a row about it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, task = encoder(path), TaskContext.get()
        end, wide = np.uint32(end_id).tobytes(), code.size > 65536
        store, base = _open(folder)
        name, own = f"{base}/part-{task.partitionId():06d}", f"{base}/_attempt-{task.taskAttemptId()}"
        index, at, tokens, out = [], 0, 0, None
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if out is None:
                    out = store.open_output_stream(f"{own}.rec")
                ids = code.encode(text) + end
                body = payload(doc_id, ids, wide)
                out.write(frame(body))
                index.append((at, len(body)))
                at += len(body) + HEAD_SIZE + 4
                tokens += len(ids) // 4
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{own}.idx") as f:
            f.write(np.array(index, INDEX).tobytes())
        for kind in ("rec", "idx"):
            store.move(f"{own}.{kind}", f"{name}.{kind}")
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32()), pa.array([f"{os.path.basename(name)}"]), pa.array([len(index)], pa.int64()), pa.array([tokens], pa.int64())], names=["part", "file", "records", "tokens"])

    return run


def write_records(spark: SparkSession, documents: DataFrame, path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Writes all documents to `folder`; returns its manifest (part, file, records, tokens)."""
    spark.createDataFrame([(1,)], "format int").write.mode("overwrite").parquet(f"{folder}/_format")  # makes the folder, on any store
    docs = documents.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    rows = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return shared(spark, rows.mapInArrow(_write(folder, path, end_id), "part int, file string, records long, tokens long"), "record-manifest")


def _read(folder: str):
    """Reads blocks (file, first record, tokens before the file) through the index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        for b in batches:
            for file, first, before in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with store.open_input_file(f"{base}/{file}.idx") as f:
                    index = np.frombuffer(f.read(), INDEX)
                rows = []
                with store.open_input_file(f"{base}/{file}.rec") as f:
                    f.seek(int(index["offset"][0]))
                    wide = f.read(HEAD_SIZE + 1)[-1] >> 1 & 1
                    start = before + int(((index["length"][:first].astype(np.int64) - START_SIZE) // (4 if wide else 2)).sum())
                    for offset, length in index[first : first + BLOCK].tolist():
                        f.seek(offset)
                        doc_id, ids = parse(unframe(f.read(length + HEAD_SIZE + 4)))
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), ids.astype(np.int32)))
                        start += len(ids)
                        if len(rows) == 256:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    def _rows(rows):
        c = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in c[:4]), pa.array(c[4], pa.list_(pa.int32()))], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return run


def read_records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """All records of a folder: doc_id, start, n_tokens, ids_crc32, ids. Checks every frame."""
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row per file
    files = manifest.withColumn("before", F.coalesce(before, F.lit(0)))
    blocks = files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("records") - 1, F.lit(BLOCK).cast("long"))).alias("first"), "before")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return blocks.repartition(parts, "file", "first").mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    manifest = write_records(spark, read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), folder)
    return read_records(spark, folder, manifest).drop("ids")
