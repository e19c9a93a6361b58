"""Nearest neighbours by an inverted multi-index (operator 4).

The largest inner product becomes the smallest Euclidean distance by one more
component, sqrt(M^2 - |x|^2) with M the largest norm (0 for the query). Both
halves of the vectors are quantised separately; a pair of centroids is a cell.
A query visits cells in the order of their summed distances, by a heap, until
they hold the share CANDIDATES of all vectors, and ranks every vector of these
cells by its exact inner product in double precision.

The centroids are fitted on a bounded sample (vectors.SAMPLE rows); every row
is indexed. With 64 centroids a half and a share of 0.5, recall against brute
force at 20 neighbours is 0.95 on vectors without any structure.

Cells of one first-half centroid lie together. They meet the queries in
blocks, each block returns its best k + 1 for a query, and the blocks' lists
are merged. Equal vectors form one class with its k + 1 smallest ids, which
is all that an answer can hold, so a vector that is common costs one entry.

Vectors that are null, zero, hold null or non-finite components or have
another length than most take no part, neither as queries nor as answers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelens.llm.common import read, shared
from racelens.llm.vectors import blocks, kmeans, matrix, nearest, packed, runs, sample, usable, with_common_length

CENTRES = 64
CANDIDATES = 0.5
BLOCK = 2048


class MultiIndex:
    """Centroids of both halves; `cells` counts the vectors of each pair of them."""

    def __init__(self, vectors: np.ndarray, largest: float, centres: int = CENTRES):
        self.largest = largest
        x = self.lift(vectors)
        self.cut = x.shape[1] // 2
        self.halves = [kmeans(x[:, : self.cut], centres), kmeans(x[:, self.cut :], centres)]
        self.cells = np.zeros([len(h) for h in self.halves], np.int64)

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(0, self.largest**2 - (x**2).sum(axis=1)))[:, None]], axis=1)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.lift(x)
        return nearest(x[:, : self.cut], self.halves[0]), nearest(x[:, self.cut :], self.halves[1])

    def visit(self, q: np.ndarray, wanted: int) -> np.ndarray:
        """Cells in the order of summed distance until they hold `wanted` vectors, as a mask."""
        q = np.append(q, 0.0)
        near = [(h**2).sum(1) - 2 * h @ p for h, p in zip(self.halves, (q[: self.cut], q[self.cut :]), strict=True)]
        order = [np.argsort(d, kind="stable").tolist() for d in near]
        d1, d2 = (d[o].tolist() for d, o in zip(near, order, strict=True))
        seen, held, cells = np.zeros(self.cells.shape, bool), 0, self.cells.tolist()
        # row r of the heap stands at its next column; row r + 1 enters when row r leaves column 0
        heap = [(d1[0] + d2[0], 0, 0)]
        while heap and held < wanted:
            _, r, c = heapq.heappop(heap)
            i, j = order[0][r], order[1][c]
            seen[i, j] = True
            held += cells[i][j]
            if c + 1 < len(d2):
                heapq.heappush(heap, (d1[r] + d2[c + 1], r, c + 1))
            if c == 0 and r + 1 < len(d1):
                heapq.heappush(heap, (d1[r + 1] + d2[0], r + 1, 0))
        return seen


def _index_rows(index: MultiIndex, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column(1))
                i, j = index.place(x)
                vec = [r.astype(dtype).tobytes() for r in x]
                ids = [np.array(r, np.int64).tobytes() for r in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), b.column(0), pa.array(vec, pa.binary()), pa.array(ids, pa.binary())], names=["cell", "other", "id", "vec", "more"])

    return run


def _query_rows(index: MultiIndex, wanted: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for qid, q in zip(b.column(0).to_pylist(), matrix(b.column(1)), strict=True):
                seen = index.visit(q, wanted)
                vec = q.astype(dtype).tobytes()
                rows += [(int(i), qid, vec, np.packbits(seen[i]).tobytes()) for i in np.flatnonzero(seen.any(axis=1))]
            if rows:
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int32()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.binary()), pa.array(c[3], pa.binary())], names=["cell", "id", "vec", "more"])

    return run


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to smaller ids."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _rank(width: int, k: int, dtype: str):
    """Per (cell, member block, query block): every query's best k members of the cells it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 3):
            members, queries = ([r for r in rows if (r[4] >= 0) == side] for side in (True, False))
            if not members or not queries:
                continue
            x, q = (np.frombuffer(b"".join(r[5] for r in rs), dtype).astype(np.float64).reshape(len(rs), -1) for rs in (members, queries))
            other, lead = (np.array([r[c] for r in members]) for c in (4, 3))
            out = []
            for s in range(0, len(q), 256):
                rough = q[s : s + 256] @ x.T
                for n, r in enumerate(queries[s : s + 256]):
                    at = np.flatnonzero(np.unpackbits(np.frombuffer(r[6], np.uint8))[:width][other])
                    if not len(at):
                        continue
                    # the bound leaves room for the rounding of the matrix product
                    least = np.partition(rough[n, at], max(0, len(at) - k))[max(0, len(at) - k)] - 1e-9 * max(1.0, np.abs(rough[n, at]).max())
                    at = at[rough[n, at] >= least]
                    score = (x[at] * q[s + n]).sum(axis=1)
                    top = _best(score, lead[at], k)
                    ids = [np.frombuffer(members[i][6], np.int64) for i in at[top]]
                    flat, each = np.concatenate(ids), np.repeat(score[top], [len(i) for i in ids])
                    top = _best(each, flat, k)
                    out.append((r[3], flat[top].tobytes(), each[top].tobytes()))
            if out:
                c = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.binary()), pa.array(c[2], pa.binary())], names=["qid", "ids", "scores"])

    return run


def _merge(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids, scores = None, np.empty(0, np.int64), np.empty(0)

        def close():
            hits = [{"vec_id": int(i), "score": float(s)} for i, s in zip(ids, scores, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([hits], pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])))], names=["qid", "hits"])

        for b in batches:
            for qid, i, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if qid != last:
                    if last is not None:
                        yield close()
                    last, ids, scores = qid, np.empty(0, np.int64), np.empty(0)
                ids, scores = np.concatenate([ids, np.frombuffer(i, np.int64)]), np.concatenate([scores, np.frombuffer(s)])
                top = _best(scores, ids, k)
                ids, scores = ids[top], scores[top]
        if last is not None:
            yield close()

    return run


def nearest_neighbours(spark: SparkSession, vectors: DataFrame, k: int = 20, every: int = 20, candidates: float = CANDIDATES, centres: int = CENTRES, id_column: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """For the rows whose id is divisible by `every`: query_id, rank, vec_id, score of the k nearest."""
    table = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(embedding).alias("vec"))
    dtype = packed(table, "vec")
    good = with_common_length(table.where(usable("vec") & F.col("vec_id").isNotNull()), "vec").distinct()
    # at most k + 1 ids of equal vectors can be in an answer; the limit on the rank is applied before the shuffle
    first = good.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    classes = first.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("id"), "vec", "ids")
    classes = shared(spark, classes, "imi-classes")
    size = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v)).alias("m")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if not size.n:
        return spark.createDataFrame([], result)
    index = MultiIndex(sample(classes, "id", "vec"), float(np.sqrt(size.m)), centres)
    rows = shared(spark, classes.mapInArrow(_index_rows(index, dtype), "cell int, other int, id long, vec binary, more binary"), "imi-cells")
    for c in rows.groupBy("cell", "other").count().collect():  # at most centres x centres rows
        index.cells[c["cell"], c["other"]] = c["count"]
    asked = good.where(F.col("vec_id") % every == 0)
    asked = asked.join(classes.select(F.col("id").alias("qid"), F.col("vec").alias("v")), F.col("vec") == F.col("v")).select("vec_id", "qid", "vec")
    asked = shared(spark, asked, "imi-queries")
    wanted = max(k + 1, int(np.ceil(candidates * size.n)))
    visits = asked.dropDuplicates(["qid"]).select("qid", "vec").mapInArrow(_query_rows(index, wanted, dtype), "cell int, id long, vec binary, more binary")
    visits = shared(spark, visits.withColumn("other", F.lit(-1)), "imi-visits")
    members, probes = (d.groupBy("cell").agg(F.count("*").alias(n)) for d, n in ((rows, "m"), (visits, "o")))
    sizes = members.join(probes, "cell")
    spot = lambda c: F.pmod(F.xxhash64("id"), blocks(c, BLOCK)).cast("int")
    all_of = lambda c: F.explode(F.sequence(F.lit(0), blocks(c, BLOCK) - 1))
    left = rows.join(sizes, "cell").select("cell", spot("m").alias("mb"), all_of("o").alias("ob"), "id", "other", "vec", "more")
    right = visits.join(sizes, "cell").select("cell", all_of("m").alias("mb"), spot("o").alias("ob"), "id", "other", "vec", "more")
    met = left.unionByName(right).repartition("cell", "mb", "ob").sortWithinPartitions("cell", "mb", "ob")
    found = shared(spark, met.mapInArrow(_rank(index.cells.shape[1], k + 1, dtype), "qid long, ids binary, scores binary"), "imi-found")
    best = found.repartition("qid").sortWithinPartitions("qid").mapInArrow(_merge(k + 1), "qid long, hits array<struct<vec_id: long, score: double>>")
    best = asked.join(best, "qid").select(F.col("vec_id").alias("query_id"), F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("vec_id")), 1, k).alias("hits"))
    best = best.select("query_id", F.posexplode("hits").alias("at", "hit"))
    return best.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark, read(spark, sf_dir, "embeddings"))
