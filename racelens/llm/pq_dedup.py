"""Near-duplicate embeddings by product quantisation (operator 9).

Coarse inverted lists hold the vectors, each with the codes of its residual in
SUBSPACES subspaces. A vector meets the members of its own list and of every
list whose border lies within the link radius; asymmetric distances from
lookup tables drop the members that are too far, and the cosine in double
precision of what is left decides. Only vectors with equal labels that are not
null meet.

Both filters are triangle bounds, so no link is lost whatever the vectors look
like: a vector within distance r of another one can lie beyond the border to a
list only if that border is within r, and its distance to a coded member
exceeds r by the member's quantisation error at most.

Equal vectors form one class and are counted, not paired. Lists are put
together to groups, and the groups of a label are cut into cells of about BLOCK
vectors. A vector goes to the pairs of its own cell with those that hold a list
within its reach; a pair of cells returns link counts and the edges of a
spanning forest, never its pairs. Where the lists are not apart, as with
vectors without clusters, most pairs of cells of a label are met.

Vectors that are null, zero, hold null or non-finite components, have a null
label or another length than most vectors link with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.llm.common import components, read, shared
from racelens.llm.vectors import blocks, kmeans, matrix, nearest, packed, runs, sample, usable, with_common_length

MAX_LISTS = 1024
SUBSPACES, CENTRES = 8, 64
BLOCK = 8192
STEP = 1024  # queries that meet a list at once
SLACK = 1e-6  # of distances, for rounding


class Index:
    """Centroids of the lists and of the residuals' subspaces, fitted on a bounded sample."""

    def __init__(self, vectors: np.ndarray, lists: int, threshold: float, groups: int = 1):
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.threshold = threshold
        self.radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        self.lists = kmeans(units, lists)
        own = nearest(units, self.lists)
        rest = units - self.lists[own]
        before = np.cumsum(np.bincount(own, minlength=len(self.lists)))
        self.group = np.concatenate([[0], before[:-1]]) * groups // len(units)
        self.cuts = np.array_split(np.arange(units.shape[1]), min(SUBSPACES, units.shape[1]))
        self.codebooks = [kmeans(rest[:, c], CENTRES) for c in self.cuts]

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and quantisation error of every row."""
        own = nearest(units, self.lists)
        rest = units - self.lists[own]
        codes = np.stack([nearest(rest[:, c], b) for c, b in zip(self.cuts, self.codebooks, strict=True)], axis=1).astype(np.uint8)
        kept = np.concatenate([b[codes[:, s]] for s, b in enumerate(self.codebooks)], axis=1)
        return own, codes, np.linalg.norm(rest - kept, axis=1)

    def reach(self, units: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Per row and list, whether the border to the list is within the radius; true for the row's own list."""
        size = (self.lists**2).sum(axis=1)
        d = size - 2 * units @ self.lists.T
        gap = size[None] + size[own][:, None] - 2 * self.lists[own] @ self.lists.T
        # lists with the same centre have no border
        return (gap < 1e-12) | (d - d[np.arange(len(units)), own][:, None] <= 2 * np.sqrt(np.maximum(gap, 0)) * (self.radius + SLACK))

    def distances(self, units: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Squared asymmetric distances of rows to the coded members of one list, from lookup tables."""
        rest, total = units - self.lists[which], 0.0
        for s, (c, b) in enumerate(zip(self.cuts, self.codebooks, strict=True)):
            x = rest[:, c]
            table = (x**2).sum(1)[:, None] - 2 * x @ b.T + (b**2).sum(1)[None]
            total = total + table[:, codes[:, s]]
        return total

    def links(self, which: int, queries: tuple, members: tuple, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, member) of positions with cosine at or over the threshold; `same`: each pair of a list once."""
        (qi, qx, ql), (mi, mx, codes, err) = queries, members
        mn, qn = np.linalg.norm(mx, axis=1), np.linalg.norm(qx, axis=1)
        maybe = self.distances(qx / qn[:, None], which, codes) <= ((self.radius + err + SLACK) ** 2)[None]
        if same:
            maybe &= (ql != which)[:, None] | (qi[:, None] < mi[None])
        a, b = np.nonzero(maybe)
        cos = np.concatenate([np.einsum("ij,ij->i", qx[a[s : s + 65536]], mx[b[s : s + 65536]]) for s in range(0, len(a), 65536)] or [np.empty(0)]) / (qn[a] * mn[b])
        return a[cos >= self.threshold], b[cos >= self.threshold]

    def meet(self, queries: tuple, members: tuple, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions of two cells, or with `same` of one with itself, list by list."""
        (qi, qx, ql), (mi, mx, ml, codes, err) = queries, members
        lists = [(which, np.flatnonzero(ml == which)) for which in np.unique(ml)]
        for s in range(0, len(qi), STEP):
            x, own = qx[s : s + STEP], ql[s : s + STEP]
            near = self.reach(x / np.linalg.norm(x, axis=1, keepdims=True), own)
            for which, m in lists:
                q = np.flatnonzero(near[:, which] & ((own <= which) | (not same)))
                if len(q):
                    a, b = self.links(which, (qi[s + q], x[q], own[q]), (mi[m], mx[m], codes[m], err[m]), same)
                    if len(a):
                        yield s + q[a], m[b]


PLACED = "label string, grp int, reach array<int>, own int, id long, mult long, vec binary, codes binary, err double"


def _place(index: Index, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.diff(index.group, prepend=-1))
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(3))
            units = x / np.linalg.norm(x, axis=1, keepdims=True)
            own, codes, err = index.encode(units)
            groups = [index.group[starts[r]].tolist() for r in np.logical_or.reduceat(index.reach(units, own), starts, axis=1)]
            vec = [v.tobytes() for v in x.astype(dtype)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(index.group[own], pa.int32()), pa.array(groups, pa.list_(pa.int32())), pa.array(own, pa.int32()), b.column(0), b.column(2), pa.array(vec, pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(err)], names=["label", "grp", "reach", "own", "id", "mult", "vec", "codes", "err"])

    return run


def _meet(index: Index, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 5):
            same = rows[0][1:3] == rows[0][3:5]
            members = rows if same else [r for r in rows if not r[5]]
            queries = rows if same else [r for r in rows if r[5]]
            if not members or not queries:
                continue
            vec = lambda rs: np.frombuffer(b"".join(r[9] for r in rs), dtype).astype(np.float64).reshape(len(rs), -1)
            (qi, ql), (mi, ml) = (tuple(np.array([r[c] for r in rs]) for c in (7, 6)) for rs in (queries, members))
            codes = np.frombuffer(b"".join(r[10] for r in members), np.uint8).reshape(len(members), -1)
            counts: dict[int, int] = {}
            root: dict[int, int] = {}
            edges = []

            def find(p):
                while root.setdefault(p, p) != p:
                    root[p] = p = root[root[p]]
                return p

            for a, b in index.meet((qi, vec(queries), ql), (mi, vec(members), ml, codes, np.array([r[11] for r in members])), same):
                for i, j in zip(a.tolist(), b.tolist(), strict=True):
                    q, m = queries[i], members[j]
                    counts[q[7]] = counts.get(q[7], 0) + m[8]
                    counts[m[7]] = counts.get(m[7], 0) + q[8]
                    x, y = find(q[7]), find(m[7])
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        edges.append((q[7], m[7]))
            if not counts:
                continue
            out = [(i, None, n) for i, n in counts.items()] + [(x, y, None) for x, y in edges]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b", "n"])

    return run


def embedding_near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = 0.93, id_column: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    table = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(embedding).alias("vec"), F.col(label).cast("string").alias("label"))
    dtype = packed(table, "vec")
    good = with_common_length(table.where(usable("vec") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()), "vec")
    classes = good.groupBy("label", "vec").agg(F.min("vec_id").alias("id"), F.countDistinct("vec_id").alias("mult"))
    classes = shared(spark, classes.select("id", "label", "mult", "vec"), "pq-classes")
    n = classes.count()
    if n:
        largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
        index = Index(sample(classes, "id", "vec"), min(MAX_LISTS, int(np.ceil(np.sqrt(n)))), threshold, -(-largest // BLOCK))
        rows = shared(spark, classes.mapInArrow(_place(index, dtype), PLACED), "pq-lists")
        sizes = rows.groupBy("label", "grp").agg(blocks(F.count("*"), BLOCK).alias("cuts"))
        rows = rows.join(sizes, ["label", "grp"]).withColumn("cut", F.pmod(F.xxhash64("id"), "cuts").cast("int")).drop("cuts")
        rows = rows.withColumn("other", F.explode("reach")).join(sizes.withColumnRenamed("grp", "other"), ["label", "other"])
        rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        mine, theirs = F.struct(F.col("grp").alias("g"), F.col("cut").alias("c")), F.struct(F.col("other").alias("g"), F.col("part").alias("c"))
        rows = rows.select("label", F.least(mine, theirs).alias("lo"), F.greatest(mine, theirs).alias("hi"), (mine <= theirs).alias("query"), "own", "id", "mult", "vec", "codes", "err")
        rows = rows.select("label", F.col("lo.g").alias("g1"), F.col("lo.c").alias("c1"), F.col("hi.g").alias("g2"), F.col("hi.c").alias("c2"), *rows.columns[3:])
        keys = rows.columns[:5]
        rows = rows.repartition(*keys).sortWithinPartitions(*keys)
        found = shared(spark, rows.mapInArrow(_meet(index, dtype), "a long, b long, n long"), "pq-links")
    else:
        found = spark.createDataFrame([], "a long, b long, n long")
    groups = components(spark, found.where("b is not null").select("a", "b"), "pq")
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    joined = classes.join(counts, "id", "left").join(groups, "id", "left")
    joined = joined.select(F.col("label").alias("l"), F.col("vec").alias("v"), (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    fit = F.when(usable("vec"), F.col("vec"))
    out = table.withColumn("fit", fit).join(joined, (F.col("label") == F.col("l")) & (F.col("fit") == F.col("v")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op9_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(spark, read(spark, sf_dir, "embeddings"))
