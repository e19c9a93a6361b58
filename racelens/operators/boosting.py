"""Boosted trees for the whole interpolation grid.

Every pair has one booster, fitted on all its rows (the finishers whose splits
up to the position are complete), however many there are. Trees are grown
level by level on binned features (squared error, second-order gain with an L2
term of 1, rows and columns sampled per tree).

All a tree learns from a row is its bins and its residual, so rows of a pair
with the same bins are one cell: a level reads the cells, and the drawn rows
are added up in them once a tree. Edges of the bins come from counts over all
rows of a position (``bin_edges``); rows are then dealt out by pair and cell,
packed by many tasks (``binned_rows``), and each pair's cells go to
one task, the largest pairs first (``fit_grid``). That task keeps HELD_BYTES
in memory and the rest in a file of its temp folder, which it reads in
sequence. Targets, leaf values and so all sums are whole multiples of a
power of two: the trees are the same however rows are dealt out.

The trees are written to the model store and read back; scoring puts cells
through the trees of their pair and gives every row its cell's prediction.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelens.functions.names import gender_code
from racelens.operators.grid import Pair, prefix_complete_len
from racelens.session import scratch_path

BLOCK_ROWS = 50_000     # rows that are packed together; no result depends on it
TOGETHER = 20           # blocks that are scored together
TASK_ROWS = 400_000     # rows of pairs that one task sorts
BINS = 32
CHUNK_ROWS = 16_384     # cells that are scored, or rows that are dealt out, at once: their bins stay in a core's cache
CHUNK_CELLS = 65_536    # cells that a tree's level reads at once
CHUNK_MOST = 1_000_000  # rows of these cells
HELD_BYTES = 256 << 20  # of a pair, in memory
BUCKETS = 65_536        # rows are drawn for a tree by so many values of a hash of their key
GRID = 1_024            # counts that a feature's edges are first looked for in
L2 = 1.0

TREE_SCHEMA = ("position int, target int, tree int, base double, feature array<int>, cut array<double>, "
               "left array<int>, right array<int>, value array<double>")
CELL_SCHEMA = "position int, target int, part int, codes binary, sizes binary, y binary, row_key binary"
_ROW = pa.schema([("position", pa.int32()), ("target", pa.int32()), ("blocks", pa.int32()), ("block", pa.int32()), ("cell", pa.binary()),
                  ("row_key", pa.int64()), ("y", pa.float64())])
_CELL = pa.schema([("position", pa.int32()), ("target", pa.int32()), ("part", pa.int32()), *[(c, pa.binary()) for c in ("codes", "sizes", "y", "row_key")]])
_COUNT = pa.schema([("position", pa.int32()), ("column", pa.int32()), ("slot", pa.int32()), ("n", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])
_TREE = pa.schema([("position", pa.int32()), ("target", pa.int32()), ("tree", pa.int32()), ("base", pa.float64()),
                   ("feature", pa.list_(pa.int32())), ("cut", pa.list_(pa.float64())), ("left", pa.list_(pa.int32())), ("right", pa.list_(pa.int32())),
                   ("value", pa.list_(pa.float64()))])


# ------------------------------------------------------------------ one tree

@dataclass
class Cells:
    """Some cells of a pair with their rows, one cell after the other."""
    codes: np.ndarray               # features x cells
    starts: np.ndarray | None       # first row of each cell; None: a row each
    y: np.ndarray                   # rows
    bucket: np.ndarray              # rows
    fitted: np.ndarray              # cells
    n: np.ndarray                   # cells: drawn rows, the sum of their residuals, and the node they are in
    g: np.ndarray
    node: np.ndarray

    def draw(self, table: np.ndarray) -> int:
        """Takes the rows whose bucket is drawn; how many they are."""
        drawn = table.take(self.bucket)
        if self.starts is None:
            self.n[:] = drawn
            np.subtract(self.y, self.fitted, out=self.g)
            self.g *= drawn
        else:
            self.n[:] = np.add.reduceat(drawn, self.starts, dtype=np.int32)
            self.g[:] = np.add.reduceat(np.where(drawn, self.y, 0.0), self.starts)
            self.g -= self.n * self.fitted
        self.node[:] = 0
        return int(np.count_nonzero(drawn))

    def descend(self, feature: np.ndarray, last: np.ndarray, left: np.ndarray) -> None:
        """From every node to its child: the left one up to the last bin that goes there. The right child follows it."""
        at = self.node.astype(np.intp)
        asked = (feature * np.intp(len(at))).take(at)
        asked += np.arange(len(at))
        right = self.codes.reshape(-1).take(asked, mode="clip") > last.take(at)
        left.take(at, out=self.node, mode="clip")
        self.node += right


def _alone(codes: list[np.ndarray], y: np.ndarray, fitted: np.ndarray) -> Cells:
    """Rows as cells of their own, each with its own bucket."""
    return Cells(np.stack(codes).astype(np.int8), None, y, np.arange(len(y)), fitted, np.empty(len(y)), np.empty(len(y)), np.zeros(len(y), np.int32))


def grow(codes: np.ndarray, edges: list[np.ndarray], residual: np.ndarray, columns: np.ndarray, depth: int, rate: float) -> dict:
    """One tree on the given rows as lists: feature (-1 in a leaf), cut, left, right, value. Rows go left below the cut;
    the right child follows the left one."""
    rows = _alone([codes[:, f] for f in range(codes.shape[1])], residual, np.zeros(len(residual)))
    rows.draw(np.ones(len(residual), bool))
    tree = _grow([rows], edges, columns, depth, rate)
    return {k: v.tolist() for k, v in tree.items()}


def _grow(cells: list[Cells], edges: list[np.ndarray], columns: np.ndarray, depth: int, rate: float, unit: float | None = None) -> dict[str, np.ndarray]:
    """The tree as arrays; the cells are left in their leaves. ``unit``: what a residual of 1 stands for where all are
    whole numbers; leaf values are then whole too."""
    def worth(g, n):
        found = rate * g / (n + L2)
        return found if unit is None else np.rint(found)

    n, g = (sum(np.bincount(c.node, w, 1) for c, w in ((c, getattr(c, x)) for c in cells)) for x in ("n", "g"))
    most = min(2 ** (depth + 1), 2 * int(n[0]) + 2)
    feature, cut, left, right = np.full(most, -1, np.int32), np.zeros(most), np.full(most, -1, np.int32), np.full(most, -1, np.int32)
    value, size, ids, descent = np.zeros(most), 1, np.array([0]), None
    value[:1] = worth(g, n)
    least = 1e-9 if unit is None else 1e-9 / unit ** 2
    # counts and sums by column, node and bin are read for the smaller child of two; the other has the rest of the parent's
    smaller, side, parents, open_nodes = ids, None, None, ids
    for _ in range(depth):
        k, q = len(ids), len(smaller)
        if not k:
            break
        first = np.full(size, -1)
        first[smaller] = np.arange(q) * BINS
        hist = np.zeros((2, len(columns), q * BINS))
        for c in cells:
            if descent:
                c.descend(*descent)
            start = first.take(c.node)
            some = np.flatnonzero((start >= 0) & (c.n > 0))
            start, weight, own = start.take(some), c.n.take(some).astype(np.float64, copy=False), c.g.take(some)
            slot = np.empty_like(start)
            for i, f in enumerate(columns):
                np.add(start, c.codes[f].take(some), out=slot)
                hist[0, i] += np.bincount(slot, weight, q * BINS)
                hist[1, i] += np.bincount(slot, own, q * BINS)
        hist = hist.reshape(2, len(columns), q, BINS)
        if parents is not None:
            both = np.empty((2, len(columns), q, 2, BINS))
            both[:, :, np.arange(q), side] = hist
            both[:, :, np.arange(q), 1 - side] = parents - hist
            hist = both.reshape(2, len(columns), 2 * q, BINS)[:, :, open_nodes]
        best, at, below, every = np.full(k, least), np.full((k, 2), -1), np.zeros(k), np.arange(k)
        below_g, whole = np.zeros(k), (g * g / (n + L2))[:, None]
        for i, f in enumerate(columns):
            nl = np.cumsum(hist[0, i], axis=1)[:, :-1]
            gl = np.cumsum(hist[1, i], axis=1)[:, :-1]
            nr, gr = n[:, None] - nl, g[:, None] - gl
            gain = np.where((nl > 0) & (nr > 0), gl * gl / (nl + L2) + gr * gr / (nr + L2) - whole, 0.0)
            top = gain.argmax(axis=1)
            found = gain[every, top]
            better = found > best
            best[better] = found[better]
            at[better, 0], at[better, 1] = f, top[better]
            below[better], below_g[better] = nl[every, top][better], gl[every, top][better]
        split = at[:, 0] >= 0
        m, descent = 2 * int(split.sum()), None
        if not m:
            break
        own = ids[split]
        feature[own], left[own] = at[split, 0], size + np.arange(0, m, 2)
        right[own] = left[own] + 1
        cut[own] = [edges[f][b] for f, b in at[split].tolist()]
        last, stay = np.full(size, BINS, np.int8), np.arange(size, dtype=np.int32)
        last[own], stay[own] = at[split, 1], left[own]
        descent = np.maximum(feature[:size], 0), last, stay
        g_next, n_next = np.empty(m), np.empty(m)
        n_next[::2], n_next[1::2] = below[split], (n - below)[split]
        g_next[::2], g_next[1::2] = below_g[split], (g - below_g)[split]
        value[size:size + m] = worth(g_next, n_next)
        open_nodes = np.flatnonzero(n_next > 1)
        side = (n_next[1::2] < n_next[::2]).astype(np.intp)
        smaller, parents = left[own] + side, hist[:, :, split]
        ids, n, g = size + open_nodes, n_next[open_nodes], g_next[open_nodes]
        size += m
    for c in cells:
        if descent:
            c.descend(*descent)
    found = {"feature": feature, "cut": cut, "left": left, "right": right, "value": value}
    return {k: v[:size] for k, v in found.items()}


def predict(tree: dict, x: np.ndarray) -> np.ndarray:
    feature, cut, left, right, value = (np.asarray(tree[k]) for k in ("feature", "cut", "left", "right", "value"))
    at = np.zeros(len(x), np.int64)
    while (inner := feature[at] >= 0).any():
        i = np.flatnonzero(inner)
        goes_left = x[i, feature[at[i]]] < cut[at[i]]
        at[i] = np.where(goes_left, left[at[i]], right[at[i]])
    return value[at]


def _leaves(feature: np.ndarray, bins: np.ndarray, left: np.ndarray, codes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The leaf of every one of ``rows`` by table look-ups in ``codes``, the n rows' bins of one feature after the other.
    The right child follows the left one."""
    inner = feature >= 0
    column, stay = np.where(inner, feature, 0) * np.intp(n), np.where(inner, left, np.arange(len(left)))
    last = np.where(inner, bins, np.iinfo(np.int8).max).astype(np.int8)     # a leaf leads to itself
    at, level = np.zeros(len(rows), np.intp), np.array([0])
    asked, found, bound, goes_right = np.empty_like(at), np.empty(len(rows), np.int8), np.empty(len(rows), np.int8), np.empty(len(rows), bool)
    while True:
        level = left[level[inner[level]]]
        if not len(level):
            return at
        level = np.concatenate([level, level + 1])
        column.take(at, out=asked, mode="clip")     # all indices are in range: clip spares the check
        asked += rows
        codes.take(asked, out=found, mode="clip")
        last.take(at, out=bound, mode="clip")
        np.greater(found, bound, out=goes_right)
        at = stay.take(at, mode="clip")
        at += goes_right


def predict_all(trees: list[dict], x: np.ndarray) -> np.ndarray:
    """The sum of all trees' predictions. Each value is put among its feature's cuts once, for all trees."""
    if not trees:
        return np.zeros(len(x))
    feature = np.concatenate([np.asarray(t["feature"]) for t in trees])
    cut = np.concatenate([np.asarray(t["cut"], np.float64) for t in trees])
    cuts, bins = [np.unique(cut[feature == f]) for f in range(x.shape[1])], np.zeros(len(feature), np.int8)
    for f, c in enumerate(cuts):
        own = feature == f
        bins[own] = np.searchsorted(c, cut[own])
    tables, at = [], 0
    for t in trees:
        left = np.asarray(t["left"], np.intp)
        end = at + len(left)
        tables.append((feature[at:end], bins[at:end], left, np.asarray(t["value"], np.float64)))
        at = end
    out = np.zeros(len(x))
    for at in range(0, len(x), CHUNK_ROWS):
        part = x[at:at + CHUNK_ROWS]
        rows = np.arange(len(part))
        codes = np.concatenate([np.searchsorted(c, part[:, f], "right").astype(np.int8) for f, c in enumerate(cuts)])
        for feature, bins, left, value in tables:
            out[at:at + CHUNK_ROWS] += value.take(_leaves(feature, bins, left, codes, rows, len(part)))
    return out


def binned(x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per column its edges (padded with infinity to BINS) and the bins of its values."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    codes = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    return [np.append(e, np.full(BINS - len(e), np.inf)) for e in edges], codes


def boost(x: np.ndarray, y: np.ndarray, params: dict, seed: list[int]) -> tuple[float, list[dict]]:
    """Mean of y, and the trees that add up on it."""
    edges, codes = binned(x)
    base = float(y.mean())
    rows = _alone(codes, y, np.full(len(y), base))
    return base, [{k: v.tolist() for k, v in tree.items()} for tree in _boosted([rows], edges, len(y), params, seed)]


def _boosted(cells: list[Cells], edges: list[np.ndarray], buckets: int, params: dict, seed: list[int], unit: float | None = None) -> Iterator[dict[str, np.ndarray]]:
    """Tree after tree on what the ones before leave. A tree draws buckets of rows, and features."""
    rng = np.random.default_rng(seed)
    take = max(1, round(float(params["featureSubsetStrategy"]) * len(edges)))
    for _ in range(params["maxIter"]):
        table = rng.random(buckets) < params["subsamplingRate"]
        columns = np.sort(rng.choice(len(edges), take, replace=False))
        if not sum([c.draw(table) for c in cells]):
            continue
        tree = _grow(cells, edges, columns, params["maxDepth"], params["stepSize"], unit)
        for c in cells:
            c.fitted += tree["value"].take(c.node)
        yield tree


# ------------------------------------------------------------------ the grid

def _matrix(v: pa.Array) -> np.ndarray:
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def position_rows(wide: DataFrame, splits: list[str], counts: dict[int, int], row_key: str = "finisher_id") -> DataFrame:
    """(position, blocks, block, row_key, v) for every row and every position up to which its splits are complete.

    ``v`` holds the splits up to the position, then age and gender; ``counts``
    gives the rows of each position that is trained (metadata, one entry per
    position). ``blocks`` and ``block`` say how work is dealt out, nothing else."""
    blocks = {p: -(-n // BLOCK_ROWS) for p, n in counts.items()}
    wanted = F.array(*[F.struct(F.lit(p).alias("position"), F.lit(k).alias("blocks")) for p, k in sorted(blocks.items())]) \
        .cast("array<struct<position: int, blocks: int>>")
    values = F.array(*[F.col(f"`{s}`").cast("double") for s in splits])
    base = wide.select(F.col(row_key).cast("long").alias("row_key"), F.col("age").cast("double").alias("age"),
                       gender_code(F.col("gender")).cast("double").alias("gender"), values.alias("_v"),
                       prefix_complete_len(splits).alias("_L")).filter("age is not null")
    rows = base.select("*", F.inline(F.filter(wanted, lambda w: w["position"] < F.col("_L"))))
    return rows.select("position", "blocks", F.pmod(F.xxhash64("row_key"), F.col("blocks")).cast("int").alias("block"), "row_key",
                       F.concat(F.slice("_v", F.lit(1), F.col("position") + 1), F.array("age", "gender")).alias("v"))


@dataclass
class Binned:
    """The cells of all pairs of some rows."""
    counts: dict[int, int]                      # rows of each position
    reach: dict[int, float]                     # largest value of a split up to it, without sign
    edges: dict[int, list[np.ndarray]]          # of each of its columns
    cells: DataFrame
    repeated: bool                              # whether row keys repeat


def _by_position(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, np.ndarray]]:
    """The values of a position's rows, up to about ``most`` rows at once."""
    held: dict[int, list[np.ndarray]] = {}
    for b in batches:
        position, lists = b.column("position").to_numpy(), b.column("v")
        for p in np.unique(position).tolist():
            own = held.setdefault(p, [])
            own.append(_matrix(lists.filter(pa.array(position == p))))
            if sum(len(v) for v in own) >= most:
                yield p, np.concatenate(held.pop(p))
    for p, own in held.items():
        yield p, np.concatenate(own)


def _slot_counts(batches: Iterator[pa.RecordBatch], points: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Per position and column the rows from each point up to the next, and the least and largest value there."""
    found: dict[tuple[int, int], np.ndarray] = {}
    for p, v in _by_position(batches, BLOCK_ROWS):
        for f in range(v.shape[1]):
            if (p, f) not in points:
                continue
            x = np.sort(v[np.isfinite(v[:, f]), f])
            at = np.append(np.searchsorted(x, points[p, f], "left"), len(x))
            own = found.setdefault((p, f), np.stack([np.zeros(len(at) - 1), np.full(len(at) - 1, np.inf), np.full(len(at) - 1, -np.inf)]))
            some = np.flatnonzero(np.diff(at))
            own[0, some] += np.diff(at)[some]
            own[1, some] = np.minimum(own[1, some], x[at[:-1][some]])
            own[2, some] = np.maximum(own[2, some], x[at[1:][some] - 1])
    for (p, f), own in found.items():
        some = np.flatnonzero(own[0])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), p, np.int32)), pa.array(np.full(len(some), f, np.int32)), pa.array(some.astype(np.int32)),
                                          pa.array(own[0, some].astype(np.int64)), pa.array(own[1, some]), pa.array(own[2, some])], schema=_COUNT)


def bin_edges(rows: DataFrame) -> tuple[dict[int, int], dict[int, float], dict[int, list[np.ndarray]]]:
    """Rows of each position, the largest value of its splits, and its columns' edges: BINS - 1 exact quantiles (the lower of two values).

    Values are counted between points; where an edge falls among different values, more points are put there and all
    rows counted again. The driver holds numbers per column, never rows."""
    value = F.when(F.abs("x") < float("inf"), F.col("x"))
    ends = rows.select("position", F.posexplode("v").alias("column", "x")).groupBy("position", "column").agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()
    counts, reach = {}, {}
    points, edges = {}, {}
    for r in ends:
        p, f = r["position"], r["column"]
        counts[p], edges[p, f] = r["n"], np.empty(0)
        if r["low"] is not None:
            points[p, f] = np.unique(np.linspace(r["low"], r["high"], GRID + 1))
    last = {p: max(f for q, f in edges if q == p) - 2 for p in counts}        # age and gender follow the splits
    for r in ends:
        if r["column"] <= last[r["position"]] and r["low"] is not None:
            reach[r["position"]] = max(reach.get(r["position"], 0.0), abs(r["low"]), abs(r["high"]))
    while points:
        asked = dict(points)
        found = rows.filter(F.col("position").isin(sorted({p for p, _ in asked}))).mapInArrow(
            lambda b, asked=asked: _slot_counts(b, asked), "position int, column int, slot int, n long, low double, high double")
        t = found.groupBy("position", "column", "slot").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")) \
            .orderBy("position", "column", "slot").toArrow()
        position, column, n, low, high = (t.column(c).to_numpy() for c in ("position", "column", "n", "low", "high"))
        for p, f in asked:
            own = (position == p) & (column == f)
            upto = np.cumsum(n[own])
            ranks = (upto[-1] - 1) * np.arange(1, BINS) // BINS
            hit = np.searchsorted(upto, ranks, "right")
            a, b = low[own][hit], high[own][hit]
            if (a < b).any():
                more = [np.linspace(a[i], b[i], 65) for i in np.flatnonzero(a < b)]
                points[p, f] = np.unique(np.concatenate([points[p, f], *more]))
            else:
                edges[p, f] = np.unique(a)
                del points[p, f]
    return counts, reach, {p: [edges[p, f] for f in sorted(f for q, f in edges if q == p)] for p in counts}


def _dealt(batches: Iterator[pa.RecordBatch], edges: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Each row once per target of its position, with its bins of the pair's features."""
    def dealt(p, held):
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        v = _matrix(rows.column("v"))
        codes = np.stack([np.searchsorted(e, v[:, f], "right").astype(np.int8) for f, e in enumerate(edges[p])], axis=1)
        at = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * (codes.shape[1] - 1))
        for target in range(p):
            cell = pa.BinaryArray.from_buffers(pa.binary(), len(codes), [None, at.buffers()[1], pa.py_buffer(np.delete(codes, target, axis=1).tobytes())])
            yield pa.RecordBatch.from_arrays([rows.column("position"), pa.array(np.full(len(codes), target, np.int32)), rows.column("blocks"),
                                              rows.column("block"), cell, rows.column("row_key"), pa.array(v[:, target])], schema=_ROW)

    held: dict[int, list[pa.RecordBatch]] = {}
    for b in batches:
        position = b.column("position").to_numpy()
        for p in np.unique(position).tolist():
            own = held.setdefault(p, [])
            own.append(b.filter(pa.array(position == p)))
            if sum(x.num_rows for x in own) >= CHUNK_ROWS:
                yield from dealt(p, held.pop(p))
    for p, own in held.items():
        yield from dealt(p, own)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their part as cells, those of one part at a time, up to twice BLOCK_ROWS rows and a batch."""
    def packed(held, part):
        t = pa.Table.from_batches(held).combine_chunks()
        cell = t.column("cell").chunk(0)
        at = np.frombuffer(cell.buffers()[1], np.int32)[cell.offset:][:len(t) + 1]
        codes = np.frombuffer(cell.buffers()[2], np.int8)[at[0]:at[-1]].reshape(len(t), -1)
        words = np.zeros((len(t), -(-codes.shape[1] // 8) * 8), np.int8)
        words[:, :codes.shape[1]] = codes
        order = np.lexsort(words.view(np.uint64).T) if words.shape[1] > 8 else np.argsort(words.view(np.uint64)[:, 0])
        codes = codes[order]
        starts = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]).any(axis=1)))
        return pa.RecordBatch.from_pylist([{
            "position": part >> 48, "target": part >> 32 & 0xFFFF, "part": part & 0xFFFFFFFF,
            "codes": np.ascontiguousarray(codes[starts].T).tobytes(), "sizes": np.diff(np.append(starts, len(t))).astype(np.int32).tobytes(),
            "y": t.column("y").to_numpy()[order].tobytes(), "row_key": t.column("row_key").to_numpy()[order].tobytes()}], _CELL)

    held, now = [], None
    for b in batches:
        part = b.column("part").to_numpy()
        ends = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
        for i, j in zip(ends, ends[1:]):
            if i == j:
                continue
            if held and (now != part[i] or sum(h.num_rows for h in held) >= 2 * BLOCK_ROWS):
                yield packed(held, now)
                held = []
            held, now = [*held, b.slice(i, j - i)], int(part[i])
    if held:
        yield packed(held, now)


def binned_rows(rows: DataFrame, models: DataFrame | None = None) -> Binned:
    """The cells of every pair, stored once: rows as ``position_rows`` gives them, put into bins by the edges of their own
    values, or by the cuts of stored trees. The rows are read several times."""
    spark = rows.sparkSession
    if models is None:
        counts, reach, edges = bin_edges(rows)
    else:
        counts, reach = {r["position"]: r["count"] for r in rows.groupBy("position").count().collect()}, {}
        edges = {p: [np.empty(0)] * (p + 3) for p in counts}
        at = F.col("feature") + (F.col("feature") >= F.col("target")).cast("int")
        cuts = models.select("position", "target", F.inline(F.arrays_zip("feature", "cut"))).filter("feature >= 0") \
            .groupBy("position", at.alias("column")).agg(F.array_sort(F.collect_set("cut")).alias("cuts")).collect()   # bounded by the bins
        for r in cuts:
            if r["position"] in edges:
                edges[r["position"]][r["column"]] = np.array(r["cuts"])
    pair_rows = sum(p * n for p, n in counts.items())
    parts = max(spark.sparkContext.defaultParallelism, -(-pair_rows // TASK_ROWS))
    # a cell is met in one part; from about 50 million rows on in several, so that no cell is too much for a task
    share = F.pmod("block", F.ceil(F.col("blocks") / 1024))
    dealt = rows.mapInArrow(lambda b: _dealt(b, edges), "position int, target int, blocks int, block int, cell binary, row_key long, y double") \
        .select((F.shiftleft(F.col("position").cast("long"), 48) + F.shiftleft(F.col("target").cast("long"), 32) + F.pmod(F.xxhash64("cell", share), "blocks")).alias("part"),
                "cell", "row_key", "y") \
        .repartition(parts, "part").sortWithinPartitions("part")
    path = scratch_path(spark, "boosted-cells")
    dealt.mapInArrow(_pack, CELL_SCHEMA).write.parquet(path)
    keys = rows.filter(F.col("position") == min(counts, default=0)).groupBy("row_key").count()     # the others' rows are among them
    return Binned(counts, reach, edges, spark.read.schema(CELL_SCHEMA).parquet(path), bool(keys.filter("count > 1").take(1)))


class _Arena:
    """Arrays of a task: the first HELD_BYTES in memory, more in a file."""

    def __init__(self):
        self.piece, self.at, self.file, self.end = np.empty(HELD_BYTES, np.uint8), 0, None, 0

    def put(self, a: np.ndarray) -> np.ndarray:
        if self.at + a.nbytes > len(self.piece):
            self.file = self.file or tempfile.TemporaryFile()   # noqa: SIM115 (it goes with the arena)
            size = max(HELD_BYTES, a.nbytes)
            self.file.truncate(self.end + size)
            self.piece, self.at = np.memmap(self.file, np.uint8, "r+", self.end, (size,)), 0
            self.end += -(-size // 65_536) * 65_536
        out = np.asarray(self.piece[self.at:self.at + a.nbytes]).view(a.dtype).reshape(a.shape)
        self.at += -(-a.nbytes // 64) * 64
        out[...] = a
        return out


def _bucket(key: np.ndarray) -> np.ndarray:
    z = key.astype(np.uint64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) % np.uint64(BUCKETS)


def _unit(n: int, reach: float) -> float:
    """Power of two for which sums over n such values, and twice as far apart, are exact."""
    return float(2.0 ** np.ceil(np.log2(4.0 * n * reach) - 53)) if reach else 1.0


def _taken_in(packed: list[dict], arena: _Arena, unit: float) -> Cells:
    """Packed cells as arrays, y in units."""
    sizes = np.concatenate([np.frombuffer(r["sizes"], np.int32) for r in packed])
    codes = np.concatenate([np.frombuffer(r["codes"], np.int8).reshape(-1, len(r["sizes"]) // 4) for r in packed], axis=1)
    y = np.rint(np.concatenate([np.frombuffer(r["y"]) for r in packed]) / unit)
    bucket = np.concatenate([_bucket(np.frombuffer(r["row_key"], np.int64)) for r in packed]).astype(np.uint16)
    starts = None if len(sizes) == len(y) else arena.put((np.cumsum(sizes) - sizes).astype(np.int64))
    return Cells(arena.put(codes), starts, arena.put(y), arena.put(bucket), *[arena.put(np.zeros(len(sizes), t)) for t in (np.float64, np.float32, np.float64, np.int32)])


def _fit(batches: Iterator[pa.RecordBatch], found: Binned, params: dict) -> Iterator[pa.RecordBatch]:
    arenas: dict[tuple[int, int], _Arena] = {}
    pairs: dict[tuple[int, int], list[Cells]] = {}
    held: dict[tuple[int, int], list[dict]] = {}

    def take_in(pair):
        p = held.pop(pair)
        pairs.setdefault(pair, []).append(_taken_in(p, arenas.setdefault(pair, _Arena()), _unit(found.counts[pair[0]], found.reach[pair[0]])))

    for b in batches:
        for i in range(b.num_rows):
            r = {c: b.column(c)[i].as_py() for c in b.schema.names}
            own = held.setdefault(pair := (r["position"], r["target"]), [])
            own.append(r)
            if sum(len(x["sizes"]) // 4 for x in own) >= CHUNK_CELLS or sum(len(x["y"]) // 8 for x in own) >= CHUNK_MOST:
                take_in(pair)
    for pair in list(held):
        take_in(pair)
    for position, target in sorted(pairs):
        cells, unit = pairs.pop((position, target)), _unit(found.counts[position], found.reach[position])
        base = np.rint(sum(c.y.sum() for c in cells) / sum(len(c.y) for c in cells))
        for c in cells:
            c.fitted[:] = base
        edges = [e for f, e in enumerate(found.edges[position]) if f != target]
        for i, tree in enumerate(_boosted(cells, edges, BUCKETS, params, [params["seed"], position, target], unit)):
            yield pa.RecordBatch.from_pylist([{"position": position, "target": target, "tree": i, "base": base * unit, **tree, "value": tree["value"] * unit}], _TREE)
        del cells, arenas[position, target]


def fit_grid(rows: DataFrame, params: dict, found: Binned | None = None) -> DataFrame:
    """M2: the trees of every pair; rows as ``position_rows`` gives them, ``found`` their cells where the caller has them."""
    found = found or binned_rows(rows)
    # a task a pair, those that take longest first
    order = sorted(((p, t) for p in found.counts for t in range(p)), key=lambda x: (-found.counts[x[0]] * (x[0] + 2), x))
    place = F.element_at(F.create_map(*[F.lit(v) for i, (p, t) in enumerate(order) for v in (p * 10_000 + t, i)]), F.col("position") * 10_000 + F.col("target")) \
        if order else F.lit(0)
    known = Binned(found.counts, found.reach, found.edges, None, found.repeated)
    return found.cells.repartitionById(max(1, len(order)), place).mapInArrow(lambda b: _fit(b, known, params), TREE_SCHEMA)


def _score(cells: pa.Table, trees: pa.Table, edges: list[np.ndarray], pair_id: int, schema: pa.Schema) -> pa.Table:
    """The rows of some cells of a pair under its stored trees."""
    if not cells.num_rows or not trees.num_rows:
        return schema.empty_table()
    trees = trees.sort_by("tree")
    column = {k: trees.column(k).combine_chunks() for k in ("feature", "cut", "left", "value")}
    ends = column["feature"].offsets.to_numpy() - column["feature"].offsets[0].as_py()
    column = {k: c.flatten().to_numpy() for k, c in column.items()}
    bins = np.zeros(len(column["feature"]), np.int8)
    for f, e in enumerate(edges):
        own = column["feature"] == f
        bins[own] = np.searchsorted(e, column["cut"][own])
    left = column["left"].astype(np.intp)
    packed = [{c: cells.column(c)[i].as_py() for c in ("codes", "sizes", "y", "row_key")} for i in range(cells.num_rows)]
    sizes = np.concatenate([np.frombuffer(r["sizes"], np.int32) for r in packed])
    codes = np.concatenate([np.frombuffer(r["codes"], np.int8).reshape(-1, len(r["sizes"]) // 4) for r in packed], axis=1)
    pred = np.full(len(sizes), trees.column("base")[0].as_py())
    for at in range(0, len(sizes), CHUNK_ROWS):
        part = np.ascontiguousarray(codes[:, at:at + CHUNK_ROWS])
        n = part.shape[1]
        for i, j in zip(ends, ends[1:]):
            pred[at:at + n] += column["value"][i:j].take(_leaves(column["feature"][i:j], bins[i:j], left[i:j], part.reshape(-1), np.arange(n), n))
    y, keys = (np.concatenate([np.frombuffer(r[c], t) for r in packed]) for c, t in (("y", np.float64), ("row_key", np.int64)))
    return pa.table([pa.array(np.full(len(y), pair_id, np.int32)), pa.array(keys), pa.array(y), pa.array(np.repeat(pred, sizes))], schema=schema)


def score_grid(rows: DataFrame, models: DataFrame, pairs: list[Pair], together: int = TOGETHER, found: Binned | None = None) -> DataFrame:
    """(pair_id, row_key, y, pred) of every row under the stored trees of its pair. ``found``: the cells the trees
    were fitted on where the caller has them; else the rows are put into bins by the trees' own cuts."""
    found = found or binned_rows(rows, models)
    ids, edges = {(p.p_idx, p.t_idx): p.pair_id for p in pairs}, found.edges
    schema = pa.schema([("pair_id", pa.int32()), ("row_key", pa.int64()), ("y", pa.float64()), ("pred", pa.float64())])

    def apply(key, cells, trees):
        position, target = key[0].as_py(), key[1].as_py()
        return _score(cells, trees, [e for f, e in enumerate(edges[position]) if f != target], ids[position, target], schema)

    # some blocks of a pair meet all its trees in one task
    shares = F.lit(1)
    for p, n in found.counts.items():
        shares = F.when(F.col("position") == p, F.lit(max(1, -(-n // (together * BLOCK_ROWS))))).otherwise(shares)
    left = found.cells.withColumn("share", F.pmod("part", shares))
    right = models.filter(F.col("position").isin(list(found.counts))).withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, sum(p * (1 + n // (together * BLOCK_ROWS)) for p, n in found.counts.items()))
    key = ["position", "target", "share"]
    out = left.repartition(tasks, *key).groupBy(*key).cogroup(right.repartition(tasks, *key).groupBy(*key)).applyInArrow(apply, "pair_id int, row_key long, y double, pred double")
    return out.groupBy("pair_id", "row_key").agg(F.first("y").alias("y"), F.avg("pred").alias("pred")) if found.repeated else out
