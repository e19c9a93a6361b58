"""Best-fit packing of tokenised documents by bin completion (operator 7).

Every document is its token ids and an end id. One longer than the capacity is
cut into pieces of full capacity behind a first piece that holds the rest.

Only the number of pieces of each length reaches the driver (at most
`capacity` rows). Bin completion works on these counts: it takes the largest
length left, lists the undominated fillings of the room beside it, closes as
many equal bins at once as the counts allow, and goes on; branches whose waste
proves that they cannot beat the incumbent are pruned. The first incumbent is
best-fit decreasing on the same counts. The first pass tries FILLINGS likely
fillings a node, each in as many bins as it can; the second one, with the nodes
left, every filling that no other piece fits into, in any number of bins. The
search ends when the incumbent meets the lower bound, when nothing is left to
try, which proves it, or after NODES nodes.

The plan is a list of patterns (lengths in one sequence, how many sequences).
Every piece finds its place by its rank among the pieces of its length: a rank
within (length, salt) plus the sum of the groups before, so a length that many
pieces share is spread over tasks.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelens.llm.bpe import vocabulary
from racelens.llm.common import read, shared
from racelens.llm.words import encoder

CAPACITY, END_ID = 2048, 0
NODES = 2_000
FILLINGS = 6

Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((length, times), ...), sequences


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing, with equal pieces placed together."""
    bins: dict[int, list[list]] = {}  # room left -> [pattern, bins]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = next((r for r in sorted(bins) if r >= length), None)
            if room is None:
                fresh = -(-left // (capacity // length))
                bins.setdefault(capacity, []).append([(), fresh])
                continue
            pattern, n = bins[room].pop()
            if not bins[room]:
                del bins[room]
            times = room // length
            full = min(n, left // times)
            parts = [(full, times)] if full else []
            if full < n and left - full * times:
                parts.append((1, min(times, left - full * times)))
            for m, t in parts:
                left -= m * t
                bins.setdefault(room - t * length, []).append([(*pattern, (length, t)), m])
            rest = n - sum(m for m, _ in parts)
            if rest:
                bins.setdefault(room, []).append([pattern, rest])
    return [(p, n) for group in bins.values() for p, n in group if p]


def dominated(a: list[int], b: list[int]) -> bool:
    """Whether the pieces of filling a fit into the places that the pieces of b take (largest first)."""
    rooms = sorted(b, reverse=True)
    for x in sorted(a, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= x]
        if not fit:
            return False
        rooms[min(fit, key=lambda i: rooms[i])] -= x
    return True


def fillings(room: int, lengths: list[int], counts: dict[int, int], limit: int = FILLINGS) -> list[list[int]]:
    """Undominated fillings of a room, least waste first, from the lengths (largest first) left."""
    found: list[tuple[int, list[int]]] = []
    steps = 0

    def extend(start: int, room: int, taken: list[int], used: dict[int, int]) -> bool:
        """Depth first, larger pieces first; True once enough full fillings are known."""
        nonlocal steps
        maximal = True
        for n in range(start, len(lengths)):
            x = lengths[n]
            if x > room or used.get(x, 0) >= counts[x]:
                continue
            maximal = False
            steps += 1
            used[x] = used.get(x, 0) + 1
            done = extend(n, room - x, [*taken, x], used)
            used[x] -= 1
            if done or steps > 40 * limit:
                return done
        if maximal:
            found.append((room, taken))
        return sum(w == 0 for w, _ in found) >= limit

    # the closest single piece and pair first, so that the depth-first walk starts near full
    extend(bisect.bisect_left([-x for x in lengths], -room), room, [], {})
    asc = lengths[::-1]
    for x in lengths[: 4 * limit]:
        if x < room:
            y = bisect.bisect_right(asc, room - x) - 1
            if y >= 0 and counts[asc[y]] > (asc[y] == x):
                found.append((room - x - asc[y], sorted((x, asc[y]), reverse=True)))
    found.sort(key=lambda f: (f[0], len(f[1])))
    out: list[list[int]] = []
    for _, f in found:
        if f not in out and not any(dominated(f, g) for g in out):
            out.append(f)
        if len(out) == limit:
            break
    return out or [[]]


def every_filling(room: int, lengths: list[int], counts: dict[int, int]) -> Iterator[list[int] | None]:
    """All fillings that no piece left fits into, one by one, larger pieces first; None for a dead end on the way."""
    volume = [0]
    for x in reversed(lengths):
        volume.append(volume[-1] + x * counts[x])
    volume.reverse()  # of the lengths from n on
    asc = [-x for x in lengths]
    stack: list[tuple[int, int, int, tuple[int, ...]]] = [(0, room, room + 1, ())]
    while stack:
        n, room, skipped, taken = stack.pop()
        n = max(n, bisect.bisect_left(asc, -room))
        if room - volume[n] >= skipped:
            yield None
        elif n == len(lengths):
            yield list(taken)
        else:
            x = lengths[n]
            most = min(counts[x], room // x)
            stack += [(n + 1, room - t * x, skipped if t == counts[x] else x, taken + (x,) * t) for t in range(most + 1)]


def bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that are needed at least.

    For every a: pieces over half share no sequence, those over capacity - a
    take no piece of a or more, and the volume of the pieces from a to half
    fits beside the others or needs sequences of its own. a = 0 is the volume.
    """
    n = np.zeros(capacity + 2, np.int64)
    n[list(counts)] = list(counts.values())
    count, volume = np.cumsum(n), np.cumsum(n * np.arange(capacity + 2))
    half = capacity // 2
    a = np.arange(half + 1)
    large = count[capacity] - count[half]
    beside = (count[capacity - a] - count[half]) * capacity - (volume[capacity - a] - volume[half])
    small = volume[half] - np.where(a > 0, volume[np.maximum(a - 1, 0)], 0)
    return int((large + np.maximum(0, -(-(small - beside) // capacity))).max())


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Patterns that hold all pieces in as few sequences as the search finds."""
    counts = {x: n for x, n in counts.items() if n > 0}
    incumbent = best_fit(counts, capacity)
    least, best = bound(counts, capacity), sum(n for _, n in incumbent)
    volume = sum(x * n for x, n in counts.items())

    def branch(left: dict[int, int], every: bool) -> Iterator[tuple[tuple, int, dict[int, int]] | None]:
        big = max(left)
        rest = dict(left)
        rest[big] -= 1
        lengths = sorted((x for x, n in rest.items() if n), reverse=True)
        for f in (every_filling if every else fillings)(capacity - big, lengths, rest):
            if f is None:
                yield None
                continue
            pattern = tuple(sorted(((x, [big, *f].count(x)) for x in {big, *f}), reverse=True))
            most = min(left[x] // t for x, t in pattern)
            for times in range(most, 0 if every else most - 1, -1):
                after = {x: n for x in left if (n := left[x] - times * dict(pattern).get(x, 0))}
                yield pattern, times, after

    for every in (False, True):
        stack = [(counts, branch(counts, every), 0, 0)] if counts else []  # counts left, its branches, sequences, waste
        taken: list[Pattern] = []
        while stack and best > least and nodes > 0:
            left, options, used, waste = stack[-1]
            try:
                option = next(options)
            except StopIteration:
                stack.pop()
                if taken:
                    taken.pop()
                continue
            nodes -= 1
            if option is None:
                continue
            pattern, times, after = option
            used, waste = used + times, waste + times * (capacity - sum(x * t for x, t in pattern))
            # all sequences but the last: capacity x best - 1 - volume may be wasted at most to beat the incumbent
            if used + (bound(after, capacity) if after else 0) >= best or waste > capacity * (best - 1) - volume:
                continue
            if not after:
                incumbent, best = [*taken, (pattern, times)], used
                continue
            taken.append((pattern, times))
            stack.append((after, branch(after, every), used, waste))
    return incumbent


class Plan:
    """Where the pieces of each length go, by their rank."""

    def __init__(self, patterns: list[Pattern]):
        slots: dict[int, list[tuple[int, int, int, int]]] = {}
        filled: dict[int, int] = {}
        base = 0
        for pattern, n in patterns:
            offset = 0
            for length, times in pattern:
                first = filled.get(length, 0)
                slots.setdefault(length, []).append((first, base, times, offset))
                filled[length] = first + n * times
                offset += length * times
            base += n
        self.sequences = base
        self.slots = {x: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for x, rows in slots.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            first, base, times, start = self.slots[int(x)]
            n = np.searchsorted(first, rank[at], side="right") - 1
            nth = rank[at] - first[n]
            sequence[at] = base[n] + nth // times[n]
            offset[at] = start[n] + nth % times[n] * x
        return sequence, offset


def _cut(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = encoder(path), np.uint32(end_id).tobytes()
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = code.encode(text) + end
                n = len(raw) // 4
                head = n % capacity or capacity
                for piece, start in enumerate((0, *range(head, n, capacity))):
                    length = capacity if piece else head
                    rows.append((doc, piece, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == 1 else pa.int64()) for n, c in enumerate(zip(*rows, strict=True))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def _placed(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = plan.place(b.column(3).to_numpy(), b.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names=[*b.schema.names[:5], "sequence_id", "offset"])

    return run


RESULT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(spark: SparkSession, documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id alone. Rows that repeat are packed as
    often as they occur, those with a null doc_id too.
    """
    docs = documents.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    pieces = shared(spark, docs.mapInArrow(_cut(path, capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long"), "pack-pieces")
    plan = Plan(complete_bins({r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}, capacity))
    salts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("nth", rank - 1).join(offsets, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(_placed(plan), RESULT)


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
