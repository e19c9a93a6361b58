"""Exact grouped quantiles with bounded memory per group.

Spark's exact ``percentile`` keeps a value->count map per group and merges
the whole map of a group in one task, so a group holding a third of all rows
needs memory proportional to its distinct values. ``exact_quantiles`` returns
the same numbers (linear interpolation between order statistics, position
(n-1)p) for all measures and probabilities of a row set in one run of three
aggregates over the rows:

1. per group and measure: n, least, largest, and ``percentile_approx`` at
   p -/+ 4/accuracy and p -/+ WIDE, brackets around the wanted order statistics
   (a sketch errs by n/accuracy ranks; the rest is room for merged sketches);
2. per group: how many values lie below each edge, or at it. The narrowest
   bracket that covers the wanted ranks is taken; the range from least to
   largest value, which always does, is the last choice;
3. ``row_number`` over the rows strictly inside a taken bracket (about
   8n/accuracy, or 2 n WIDE where that is under a rank). Values at an edge are
   known from the counts, so heavy ties are never ranked.

The results of the first two, a row per group, are materialised in the shared
checkpoint folder. The rows are read three times: the caller materialises them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 100_000
WIDE = 1 / 250      # half width of the second bracket, for groups of 250 rows and more

FIELDS = ("lo", "hi", "up_to_lo", "below_hi", "k", "k1", "frac", "ranked")    # of a taken bracket

Spec = tuple[str, str, list[float]]     # name of the result, measure, probabilities


def _brackets(probs: list[float], accuracy: int) -> list[tuple[float, float]]:
    return [(max(0.0, p - eps), min(1.0, p + eps)) for p in probs for eps in (4.0 / accuracy, WIDE)]


def _at_edges(v: Column, lo: Column, hi: Column) -> list[Column]:
    """Counts of values below and up to either edge."""
    return [F.count_if(v < lo), F.count_if(v <= lo), F.count_if(v < hi), F.count_if(v <= hi)]


def _taken(s: str, probs: list[float]) -> list[Column]:
    """Per probability: the narrowest bracket that covers ranks k and k + 1, as a struct."""
    out = []
    for j, p in enumerate(probs):
        n = F.col(f"_n{s}")
        position = (n - 1) * F.lit(p)
        k = F.floor(position).cast("long")
        k1 = F.least(k + 1, n - 1)

        def bracket(lo, hi, up_to_lo, below_hi, k=k, k1=k1, position=position):
            inside = lambda r: (r >= up_to_lo) & (r < below_hi)
            return F.struct(lo.alias("lo"), hi.alias("hi"), up_to_lo.alias("up_to_lo"), below_hi.alias("below_hi"),
                            k.alias("k"), k1.alias("k1"), (position - k).alias("frac"),
                            (inside(k) | inside(k1)).alias("ranked"))

        choice = []
        for e in (2 * j, 2 * j + 1):
            c = F.col(f"_c{s}_{e}")
            found = bracket(F.col(f"_lo{s}")[e], F.col(f"_hi{s}")[e], c[1], c[2])
            choice.append(F.when((c[0] <= k) & (c[3] > k1), found))
        ends = bracket(F.col(f"_min{s}"), F.col(f"_max{s}"), F.col(f"_c{s}_ends")[1], F.col(f"_c{s}_ends")[2])
        out.append(F.coalesce(*choice, F.when(n > 0, ends)).alias(f"_b{s}_{j}"))
    return out


def exact_quantiles(rows: DataFrame, keys: list[str], specs: list[Spec], aggs: list[Column] | None = None,
                    accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """keys..., the aggregates ``aggs`` (of the first pass), and per spec an array of quantiles.

    Nulls are left out; a group without values has null quantiles. ``rows`` is read three times."""
    measures = {name: F.col(col).cast("double") for name, col, _ in specs}
    first = []
    for s, col, probs in specs:
        v, edges = measures[s], _brackets(probs, accuracy)
        first += [F.count(v).alias(f"_n{s}"), F.min(v).alias(f"_min{s}"), F.max(v).alias(f"_max{s}"),
                  F.percentile_approx(v, [lo for lo, _ in edges], accuracy).alias(f"_lo{s}"),
                  F.percentile_approx(v, [hi for _, hi in edges], accuracy).alias(f"_hi{s}")]
    stats = rows.groupBy(*keys).agg(*(aggs or []), *first).checkpoint()
    values = rows.select(*keys, *[v.alias(f"_v{s}") for s, v in measures.items()])

    counts = []
    for s, _, probs in specs:
        v = F.col(f"_v{s}")
        counts += [F.array(*_at_edges(v, F.col(f"_lo{s}")[e], F.col(f"_hi{s}")[e])).alias(f"_c{s}_{e}")
                   for e in range(2 * len(probs))]
        counts.append(F.array(*_at_edges(v, F.col(f"_min{s}"), F.col(f"_max{s}"))).alias(f"_c{s}_ends"))
    edges = stats.select(*keys, *[f"_{part}{s}" for s, _, _ in specs for part in ("lo", "hi", "min", "max")])
    counted = values.join(edges, keys).groupBy(*keys).agg(*counts)
    taken = stats.join(counted, keys)
    chosen = [b for s, _, probs in specs for b in _taken(s, probs)]
    own = [c for c in stats.columns if not c.startswith("_") or c in keys]
    slots = [(s, j) for s, _, probs in specs for j in range(len(probs))]
    # plain columns: fields of structs in a filter below a generator make the optimizer derive constraints without end
    taken = taken.select(*own, *chosen).select(*own, *[F.col(f"_b{s}_{j}")[f].alias(f"_{f}_{i}")
                                                       for i, (s, j) in enumerate(slots) for f in FIELDS]).checkpoint()

    def col(field: str, i: int) -> Column:
        return F.col(f"_{field}_{i}")

    hit = [col("ranked", i) & (F.col(f"_v{s}") > col("lo", i)) & (F.col(f"_v{s}") < col("hi", i)) for i, (s, _) in enumerate(slots)]
    inside = values.join(taken.drop(*[c for c in own if c not in keys]), keys).filter(reduce(Column.__or__, hit))
    inside = inside.select(*keys, F.inline(F.array(*[
        F.when(hit[i], F.struct(F.lit(i).alias("_slot"), F.col(f"_v{s}").alias("_v"), (col("k", i) - col("up_to_lo", i)).alias("_r"),
                                (col("k1", i) - col("up_to_lo", i)).alias("_r1")))
        for i, (s, _) in enumerate(slots)]))).filter("_slot is not null")
    rank = F.row_number().over(Window.partitionBy(*keys, "_slot").orderBy("_v")) - 1
    inside = inside.withColumn("_at", rank).filter("_at = _r or _at = _r1")
    picked = inside.groupBy(*keys).agg(*[F.max(F.when((F.col("_slot") == i) & (F.col("_at") == F.col(r)), F.col("_v"))).alias(f"{r}_{i}")
                                         for i in range(len(slots)) for r in ("_r", "_r1")])

    def quantile(i: int) -> Column:
        def at(r: Column, mid: Column) -> Column:
            return F.when(r < col("up_to_lo", i), col("lo", i)).when(r >= col("below_hi", i), col("hi", i)).otherwise(mid)
        low, high = at(col("k", i), F.col(f"_r_{i}")), at(col("k1", i), F.col(f"_r1_{i}"))
        return F.when(low == high, low).otherwise(low + col("frac", i) * (high - low))

    return taken.join(picked, keys, "left").select(
        *own, *[F.array(*[quantile(i) for i, (of, _) in enumerate(slots) if of == s]).alias(s) for s, _, _ in specs])


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], mode: str = "exact",
                      accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Wide form: keys..., one column per probability named q{index}.

    mode 'exact'   : Spark ``percentile`` (fine for moderate groups)
         'bracket' : exact with bounded memory per group (any group size; reads ``df`` three times)
         'approx'  : ``percentile_approx`` (rank error <= n/accuracy)
    """
    if mode == "bracket":
        q = exact_quantiles(df, keys, [("q", value, list(probs))], accuracy=accuracy)
    else:
        agg: Column = (F.percentile(value, list(probs)) if mode == "exact"
                       else F.percentile_approx(value, list(probs), accuracy))
        q = df.groupBy(*keys).agg(agg.alias("q"))
    return q.select(*keys, *[F.col("q")[i].alias(f"q{i}") for i in range(len(probs))])
