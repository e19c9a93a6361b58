"""Training table.

The wide results table is the only large input. It meets the selection
(at most five catalog entries per request) through a join whose small side
has a proven row bound (5 x number of requests); whether it is broadcast is
left to Spark's check of its size in bytes.
The chosen (race, event) pairs, metadata of the same bound, are also turned
into a literal predicate so that a partitioned source is pruned at planning
time (``PartitionFilters``).

Editions spell their columns differently (km_5 or km_5_0). ``source_columns``
lists the spellings that any plan reads; one scan declares just these, a file
without one reads it as null, and a split takes the first spelling that its
row has. So every request is served by one pruned scan of the stored table.

The multi-request table is long: (request, athlete row, split, seconds).
Each request's plan travels with its selection rows as an array of places in
the declared columns, so the wide side is never shuffled and never unpivoted
into all of its columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelens.operators.history import KIND_DIRECT, KIND_IMPOSSIBLE
from racelens.operators.requests import clean_filter

ID_COLUMNS = ["athlete_id", "event_id", "event_std", "gender", "age"]
TASK_ROWS = 1_000_000       # rows of the long table that one task sorts and writes


def literal_pair_filter(pairs: list[tuple[str, str]]) -> F.Column | None:
    """One condition per set of events, over all races that have it: static partition pruning."""
    if not pairs:
        return None
    events: dict[str, set[str]] = {}
    for r, e in pairs:
        events.setdefault(r, set()).add(e)
    races: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(events):
        races.setdefault(tuple(sorted(events[r])), []).append(r)
    conds = [F.col("race_id").isin(rs) & F.col("event_id").isin(list(es)) for es, rs in races.items()]
    return reduce(lambda a, b: a | b, conds)


def result_filter(wide: DataFrame, selection: DataFrame, requests: DataFrame, n_requests: int | None = None,
                  prune_pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Rows of the chosen (race, event) pairs, per request, plus the
    request's optional event filters ('None', empty, null = no filter)."""
    keep = [c for c in selection.columns if c in ("race_id", "event_id") or c not in wide.columns]
    sel = (selection.select(*keep)
           .join(requests.select("req_key", clean_filter("event_id_filter").alias("eid_f"),
                                 clean_filter("event_std_filter").alias("estd_f")), "req_key"))
    if prune_pairs is not None:
        lit_cond = literal_pair_filter(prune_pairs)
        if lit_cond is not None:
            wide = wide.filter(lit_cond)
    j = wide.join(sel, ["race_id", "event_id"])
    return j.filter((F.col("eid_f").isNull() | (F.col("event_id") == F.col("eid_f")))
                    & (F.col("estd_f").isNull() | (F.col("event_std") == F.col("estd_f"))))


def source_columns(plan: DataFrame) -> list[str]:
    """Every column name that a direct split of any plan may be read from (one row per name, metadata)."""
    names = plan.filter(F.col("kind") == KIND_DIRECT).select(F.explode("sources").alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


def plan_arrays(plan: DataFrame, columns: list[str]) -> DataFrame:
    """Per request: the final splits as an ordered array of (ord, alias, split, direct, at);
    ``at`` are the places of its sources among ``columns``, the requested name first."""
    kept = plan.filter(F.col("kind") != KIND_IMPOSSIBLE)
    declared = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
    at = F.filter(F.transform("sources", lambda s: F.array_position(declared, s).cast("int") - 1), lambda i: i >= 0)
    kept = kept.select("req_key", "ord", "alias", "split", (F.col("kind") == KIND_DIRECT).alias("direct"), at.alias("at"))
    return kept.groupBy("req_key").agg(F.array_sort(F.collect_list(
        F.struct("ord", "alias", "split", "direct", "at"))).alias("plan"))


def training_rows(wide: DataFrame, selection: DataFrame, plan: DataFrame, requests: DataFrame,
                  split_columns: list[str], prune_pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """The rows of every request: req_key, nombre, identity columns and ``picked``,
    the request's final splits in order as (ord, split under its published name, secs).

    Direct splits read the first non-null historical column of the same
    distance (requested name first); interpolated splits are null, to be
    filled by the distance-ratio model."""
    sel = selection.join(plan_arrays(plan, split_columns), "req_key")
    rows = result_filter(wide, sel.select("req_key", "race_id", "event_id", "nombre", "plan"),
                         requests, prune_pairs=prune_pairs)
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in split_columns]).cast("array<double>")
    picked = F.transform(F.col("plan"), lambda p: F.struct(
        p["ord"].alias("ord"), p["alias"].alias("split"),
        F.when(p["direct"], F.get(F.filter(F.transform(p["at"], lambda i: F.get(F.col("_v"), i)),
                                           lambda v: v.isNotNull()), F.lit(0))).alias("secs")))
    return (rows.select("req_key", "nombre", *ID_COLUMNS, values.alias("_v"), "plan")
            .select("req_key", "nombre", *ID_COLUMNS, picked.alias("picked")))


def training_table(wide: DataFrame, selection: DataFrame, plan: DataFrame, requests: DataFrame,
                   split_columns: list[str], n_requests: int | None = None,
                   prune_pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """R11 (long form, all requests in one plan): req_key, nombre, athlete_id,
    event_id, event_std, gender, age, ord, split (published name), secs."""
    rows = training_rows(wide, selection, plan, requests, split_columns, prune_pairs)
    return rows.select("req_key", "nombre", *ID_COLUMNS, F.inline("picked"))


def training_projection_keyed(wide: DataFrame, selection: DataFrame, plan: DataFrame, requests: DataFrame,
                              split_columns: list[str], prune_pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """R10 for every request in one table: a row per result, with the request's
    published names and their values in request order, comma-joined (a missing
    value is empty). Published names differ by request, so they are data here;
    ``training_projection`` gives one request's columns."""
    rows = training_rows(wide, selection, plan, requests, split_columns, prune_pairs)
    value = lambda x: F.coalesce(x["secs"].cast("decimal(18,3)").cast("string"), F.lit(""))
    return rows.select("req_key", *ID_COLUMNS,
                       F.array_join(F.transform("picked", lambda x: x["split"]), ",").alias("split_names"),
                       F.array_join(F.transform("picked", value), ",").alias("split_secs"))


def training_projection(wide: DataFrame, plan_rows: list, split_columns: list[str]) -> DataFrame:
    """R10 for one request (wide form): identity columns plus one column per
    final split under its published name. ``plan_rows`` are the request's
    collected plan rows (bounded by the number of requested splits)."""
    have = set(split_columns)
    cols = [F.col(c) for c in ID_COLUMNS]
    for p in sorted(plan_rows, key=lambda r: r["ord"]):
        if p["kind"] == KIND_IMPOSSIBLE:
            continue
        if p["kind"] == KIND_DIRECT:
            srcs = [F.col(f"`{s}`") for s in p["sources"] if s in have]
            val = F.coalesce(*srcs) if srcs else F.lit(None)
        else:
            val = F.lit(None)
        cols.append(val.cast("double").alias(p["alias"]))
    return wide.select(*cols)


def schema_fingerprint(plan: DataFrame) -> DataFrame:
    """temp_wide_{md5 of the sorted final split names joined by '_'}[:8]."""
    kept = plan.filter(F.col("kind") != KIND_IMPOSSIBLE)
    key = F.array_join(F.array_sort(F.collect_list("split")), "_")
    return kept.groupBy("req_key").agg(key.alias("split_key")).select(
        "req_key", F.concat(F.lit("temp_wide_"), F.substring(F.md5("split_key"), 1, 8)).alias("source_table"))


def preview(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """A deterministic look at the first rows (top-k by key)."""
    return df.orderBy(*order_cols).limit(n)


def _first_of_each(batches: Iterator[pa.RecordBatch], key: str, order_cols: list[str], n: int) -> Iterator[pa.RecordBatch]:
    """The first ``n`` rows of every key that a task has, in Spark's order; it holds these and one batch."""
    kept = None
    for b in batches:
        t = pa.Table.from_batches([b]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([b])])
        by = {}
        for c in [key, *order_cols]:
            col = t.column(c)
            if pa.types.is_floating(col.type):     # NaN comes after every number
                nan = pc.is_nan(col)
                by[c], by[f"{c} nan"] = pc.if_else(nan, pa.scalar(float("inf"), col.type), col), nan
            else:
                by[c] = col
        at = pc.sort_indices(pa.table(by), sort_keys=[(c, "ascending") for c in by], null_placement="at_start")
        codes = t.column(key).combine_chunks().dictionary_encode("encode").indices.to_numpy()[at]
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
        kept = t.take(at.filter(pa.array(place < n)))
    if kept is not None:
        yield from kept.combine_chunks().to_batches()


def preview_each(df: DataFrame, key: str, order_cols: list[str], n: int = 5) -> DataFrame:
    """S8 for a table of many requests: the first rows of each. Every task keeps n rows a key
    as it reads, so that no task sorts its rows; the few that are left are ranked."""
    first = df.mapInArrow(lambda b: _first_of_each(b, key, order_cols, n), df.schema)
    w = Window.partitionBy(key).orderBy(*order_cols)
    return first.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def write_by_request(rows: DataFrame, n_rows: int, path: str) -> str:
    """Writes the long table of ``training_rows`` a folder a request. The writer sorts a task's rows by request,
    so ``n_rows``, their number in the long form, gives the number of tasks: contiguous ranges of about TASK_ROWS each."""
    spread = rows.repartitionByRange(max(1, -(-n_rows // TASK_ROWS)), "req_key", F.xxhash64(*[c for c in rows.columns if c != "req_key"]))
    (spread.select("req_key", "nombre", *ID_COLUMNS, F.inline("picked")).write.mode("overwrite")
     .option("compression", "snappy").partitionBy("req_key").parquet(path))
    return path


def training_size(wide: DataFrame, selection: DataFrame, plan: DataFrame) -> int:
    """Rows of the long table at most, from the rows of every edition (no column is read) and the splits of every plan."""
    sizes = wide.groupBy("race_id", "event_id").agg(F.count(F.lit(1)).alias("n"))
    splits = plan.filter(F.col("kind") != KIND_IMPOSSIBLE).groupBy("req_key").agg(F.count(F.lit(1)).alias("k"))
    return selection.join(sizes, ["race_id", "event_id"]).join(splits, "req_key").agg(F.sum(F.col("n") * F.col("k"))).first()[0] or 0
