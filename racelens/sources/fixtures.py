"""Race tables derived from the driver's TPC-H style tables.

One order is one finisher and each line item one leg (see FIXTURES.md):

* ``finishers``  orders x customer: athlete, race, event and person attributes
* ``race_legs``  per order: leg number and running seconds (window per order)
* ``race_long``  legs x finishers: one row per (finisher, split)
* ``race_wide``  one row per finisher, one double column per split (as many as the longest order has legs)
* ``wide_rows``   chosen columns of it with so many splits
* ``stored_wide`` chosen columns of it, written once and read back
* ``race_catalog`` one row per (race, event) with its split-name list
* ``raw_requests`` the request batch: literal edge cases plus one request per
  race edition found in the data, so the batch grows with the data

Plan notes: line items are shuffled exactly once (by order key) - the leg
window, the wide pivot and the join to finishers all reuse that hash
partitioning. Orders meet customers first on the customer key, so the large
line-item side never takes part in that second shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelens.functions import names as N

# --- fixed values of the derived fixture (FIXTURES.md) ---------------------
LEG_KM = 5.0            # each leg is 5 km
BASE_SECS = 1200        # leg seconds = 1200 + 10 * quantity
SECS_PER_QTY = 10
AGE_BASE, AGE_SPAN = 18, 60
GENDER_BY_MOD5 = ("M", "F", "male", "FEMALE", None)
URGENT_EVENTS = ("1", "2")
TASK_LEGS = 500_000     # line items that one task sorts for the wide table
GUESS_LEGS = 24         # splits that the stored wide table is first cut into
LEAP_GAP_LEG = 4        # years divisible by 4 lack the 20 km entry
# Standard split list of the requests derived from each race edition.
EDITION_REQUEST_SPLITS = ["km_5", "km_10", "km_15", "km_20", "half", "km_30", "km_40"]
# Literal requests: (key, pos, nombre, carrera, splits, event_id_filter,
#                    event_std_filter, tipo_modelo)
LITERAL_REQUESTS = [
    ("b4-0", 0, "automobile-2001", None,
     ["km_5", "KM_20", "km_10.00", "km_7", "km_12.5", "half", "checkpoint"], None, None, "interpolacion"),
    ("b4-1", 1, "building-1996", None,
     ["km_5_0", "km_10_0", "km_15_0", "km_20_0", "km_25_0", "km_30_0", "km_35_0", "km_40_0"],
     None, None, "interpolacion"),
    ("b4-2", 2, "machinery-1995", None, ["km_5"], None, None, "interpolacion"),
    ("b4-3", 3, "unknown-2001", None, ["km_5"], None, None, "interpolacion"),
    ("b4-4", 4, "badname", None, ["km_5"], None, None, "interpolacion"),
    ("b4-5", 5, None, "household-1999", ["km_5", "km_10", "finish"], None, None, None),
    ("b4-6", 6, "furniture-2000", None, [], None, None, "interpolacion"),
    ("b4-7", 7, "", None, ["km_5"], None, None, "interpolacion"),
    ("b4-8", 8, "household-2001", None, ["km_5", "km_10", "km_15", "km_20", "km_25"],
     "None", "urgent", "prediccion"),
    ("b4-9", 9, "building-2000", None, ["km_5", "km_18.2", "km_18_2", "half", "finish"],
     "3", None, "interpolacion"),
    ("b4-10", 10, "machinery-2001", None, ["km_5", "km_10"], None, None, "clasificacion"),
]
# ---------------------------------------------------------------------------

REQUEST_SCHEMA = ("req_key string, req_pos int, nombre string, carrera string, splits array<string>, "
                  "event_id_filter string, event_std_filter string, tipo_modelo string")


def _read(spark: SparkSession, sf_dir: str, table: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def finishers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    event = F.substring("o_orderpriority", 1, 1)
    gender = F.when(F.col("o_custkey") % 5 == 0, GENDER_BY_MOD5[0])
    for i, g in enumerate(GENDER_BY_MOD5[1:], start=1):
        gender = gender.when(F.col("o_custkey") % 5 == i, F.lit(g))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("o_orderkey").alias("finisher_id"),
                    F.col("o_custkey").cast("string").alias("athlete_id"),
                    F.concat(F.lower("c_mktsegment"), F.lit("-"),
                             F.year("o_orderdate").cast("string")).alias("race_id"),
                    event.alias("event_id"),
                    F.when(event.isin(*URGENT_EVENTS), "urgent").otherwise("regular").alias("event_std"),
                    gender.alias("gender"),
                    (F.lit(AGE_BASE) + F.col("o_custkey") % AGE_SPAN).cast("int").alias("age")))


def race_legs(spark: SparkSession, sf_dir: str, rows: int = 0) -> DataFrame:
    """Leg number and running seconds by a window per order; the number of tasks follows from
    the number of line items (file footers), or of other ``rows`` that meet them there, so that
    what a task sorts does not grow with them."""
    # the last of LEG_ORDER, the price, orders none but legs of equal quantity, which have equal seconds
    li = _read(spark, sf_dir, "lineitem", ["l_orderkey", *LEG_ORDER[:-1]])
    li = li.repartition(max(spark.sparkContext.defaultParallelism, -(-max(li.count(), rows) // TASK_LEGS)), "l_orderkey")
    w = Window.partitionBy("l_orderkey").orderBy(*LEG_ORDER[:-1])
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return li.select("l_orderkey",
                     F.row_number().over(w).alias("leg"),
                     F.sum(F.lit(BASE_SECS) + F.lit(SECS_PER_QTY) * F.col("l_quantity")).over(running).alias("secs"))


LEG_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def race_legs_ranged(spark: SparkSession, sf_dir: str, n_ranges: int | None = None) -> DataFrame:
    """Leg number and running seconds without putting one order in one task.

    ``repartitionByRange`` on (order, leg order) cuts the global order into
    contiguous ranges, so an order holding a third of all line items is spread
    over many tasks. Each (range, order) piece is ranked and summed locally
    (bounded by one range), a small table of piece totals gives each piece
    its offset (cumulative count and seconds of the earlier pieces of the
    same order), and one join adds it back. Only orders at a range edge can
    span ranges (at most two per range), so that table is bounded by the
    number of ranges and is broadcast. Equal leg-order keys tie as in the
    window version: same seconds, legs in either order."""
    li = _read(spark, sf_dir, "lineitem", ["l_orderkey"] + LEG_ORDER)
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w_secs = F.lit(BASE_SECS) + F.lit(SECS_PER_QTY) * F.col("l_quantity")
    ranged = (li.repartitionByRange(n, "l_orderkey", *LEG_ORDER)
              .withColumn("_piece", F.spark_partition_id())
              .withColumn("_w", w_secs)
              .checkpoint())   # the range bounds are sampled: fix them once for all three readers
    local = Window.partitionBy("_piece", "l_orderkey").orderBy(*LEG_ORDER)
    run = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = ranged.select("l_orderkey", "_piece", F.row_number().over(local).alias("_r"),
                           F.sum("_w").over(run).alias("_s"))
    # only orders at a range edge can continue into the next range: at most two
    # candidates per range, so their totals and offsets are tiny (broadcast)
    edges = ranged.groupBy("_piece").agg(F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"))
    cand = edges.select(F.explode(F.array("lo", "hi")).alias("l_orderkey")).distinct()
    totals = (pieces.join(F.broadcast(cand), "l_orderkey", "left_semi")
              .groupBy("l_orderkey", "_piece").agg(F.max("_r").alias("_n"), F.max("_s").alias("_t")))
    before = Window.partitionBy("l_orderkey").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("l_orderkey", "_piece",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_on"),
                            F.coalesce(F.sum("_t").over(before), F.lit(0.0)).alias("_os"))
    return (pieces.join(F.broadcast(offsets), ["l_orderkey", "_piece"], "left")
            .select("l_orderkey", (F.col("_r") + F.coalesce("_on", F.lit(0))).cast("int").alias("leg"),
                    (F.col("_s") + F.coalesce("_os", F.lit(0.0))).alias("secs")))


def race_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs = race_legs_ranged(spark, sf_dir)
    fin = finishers(spark, sf_dir)
    return (legs.join(fin, legs.l_orderkey == fin.finisher_id)
            .select("finisher_id", "athlete_id", "race_id", "event_id", "event_std", "gender", "age", "leg",
                    F.concat(F.lit("km_"), (F.col("leg") * int(LEG_KM)).cast("string")).alias("split"),
                    (F.col("leg") * LEG_KM).alias("dist_km"), "secs"))


_leg_counts: dict[tuple[str, str], int] = {}


def leg_count(spark: SparkSession, sf_dir: str) -> int:
    """Legs of the longest order: one count per order with partial aggregation, once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _leg_counts:
        per_order = _read(spark, sf_dir, "lineitem", ["l_orderkey"]).groupBy("l_orderkey").count()
        _leg_counts[key] = per_order.agg(F.max("count")).first()[0] or 0
    return _leg_counts[key]


def wide_split_names(n: int) -> list[str]:
    return [f"km_{int(LEG_KM * k)}" for k in range(1, n + 1)]


def _pivot(legs: DataFrame, names: list[str], *aggs: F.Column) -> DataFrame:
    return legs.groupBy("l_orderkey").agg(*[
        F.max(F.when(F.col("leg") == k, F.col("secs"))).alias(name)
        for k, name in enumerate(names, start=1)], *aggs)


def race_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot all legs per order (same partitioning as the window), then attach
    the finisher attributes: one row per finisher, splits as double columns."""
    names = wide_split_names(leg_count(spark, sf_dir))
    piv = _pivot(race_legs(spark, sf_dir), names)
    fin = finishers(spark, sf_dir)
    return (piv.join(fin, piv.l_orderkey == fin.finisher_id)
            .select("finisher_id", "athlete_id", "race_id", "event_id", "event_std", "gender", "age",
                    *names))


def wide_rows(spark: SparkSession, sf_dir: str, columns: list[str], n: int, every_order: bool = True) -> DataFrame:
    """``race_wide`` with these finisher columns alone and ``n`` splits, and the number of an order's legs (``_legs``).

    ``every_order``: those without a finisher too, with nulls for it. A task's finishers are kept as a hash table, so
    that the wide rows need no sort; their number is bounded as that of the line items is."""
    names = wide_split_names(n)
    orders = _read(spark, sf_dir, "orders", ["o_orderkey"]).count()
    piv = _pivot(race_legs(spark, sf_dir, orders), names, F.max("leg").alias("_legs"))
    fin = finishers(spark, sf_dir).select("finisher_id", *[c for c in columns if c != "finisher_id"]).hint("shuffle_hash")
    return piv.join(fin, piv.l_orderkey == fin.finisher_id, "left" if every_order else "inner").select(*columns, *names, "_legs")


def known_legs(spark: SparkSession, sf_dir: str, found: int | None = None) -> int | None:
    """Legs of the longest order where this session knows them, or has just ``found`` them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if found is not None:
        _leg_counts[key] = found
    return _leg_counts.get(key)


def stored_wide(spark: SparkSession, sf_dir: str, columns: list[str], path: str) -> DataFrame:
    """``race_wide`` with these finisher columns alone, written to ``path`` and read back.

    Line items are shuffled once: the longest order is found with the pivot, not by a count before it. Legs are
    counted beside ``GUESS_LEGS`` splits, over all orders (those without a finisher too, as ``leg_count`` does);
    where an order has more, the pivot is made again with as many splits as it has."""
    key = (spark.sparkContext.applicationId, sf_dir)
    n, known = _leg_counts.get(key, GUESS_LEGS), key in _leg_counts
    rows = wide_rows(spark, sf_dir, columns, n, not known)
    rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    if not known:
        _leg_counts[key] = stored.agg(F.max("_legs")).first()[0] or 0
        if _leg_counts[key] > n:
            return stored_wide(spark, sf_dir, columns, f"{path}-{_leg_counts[key]}")
    return stored.filter("finisher_id is not null").select(*columns, *wide_split_names(_leg_counts[key]))


def catalog_split_names(year, n: int) -> F.Column:
    """Split list of a catalog entry: km_5, km_10, ... (n legs) in even years,
    the same distances spelled km_5_0, km_10_0, ... in odd years, no 20 km
    entry in years divisible by four."""
    legs = F.filter(F.sequence(F.lit(1), F.lit(n)),
                    lambda k: ~((year % 4 == 0) & (k == LEAP_GAP_LEG)))
    return F.transform(legs, lambda k: F.concat(
        F.lit("km_"), (k * int(LEG_KM)).cast("string"),
        F.when(year % 2 == 1, F.lit("_0")).otherwise(F.lit(""))))


def race_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (race, event). Partial aggregation collapses the finisher
    rows map-side, so only distinct (race, event) keys are shuffled."""
    cat = (finishers(spark, sf_dir).groupBy("race_id", "event_id")
           .agg(F.max("event_std").alias("event_std")))
    year = N.race_edition_year(F.col("race_id"))
    return cat.select("race_id", "event_id", "event_std", catalog_split_names(year, leg_count(spark, sf_dir)).alias("splits"))


def raw_requests(spark: SparkSession, sf_dir: str, catalog: DataFrame | None = None) -> DataFrame:
    """Literal edge-case requests plus one request per race edition (taken
    from the catalog when given, so the finishers are aggregated once)."""
    lit_df = spark.createDataFrame(LITERAL_REQUESTS, REQUEST_SCHEMA)
    src = catalog if catalog is not None else finishers(spark, sf_dir)
    editions = (src.select("race_id").distinct()
                .select(F.concat(F.lit("ed-"), "race_id").alias("req_key"),
                        F.lit(None).cast("int").alias("req_pos"),
                        F.col("race_id").alias("nombre"),
                        F.lit(None).cast("string").alias("carrera"),
                        F.array(*[F.lit(s) for s in EDITION_REQUEST_SPLITS]).alias("splits"),
                        F.lit(None).cast("string").alias("event_id_filter"),
                        F.lit(None).cast("string").alias("event_std_filter"),
                        F.lit("interpolacion").alias("tipo_modelo")))
    return lit_df.unionByName(editions)
