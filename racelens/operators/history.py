"""History selection (R1-R8) and the split plan.

Inputs are the normalised request batch (one row per request) and the catalog
(one row per race edition and event). Both are metadata-sized: the catalog
grows with the number of race editions, not with result rows. Still, nothing
here builds an all-pairs product:

* candidates: equi-join on the race base, then ``year <`` as a residual
  filter (``match='prefix'`` keeps the analysed system's ``startswith``);
* direct-by-distance: band join on 0.001 km buckets (neighbour buckets
  exploded on one side, equi-join, exact residual filter);
* nearest split: as-of join, i.e. the wanted and historical distances of a
  request sorted together and the last/first historical distance carried
  along by window functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelens.functions import names as N
from racelens.operators.requests import clean_filter

# --- fixed values -----------------------------------------------------------
MAX_EDITIONS = 5        # catalog entries kept per request, newest first
# ----------------------------------------------------------------------------

KIND_DIRECT, KIND_INTERP, KIND_IMPOSSIBLE = "direct", "interpolate", "impossible"


def prepare_catalog(catalog: DataFrame, order_cols=("race_id", "event_id")) -> DataFrame:
    """Add edition year and base; rows whose year is not an integer are skipped."""
    order = F.struct(*[F.col(c) for c in order_cols]) if len(order_cols) > 1 else F.col(order_cols[0])
    return (catalog.select("*", N.race_edition_year("race_id").alias("year"),
                           N.race_edition_base("race_id").alias("cat_base"),
                           order.alias("cat_order"))
            .filter(F.col("year").isNotNull()))


def prepare_requests(requests: DataFrame) -> DataFrame:
    return requests.select("req_key", "nombre", "splits",
                           N.race_base("nombre").alias("base"),
                           N.race_target_year("nombre").alias("target_year"),
                           clean_filter("event_id_filter").alias("eid_f"),
                           clean_filter("event_std_filter").alias("estd_f"))


def history_candidates(requests: DataFrame, catalog: DataFrame, match: str = "base",
                       order_cols=("race_id", "event_id")) -> DataFrame:
    """R2: earlier editions of the same race passing the optional event filters."""
    r = prepare_requests(requests).filter(F.col("base").isNotNull())
    c = prepare_catalog(catalog, order_cols)
    if match == "base":
        on = [r.base == c.cat_base]
    else:  # the analysed system's rule: any race id starting with '{base}-'
        on = [c.race_id.startswith(F.concat(r.base, F.lit("-")))]
    cond = on[0] & (c.year < r.target_year) \
        & (r.eid_f.isNull() | (c.event_id == r.eid_f)) \
        & (r.estd_f.isNull() | (c.event_std == r.estd_f))
    return (r.join(c, cond)
            .select("req_key", "nombre", c.race_id, c.event_id, c.event_std, c.year, "cat_order",
                    F.transform(c.splits, lambda s: F.lower(s)).alias("cand_splits")))


def split_universe(candidates: DataFrame) -> DataFrame:
    """Distinct historical split names per request, with their km."""
    return (candidates.select("req_key", F.explode("cand_splits").alias("hname")).distinct()
            .withColumn("hkm", N.split_distance(F.col("hname"))))


def wanted_splits(requests: DataFrame) -> DataFrame:
    """Requested splits in request order, normalised, first occurrence wins."""
    w = requests.select("req_key", F.posexplode("splits").alias("ord", "original"))
    w = w.withColumn("split", N.normalise_split(F.col("original")))
    first = (w.groupBy("req_key", "split")
             .agg(F.min(F.struct("ord", "original")).alias("f"))
             .select("req_key", "split", F.col("f.ord").alias("ord"), F.col("f.original").alias("original")))
    return first.withColumn("target_km", N.split_distance(F.col("split")))


def _band_matches(wanted: DataFrame, universe: DataFrame, tol: float) -> DataFrame:
    """Historical names within tol km of each wanted split (bucketed band join)."""
    scale = 1.0 / tol
    wb = (wanted.filter(F.col("target_km").isNotNull())
          .select("req_key", "split", "target_km",
                  F.explode(F.array(*[F.floor(F.col("target_km") * scale) + d for d in (-1, 0, 1)])).alias("b")))
    ub = (universe.filter(F.col("hkm").isNotNull())
          .select("req_key", "hname", "hkm", F.floor(F.col("hkm") * scale).alias("b")))
    return (wb.join(ub, ["req_key", "b"])
            .filter(F.abs(F.col("hkm") - F.col("target_km")) < F.lit(tol))
            .select("req_key", "split", "hname", "hkm",
                    F.abs(F.col("hkm") - F.col("target_km")).alias("diff")))


def _nearest(wanted: DataFrame, universe: DataFrame) -> DataFrame:
    """Nearest historical split with km > 0 for each wanted distance split.

    Ties: smaller difference, then smaller km, then name. Names sharing a km
    are first reduced to the smallest name, then an as-of pass finds the
    closest km below and above."""
    u = (universe.filter(F.col("hkm").isNotNull() & (F.col("hkm") > 0))
         .groupBy("req_key", "hkm").agg(F.min("hname").alias("hname")))
    ev = (u.select("req_key", F.col("hkm").alias("km"), F.lit(1).alias("is_u"),
                   F.lit(None).cast("string").alias("split"), F.struct(F.col("hkm").alias("km"),
                                                                   F.col("hname").alias("name")).alias("h"))
          .unionByName(wanted.filter(F.col("target_km").isNotNull())
                       .select("req_key", F.col("target_km").alias("km"), F.lit(0).alias("is_u"), "split",
                               F.lit(None).cast("struct<km:double,name:string>").alias("h"))))
    below = Window.partitionBy("req_key").orderBy(F.col("km"), F.col("is_u").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = Window.partitionBy("req_key").orderBy(F.col("km"), F.col("is_u")) \
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ev = ev.select("req_key", "km", "is_u", "split",
                   F.last("h", ignorenulls=True).over(below).alias("lo"),
                   F.first("h", ignorenulls=True).over(above).alias("hi"))
    ev = ev.filter(F.col("is_u") == 0)
    best = F.least(
        F.when(F.col("lo").isNotNull(), F.struct((F.col("km") - F.col("lo.km")).alias("diff"),
                                                 F.col("lo.km").alias("km"), F.col("lo.name").alias("name"))),
        F.when(F.col("hi").isNotNull(), F.struct((F.col("hi.km") - F.col("km")).alias("diff"),
                                                 F.col("hi.km").alias("km"), F.col("hi.name").alias("name"))))
    return ev.select("req_key", "split", best.alias("near"))


def split_plan(requests: DataFrame, universe: DataFrame, tol: float = N.EQUIVALENCE_TOL_KM) -> DataFrame:
    """Per wanted split: kind, source, source km, target km, difference.

    direct      : a historical split with the same distance (best by diff,
                  km, name), else one with the same name
    interpolate : distance split without an equal: nearest historical split
                  with km > 0 (0 km would divide by zero later)
    impossible  : neither
    ``sources`` lists every historical name of the same distance, the
    requested name first; the training table reads their coalesce."""
    wanted = wanted_splits(requests)
    band = _band_matches(wanted, universe, tol)
    direct = (band.groupBy("req_key", "split")
              .agg(F.min(F.struct("diff", "hkm", "hname")).alias("best"),
                   F.array_sort(F.collect_list("hname")).alias("dist_names")))
    by_name = universe.select("req_key", F.col("hname").alias("split"), F.lit(True).alias("name_hit"))
    near = _nearest(wanted, universe)
    p = (wanted.join(direct, ["req_key", "split"], "left")
         .join(by_name, ["req_key", "split"], "left")
         .join(near, ["req_key", "split"], "left"))
    is_dist = F.col("best").isNotNull()
    is_name = F.coalesce(F.col("name_hit"), F.lit(False))
    kind = (F.when(is_dist | is_name, KIND_DIRECT)
            .when(F.col("target_km").isNotNull() & F.col("near").isNotNull(), KIND_INTERP)
            .otherwise(KIND_IMPOSSIBLE))
    source = (F.when(is_dist, F.col("best.hname")).when(is_name, F.col("split"))
              .when(F.col("near").isNotNull() & F.col("target_km").isNotNull(), F.col("near.name")))
    source_km = (F.when(is_dist, F.col("best.hkm")).when(is_name, N.split_distance(F.col("split")))
                 .when(F.col("near").isNotNull() & F.col("target_km").isNotNull(), F.col("near.km")))
    names_same_km = F.coalesce(F.col("dist_names"), F.array().cast("array<string>"))
    sources = F.when(kind == KIND_DIRECT, F.array_distinct(F.concat(
        F.array(F.col("split")), F.array_remove(names_same_km, F.col("split"))))) \
        .otherwise(F.array().cast("array<string>"))
    out = p.select("req_key", "ord", "original", "split", kind.alias("kind"), source.alias("source"),
                   source_km.alias("source_km"), "target_km", sources.alias("sources"))
    out = out.withColumn("diff_km", F.when(F.col("kind") != KIND_IMPOSSIBLE,
                                           F.abs(F.col("source_km") - F.col("target_km"))))
    return out.withColumn("alias", N.alias_name(F.col("original"), F.col("split")))


def has_distance_split(arr) -> F.Column:
    return F.exists(arr, lambda s: N.split_distance(s).isNotNull())


def latest_editions(candidates: DataFrame, plan: DataFrame, n: int = MAX_EDITIONS) -> DataFrame:
    """R6 + R7: when a wanted split is impossible keep only candidates with a
    distance split; then the newest ``n`` catalog entries (ties: catalog order)."""
    imp = plan.groupBy("req_key").agg(F.bool_or(F.col("kind") == KIND_IMPOSSIBLE).alias("has_impossible"))
    c = candidates.join(imp, "req_key", "left")
    c = c.filter(~F.coalesce(F.col("has_impossible"), F.lit(False)) | has_distance_split(F.col("cand_splits")))
    w = Window.partitionBy("req_key").orderBy(F.col("year").desc(), F.col("cat_order"))
    return (c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select("req_key", "nombre", "race_id", "event_id", "event_std", "year", "rank", "cand_splits"))


def history_adaptive(requests: DataFrame, catalog: DataFrame, match: str = "base",
                     order_cols=("race_id", "event_id"), n: int = MAX_EDITIONS):
    """Candidates -> universe -> plan -> R6/R7. Returns (selection, plan).

    The plan is computed only for requests that have candidates, as in the
    analysed system (no candidates: no analysis)."""
    cands = history_candidates(requests, catalog, match, order_cols)
    universe = split_universe(cands)
    has_cand = cands.select("req_key").distinct()
    plan = split_plan(requests.join(has_cand, "req_key", "left_semi"), universe)
    return latest_editions(cands, plan, n), plan


def history_exact(requests: DataFrame, catalog: DataFrame, match: str = "base",
                  order_cols=("race_id", "event_id"), n: int = MAX_EDITIONS) -> DataFrame:
    """Earlier editions whose split set equals the request's
    (case-insensitive), optional event filters, first ``n`` in catalog order."""
    cands = history_candidates(requests, catalog, match, order_cols)
    want = prepare_requests(requests).select(
        "req_key", F.array_sort(F.array_distinct(F.transform("splits", lambda s: F.lower(s)))).alias("want_set"))
    c = cands.join(want, "req_key").filter(
        F.array_sort(F.array_distinct(F.col("cand_splits"))) == F.col("want_set"))
    w = Window.partitionBy("req_key").orderBy("cat_order")
    return (c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select("req_key", "nombre", "race_id", "event_id", "event_std", "year", "rank"))


def final_splits(plan: DataFrame) -> DataFrame:
    """Direct and interpolated splits in request order."""
    kept = plan.filter(F.col("kind") != KIND_IMPOSSIBLE)
    ordered = F.array_sort(F.collect_list(F.struct("ord", "split")))
    return kept.groupBy("req_key").agg(
        F.array_join(F.transform(ordered, lambda x: x["split"]), ",").alias("final_splits"),
        F.count(F.lit(1)).alias("n_final"))
