"""Registered queries: one builder per SURVEY section 2 key.

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the
driver's tables (or data Spark derives from them). Floating results are
rounded to 6 decimals, the same rounding the oracle SQL applies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.functions import names as N
from racelens.operators import history as H
from racelens.operators import requests as Q
from racelens.operators import training_table as T
from racelens.plans.context import Ctx, r6
from racelens.sources import fixtures as X

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Builder] = {}


def query(key: str):
    def deco(fn):
        REGISTRY[key] = fn
        return fn
    return deco


# ---------------------------------------------------------------- F: names

@query("split_distance")
def q_split_distance(spark, sf):
    c = Ctx(spark, sf)
    return (c.name_rows.groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.col("name").alias("split_name"), "n_rows", r6(N.split_distance(F.col("name"))).alias("km")))


@query("split_type")
def q_split_type(spark, sf):
    c = Ctx(spark, sf)
    return (c.name_rows.select(N.split_type(F.col("name")).alias("split_type"))
            .groupBy("split_type").agg(F.count(F.lit(1)).alias("n_rows")))


@query("split_order")
def q_split_order(spark, sf):
    c = Ctx(spark, sf)
    req = c.raw_requests.select(F.col("req_key").alias("item"), "splits")
    cat = c.catalog.select(F.concat_ws("/", "race_id", "event_id").alias("item"), "splits")
    both = req.unionByName(cat)
    return both.select("item", F.array_join(N.order_splits_array(F.col("splits")), ",").alias("ordered"))


@query("split_detect")
def q_split_detect(spark, sf):
    c = Ctx(spark, sf)
    cols = spark.createDataFrame([(x,) for x in c.wide.columns], "name string")
    names = c.name_rows.select("name").distinct().unionByName(cols).distinct()
    return names.select(F.col("name").alias("column_name"),
                        N.is_split_column(F.col("name"), "strict").alias("is_split_strict"),
                        N.is_split_column(F.col("name"), "broad").alias("is_split_broad"),
                        N.is_split_column(F.col("name"), "prediction").alias("is_split_prediction"))


@query("column_normalise")
def q_column_normalise(spark, sf):
    c = Ctx(spark, sf)
    return (c.name_rows.select("name").distinct()
            .select(F.col("name").alias("column_name"), N.normalise_column_name(F.col("name")).alias("normalised")))


@query("split_normalise")
def q_split_normalise(spark, sf):
    c = Ctx(spark, sf)
    return (c.raw_requests.select("req_key", F.posexplode("splits").alias("ord", "original"))
            .select("req_key", "ord", "original", N.normalise_split(F.col("original")).alias("normalised")))


@query("split_alias")
def q_split_alias(spark, sf):
    c = Ctx(spark, sf)
    return c.plan.filter(F.col("kind") != H.KIND_IMPOSSIBLE).select("req_key", "original", "split", "alias")


@query("split_equivalent")
def q_split_equivalent(spark, sf):
    c = Ctx(spark, sf)
    w = H.wanted_splits(c.valid)
    return (H._band_matches(w, c.universe, N.EQUIVALENCE_TOL_KM)
            .select("req_key", "split", "hname", r6("diff").alias("diff_km")))


@query("closest_split")
def q_closest_split(spark, sf):
    c = Ctx(spark, sf)
    w = H.wanted_splits(c.valid.join(c.candidates.select("req_key").distinct(), "req_key", "left_semi"))
    near = H._nearest(w, c.universe)
    return near.filter(F.col("near").isNotNull()).select(
        "req_key", "split", F.col("near.name").alias("closest"), r6("near.km").alias("closest_km"),
        r6("near.diff").alias("diff_km"))


@query("prefix_label")
def q_prefix_label(spark, sf):
    c = Ctx(spark, sf)
    return c.catalog.select("race_id", "event_id",
                            N.prefix_label(N.order_splits_array(F.col("splits"))).alias("prefix_label"))


@query("race_parse")
def q_race_parse(spark, sf):
    c = Ctx(spark, sf)
    names = (c.requests.select(F.col("nombre").alias("name"))
             .unionByName(c.catalog.select(F.col("race_id").alias("name"))).distinct())
    return names.select("name", N.race_base(F.col("name")).alias("base"),
                        N.race_target_year(F.col("name")).alias("target_year"),
                        N.race_edition_year(F.col("name")).alias("edition_year"))


@query("gender_encode")
def q_gender_encode(spark, sf):
    c = Ctx(spark, sf)
    return (c.wide.select("gender", N.gender_code(F.col("gender")).alias("gender_code"))
            .groupBy("gender", "gender_code").agg(F.count(F.lit(1)).alias("n_rows")))


@query("manifest_normalise")
def q_manifest_normalise(spark, sf):
    c = Ctx(spark, sf)
    return c.plan.select("req_key", N.normalise_manifest_name(F.col("original")).alias("split_key"),
                         "kind", N.normalise_manifest_name(F.col("source")).alias("source"))


# ---------------------------------------------------------------- C: requests

@query("request_normalise")
def q_request_normalise(spark, sf):
    c = Ctx(spark, sf)
    return c.requests.select("req_key", "nombre", F.array_join("splits", ",").alias("splits"),
                             "event_id_filter", "event_std_filter", "tipo_modelo")


@query("request_validate")
def q_request_validate(spark, sf):
    return Q.request_validate(Ctx(spark, sf).requests)


@query("run_timestamp")
def q_run_timestamp(spark, sf):
    c = Ctx(spark, sf)
    # no stamp among the requests: the clock is the time of the newest result
    clock = spark.read.parquet(f"{sf}/orders.parquet").agg(F.max("o_orderdate").cast("timestamp").cast("string")).first()[0]
    return Q.run_timestamp(c.valid, clock=clock)


@query("run_names")
def q_run_names(spark, sf):
    c = Ctx(spark, sf)
    ts = Q.run_timestamp(c.valid).first()["run_ts"]   # one scalar for the whole batch
    return Q.run_names(c.valid, F.lit(ts))


@query("batch_outcomes")
def q_batch_outcomes(spark, sf):
    c = Ctx(spark, sf)
    return Q.batch_outcomes(c.valid, c.selection)


# ---------------------------------------------------------------- R: history

@query("history_exact")
def q_history_exact(spark, sf):
    c = Ctx(spark, sf)
    return H.history_exact(c.valid, c.catalog)


@query("history_candidates")
def q_history_candidates(spark, sf):
    c = Ctx(spark, sf)
    return c.candidates.select("req_key", "race_id", "event_id", "event_std", "year")


@query("split_universe")
def q_split_universe(spark, sf):
    c = Ctx(spark, sf)
    return c.universe.select("req_key", "hname", r6("hkm").alias("hkm"))


@query("split_plan")
def q_split_plan(spark, sf):
    c = Ctx(spark, sf)
    return c.plan.select("req_key", "ord", "original", "split", "kind", "source", r6("source_km").alias("source_km"),
                         r6("target_km").alias("target_km"), r6("diff_km").alias("diff_km"), "alias")


@query("final_splits")
def q_final_splits(spark, sf):
    return H.final_splits(Ctx(spark, sf).plan)


@query("drop_undistanced")
def q_drop_undistanced(spark, sf):
    c = Ctx(spark, sf)
    imp = c.plan.groupBy("req_key").agg(F.bool_or(F.col("kind") == H.KIND_IMPOSSIBLE).alias("has_impossible"))
    return (c.candidates.join(imp, "req_key", "left")
            .select("req_key", "race_id", "event_id",
                    F.coalesce("has_impossible", F.lit(False)).alias("has_impossible"),
                    H.has_distance_split(F.col("cand_splits")).alias("has_distance"))
            .withColumn("kept", ~F.col("has_impossible") | F.col("has_distance")))


@query("latest_editions")
def q_latest_editions(spark, sf):
    c = Ctx(spark, sf)
    return c.selection.select("req_key", "race_id", "event_id", "year", "rank")


@query("history_adaptive")
def q_history_adaptive(spark, sf):
    c = Ctx(spark, sf)
    sel, _ = H.history_adaptive(c.valid, c.catalog)
    return sel.select("req_key", "nombre", "race_id", "event_id", "event_std", "year", "rank")


def _training_long(c: Ctx) -> DataFrame:
    """R11 over the stored editions: one scan, pruned to the chosen partitions and the columns of all plans."""
    return T.training_table(c.history_rows, c.selection, c.plan, c.valid, c.sources)


@query("result_filter")
def q_result_filter(spark, sf):
    c = Ctx(spark, sf)
    rows = T.result_filter(c.history_rows, c.selection, c.valid, prune_pairs=c.chosen_pairs)
    return rows.groupBy("req_key", "race_id", "event_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                                              F.count_distinct("athlete_id").alias("n_athletes"))


@query("training_projection")
def q_training_projection(spark, sf):
    """R10 for every valid request, keyed by req_key."""
    c = Ctx(spark, sf)
    return T.training_projection_keyed(c.history_rows, c.selection, c.plan, c.valid, c.sources)


@query("training_table")
def q_training_table(spark, sf):
    return _training_long(Ctx(spark, sf))


@query("schema_fingerprint")
def q_schema_fingerprint(spark, sf):
    return T.schema_fingerprint(Ctx(spark, sf).plan)


@query("preview")
def q_preview(spark, sf):
    c = Ctx(spark, sf)
    return T.preview_each(_training_long(c), "req_key", ["athlete_id", "event_id", "ord", "secs"])
