"""Request handling (C1-C5): the batch of training requests is data.

All requests of a batch are one DataFrame; nothing loops over them on the
driver. Validation is an aggregate whose single result row is inspected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelens.functions import names as N

# --- fixed values -----------------------------------------------------------
MODEL_KINDS = ("interpolacion", "prediccion")
DEFAULT_MODEL_KIND = "interpolacion"
TIMESTAMP_FORMAT = "yyyyMMdd-HHmmss"
NO_FILTER_VALUES = ("None", "")
# ----------------------------------------------------------------------------


def clean_filter(c) -> F.Column:
    """'None', empty and null all mean 'no filter'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull() | c.isin(*NO_FILTER_VALUES), F.lit(None).cast("string")).otherwise(c)


def request_normalise(raw: DataFrame) -> DataFrame:
    """name = nombre, else carrera; default model kind; drop requests
    without a name or without splits."""
    name = F.coalesce(F.nullif(F.col("nombre"), F.lit("")), F.nullif(F.col("carrera"), F.lit("")))
    return (raw.select("req_key", "req_pos", name.alias("nombre"), "splits", "event_id_filter",
                       "event_std_filter",
                       F.coalesce("tipo_modelo", F.lit(DEFAULT_MODEL_KIND)).alias("tipo_modelo"))
            .filter(F.col("nombre").isNotNull() & F.col("splits").isNotNull() & (F.size("splits") > 0)))


def request_validate(requests: DataFrame) -> DataFrame:
    """(request, is_valid, reason) for every normalised request."""
    ok = F.col("tipo_modelo").isin(*MODEL_KINDS)
    return requests.select("req_key", "nombre", "tipo_modelo", ok.alias("is_valid"),
                           F.when(ok, F.lit(None).cast("string"))
                           .otherwise(F.concat(F.lit("unknown tipo_modelo: "), F.col("tipo_modelo")))
                           .alias("reason"))


def assert_valid_batch(requests: DataFrame) -> None:
    """An empty batch or an unknown model kind fails the batch (one action)."""
    row = request_validate(requests).agg(F.count(F.lit(1)).alias("n"),
                                         F.count_if(~F.col("is_valid")).alias("bad"),
                                         F.min("reason").alias("first_reason")).first()
    if row["n"] == 0:
        raise ValueError("no request could be prepared")
    if row["bad"]:
        raise ValueError(row["first_reason"])


def valid_requests(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("tipo_modelo").isin(*MODEL_KINDS))


def run_timestamp(requests: DataFrame, arg_ts: str | None = None,
                  clock: str = "2026-03-03 08:57:22", ts_col: str | None = None) -> DataFrame:
    """Run stamp = argument, else the first request's stamp, else the clock.

    The clock is a parameter so that runs are reproducible in tests."""
    first = (F.min_by(F.col(ts_col), F.col("req_pos")) if ts_col
             else F.lit(None).cast("string")).alias("first_ts")
    agg = requests.agg(first)
    stamp = F.coalesce(F.lit(arg_ts).cast("string"), F.col("first_ts"),
                       F.date_format(F.to_timestamp(F.lit(clock)), TIMESTAMP_FORMAT))
    return agg.select(stamp.alias("run_ts"))


def run_names(requests: DataFrame, run_ts: F.Column) -> DataFrame:
    """C4: model folder '{race}-{ts}' and result table name."""
    clean = F.regexp_replace("nombre", r"[^a-zA-Z0-9_-]", "_")
    table = F.replace(F.concat(F.lit("modelo_"), clean, F.lit("_"), run_ts), F.lit("-"), F.lit("_"))
    return requests.select("req_key", "nombre", F.concat_ws("-", "nombre", run_ts).alias("model_folder"),
                           table.alias("result_table"))


def batch_outcomes(requests: DataFrame, selection: DataFrame) -> DataFrame:
    """Every request gets an outcome; failures carry a reason.

    ``selection`` is the output of history selection (one row per chosen
    catalog entry); a request without rows there found no usable history."""
    used = selection.groupBy("req_key").agg(F.count(F.lit(1)).alias("races_used"))
    out = requests.join(used, "req_key", "left")
    malformed = N.race_base(F.col("nombre")).isNull()
    return out.select(
        "req_key", "nombre",
        F.when(F.col("races_used").isNotNull(), "success").otherwise("failure").alias("outcome"),
        F.when(F.col("races_used").isNotNull(), F.lit(None).cast("string"))
        .when(malformed, F.lit("malformed race name"))
        .otherwise(F.lit("no historical data")).alias("reason"),
        F.coalesce("races_used", F.lit(0)).cast("long").alias("races_used"))
