"""Training-set preparation (T1-T8): the pair grid in one pass.

The grid (which target/position or prefix/future pairs exist) is schema
metadata: a handful of split names. The data side is one pass over the wide
table: every row is expanded into the pairs for which it is a complete case
(``inline`` of a slice of a literal pair array, the slice length following
from the row's count of leading non-null splits), carrying y (target), x
(position / last prefix split), age, gender code, the K-fold bucket and the
athlete hold-out flag.
Every later statistic is a ``groupBy(pair_id)`` with partial aggregation, so
only (pair x partition) partial rows are shuffled, however large a pair is.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelens.functions import names as N

# --- fixed values -----------------------------------------------------------
MIN_SAMPLES = 20          # pairs with fewer complete rows are skipped
N_FOLDS = 5               # K of the K-fold evaluation
HOLDOUT_SALT = "42:"      # athlete hold-out bucket salt (seed 42)
HOLDOUT_PERCENT = 20      # share of athletes held out, in percent
# ----------------------------------------------------------------------------

KIND_INTERP, KIND_PRED = "interpolacion", "prediccion"


@dataclass
class Pair:
    pair_id: int
    kind: str
    target: str           # interpolation: target split; prediction: future split
    position: str         # interpolation: position split; prediction: last prefix split
    t_idx: int
    p_idx: int
    required: list[int]
    features: list[str] = field(default_factory=list)
    prefix: list[str] = field(default_factory=list)

    @property
    def model_id(self) -> str:
        if self.kind == KIND_INTERP:
            return f"{self.target}_desde_{self.position}"
        return f"pred_{'_'.join(self.prefix)}_to_{self.target.replace('km_', '')}"


def ordered_splits(columns: list[str], mode: str = "strict") -> list[str]:
    """F4 then F3 over a schema's column names."""
    return N.order_split_names(N.detect_split_columns(columns, mode))


def split_value_counts(wide: DataFrame, splits: list[str]) -> DataFrame:
    """Non-null count of every split in ONE aggregate, as (split, ord, n_values)."""
    agg = wide.agg(*[F.count(F.col(f"`{s}`")).alias(f"c{i}") for i, s in enumerate(splits)])
    arr = F.array(*[F.struct(F.lit(s).alias("split"), F.lit(i).alias("ord"), F.col(f"c{i}").alias("n_values"))
                    for i, s in enumerate(splits)])
    return agg.select(F.inline(arr))


def non_empty_splits(wide: DataFrame, splits: list[str]) -> list[str]:
    """Splits that have data (one tiny collected row per split)."""
    have = {r["split"] for r in split_value_counts(wide, splits).filter("n_values > 0").collect()}
    return [s for s in splits if s in have]


def interp_pairs(splits: list[str], extra_features=("age", "gender")) -> list[Pair]:
    """T1 + T3: all (target, later position); features = splits up to the
    position except the target, then age and gender."""
    out, pid = [], 0
    for t in range(len(splits) - 1):
        for p in range(t + 1, len(splits)):
            feats = [s for i, s in enumerate(splits[:p + 1]) if i != t] + list(extra_features)
            out.append(Pair(pid, KIND_INTERP, splits[t], splits[p], t, p, list(range(p + 1)), feats))
            pid += 1
    return out


def pred_pairs(splits: list[str], extra_features=("age", "gender"), start_id: int = 1000) -> list[Pair]:
    """T2 + T3: all (prefix of length i, later future split)."""
    out, pid = [], start_id
    for i in range(1, len(splits)):
        prefix = splits[:i]
        for f in range(i, len(splits)):
            feats = prefix + list(extra_features)
            out.append(Pair(pid, KIND_PRED, splits[f], splits[i - 1], f, i - 1, list(range(i)) + [f],
                            feats, prefix))
            pid += 1
    return out


def pair_frame(spark, pairs: list[Pair]) -> DataFrame:
    """The grid as a (small, metadata) DataFrame."""
    rows = [(p.pair_id, p.kind, p.model_id, p.target, p.position, p.t_idx, p.p_idx,
             float(N_km(p.target)), float(N_km(p.position)), ",".join(p.features), len(p.features),
             "_".join(p.prefix) if p.prefix else None, "_".join(p.prefix) if p.prefix else None)
            for p in pairs]
    return spark.createDataFrame(
        rows, "pair_id int, kind string, model_id string, target string, position string, t_idx int, "
              "p_idx int, target_km double, position_km double, features string, n_features int, "
              "prefix string, prefix_joined string")


def N_km(name: str) -> float:
    import re
    low = name.lower()
    if low in N.ORDER_SYNONYMS:
        return N.ORDER_SYNONYMS[low]
    m = re.match(N.KM_PATTERN, low)
    return float(m.group(1).replace("_", ".")) if m else float("nan")


def md5_bucket(key: Column, modulo: int) -> Column:
    """Order-free reproducible bucket: first 32 bits of md5 as an integer."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(modulo)).cast("int")


def fold_of(row_key: Column, k: int = N_FOLDS) -> Column:
    """K-fold bucket of a row."""
    return md5_bucket(row_key.cast("string"), k)


def is_holdout(athlete: Column, salt: str = HOLDOUT_SALT, percent: int = HOLDOUT_PERCENT) -> Column:
    """The athlete (not the row) is held out: 20 of 100 md5 buckets."""
    return md5_bucket(F.concat(F.lit(salt), athlete.cast("string")), 100) < percent


def prefix_complete_len(splits: list[str]) -> Column:
    """Number of leading non-null splits of a row (plain CASE, code-generated)."""
    expr = None
    for i, s in enumerate(splits):
        cond = F.col(f"`{s}`").isNull()
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(splits))) if expr is not None else F.lit(0)


def pair_rows(wide: DataFrame, splits: list[str], pairs: list[Pair], row_key: str = "finisher_id",
              gender_numeric: bool = False, extra=None) -> DataFrame:
    """T4 for the whole grid in one pass.

    Complete cases follow from L, the row's count of leading non-null splits:
    an interpolation pair (t, p) needs splits 0..p, i.e. p < L; a prediction
    pair (prefix i, future f) needs i <= L and split f. With the pairs sorted
    by p (resp. i) the candidates of a row are a prefix of the pair array, so
    ``slice`` + ``inline`` expand exactly them: no lambda, no per-pair check
    outside generated code. Output: pair_id, row_key, athlete_id, y, x, age,
    gender, fold, holdout; ``extra`` (a function of the target's and position's
    place among the row's values) may add columns."""
    n = len(splits)
    kinds = {p.kind for p in pairs}
    if len(kinds) != 1:
        return pair_rows(wide, splits, [p for p in pairs if p.kind == KIND_INTERP], row_key, gender_numeric) \
            .unionByName(pair_rows(wide, splits, [p for p in pairs if p.kind == KIND_PRED], row_key, gender_numeric))
    interp = kinds == {KIND_INTERP}
    if len(pairs) != n * (n - 1) // 2:
        raise ValueError("pair_rows expects the full grid of the given splits")
    order = sorted(pairs, key=(lambda p: (p.p_idx, p.t_idx)) if interp else (lambda p: (len(p.prefix), p.t_idx)))
    lit_pairs = F.array(*[F.struct(F.lit(p.pair_id).alias("pair_id"), F.lit(p.t_idx).alias("t"),
                                   F.lit(p.p_idx).alias("p")) for p in order])
    L = F.col("_L")
    if interp:
        # pairs with p < L: all (t, p) with t < p < L -> L(L-1)/2 of them
        take = (L * (L - 1) / 2).cast("int")
    else:
        # pairs with prefix length i <= L: sum_{i=1..L} (n - i) = L*n - L(L+1)/2
        take = (L * n - L * (L + 1) / 2).cast("int")
    vals = F.array(*[F.col(f"`{s}`").cast("double") for s in splits])
    # per-row attributes (hash buckets included) are computed once, before the expansion
    base = (wide.select(F.col(row_key).alias("row_key"), "athlete_id", F.col("age").cast("double").alias("age"),
                        N.gender_code(F.col("gender"), numeric=gender_numeric).cast("double").alias("gender"),
                        vals.alias("v"), prefix_complete_len(splits).alias("_L"))
            .filter(F.col("age").isNotNull() & (F.col("_L") > 0))
            .withColumn("fold", fold_of(F.col("row_key")))
            .withColumn("holdout", is_holdout(F.col("athlete_id"))))
    count_pairs = len(order)
    ex = base.select("row_key", "athlete_id", "age", "gender", "v", "fold", "holdout",
                     F.inline(F.slice(lit_pairs, F.lit(1), F.least(take, F.lit(count_pairs)))))
    out = ex.select("pair_id", "row_key", "athlete_id",
                    F.get(F.col("v"), F.col("t")).alias("y"), F.get(F.col("v"), F.col("p")).alias("x"),
                    "age", "gender", "fold", "holdout", *(extra(F.col("v"), F.col("t"), F.col("p")) if extra else []))
    return out if interp else out.filter(F.col("y").isNotNull())


def _leading(wide: DataFrame, splits: list[str]) -> DataFrame:
    """Rows that can be complete cases, with their count of leading non-null splits."""
    return wide.filter("age is not null").select("athlete_id", *[F.col(f"`{s}`") for s in splits],
                                                 prefix_complete_len(splits).alias("_L")).filter("_L > 0")


def interp_counts(wide: DataFrame, splits: list[str], pair_df: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """T4 + T5 of the (target, position) grid from a histogram of leading counts:
    a pair's complete rows are those with more leading splits than its position."""
    return counts_of(_leading(wide, splits).groupBy("_L").agg(F.count(F.lit(1)).alias("n")), pair_df, min_samples)


def counts_of(hist: DataFrame, pair_df: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """``interp_counts`` of a histogram (_L, n) of leading counts above 0."""
    n = hist.select(F.explode(F.sequence(F.lit(0), F.col("_L") - 1)).alias("p_idx"), "n").groupBy("p_idx").agg(F.sum("n").alias("n"))
    out = pair_df.select("pair_id", "p_idx").join(n, "p_idx", "left")
    return (out.select("pair_id", F.coalesce("n", F.lit(0)).alias("n_complete"))
            .withColumn("trained", F.col("n_complete") >= min_samples))


def holdout_counts(wide: DataFrame, splits: list[str], pair_df: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """T7 sizes of the (prefix, future) grid: rows and distinct athletes, held out and not.

    Rows come from a histogram: per leading count, how many have each later
    split. An athlete takes part in a pair when one of its rows does, that is
    when the most leading splits among its rows with the future split reach
    the prefix; so each athlete is shuffled once, whatever its number of pairs."""
    base = _leading(wide, splits)
    held = is_holdout(F.col("athlete_id"))
    later = lambda cols: F.inline(F.array(*[F.struct(F.lit(i).alias("t_idx"), c.alias("v")) for i, c in enumerate(cols)]))
    prefixes = F.explode(F.sequence(F.lit(1), F.col("_L"))).alias("i")
    rows = (base.groupBy(held.alias("holdout"), "_L").agg(*[F.count(F.col(f"`{s}`")).alias(f"c{i}") for i, s in enumerate(splits)])
            .select("holdout", "_L", later([F.col(f"c{i}") for i in range(len(splits))]))
            .select("holdout", "t_idx", F.col("v").alias("n"), F.lit(0).cast("long").alias("m"), prefixes))
    athletes = (base.groupBy("athlete_id").agg(*[F.max(F.when(F.col(f"`{s}`").isNotNull(), F.col("_L"))).alias(f"c{i}") for i, s in enumerate(splits)])
                .select(held.alias("holdout"), later([F.col(f"c{i}") for i in range(len(splits))])).filter("v is not null")
                .groupBy("holdout", "t_idx", F.col("v").alias("_L")).agg(F.count(F.lit(1)).alias("m"))
                .select("holdout", "t_idx", F.lit(0).cast("long").alias("n"), "m", prefixes))
    total = lambda c, test: F.coalesce(F.sum(F.when(F.col("holdout") == test, F.col(c))), F.lit(0))
    sums = rows.unionByName(athletes).groupBy("t_idx", (F.col("i") - 1).alias("p_idx")).agg(
        total("n", False).alias("n_train"), total("n", True).alias("n_test"),
        total("m", False).alias("n_athletes_train"), total("m", True).alias("n_athletes_test"))
    found = ["n_train", "n_test", "n_athletes_train", "n_athletes_test"]
    out = pair_df.select("pair_id", "t_idx", "p_idx").join(sums, ["t_idx", "p_idx"], "left").select(
        "pair_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in found])
    return (out.withColumn("n_complete", F.col("n_train") + F.col("n_test"))
            .withColumn("trained", F.col("n_complete") >= min_samples))
