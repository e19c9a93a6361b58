"""Oracle SQL for the training side (T, M, E, P keys).

The grid is a join of the distinct legs found in the data; fold and
hold-out buckets use ``'0x' || md5 prefix`` cast to BIGINT. Model-derived
floats are rounded to 4 decimals as in the Spark queries.
"""

from __future__ import annotations

from racelens.plans.oracle import oracle
from racelens.plans.oracle_base import sql

GENDER = ("CAST(CASE WHEN gender IN ('M', 'male', 'Male', 'MALE') THEN 0 "
          "WHEN gender IN ('F', 'female', 'Female', 'FEMALE') THEN 1 ELSE 0 END AS DOUBLE)")
FOLD = "CAST(CAST('0x' || substr(md5(CAST(finisher_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 AS INTEGER)"
HOLDOUT = "(CAST('0x' || substr(md5('42:' || athlete_id), 1, 8) AS BIGINT) % 100 < 20)"


# the grid from the distinct legs of the data: legs 1..n, all (target, later position) and (prefix, future)
_IPAIRS = """
  SELECT CAST(row_number() OVER (ORDER BY t.k, p.k) - 1 AS INTEGER) AS pair_id,
         t.name || '_desde_' || p.name AS model_id, t.name AS target, p.name AS position,
         CAST(5 * t.k AS DOUBLE) AS target_km, CAST(5 * p.k AS DOUBLE) AS position_km,
         (SELECT string_agg(l.name, ',' ORDER BY l.k) FROM legs l WHERE l.k <= p.k AND l.k <> t.k) || ',age,gender' AS features,
         CAST(p.k + 1 AS INTEGER) AS n_features, CAST(NULL AS VARCHAR) AS prefix, 'interpolacion' AS kind,
         t.k AS y_leg, p.k AS x_leg
  FROM legs t JOIN legs p ON t.k < p.k"""
_PPAIRS = """
  SELECT CAST(999 + row_number() OVER (ORDER BY i.k, f.k) AS INTEGER) AS pair_id,
         'pred_' || x.names || '_to_' || replace(f.name, 'km_', '') AS model_id, f.name AS target, i.name AS position,
         CAST(5 * f.k AS DOUBLE) AS target_km, CAST(5 * i.k AS DOUBLE) AS position_km,
         replace(x.names, '_km', ',km') || ',age,gender' AS features, CAST(i.k + 2 AS INTEGER) AS n_features,
         x.names AS prefix, 'prediccion' AS kind, f.k AS y_leg, i.k AS x_leg
  FROM legs i JOIN legs f ON i.k < f.k
  JOIN (SELECT a.k, string_agg(b.name, '_' ORDER BY b.k) AS names FROM legs a JOIN legs b ON b.k <= a.k GROUP BY a.k) x
    ON x.k = i.k"""


def _rows(pairs: str) -> str:
    """Rows of a pair: finishers that have both legs (and so all before the later one)."""
    return f"""
  SELECT p.pair_id, f.finisher_id AS row_key, f.athlete_id, y.secs AS y, x.secs AS x, CAST(f.age AS DOUBLE) AS age,
         {GENDER} AS gender, {FOLD} AS fold, {HOLDOUT} AS holdout
  FROM {pairs} p JOIN race_legs y ON y.leg = p.y_leg JOIN race_legs x ON x.leg = p.x_leg AND x.l_orderkey = y.l_orderkey
  JOIN finishers f ON f.finisher_id = y.l_orderkey WHERE f.age IS NOT NULL"""


def _moments(src: str, keys: str, pre: str) -> str:
    return (f"SELECT {keys}, count(*) AS {pre}n, avg(x) AS {pre}mx, avg(y) AS {pre}my, "
            f"var_pop(x) * count(*) AS {pre}sxx, covar_pop(x, y) * count(*) AS {pre}sxy FROM {src} GROUP BY {keys}")


def _gate(src: str) -> str:
    """Gate columns per pair from prediction rows (pair_id, y, pred)."""
    return f"""
  SELECT pair_id, n, mae_naive, mae, std_error, p50, p95, pass_naive, improvement, cv, ratio,
         cv <= 0.5 AS pass_consistency, ratio <= 3.0 AS pass_outliers,
         CAST(least(100,
           CASE WHEN pass_naive THEN 40 + CASE WHEN improvement > 0.3 THEN 10 WHEN improvement > 0.1 THEN 5 ELSE 0 END ELSE 0 END
         + CASE WHEN cv <= 0.5 THEN 30 + CASE WHEN cv < 0.3 THEN 10 WHEN cv < 0.4 THEN 5 ELSE 0 END ELSE 0 END
         + CASE WHEN ratio <= 3.0 THEN 30 + CASE WHEN ratio < 2.0 THEN 10 WHEN ratio < 2.5 THEN 5 ELSE 0 END ELSE 0 END)
         AS INTEGER) AS score,
         (pass_naive AND cv <= 0.5 AND ratio <= 3.0) AS approved
  FROM (
    SELECT pair_id, n, mae_naive, mae, std_error, p50, p95,
           coalesce(mae < mae_naive AND mae_naive > 0, false) AS pass_naive,
           CASE WHEN mae_naive > 0 THEN (mae_naive - mae) / mae_naive END AS improvement,
           CASE WHEN mae > 0 THEN std_error / mae ELSE 'inf'::DOUBLE END AS cv,
           CASE WHEN p50 > 0 THEN p95 / p50 ELSE 'inf'::DOUBLE END AS ratio
    FROM (
      SELECT s.pair_id, count(*) AS n, avg(abs(s.y - m.mean_y)) AS mae_naive, avg(abs(s.y - s.pred)) AS mae,
             stddev_pop(abs(s.y - s.pred)) AS std_error, quantile_cont(abs(s.y - s.pred), 0.5) AS p50,
             quantile_cont(abs(s.y - s.pred), 0.95) AS p95
      FROM {src} s JOIN (SELECT pair_id, avg(y) AS mean_y FROM {src} GROUP BY pair_id) m ON s.pair_id = m.pair_id
      GROUP BY s.pair_id))"""


_T = {
    "ipairs": (["legs"], _IPAIRS),
    "ppairs": (["legs"], _PPAIRS),
    "irows": (["ipairs", "finishers", "race_legs"], _rows("ipairs")),
    "prows": (["ppairs", "finishers", "race_legs"], _rows("ppairs")),
    "icounts": (["irows", "ipairs"], """
  SELECT p.pair_id, coalesce(c.n, 0) AS n_complete, coalesce(c.n, 0) >= 20 AS trained
  FROM ipairs p LEFT JOIN (SELECT pair_id, count(*) AS n FROM irows GROUP BY pair_id) c ON p.pair_id = c.pair_id"""),
    "pcounts": (["prows", "ppairs"], """
  SELECT p.pair_id, coalesce(c.n, 0) AS n_complete, coalesce(c.n, 0) >= 20 AS trained
  FROM ppairs p LEFT JOIN (SELECT pair_id, count(*) AS n FROM prows GROUP BY pair_id) c ON p.pair_id = c.pair_id"""),
    "itrained": (["irows", "icounts"], """
  SELECT * FROM irows WHERE pair_id IN (SELECT pair_id FROM icounts WHERE trained)"""),
    "ptrained": (["prows", "pcounts"], """
  SELECT * FROM prows WHERE pair_id IN (SELECT pair_id FROM pcounts WHERE trained)"""),
    # M3 the long way: the kept splits' differences, age and gender of every row, normal equations of the other folds
    # summed row by row, and elimination pivot by pivot (a pivot that is next to nothing is left out)
    "ikept": (["itrained", "ipairs", "race_legs"], """
  SELECT r.pair_id, r.row_key, list(l.secs ORDER BY l.leg) AS kept, max(CASE WHEN l.leg = p.y_leg - 1 THEN l.secs END) AS before
  FROM itrained r JOIN ipairs p ON p.pair_id = r.pair_id
  JOIN race_legs l ON l.l_orderkey = r.row_key AND l.leg <= p.x_leg AND l.leg <> p.y_leg GROUP BY 1, 2"""),
    "ifeat": (["ikept", "itrained"], """
  SELECT r.pair_id, r.row_key, r.fold, r.y, coalesce(k.before, 0.0) + 1450 AS base,
         [1.0, r.age - 47.5, r.gender] || list_transform(k.kept, lambda v, i: v - (CASE WHEN i > 1 THEN k.kept[i - 1] ELSE 0 END) - 1450.0) AS z
  FROM itrained r JOIN ikept k ON k.pair_id = r.pair_id AND k.row_key = r.row_key"""),
    "icells": (["ifeat"], """
  SELECT f.pair_id, t.k AS fold, i, j, sum(f.zz[i] * f.zz[j]) AS g
  FROM (SELECT pair_id, fold, z || [y - base] AS zz, len(z) AS d FROM ifeat) f, range(5) t(k),
       unnest(range(1, f.d + 1)) a(i), unnest(range(1, f.d + 2)) b(j)
  WHERE f.fold <> t.k GROUP BY 1, 2, 3, 4"""),
    "isystems": (["icells"], """
  SELECT pair_id, fold, list(line ORDER BY i) AS m, list(line[i] ORDER BY i) AS own, count(*) AS d
  FROM (SELECT pair_id, fold, i, list(g ORDER BY j) AS line FROM icells GROUP BY 1, 2, 3) GROUP BY 1, 2"""),
    "isweep": (["isystems"], """
  SELECT pair_id, fold, 0 AS k, d, m, own, CAST([] AS BOOLEAN[]) AS used FROM isystems
  UNION ALL
  SELECT pair_id, fold, k + 1, d,
         CASE WHEN own[k + 1] > 0 AND m[k + 1][k + 1] > 1e-9 * own[k + 1] THEN
           list_transform(m, lambda line, i: list_transform(line, lambda v, j:
             CASE WHEN i = k + 1 THEN v / m[k + 1][k + 1] ELSE v - line[k + 1] * m[k + 1][j] / m[k + 1][k + 1] END))
         ELSE m END, own, list_append(used, own[k + 1] > 0 AND m[k + 1][k + 1] > 1e-9 * own[k + 1])
  FROM isweep WHERE k < d"""),
    "ifold_models": (["isweep", "ifeat"], """
  SELECT s.pair_id, s.fold, n.n_train, s.d, list_transform(s.m, lambda line, i: CASE WHEN s.used[i] THEN line[s.d + 1] ELSE 0.0 END) AS beta
  FROM isweep s JOIN (SELECT pair_id, t.k AS fold, count(*) AS n_train FROM ifeat, range(5) t(k) WHERE fold <> t.k GROUP BY 1, 2) n
    ON n.pair_id = s.pair_id AND n.fold = s.fold WHERE s.k = s.d"""),
    "icv": (["itrained", "ifeat", "ifold_models"], """
  SELECT r.*, m.n_train, m.d, m.beta, f.base + list_dot_product(f.z, m.beta) AS pred
  FROM itrained r JOIN ifeat f ON f.pair_id = r.pair_id AND f.row_key = r.row_key
  JOIN ifold_models m ON r.pair_id = m.pair_id AND r.fold = m.fold"""),
    "igate": (["icv"], _gate("icv")),
    "ifolds": (["icv"], """
  SELECT pair_id, avg(mae) AS mae_folds_mean, stddev_pop(mae) AS mae_folds_std, count(*) AS k
  FROM (SELECT pair_id, fold, avg(abs(y - pred)) AS mae FROM icv GROUP BY pair_id, fold) GROUP BY pair_id"""),
    "ieval": (["ipairs", "igate", "ifolds"], """
  SELECT p.pair_id, p.model_id, p.target, p.position, g.n, g.mae, f.mae_folds_mean, f.mae_folds_std,
         g.score, g.improvement, g.approved
  FROM ipairs p JOIN igate g ON p.pair_id = g.pair_id JOIN ifolds f ON p.pair_id = f.pair_id"""),
    "pmodels": (["ptrained"], f"""
  SELECT pair_id, CASE WHEN n_sxx > 0 THEN n_sxy / n_sxx ELSE 0.0 END AS slope,
         my - CASE WHEN n_sxx > 0 THEN n_sxy / n_sxx ELSE 0.0 END * mx AS intercept
  FROM ({_moments('(SELECT * FROM ptrained WHERE NOT holdout)', 'pair_id', '').replace('AS sxx', 'AS n_sxx')
        .replace('AS sxy', 'AS n_sxy')})"""),
    "ppred": (["ptrained", "pmodels"], """
  SELECT r.*, m.intercept + m.slope * r.x AS pred FROM ptrained r JOIN pmodels m ON r.pair_id = m.pair_id"""),
    "pquant": (["ppred"], """
  SELECT pair_id, quantile_cont(y - pred, 0.1) AS q10, quantile_cont(y - pred, 0.5) AS q50,
         quantile_cont(y - pred, 0.9) AS q90
  FROM ppred WHERE NOT holdout GROUP BY pair_id"""),
    "pint": (["ppred", "pquant"], """
  SELECT p.pair_id, p.row_key, p.athlete_id, p.y, p.pred, p.pred + q.q10 AS lower, p.pred + q.q50 AS median,
         p.pred + q.q90 AS upper
  FROM ppred p JOIN pquant q ON p.pair_id = q.pair_id WHERE p.holdout"""),
    "pcov": (["pint"], """
  SELECT pair_id, avg(CASE WHEN y >= lower AND y <= upper THEN 1.0 ELSE 0.0 END) * 100 AS coverage,
         count(*) AS n_test FROM pint GROUP BY pair_id"""),
    "pgate": (["ppred"], _gate("(SELECT * FROM ppred WHERE holdout)")),
}


def tsql(body: str, *deps: str) -> str:
    return sql(body, *deps, extra=_T)


def _ids(src: str, run: str, cols: str) -> str:
    pairs = "ipairs" if run == "i" else "ppairs"
    return f"SELECT p.model_id, {cols} FROM {src} s JOIN {pairs} p ON s.pair_id = p.pair_id"


oracle("pair_grid_interp", tsql("""
SELECT p.model_id, p.target, p.position, p.n_features, c.n_complete
FROM ipairs p JOIN icounts c ON p.pair_id = c.pair_id""", "ipairs", "icounts"))

oracle("pair_grid_pred", tsql("""
SELECT p.model_id, p.prefix, p.target AS future, p.n_features, c.n_complete
FROM ppairs p JOIN pcounts c ON p.pair_id = c.pair_id""", "ppairs", "pcounts"))

oracle("feature_sets", tsql("""
SELECT model_id, kind, features FROM ipairs UNION ALL SELECT model_id, kind, features FROM ppairs""",
                            "ipairs", "ppairs"))

oracle("complete_cases", tsql(
    _ids("icounts", "i", "s.n_complete") + " UNION ALL " + _ids("pcounts", "p", "s.n_complete"),
    "ipairs", "ppairs", "icounts", "pcounts"))

oracle("min_samples", tsql(
    _ids("icounts", "i", "s.n_complete, s.trained") + " UNION ALL " + _ids("pcounts", "p", "s.n_complete, s.trained"),
    "ipairs", "ppairs", "icounts", "pcounts"))

oracle("empty_splits", tsql("""
SELECT l.name AS split, CAST(l.k - 1 AS INTEGER) AS ord, count(r.secs) AS n_values, count(r.secs) > 0 AS has_data
FROM legs l LEFT JOIN race_long r ON r.leg = l.k GROUP BY 1, 2""", "legs", "race_long"))

oracle("athlete_holdout", tsql(_ids("""(SELECT pair_id, count(*) FILTER (WHERE NOT holdout) AS n_train,
       count(*) FILTER (WHERE holdout) AS n_test,
       count(DISTINCT CASE WHEN NOT holdout THEN athlete_id END) AS n_athletes_train,
       count(DISTINCT CASE WHEN holdout THEN athlete_id END) AS n_athletes_test
  FROM ptrained GROUP BY pair_id)""", "p", "s.n_train, s.n_test, s.n_athletes_train, s.n_athletes_test"),
    "ppairs", "ptrained"))

oracle("kfold", tsql(_ids("(SELECT pair_id, fold, count(*) AS n_rows FROM itrained GROUP BY 1, 2)", "i",
                          "s.fold, s.n_rows"), "ipairs", "itrained"))

oracle("naive_mean", tsql(_ids("(SELECT pair_id, count(*) AS n, avg(y) AS mean_y FROM itrained GROUP BY 1)", "i",
                               "s.n, round(s.mean_y, 4) AS mean_y"), "ipairs", "itrained"))

oracle("cv_predict", tsql(_ids("""(SELECT pair_id, fold, count(*) AS n_pred, first(n_train) AS n_train,
  CAST(first(d) - 1 AS INTEGER) AS n_features, first(beta[2]) AS age_weight, avg(pred) AS mean_pred FROM icv GROUP BY 1, 2)""", "i",
    "s.fold, s.n_pred, s.n_train, s.n_features, round(s.age_weight, 4) AS age_weight, "
    "round(s.mean_pred, 4) AS mean_pred"), "ipairs", "icv"))

oracle("fold_mae", tsql(_ids("ifolds", "i", "round(s.mae_folds_mean, 4) AS mae_folds_mean, "
                                           "round(s.mae_folds_std, 4) AS mae_folds_std, s.k"), "ipairs", "ifolds"))

_COLS = "SELECT name AS col, CAST(5 * k AS DOUBLE) AS col_km FROM legs"

oracle("extrapolate", tsql(f"""
SELECT p.req_key, p.alias || '_desde_' || i.position || '_ext' AS model_id, c.col AS source,
       round(p.target_km / p.source_km, 4) AS factor, v.n, round(v.pred * (p.target_km / p.source_km), 4) AS mean_pred
FROM plan p JOIN ({_COLS}) c ON round(p.source_km, 3) = round(c.col_km, 3)
JOIN ipairs i ON i.target = c.col JOIN (SELECT pair_id, count(*) AS n, avg(pred) AS pred FROM icv GROUP BY 1) v ON v.pair_id = i.pair_id
WHERE p.kind = 'interpolate'""", "plan", "ipairs", "icv", "legs"))

oracle("extrapolated_metrics", tsql(f"""
SELECT p.req_key, p.alias || '_desde_' || e.position || '_ext' AS model_id, c.col AS source,
       round(p.target_km / p.source_km, 4) AS factor, e.approved AS trained,
       CASE WHEN e.approved THEN round(e.mae_folds_mean * (p.target_km / p.source_km), 4) END AS mae,
       CASE WHEN e.approved THEN round(e.mae_folds_std * (p.target_km / p.source_km), 4) END AS mae_std,
       CASE WHEN e.approved THEN greatest(e.score - 10, 0) END AS score,
       CASE WHEN e.approved THEN round(e.improvement * 0.9, 4) END AS improvement,
       CASE WHEN e.approved THEN round(e.improvement, 4) END AS improvement_estimated,
       CASE WHEN e.approved THEN e.n END AS n_samples
FROM plan p JOIN ({_COLS}) c ON round(p.source_km, 3) = round(c.col_km, 3)
JOIN ieval e ON e.target = c.col
WHERE p.kind = 'interpolate'""", "plan", "ieval", "legs"))

oracle("residual_quantiles", tsql(_ids("pquant", "p", "round(s.q10, 4) AS q10, round(s.q50, 4) AS q50, "
                                                      "round(s.q90, 4) AS q90"), "ppairs", "pquant"))

oracle("interval_predict", tsql(_ids("pint", "p", "s.row_key, s.y, round(s.pred, 4) AS pred, "
                                                  "round(s.lower, 4) AS lower, round(s.median, 4) AS median, "
                                                  "round(s.upper, 4) AS upper"), "ppairs", "pint"))

oracle("coverage", tsql(_ids("pcov", "p", "round(s.coverage, 4) AS coverage, s.n_test"), "ppairs", "pcov"))

oracle("batch_predict", tsql(_ids("ppred", "p", "s.row_key, round(s.pred, 4) AS pred"), "ppairs", "ppred"))

oracle("fit_if_approved", tsql("""
SELECT p.model_id, g.approved, CASE WHEN g.approved THEN 'fit_final' ELSE 'skip' END AS action,
       CASE WHEN g.approved THEN g.n END AS n_train, CAST(CASE WHEN g.approved THEN p.n_features END AS INTEGER) AS n_features
FROM igate g JOIN ipairs p ON p.pair_id = g.pair_id""", "ipairs", "igate"))

oracle("error_metrics", tsql(_ids("""(SELECT pair_id, count(*) AS n, avg(abs(y - pred)) AS mae,
    sqrt(avg((y - pred) * (y - pred))) AS rmse,
    CASE WHEN var_pop(y) > 0 THEN 1 - avg((y - pred) * (y - pred)) / var_pop(y) END AS r2,
    max(abs(y - pred)) AS max_error, min(abs(y - pred)) AS min_error, stddev_pop(abs(y - pred)) AS std_error,
    quantile_cont(abs(y - pred), 0.25) AS q1_error, quantile_cont(abs(y - pred), 0.5) AS median_error,
    quantile_cont(abs(y - pred), 0.75) AS q3_error, quantile_cont(abs(y - pred), 0.9) AS p90_error,
    quantile_cont(abs(y - pred), 0.95) AS p95_error, quantile_cont(abs(y - pred), 0.99) AS p99_error,
    avg(abs((y - pred) / (y + 1e-6)) * 100) AS mape,
    quantile_cont(abs((y - pred) / (y + 1e-6)) * 100, 0.5) AS median_rel_error,
    quantile_cont(abs((y - pred) / (y + 1e-6)) * 100, 0.95) AS p95_rel_error
  FROM icv GROUP BY pair_id)""", "i", "s.n, " + ", ".join(
    f"round(s.{c}, 4) AS {c}" for c in ["mae", "rmse", "r2", "max_error", "min_error", "std_error", "q1_error",
                                        "median_error", "q3_error", "p90_error", "p95_error", "p99_error", "mape",
                                        "median_rel_error", "p95_rel_error"])), "ipairs", "icv"))

oracle("metric_provenance", tsql("""
SELECT p.req_key, e.model_id, e.target, p.source AS split_origen, p.kind AS tipo_origen,
       CASE WHEN p.kind = 'interpolate' THEN round(abs(p.source_km - p.target_km), 4) END AS diferencia_distancia,
       round(e.mae, 4) AS mae
FROM ieval e LEFT JOIN plan p ON p.alias = e.target AND p.kind <> 'impossible'""", "plan", "ieval"))

oracle("gate_naive", tsql(_ids("igate", "i", "round(s.mae_naive, 4) AS mae_naive, round(s.mae, 4) AS mae, "
                                             "round(s.improvement, 4) AS improvement, s.pass_naive"),
                          "ipairs", "igate"))
oracle("gate_consistency", tsql(_ids("igate", "i", "round(s.std_error, 4) AS std_error, round(s.cv, 4) AS cv, "
                                                   "s.pass_consistency"), "ipairs", "igate"))
oracle("gate_outliers", tsql(_ids("igate", "i", "round(s.p50, 4) AS p50, round(s.p95, 4) AS p95, "
                                                "round(s.ratio, 4) AS ratio, s.pass_outliers"), "ipairs", "igate"))
oracle("quality_score", tsql(_ids("igate", "i", "s.pass_naive, s.pass_consistency, s.pass_outliers, s.score, "
                                                "s.approved"), "ipairs", "igate"))
oracle("approval_status", tsql(_ids("igate", "i", "s.score, s.approved, CASE WHEN s.approved AND s.score >= 60 "
                                                  "THEN 'PendingManualApproval' ELSE 'Rejected' END AS status"),
                               "ipairs", "igate"))

oracle("validation_stats_interp", tsql("""
SELECT count(g.score) AS total_evaluados, count(*) FILTER (WHERE g.approved) AS aprobados,
       count(*) FILTER (WHERE NOT g.approved) AS rechazados, count(*) FILTER (WHERE NOT c.trained) AS insuficientes,
       round(avg(g.score), 4) AS puntuacion_promedio, min(g.score) AS puntuacion_min, max(g.score) AS puntuacion_max,
       round(avg(g.improvement), 4) AS mejora_promedio_sobre_naive, round(avg(g.cv), 4) AS cv_promedio,
       round(avg(g.ratio), 4) AS ratio_outliers_promedio,
       count(*) FILTER (WHERE NOT g.pass_naive) AS rechazos_por_mejor_que_naive,
       count(*) FILTER (WHERE NOT g.pass_consistency) AS rechazos_por_consistencia,
       count(*) FILTER (WHERE NOT g.pass_outliers) AS rechazos_por_outliers,
       round(CASE WHEN count(g.score) > 0 THEN (count(*) FILTER (WHERE g.approved)) / count(g.score) ELSE 0.0 END, 4)
         AS tasa_aprobacion
FROM icounts c LEFT JOIN igate g ON c.pair_id = g.pair_id""", "icounts", "igate"))

oracle("validation_stats_pred", tsql("""
SELECT count(*) AS total_evaluados, count(*) FILTER (WHERE approved) AS aprobados,
       count(*) FILTER (WHERE NOT approved) AS rechazados, round(avg(score), 4) AS calidad_promedio,
       round(avg(improvement), 4) AS mejora_promedio, round(avg(cv), 4) AS cv_promedio,
       round(CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE approved)) / count(*) ELSE 0.0 END, 4)
         AS tasa_aprobacion
FROM pgate""", "pgate"))

oracle("top_models_mae", tsql("""
SELECT model_id, round(mae_folds_mean, 4) AS mae, score FROM ieval WHERE approved
ORDER BY mae_folds_mean, model_id LIMIT 5""", "ieval"))

oracle("top_models_quality", tsql("""
SELECT model_id, round(mae_folds_mean, 4) AS mae, score FROM ieval WHERE approved
ORDER BY score DESC, mae_folds_mean, model_id LIMIT 5""", "ieval"))

oracle("metric_summary", tsql("""
SELECT round(coalesce(avg(mae_folds_mean), 0.0), 4) AS mae_promedio,
       round(coalesce(avg(mae_folds_std), 0.0), 4) AS mae_std_promedio,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS total_muestras
FROM ieval WHERE approved""", "ieval"))

oracle("split_source_report", tsql("""
SELECT c.req_key, coalesce(m.kind, 'unknown') AS kind, count(*) AS n_splits
FROM (SELECT req_key, translate(alias, '.- ', '___') AS col FROM plan WHERE kind <> 'impossible') c
LEFT JOIN (SELECT req_key, translate(original, '.- ', '___') AS col, kind FROM plan) m
  ON c.req_key = m.req_key AND c.col = m.col
GROUP BY 1, 2""", "plan"))

oracle("training_row_report", tsql("""
SELECT p.prefix AS input_splits, p.target AS output_split, round(g.mae, 4) AS mae_test,
       round(v.coverage, 4) AS cobertura_test, round(q.q10, 4) AS q10_train, round(q.q50, 4) AS q50_train,
       round(q.q90, 4) AS q90_train, s.n_samples_train, s.n_samples_test, s.n_atletas_train, s.n_atletas_test,
       g.approved AS validacion_aprobado, g.score AS calidad
FROM ppairs p
JOIN (SELECT pair_id, count(*) FILTER (WHERE NOT holdout) AS n_samples_train,
             count(*) FILTER (WHERE holdout) AS n_samples_test,
             count(DISTINCT CASE WHEN NOT holdout THEN athlete_id END) AS n_atletas_train,
             count(DISTINCT CASE WHEN holdout THEN athlete_id END) AS n_atletas_test
      FROM ptrained GROUP BY pair_id) s ON p.pair_id = s.pair_id
LEFT JOIN pquant q ON p.pair_id = q.pair_id
LEFT JOIN pcov v ON p.pair_id = v.pair_id
LEFT JOIN pgate g ON p.pair_id = g.pair_id""", "ppairs", "ptrained", "pquant", "pcov", "pgate"))

_GRID = "(SELECT CAST(count(*) AS INTEGER) FROM legs) AS n_splits, (SELECT CAST(count(*) * (count(*) - 1) // 2 AS INTEGER) FROM legs) AS expected_pairs"
oracle("grid_totals", tsql(f"""
SELECT 'interpolacion' AS kind, {_GRID},
       count(*) FILTER (WHERE trained) AS trained_pairs, count(*) FILTER (WHERE trained) * 1 AS models FROM icounts
UNION ALL
SELECT 'prediccion', {_GRID}, count(*) FILTER (WHERE trained),
       count(*) FILTER (WHERE trained) * 3 FROM pcounts""", "icounts", "pcounts", "legs"))

oracle("batch_summary", tsql("""
SELECT r.req_key, r.nombre, len(r.splits) AS splits_originales, p.splits, p.splits_interpolados, p.splits_imposibles,
       s.carreras_usadas
FROM req_valid r
JOIN (SELECT req_key, count(*) FILTER (WHERE kind <> 'impossible') AS splits,
             count(*) FILTER (WHERE kind = 'interpolate') AS splits_interpolados,
             count(*) FILTER (WHERE kind = 'impossible') AS splits_imposibles FROM plan GROUP BY req_key) p
  ON r.req_key = p.req_key
JOIN (SELECT req_key, count(*) AS carreras_usadas FROM selection GROUP BY req_key) s ON r.req_key = s.req_key""",
                             "req_valid", "plan", "selection"))
