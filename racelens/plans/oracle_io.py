"""Oracle SQL of sources and sinks (S keys) and model ids."""

from __future__ import annotations

from racelens.plans.oracle import oracle
from racelens.plans.oracle_train import tsql

RUN_TS = "20260303-085722"

oracle("catalog_scan", tsql("""
SELECT CAST(row_number() OVER (ORDER BY c.race_id, c.event_id) - 1 AS INTEGER) AS cat_pos,
       c.race_id || '_' || c.event_id AS entry_key, c.race_id, c.event_id, c.event_std, s.splits
FROM race_catalog c
JOIN (SELECT race_id, event_id, string_agg(split, ',' ORDER BY pos) AS splits FROM catalog_splits GROUP BY 1, 2) s
  ON c.race_id = s.race_id AND c.event_id = s.event_id""", "race_catalog", "catalog_splits"))

oracle("wide_scan", tsql("""
SELECT DISTINCT r.finisher_id, r.athlete_id, r.race_id, r.event_id, r.event_std, r.gender, r.age,
       CASE WHEN even THEN split END AS split, CASE WHEN even THEN secs END AS secs
FROM (SELECT *, TRY_CAST(string_split(race_id, '-')[-1] AS INTEGER) % 2 = 0 AS even FROM race_long) r""", "race_long"))

oracle("column_def_parse", tsql("""
SELECT req_key, pos, definition, regexp_extract(definition, '^\\s*"?([^"\\s]+)"?\\s*([A-Za-z0-9_<>,()]*)\\s*$', 1) AS name,
       CASE WHEN regexp_extract(definition, '^\\s*"?([^"\\s]+)"?\\s*([A-Za-z0-9_<>,()]*)\\s*$', 2) = '' THEN 'string'
            ELSE lower(regexp_extract(definition, '^\\s*"?([^"\\s]+)"?\\s*([A-Za-z0-9_<>,()]*)\\s*$', 2)) END AS type
FROM (
  SELECT req_key, CAST(t.pos AS INTEGER) AS pos, t.d AS definition
  FROM (SELECT DISTINCT req_key FROM plan WHERE kind <> 'impossible') r,
       (VALUES (0, 'athlete_id'), (1, '"event_std" string'), (2, '"gender"'), (3, '"age" int')) t(pos, d)
  UNION ALL
  SELECT req_key, CAST(3 + row_number() OVER (PARTITION BY req_key ORDER BY ord) AS INTEGER),
         '"' || split || '" double'
  FROM plan WHERE kind <> 'impossible')""", "plan"))

oracle("partition_select", tsql("""
SELECT w.race_id, w.event_id, count(*) AS n_rows,
       count(CASE WHEN TRY_CAST(string_split(w.race_id, '-')[-1] AS INTEGER) % 2 = 0 THEN w.km_5 END) AS n_km_5
FROM race_wide w JOIN (SELECT DISTINCT race_id, event_id FROM selection) s
  ON w.race_id = s.race_id AND w.event_id = s.event_id
GROUP BY 1, 2""", "race_wide", "selection"))

oracle("training_table_write", tsql("""
SELECT req_key, nombre, athlete_id, event_id, event_std, gender, age, ord, split, secs FROM train_long""",
                                    "train_long"))

oracle("manifest_write", tsql(f"""
SELECT r.req_key, r.nombre AS carrera, '{RUN_TS}' AS timestamp, CAST(len(r.splits) AS INTEGER) AS n_originales,
       p.finales AS splits_finales, coalesce(p.directos, '') AS splits_directos,
       CAST(p.n_interp AS INTEGER) AS n_interpolables, coalesce(p.imposibles, '') AS splits_imposibles,
       CAST(p.n_map AS INTEGER) AS n_mapping,
       'temp_wide_' || substr(md5(p.keyset), 1, 8) AS tabla_fuente,
       replace('modelo_' || regexp_replace(r.nombre, '[^a-zA-Z0-9_-]', '_', 'g') || '_{RUN_TS}', '-', '_')
         AS tabla_generada,
       CAST(s.n AS INTEGER) AS carreras_usadas
FROM req_valid r
JOIN (SELECT req_key,
             string_agg(split, ',' ORDER BY ord) FILTER (WHERE kind <> 'impossible') AS finales,
             string_agg(split, ',' ORDER BY ord) FILTER (WHERE kind = 'direct') AS directos,
             count(*) FILTER (WHERE kind = 'interpolate') AS n_interp,
             string_agg(split, ',' ORDER BY ord) FILTER (WHERE kind = 'impossible') AS imposibles,
             count(*) FILTER (WHERE kind <> 'impossible') AS n_map,
             string_agg(split, '_' ORDER BY split) FILTER (WHERE kind <> 'impossible') AS keyset
      FROM plan GROUP BY req_key) p ON r.req_key = p.req_key
JOIN (SELECT req_key, count(*) AS n FROM selection GROUP BY req_key) s ON r.req_key = s.req_key
WHERE p.finales IS NOT NULL""", "req_valid", "plan", "selection"))

_JOB = """
SELECT r.nombre AS carrera, r.nombre || '-' || '{ts}' AS carpeta_modelo,
       'models/modelos/' || r.nombre || '-' || '{ts}' || '/data/' AS data_path,
       'modelo_' || replace(r.nombre, '-', '_') || '_' || replace('{ts}', '-', '_') AS tabla_generada,
       CAST(p.splits AS INTEGER) AS splits, CAST(s.n AS INTEGER) AS carreras_usadas{extra}
FROM req_valid r
JOIN (SELECT req_key, count(*) FILTER (WHERE kind <> 'impossible') AS splits,
             count(*) FILTER (WHERE kind = 'interpolate') AS interp,
             count(*) FILTER (WHERE kind = 'impossible') AS imp FROM plan GROUP BY req_key) p
  ON r.req_key = p.req_key
JOIN (SELECT req_key, count(*) AS n FROM selection GROUP BY req_key) s ON r.req_key = s.req_key"""

oracle("manifest_rewrite", tsql(_JOB.format(ts=RUN_TS, extra=""), "req_valid", "plan", "selection"))

oracle("latest_manifest", tsql(_JOB.format(
    ts=RUN_TS, extra=", CAST(len(r.splits) AS INTEGER) AS splits_originales, CAST(p.interp AS INTEGER) AS "
                     "splits_interpolados, CAST(p.imp AS INTEGER) AS splits_imposibles"),
    "req_valid", "plan", "selection"))

oracle("reuse_if_exists", tsql("""
SELECT s.source_table AS table_name, false AS reused_first, true AS reused_second, f.race_id, count(*) AS n_rows
FROM (SELECT DISTINCT k.source_table, x.race_id, x.event_id
      FROM (SELECT req_key, 'temp_wide_' || substr(md5(string_agg(split, '_' ORDER BY split)), 1, 8) AS source_table
            FROM plan WHERE kind <> 'impossible' GROUP BY req_key) k
      JOIN selection x ON k.req_key = x.req_key) s
JOIN (SELECT DISTINCT finisher_id, race_id, event_id FROM race_long) f ON f.race_id = s.race_id AND f.event_id = s.event_id
GROUP BY s.source_table, f.race_id""", "plan", "selection", "race_long"))

oracle("recursive_load", tsql("""
SELECT finisher_id, athlete_id, event_std, gender, age,
       split || CASE WHEN TRY_CAST(string_split(race_id, '-')[-1] AS INTEGER) % 2 = 1 THEN '_0' ELSE '' END AS split, secs
FROM race_long""", "race_long"))

oracle("metrics_csv", tsql("""
SELECT p.model_id, p.target, p.position, round(f.mae_folds_mean, 4) AS mae, round(f.mae_folds_std, 4) AS mae_std,
       g.n AS n_samples, g.score, g.approved
FROM ipairs p JOIN igate g ON p.pair_id = g.pair_id JOIN ifolds f ON p.pair_id = f.pair_id""",
                           "ipairs", "igate", "ifolds"))

oracle("metrics_json", tsql("""
SELECT p.model_id, round(f.mae_folds_mean, 4) AS mae, round(f.mae_folds_std, 4) AS mae_std,
       round(CASE WHEN var_pop(c.y) > 0 THEN 1 - avg((c.y - c.pred) * (c.y - c.pred)) / var_pop(c.y) END, 4) AS r2,
       g.n AS n_samples, g.score AS calidad, g.approved AS aprobado, round(g.improvement, 4) AS mejora_sobre_naive,
       round(g.cv, 4) AS cv_error, round(g.ratio, 4) AS outliers_ratio
FROM ipairs p JOIN igate g ON p.pair_id = g.pair_id JOIN ifolds f ON p.pair_id = f.pair_id
JOIN icv c ON c.pair_id = p.pair_id
GROUP BY p.model_id, f.mae_folds_mean, f.mae_folds_std, g.n, g.score, g.approved, g.improvement, g.cv, g.ratio""",
                            "ipairs", "igate", "ifolds", "icv"))

_PRED_IDS = """
SELECT 'pred_' || p.prefix || '_to_' || replace(p.target, 'km_', '') || '_q' || q.q AS model_id
FROM ppairs p JOIN pcounts c ON p.pair_id = c.pair_id AND c.trained, (VALUES ('10'), ('50'), ('90')) q(q)"""

oracle("model_ids", tsql(f"""
SELECT p.model_id, 'interpolacion' AS kind FROM ipairs p JOIN icounts c ON p.pair_id = c.pair_id AND c.trained
UNION ALL
SELECT model_id, 'prediccion' FROM ({_PRED_IDS})""", "ipairs", "icounts", "ppairs", "pcounts"))

oracle("model_index", tsql(f"""
SELECT coalesce((SELECT '[' || string_agg('"' || model_id || '"', ',' ORDER BY model_id) || ']'
                 FROM ieval WHERE approved), '[]') AS modelos_disponibles,
       (SELECT '[' || string_agg('"' || model_id || '"', ',' ORDER BY model_id) || ']'
        FROM ({_PRED_IDS})) AS modelos_prediccion""", "ppairs", "pcounts", "ieval"))

oracle("run_summary_write", tsql(f"""
SELECT 'race_wide' AS carrera, '{RUN_TS}' AS timestamp, (SELECT CAST(count(*) AS INTEGER) FROM ipairs) AS total_modelos_teoricos,
       count(*) FILTER (WHERE g.approved) AS modelos_guardados, (SELECT string_agg(name, ',' ORDER BY k) FROM legs) AS splits,
       100 AS n_estimators, 10 AS max_depth,
       (SELECT round(coalesce(avg(mae_folds_mean), 0.0), 6) FROM ieval WHERE approved) AS mae_promedio,
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM ieval WHERE approved) AS total_muestras,
       count(g.score) AS total_evaluados, count(*) FILTER (WHERE g.approved) AS aprobados,
       count(*) FILTER (WHERE NOT c.trained) AS insuficientes,
       round(CASE WHEN count(g.score) > 0 THEN (count(*) FILTER (WHERE g.approved)) / count(g.score) ELSE 0.0 END, 4)
         AS tasa_aprobacion
FROM icounts c LEFT JOIN igate g ON c.pair_id = g.pair_id""", "icounts", "igate", "ieval", "ipairs", "legs"))

