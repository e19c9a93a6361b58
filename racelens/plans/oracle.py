"""Oracle SQL (DuckDB) for the registered queries, same keys and column names."""

from __future__ import annotations

from racelens.plans.oracle_base import sort_km_sql, split_km_sql, sql

ORACLE: dict[str, str] = {}


def oracle(key: str, text: str) -> None:
    ORACLE[key] = text


# name rows: result legs under catalog spelling + requested names
_NAME_ROWS = ("name_rows", (["race_long", "raw_requests"], """
  SELECT split || CASE WHEN TRY_CAST(string_split(race_id, '-')[-1] AS INTEGER) % 2 = 1 THEN '_0' ELSE '' END AS name
  FROM race_long
  UNION ALL
  SELECT unnest(splits) AS name FROM raw_requests"""))
_EXTRA = {_NAME_ROWS[0]: _NAME_ROWS[1]}


def nsql(body: str, *deps: str) -> str:
    return sql(body, *deps, extra=_EXTRA)


_STRICT = ("(NOT (lower({n}) LIKE '%\\_id' ESCAPE '\\' OR lower({n}) LIKE '%\\_std' ESCAPE '\\' "
           "OR lower({n}) LIKE 'rawtime\\_%' ESCAPE '\\' OR lower({n}) IN ({fixed})) AND ({keep}))")
_FIXED_I = "'gender', 'age', 'birthdate', 'athlete_id', 'event_id', 'event_std'"
_FIXED_P = _FIXED_I + ", 'race_id'"


def _detect(n: str, mode: str) -> str:
    if mode == "prediction":
        keep = f"lower({n}) LIKE 'km\\_%' ESCAPE '\\' OR lower({n}) IN ('half', 'finish', 'meta')"
        fixed = _FIXED_P
    else:
        keep = f"lower({n}) LIKE 'km\\_%' ESCAPE '\\' OR lower({n}) IN ('half', 'finish', 'meta', 'start')"
        if mode == "broad":
            keep += "".join(f" OR contains(lower({n}), '{m}')" for m in ("km", "half", "finish", "meta"))
        fixed = _FIXED_I
    return _STRICT.format(n=n, fixed=fixed, keep=keep)


# ---------------------------------------------------------------- F
oracle("split_distance", nsql(f"""
SELECT name AS split_name, count(*) AS n_rows, round({split_km_sql('name')}, 6) AS km
FROM name_rows GROUP BY name""", "name_rows"))

oracle("split_type", nsql(f"""
SELECT CASE WHEN {split_km_sql('name')} IS NOT NULL THEN 'distance' ELSE 'other' END AS split_type,
       count(*) AS n_rows
FROM name_rows GROUP BY 1""", "name_rows"))

oracle("split_order", nsql(f"""
SELECT item, coalesce(string_agg(s, ',' ORDER BY {sort_km_sql('s')}, pos), '') AS ordered
FROM (
  SELECT req_key AS item, s, pos FROM (
    SELECT req_key, unnest(splits) AS s, generate_subscripts(splits, 1) AS pos FROM raw_requests)
  UNION ALL
  SELECT race_id || '/' || event_id, split, pos FROM catalog_splits)
GROUP BY item
UNION ALL
SELECT req_key, '' FROM raw_requests WHERE len(splits) = 0""", "raw_requests", "catalog_splits"))

oracle("split_detect", nsql(f"""
SELECT name AS column_name, {_detect('name', 'strict')} AS is_split_strict,
       {_detect('name', 'broad')} AS is_split_broad, {_detect('name', 'prediction')} AS is_split_prediction
FROM (SELECT DISTINCT name FROM (
        SELECT name FROM name_rows
        UNION ALL
        SELECT name FROM legs
        UNION ALL
        SELECT unnest(['finisher_id', 'athlete_id', 'race_id', 'event_id', 'event_std', 'gender', 'age'])))""",
                            "name_rows", "legs"))

oracle("column_normalise", nsql("""
SELECT name AS column_name, translate(name, '.- ', '___') AS normalised
FROM (SELECT DISTINCT name FROM name_rows)""", "name_rows"))

oracle("split_normalise", nsql("""
SELECT req_key, CAST(generate_subscripts(splits, 1) - 1 AS INTEGER) AS ord, unnest(splits) AS original,
       replace(lower(unnest(splits)), '.', '_') AS normalised
FROM raw_requests""", "raw_requests"))

oracle("split_alias", nsql("""
SELECT req_key, original, split, alias FROM plan WHERE kind <> 'impossible'""", "plan"))

oracle("split_equivalent", nsql("""
SELECT req_key, split, hname, round(diff, 6) AS diff_km FROM equiv""", "equiv"))

oracle("closest_split", nsql("""
SELECT req_key, split, hname AS closest, round(hkm, 6) AS closest_km, round(diff, 6) AS diff_km
FROM nearest""", "nearest"))

oracle("prefix_label", nsql(f"""
SELECT race_id, event_id,
       string_agg(CASE WHEN contains(split, 'km_') THEN replace(replace(split, 'km_', ''), '_', '.') || 'k'
                       ELSE split END, '_' ORDER BY {sort_km_sql('split')}, pos) AS prefix_label
FROM catalog_splits GROUP BY race_id, event_id""", "catalog_splits"))

oracle("race_parse", nsql("""
SELECT name,
       CASE WHEN regexp_matches(name, '^(.*)-([0-9]{4})$') THEN regexp_extract(name, '^(.*)-([0-9]{4})$', 1) END AS base,
       CASE WHEN regexp_matches(name, '^(.*)-([0-9]{4})$')
            THEN CAST(regexp_extract(name, '^(.*)-([0-9]{4})$', 2) AS INTEGER) END AS target_year,
       TRY_CAST(string_split(name, '-')[-1] AS INTEGER) AS edition_year
FROM (SELECT nombre AS name FROM req_norm UNION SELECT race_id FROM race_catalog)""", "req_norm", "race_catalog"))

oracle("gender_encode", nsql("""
SELECT gender, CAST(CASE WHEN gender IN ('M', 'male', 'Male', 'MALE') THEN 0
                         WHEN gender IN ('F', 'female', 'Female', 'FEMALE') THEN 1 ELSE 0 END AS INTEGER) AS gender_code,
       count(*) AS n_rows
FROM race_wide GROUP BY 1, 2""", "race_wide"))

oracle("manifest_normalise", nsql("""
SELECT req_key, translate(original, '.- ', '___') AS split_key, kind, translate(source, '.- ', '___') AS source
FROM plan""", "plan"))

# ---------------------------------------------------------------- C
oracle("request_normalise", nsql("""
SELECT req_key, nombre, array_to_string(splits, ',') AS splits, event_id_filter, event_std_filter, tipo_modelo
FROM req_norm""", "req_norm"))

oracle("request_validate", nsql("""
SELECT req_key, nombre, tipo_modelo, tipo_modelo IN ('interpolacion', 'prediccion') AS is_valid,
       CASE WHEN tipo_modelo IN ('interpolacion', 'prediccion') THEN NULL
            ELSE 'unknown tipo_modelo: ' || tipo_modelo END AS reason
FROM req_norm""", "req_norm"))

oracle("run_timestamp", "SELECT strftime(max(o_orderdate), '%Y%m%d-%H%M%S') AS run_ts FROM orders")

oracle("run_names", nsql("""
SELECT req_key, nombre, nombre || '-' || '20260303-085722' AS model_folder,
       replace('modelo_' || regexp_replace(nombre, '[^a-zA-Z0-9_-]', '_', 'g') || '_' || '20260303-085722', '-', '_')
         AS result_table
FROM req_valid""", "req_valid"))

oracle("batch_outcomes", nsql("""
SELECT r.req_key, r.nombre,
       CASE WHEN u.n IS NOT NULL THEN 'success' ELSE 'failure' END AS outcome,
       CASE WHEN u.n IS NOT NULL THEN NULL
            WHEN NOT regexp_matches(r.nombre, '^(.*)-([0-9]{4})$') THEN 'malformed race name'
            ELSE 'no historical data' END AS reason,
       coalesce(u.n, 0) AS races_used
FROM req_valid r LEFT JOIN (SELECT req_key, count(*) AS n FROM selection GROUP BY req_key) u
  ON r.req_key = u.req_key""", "req_valid", "selection"))

# ---------------------------------------------------------------- R
oracle("history_exact", nsql("""
SELECT req_key, nombre, race_id, event_id, event_std, year, rank FROM (
  SELECT k.*, CAST(row_number() OVER (PARTITION BY k.req_key ORDER BY k.race_id, k.event_id) AS INTEGER) AS rank
  FROM cands k
  JOIN (SELECT race_id, event_id, list_sort(list_distinct(list(lower(split)))) AS cset
        FROM catalog_splits GROUP BY race_id, event_id) cs ON cs.race_id = k.race_id AND cs.event_id = k.event_id
  JOIN (SELECT req_key, list_sort(list_distinct(list_transform(splits, lambda s: lower(s)))) AS wset
        FROM req_valid) w ON w.req_key = k.req_key
  WHERE cs.cset = w.wset)
WHERE rank <= 5""", "cands", "catalog_splits", "req_valid"))

oracle("history_candidates", nsql("""
SELECT req_key, race_id, event_id, event_std, year FROM cands""", "cands"))

oracle("split_universe", nsql("""
SELECT req_key, hname, round(hkm, 6) AS hkm FROM universe""", "universe"))

oracle("split_plan", nsql("""
SELECT req_key, ord, original, split, kind, source, round(source_km, 6) AS source_km, round(target_km, 6) AS target_km,
       round(CASE WHEN kind <> 'impossible' THEN abs(source_km - target_km) END, 6) AS diff_km, alias
FROM plan""", "plan"))

oracle("final_splits", nsql("""
SELECT req_key, string_agg(split, ',' ORDER BY ord) AS final_splits, count(*) AS n_final
FROM plan WHERE kind <> 'impossible' GROUP BY req_key""", "plan"))

oracle("drop_undistanced", nsql("""
SELECT req_key, race_id, event_id, has_imp AS has_impossible, has_dist AS has_distance,
       (NOT has_imp OR has_dist) AS kept
FROM cand_flags""", "cand_flags"))

oracle("latest_editions", nsql("""
SELECT req_key, race_id, event_id, year, rank FROM selection""", "selection"))

oracle("history_adaptive", nsql("""
SELECT req_key, nombre, race_id, event_id, event_std, year, rank FROM selection""", "selection"))

oracle("result_filter", nsql("""
SELECT s.req_key, s.race_id, s.event_id, count(*) AS n_rows, count(DISTINCT w.athlete_id) AS n_athletes
FROM selection s JOIN req_prep r ON r.req_key = s.req_key
JOIN race_wide w ON w.race_id = s.race_id AND w.event_id = s.event_id
 AND (r.eid_f IS NULL OR w.event_id = r.eid_f) AND (r.estd_f IS NULL OR w.event_std = r.estd_f)
GROUP BY 1, 2, 3""", "selection", "req_prep", "race_wide"))

oracle("training_projection", nsql("""
SELECT req_key, athlete_id, event_id, event_std, gender, age, string_agg(split, ',' ORDER BY ord) AS split_names,
       string_agg(coalesce(CAST(CAST(secs AS DECIMAL(18, 3)) AS VARCHAR), ''), ',' ORDER BY ord) AS split_secs
FROM train_long GROUP BY req_key, finisher_id, athlete_id, event_id, event_std, gender, age""", "train_long"))

oracle("training_table", nsql("""
SELECT req_key, nombre, athlete_id, event_id, event_std, gender, age, ord, split, secs FROM train_long""",
                              "train_long"))

oracle("schema_fingerprint", nsql("""
SELECT req_key, 'temp_wide_' || substr(md5(string_agg(split, '_' ORDER BY split)), 1, 8) AS source_table
FROM plan WHERE kind <> 'impossible' GROUP BY req_key""", "plan"))

oracle("preview", nsql("""
SELECT req_key, nombre, athlete_id, event_id, event_std, gender, age, ord, split, secs FROM train_long
QUALIFY row_number() OVER (PARTITION BY req_key ORDER BY athlete_id, event_id, ord, secs NULLS FIRST) <= 5""", "train_long"))
