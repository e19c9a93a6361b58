"""DuckDB oracle: the derived race tables and the selection logic as SQL.

These statements solve the same problems the straightforward way (cross products of split names, explicit
unpivots) because the oracle only has to be right, not scalable. Tables
``lineitem``, ``orders`` and ``customer`` are views registered by the
checker. ``sql(body, *deps)`` prefixes the needed CTEs in dependency order.
"""

from __future__ import annotations

from racelens.sources import fixtures as X


def sq(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def split_km_sql(e: str) -> str:
    """F1 in DuckDB."""
    low = f"lower({e})"
    num = f"regexp_extract({low}, '^km_([0-9]*[._]?[0-9]+)$', 1)"
    return (f"(CASE WHEN {low} = 'half' THEN 21.0975 WHEN {low} = 'finish' THEN 42.195 "
            f"WHEN {low} = 'start' THEN 0.0 WHEN {num} <> '' THEN TRY_CAST(replace({num}, '_', '.') AS DOUBLE) "
            f"ELSE CAST(NULL AS DOUBLE) END)")


def sort_km_sql(e: str) -> str:
    """F3 sort key in DuckDB (synonyms, unknown = infinity)."""
    low = f"lower({e})"
    num = f"regexp_extract({low}, '^km_([0-9]*[._]?[0-9]+)$', 1)"
    return (f"coalesce(CASE WHEN {low} IN ('half', 'media') THEN 21.0975 WHEN {low} IN ('finish', 'meta') "
            f"THEN 42.195 WHEN {low} IN ('start', 'salida') THEN 0.0 "
            f"WHEN {num} <> '' THEN TRY_CAST(replace({num}, '_', '.') AS DOUBLE) END, 'inf'::DOUBLE)")


def _requests_values() -> str:
    rows = []
    for key, pos, nombre, carrera, splits, eid, estd, tipo in X.LITERAL_REQUESTS:
        arr = "CAST([" + ", ".join(sq(s) for s in splits) + "] AS VARCHAR[])"
        rows.append(f"({sq(key)}, {pos}, {sq(nombre)}, {sq(carrera)}, {arr}, {sq(eid)}, {sq(estd)}, {sq(tipo)})")
    return ",\n    ".join(rows)


_ED_SPLITS = "CAST([" + ", ".join(sq(s) for s in X.EDITION_REQUEST_SPLITS) + "] AS VARCHAR[])"

ORDER_KEYS = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"

CTES: dict[str, tuple[list[str], str]] = {
    "finishers": ([], """
  SELECT o_orderkey AS finisher_id, CAST(o_custkey AS VARCHAR) AS athlete_id,
         lower(c_mktsegment) || '-' || CAST(year(o_orderdate) AS VARCHAR) AS race_id,
         substr(o_orderpriority, 1, 1) AS event_id,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'urgent' ELSE 'regular' END AS event_std,
         CASE o_custkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'male' WHEN 3 THEN 'FEMALE' END AS gender,
         CAST(18 + o_custkey % 60 AS INTEGER) AS age
  FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "race_legs": ([], f"""
  SELECT l_orderkey,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORDER_KEYS}) AS INTEGER) AS leg,
         sum(1200 + 10 * l_quantity) OVER (PARTITION BY l_orderkey ORDER BY {ORDER_KEYS}
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS secs
  FROM lineitem"""),
    "race_long": (["finishers", "race_legs"], """
  SELECT f.finisher_id, f.athlete_id, f.race_id, f.event_id, f.event_std, f.gender, f.age, l.leg,
         'km_' || CAST(5 * l.leg AS VARCHAR) AS split, CAST(5.0 * l.leg AS DOUBLE) AS dist_km, l.secs
  FROM race_legs l JOIN finishers f ON l.l_orderkey = f.finisher_id"""),
    # the columns of the wide table that queries name one by one; all others are read from race_long
    "race_wide": (["finishers", "race_legs"], """
  SELECT f.finisher_id, f.athlete_id, f.race_id, f.event_id, f.event_std, f.gender, f.age, w.*
  FROM (SELECT l_orderkey AS wk, max(CASE WHEN leg = 1 THEN secs END) AS km_5,
          max(CASE WHEN leg = 2 THEN secs END) AS km_10, max(CASE WHEN leg = 4 THEN secs END) AS km_20
        FROM race_legs GROUP BY l_orderkey) w
  JOIN finishers f ON w.wk = f.finisher_id"""),
    "legs": (["race_legs"], """
  SELECT DISTINCT leg AS k, 'km_' || CAST(5 * leg AS VARCHAR) AS name FROM race_legs"""),
    "wide_long": (["race_long"], """
  SELECT finisher_id, split || CASE WHEN TRY_CAST(string_split(race_id, '-')[-1] AS INTEGER) % 2 = 1 THEN '_0' ELSE '' END AS col,
         secs FROM race_long"""),
    "race_catalog": (["finishers"], """
  SELECT race_id, event_id, max(event_std) AS event_std,
         TRY_CAST(string_split(race_id, '-')[-1] AS INTEGER) AS year
  FROM finishers GROUP BY race_id, event_id"""),
    "catalog_splits": (["race_catalog", "legs"], """
  SELECT c.race_id, c.event_id, CAST(t.k AS INTEGER) - 1 AS pos,
         'km_' || CAST(5 * t.k AS VARCHAR) || CASE WHEN c.year % 2 = 1 THEN '_0' ELSE '' END AS split
  FROM race_catalog c, legs t
  WHERE NOT (c.year % 4 = 0 AND t.k = 4)"""),
    "raw_requests": (["finishers"], f"""
  SELECT * FROM (VALUES
    {_requests_values()}
  ) t(req_key, req_pos, nombre, carrera, splits, event_id_filter, event_std_filter, tipo_modelo)
  UNION ALL
  SELECT 'ed-' || race_id, CAST(NULL AS INTEGER), race_id, CAST(NULL AS VARCHAR), {_ED_SPLITS},
         CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'interpolacion'
  FROM (SELECT DISTINCT race_id FROM finishers)"""),
    "req_norm": (["raw_requests"], """
  SELECT req_key, req_pos, coalesce(nullif(nombre, ''), nullif(carrera, '')) AS nombre, splits,
         event_id_filter, event_std_filter, coalesce(tipo_modelo, 'interpolacion') AS tipo_modelo
  FROM raw_requests
  WHERE coalesce(nullif(nombre, ''), nullif(carrera, '')) IS NOT NULL AND splits IS NOT NULL AND len(splits) > 0"""),
    "req_valid": (["req_norm"], """
  SELECT * FROM req_norm WHERE tipo_modelo IN ('interpolacion', 'prediccion')"""),
    "req_prep": (["req_valid"], """
  SELECT req_key, nombre, splits,
         CASE WHEN regexp_matches(nombre, '^(.*)-([0-9]{4})$')
              THEN regexp_extract(nombre, '^(.*)-([0-9]{4})$', 1) END AS base,
         CASE WHEN regexp_matches(nombre, '^(.*)-([0-9]{4})$')
              THEN CAST(regexp_extract(nombre, '^(.*)-([0-9]{4})$', 2) AS INTEGER) END AS target_year,
         CASE WHEN event_id_filter IS NULL OR event_id_filter IN ('None', '') THEN NULL ELSE event_id_filter END AS eid_f,
         CASE WHEN event_std_filter IS NULL OR event_std_filter IN ('None', '') THEN NULL ELSE event_std_filter END AS estd_f
  FROM req_valid"""),
    "cands": (["req_prep", "race_catalog"], """
  SELECT r.req_key, r.nombre, c.race_id, c.event_id, c.event_std, c.year
  FROM req_prep r JOIN race_catalog c
    ON r.base = regexp_extract(c.race_id, '^(.*)-[^-]*$', 1) AND c.year < r.target_year
   AND (r.eid_f IS NULL OR c.event_id = r.eid_f) AND (r.estd_f IS NULL OR c.event_std = r.estd_f)
  WHERE r.base IS NOT NULL AND c.year IS NOT NULL"""),
    "universe": (["cands", "catalog_splits"], f"""
  SELECT req_key, hname, {split_km_sql('hname')} AS hkm
  FROM (SELECT DISTINCT k.req_key, lower(s.split) AS hname
        FROM cands k JOIN catalog_splits s ON k.race_id = s.race_id AND k.event_id = s.event_id)"""),
    "wanted_all": (["req_valid"], """
  SELECT req_key, unnest(splits) AS original, CAST(generate_subscripts(splits, 1) - 1 AS INTEGER) AS ord
  FROM req_valid"""),
    "wanted": (["wanted_all", "cands"], f"""
  SELECT req_key, split, ord, original, {split_km_sql('split')} AS target_km
  FROM (SELECT req_key, replace(lower(original), '.', '_') AS split, ord, original,
               row_number() OVER (PARTITION BY req_key, replace(lower(original), '.', '_') ORDER BY ord) AS rn
        FROM wanted_all WHERE req_key IN (SELECT req_key FROM cands))
  WHERE rn = 1"""),
    "equiv": (["wanted", "universe"], """
  SELECT w.req_key, w.split, u.hname, u.hkm, abs(u.hkm - w.target_km) AS diff,
         row_number() OVER (PARTITION BY w.req_key, w.split ORDER BY abs(u.hkm - w.target_km), u.hkm, u.hname) AS rn
  FROM wanted w JOIN universe u ON w.req_key = u.req_key AND abs(u.hkm - w.target_km) < 0.001"""),
    "nearest": (["wanted", "universe"], """
  SELECT * FROM (
    SELECT w.req_key, w.split, u.hname, u.hkm, abs(u.hkm - w.target_km) AS diff,
           row_number() OVER (PARTITION BY w.req_key, w.split ORDER BY abs(u.hkm - w.target_km), u.hkm, u.hname) AS rn
    FROM wanted w JOIN universe u ON w.req_key = u.req_key
    WHERE w.target_km IS NOT NULL AND u.hkm > 0) WHERE rn = 1"""),
    "plan": (["wanted", "universe", "equiv", "nearest"], """
  SELECT w.req_key, w.ord, w.original, w.split,
         CASE WHEN e.hname IS NOT NULL OR b.hname IS NOT NULL THEN 'direct'
              WHEN w.target_km IS NOT NULL AND n.hname IS NOT NULL THEN 'interpolate'
              ELSE 'impossible' END AS kind,
         CASE WHEN e.hname IS NOT NULL THEN e.hname WHEN b.hname IS NOT NULL THEN w.split
              WHEN w.target_km IS NOT NULL THEN n.hname END AS source,
         CASE WHEN e.hname IS NOT NULL THEN e.hkm WHEN b.hname IS NOT NULL THEN w.target_km
              WHEN w.target_km IS NOT NULL THEN n.hkm END AS source_km,
         w.target_km,
         CASE WHEN replace(w.original, '.', '_') = w.split THEN w.original ELSE w.split END AS alias
  FROM wanted w
  LEFT JOIN (SELECT * FROM equiv WHERE rn = 1) e ON w.req_key = e.req_key AND w.split = e.split
  LEFT JOIN universe b ON w.req_key = b.req_key AND w.split = b.hname
  LEFT JOIN nearest n ON w.req_key = n.req_key AND w.split = n.split"""),
    "plan_sources": (["plan", "equiv"], """
  SELECT p.req_key, p.split, p.split AS src, 0 AS prio FROM plan p WHERE p.kind = 'direct'
  UNION ALL
  SELECT p.req_key, p.split, e.hname AS src,
         row_number() OVER (PARTITION BY p.req_key, p.split ORDER BY e.hname) AS prio
  FROM plan p JOIN equiv e ON p.req_key = e.req_key AND p.split = e.split
  WHERE p.kind = 'direct' AND e.hname <> p.split"""),
    "cand_flags": (["cands", "catalog_splits", "plan"], f"""
  SELECT k.*, coalesce(i.has_imp, false) AS has_imp,
         EXISTS (SELECT 1 FROM catalog_splits s WHERE s.race_id = k.race_id AND s.event_id = k.event_id
                 AND {split_km_sql('s.split')} IS NOT NULL) AS has_dist
  FROM cands k LEFT JOIN (SELECT req_key, bool_or(kind = 'impossible') AS has_imp FROM plan GROUP BY req_key) i
    ON k.req_key = i.req_key"""),
    "selection": (["cand_flags"], """
  SELECT * FROM (
    SELECT req_key, nombre, race_id, event_id, event_std, year,
           CAST(row_number() OVER (PARTITION BY req_key ORDER BY year DESC, race_id, event_id) AS INTEGER) AS rank
    FROM cand_flags WHERE NOT has_imp OR has_dist) WHERE rank <= 5"""),
    "train_long": (["selection", "req_prep", "race_wide", "plan", "plan_sources", "wide_long"], """
  SELECT s.req_key, s.nombre, w.finisher_id, w.athlete_id, w.event_id, w.event_std, w.gender, w.age,
         p.ord, p.alias AS split,
         CASE WHEN p.kind = 'direct' THEN
           (SELECT arg_min(v.secs, ps.prio) FROM plan_sources ps JOIN wide_long v
              ON v.col = ps.src AND v.finisher_id = w.finisher_id
            WHERE ps.req_key = p.req_key AND ps.split = p.split AND v.secs IS NOT NULL) END AS secs
  FROM selection s
  JOIN req_prep r ON r.req_key = s.req_key
  JOIN race_wide w ON w.race_id = s.race_id AND w.event_id = s.event_id
   AND (r.eid_f IS NULL OR w.event_id = r.eid_f) AND (r.estd_f IS NULL OR w.event_std = r.estd_f)
  JOIN plan p ON p.req_key = s.req_key AND p.kind <> 'impossible'"""),
}


MATERIALISED = {"race_legs", "itrained", "ikept", "ifeat", "isystems", "ifold_models", "icv"}


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, *deps: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    """``WITH`` + the needed CTEs (dependency order) + ``body``."""
    if extra:
        for k, v in extra.items():
            CTES.setdefault(k, v)
    names = _order(deps)
    if not names:
        return body
    # tables that are read row by row more than once, or that refer to themselves, are worked out once
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n in MATERIALISED else ''}({CTES[n][1]}\n)" for n in names) + "\n" + body
