"""Secret scan with multipart credential linking (operator 13), DataFrame functions only.

Strong kinds are reported wherever they stand: `assign` (a secret's name, a
sign and a value), `access` (access key ids) and `hex` (long hexadecimal
runs). Weak kinds mean nothing alone: `login` (an address), `endpoint` (a
service address) and `weak` (a value behind a vaguer name, or a long mixed
token). A credential has several parts, so a weak candidate is reported only
when a complementary part stands within `reach` code points of it in the same
scope: a secret (assign, hex, weak) beside an identifier or an endpoint
(access, login, endpoint), and the other way round. Scopes are the runs of
lines between blank lines.

The interval join sweeps the parts of a text in order of their starts, blank
lines among them: one pass forwards carries the furthest end of each side, one
backwards the nearest start, and a blank line clears both. No pair is built
and no row leaves its task. Positions are running sums of the code points of
matches and of the text between them, in blocks, so that a text with very many
matches costs little more than their number.

A null or empty text has no spans. Every row of the input gives one row;
repeated rows repeat theirs, and doc_id may be null. All matches are found on
the whole text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.llm.common import read

REACH = 200
BLOCK = 256


def _either(word: str) -> str:
    """A pattern for an ASCII word whose letters stand in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_SIGN = r"""["']?\x20*[:=]\x20*["']?"""
_VAGUE = ["passphrase", "pass", "pwd", "access_?key", "private_?key", "credentials?", "auth"]

#: Kind, pattern, and for kinds whose second group is the value its least length.
ASSIGN = "(" + "|".join(map(_either, ["password", "passwd", "secret", "token", "api_?key"])) + ")" + _SIGN + "([A-Za-z0-9+/_.=-]+)"
KINDS = [
    ("assign", ASSIGN, 8),
    ("access", "AKIA[A-Z0-9]{12,}", None),
    ("hex", "[0-9a-f]{32,}", None),
    ("login", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}", None),
    ("endpoint", r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\x20\x09-\x0D"'<>]+""", None),
    ("weak", "(" + "|".join(map(_either, _VAGUE)) + ")" + _SIGN + r"""([^\x20\x09-\x0D"',;]{4,})""", None),
    ("weak", "[A-Za-z0-9+/]{40,}", None),
]
NAMES = ["assign", "access", "hex", "login", "endpoint", "weak"]
BASE = 3
SCOPE, SCOPE_END = 9, r"\x0A[\x20\x09\x0D]*\x0A"
SECRETS, OTHERS = [0, 2, 5], [1, 3, 4]

_PART = "array<struct<start: bigint, k: int, end: bigint, value: string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _scan(items: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The state after each item. States are appended within blocks, so that no long array is copied for every item."""
    def block(seed: Column, part: Column) -> Column:
        states = F.aggregate(part, F.array(seed), lambda seen, x: F.concat(seen, F.array(step(F.element_at(seen, -1), x))))
        return F.slice(states, F.lit(2), F.size(part))

    def whole(a: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")), lambda i: F.slice(a, i * BLOCK + 1, F.lit(BLOCK)))
        states = F.aggregate(blocks, F.array(F.array(zero)), lambda seen, b: F.concat(seen, F.array(block(F.element_at(F.element_at(seen, -1), -1), b))))
        return F.slice(F.flatten(states), F.lit(2), F.size(a))

    return _let(items, lambda a: F.when(F.size(a) > 0, whole(a)).otherwise(F.slice(F.array(zero), F.lit(1), F.lit(0))))


def _parts(text: Column, k: int, pattern: str, least: int | None) -> Column:
    """Spans of the leftmost non-overlapping matches, in code points, as (start, k, end, value)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    fits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda v: F.length(v) >= least) if least else F.transform(found, lambda v: F.lit(True))
    between = F.slice(F.transform(F.split(text, pattern, -1), lambda v: F.length(v)), F.lit(1), F.size(found))
    items = F.zip_with(
        F.zip_with(between, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))), fits,
        lambda x, ok: F.struct(x["gap"].alias("gap"), x["value"].alias("value"), ok.alias("fits")))
    zero = F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end"), F.lit("").alias("value"), F.lit(False).alias("fits"))

    def step(at: Column, x: Column) -> Column:
        start = at["end"] + x["gap"]
        return F.struct(start.alias("start"), (start + F.length(x["value"])).alias("end"), x["value"].alias("value"), x["fits"].alias("fits"))

    spans = F.filter(_scan(items, zero, step), lambda s: s["fits"])
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), s["value"].alias("value")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_PART)).cast(_PART)


def _linked(parts: Column, reach: int) -> Column:
    """The weak parts that have a complementary part within reach in their scope."""
    none = F.lit(None).cast("bigint")
    zero = F.struct(none.alias("secret"), none.alias("other"))

    def sweep(near: Callable[[Column, Column], Column], edge: str) -> Callable[[Column, Column], Column]:
        def step(at: Column, x: Column) -> Column:
            side = lambda name, kinds: F.when(x["k"] == SCOPE, none).when(x["k"].isin(kinds), near(at[name], x[edge])).otherwise(at[name])
            return F.struct(side("secret", SECRETS).alias("secret"), side("other", OTHERS).alias("other"))
        return step

    def links(a: Column) -> Column:
        before = _scan(a, zero, sweep(F.greatest, "end"))
        after = F.reverse(_scan(F.reverse(a), zero, sweep(F.least, "start")))
        joined = F.zip_with(F.zip_with(a, before, lambda x, b: F.struct(x.alias("x"), b.alias("b"))), after, lambda y, c: F.struct(y["x"].alias("x"), y["b"].alias("b"), c.alias("c")))

        def meets(y: Column) -> Column:
            x, mate = y["x"], F.when(y["x"]["k"].isin(SECRETS), F.lit("other")).otherwise(F.lit("secret"))
            b = F.when(mate == "other", y["b"]["other"]).otherwise(y["b"]["secret"])
            c = F.when(mate == "other", y["c"]["other"]).otherwise(y["c"]["secret"])
            close = F.coalesce(b >= x["start"] - reach, F.lit(False)) | F.coalesce(c <= x["end"] + reach, F.lit(False))
            return (x["k"] >= BASE) & (x["k"] != SCOPE) & close

        return F.transform(F.filter(joined, meets), lambda y: y["x"])

    return _let(parts, links)


def find_secrets(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, base, spans): arrays of (start, k, end, value), k an index of NAMES; base holds the strong kinds alone, spans the linked weak ones too."""
    text = F.col("text")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kinds = [_parts(text, NAMES.index(name), pattern, least) for name, pattern, least in KINDS]
    # a long token counts only when it is mixed and no plain hexadecimal run
    kinds[-1] = F.filter(kinds[-1], lambda s: s["value"].rlike("[0-9]") & ~s["value"].rlike("^([0-9a-f]+|[0-9]+)$"))
    rows = rows.select("doc_id", "text", F.array_sort(F.concat(*kinds[:BASE])).alias("base"), F.concat(*kinds[BASE:]).alias("candidates"))
    both = F.col("candidates")
    ends = F.when(F.size(both) > 0, _parts(text, SCOPE, SCOPE_END, None)).otherwise(F.array().cast(_PART))
    rows = rows.select("doc_id", "base", F.when(F.size(both) > 0, F.array_sort(F.concat("base", both, ends))).otherwise(F.array().cast(_PART)).alias("parts"))
    linked = F.when(F.size("parts") > 0, _linked(F.col("parts"), reach)).otherwise(F.array().cast(_PART))
    return rows.select("doc_id", "base", F.array_sort(F.concat(F.col("base"), linked)).alias("spans"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, NAMES))
    listed = lambda c: F.array_join(F.transform(F.col(c), lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda k: F.size(F.filter("base", lambda s: s["k"] == k)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def _oracle() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    found = []
    for n, (name, pattern, least) in enumerate([*KINDS, ("scope", SCOPE_END, None)]):
        k = NAMES.index(name) if name in NAMES else SCOPE
        value = f"regexp_extract_all(t, {quoted(pattern)}, 2)" if least else "NULL::VARCHAR[]"
        found.append(f"SELECT rid, {n} AS n, {k} AS k, {least or 0} AS least, regexp_split_to_array(t, {quoted(pattern)}) AS gaps, regexp_extract_all(t, {quoted(pattern)}) AS hits, {value} AS vals FROM d WHERE regexp_matches(t, {quoted(pattern)})")
    lists = " UNION ALL ".join(found)
    sides = ["list_contains([" + ", ".join(map(str, s)) + "], {}.k)" for s in (SECRETS, OTHERS)]
    name = "(['" + "', '".join(NAMES) + "'])[k + 1] || ':' || s || ':' || e"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({lists}),
hits AS (SELECT rid, n, k, least, gaps, hits, vals, unnest(range(1, len(hits) + 1)) AS i FROM found),
placed AS (SELECT rid, n, k, hits[i] AS v, len(hits[i]) AS h, least = 0 OR len(vals[i]) >= least AS fits,
  sum(len(gaps[i]) + len(hits[i])) OVER (PARTITION BY rid, n ORDER BY i) AS e FROM hits),
parts AS (SELECT DISTINCT rid, k, CAST(e - h AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed
  WHERE fits AND (n <> {len(KINDS) - 1} OR (regexp_matches(v, '[0-9]') AND NOT regexp_full_match(v, '[0-9a-f]+|[0-9]+')))),
scoped AS (SELECT *, sum(CASE WHEN k = {SCOPE} THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY s, k, e ROWS UNBOUNDED PRECEDING) AS scope FROM parts),
linked AS (SELECT DISTINCT a.rid, a.k, a.s, a.e FROM scoped a JOIN scoped b ON a.rid = b.rid AND a.scope = b.scope AND b.s <= a.e + {REACH} AND b.e >= a.s - {REACH}
  WHERE a.k BETWEEN {BASE} AND {len(NAMES) - 1} AND (({sides[0].format('a')} AND {sides[1].format('b')}) OR ({sides[1].format('a')} AND {sides[0].format('b')}))),
spans AS (SELECT rid, k, s, e FROM parts WHERE k < {BASE} UNION ALL SELECT * FROM linked),
listed AS (SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg({name}, ',' ORDER BY s, k, e) FILTER (k < {BASE}) AS base, string_agg({name}, ',' ORDER BY s, k, e) AS spans FROM spans GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (rid)"""


ORACLE_SQL = _oracle()
