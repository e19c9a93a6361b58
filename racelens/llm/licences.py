"""Licence scan by an exact set-similarity join (operator 1).

Text blocks are the lines of a document, as sets of words; templates are the
word sets of licence notices. A block meets a template if it holds at least
the share `threshold` of its words. Tokens are ordered by their frequency in
the whole corpus, rare first. A block can only meet a template if it holds one
of the template's first |T| - need + 1 tokens (prefix filter), has at least
`need` words (length filter) and has, from the first common token on, enough
tokens left on both sides (positional filter). What passes is counted in full,
so the result is exact. The templates are a short list that goes with the
tasks; the counts that reach the driver are one row per template word.

Beside this, phrases are found wherever their words stand consecutively, over
line ends too. Words are runs of digits, letters a-z after lower-casing A-Z,
and all characters outside ASCII. A null or empty text has no words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.llm.common import read

THRESHOLD = 0.8

# --- fixed values: phrases of the base scan and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# --- end of fixed values

#: Notices and the labels they give; one label may have several.
TEMPLATES = [
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this work has been dedicated to the public domain", "public-domain"),
    ("all rights reserved", "all-rights-reserved"),
]

_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class TemplateJoin:
    """Templates with their tokens in global order, and an index of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], threshold: float):
        self.order = {t: n for n, t in enumerate(sorted({w for t, _ in templates for w in words(t)}, key=lambda w: (frequency.get(w, 0), w)))}
        self.sets, self.prefixes = [], {}
        for n, (text, label) in enumerate(templates):
            tokens = sorted(set(words(text)), key=self.order.__getitem__)
            need = -(-int(round(threshold * len(tokens) * 1000)) // 1000)
            self.sets.append((label, {t: i for i, t in enumerate(tokens)}, max(1, need)))
            for i, t in enumerate(tokens[: len(tokens) - need + 1]):
                self.prefixes.setdefault(t, []).append((n, i))

    def matches(self, line: list[bytes]) -> list[tuple[str, float]]:
        """(label, containment) of every template that a line's words meet."""
        distinct = set(line)
        known = sorted((w for w in distinct if w in self.order), key=self.order.__getitem__)
        seen, out = set(), []
        for j, w in enumerate(known):
            for n, i in self.prefixes.get(w, ()):
                if n in seen:
                    continue
                label, tokens, need = self.sets[n]
                seen.add(n)
                if len(distinct) < need or 1 + min(len(tokens) - i, len(known) - j) - 1 < need:
                    continue
                both = sum(t in tokens for t in known)
                if both >= need:
                    out.append((label, both / len(tokens)))
        return out


def token_frequency(documents: DataFrame, templates: list[tuple[str, str]]) -> dict[bytes, int]:
    """How often each template word stands in the whole table."""
    vocabulary = {w for t, _ in templates for w in words(t)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                counts.update(w for w in words(text or "") if w in vocabulary)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    counts = documents.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long")
    return {bytes(r.word): r.n for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _places(found: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[int, str]]:
    joined = b" %b " % b" ".join(found)
    out = []
    for phrase, label in phrases:
        if b" %b " % b" ".join(phrase) in joined:
            out += [(i, label) for i in range(len(found) - len(phrase) + 1) if found[i] == phrase[0] and found[i : i + len(phrase)] == phrase]
    return out


def license_scan(spark: SparkSession, documents: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, the places of phrases, and `blocks`, the lines that meet a template.

    Columns: doc_id, n_words, places array<struct<word, label>>, blocks
    array<struct<line, label, containment>>.
    """
    templates = TEMPLATES if templates is None else templates
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    join = TemplateJoin(templates, token_frequency(texts, templates), threshold)
    wanted = [(words(p), label) for p, label in (PHRASES if phrases is None else phrases).items()]
    place = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    block = pa.list_(pa.struct([("line", pa.int32()), ("label", pa.string()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, places, blocks = [], [], []
            for text in b.column(1).to_pylist():
                found = words(text or "")
                n.append(len(found))
                places.append([{"word": i, "label": x} for i, x in _places(found, wanted)])
                met = []
                if not join.prefixes.keys().isdisjoint(found):
                    for k, line in enumerate(text.split("\n")):
                        met += [{"line": k, "label": x, "containment": c} for x, c in join.matches(words(line))]
                blocks.append(met)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(places, place), pa.array(blocks, block)], names=["doc_id", "n_words", "places", "blocks"])

    return texts.mapInArrow(run, "doc_id long, n_words long, places array<struct<word: long, label: string>>, blocks array<struct<line: int, label: string, containment: double>>")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(spark, read(spark, sf_dir, "documents"))
    joined = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(c)))
    best = F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0)))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        joined(F.col("places.label")).alias("base_labels"), joined(F.concat("places.label", "blocks.label")).alias("labels"), best.alias("score"),
    )


def _oracle() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    at = []
    for phrase, label in PHRASES.items():
        test = " AND ".join(f"w[i + {n}] = '{x}'" for n, x in enumerate(phrase.split(), 1))
        at.append(f"list_transform(list_filter(range(len(w)), lambda i: {test}), lambda i: {{'word': i, 'label': '{label}'}})")
    sets = ", ".join(f"({n}, '{label}', {sorted(set(t.split()))!r})" for n, (t, label) in enumerate(TEMPLATES))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, {split.format(lower.format('t'))} AS w FROM d),
p AS (SELECT doc_id, len(w) AS n_words, {' || '.join(at)} AS p FROM w),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
sets AS (SELECT doc_id, list_distinct({split.format(lower.format('line'))}) AS s FROM lines),
templates(n, label, t) AS (VALUES {sets}),
met AS (SELECT doc_id, label, len(list_intersect(s, t)) / len(t) AS c FROM sets, templates WHERE len(list_intersect(s, t)) >= {THRESHOLD} * len(t)),
best AS (SELECT doc_id, list(DISTINCT label) AS ls, max(c) AS c FROM met GROUP BY doc_id),
names AS (SELECT p.doc_id, p.n_words, p.p, list_transform(p.p, lambda x: x.label) AS base, coalesce(best.ls, []) AS ls, coalesce(best.c, 0) AS c FROM p LEFT JOIN best USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_base,
  CAST(list_min(list_transform(p, lambda x: x.word)) AS BIGINT) AS first_word, CAST(list_max(list_transform(p, lambda x: x.word)) AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || ls)), ',') AS labels,
  CAST(CASE WHEN len(p) > 0 THEN 1.0 ELSE c END AS DOUBLE) AS score
FROM names"""


ORACLE_SQL = _oracle()
