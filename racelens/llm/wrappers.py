"""Main text of web pages by wrappers inferred per host (operator 2).

A page becomes a stream of block tags and texts. Adjacent equal groups of the
stream fold into repeated groups. The wrapper of a host is a regular
expression without unions over such streams: starting from one page, each
further page is aligned with it, and every mismatch is resolved into an
optional group, a repeated group (where one side repeats what the other has
once), or a text slot (where texts differ; a text that is equal on all pages
stays part of the template). Alignment goes on page by page and then wrapper
by wrapper: every task folds the pages of its partition, the partial wrappers
of a host are merged in groups and then once more, so no task sees all pages
of a host.

The slots of a wrapper get a role from their place in it. Content are the
texts inside article or main, or where the page has neither, all texts; not
those in navigation, headers, footers, sidebars, notices, adverts, forms or
comments, by tag or by the words of class, id and role; nor, on pages without
article and main, texts that never change over at least MIN_PAGES different
pages that have them, unless nothing else would be left. Marks on html, body,
main and on what is around article and main say something about the page, not
about its text, and count for nothing. Extraction aligns each page with the
wrapper of its host and joins its content.

White space inside a block, a line break tag included, becomes one blank. A
null or empty page has an empty text. A null url is a host of its own.
"""

from __future__ import annotations

import difflib
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.llm.common import read, shared

MIN_PAGES = 5
LONGEST_UNIT = 8
FAN_IN = 64

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|object)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*(?:>|\Z)|</?[a-z][^>]*(?:>|\Z)", re.I | re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# --- fixed values: names of HTML elements by their behaviour
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
ASIDE = frozenset("head nav header footer aside form button select menu dialog title".split())
MAIN = frozenset("article main".split())
WHOLE = frozenset("html body main".split())
# --- end of fixed values

#: Words of class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion nav navigation navbar menu breadcrumb breadcrumbs sidebar sidenav aside "
    "footer header masthead complementary contentinfo notice notices alert cookie cookies consent gdpr popup modal newsletter subscribe signup login search share sharing social "
    "comment comments disqus reply replies respond related recommended pagination pager widget".split()
)


def _marked(attributes: str) -> bool:
    for m in ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            if name in MARKS or any(w in MARKS and w not in ("header", "footer", "reply") for w in re.split(r"[-_]+", name)):
                return True
    return False


def stream(page: str) -> list[tuple[str, str | None]]:
    """(tag, None) of block tags and ('#', text) of texts that are not blank, in page order.

    Texts are raw: character references are not decoded yet. Tags carry the
    class, id and role that mark them as not part of the article as a '!'.
    """
    out: list[tuple[str, str | None]] = []
    text: list[str] = []
    at = 0

    def flush():
        if text:
            if (joined := "".join(text)).strip():
                out.append(("#", joined))
            text.clear()

    for m in TOKEN.finditer(page):
        text.append(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in INLINE:
            continue
        if name == "br":
            text.append(" ")
            continue
        flush()
        if m[2]:
            if name not in SELF_CLOSING and name not in VOID:
                out.append((f"/{name}", None))
        elif name not in VOID:
            out.append((name + "!" * (m[4] != "" and name not in WHOLE and _marked(m[4])), None))
    text.append(page[at:])
    flush()
    # a self-closing tag without a text behind it holds nothing
    return [t for n, t in enumerate(out) if t[0] not in SELF_CLOSING or (n + 1 < len(out) and out[n + 1][0] == "#")]


# A node is [signature, group, text, inner, pages]: group numbers optional groups (0: always there);
# text is None (no text), a hash (equal so far; of a group: of its whole run) or "*" (a slot);
# inner are the nodes of a repeated group; pages are hashes of different pages that have the node, MIN_PAGES at most.
Node = list


def fold(tokens: list[tuple[str, str | None]]) -> list[Node]:
    """Nodes of a stream, adjacent equal groups folded, shorter groups first."""
    nodes: list[Node] = [[t, 0, None if x is None else xxhash.xxh3_64_hexdigest(" ".join(x.split()).encode("utf-8", "surrogatepass")), None] for t, x in tokens]
    page = [xxhash.xxh3_64_hexdigest("|".join(f"{x[0]} {x[2] or ''}" for x in nodes))]
    for x in nodes:
        x.append(page)
    for size in range(1, LONGEST_UNIT + 1):
        out: list[Node] = []
        n = 0
        sigs = [x[0] for x in nodes]
        while n < len(nodes):
            unit = sigs[n : n + size]
            times = 1
            while len(unit) == size and sigs[n + times * size : n + (times + 1) * size] == unit:
                times += 1
            if times > 1 and unit[0] != "#" and not unit[0].startswith("/"):
                inner = nodes[n : n + size]
                for k in range(1, times):
                    inner = [_both(a, b) for a, b in zip(inner, nodes[n + k * size : n + (k + 1) * size], strict=True)]
                out.append([f"({' '.join(unit)})+", 0, _run_hash(nodes[n : n + times * size]), inner, page])
                n += times * size
            else:
                out.append(nodes[n])
                n += 1
        nodes = out
    return nodes


def _run_hash(nodes: list[Node]) -> str:
    """One hash for the texts of a repeated run: equal only where the whole run is."""
    return xxhash.xxh3_64_hexdigest("|".join(x[2] or "" for x in nodes))


def _both(a: Node, b: Node) -> Node:
    text = a[2] if a[2] == b[2] else "*"
    inner = [_both(x, y) for x, y in zip(a[3], b[3], strict=True)] if a[3] else None
    return [a[0], a[1] or b[1], text, inner, _pages(a[4], b[4])]


def _pages(a: list[str], b: list[str]) -> list[str]:
    return a if len(a) >= MIN_PAGES or a is b else [*a, *(x for x in b if x not in a)][:MIN_PAGES]


def _repeat_single(nodes: list[Node], other: list[Node]) -> list[Node]:
    """Where `other` repeats a group that `nodes` hold once, that one becomes a repeated group too."""
    for unit in sorted({x[0] for x in other if x[3]} - {x[0] for x in nodes}, key=len):
        inner = next(x[3] for x in other if x[0] == unit)
        sigs, size, out, n = [i[0] for i in inner], len(inner), [], 0
        while n < len(nodes):
            if [x[0] for x in nodes[n : n + size]] == sigs:
                out.append([unit, max(x[1] for x in nodes[n : n + size]), _run_hash(nodes[n : n + size]), nodes[n : n + size], nodes[n][4]])
                n += size
            else:
                out.append(nodes[n])
                n += 1
        nodes = out
    return nodes


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """The least general wrapper found for two: mismatches become optional groups and text slots."""
    a, b = _repeat_single(a, b), _repeat_single(b, a)
    group = max((x[1] for x in a + b), default=0)
    out: list[Node] = []
    for kind, i, j, k, m in difflib.SequenceMatcher(None, [x[0] for x in a], [x[0] for x in b], autojunk=False).get_opcodes():
        if kind == "equal":
            out += [_both(x, y) for x, y in zip(a[i:j], b[k:m], strict=True)]
            continue
        for side in (a[i:j], b[k:m]):
            if side:
                group += 1
                out += [[x[0], x[1] or group, *x[2:]] for x in side]
    return out


def expression(nodes: list[Node]) -> str:
    """The wrapper as a regular expression without unions; '#text' is a slot, a quoted hash a fixed text."""
    parts, open_group = [], 0
    for sig, group, text, inner, _ in nodes:
        if group != open_group:
            parts += [")?"] * bool(open_group) + ["("] * bool(group)
            open_group = group
        parts.append(f"({expression(inner)})+" if inner else "#text" if text == "*" else f"'{text}'" if text else f"<{sig}>")
    return " ".join(parts + [")?"] * bool(open_group))


class Roles:
    """For every text of a page, whether it is content by the wrapper."""

    def __init__(self, nodes: list[Node]):
        self.nodes = nodes
        self.known: dict[tuple, tuple[list[bool], list[bool]]] = {}

    def content(self, tokens: list[tuple[str, str | None]]) -> tuple[list[bool], list[bool]]:
        """Per text of a page, whether its slot of the wrapper is content, and whether it is where the page has no other."""
        key = tuple(t for t, _ in tokens)
        if key not in self.known:
            if len(self.known) > 2000:
                self.known.clear()
            self.known[key] = self._place(tokens)
        return self.known[key]

    def _place(self, tokens: list[tuple[str, str | None]]) -> tuple[list[bool], list[bool]]:
        fixed = self._fixed(tokens)
        stack: list[str] = []
        found: list[tuple[bool, bool, bool]] = []  # inside, off, fixed
        bounded = False

        def off() -> bool:
            inner = next((n for n, t in enumerate(stack) if t.rstrip("!") in MAIN), 0)
            return any(t.endswith("!") for t in stack[inner:]) or any(t in ASIDE for t in stack)

        for (tag, text), same in zip(tokens, fixed, strict=True):
            name = tag.rstrip("!")
            if text is not None:
                found.append((any(t.rstrip("!") in MAIN for t in stack), off(), same))
            elif tag.startswith("/"):
                plain = [t.rstrip("!") for t in stack]
                if tag[1:] in plain:
                    del stack[len(plain) - 1 - plain[::-1].index(tag[1:]) :]
            elif name in SELF_CLOSING:
                while stack and stack[-1].rstrip("!") in SELF_CLOSING:
                    stack.pop()
                if tag.endswith("!"):
                    stack.append(tag)
            else:
                if stack and stack[-1].rstrip("!") in SELF_CLOSING:
                    stack.pop()
                stack.append(tag)
                bounded = bounded or (name in MAIN and not off())
        if bounded:
            kept = [inside and not gone for inside, gone, _ in found]
            return kept, kept
        return [not gone and not same for _, gone, same in found], [not gone for _, gone, _ in found]

    def _fixed(self, tokens: list[tuple[str, str | None]]) -> list[bool]:
        """Per token, whether the wrapper says that its text is the same on all of at least MIN_PAGES pages."""
        mine, theirs = _repeat_single(fold(tokens), self.nodes), self.nodes
        same: list[bool] = []
        match = dict((i + n, j + n) for i, j, size in difflib.SequenceMatcher(None, [x[0] for x in mine], [x[0] for x in theirs], autojunk=False).get_matching_blocks() for n in range(size))
        at = 0
        for n, node in enumerate(mine):
            leaves = list(_leaves(node))
            there = theirs[match[n]] if n in match else None
            fixed = there is not None and there[2] not in (None, "*") and len(there[4]) >= MIN_PAGES
            sigs = [x[0] for x in leaves]
            while [t for t, _ in tokens[at : at + len(sigs)]] == sigs:
                same += [fixed] * len(sigs)
                at += len(sigs)
                if not node[3]:
                    break
        return (same + [False] * len(tokens))[: len(tokens)]


def _leaves(node: Node) -> Iterator[Node]:
    if node[3]:
        for x in node[3]:
            yield from _leaves(x)
    else:
        yield node


def clean(text: str) -> str:
    return " ".join((html.unescape(text) if "&" in text else text).split())


def host_of(url: Column) -> Column:
    """Host of an address, lower case; the empty string without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of the hosts of one partition, with the number of pages behind each."""
    held: dict[str, tuple[list[Node], int]] = {}
    shapes: dict[tuple[str, str], list[Node]] = {}
    part = TaskContext.get().partitionId()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([part] * len(held), pa.int32()), pa.array([json.dumps(w) for w, _ in held.values()], pa.string()), pa.array([n for _, n in held.values()], pa.int64())], names=["host", "part", "wrapper", "pages"])

    for b in batches:
        for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            nodes = fold(stream(page or ""))
            known, n = held.get(host, (None, 0))
            if known is not None and [x[0] for x in known] == [x[0] for x in nodes]:
                known = [_both(x, y) for x, y in zip(known, nodes, strict=True)]
            else:
                known = nodes if known is None else align(known, nodes)
            held[host] = (known, n + 1)
        if len(held) > 20_000:  # many hosts: hand over what there is, it is merged below
            yield out()
            held.clear()
    shapes.clear()
    if held:
        yield out()


def _merge(key, rows):
    """One wrapper from the partial ones of a host."""
    import pandas as pd

    rows = rows.sort_values(["part", "wrapper"])
    nodes = None
    for w in dict.fromkeys(rows["wrapper"]):
        nodes = json.loads(w) if nodes is None else align(nodes, json.loads(w))
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "part": [0], "wrapper": [json.dumps(nodes)], "pages": [int(rows["pages"].sum())]})


def infer_wrappers(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per host: host, wrapper (JSON nodes), pages; `expression` prints a wrapper."""
    schema = "host string, part int, wrapper string, pages long"
    partial = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string")).mapInArrow(_partial, schema)
    partial = shared(spark, partial, "wrappers-partial")
    some = partial.withColumn("salt", F.pmod("part", F.lit(FAN_IN))).groupBy("host", "salt").applyInPandas(lambda k, r: _merge(k, r.drop(columns="salt")), schema)
    return shared(spark, some.groupBy("host").applyInPandas(_merge, schema).drop("part"), "wrappers")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roles: dict[str, Roles] = {}
    for b in batches:
        texts = []
        for page, wrapper in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            if wrapper not in roles:
                if len(roles) > 1000:
                    roles.clear()
                roles[wrapper] = Roles(json.loads(wrapper))
            tokens = stream(page or "")
            own = [x for _, x in tokens if x is not None]
            for keep in roles[wrapper].content(tokens):
                found = [c for t, k in zip(own, keep, strict=True) if k and (c := clean(t))]
                if found:
                    break
            texts.append("\n\n".join(found))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def main_text(spark: SparkSession, pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    rows = rows.join(wrappers, "host").select("page_id", "url", "html", "wrapper")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return main_text(spark, pages, infer_wrappers(spark, pages))
