"""Byte-pair encoding by a deterministic token automaton (operator 5).

The automaton reads tokens. It starts as one state that every single-byte arc
leaves and enters, which accepts any split into bytes. Each merge (u, v) -> w,
in order of rank, is one gadget: the state behind the u arcs is copied for
them alone and loses its v arc, and a w arc runs from wherever a u arc and
then a v arc ran to where the v arc led. In the end the automaton accepts of
every byte string exactly one path, and the labels on it are its tokens.

Arcs with one label always lead to one state, so the table holds the state
behind each label and, for each state, the labels cut from it. A label that is
cut takes along what later merges begin with it; with the labels numbered
along their left parts (later merges first) each cut is one interval.

A pre-split word is encoded by transitions from left to right, looked up in
the table; as its path is the only one, a step back ends where a prefix has no
continuation. Decoding emits the labels of the arcs.

A vocabulary is a file in the `tokenizers` JSON format for byte-level BPE; its
path is a parameter. Special tokens written out in a text are encoded as such,
as the library does it by default.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from racelens.llm.common import read

CACHE = 500_000

# --- fixed values: the pre-split pattern of byte-level BPE vocabularies
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --- end of fixed values
#: White space of that pattern (Python's own class has four control characters more).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space with at most one blank before the next word; no piece of WORD crosses these bounds.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself where printable, else 256 and up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in shown}
    hidden = (b for b in range(256) if b not in set(shown))
    letters.update({chr(256 + n): b for n, b in enumerate(hidden)})
    return letters


class TokenAutomaton:
    """`labels` are the byte strings of the arcs by token id."""

    def __init__(self, labels: dict[bytes, int], merges: Iterable[tuple[bytes, bytes]]):
        self.ids = labels
        rules, heads = [], {}
        for rank, (u, v) in enumerate(merges):
            rules.append((u, v))
            if u + v in heads:
                raise ValueError(f"two merges make {u + v!r}")
            heads[u + v] = rank
        self._number(rules)
        self._compile(rules)

    def _number(self, rules: list[tuple[bytes, bytes]]) -> None:
        """Place of every label in a walk along left parts, later merges first; end of its subtree."""
        after: dict[bytes, list[tuple[int, bytes]]] = {}
        made = {u + v for u, v in rules}
        for rank, (u, v) in enumerate(rules):
            after.setdefault(u, []).append((rank, u + v))
        self.place, self.end, self.after = {}, {}, after
        stack = [(t, False) for t in sorted(set(self.ids) - made, reverse=True)]
        n = 0
        while stack:
            t, done = stack.pop()
            if done:
                self.end[t] = n
                continue
            self.place[t] = n
            n += 1
            stack.append((t, True))
            stack += [(w, False) for _, w in sorted(after.get(t, []))]

    def _interval(self, v: bytes, rank: int) -> tuple[int, int]:
        """v and every label that starts with v by a merge from `rank` on."""
        first = self.after.get(v, [])
        later = [w for r, w in first if r >= rank]
        return self.place[v], self.end[later[0]] if later else self.place[v] + 1

    def _compile(self, rules: list[tuple[bytes, bytes]]) -> None:
        cuts: list[list[tuple[int, int]]] = [[]]
        users = [1]  # the start itself uses state 0
        behind: dict[bytes, int] = {}
        for t in self.place:
            if len(t) == 1:
                behind[t] = 0
                users[0] += 1
        for rank, (u, v) in enumerate(rules):
            old = behind.get(u)
            if old is None or v not in behind or any(a <= self.place[v] < b for a, b in cuts[old]):
                continue  # no path takes u and then v at this point: w never arises
            target = old if u == v else behind[v]
            if users[old] > 1:
                users[old] -= 1
                cuts.append(list(cuts[old]))
                users.append(1)
                behind[u] = len(cuts) - 1
                if u == v:
                    users[old] += 1
            elif u == v:
                cuts.append(list(cuts[old]))
                users.append(1)
                behind[u] = len(cuts) - 1
            if u != v:
                users[target] += 1
            behind[u + v] = target
            # after a single u, neither u nor uu may follow: runs pair from the left
            cuts[behind[u]].append(self._interval(v, rank if u == v else rank + 1))
        self.start, self.behind = 0, {}
        self.arcs = {t: (self.ids[t], s, self.place[t]) for t, s in behind.items()}
        self.cuts = []
        for c in cuts:
            joined: list[list[int]] = []
            for a, b in sorted(c):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(b, joined[-1][1])
                else:
                    joined.append([a, b])
            self.cuts.append(([a for a, _ in joined], [b for _, b in joined]))
        self._tree()

    def _tree(self) -> None:
        """The labels as a tree by bytes, to list the arcs that fit at a place."""
        self.tree: dict = {}
        for label, arc in self.arcs.items():
            node = self.tree
            for byte in label:
                node = node.setdefault(byte, {})
            node[-1] = arc

    def encode(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word: the labels on its path, by table look-ups only.

        Takes the longest arc that is open first and steps back from a dead
        end. A place is reached by one path at most, so none is tried twice.
        """
        n, cuts, tree = len(word), self.cuts, self.tree
        if not n:
            return []
        dead: set[int] = set()
        trail: list[tuple[int, int, int, list]] = []  # place, state, token, arcs left to try
        at, state, fits = 0, self.start, None
        while True:
            if fits is None:
                fits, node, i = [], tree, at
                while i < n:
                    node = node.get(word[i])
                    if node is None:
                        break
                    i += 1
                    arc = node.get(-1)
                    if arc is not None:
                        fits.append((i, arc))
            starts, ends = cuts[state]
            while fits:
                i, (token, behind, place) = fits.pop()
                cut = bisect_right(starts, place)
                if (not cut or place >= ends[cut - 1]) and i not in dead:
                    break
            else:
                if not trail:
                    raise ValueError(f"no path for {word[:20]!r}")
                dead.add(at)
                at, state, _, fits = trail.pop()
                continue
            trail.append((at, state, token, fits))
            if i == n:
                return [t[2] for t in trail]
            at, state, fits = i, behind, None


class Encoder:
    """Whole texts to ids and back. Words that were seen are kept, up to CACHE of them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        raw = lambda t: bytes(letter[c] for c in t)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        labels = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.automaton = TokenAutomaton(labels, ((raw(u), raw(v)) for u, v in pairs))
        self.labels = {i: t for t, i in labels.items()} | {i: t.encode() for t, i in self.special.items()}
        self.word = regex.compile(WORD)
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        out, known = [], self.words
        for w in self.word.findall(chunk):
            ids = known.get(w)
            if ids is None:
                found = self.automaton.encode(w.encode())
                ids = known[w] = struct.pack(f"<{len(found)}I", *found)
            out.append(ids)
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        chunks, known = CHUNK.findall(text), self.chunks
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            if len(self.words) > CACHE:
                self.words.clear()
            for c in chunks:
                if c not in known:
                    known[c] = self._chunk(c)
            return b"".join(map(known.__getitem__, chunks))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; a null text is empty."""
        text, out, at = text or "", [], 0
        for m in self.specials.finditer(text) if self.specials else ():
            out += [self._plain(text[at : m.start()]), np.uint32(self.special[m[0]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:] if at else text)])

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, compiled once in a process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                ids = np.frombuffer(code.encode(text), "<u4").tolist()
                rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(code.decode(ids).encode()).hexdigest()))
            n, a, d = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for b in batches:
            ids = [np.frombuffer(code.encode(t), "<u4").astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def _texts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([code.decode(i or ()) for i in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return run


def encode(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row; a null text has no ids."""
    return documents.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(_ids(path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(_texts(path), "doc_id long, text string")


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").selectExpr("cast(doc_id as long) doc_id", "text")
    return docs.mapInArrow(_digests(vocabulary("byte_bpe_50k.json")), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
