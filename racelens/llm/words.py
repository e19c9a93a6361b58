"""Texts to ids with a file of the `tokenizers` library, each distinct word once.

A text is cut into chunks at bounds that no token crosses: between blanks
where the vocabulary drops white space, in front of the blank that a word takes
along where it keeps it. A chunk of printable ASCII and Latin-1 letters is cut
into its words by the vocabulary's own pattern and each distinct word goes to
the library's model; every other chunk goes through the whole library. Chunks
and words that were seen are kept, up to CACHE of each.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

from racelens.llm.bpe import CHUNK, byte_letters

CACHE = 500_000
BLANKS = re.compile(r"[^ \n\t\r]+")
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Chunks cut here: their composed form is themselves, and lower case changes one letter into one.
EASY = re.compile(f" ?[!-~{LETTERS}]+")
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
KEPT = re.compile(f"{ENDINGS}| ?[{LETTERS}]+| ?[0-9]+| ?[^ 0-9{LETTERS}]+| ")
DROPPED = re.compile(f"{ENDINGS}|[{LETTERS}]+|[0-9]|[^ 0-9{LETTERS}]+")
# --- fixed values: the pattern and the steps of the vocabulary files that drop white space
DROPPED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
DROPPED_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
KEPT_STEP = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
# --- end of fixed values


class WordEncoder:
    """Encodes with a file of byte-level BPE (white space kept) or of BPE with word ends (lower case, white space dropped)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"] or {}
        if steps == KEPT_STEP and spec["normalizer"] is None:
            self.lower, self.chunk, self.word = False, CHUNK, KEPT
        elif steps.get("pretokenizers", [{}])[0].get("pattern") == {"Regex": DROPPED_PATTERN} and spec["normalizer"]["normalizers"] == DROPPED_STEPS:
            self.lower, self.chunk, self.word = True, BLANKS, DROPPED
        else:
            raise ValueError("this kind of vocabulary is not known")
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)))
        self.special_ids = {t["content"]: struct.pack("<I", t["id"]) for t in spec["added_tokens"]}
        self.size = self.library.get_vocab_size()
        letters = {b: c for c, b in byte_letters().items()}
        self.letters = {n: "".join(letters[b] for b in chr(n).encode()) for n in range(256)}
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        """Puts chunks into the cache."""
        words, letters, find, tokens = self.words, self.letters, self.word.findall, self.model.tokenize
        odd = []
        for c in new:
            if not EASY.fullmatch(c):
                odd.append(c)
                continue
            parts = []
            for w in find(c.lower() if self.lower else c):
                ids = words.get(w)
                if ids is None:
                    found = [t.id for t in tokens(w.translate(letters))]
                    ids = words[w] = struct.pack(f"<{len(found)}I", *found)
                parts.append(ids)
            self.chunks[c] = b"".join(parts)
        if odd:
            for c, e in zip(odd, self.library.encode_batch_fast(odd, add_special_tokens=False), strict=True):
                self.chunks[c] = np.array(e.ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        chunks, known = self.chunk.findall(text), self.chunks
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            if len(self.words) > CACHE:
                self.words.clear()
            self._learn(list(set(chunks).difference(known)))
            return b"".join(map(known.__getitem__, chunks))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; a null text is empty.

        Special tokens written out in a text are encoded as such, as the library does it by default.
        """
        text, out, at = text or "", [], 0
        for m in self.special.finditer(text) if self.special_ids else ():
            out += [self._plain(text[at : m.start()]), self.special_ids[m[0]]]
            at = m.end()
        return b"".join([*out, self._plain(text[at:] if at else text)])


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary file, loaded once in a process."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
