import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from racelens.llm import words
from racelens.llm.bpe import vocabulary

PIECES = list("abSsTtREvemLlDd'' \t\n\r12!?.,-<|>éÉßÿ×÷µªº日本ıİΣς́\x1c\x1d\x85\u3000\xa0\u200b\u2028 🎉٣²½\x0b\x00\x7f") + ["<|endoftext|>", "<|startoftext|>", "'ll", "'RE", " ", " "]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_random_texts_against_the_library(name, monkeypatch):
    monkeypatch.setattr(words, "CACHE", 5_000)  # so that the caches are emptied on the way
    code, library, r = words.WordEncoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name)), random.Random(3)
    texts = ["", "word " * 5_000, "x" * 30_000, *("".join(r.choices(PIECES, k=r.randrange(30))) for _ in range(20_000))]
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(code.encode(t), "<u4").tolist() == e.ids, t[:80]
    assert code.encode(None) == b""


def test_other_kinds_are_refused(tmp_path):
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    library.pre_tokenizer = None
    library.save(str(tmp_path / "t.json"))
    with pytest.raises(ValueError):
        words.WordEncoder(str(tmp_path / "t.json"))
