import pytest
from tokenizers import Tokenizer

from gaugeline.llm import token_counts as op
from gaugeline.llm.common import tokenizer_file
from helpers import ODD_TEXTS, frame, real_texts

HARD = [
    (200, "a<|endoftext|>b <|endoftext|><|endoftext|> <|end"), (201, "a\x1c b\x1f!"), (202, "it's  we'll\n\n  go  　x"),
    (203, "\n \n\t a"), (204, "don’t   ᠎ ﻿ x"),
]


@pytest.mark.parametrize("rows", [ODD_TEXTS + HARD, real_texts(), []], ids=["odd", "real", "empty"])
def test_against_the_library(spark, rows):
    path = tokenizer_file("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = sorted((tuple(r) for r in op.token_counts(frame(spark, rows, wide=True), path, limit=20).collect()), key=repr)
    count = lambda t: len(library.encode(t or "", add_special_tokens=False))
    assert got == sorted(((i, len((t or "").encode()), count(t), count(t) > 20) for i, t in rows), key=repr)


def test_small_caches_change_nothing(monkeypatch):
    path = tokenizer_file("byte_bpe_50k.json")
    monkeypatch.setattr(op, "CACHE_PIECES", 3)
    counter = op._Counter(path, "", b"")
    texts = [t or "" for _, t in ODD_TEXTS]
    library = Tokenizer.from_file(path)
    for _ in range(2):
        assert counter.count(texts) == [len(library.encode(t, add_special_tokens=False)) for t in texts]
