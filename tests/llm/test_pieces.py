import random

import pytest
import sentencepiece

from gaugeline.llm import pieces as op
from gaugeline.llm.common import tokenizer_file
from helpers import ODD_TEXTS, frame, real_texts

PATH = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return op.load(PATH)


@pytest.mark.parametrize("rows", [ODD_TEXTS, real_texts(), []], ids=["odd", "real", "empty"])
def test_ids_of_the_library_and_round_trip(spark, model, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoded = op.encode(frame(spark, rows, wide=True), model)
    got = sorted(((r["doc_id"], list(r["ids"]), r["n_pieces"], r["round_trip"]) for r in encoded.collect()), key=repr)
    want = [(i, library.encode(t or "")) for i, t in rows]
    assert got == sorted(((i, ids, len(ids), True) for i, ids in want), key=repr)
    back = op.decode(encoded, model).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_random_texts(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(3)
    letters = ["a", "s", "the", "ing", " ", "  ", "\n", "é", "日本", "!", "1", "\x00", "🙂", "aaa", "ения", "(", "▁"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 400 + "ss" * 90, "日本語の" * 60]
    assert [i.tolist() for i in op.Encoder(model).encode(texts)] == library.encode(texts)


def test_unigram_models_by_brute_force():
    rng = random.Random(5)
    names = ["a", "b", "c", "ab", "bc", "abc", "ca", "▁", "▁a", "▁ab", "cab"]
    model = op.Model(dict(enumerate(names)), {i: -rng.random() * len(n) for i, n in enumerate(names)}, [99] * 256, merges=False)

    def best(text):
        if not text:
            return 0.0, []
        ways = [(model.score[i] + best(text[len(n) :])[0], [i] + best(text[len(n) :])[1]) for i, n in enumerate(names) if text.startswith(n)]
        return max(ways, default=(float("-inf"), []))

    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(80)]
    for text, ids in zip(texts, op.Encoder(model).encode(texts), strict=True):
        assert ids.tolist() == best(op.MARK + text)[1]
    long = "".join(rng.choice("abc") for _ in range(300))
    assert op.Encoder(model)._one(long) == op.Encoder(model)._many([long])[0]


def test_space_mark_comes_back_as_space(model):
    ids = op.Encoder(model).encode(["x▁y"])[0]
    assert op.decoded(ids.tolist(), op.piece_bytes(model)) == "x y"
