import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from gaugeline.llm import simhash as op
from gaugeline.llm.queries import QUERIES
from helpers import ODD_TEXTS, frame, real_texts

FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def slow_fingerprint(text: str, shingle: int = op.SHINGLE) -> bytes:
    """By its definition: every term votes on every bit."""
    word = lambda w: sum((b + 1) * pow(int(op._STEP), i, 1 << 64) for i, b in enumerate(w)) % (1 << 64)
    words = [word(w) for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()]
    size = min(shingle, len(words))
    if not words:
        return bytes(op.BYTES)
    mixed = lambda x: int(op._mixed(np.array([x % (1 << 64)], np.uint64))[0])

    def term(some):
        total = size
        for w in some:
            total = mixed(total * int(op._STEP) + w)
        return total

    votes = [0] * 8 * op.BYTES
    for t, n in Counter(term(words[i : i + size]) for i in range(len(words) - size + 1)).items():
        hashed = b"".join(h.to_bytes(8, "little") for h in (t, mixed(t + int(op._STEP))))
        for bit in range(len(votes)):
            votes[bit] += round(16 + 16 * math.log2(n)) * (1 if hashed[bit // 8] >> (7 - bit % 8) & 1 else -1)
    return int("".join("1" if v > 0 else "0" for v in votes), 2).to_bytes(op.BYTES)


def brute(rows):
    """Rows of ``with_next`` for rows with different ids."""
    rows = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for n, (i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        own, other, following = map(slow_fingerprint, (t, changed, after))
        alike = lambda a, b: 1 - bin(int.from_bytes(a) ^ int.from_bytes(b)).count("1") / 128
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), own, other, alike(own, other), alike(own, following)))
    return sorted(out, key=repr)


def seen(rows):
    return sorted((tuple(bytes(v) if isinstance(v, (bytes, bytearray)) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("rows", [[r for r in ODD_TEXTS if r[1] != "twice"], real_texts(60), [(7, "alone here")], []], ids=["odd", "real", "one", "empty"])
def test_with_next_against_brute_force(spark, rows):
    found = op.with_next(frame(spark, rows, wide=True).repartition(5))
    assert found.columns == FIELDS
    assert seen(found.collect()) == brute(rows)


def test_repeated_rows_are_each_others_next(spark):
    rows = {r["doc_id"]: r for r in op.with_next(frame(spark, [(1, "last one"), (5, "same words"), (5, "same words"), (9, "other text")])).collect()}
    assert rows[5]["n_chars"] == 10 and len(rows) == 3


def test_equal_texts_and_words_decide():
    make = op.Fingerprinter()
    assert make("Some  WORDS in\there") == make("some words in here") != make("some other words in here")
    long = " ".join(f"w{i}" for i in range(300_000))  # more than one piece
    assert len(long) > op._PIECE and len(make.word_hashes(long.encode())) == 300_000
    assert len(set(make.word_hashes(long.encode()).tolist())) == 300_000
    text = real_texts(1)[0][1]
    assert op.likeness(make(text), make(text + " tail")) > 0.95
    assert op.likeness(make(""), make(" \t")) == 1


def flipped(rng, base: int, most: int) -> bytes:
    for bit in rng.sample(range(128), rng.randint(0, most)):
        base ^= 1 << bit
    return base.to_bytes(16)


@pytest.mark.parametrize("radius, most", [(5, 4096), (5, 16), (3, 8), (1, 4096), (0, 4096)])
def test_all_fingerprints_within_the_radius(spark, radius, most):
    rng = random.Random(radius * 100 + most)
    bases = [rng.getrandbits(128) for _ in range(12)]
    prints = [flipped(rng, rng.choice(bases), 9) for _ in range(500)]
    prints += [prints[3]] * 40 + [flipped(rng, bases[0], 3) for _ in range(300)] + [bytes(16)] * 3
    rows = list(enumerate(prints))
    distinct = {p: min(i for i, q in rows if q == p) for p in prints}
    near = {p: sum(1 for q in distinct if 0 < (int.from_bytes(p) ^ int.from_bytes(q)).bit_count() <= radius) for p in distinct}
    frame = spark.createDataFrame([(i, bytearray(p)) for i, p in rows], "doc_id long, fingerprint binary").repartition(6)
    found = op.within_radius(frame, radius, most).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_near"]) for r in found) == [(i, distinct[p], near[p]) for i, p in rows]
    assert radius < 3 or any(near.values())


def test_no_fingerprints(spark):
    assert op.within_radius(spark.createDataFrame([], "doc_id long, fingerprint binary")).collect() == []


def test_query_tells_edited_from_next(spark):
    rows = QUERIES["op13_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    own = [r for r in rows if r["n_chars"] > 400 and r["near_next"] < 1]
    assert sum(r["near_edited"] > r["near_next"] for r in own) > 0.97 * len(own)
    assert all(len(r["fingerprint"]) == 32 for r in rows)
    assert len({r["fingerprint"] for r in rows}) == len({r["class_id"] for r in rows})
