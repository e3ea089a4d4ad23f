import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeline.llm import substring_dedup as op
from gaugeline.llm.suffix_array import suffix_array
from helpers import ODD_TEXTS, frame, real_texts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_suffix_array_is_the_sorted_suffixes(codes):
    codes = [*codes, 0]
    assert suffix_array(codes) == sorted(range(len(codes)), key=lambda i: codes[i:])


@pytest.mark.parametrize("text", [b"a" * 3000, b"ab" * 1500, b"abcab" * 500, bytes(range(200)) * 9])
def test_suffix_array_of_repetitive_texts(text):
    codes = [*(b + 1 for b in text), 0]
    order = suffix_array(codes)
    assert sorted(order) == list(range(len(codes)))
    assert all(text[a:] < text[b:] for a, b in zip(order, order[1:]))


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + 400] for _, b in texts for p in range(len(b) - 399))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - 399):
            if seen[b[p : p + 400]] > 1:
                gone[p : p + 400] = b"\1" * 400
        kept = bytes(c for c, g in zip(b, gone) if not g)
        begins = [k for k, g in enumerate(gone) if g and not (k and gone[k - 1])]
        ends = [k + 1 for k, g in enumerate(gone) if g and not (k + 1 < len(gone) and gone[k + 1])]
        spans = ",".join(f"{a}:{z}" for a, z in zip(begins, ends, strict=True))
        out.append((i, len(b), sum(gone), len(begins), hashlib.sha256(kept).hexdigest(), spans))
    return sorted(out, key=repr)


def passages():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    common = [text(450), text(400), text(399), text(700)]
    rows = [(i, text(rng.randint(0, 300)) + rng.choice(common) + text(rng.randint(0, 300))) for i in range(60)]
    rows += [(100 + i, text(90) + common[3][i * 20 : i * 20 + 420] + text(90)) for i in range(12)]
    return rows + [(200, "ab" * 400), (201, "x" * 420), (202, common[0] + common[0]), (203, text(100) + common[0])]


@pytest.mark.parametrize("most", [64, 2], ids=["gathered", "hot"])
@pytest.mark.parametrize("rows", [passages(), real_texts(80)], ids=["passages", "real"])
def test_against_brute_force(spark, monkeypatch, rows, most):
    monkeypatch.setattr(op, "MOST", most)
    got = sorted((tuple(r) for r in op.remove_repeats(frame(spark, rows, wide=True)).drop("kept").collect()), key=repr)
    assert got == brute(rows)


def test_odd_rows(spark):
    rows = [(i, t if t is None or len(t) < 6000 else t[:2500]) for i, t in ODD_TEXTS]
    got = sorted((tuple(r) for r in op.remove_repeats(frame(spark, rows, wide=True)).drop("kept").collect()), key=repr)
    assert got == brute(rows)
    assert op.remove_repeats(frame(spark, [])).count() == 0


def test_parts_of_long_texts(monkeypatch):
    rng = random.Random(2)
    data = bytes(rng.choice(b"abc") for _ in range(5000))
    whole = op.runs(data, 128)
    monkeypatch.setattr(op, "_PART", 700)
    starts, lengths, _ = op.runs(data, 128)
    assert lengths.sum() == whole[1].sum() == len(data) - 399
    assert set(whole[0].tolist()) <= set(starts.tolist())
