import hashlib
import random
import zlib

import numpy as np
import pytest

from gaugeline.llm import periodic_runs as op
from gaugeline.llm.common import crc
from helpers import ODD_TEXTS, frame, real_texts


def slow_runs(words, least=12):
    """(start, length, period), by trying all periods."""
    found = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def quick(words, least=12):
    found = op.find_runs(np.array([*words, -len(words) - 1], np.int64), least)
    return [(s, e - s, q) for s, e, q in found.tolist()]


@pytest.mark.parametrize("least", [2, 5, 12, 31])
def test_runs_against_all_periods(least):
    rng = random.Random(least)
    for _ in range(700):
        size, letters = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 4])
        words = [rng.randrange(letters) for _ in range(size)]
        if rng.random() < 0.5 and size > 6:
            at = rng.randrange(size)
            p = rng.randint(1, max(1, (size - at) // 2))
            words = [words[i] if i < at else words[at + (i - at) % p] for i in range(size)]
        elif rng.random() < 0.3:  # many runs inside one another
            a, b = [0], [0, 1]
            while len(b) < size:
                a, b = b, b + a
            words = b[:size]
        assert quick(words, least) == slow_runs(words, least)


def test_work_stays_in_proportion_where_one_word_is_repeated():
    for words, run in (([0] * 300_000, (0, 300_000, 1)), (list(range(70)) * 3000, (0, 210_000, 70))):
        assert quick(words) == [run]
        names = op.factor_names(np.array([*words, -len(words) - 1], np.int64))
        assert all(len(op._proposed(level, 1 << k, 1 << k)[0]) <= 8 * len(words) for k, level in enumerate(names))


ROWS = [*ODD_TEXTS, (20, "a b c " * 40 + "tail end"), (21, "x y " * 9 + "z " + "x y " * 9), (22, "a\x1cb " * 20), (23, "é ü " * 30)]


@pytest.mark.parametrize("rows", [ROWS, real_texts(60), []], ids=["odd", "real", "empty"])
def test_operator_against_brute_force(spark, rows):
    docs = frame(spark, [(i, t) for i, t in rows if len(t or "") < 20_000], wide=True)
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"].encode()) for r in op.periodic_runs(docs).collect()), key=repr)
    want = []
    for i, t in rows:
        if len(t or "") < 20_000:
            words = (t or "").encode().split()
            want.append((i, len(words), slow_runs(words), collapsed(words, slow_runs(words))))
    assert got == sorted(want, key=repr)


def test_long_texts(spark):
    rows = {r["doc_id"]: r for r in op.periodic_runs(frame(spark, ODD_TEXTS)).collect()}
    assert [tuple(r) for r in rows[11]["runs"]] == [(0, 6000, 1)] and rows[11]["collapsed"] == "word"
    assert rows[10]["n_words"] == 1 and not rows[10]["runs"]


def test_query_columns(spark):
    """The planted periods and the report, for ids of all kinds of codes."""
    rows = [(i, t) for n, (_, t) in enumerate(real_texts(120)) for i in [n * 7 + 1]] + [(2000 + n, t) for n, t in enumerate(["", None, "one", "a b"] * 12)]
    edited = op.with_period(frame(spark, rows), crc())
    got = {r["doc_id"]: r for r in op.report(op.periodic_runs(edited)).collect()}
    planted = 0
    for i, t in rows:
        words = (t or "").encode().split()
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            planted += 1
        runs = slow_runs(words) if n < 3000 else [tuple(x) for x in quick([hash(w) % (1 << 20) for w in words])]
        row = got[i]
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs)).hexdigest()
    assert planted > 8
