import random
import re

import numpy as np
import pytest

from gaugeline.llm import near_dedup as op
from gaugeline.llm.components import components
from helpers import ODD_TEXTS, frame, real_texts


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            same_id = sets[a][0] is not None and sets[a][0] == sets[b][0] and x and y
            if same_id or (x and y and 100 * len(x & y) >= percent * len(x | y)):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min((v for v in (least.get(root(k)), i) if v is not None), default=None)
    return sorted(((i, len(s), least[root(k)], i == least[root(k)]) for k, (i, s) in enumerate(sets)), key=repr)


def families():
    """Originals, variants of them at many distances, chains, and a hub whose variants
    are near it but not near each other."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, number = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 160))]
        for _ in range(6):
            rows.append((number := number + 1, " ".join(base)))
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = word()
    hub = [word() for _ in range(200)]
    for _ in range(25):
        variant = list(hub)
        for _ in range(4):
            variant[rng.randrange(200)] = word()
        rows.append((number := number + 1, " ".join(variant)))
    rows.append((number + 1, " ".join(hub)))
    return rows + [(number + 2, " ".join(hub).upper()), (number + 3, "\n".join(hub))]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_families_against_brute_force(spark, size, percent):
    rows = families()
    got = sorted((tuple(r) for r in op.near_dedup(frame(spark, rows, wide=True), size, percent).collect()), key=repr)
    assert got == brute(rows, size, percent)


@pytest.mark.parametrize("rows", [ODD_TEXTS, real_texts(100)], ids=["odd", "real"])
def test_rows_against_brute_force(spark, rows):
    got = sorted((tuple(r) for r in op.near_dedup(frame(spark, rows, wide=True)).collect()), key=repr)
    assert got == brute(rows, 3, 85)


def test_empty_table(spark):
    assert op.near_dedup(frame(spark, [])).count() == 0


def test_tables_find_what_they_should():
    tables = op.tables_for(0.85)
    assert 1 - (1 - 0.85**op.ROWS) ** tables > 1 - op.MISS
    rng = np.random.default_rng(0)
    xor, factor = op._seeds(2 * tables * op.ROWS)
    shared = 0
    for _ in range(60):
        common = rng.integers(0, 1 << 63, 850, np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 1 << 63, 75, np.uint64)]) for _ in range(2))
        keys = op.table_keys(np.stack([op.signature(s, xor, factor) for s in (a, b)]), tables)
        shared += len(np.intersect1d(*keys)) / keys.shape[1]
        assert len(np.intersect1d(*keys))
    assert 0.42 < shared / 60 < 0.62  # 0.85 to the fourth power


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91), (95, 91), (7, 7)], "a long, b long")
    found = {r["id"]: r["component"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {90: 90, 91: 90, 95: 90}
