import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import merkle as op
from gaugeline.llm.common import crc
from helpers import ODD_TEXTS

ROW = "doc_id long, source string, lang string, n_chars long, text string"

sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(digests, fanout):
    """(root, siblings of each leaf as (left, right) per level)."""
    paths, spans = [[] for _ in digests], [[n] for n in range(len(digests))]
    while len(digests) > 1:
        groups = [range(n, min(n + fanout, len(digests))) for n in range(0, len(digests), fanout)]
        for group in groups:
            for n in group:
                for k in spans[n]:
                    paths[k].append(("".join(digests[m] for m in group if m < n), "".join(digests[m] for m in group if m > n)))
        spans = [[k for n in group for k in spans[n]] for group in groups]
        digests = [sha("".join(digests[n] for n in group)) for group in groups]
    return digests[0], paths


def brute(rows, fanout=16):
    """Rows of ``verify``; ``rows`` are (doc_id, source, lang, n_chars, text)."""
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        own = sorted(by[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = (own, *climb([leaf(r) for r in own], fanout))
    root, tops = climb([trees[n][1] for n in names], fanout) if names else (None, [])
    out = []
    for name, top in zip(names, tops, strict=True):
        own, subroot, paths = trees[name]
        for row, path in zip(own, paths, strict=True):
            path = path + top
            shown = row
            if zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 5 == 0 and row[4] is not None:
                shown = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            digest = leaf(shown)
            for left, right in path:
                digest = sha(left + digest + right)
            out.append((row[0], leaf(row), subroot, root, sha("".join(a + b for a, b in path)), digest, digest == root))
    return sorted(out, key=repr)


def found(spark, rows, fanout=16):
    docs = spark.createDataFrame(rows, ROW).repartition(5)
    docs = docs.withColumns({c: F.lit(1) for c in ("tree", "place", "size", "digest", "path", "s0", "_part", "shown")})
    return sorted((tuple(r) for r in op.verify(docs, crc() % 5 == 0, fanout=fanout).drop("path").collect()), key=repr)


MIXED = [(i, "abc"[i % 3] if i % 7 else None, "en", len(t or ""), t) for i, t in ODD_TEXTS if i is not None]
MIXED += [(None, "é", None, None, "No id"), (None, "é", None, None, "No id"), (200, "lone", None, 3, "One"), (201, "", "en", 3, None)]
MIXED += [(1000 + n // 2, "hot", "de", n, f"Text {n // 3}") for n in range(300)]


@pytest.mark.parametrize("fanout", [16, 2, 3])
def test_against_brute_force(spark, fanout):
    got = found(spark, MIXED, fanout)
    assert got == brute(MIXED, fanout)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("count", [1, 2, 16, 17, 256, 257])
def test_runs_of_every_length(spark, count):
    rows = [(n, "s", None, None, f"Text {n}") for n in range(count)]
    assert found(spark, rows) == brute(rows)


def test_many_sources(spark):
    rows = [(n, f"source {n % 40}", None, None, "Some Text") for n in range(90)]
    assert found(spark, rows) == brute(rows)


def test_empty(spark):
    assert found(spark, []) == []


def test_no_task_numbers_a_whole_source(spark):
    """Places come from ranges of ids, though all rows have one source."""
    rows = spark.range(5000).select(F.lit("=s").alias("tree"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    from gaugeline.sources.scratch import written

    ranged = op.placed(written(rows.repartition(4)), ["id"])
    assert [r["place"] for r in ranged.orderBy("id").collect()] == list(range(5000))
    assert ranged.filter("size <> 5000").isEmpty()
