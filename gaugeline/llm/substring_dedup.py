"""Removal of long strings that occur more than once, by suffix arrays.

A byte goes when a string of ``SPAN`` bytes that covers it also starts anywhere else.
What is decided is therefore, for each start of such a string (a window), whether an
equal window exists; equal windows share a prefix of ``SPAN`` bytes, so they are
neighbours in a suffix array.

**Dealing out.** The smallest hash of ``SEED`` bytes in a window, the rightmost of
equal ones, is its seed. Equal windows have equal seeds, so only windows of one seed
hash need to meet. The windows of one seed place are one run of starts in a row, a
few hundred at most, and its text a region. A run is one row: seed hash, document,
start, length, and the hash of the region. Runs whose seed hash occurs once have no
equal window and end here. Of the rest, equal regions (whole copies of a passage)
are one class with its count, combined inside map tasks first: a class of two or more
is removed whole. One run can have no two equal windows, as these would have
different seed places.

**Suffix arrays.** Classes that share a seed hash without being equal meet with their
texts in one task; the suffix array of their concatenation (``suffix_array``), kept to
the starts of windows, shows which classes of a single run have windows in common
with others.

**Hot seeds.** A seed hash with more than ``MOST`` classes (a common passage in ever
other surroundings) is not gathered. Its regions are dealt out again as documents of
their own by a longer seed, at last by the whole window, where all of a group are
equal and are only counted. So no task gets more than ``MOST`` regions of one group,
and nothing is skipped.

Seed hashes have 64 bits and decide only who meets; region hashes have 64 more bits
beside the seed hash.

Defined cases: null text is empty; texts shorter than ``SPAN`` bytes lose nothing;
repeated rows, with one id or many, are copies of each other and lose all windows;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import id_and_text, slices, written
from gaugeline.llm.suffix_array import suffix_array
from gaugeline.operators.keyed import join_per_key

SPAN = 400
SEEDS = (128, 368, SPAN)
MOST = 64
#: Bytes of a text that are hashed at once.
_PART = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 24) - 1)

KEY = ["doc_id", "text_hash"]
_RUN = "seed long, doc_id long, text_hash long, start long, windows int, region long"
_MARK = "doc_id long, text_hash long, start long, windows int"


def seed_hashes(data: bytes, size: int) -> np.ndarray:
    """Hash of every ``size`` bytes in a row: polynomial, by doubling, then mixed."""
    base = lambda n: np.uint64(pow(_BASE, n, 1 << 64))
    power = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    count = len(data) - size + 1
    total, at, length = None, 0, 1
    while True:
        if size & length:
            part = power[at : at + count]
            # The part that is already there stands before this one.
            total = part.copy() if total is None else total * base(length) + part
            at += length
        if length * 2 > size:
            break
        power = power[:-length] * base(length) + power[length:]
        length *= 2
    total ^= total >> np.uint64(32)
    total *= _MIX
    total ^= total >> np.uint64(29)
    total *= _MIX
    return total ^ (total >> np.uint64(32))


def runs(data: bytes, size: int, span: int = SPAN):
    """(starts, windows, seed hashes) of the runs of a text, for seeds of ``size`` bytes."""
    starts, lengths, seeds = [], [], []
    for first in range(0, len(data) - span + 1, _PART):
        part = data[first : first + _PART + span - 1]
        hashes = seed_hashes(part, size)
        among = span - size + 1
        # Upper bits of the hash, then the place counted down: the least is the rightmost.
        place = np.arange(len(hashes), dtype=np.uint64)
        least = (hashes & ~_PLACE) | (_PLACE - place)
        length = 1
        while length * 2 <= among:
            least = np.minimum(least[:-length], least[length:])
            length *= 2
        count = len(part) - span + 1
        least = np.minimum(least[:count], least[among - length : among - length + count])
        begin = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        starts.append(begin + first)
        lengths.append(np.diff(np.append(begin, count)))
        seeds.append(hashes[(_PLACE - (least[begin] & _PLACE)).astype(np.int64)].view(np.int64))
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(seeds)


def repeated_windows(regions: list[bytes], span: int = SPAN) -> list[list[tuple[int, int]]]:
    """For each region (start, number) of the runs of windows that occur elsewhere in
    the regions, by one suffix array of them all."""
    codes: list[int] = []
    owner: list[int] = []
    begin = []
    for i, region in enumerate(regions):
        begin.append(len(codes))
        codes += [b + 2 for b in region]
        codes.append(1)  # no window reaches over it
        owner += [i] * (len(region) - span + 1) + [-1] * span
    codes.append(0)
    owner.append(-1)
    text = b"\0".join(regions)
    starts = [s for s in suffix_array(codes) if owner[s] >= 0]
    marked = set()
    for a, b in zip(starts, starts[1:], strict=False):
        if text[a : a + span] == text[b : b + span]:
            marked.add(a)
            marked.add(b)
    found: list[list[tuple[int, int]]] = [[] for _ in regions]
    for s in sorted(marked):
        own = found[owner[s]]
        at = s - begin[owner[s]]
        if own and sum(own[-1]) == at:
            own[-1] = (own[-1][0], own[-1][1] + 1)
        else:
            own.append((at, 1))
    return found


def _batch(rows: list[tuple], schema: str):
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash and the compressed bytes of each text."""

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches):
            texts = pa.array([squeeze(t) for t in part.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), texts], names=[*KEY, "packed"])

    return _keyed(docs, id_col, text_col).mapInArrow(pack, "doc_id long, text_hash long, packed binary")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = id_and_text(docs, id_col, text_col)
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))


def _all_runs(texts: DataFrame, size: int) -> DataFrame:
    """A row (``_RUN``) for each run of ``doc_id, text_hash, text``."""

    def cut(batches):
        for part in slices(batches):
            seeds, docs, hashes, starts, lengths, regions = [], [], [], [], [], []
            for doc, text_hash, data in zip(*(part.column(c).to_pylist() for c in (*KEY, "text")), strict=True):
                begin, windows, seed = runs(data, size)
                if not len(begin):
                    continue
                seeds.append(seed)
                starts.append(begin)
                lengths.append(windows)
                docs += [doc] * len(begin)
                hashes += [text_hash] * len(begin)
                whole = memoryview(data)
                regions += [
                    xxhash.xxh3_64_intdigest(whole[b : b + n + SPAN - 1]) for b, n in zip(begin.tolist(), windows.tolist(), strict=True)
                ]
            if seeds:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(seeds), pa.int64()), pa.array(docs, pa.int64()), pa.array(hashes, pa.int64()),
                        pa.array(np.concatenate(starts), pa.int64()), pa.array(np.concatenate(lengths), pa.int32()),
                        pa.array(np.array(regions, np.uint64).view(np.int64), pa.int64()),
                    ],
                    names=[f.split()[0] for f in _RUN.split(", ")],
                )

    return texts.mapInArrow(cut, _RUN)


def _regions(texts: DataFrame, unpack: bool, wanted: DataFrame) -> DataFrame:
    """The texts of ``wanted`` (KEY, start, windows, seed, region, copies)."""
    parts = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("start", "windows", "seed", "region", "copies")).alias("parts"))
    schema = "doc_id long, text_hash long, start long, windows int, seed long, region long, copies long, text binary"

    def cut(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for part in slices(batches):
            rows = []
            for doc, text_hash, data, places in zip(*(c.to_pylist() for c in part.columns), strict=True):
                data = expand(data) if unpack else data
                rows += [
                    (doc, text_hash, p["start"], p["windows"], p["seed"], p["region"], p["copies"], data[p["start"] : p["start"] + p["windows"] + SPAN - 1])
                    for p in places
                ]
                if len(rows) > 2000:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    return join_per_key(texts, parts, KEY, "inner").select(*KEY, texts.columns[-1], "parts").mapInArrow(cut, schema)


def _by_suffix_array(regions: DataFrame) -> DataFrame:
    """Marks (``_MARK``) in the classes of one run, group by group."""
    names = ["seed", "copies", "doc_id", "text_hash", "start", "text"]

    def search(batches):
        rows = (row for part in slices(batches) for row in zip(*(part.column(n).to_pylist() for n in names), strict=True))
        out = []
        for _, group in groupby(rows, key=lambda r: r[0]):
            group = list(group)
            for row, found in zip(group, repeated_windows([r[5] for r in group]), strict=True):
                if row[1] == 1:
                    out += [(row[2], row[3], row[4] + at, n) for at, n in found]
            if len(out) > 2000:
                yield _batch(out, _MARK)
                out = []
        if out:
            yield _batch(out, _MARK)

    return regions.repartition("seed").sortWithinPartitions("seed").select(*names).mapInArrow(search, _MARK)


def repeated(texts: DataFrame, source: DataFrame, unpack: bool, level: int = 0) -> DataFrame:
    """Marks of every window that occurs more than once. ``texts`` has KEY and text;
    ``source`` the same texts for a second look, compressed if ``unpack``."""
    rows = written(_all_runs(texts, SEEDS[level]), "runs")
    several = rows.groupBy("seed").count().filter("count > 1").select("seed")
    # By document again: the files of a hot seed would otherwise hold nothing else.
    rows = written(join_per_key(rows, several, ["seed"], "left_semi").repartition(*KEY), "shared-runs")
    classes = rows.groupBy("seed", "region").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(*KEY, "start", "windows")).alias("first"),
    )
    whole = classes.filter("copies > 1").select("seed", "region")
    marks = join_per_key(rows, whole, ["seed", "region"], "left_semi").select(*KEY, "start", "windows")
    if SEEDS[level] == SPAN:  # a region is one window: equal or nothing
        return marks
    groups = classes.groupBy("seed").agg(
        F.count(F.lit(1)).alias("classes"), F.sum((F.col("copies") == 1).cast("int")).alias("single")
    )
    groups = written(groups.filter("classes > 1 and single > 0"), "groups")

    def wanted(condition: str) -> DataFrame:
        chosen = join_per_key(classes, groups.filter(condition).select("seed"), ["seed"], "left_semi")
        return chosen.select("first.*", "seed", "region", "copies")

    marks = marks.unionByName(_by_suffix_array(_regions(source, unpack, wanted(f"classes <= {MOST}"))))
    if groups.filter(f"classes > {MOST}").isEmpty():
        return marks
    # Hot seeds: every class is a text of its own, known by its hashes.
    hot = written(_regions(source, unpack, wanted(f"classes > {MOST}")), "hot-regions")
    texts = hot.select(F.col("seed").alias("doc_id"), F.col("region").alias("text_hash"), "text")
    inner = repeated(texts, texts, False, level + 1).withColumnsRenamed(
        {"doc_id": "seed", "text_hash": "region", "start": "at", "windows": "n"}
    )
    single = hot.filter("copies = 1").select("seed", "region", *KEY, "start")
    # A class may hold many marks, but no more than its windows.
    found = single.join(inner, ["seed", "region"])
    return marks.unionByName(found.select(*KEY, (F.col("start") + F.col("at")).alias("start"), F.col("n").alias("windows")))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_bytes: bool = True
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    removed_spans (start:end in bytes of the text, end exclusive, comma-joined), and kept,
    the remaining bytes (null without ``with_bytes``)."""
    source = packed(docs, id_col, text_col)
    marks = repeated(_keyed(docs, id_col, text_col), source, True)
    per_doc = marks.groupBy(*KEY).agg(F.collect_set(F.struct("start", "windows")).alias("marks"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed_spans string, kept binary"

    def remove(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for part in slices(batches):
            rows = []
            for doc, data, places in zip(*(c.to_pylist() for c in part.columns), strict=True):
                data = expand(data)
                kept, removed, spans = data, 0, []
                if places:
                    change = np.zeros(len(data) + 1, np.int32)
                    begin = np.array([p["start"] for p in places])
                    np.add.at(change, begin, 1)
                    np.add.at(change, begin + np.array([p["windows"] for p in places]) + SPAN - 1, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    removed = int(gone.sum())
                    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
                    spans = [f"{a}:{b}" for a, b in zip(edges[::2], edges[1::2], strict=True)]
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((doc, len(data), removed, len(spans), digest, ",".join(spans), kept if with_bytes else None))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")]
            )

    return join_per_key(source, per_doc, KEY).select("doc_id", "packed", "marks").mapInArrow(remove, schema)
