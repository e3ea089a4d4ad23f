"""Document fingerprints: SimHash, and all fingerprints within a Hamming radius.

**Fingerprint.** The terms of a text are its word shingles (A-Z in lower case), each
weighted by 1 + log2 of how often it stands there. A term's hash of 128 bits votes on
each bit with its weight, for or against; the sign of the sum is the bit. Two
fingerprints are as alike as the share of their equal bits.

**Permuted block tables.** The bits are cut into ``radius + 2`` blocks. Two fingerprints
within the radius differ in at most ``radius`` blocks, so they agree in two: a table for
each two blocks, keyed by these blocks' bits, has them in one bucket. Equal fingerprints
are one class, in the tables once. A pair is counted only in the table of the lowest two
blocks in which it agrees, so no list of pairs is made or reduced. A bucket is compared
inside its task as long as it has up to ``BUCKET`` members; a larger one is passed on
while it is read, cut into chunks of that size, and every two chunks are a group of
their own, so that no task holds more than two chunks of a bucket.

**Next document.** ``with_next`` puts each document beside the one after it: documents
are dealt out by ranges of their ids, once, and sorted; only the first and last row of a
range are matched across ranges.

Defined cases: null text is empty; a text without words has the fingerprint of all
zeros; fewer words than a shingle are one term; rows with one id follow each other in the
order of their texts' hashes, repeated ones are each other's next; a null id is after all
others; the next document of a lone one is itself; an empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import WHITE, id_and_text, slices, written
from gaugeline.operators.keyed import join_per_key

SHINGLE = 2
BYTES = 16
RADIUS = 5
BUCKET = 4096
WHITE_BYTES = frozenset(WHITE.encode())
_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)
#: Bytes of a text that are cut into words at once, and terms that vote at once.
_PIECE, _TERMS = 1 << 20, 1 << 16
#: A-Z in lower case plus one, white space zero.
_LETTERS = np.arange(1, 257, dtype=np.uint64)
_LETTERS[65:91] += np.uint64(32)
_LETTERS[np.frombuffer(WHITE.encode(), np.uint8)] = 0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> _HALF)


class Fingerprinter:
    """Fingerprints of texts, in ``BYTES`` bytes. Weights are whole numbers (sixteenths),
    so that the order of the sums plays no part."""

    def __init__(self, shingle: int = SHINGLE):
        self.shingle = shingle
        self.powers = np.ones(1, np.uint64)

    def word_hashes(self, data: bytes) -> np.ndarray:
        """A hash of each word: a polynomial in its letters."""
        parts, first = [], 0
        while first < len(data):
            end = first + _PIECE
            while end < len(data) and data[end] not in WHITE_BYTES:
                end += 1
            letters = _LETTERS[np.frombuffer(data, np.uint8, min(end, len(data)) - first, first)]
            inside = letters > 0
            begins = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
            if len(begins):
                letters, begins = letters[begins[0] :], begins - begins[0]
                since = np.arange(len(letters)) - np.repeat(begins, np.diff(np.append(begins, len(letters))))
                longest = int(since.max()) + 1
                if longest > len(self.powers):
                    self.powers = np.cumprod(np.append(np.uint64(1), np.full(2 * longest, _STEP)))
                parts.append(np.add.reduceat(letters * self.powers[since], begins))
            first = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def __call__(self, text: str) -> bytes:
        words = self.word_hashes(text.encode("utf-8", "surrogatepass"))
        if not len(words):
            return bytes(BYTES)
        size = min(self.shingle, len(words))
        terms = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            terms = _mixed(terms * _STEP + words[i : len(words) - size + 1 + i])
        terms, count = np.unique(terms, return_counts=True)
        weight = np.rint(16 + 16 * np.log2(count)).astype(np.float32)
        hashes = np.stack([terms, _mixed(terms + _STEP)], axis=1).view(np.uint8)
        votes = np.zeros(8 * BYTES)
        for first in range(0, len(terms), _TERMS):
            votes += weight[first : first + _TERMS] @ np.unpackbits(hashes[first : first + _TERMS], axis=1).astype(np.float32)
        return np.packbits(2 * votes > weight.sum(dtype=np.float64)).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / (8 * len(a))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (binary)."""

    def run(batches):
        make = Fingerprinter(shingle)
        for part in slices(batches):
            made = pa.array([make(t) for t in part.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), made], names=["doc_id", "fingerprint"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint binary")


# Within a radius

def blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, end) of the ``radius + 2`` blocks."""
    count = radius + 2
    cuts = [8 * BYTES * i // count for i in range(count + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def _block_values(prints: np.ndarray, radius: int) -> np.ndarray:
    """The bits of each block of each fingerprint (rows of bytes), as numbers."""
    bits = np.unpackbits(prints, axis=1)
    values = np.zeros((len(prints), radius + 2), np.uint64)
    for n, (first, end) in enumerate(blocks(radius)):
        for at in range(first, end):
            values[:, n] = (values[:, n] << np.uint64(1)) | bits[:, at]
    return values


def _links(mine: np.ndarray, other: np.ndarray, table: tuple[int, int], radius: int, itself: bool):
    """For each of ``mine`` and of ``other`` (rows of bytes) the links between the two that
    belong to the table; with ``itself`` the two are the same."""
    values, words = [_block_values(x, radius) for x in (mine, other)], [x.view(np.uint64) for x in (mine, other)]
    here, there = np.zeros(len(mine), np.int64), np.zeros(len(other), np.int64)
    low, high = table
    step = max(1, (1 << 20) // max(1, len(other)))
    agree = lambda n: values[0][part, None, n] == values[1][None, :, n]
    for first in range(0, len(mine), step):
        part = slice(first, first + step)
        apart = np.bitwise_count(words[0][part, None, :] ^ words[1][None, :, :]).sum(axis=2, dtype=np.int64)
        linked = (apart <= radius) & (apart > 0)
        if linked.any():
            linked &= agree(low) & agree(high)
            for n in range(high):  # agreeing in a lower block, the pair belongs to another table
                if n != low:
                    linked &= ~agree(n)
        here[part] += linked.sum(axis=1)
        there += linked.sum(axis=0)
    return (here, None) if itself else (here, there)


def _entries(classes: DataFrame, radius: int) -> DataFrame:
    """(bucket, fingerprint) of each fingerprint in each table. A bucket is a hash of the
    table's two blocks, with the number of the table in its low byte."""
    tables = list(combinations(range(radius + 2), 2))

    def run(batches):
        for part in slices(batches, 4096):
            column = part.column("fingerprint")
            prints = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BYTES)
            values = _block_values(prints, radius)
            for n, (a, b) in enumerate(tables):
                key = _mixed(_mixed(values[:, a]) + values[:, b]) & ~np.uint64(255) | np.uint64(n)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), column], names=["bucket", "fingerprint"])

    return classes.select("fingerprint").mapInArrow(run, "bucket long, fingerprint binary")


_COUNTED = "bucket long, fingerprint binary, links long"


def _counted(bucket: int, prints: np.ndarray, links: np.ndarray | None) -> pa.RecordBatch:
    """Rows with a link or, without ``links``, rows of a bucket that is passed on."""
    if links is not None:
        prints, links = prints[links > 0], links[links > 0]
    size = len(prints)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(size, bucket, np.int64)),
            pa.FixedSizeBinaryArray.from_buffers(pa.binary(BYTES), size, [None, pa.py_buffer(np.ascontiguousarray(prints))]).cast(pa.binary()),
            pa.nulls(size, pa.int64()) if links is None else pa.array(links),
        ],
        names=["bucket", "fingerprint", "links"],
    )


def _groups(batches, keys: list[str]):
    """(key, rows of bytes, whether the group goes on) of rows sorted by ``keys``. What
    belongs to one group comes in pieces, each with all of it that a batch holds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        prints = np.frombuffer(b"".join(batch.column("fingerprint").to_pylist()), np.uint8).reshape(-1, BYTES)
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        at = np.flatnonzero(new)
        for first, end in zip(at, [*at[1:], batch.num_rows], strict=True):
            yield tuple(int(c[first]) for c in columns), prints[first:end]


def _in_buckets(entries: DataFrame, radius: int, most: int) -> DataFrame:
    """(``_COUNTED``) links of the fingerprints in small buckets; members of large ones
    with null."""
    tables = list(combinations(range(radius + 2), 2))

    def run(batches):
        key, held, size, large = None, [], 0, False

        def close():
            if key is not None and not large and size > 1:
                prints = np.concatenate(held)
                yield _counted(*key, prints, _links(prints, prints, tables[key[0] & 255], radius, True)[0])

        for now, prints in _groups(batches, ["bucket"]):
            if now != key:
                yield from close()
                key, held, size, large = now, [], 0, False
            size += len(prints)
            held.append(prints)
            if size > most or large:
                large = True
                yield _counted(*key, np.concatenate(held), None)
                held = []
        yield from close()

    dealt = entries.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, _COUNTED)


def _in_chunks(large: DataFrame, radius: int, most: int) -> DataFrame:
    """(fingerprint, links) in the buckets (bucket, fingerprint) with too many members:
    each two chunks of a bucket are compared in a group of their own."""
    tables = list(combinations(range(radius + 2), 2))
    # Half a bucket's worth on average, so that a chunk hardly ever holds more than one.
    chunks = large.groupBy("bucket").agg(F.ceil(2 * F.count(F.lit(1)) / most).alias("chunks"))
    members = join_per_key(large, chunks, ["bucket"]).withColumn("own", F.pmod(F.xxhash64("fingerprint"), "chunks"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    members = members.select("bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "fingerprint")
    by = ["bucket", "x", "y", "own"]

    def run(batches):
        group, sides = None, {}

        def close():
            if group is None:
                return
            bucket, x, y = group
            both = [np.concatenate(sides[n]) for n in (x, y) if n in sides]
            if x == y and both:
                yield _counted(bucket, both[0], _links(both[0], both[0], tables[bucket & 255], radius, True)[0])
            elif len(both) == 2:
                for prints, links in zip(both, _links(*both, tables[bucket & 255], radius, False), strict=True):
                    yield _counted(bucket, prints, links)

        for key, prints in _groups(batches, by):
            if key[:3] != group:
                yield from close()
                group, sides = key[:3], {}
            sides.setdefault(key[3], []).append(prints)
        yield from close()

    return members.repartition(*by[:3]).sortWithinPartitions(*by).mapInArrow(run, _COUNTED).select("fingerprint", "links")


def within_radius(prints: DataFrame, radius: int = RADIUS, most: int = BUCKET) -> DataFrame:
    """``prints`` (doc_id, fingerprint) with class_id, the smallest doc_id of the same
    fingerprint, and n_near, how many other fingerprints are within the radius."""
    classes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id")), "classes")
    counted = written(_in_buckets(_entries(classes, radius), radius, most), "near")
    large = counted.filter("links is null").select("bucket", "fingerprint")
    found = counted.filter("links is not null").select("fingerprint", "links")
    if not large.isEmpty():
        found = found.unionByName(_in_chunks(large, radius, most))
    near = found.groupBy("fingerprint").agg(F.sum("links").alias("n_near"))
    known = join_per_key(classes, near, ["fingerprint"])
    return join_per_key(prints, known, ["fingerprint"]).withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))


# Beside the next document

_FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
)
_INNER, _HEAD, _TAIL = 0, 1, 2


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the start of the other."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class _Report:
    """Rows of ``_FIELDS`` for a text and the one that follows it."""

    def __init__(self, shingle: int):
        self.make = Fingerprinter(shingle)
        self.last: tuple[str, bytes] = ("", self.make(""))

    def of(self, text: str) -> bytes:
        if text != self.last[0]:
            self.last = (text, self.make(text))
        return self.last[1]

    def __call__(self, doc, text: str, following: str) -> tuple:
        own = self.of(text)
        changed = edited(text, following)
        other = own if changed == text else self.make(changed)
        after = self.of(following)
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return doc, len(text), digest, own, other, likeness(own, other), likeness(own, after)


def _reported(rows: list[tuple], more: dict[str, pa.Array] | None = None) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.split() for f in _FIELDS.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    more = more or {}
    return pa.RecordBatch.from_arrays([*arrays, *more.values()], names=[*[n for n, _ in fields], *more])


def with_next(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars (code points), edited_sha256, fingerprint and
    edited_fingerprint, and the likeness of the fingerprint to that of the edited text
    (near_edited) and of the next document (near_next), the one with the next smaller id;
    after the smallest comes the largest."""
    by = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranged = id_and_text(docs, id_col, text_col).repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = ranged.withColumn("part", F.spark_partition_id())

    def run(batches):
        """Rows with a next one in their range, and the first and last text of the range."""
        report, held, opened = _Report(shingle), None, False

        def batch(rows, part, kind, texts):
            size = len(rows)
            more = {"part": pa.array([part] * size, pa.int32()), "kind": pa.array([kind] * size, pa.int32()), "text": pa.array(texts, pa.string())}
            return _reported(rows, more)

        for part in slices(batches):
            rows = []
            for doc, text, number in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "part")), strict=True):
                if not opened:
                    opened = True
                    yield batch([(doc, *[None] * 6)], number, _HEAD, [text])
                if held is not None:
                    rows.append(report(held[0], held[1], text))
                held = (doc, text, number)
            if rows:
                yield batch(rows, held[2], _INNER, [None] * len(rows))
        if held is not None:
            yield batch([(held[0], *[None] * 6)], held[2], _TAIL, [held[1]])

    fixed = written(ranged.mapInArrow(run, f"{_FIELDS}, part int, kind int, text string"), "beside")
    names = [f.split()[0] for f in _FIELDS.split(", ")]
    heads = fixed.filter(F.col("kind") == _HEAD).select("part", F.col("text").alias("following"))
    # One number per range; their texts are matched by a join.
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    everywhere = Window.partitionBy(F.lit(0))
    after = heads.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(everywhere)).alias("next"))
    tails = fixed.filter(F.col("kind") == _TAIL).select("doc_id", "text", "part").join(after, "part")
    ends = tails.join(heads.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "following")

    def close(batches):
        report = _Report(shingle)
        for part in slices(batches):
            yield _reported([report(*r) for r in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True)])

    return fixed.filter(F.col("kind") == _INNER).select(*names).unionByName(ends.mapInArrow(close, _FIELDS))
