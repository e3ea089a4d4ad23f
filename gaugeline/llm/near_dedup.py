"""Near copies by MinHash with tensored banding, confirmed on full sets.

A text is the set of its distinct word shingles. Texts with equal sets are one class;
only the class with the smallest id goes on. Two collections of ``tables`` short keys,
each of ``ROWS`` minhashes, are computed, and each key of the first is paired with
each of the second: tables squared keys from twice the tables' minhashes. Two sets
are candidates when they share a pair key. The number of tables follows from the
threshold, so that a link right at it shares none with a chance of ``MISS`` at most.

A bucket (all sets with one key) never lists its pairs. Its members are compared with
its hub, the member whose keys are shared most, so that variants of one original are
held against the original. Confirmed links make components. The members of buckets
that then hold several components are compared across components, wherever they share
one of their rarest shingles, as all sets do that reach the threshold (prefix and
position filter). That drops variants that are too far from each other before they
make pairs, and loses no link.

Candidates are confirmed on the full sets, made again from the texts (64-bit hashes
of shingles).

Defined cases: null text is empty; a text without words has an empty set and is linked
with nothing; fewer words than a shingle make one shingle of all words; rows with one
id are one node, and a null id belongs to its class but is never its representative
while another id is there; an empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import id_and_text, slices, written
from gaugeline.llm.components import components
from gaugeline.operators.keyed import join_per_key

ROWS = 2
MISS = 2e-6
#: Counters for how rare shingles are.
SLOTS = 1 << 20
_SLOT_SHIFT = np.uint64(44)
_WORD_CACHE = 200_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def tables_for(threshold: float) -> int:
    """Keys per collection: the chance that one of the two collections shares none of
    its keys at a similarity of ``threshold`` is at most ``MISS``."""
    return math.ceil(math.log(MISS / 2) / math.log(1 - threshold**ROWS))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes. Words are what stands between
    white space, A-Z in lower case."""

    def __init__(self, size: int):
        self.size = size
        self.words: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.words) > _WORD_CACHE:
            self.words.clear()
        numbers = list(map(self.words.get, words))
        if None in numbers:
            for i, n in enumerate(numbers):
                if n is None:
                    numbers[i] = self.words[words[i]] = xxhash.xxh3_64_intdigest(words[i])
        ids = np.array(numbers, np.uint64)
        size = min(self.size, len(ids))
        total = np.full(len(ids) - size + 1, size, np.uint64)
        for i in range(size):
            total = _mixed(total * _BASE + ids[i : len(ids) - size + 1 + i])
        return np.unique(total)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240101)
    return rng.integers(0, 1 << 63, count, np.uint64), rng.integers(0, 1 << 62, count, np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, xor: np.ndarray, factor: np.ndarray) -> np.ndarray:
    least = np.empty(len(xor), np.uint64)
    for k in range(len(xor)):
        least[k] = ((shingles ^ xor[k]) * factor[k]).min()
    return least


def table_keys(least: np.ndarray, tables: int) -> np.ndarray:
    """Pair keys of signatures (rows): every key of one collection with every of the other."""
    parts = least.reshape(len(least), 2, tables, ROWS)
    short = np.zeros(parts.shape[:3], np.uint64)
    for r in range(ROWS):
        short = _mixed(short * _BASE + parts[..., r])
    place = np.arange(tables, dtype=np.uint64)
    first = short[:, 0, :, None] + place[:, None] * _MIX
    second = short[:, 1, None, :] + place[None, :] * _BASE
    return _mixed(_mixed(first) * _BASE + second).reshape(len(least), -1)


def shingled(docs: DataFrame, size: int, tables: int) -> DataFrame:
    """doc_id, n_shingles, set_hash and signature of ``doc_id, text``."""
    xor, factor = _seeds(2 * tables * ROWS)

    def run(batches):
        shingler = Shingler(size)
        for part in slices(batches):
            counts, hashes, signatures = [], [], []
            for text in part.column("text").to_pylist():
                found = shingler(text)
                counts.append(len(found))
                hashes.append(xxhash.xxh3_128_digest(found.tobytes()))
                signatures.append(signature(found, xor, factor).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "set_hash", "signature"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, signature binary")


def _keys(nodes: DataFrame, tables: int) -> DataFrame:
    """(key, id) of each node in each table."""

    def run(batches):
        for part in slices(batches):
            least = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint64).reshape(part.num_rows, -1)
            keys = table_keys(least, tables)
            ids = np.repeat(part.column("id").to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(ids)], names=["key", "id"])

    return nodes.select("id", "signature").mapInArrow(run, "key long, id long")


def _packed(docs: DataFrame) -> DataFrame:
    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches):
            texts = pa.array([squeeze(t.encode("utf-8", "surrogatepass")) for t in part.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), texts], names=["id", "packed"])

    return docs.mapInArrow(pack, "id long, packed binary")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``texts`` is (id, packed)."""
    first = pairs.join(texts.select(F.col("id").alias("b"), F.col("packed").alias("text_b")), "b")
    both = first.join(texts.select(F.col("id").alias("a"), F.col("packed").alias("text_a")), "a")

    def check(batches):
        shingler = Shingler(size)
        expand = zstandard.ZstdDecompressor().decompress
        made = lambda blob: shingler(expand(blob).decode("utf-8", "surrogatepass"))
        last, last_set = None, None
        for part in slices(batches):
            stays = []
            for a, text_a, text_b in zip(*(part.column(c).to_pylist() for c in ("a", "text_a", "text_b")), strict=True):
                if a != last:
                    last, last_set = a, made(text_a)
                stays.append(similar(last_set, made(text_b), percent))
            yield part.select(["a", "b"]).filter(pa.array(stays, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def _hub_pairs(buckets: DataFrame) -> DataFrame:
    """Of each bucket the pairs (hub, member); the hub has the highest score, then the
    smallest id."""
    hubs = buckets.groupBy("key").agg(F.max(F.struct("score", (-F.col("id")).alias("minus"))).alias("hub"))
    hubs = hubs.select("key", (-F.col("hub.minus")).alias("a"))
    return join_per_key(buckets, hubs, ["key"]).select("a", F.col("id").alias("b")).filter("a <> b").distinct()


def _mixed_buckets(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their component, of the buckets that hold several components."""
    with_label = buckets.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = with_label.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    several = several.filter("lo <> hi").select("key")
    return join_per_key(with_label, several, ["key"], "left_semi")


def _frequencies(sets: DataFrame, size: int) -> np.ndarray:
    """How often shingles occur in ``id, packed``, by a table of ``SLOTS`` counters that
    shingles share by their hash. It sorts shingles; no result hangs on its precision."""

    def count(batches):
        slots = np.zeros(SLOTS, np.int64)
        for _, found in _sets(batches, size):
            np.add.at(slots, (found >> _SLOT_SHIFT).astype(np.int64), 1)
        used = np.flatnonzero(slots)
        for start in range(0, len(used), 50_000):
            part = used[start : start + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(slots[part])], names=["slot", "n"])

    table = sets.select("id", "packed").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros(SLOTS, np.int64)
    totals[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return np.minimum(totals, np.iinfo(np.int32).max).astype(np.int32)


def _sets(batches, size: int):
    """(row of its batch, set) for batches that end with a compressed text."""
    shingler = Shingler(size)
    expand = zstandard.ZstdDecompressor().decompress
    for part in slices(batches):
        head = [c.to_pylist() for c in part.columns[:-1]]
        for i, blob in enumerate(part.column(part.num_columns - 1).to_pylist()):
            yield tuple(c[i] for c in head), shingler(expand(blob).decode("utf-8", "surrogatepass"))


def _across(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs of different components that may reach the threshold, of the sets
    ``id, component``: two sets that do share one of their rarest shingles (prefix
    filter), and enough may follow it (position filter)."""
    sets = written(members.join(texts, "id").select("id", "component", "packed"), "members")
    frequent = _frequencies(sets, size)

    def rarest(batches):
        rows = []
        for (member, component), found in _sets(batches, size):
            order = found[np.lexsort((found, frequent[(found >> _SLOT_SHIFT).astype(np.int64)]))]
            prefix = order[: len(order) - -(-percent * len(order) // 100) + 1].view(np.int64).tolist()
            rows += [(s, member, component, len(order), place) for place, s in enumerate(prefix)]
            if len(rows) > 20_000:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)

    prefixes = written(
        sets.mapInArrow(rarest, "shingle long, id long, component long, size long, place long"), "prefixes"
    )
    several = prefixes.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    several = several.filter("lo <> hi").select("shingle")
    some = written(join_per_key(prefixes, several, ["shingle"], "left_semi"), "prefixes")
    other = some.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("id", "component", "size", "place")])
    follow = F.least(F.col("size") - F.col("place"), F.col("size_a") - F.col("place_a"))
    enough = (100 + percent) * follow >= percent * (F.col("size") + F.col("size_a"))
    return (
        some.join(other, "shingle")
        .filter((F.col("component_a") < F.col("component")) & enough)
        .select(F.least("id_a", "id").alias("a"), F.greatest("id_a", "id").alias("b"))
        .distinct()
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["shingle", "id", "component", "size", "place"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


def near_dedup(
    docs: DataFrame, shingle: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept. Two sets are linked
    when 100 * shared >= percent * together."""
    texts = id_and_text(docs, id_col, text_col)
    tables = tables_for(percent / 100)
    rows = written(shingled(texts, shingle, tables), "signatures")
    classes = rows.filter("n_shingles > 0").groupBy("set_hash").agg(F.min("doc_id").alias("id"))
    mapped = written(join_per_key(rows.select("doc_id", "n_shingles", "set_hash"), classes, ["set_hash"]), "classes")
    ids = mapped.filter("doc_id = id").select("id", F.col("n_shingles").alias("size")).distinct()
    nodes = rows.filter("n_shingles > 0").select(F.col("doc_id").alias("id"), "signature").join(ids, "id")
    keys = _keys(nodes, tables)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = written(join_per_key(keys, shared, ["key"], "inner"), "buckets")
    scores = buckets.groupBy("id").agg(F.sum("members").alias("score")).join(ids, "id")
    buckets = buckets.select("key", "id").join(scores, "id")
    pairs = written(_hub_pairs(buckets), "pairs")
    involved = buckets.select("id").distinct()
    packed = written(_packed(texts).join(involved, "id", "left_semi").dropDuplicates(["id"]), "texts")
    links = written(confirmed(pairs, packed, shingle, percent), "links")
    labels = components(links)
    mixed = _mixed_buckets(buckets, labels).select("id", "component").distinct()
    new = _across(mixed, packed, shingle, percent).join(pairs, ["a", "b"], "left_anti")
    found = written(confirmed(new, packed, shingle, percent), "links")
    # The further links join components; those of the few joined ones are found alone.
    label = lambda name: labels.select(F.col("id").alias(name), F.col("component").alias(f"of_{name}"))
    named = found.join(label("a"), "a", "left").join(label("b"), "b", "left")
    joined = components(named.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    joined = joined.select(F.col("id").alias("component"), F.col("component").alias("least"))
    merged = join_per_key(mapped, labels, ["id"]).withColumn("component", F.coalesce("component", "id"))
    merged = join_per_key(merged, joined, ["component"]).withColumn("component", F.coalesce("least", "component"))
    component = F.coalesce("component", "id", "doc_id")
    return merged.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
