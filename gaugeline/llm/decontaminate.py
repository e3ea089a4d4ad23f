"""Benchmark passages in documents by greedy string tiling.

Texts are lower-cased and cut into words (letters and digits); in scripts written
without spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) each letter is a word. A Karp-Rabin hash
runs over every ``MIN_MATCH`` words of a whole document and is looked up among the
hashes of the items' word runs: the shared seeds, verified word by word. Seeds that
follow each other on one diagonal are one match. The longest match whose words are
all unmarked in document and item is marked as a tile, matches that lost words to
it are cut, and so on until none of ``MIN_MATCH`` words is left. An item is leaked
when tiles cover the share ``COVERAGE`` of its words; as tiles may lie anywhere and
in any order, a passage whose parts were moved counts as well.

The items are a query set, dealt evenly into blocks of about ``BLOCK_CHARS`` code
points. One block at a time is collected, sent to the tasks and held against all
documents where they are read; its findings are written before the next block is
collected, so driver and tasks hold one block, however many there are. A benchmark
of one block, the usual case, is searched without writing anything. No document is
shuffled, so a passage that many documents share makes no hot key.

Defined cases: null and empty texts, of documents or items, match nothing;
no tile lies in items of fewer than ``MIN_MATCH`` words. Of those the exact word sequence
counts: with ``SHORT`` spaced words or more wherever it stands, else, as it may be a word
of the language, where it is all words of a line or of the document. Equal items
each give their row; repeated document rows give a row each; empty tables give an
empty result (or, for ``drop_contaminated``, the documents as they are). Columns
other than id and text are ignored, or passed on unread by ``drop_contaminated``.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import id_and_text, slices, written

MIN_MATCH = 5
COVERAGE = 0.5
SHORT = 3
BLOCK_CHARS = 4_000_000

_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_LETTER = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(rf"[^\W_{_UNSPACED}]+|(?=[^\W_])[{_UNSPACED}]")
_BASE = np.uint64(0x9E3779B97F4A7C15)
FOUND = "doc_id long, item_id long, item_words int, matched_words int, tiles int, coverage double"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def running_hashes(numbers: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2^64, of every ``size`` numbers in a row."""
    if len(numbers) < size:
        return np.empty(0, np.uint64)
    total = np.zeros(len(numbers) - size + 1, np.uint64)
    for i in range(size):
        total = total * _BASE + numbers[i : len(numbers) - size + 1 + i]
    return total


class Items:
    """One block of benchmark items and their seeds."""

    def __init__(self, rows: list[tuple[int, str]], size: int):
        self.size = size
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        places = defaultdict(list)
        #: Items too short for a seed, by their words.
        self.anywhere, self.alone = defaultdict(list), defaultdict(list)
        number = self.vocabulary.setdefault
        for item, text in rows:
            ids = np.array([number(w, len(self.vocabulary) + 1) for w in words(text)], np.uint64)
            for i, h in enumerate(running_hashes(ids, size).tolist()):
                places[h].append((len(self.items), i))
            self.items.append((item, ids))
            if 0 < len(ids) < size:
                anywhere = len(ids) >= SHORT and not _LETTER.search(text)
                (self.anywhere if anywhere else self.alone)[tuple(ids.tolist())].append(len(self.items) - 1)
        self.places = dict(places)
        self.seeds = np.sort(np.fromiter(self.places, np.uint64, len(self.places)))

    def matches(self, text: str) -> dict[int, list[tuple[int, int, int]]]:
        """By item: the maximal matches (length, place in item, place in text)."""
        number = self.vocabulary.get
        ids = np.array([number(w, 0) for w in words(text)], np.uint64)
        hashes = running_hashes(ids, self.size)
        if not len(hashes) or not len(self.seeds):
            return {}
        at = np.searchsorted(self.seeds, hashes)
        hits = np.flatnonzero(self.seeds[np.minimum(at, len(self.seeds) - 1)] == hashes)
        open_runs: dict[tuple[int, int], tuple[int, int]] = {}
        found = defaultdict(list)
        for j in hits.tolist():
            for item, i in self.places[int(hashes[j])]:
                if not np.array_equal(self.items[item][1][i : i + self.size], ids[j : j + self.size]):
                    continue
                first, last = open_runs.get((item, j - i), (j, j))
                if j - last > 1:
                    found[item].append((last - first + self.size, first - (j - i), first))
                    first = j
                open_runs[item, j - i] = (first, j)
        for (item, diagonal), (first, last) in open_runs.items():
            found[item].append((last - first + self.size, first - diagonal, first))
        return found

    def leaks(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, words, matched words, tiles) of each item that shares a seed."""
        return [
            (self.items[item][0], len(self.items[item][1]), *tile(runs, self.size))
            for item, runs in self.matches(text).items()
        ]


    def short(self, text: str) -> list[tuple[int, int, int, int]]:
        """As ``leaks``, the items too short for a seed."""
        found = set()
        number = lambda part: [self.vocabulary.get(w, 0) for w in words(part)]
        if self.anywhere:
            ids = number(text)
            for n in {len(k) for k in self.anywhere}:
                for i in range(len(ids) - n + 1):
                    found.update(self.anywhere.get(tuple(ids[i : i + n]), ()))
        if self.alone:
            for part in [text, *text.splitlines()]:
                found.update(self.alone.get(tuple(number(part)), ()))
        return [(self.items[item][0], n, n, 1) for item in sorted(found) for n in [len(self.items[item][1])]]


def tile(runs: list[tuple[int, int, int]], size: int) -> tuple[int, int]:
    """Marks the longest match first, then what is left of the others. Words marked
    and tiles laid. Of equally long matches the first in the item, then in the text."""
    heap = [(-length, i, j) for length, i, j in runs]
    heapq.heapify(heap)
    in_item: set[int] = set()
    in_text: set[int] = set()
    tiles = 0
    while heap:
        length, i, j = heapq.heappop(heap)
        free = [k for k in range(-length) if i + k not in in_item and j + k not in in_text]
        if len(free) == -length:
            in_item.update(range(i, i - length))
            in_text.update(range(j, j - length))
            tiles += 1
            continue
        start = 0
        for k in range(1, len(free) + 1):
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - start >= size:
                    heapq.heappush(heap, (start - k, i + free[start], j + free[start]))
                start = k
    return len(in_item), tiles


def blocks(benchmark: DataFrame, size: int, item_col: str, text_col: str) -> tuple[int, Iterator[Items]]:
    """How many blocks the items make, and the blocks, each collected when it is asked
    for. Rows are dealt by their place in the written table: neither a repeated id nor
    equal texts gather in one block."""
    rows = id_and_text(benchmark, item_col, text_col)
    chars = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    count = max(1, math.ceil(chars / BLOCK_CHARS))
    if count > 1:
        share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count))
        rows = written(rows.withColumn("_share", share), "items")

    def each():
        for n in range(count):
            part = rows if count == 1 else rows.filter(F.col("_share") == n).drop("_share")
            yield Items([tuple(r) for r in part.collect()], size)

    return count, each()


def _found(docs: DataFrame, block: Items, coverage: float) -> DataFrame:
    """``FOUND`` of ``doc_id, text`` and one block."""

    def search(batches):
        for part in slices(batches):
            rows = []
            for doc, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for item, total, matched, tiles in block.leaks(text) + block.short(text):
                    if matched >= coverage * total:
                        rows.append((doc, item, total, matched, tiles, matched / total))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=[f.split()[0] for f in FOUND.split(", ")],
                )

    return docs.mapInArrow(search, FOUND)


def _clean(docs: DataFrame, block: Items, coverage: float, text_col: str, clean: bool = True) -> DataFrame:
    """The documents that leak no item of the block, or, if not ``clean``, those that do."""

    def keep(batches):
        for part in slices(batches):
            stays = [
                clean != any(m >= coverage * n for _, n, m, _ in block.leaks(text or "") + block.short(text or ""))
                for text in part.column(text_col).to_pylist()
            ]
            yield part.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    min_match: int = MIN_MATCH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row (``FOUND``) for each document and item it leaks; clean documents have none."""
    rows = id_and_text(docs, id_col, text_col)
    count, parts = blocks(benchmark, min_match, item_col, item_text_col)
    if count == 1:
        return _found(rows, next(parts), coverage)
    return reduce(DataFrame.union, [written(_found(rows, block, coverage), "leaks") for block in parts])


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    min_match: int = MIN_MATCH,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The documents, all columns, that leak no item. Where there are several blocks the
    digests of the leaking texts are written, and their documents taken out at the end."""
    count, parts = blocks(benchmark, min_match, item_col, item_text_col)
    if count == 1:
        return _clean(docs, next(parts), coverage, text_col)
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digest = F.sha2(F.col("text"), 256).alias("_leaking")
    leaking = reduce(
        DataFrame.union,
        [written(_clean(texts, block, coverage, "text", clean=False).select(digest).distinct(), "leaks") for block in parts],
    )
    own = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    return docs.join(leaking.distinct(), own == F.col("_leaking"), "left_anti")
