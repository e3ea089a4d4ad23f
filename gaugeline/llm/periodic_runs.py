"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of words with smallest period q that is at least two periods and
``least`` words long and that no neighbouring word extends. Each text is worked on by
itself, several short ones in one array, so nothing is shuffled.

**Dictionary of basic factors.** Level k names every stretch of 2^k words: equal
stretches of one text have equal names, made from the pair of names of their halves.
Names that occur once in their text are dead, and so is what they are part of.

**Proposals.** A run of period q, with 2^k < q <= 2^(k+1), starts with a factor of 2^k
words that occurs again q later. So per level the successor occurrences within twice
the factor's length propose periods (the lowest level also those up to its length).
Occurrences at most half a length apart form an arithmetic progression, whose step is
the factor's own period. Only pairs are looked at of which one stands first in its
progression: for any other pair the words left of both are equal, so it is not where
a run starts. A window holds few progressions, which keeps the pairs of a level
proportional to the words even where one word is repeated throughout.

**Extension.** The pair's common extension to the right is added up from the levels'
names, highest first. Stretches of one start and end found with several periods are one
run with the smallest.

Defined cases: null text is empty; a text without words has no runs and collapses to
the empty text; rows with one id are handled each by itself; an empty table gives an
empty result; memory grows with the longest text only (some 8 bytes per word and level).
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import id_and_text, slices

LEAST = 12
#: Words that are worked on at once; a longer text is worked on alone.
WORDS = 1 << 18
WHITE_RUN = r"[\x20\x09-\x0D]+"
RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _dead(size: int) -> np.ndarray:
    """Names that are equal to nothing."""
    return -np.arange(1, size + 1)


def factor_names(words: np.ndarray) -> list[np.ndarray]:
    """Names of the stretches of 1, 2, 4, ... words that start at each place, up to the
    last level on which a name occurs twice; dead ones are negative."""
    size = len(words)
    names, length = [words], 1
    repeated = (words >= 0) & (np.bincount(np.maximum(words, 0), minlength=1)[np.maximum(words, 0)] > 1)
    while 2 * length <= size:
        both = np.flatnonzero(repeated[: size - length] & repeated[length:])
        if not len(both):
            break
        pair = names[-1][both] * np.int64(size + 1) + names[-1][both + length]
        _, name, count = np.unique(pair, return_inverse=True, return_counts=True)
        again = count[name] > 1
        if not again.any():
            break
        level = _dead(size)
        level[both[again]] = name[again]
        names.append(level)
        repeated = level >= 0
        length *= 2
    return names


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) for each place in low .. high - 1 of each row."""
    count = np.maximum(high - low, 0)
    row = np.repeat(np.arange(len(low)), count)
    return row, np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[row]


def _proposed(level: np.ndarray, length: int, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places with one name, more than ``nearest`` and at most two lengths
    apart, of which one is the first of its progression."""
    place = np.flatnonzero(level >= 0)
    place = place[np.argsort(level[place], kind="stable")]
    key = level[place] * np.int64(4 * len(level)) + place
    first = np.diff(key, prepend=-4 * len(level)) > length // 2
    head = key[first]
    row, at = _ranges(np.searchsorted(key, head + nearest, "right"), np.searchsorted(key, head + 2 * length, "right"))
    back, before = _ranges(np.searchsorted(key, head - 2 * length, "left"), np.searchsorted(key, head - nearest, "left"))
    heads = place[first]
    return np.concatenate([heads[row], place[before]]), np.concatenate([place[at], heads[back]])


def find_runs(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period), by start and end, of the runs of numbered words. A
    negative number is equal to nothing; the last one is negative."""
    names = factor_names(words)
    lowest = 1
    while 4 * lowest - 1 <= least:
        lowest *= 2
    starts, periods = [], []
    for k, level in enumerate(names):
        length = 1 << k
        if length < lowest:
            continue
        i, j = _proposed(level, length, 0 if length == lowest else length)
        opens = (i == 0) | (words[i - 1] != words[j - 1])
        starts.append(i[opens])
        periods.append((j - i)[opens])
    if not starts:
        return np.empty((0, 3), np.int64)
    start, period = np.concatenate(starts), np.concatenate(periods)
    common = np.zeros(len(start), np.int64)
    for k in range(len(names) - 1, -1, -1):
        at = start + common
        common += (names[k][at] == names[k][at + period]).astype(np.int64) << k
    length = common + period
    holds = length >= np.maximum(least, 2 * period)
    found = np.stack([start[holds], (start + length)[holds], period[holds]], axis=1)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[new]


def _searched(texts: list[list[bytes]], least: int) -> tuple[list[np.ndarray], list[bytes]]:
    """Runs and collapsed text of each list of words."""
    size = sum(map(len, texts)) + len(texts)
    words = np.empty(size, np.int64)
    begin, at, free = [], 0, 0
    for text in texts:
        begin.append(at)
        numbers: dict[bytes, int] = {}
        words[at : at + len(text)] = [numbers.setdefault(w, len(numbers) + free) for w in text]
        at += len(text)
        free += len(numbers)
        words[at] = -at - 1
        at += 1
    found = find_runs(words, least)
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 1], -1)
    gone = np.cumsum(change) > 0
    cut = np.searchsorted(found[:, 0], [*begin, size])
    runs, kept = [], []
    for n, text in enumerate(texts):
        own = found[cut[n] : cut[n + 1]]
        runs.append(np.stack([own[:, 0] - begin[n], own[:, 1] - own[:, 0], own[:, 2]], axis=1))
        if len(own):
            drop = gone[begin[n] : begin[n] + len(text)].tolist()
            text = [w for w, out in zip(text, drop, strict=True) if not out]
        kept.append(b" ".join(text))
    return runs, kept


def _result(ids: pa.Array, counts: list[int], runs: list[np.ndarray], kept: list[bytes]) -> pa.RecordBatch:
    all_runs = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
    ends = np.cumsum([0, *map(len, runs)])
    entries = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(all_runs[:, c])) for c in range(3)], fields=list(_RUN))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(counts, pa.int64()), lists, pa.array(kept, pa.binary())], names=["doc_id", "n_words", "runs", "collapsed"]
    )


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period in words, by
    start and period) and collapsed, the words joined by one space without those that
    stand in a run after its first period."""
    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))

    def search(batches):
        for part in slices(batches):
            texts, size, first = [], 0, 0
            for n, text in enumerate(part.column("text").to_pylist()):
                texts.append(text.split())
                size += len(texts[-1]) + 1
                if size >= WORDS or n == part.num_rows - 1:
                    runs, kept = _searched(texts, least)
                    yield _result(part.column("doc_id").slice(first, len(texts)), list(map(len, texts)), runs, kept)
                    texts, size, first = [], 0, n + 1

    found = rows.mapInArrow(search, f"doc_id long, n_words long, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_period(docs: DataFrame, code: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text, where every tenth ``code`` makes the end of a text periodic: from
    a place on, the words there are repeated. What place and how many words depends on
    the code; words are then joined by one space."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.when(code % 10 == 0, text).alias("changed"), F.floor(code / 10).alias("g")
    )
    split = split.withColumn("words", F.filter(F.split("changed", WHITE_RUN), lambda w: w != ""))
    split = split.withColumn("n", F.nullif(F.size("words"), F.lit(0)))
    split = split.withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    split = split.withColumn("p", (F.lit(1) + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return split.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def report(runs: DataFrame) -> DataFrame:
    """Of ``periodic_runs``: doc_id, n_runs, the longest run (ties: smallest start, then
    period) with its exponent in thousandths, and digests of runs and collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    period = -longest["period"]
    return runs.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-longest["start"]).alias("start"),
        longest["length"].alias("length"),
        period.alias("period"),
        F.floor(1000 * longest["length"] / period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
