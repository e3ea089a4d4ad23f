"""Exact copies by a cuckoo-filter index of live digests.

A text is normalised by deleting white space and stands for its SHA-256. The index
is a table (digest, keep_id, keep_chars, copies), dealt out by digest; each task
holds the digests of its partition in a :class:`CuckooIndex`. Inserting merges a
digest that is live already (a hit, verified against the stored digest) and adds
one that is not. Deleting removes digests, so that later rows with them count as
new again.

Copies are first merged inside the tasks that read them, with the same index: a
group holding a third of all rows reaches the shuffle as one row per task. A task's
index holds its own partition only, and Spark sizes the partitions.

Defined cases: null text is empty; all texts of white space only are equal; a null
id is after every other id; repeated rows with one id are copies of each other, and
each gets its own result row; an empty table gives an empty result. Other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import WHITE, id_and_text, written
from gaugeline.llm.cuckoo import CuckooIndex
from gaugeline.operators.keyed import join_per_key

INDEX = "digest binary, keep_id long, keep_chars long, copies long"
_ARROW = pa.schema(
    [("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_chars", pa.int64()), ("copies", pa.int64())]
)
_LOAD, _DELETE, _INSERT = 0, 1, 2
_ROWS_OUT = 20_000


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest of the normalised text, code points of the text as it is."""
    rows = id_and_text(docs, id_col, text_col)
    return rows.select(
        "doc_id",
        F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)).alias("digest"),
        F.length("text").cast("long").alias("chars"),
    )


def _better(a: tuple, b: tuple) -> bool:
    """Whether (id, chars) a stays rather than b: more code points, then smaller id."""
    if a[1] != b[1]:
        return a[1] > b[1]
    return b[0] is None or (a[0] is not None and a[0] < b[0])


def _merge(batches):
    """Rows (step, INDEX columns) of one partition through a cuckoo index, in the
    order of the steps: what is live, what is deleted, what is new."""
    index = CuckooIndex()
    for batch in batches:
        for step, digest, doc, chars, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if step == _DELETE:
                index.delete(digest)
                continue
            entry = index.find(digest)
            if entry < 0:
                index.insert(digest, (doc, chars, copies))
            else:
                old = index.values[entry]
                best = (doc, chars) if _better((doc, chars), old) else old[:2]
                index.values[entry] = (*best, old[2] + copies)
    rows = []
    for digest, value in index.items():
        rows.append((digest, *value))
        if len(rows) == _ROWS_OUT:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def _steps(rows: DataFrame, step: int) -> DataFrame:
    return rows.select(F.lit(step).alias("step"), *[f.split()[0] for f in INDEX.split(", ")])


def _single(marks: DataFrame) -> DataFrame:
    """Each row of ``digests`` as an index entry of its own, copies inside a task merged."""
    entries = marks.select(
        "digest", F.col("doc_id").alias("keep_id"), F.col("chars").alias("keep_chars"), F.lit(1).cast("long").alias("copies")
    )
    return _steps(entries, _INSERT).mapInArrow(_merge, INDEX)


def build(marks: DataFrame) -> DataFrame:
    """The index of all rows of ``digests``."""
    return _steps(_single(marks), _INSERT).repartition("digest").mapInArrow(_merge, INDEX)


def change(index: DataFrame, new: DataFrame | None = None, gone: DataFrame | None = None) -> DataFrame:
    """The index after deleting the digests of ``gone`` and then inserting the rows
    of ``new`` (both as ``digests`` gives them). ``index`` is not altered."""
    steps = _steps(index, _LOAD)
    if gone is not None:
        steps = steps.unionByName(_steps(_single(gone), _DELETE))
    if new is not None:
        steps = steps.unionByName(_steps(_single(new), _INSERT))
    return steps.repartition("digest").sortWithinPartitions("step").mapInArrow(_merge, INDEX)


def decide(marks: DataFrame, index: DataFrame) -> DataFrame:
    """Every row of ``marks`` with keep_id and group_size of its group. The rows of
    a hot digest may be split over many tasks, as the index side has one row each."""
    return join_per_key(
        marks, index.select("digest", "keep_id", F.col("copies").alias("group_size")), ["digest"]
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    marks = written(digests(docs, id_col, text_col), "digests")
    index = written(build(marks), "live-digests")
    return decide(marks, index).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
