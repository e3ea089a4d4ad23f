"""Small helpers shared by the text operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.sources.scratch import written  # noqa: F401

#: Space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\f\r"
#: Rows that a Python task handles at once, whatever Spark's batch size is.
SLICE = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_file(name: str) -> str:
    """Where the installed vocabulary files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, as ``doc_id`` and ``text``; a null
    text is empty. Other columns, whatever their names, never reach it."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def crc(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def crc_third(id_col: str = "doc_id") -> Column:
    return crc(id_col) % 3


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def worker_store() -> dict:
    """What a Python worker keeps from task to task. Task functions are sent by value,
    so their own module's names last for one task only."""
    return sys.modules.setdefault("_gaugeline_worker", types.ModuleType("_gaugeline_worker")).__dict__


def bounded_sample(rows: DataFrame, size: int, label: str | None = None) -> list:
    """Of ``doc_id`` (and ``label``), the ``size`` rows of each label with the smallest
    hash of their id. Labels are a few classes. Counts over all rows give a bound for
    the hash under which twice as many rows are expected, so that what is ranked
    does not grow with the table."""
    rows = rows.filter(F.col("doc_id").isNotNull())
    rows = rows.withColumn("_label", F.col(label) if label else F.lit(0))
    places = 1 << 40
    bound = F.lit(0)
    for value, count in ((r[0], r[1]) for r in rows.groupBy("_label").count().collect()):
        most = places if count <= 4 * size else 2 * size * places // count
        bound = F.when(F.col("_label").eqNullSafe(F.lit(value)), F.lit(most)).otherwise(bound)
    order = Window.partitionBy("_label").orderBy(F.xxhash64("doc_id"), "doc_id")
    few = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(places)) < bound)
    picked = few.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= size)
    return [tuple(r) for r in picked.select("doc_id", *([label] if label else [])).collect()]
