"""The corpus pipeline: stages over ``documents``, each on all that the one before
it kept. Every stage is written as Parquet in the shared folder and read again.

All stages but the last return the columns of ``documents``. Null texts have no
language and go with the first stage; rows with one id and equal texts stay together,
as do their decisions; an empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm import decontaminate as leaks
from gaugeline.llm import exact_dedup as copies
from gaugeline.llm import language as languages
from gaugeline.llm import near_dedup as variants
from gaugeline.llm import pieces
from gaugeline.llm.common import documents, tokenizer_file, written
from gaugeline.operators.keyed import join_per_key

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The near-copy stage: words of a shingle, similarity in percent.
SHINGLE, PERCENT = 5, 80


def _staying(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The documents whose row of ``decided`` is kept."""
    kept = decided.filter("kept").select("doc_id").distinct()
    return join_per_key(docs, kept, ["doc_id"], "left_semi")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that are in none of the languages: no letter, or no language with
    a fair score."""
    return languages.keep_identified(docs, languages.train(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the most code points, then the smallest doc_id."""
    return _staying(docs, copies.exact_dedup(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts the smallest doc_id."""
    return _staying(docs, variants.near_dedup(docs, SHINGLE, PERCENT))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    return leaks.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids, round_trip of what is left."""
    return pieces.encode(docs, pieces.load(tokenizer_file("piece_bpe_32k.model")))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: SQL can't express every stage; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
