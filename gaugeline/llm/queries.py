"""The operators on their whole tables, and the SQL that gives the same rows where
SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import decontaminate, exact_dedup, language, merkle, near_dedup, periodic_runs, pieces, pii, quality, secrets, simhash, substring_dedup, token_counts
from gaugeline.llm.common import crc, documents, tokenizer_file
from gaugeline.llm.sql import EXACT_DEDUP_SQL, RUNS_SQL, merkle_sql, pii_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_pii", pii_sql())
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(documents(spark, sf_dir))


@query("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.train(docs))


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(documents(spark, sf_dir))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


@query("op5_pieces")
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir), pieces.load(tokenizer_file("piece_bpe_32k.model")))


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.quality(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query("op7_repeated_strings")
def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir), with_bytes=False).drop("kept")


@query("op8_near_dedup")
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir))


@query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op10_exact_dedup", EXACT_DEDUP_SQL)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


@query("op11_merkle_manifest", merkle_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(documents(spark, sf_dir), crc() % 5 == 0).drop("path")


@query("op12_periodic_runs", RUNS_SQL)
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = periodic_runs.with_period(documents(spark, sf_dir), crc())
    return periodic_runs.report(periodic_runs.periodic_runs(edited))


@query("op13_fingerprints")
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.with_next(documents(spark, sf_dir))
    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    return simhash.within_radius(rows).select(
        "doc_id", "n_chars", "edited_sha256", hexed("fingerprint"), hexed("edited_fingerprint"), "near_edited", "near_next", "class_id", "n_near"
    )
