"""Rejects by flags, date window, copies and conflicting values.

Each step adds ``rejectReason`` (null for accepted rows) instead of filtering, so
accepted and rejected rows come from the same pass; ``split`` separates them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import schema as S
from gaugeline.functions import fixed_values as fv
from gaugeline.functions.times import as_date
from gaugeline.operators.keyed import ROW, first_of_repeated, join_per_key, split_repeated
from gaugeline.settings import Settings

REASON = "rejectReason"


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows without the reason column, and rejected rows with it."""
    return (
        classified.filter(F.col(REASON).isNull()).drop(REASON),
        classified.filter(F.col(REASON).isNotNull()),
    )


def _mark(df: DataFrame, *rules: tuple[Column, str]) -> DataFrame:
    """Reason of the first rule that applies; an earlier reason stays."""
    known = [F.col(REASON)] if REASON in df.columns else []
    found = [F.when(condition, reason) for condition, reason in rules]
    return df.withColumn(REASON, F.coalesce(*known, *found))


def _not_true(flag: Column) -> Column:
    """False and null both count as not set."""
    return ~F.coalesce(flag, F.lit(False))


def reject_unknown_type(df: DataFrame) -> DataFrame:
    """Readings of no type, or of one that no later step knows."""
    known = F.col("readingType").isin(fv.LOAD_PROFILE, fv.REGISTERS, fv.EVENTS)
    return _mark(df, (_not_true(known), fv.REASON_TYPE))


def reject_unassociated(df: DataFrame) -> DataFrame:
    return _mark(df, (_not_true(F.col("result_rD")), fv.REASON_ASSOCIATION))


def reject_unstorable(df: DataFrame) -> DataFrame:
    return _mark(
        df,
        (
            _not_true(F.col("result_sPV")) | _not_true(F.col("toStock")),
            fv.REASON_VARIABLE,
        ),
    )


def require_utc(df: DataFrame) -> DataFrame:
    return _mark(df, (F.col("readingUtcLocalTime").isNull(), fv.REASON_NO_UTC))


def reject_out_of_window(df: DataFrame, settings: Settings, as_of: dt.date) -> DataFrame:
    """Keep readings between the later of last read date and relation start,
    minus the past days, and the run date plus the future days. A reading
    without any start date is rejected: its window is unknown."""
    profile = F.col("readingType") == fv.LOAD_PROFILE
    past = F.when(profile, settings.load_profile_past_days).otherwise(
        settings.other_past_days
    )
    future = F.when(profile, settings.load_profile_future_days).otherwise(
        settings.other_future_days
    )
    start = F.greatest(
        as_date(F.col("lastReadDate")), as_date(F.col("relationStartDate"))
    )
    day = F.col("readingUtcLocalTime").cast("date")
    inside = day.between(
        F.date_sub(start, past), F.date_add(F.lit(as_of).cast("date"), future)
    )
    return _mark(df, (_not_true(inside), fv.REASON_WINDOW))


def drop_duplicates(
    df: DataFrame, key: Sequence[str] = S.DUPLICATE_KEY, order: str = "identReading"
) -> DataFrame:
    """One row per key, the least by ``order``."""
    once, affected = split_repeated(df, key)
    return once.unionByName(first_of_repeated(affected, key, order))


def duplicate_report(
    df: DataFrame, key: Sequence[str] = S.DUPLICATE_KEY, order: str = "identReading"
) -> DataFrame:
    """One row per key that occurs more than once, the one that is kept."""
    _, affected = split_repeated(df, key)
    counted = first_of_repeated(affected, key, order, copies="_copies")
    return (
        counted.filter(F.col("_copies") > 1)
        .drop("_copies")
        .withColumn(REASON, F.lit(fv.REASON_DUPLICATE))
    )


def conflicting_keys(
    df: DataFrame, key: Sequence[str] = S.CONFLICT_KEY, value: str = "readingsValue"
) -> DataFrame:
    """Keys with more than one distinct value, null being a value of its own. The rows are
    reduced to distinct values, so that a key with countless copies is one row per map
    task, and one with countless values is counted by many tasks first."""
    values = df.select(*key, value).distinct()
    several = values.groupBy(*key).agg(F.count(F.lit(1)).alias("_values"))
    return several.filter("_values > 1").select(*key)


def _with_conflicts(affected: DataFrame, key: Sequence[str], rows: DataFrame, value: str) -> DataFrame:
    conflicts = conflicting_keys(affected, key, value).withColumn("_conflict", F.lit(True))
    marked = join_per_key(rows, conflicts, key, "left")
    return _mark(marked, (F.col("_conflict"), fv.REASON_CONFLICT)).drop("_conflict")


def reject_conflicts(
    df: DataFrame, key: Sequence[str] = S.CONFLICT_KEY, value: str = "readingsValue"
) -> DataFrame:
    """All rows of a conflicting key leave, whatever their number."""
    once, affected = split_repeated(df, key, differing=value)
    marked = _with_conflicts(affected, key, affected.drop(ROW), value)
    return _mark(once, (F.lit(False), fv.REASON_CONFLICT)).unionByName(marked)


def resolve_duplicates(df: DataFrame, order: str = "identReading") -> DataFrame:
    """Copies and conflicts in one go: one row per distinct reading, with
    ``copies`` and the reject reason of conflicting keys. Readings whose key occurs once,
    as most do, are never grouped."""
    once, affected = split_repeated(df, S.CONFLICT_KEY)
    first = first_of_repeated(affected, S.DUPLICATE_KEY, order, copies="copies")
    marked = _with_conflicts(affected, S.CONFLICT_KEY, first, "readingsValue")
    untouched = once.withColumn("copies", F.lit(1).cast("long"))
    return _mark(untouched, (F.lit(False), fv.REASON_CONFLICT)).unionByName(marked)


def reported_copies(resolved: DataFrame) -> DataFrame:
    """The report rows of duplicated readings after ``resolve_duplicates``."""
    return (
        resolved.filter(F.col("copies") > 1)
        .drop("copies")
        .withColumn(REASON, F.lit(fv.REASON_DUPLICATE))
    )
