"""The store of accepted readings in all their versions.

A table laid out by the week of the reading and, inside a week, in buckets by a hash of
the version key. A batch then reads the weeks that it has readings in, whatever their
number and however far apart (Spark prunes the others while the query runs), and of
those weeks its own keys, for which the stored side is not shuffled: buckets are met by
the batch's keys dealt out likewise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import schema as S
from gaugeline.functions import fixed_values as fv
from gaugeline.functions.times import iso_week, iso_year

WEEK, KEY_HASH = "readingWeek", "storeKey"
TIME = "readingUtcLocalTime"


def week_number(time: Column) -> Column:
    """ISO year and week as one number, 202405; 0 without a time, so that such readings
    are stored and never read for a batch."""
    day = time.cast("date")
    return F.coalesce(iso_year(day) * 100 + iso_week(day), F.lit(0))


def laid_out(
    readings: DataFrame, key: Sequence[str] = S.VERSION_KEY, time: str = TIME
) -> DataFrame:
    """Readings with the two columns of the layout."""
    return readings.withColumns({WEEK: week_number(F.col(time)), KEY_HASH: F.xxhash64(*key)})


def append_versions(
    readings: DataFrame,
    table: str,
    path: str | None = None,
    buckets: int = 64,
    key: Sequence[str] = S.VERSION_KEY,
    time: str = TIME,
) -> None:
    """Adds readings to the store ``table`` (in ``path``, if given), which is made if it is
    not there. ``buckets`` is fixed with the first write; with at least as many as a join
    has partitions, the stored side of it needs no shuffle. Rows are dealt out by week and
    bucket first, so that a task writes few files and a large week many tasks."""
    rows = laid_out(readings, key, time)
    bucket = F.pmod(F.hash(KEY_HASH), F.lit(buckets))  # as Spark numbers them
    writer = rows.repartition(F.col(WEEK), bucket).write.mode("append").format("parquet")
    writer = writer.partitionBy(WEEK).bucketBy(buckets, KEY_HASH).sortBy(KEY_HASH)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def read_versions(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def is_store(stored: DataFrame) -> bool:
    return WEEK in stored.columns and KEY_HASH in stored.columns


def versions_of_batch(
    stored: DataFrame,
    batch: DataFrame,
    key: Sequence[str] = S.VERSION_KEY,
    time: str = TIME,
    reading_type: str = "readingType",
) -> DataFrame:
    """The stored versions of the batch's readings, of the types that have versions.

    The weeks of the batch are broadcast: they are at most as many as the calendar has,
    some thousands. The keys are met by their hash; whoever joins the result by the key
    itself loses a false hit."""
    versioned = batch.filter(F.col(reading_type).isin(fv.REGISTERS, fv.LOAD_PROFILE))
    wanted = versioned.select(week_number(F.col(time)).alias(WEEK), F.xxhash64(*key).alias(KEY_HASH))
    weeks = wanted.select(WEEK).filter(F.col(WEEK) > 0).distinct()
    keys = wanted.select(KEY_HASH).distinct()
    known = stored.filter(F.col(reading_type).isin(fv.REGISTERS, fv.LOAD_PROFILE))
    recent = known.join(F.broadcast(weeks), WEEK, "left_semi")
    return recent.join(keys, KEY_HASH, "left_semi")
