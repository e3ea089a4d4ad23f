"""Reading staged and stored readings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions import fixed_values as fv
from gaugeline.functions.times import as_time
from gaugeline.schema import INTEGER_COLUMNS


def _text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_staged_csv(
    spark: SparkSession, path: str | list[str], columns: Iterable[str] | None = None
) -> DataFrame:
    """Staged readings: headered CSV, all text, empty text is null. With
    ``columns`` no file is opened for its header while planning; a file whose
    header differs from them fails instead of shifting columns."""
    reader = spark.read.option("header", True)
    if columns is not None:
        reader = reader.schema(_text_schema(columns)).option("enforceSchema", False)
    return reader.csv(path)


def earliest_time(batch: DataFrame, time: str = "readingUtcLocalTime") -> Column:
    """Earliest time of the versioned rows of a batch as a scalar subquery: it
    is computed by the cluster and pushed to the stored scan, with neither a
    driver round trip nor a join."""
    versioned = batch.filter(F.col("readingType").isin(fv.REGISTERS, fv.LOAD_PROFILE))
    return versioned.select(F.min(time)).scalar()


def recent_versions(
    stored: DataFrame,
    since: Column | dt.datetime,
    time: str = "readingUtcLocalTime",
    reading_type: str = "readingType",
) -> DataFrame:
    """Stored readings of the versioned types at or after ``since``."""
    bound = since if isinstance(since, Column) else F.lit(since).cast("timestamp_ntz")
    return stored.filter(
        (F.col(time) >= bound)
        & F.col(reading_type).isin(fv.REGISTERS, fv.LOAD_PROFILE)
    )


def read_stored(
    spark: SparkSession,
    source: str,
    since: Column | dt.datetime,
    columns: Iterable[str] | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """Stored readings from ``since`` on. ``source`` is a folder of ``fmt`` files
    or, with ``fmt="table"``, a catalog table. Malformed CSV lines are dropped.
    With CSV the times arrive as text and are parsed; columnar formats get the
    bound pushed into the scan."""
    if fmt == "table":
        stored = spark.table(source)
    elif fmt == "csv":
        reader = spark.read.option("header", True).option("mode", "DROPMALFORMED")
        if columns is not None:
            reader = reader.schema(_text_schema(columns)).option("enforceSchema", False)
        stored = reader.csv(source)
    else:
        stored = spark.read.format(fmt).load(source)
    return recent_versions(typed_stored(stored), since)


def typed_stored(stored: DataFrame) -> DataFrame:
    """Text columns of stored readings in the types of a new batch."""
    text = {name for name, kind in stored.dtypes if kind == "string"}
    timed = {
        name: as_time(F.col(name))
        for name in ("readingUtcLocalTime", "readingLocalTime", "readingDateSource")
        if name in text
    }
    whole = {
        name: F.col(name).try_cast("int")
        for name in (*INTEGER_COLUMNS, "version")
        if name in text
    }
    return stored.withColumns({**timed, **whole}) if timed or whole else stored
