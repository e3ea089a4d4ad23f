"""Writing results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.times import iso_week, iso_year, time_text


def rendered(df: DataFrame) -> DataFrame:
    """Times as ``yyyy-MM-dd HH:mm:ss`` text; the rest is left to the writer."""
    return df.withColumns(
        {
            name: time_text(F.col(name))
            for name, kind in df.dtypes
            if kind in ("timestamp_ntz", "timestamp")
        }
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV with null and empty text both written as nothing. The number
    of files follows the partitions; nothing is gathered into one."""
    (
        rendered(df)
        .write.mode(mode)
        .option("header", True)
        .option("emptyValue", "")
        .csv(path)
    )


def with_run_week(df: DataFrame, as_of: dt.date) -> DataFrame:
    day = F.lit(as_of).cast("date")
    return df.withColumns({"isoYear": iso_year(day), "isoWeek": iso_week(day)})


def write_final(
    df: DataFrame, path: str, as_of: dt.date, batch: str, fmt: str = "csv"
) -> None:
    """Final readings filed under ISO year and week of the run date and, below it,
    the batch (an id of the caller, such as the file's or the run's). Only that
    batch is replaced, as when it is run again; readers by week prune the others."""
    writer = (
        with_run_week(rendered(df) if fmt == "csv" else df, as_of)
        .withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("isoYear", "isoWeek", "batch")
        .format(fmt)
    )
    if fmt == "csv":
        writer = writer.option("header", True).option("emptyValue", "")
    writer.save(path)
