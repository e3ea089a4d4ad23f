"""Steps on flat readings that belong to no single stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.schema import INTEGER_COLUMNS


def union_readings(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; copies stay."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def drop_unnamed(df: DataFrame, column: str = "variableId") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def fill_relation_dates(
    df: DataFrame, columns=("relationStartDate", "relationEndDate")
) -> DataFrame:
    """Null relation dates as empty text, for output only."""
    return df.fillna("", subset=list(columns))


def cast_readings(df: DataFrame, columns=tuple(INTEGER_COLUMNS)) -> DataFrame:
    """Integer columns; text that is no number becomes null."""
    return df.withColumns({name: F.col(name).try_cast("int") for name in columns})
