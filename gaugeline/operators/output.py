"""Final shape of readings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import schema as S
from gaugeline.functions import fixed_values as fv


def final_projection(
    df: DataFrame, columns: Sequence[str] = tuple(S.FINAL_COLUMNS)
) -> DataFrame:
    """The final columns in order; missing ones are null, which sinks write as
    empty text."""
    have = set(df.columns)
    return df.select(
        *[
            F.col(c) if c in have else F.lit(None).cast("string").alias(c)
            for c in columns
        ]
    )


def final_casts(
    df: DataFrame,
    integers: Sequence[str] = tuple(S.FINAL_INTEGERS),
    floats: Sequence[str] = tuple(S.FINAL_FLOATS),
    longs: Sequence[str] = tuple(S.FINAL_LONGS),
) -> DataFrame:
    """Integer, long and float columns; text that is no number becomes null."""
    return df.withColumns(
        {
            **{name: F.col(name).try_cast("int") for name in integers},
            **{name: F.col(name).try_cast("bigint") for name in longs},
            **{name: F.col(name).try_cast("float") for name in floats},
        }
    )


def route_by_type(
    df: DataFrame,
    load_profile: Callable[[DataFrame], DataFrame],
    others: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Interval readings through one step, all others through another, together
    again by column name. Readings of no type or an unknown one go with the
    others, so none is lost here; ``quality.reject_unknown_type`` refuses them."""
    profile = F.col("readingType").eqNullSafe(fv.LOAD_PROFILE)
    return load_profile(df.filter(profile)).unionByName(others(df.filter(~profile)))
