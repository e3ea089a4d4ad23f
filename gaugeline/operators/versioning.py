"""Versions of readings against the stored ones, and usage values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import schema as S
from gaugeline.functions import fixed_values as fv
from gaugeline.functions.normalize import usage_value
from gaugeline.operators.keyed import first_per_key, join_per_key
from gaugeline.operators.quality import REASON

_KEPT = ["estimationReading", "estimationValid", "editionReading", "editionValid"]


def latest_version(
    stored: DataFrame,
    key: Sequence[str] = S.VERSION_KEY,
    version: str = "version",
) -> DataFrame:
    """The stored row with the highest version of each key; a version that is no
    number is below all others. Whole rows travel, so select the wanted columns
    first."""
    number = F.col(version).try_cast("int")
    return first_per_key(stored, key, [number.isNull(), -number])


def assign_version(
    new: DataFrame,
    latest: DataFrame,
    key: Sequence[str] = S.VERSION_KEY,
    value: str = "readingsValue",
    kept: Sequence[str] = _KEPT,
) -> DataFrame:
    """Version 1 for a reading not stored yet, the stored version (0 if it is no
    number) plus one for a changed value; the same value (as trimmed text, none
    like none) is rejected. A changed reading takes over the stored estimation and
    edition columns. Events keep the version they have."""
    known = latest.select(
        *key,
        F.lit(True).alias("_stored"),
        F.col(value).alias("_value"),
        F.col("version").try_cast("int").alias("_version"),
        *[F.col(name).alias(f"_{name}") for name in kept],
    )
    missing = [name for name in (*kept, "version") if name not in new.columns]
    bare = new.withColumns({name: F.lit(None).cast("string") for name in missing})
    matched = join_per_key(bare, known, key)

    versioned = ~F.col("readingType").eqNullSafe(fv.EVENTS)
    found = versioned & F.col("_stored").isNotNull()
    same = found & F.trim("_value").eqNullSafe(F.trim(F.col(value)))
    version = F.when(~versioned, F.col("version").try_cast("int")).otherwise(
        F.when(found, F.coalesce("_version", F.lit(0)) + 1).otherwise(1)
    )
    out = matched.withColumns(
        {
            "version": version,
            REASON: F.coalesce(
                *([F.col(REASON)] if REASON in new.columns else []),
                F.when(same, fv.REASON_SAME_VERSION),
            ),
            **{
                name: F.when(found, F.col(f"_{name}")).otherwise(F.col(name))
                for name in kept
            },
        }
    )
    return out.drop("_stored", "_value", "_version", *[f"_{name}" for name in kept])


def usage_reading(df: DataFrame) -> DataFrame:
    """``usageReading``: value times the multiplier map; none for events."""
    usage = F.when(
        ~F.col("readingType").eqNullSafe(fv.EVENTS),
        usage_value(F.col("readingsValue"), F.col("multiplier")),
    )
    return df.withColumn("usageReading", usage)
