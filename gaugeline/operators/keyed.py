"""Grouping and joining on keys that may be null or hot.

Any key here may hold a large share of all rows. Groups are therefore reduced by
aggregates, which Spark combines inside each map task before the shuffle, never
by windows over a whole key; and rows join per-key results on equality, where
adaptive execution splits an oversized partition of the row side over many
tasks. Small right sides are broadcast by Spark's own size check only.

Keys are joined as one struct. Two structs are equal when their fields are, nulls
included, so a plain equality join treats null keys alike. Per-key tables are
grouped by the plain columns on purpose: the struct then needs a shuffle of that
(small) table, and only a join of two fresh shuffles can be split by Spark.

Where most keys occur once, ``split_repeated`` marks in two phases: hashes alone are
counted, a written table of those that occur again is all that rows are held against,
and only the rows it hits are looked at by their true keys. The other rows pass as they
are, never grouped. Two keys with one hash are a false alarm, no error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.sources.scratch import written

KEY = "_key"
HASH = "_hash"
ROW = "_row"
# Low bits of a row id: the position inside its partition.
POSITION_BITS = (1 << 33) - 1


def key_of(keys: Sequence[str]) -> Column:
    return F.struct(*keys).alias(KEY)


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
    copies: str | None = None,
) -> DataFrame:
    """One row per key: the least by ``order``, then by all its other columns, so
    the survivor does not depend on row order. ``copies`` names a column for the
    number of rows of the key."""
    others = [name for name in df.columns if name not in keys]
    counts = [F.count(F.lit(1)).alias(copies)] if copies else []
    if not others:
        return df.groupBy(*keys).agg(*counts) if counts else df.distinct()
    ranks = [
        (F.col(o) if isinstance(o, str) else o).alias(f"_rank{i}")
        for i, o in enumerate(order)
    ]
    least = df.groupBy(*keys).agg(
        F.min(F.struct(*ranks, *others)).alias("_row"), *counts
    )
    return least.select(
        *[
            F.col(name) if name in keys else F.col("_row").getField(name).alias(name)
            for name in df.columns
        ],
        *([copies] if copies else []),
    )


def join_per_key(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Rows with the columns of ``per_key``, which has one row per key."""
    others = [name for name in per_key.columns if name not in keys]
    keyed = per_key.select(key_of(keys), *others)
    return rows.withColumn(KEY, key_of(keys)).join(keyed, KEY, how).drop(KEY)


def anti_join(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``other``; null keys match null keys."""
    return join_per_key(rows, other.select(*keys).distinct(), keys, "left_anti")


def set_difference(df: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that are not in ``other``. Both sides are reduced
    to distinct rows first, so copies never meet in one join partition."""
    return df.distinct().subtract(other.distinct())


def split_repeated(
    df: DataFrame, keys: Sequence[str], differing: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key occurs once, and a written table of all rows of keys that may occur
    more often, with ``_row``, a number of its own for each; with ``differing``, of keys
    that may have more than one value in that column, null being a value. ``df`` is read
    three times, the first time in ``keys`` only."""
    hashed = df.withColumn(HASH, F.xxhash64(*keys))
    hashes = hashed.groupBy(HASH)
    if differing is None:
        found = hashes.agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    else:
        value = F.when(F.col(differing).isNotNull(), F.xxhash64(differing)).otherwise(0)
        found = hashes.agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
        found = found.filter("_low <> _high")
    repeated = written(found.select(HASH), "repeated")
    once = hashed.join(repeated, HASH, "left_anti").drop(HASH)
    again = hashed.join(repeated, HASH, "left_semi").drop(HASH)
    return once, written(again.withColumn(ROW, F.monotonically_increasing_id()), "affected")


def first_of_repeated(
    affected: DataFrame, keys: Sequence[str], order: str, copies: str | None = None
) -> DataFrame:
    """One row per key of ``affected`` (as ``split_repeated`` gives it): the least by
    ``order``, a number or time, null last; of several such the one with the least hash
    of its columns, whatever the order of the rows. ``copies`` names a column for the
    number of rows of the key. All aggregates hold numbers only."""
    slim = affected.select(
        *keys,
        F.col(order).alias("_order"),
        ROW,
        F.xxhash64(*[c for c in affected.columns if c != ROW]).alias("_tie"),
    )
    least = slim.groupBy(*keys).agg(
        F.min("_order").alias("_least"), F.count(F.lit(1)).alias("_copies")
    )
    first = join_per_key(slim, least, keys, "inner").filter(
        F.col("_order").eqNullSafe(F.col("_least"))
    )
    chosen = first.groupBy(*keys).agg(
        F.min_by(ROW, "_tie").alias(ROW), F.max("_copies").alias("_copies")
    )
    kept = affected.join(chosen.select(ROW, "_copies"), ROW).drop(ROW)
    return kept.withColumnRenamed("_copies", copies) if copies else kept.drop("_copies")


def with_position(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "position",
    keep_order: bool = True,
) -> DataFrame:
    """Rows with their position, from 0, in their group. A group may hold most rows: ranges
    of (group, order) are sorted by tasks of their own, and a row's position is that in
    its range after the rows of its group in the ranges before. ``df`` is read twice; null
    groups are groups. Without ``keep_order`` the columns of ``order`` are given up, once
    the rows are sorted."""
    by = [*groups, *order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(
        {
            "_part": F.spark_partition_id(),
            "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_BITS)),
        }
    )
    fixed = written(ranged if keep_order else ranged.drop(*order), "positions")
    ranges = fixed.groupBy(*groups, "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per group and task.
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranges.select(
        *groups,
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    placed = join_per_key(fixed, shifts, [*groups, "_part"], "inner")
    return placed.withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")
