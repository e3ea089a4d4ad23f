"""Identifiers, topology lists and lookups of the enrich stage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.functions import fixed_values as fv
from gaugeline.functions import times
from gaugeline.operators.keyed import first_per_key, with_position
from gaugeline.sources.scratch import written

FILE = ["guidFile", "owner", "readingsSource"]
PROFILE_VARIABLE = [
    "readingType", "variableId", "servicePointId", "meteringType", "unitOfMeasure",
    "logNumber", "channel", "intervalSize",
]
OTHER_VARIABLE = PROFILE_VARIABLE[:5]
_DEVICE = ["deviceId", "brand", "model", "deviceDescription", "deviceStatus"]
_RELATION = [
    "servicePointId", "deviceId", "meteringType", "relationStartDate", "relationEndDate",
]

# Low bits of a row id: the position inside its partition.
_POSITION_BITS = (1 << 33) - 1


def add_ids(df: DataFrame, as_of: dt.date) -> DataFrame:
    nothing = F.lit(None).cast("bigint")
    return df.withColumns(
        {
            "idVdi": nothing,
            "idenEvent": nothing,
            "dateCreation": F.lit(as_of).cast("date"),
        }
    )


def init_version(df: DataFrame) -> DataFrame:
    return df.withColumn("version", F.lit(1))


def number_rows(
    df: DataFrame,
    order: Sequence[Column | str] = (),
    name: str = "identReading",
) -> DataFrame:
    """Consecutive numbers from 0, in ``order`` or else in input order.

    Each partition numbers its own rows; the written table fixes which rows it
    has, and the counts of the partitions before it give its offset. With
    ``order`` a range sort makes the partitions; ties are cut by input position,
    so a value shared by many rows spreads over partitions."""
    if order:
        by_input = df.withColumn("_input", F.monotonically_increasing_id())
        df = by_input.orderBy(*order, "_input").drop("_input")
    placed = df.withColumns(
        {
            "_part": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)),
        }
    )
    fixed = written(placed, "numbered")
    # One row per task that wrote: Spark sees its size when it is there, and broadcasts
    # it or deals the rows out by task.
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        fixed.join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos"))
        .drop("_part", "_pos", "_offset")
    )


def distinct_service_points(df: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return df.select(*scope, "servicePointId").distinct()


def distinct_devices(
    df: DataFrame,
    scope: Sequence[str] = (),
    order: Sequence[str] = ("identReading",),
) -> DataFrame:
    """One row per device with its profile, from its first reading."""
    columns = [*scope, *_DEVICE]
    first = first_per_key(df.select(*columns, *order), [*scope, "deviceId"], order)
    return first.select(*columns, F.lit(fv.DEVICE_CATEGORY).alias("deviceCategory"))


def distinct_relations(
    df: DataFrame,
    scope: Sequence[str] = (),
    order: Sequence[str] = ("identReading",),
) -> DataFrame:
    """One row per service point and device with the dates of the relation."""
    key = [*scope, "servicePointId", "deviceId"]
    columns = [*scope, *_RELATION]
    return first_per_key(df.select(*columns, *order), key, order).select(*columns)


def distinct_profile_variables(df: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    profile = df.filter(F.col("readingType") == fv.LOAD_PROFILE)
    return profile.select(*scope, *PROFILE_VARIABLE).distinct()


def distinct_register_event_variables(
    df: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    other = df.filter(F.col("readingType").isin(fv.REGISTERS, fv.EVENTS))
    return other.select(*scope, *OTHER_VARIABLE).distinct()


def service_point_variables(df: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Both variable lists; registers and events have no log, channel or size."""
    return distinct_profile_variables(df, scope).unionByName(
        distinct_register_event_variables(df, scope), allowMissingColumns=True
    )


def topology_entries(
    df: DataFrame, order: Sequence[str] = ("identReading",)
) -> DataFrame:
    """What the topology service is asked about, a row per entry: file, ``list``, the entry
    as a struct in the column of its list, and its ``position`` in the file, list by list
    and in a list by the entry's fields.

    The readings are passed once, reduced to their distinct devices and
    variables; the lists come from that small table."""
    told = dict.fromkeys([*FILE, *_DEVICE, *_RELATION, *PROFILE_VARIABLE])
    groups = df.groupBy(*told)
    if len(order) == 1:  # a number or time alone: no rows are sorted for it
        condensed = groups.agg(F.min(order[0]).alias(order[0]))
    else:
        condensed = groups.agg(F.min(F.struct(*order)).alias("_first")).select(*told, "_first.*")
    known = written(condensed, "topology")
    lists = {
        "servicePoint": distinct_service_points(known, FILE),
        "device": distinct_devices(known, FILE, order),
        "relationDevice": distinct_relations(known, FILE, order),
        "servicePointVariable": service_point_variables(known, FILE),
    }
    entries = None
    for number, (name, frame) in enumerate(lists.items()):
        fields = [c for c in frame.columns if c not in FILE]
        shaped = frame.select(
            *FILE,
            F.lit(number).alias("_list"),
            F.lit(name).alias("list"),
            F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]).alias("_fields"),
            F.struct(*fields).alias(name),
        )
        entries = shaped if entries is None else entries.unionByName(shaped, allowMissingColumns=True)
    return with_position(written(entries, "entries"), FILE, ["_list", "_fields"], keep_order=False)


def topology_request(
    df: DataFrame, order: Sequence[str] = ("identReading",), chunk: int = 10_000
) -> DataFrame:
    """``topology_entries`` as requests: per file and ``part`` an owner block and the lists
    of service points, devices, relations and variables as one JSON text. A part has the
    ``chunk`` entries from position ``part * chunk`` on, whatever the size of its file, so
    no record grows with the file."""
    entries = topology_entries(df, order)
    names = [c for c in entries.columns if c not in (*FILE, "list", "position")]
    grouped = entries.groupBy(*FILE, F.floor(F.col("position") / chunk).alias("part")).agg(
        *[
            F.array_sort(
                F.collect_list(F.when(F.col(name).isNotNull(), F.struct("position", F.col(name).alias("entry"))))
            ).alias(name)
            for name in names
        ]
    )
    body = F.struct(
        F.struct(F.col("readingsSource").alias("hes"), "owner", "guidFile").alias("owner"),
        *[F.transform(name, lambda e: e["entry"]).alias(name) for name in names],
    )
    return grouped.select(*FILE, "part", F.to_json(body).alias("request"))


def join_relation_flags(df: DataFrame, relation: DataFrame) -> DataFrame:
    """Readings of known relations, with ``result_rD``. Both tables may be large:
    Spark broadcasts the lookup if it is small, else shuffles and splits hot
    relations."""
    return df.join(
        relation.select("servicePointId", "deviceId", "result_rD"),
        ["servicePointId", "deviceId"],
        "inner",
    )


def join_variable_flags(df: DataFrame, variable: DataFrame) -> DataFrame:
    """Readings of known variables, with ``result_sPV, toStock, lastReadDate``."""
    key = ["variableId", "servicePointId", "readingType"]
    return df.join(
        variable.select(*key, "result_sPV", "toStock", "lastReadDate"), key, "inner"
    )


def require_timezone(df: DataFrame) -> DataFrame:
    return df.filter(F.col("servicePointTimeZone").isNotNull())


def add_utc(df: DataFrame) -> DataFrame:
    """Time texts as timestamps, the UTC time and its date and week keys."""
    local = times.as_time(F.col("readingLocalTime"))
    timed = df.withColumns(
        {
            "readingLocalTime": local,
            "readingDateSource": times.as_time(F.col("readingDateSource")),
            "readingUtcLocalTime": times.to_utc(local, F.col("servicePointTimeZone")),
        }
    )
    return timed.withColumns(
        {
            "idDateYmd": times.date_key(F.col("readingUtcLocalTime")),
            "idDateYw": times.week_key(F.col("readingUtcLocalTime")),
        }
    )
