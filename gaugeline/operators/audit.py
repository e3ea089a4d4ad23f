"""Audit records as tables: one JSON message per rejected or filled reading, per
validated series and per processed file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import fixed_values as fv
from gaugeline.functions.times import time_text
from gaugeline.operators.intervals import is_outage
from gaugeline.operators.quality import REASON
from gaugeline.settings import Settings


def _message(
    category: dict[str, Column], source: str, stamp: str, settings: Settings
) -> Column:
    data = F.struct(
        F.lit(fv.AUDIT_MESSAGE).alias("message"),
        F.lit(fv.AUDIT_LEVEL).alias("logLevel"),
        F.struct(*[c.alias(name) for name, c in category.items()]).alias("category"),
        F.col("readingsSource").alias("hes"),
    )
    envelope = F.struct(
        F.lit(settings.audit_target).alias("target"),
        F.lit(settings.audit_event_type).alias("eventType"),
        F.array(data).alias("data"),
        F.lit(source).alias("source"),
        F.col("guidFile").alias("transactionId"),
        F.col("owner").alias("owner"),
        F.lit(fv.AUDIT_USER).alias("userId"),
        F.lit(stamp).alias("datestamp"),
        F.lit(source).alias("process"),
    )
    return F.to_json(envelope, {"ignoreNullFields": "false"})


def _text(column: Column) -> Column:
    return column.cast("string")


def reject_actions(rejected: DataFrame) -> DataFrame:
    late = F.col(REASON) == fv.REASON_WINDOW
    return rejected.withColumns(
        {
            "categoryAction": F.when(late, fv.ACTION_DISCARD_TIME).otherwise(
                fv.ACTION_DISCARD
            ),
            "categoryResult": F.lit(fv.RESULT_DISCARDED),
        }
    )


def fill_actions(filled: DataFrame, settings: Settings) -> DataFrame:
    """Gap rows filled for a power outage. Expects ``quality_flag`` of the reading
    before the gap and ``isOriginal``."""
    action = fv.ACTION_ZERO_FILL if settings.fill_with_zero else fv.ACTION_NULL_FILL
    return filled.filter(
        ~F.col("isOriginal") & is_outage(F.col("quality_flag"), settings)
    ).withColumns(
        {"categoryAction": F.lit(action), "categoryResult": F.lit(fv.RESULT_FILLED)}
    )


_AUDITED = [
    "guidFile", "readingType", "variableId", "readingUtcLocalTime", "servicePointId",
    "deviceId", "readingsSource", "owner", "categoryAction", "categoryResult",
]


def reading_audit(
    rejected: DataFrame, filled: DataFrame, settings: Settings, stamp: str
) -> DataFrame:
    """One record per rejected reading and per outage gap row."""
    rows = reject_actions(rejected).select(*_AUDITED).unionByName(
        fill_actions(filled, settings).select(*_AUDITED)
    )
    source, process = fv.AUDIT_PROCESS["clean"]
    taken = time_text(F.col("readingUtcLocalTime"))
    category = {
        "category_name": F.lit(fv.AUDIT_READINGS),
        "guid_file": F.col("guidFile"),
        "process": F.lit(process),
        "action": F.col("categoryAction"),
        "entity_1": F.col("readingType"),
        "id_1": F.col("variableId"),
        "reading_type": F.col("readingType"),
        "start_timestamp": taken,
        "end_timestamp": taken,
        "service_point": F.col("servicePointId"),
        "device": F.col("deviceId"),
        "cant_readings": F.lit(""),
        "result": F.col("categoryResult"),
    }
    return rows.select(
        "guidFile", "owner", "readingsSource", "servicePointId", "deviceId",
        "readingType", "variableId", "readingUtcLocalTime",
        "categoryAction", "categoryResult",
        _message(category, source, stamp, settings).alias("message"),
    )


def interval_audit(
    summary: DataFrame, stamp: str, settings: Settings = Settings()
) -> DataFrame:
    """One record per series. Expects ``series_summary`` with the attributes
    ``readingType, guidFile, owner, readingsSource``. The count is that of the
    readings when complete, of the missing ones when not."""
    _, process = fv.AUDIT_PROCESS["clean"]
    count = F.when(F.col("result") == fv.RESULT_SUCCESS, F.col("actual")).otherwise(
        F.col("missing")
    )
    counted = summary.withColumn("readings", count)
    category = {
        "category_name": F.lit(fv.AUDIT_READINGS),
        "guid_file": F.col("guidFile"),
        "process": F.lit(process),
        "action": F.lit(fv.ACTION_VALIDATION),
        "entity_1": F.col("readingType"),
        "id_1": F.col("variableId"),
        "reading_type": F.col("readingType"),
        "start_timestamp": time_text(F.col("minTime")),
        "end_timestamp": time_text(F.col("maxTime")),
        "service_point": F.col("servicePointId"),
        "device": F.col("deviceId"),
        "cant_readings": F.col("readings"),
        "result": F.col("result"),
    }
    message = _message(category, fv.AUDIT_VALIDATION_SOURCE, stamp, settings)
    return counted.select(
        "guidFile", "owner", "readingsSource", "servicePointId", "deviceId",
        "readingType", "variableId", "minTime", "maxTime", "readings", "result",
        message.alias("message"),
    )


_FILE = ["guidFile", "owner", "readingsSource"]


def stage_audit(
    df: DataFrame, stage: str, status: str, stamp: str, settings: Settings = Settings()
) -> DataFrame:
    """One record per file with its number of rows at the start or end of a
    stage."""
    counted = df.groupBy(*_FILE).agg(F.count(F.lit(1)).alias("registerCount"))
    return _stage_records(counted.withColumn("status", F.lit(status)), stage, stamp, settings)


def lifecycle_audit(
    before: DataFrame, after: DataFrame, stage: str, stamp: str, settings: Settings = Settings(),
    rows: str | None = None,
) -> DataFrame:
    """Two records per file, of the start and the end of a stage, with the rows that went
    in and that came out: none, for a file that lost all of its rows. Both tables are read
    in the columns of the file only and counted in one aggregate. ``rows`` names a column
    of ``after`` that says how many rows each of its rows stands for."""
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    came = before.select(*_FILE, one.alias("_in"), none.alias("_out"))
    went = after.select(*_FILE, none.alias("_in"), (F.col(rows) if rows else one).alias("_out"))
    both = came.unionByName(went).groupBy(*_FILE)
    counted = both.agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out"))
    record = lambda status, count: F.struct(F.lit(status).alias("status"), F.col(count).alias("registerCount"))
    each = counted.select(
        *_FILE, F.inline(F.array(record(fv.STAGE_STARTED, "_in"), record(fv.STAGE_ENDED, "_out")))
    )
    return _stage_records(each, stage, stamp, settings)


def _stage_records(counted: DataFrame, stage: str, stamp: str, settings: Settings) -> DataFrame:
    source, process = fv.AUDIT_PROCESS[stage]
    category = {
        "category_name": F.lit(fv.AUDIT_LIFECYCLE),
        "guid_file": F.col("guidFile"),
        "process": F.lit(process),
        "status": F.col("status"),
        "register_count": _text(F.col("registerCount")),
        "event_timestamp": F.lit(stamp),
    }
    return counted.select(
        *_FILE,
        F.lit(process).alias("stage"),
        "status",
        "registerCount",
        _message(category, source, stamp, settings).alias("message"),
    )
