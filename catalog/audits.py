"""Audit records."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import AS_OF, READINGS, STAMP, event_readings, query, shown, sql_time
from catalog.cleaning import SETTINGS as WINDOW
from catalog.intervals import PROFILE, SETTINGS, profile_readings
from gaugeline.operators import audit, intervals as iv, quality
from gaugeline.plans.stages import lifecycle


_series = "servicePointId, deviceId, meteringType, variableId, logNumber"


def _audit_fields(df, *names):
    """Fields of the JSON message next to the plain columns."""
    paths = {
        "action": "$.data[0].category.action",
        "start": "$.data[0].category.start_timestamp",
        "readings_text": "$.data[0].category.cant_readings",
        "transaction": "$.transactionId",
        "count_text": "$.data[0].category.register_count",
        "process": "$.process",
        "hes": "$.data[0].hes",
    }
    return df.select(
        *df.columns, *[F.get_json_object("message", paths[n]).alias(n) for n in names]
    ).drop("message")


@query(
    "a01_reading_audit",
    f"""WITH {PROFILE}, dated AS (
 SELECT *, greatest(CAST(left(lastReadDate, 10) AS DATE),
   CAST(left(relationStartDate, 10) AS DATE)) AS opening,
  CAST(readingUtcLocalTime AS DATE) AS day,
  readingType = 'LOAD PROFILE READING' AS profile FROM readings),
 refused AS (SELECT *, CASE WHEN result_rD IS NOT TRUE OR readingUtcLocalTime IS NULL
   THEN 'Discard' WHEN coalesce(day >= opening - CASE WHEN profile THEN 3 ELSE 6 END
    AND day <= DATE '2024-01-25' + CASE WHEN profile THEN 1 ELSE 2 END, FALSE)
   THEN NULL ELSE 'Discard lapse time' END AS action FROM dated),
 rows AS (SELECT guidFile, owner, readingsSource, servicePointId, readingType, variableId,
   readingUtcLocalTime AS t, action, 'Discarded' AS result FROM refused
   WHERE action IS NOT NULL
  UNION ALL SELECT guidFile, owner, readingsSource, servicePointId, readingType, variableId,
   step, 'ZeroFilling', 'Filled' FROM marked
   WHERE NOT isOriginal AND quality_flag = '1-2-32')
 SELECT guidFile, owner, readingsSource AS hes, servicePointId, readingType, variableId,
  {sql_time('t')} AS readingUtcLocalTime, {sql_time('t')} AS start, action,
  result AS categoryResult, guidFile AS transaction FROM rows""",
)
def a01(spark, sf):
    flagged = quality.require_utc(quality.reject_unassociated(event_readings(spark, sf)))
    flagged = quality.reject_out_of_window(flagged, WINDOW, AS_OF)
    _, rejected = quality.split(flagged)
    filled = iv.fill_gaps(iv.quality_flag(profile_readings(spark, sf)))
    records = audit.reading_audit(rejected, filled, SETTINGS, STAMP)
    return _audit_fields(
        shown(records), "action", "start", "transaction", "hes"
    ).drop("readingsSource", "deviceId", "categoryAction")


@query(
    "a02_interval_audit",
    f"""WITH {PROFILE}, audited AS (SELECT {_series} , min(step) AS minTime, max(step) AS maxTime,
  date_diff('minute', min(step), max(step)) // 60 + 1 AS expected,
  count(intervalMark) AS actual, min(owner) AS owner, min(guidFile) AS guidFile
  FROM marked GROUP BY {_series})
 SELECT guidFile, owner, servicePointId, deviceId, variableId,
  {sql_time('minTime')} AS minTime, {sql_time('maxTime')} AS maxTime,
  CAST(CASE WHEN expected = actual THEN actual ELSE expected - actual END AS BIGINT)
   AS readings,
  CASE WHEN expected = actual THEN 'Successful' ELSE 'Failed' END AS result,
  'Interval Validation' AS action, {sql_time('minTime')} AS start, 'VALIDATION' AS process,
  CAST(CASE WHEN expected = actual THEN actual ELSE expected - actual END AS VARCHAR)
   AS readings_text FROM audited""",
)
def a02(spark, sf):
    filled = iv.fill_gaps(iv.quality_flag(profile_readings(spark, sf)))
    mark = iv.interval_mark(F.col("quality_flag"), F.col("isOriginal"), SETTINGS)
    summary = iv.series_summary(
        filled.withColumn("intervalMark", mark),
        attributes=["readingType", "guidFile", "owner", "readingsSource"],
    )
    records = audit.interval_audit(summary, STAMP)
    return _audit_fields(
        shown(records), "action", "start", "process", "readings_text"
    ).drop("readingsSource", "readingType")


@query(
    "a03_stage_audit",
    f"""WITH {READINGS} SELECT guidFile, owner, readingsSource, 'Enrich' AS stage,
 'processing_ended' AS status, count(*) AS registerCount, 'ENRICHMENT' AS process,
 CAST(count(*) AS VARCHAR) AS count_text, guidFile AS transaction FROM readings
 GROUP BY guidFile, owner, readingsSource""",
)
def a03(spark, sf):
    records = audit.stage_audit(
        event_readings(spark, sf), "enrich", "processing_ended", STAMP
    )
    return _audit_fields(records, "process", "count_text", "transaction")


@query(
    "a03_lifecycle_audit",
    f"""WITH {READINGS}, files AS (SELECT guidFile, owner, readingsSource, count(*) AS came,
  count(*) FILTER (WHERE readingUtcLocalTime IS NOT NULL AND day(readingLocalTime) > 2) AS went FROM readings GROUP BY ALL)
 SELECT guidFile, owner, readingsSource, 'Enrich' AS stage, status, n AS registerCount, 'ENRICHMENT' AS process,
  CAST(n AS VARCHAR) AS count_text, guidFile AS transaction
 FROM (SELECT *, 'processing_started' AS status, came AS n FROM files
  UNION ALL SELECT *, 'processing_ended', went FROM files)""",
)
def a03_lifecycle(spark, sf):
    """What came in and went out of each file; those of two days lose all their rows."""
    readings = event_readings(spark, sf)
    kept = readings.filter(F.col("readingUtcLocalTime").isNotNull() & (F.day("readingLocalTime") > 2))
    records = lifecycle("enrich", readings, kept, STAMP)
    return _audit_fields(records, "process", "count_text", "transaction")
