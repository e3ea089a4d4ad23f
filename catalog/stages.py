"""The clean stage as a whole: every step on all event readings, with stored
versions of a part of them."""

from __future__ import annotations

from pyspark.sql import functions as F

import gaugeline as g
from catalog.audits import _audit_fields
from catalog.base import AS_OF, READINGS, event_readings, query, shown, sql_time
from catalog.cleaning import _KEY, _VERSION_KEY
from catalog.intervals import _SERIES, FLAG_SQL, SERIES_SQL
from gaugeline import schema as S
from gaugeline.functions import times
from gaugeline.operators import enrich as en

SETTINGS = g.Settings(
    load_profile_past_days=3,
    load_profile_future_days=1,
    other_past_days=6,
    other_future_days=2,
    fill_with_zero=True,
    outage_flags=("1-2-32",),
)


def _enriched(spark, sf):
    df = en.init_version(en.add_ids(event_readings(spark, sf), AS_OF))
    utc = F.col("readingUtcLocalTime")
    df = df.withColumns({"idDateYmd": times.date_key(utc), "idDateYw": times.week_key(utc)})
    missing = [c for c in S.READING_COLUMNS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in missing})


def _stored(spark, sf):
    number = F.col("identReading")
    # Views are stored under another owner, so that they are new here.
    owner = F.when(F.col("variableId") == "view", F.concat(F.lit("FORMER-"), "owner"))
    known = event_readings(spark, sf).withColumn("owner", F.coalesce(owner, "owner"))
    return known.select(
        *S.VERSION_KEY,
        "readingType",
        F.when(number % 2 == 0, F.col("readingsValue")).otherwise("99").alias("readingsValue"),
        (number % 4 + 1).cast("int").alias("version"),
        F.concat(F.lit("E"), number % 4).alias("estimationReading"),
        F.lit(None).cast("string").alias("estimationValid"),
        F.lit(None).cast("string").alias("editionReading"),
        F.lit("true").alias("editionValid"),
    )


def _cleaned(spark, sf):
    return g.clean(_enriched(spark, sf), _stored(spark, sf), SETTINGS, AS_OF)


_DECIDED = (
    READINGS
    + f""",
dated AS (SELECT *, greatest(CAST(left(lastReadDate, 10) AS DATE),
   CAST(left(relationStartDate, 10) AS DATE)) AS opening,
  CAST(readingUtcLocalTime AS DATE) AS day,
  readingType = 'LOAD PROFILE READING' AS lp FROM readings),
flagged AS (SELECT *, CASE WHEN readingType IS NULL
   OR readingType NOT IN ('LOAD PROFILE READING', 'REGISTERS', 'EVENTS') THEN 'unknown reading type'
  WHEN result_rD IS NOT TRUE THEN 'Estado de asociacion'
  WHEN result_sPV IS NOT TRUE OR toStock IS NOT TRUE THEN 'result variable - to stock '
  WHEN readingUtcLocalTime IS NULL THEN 'missing utc time'
  WHEN day >= opening - CASE WHEN lp THEN 3 ELSE 6 END
   AND day <= DATE '2024-01-25' + CASE WHEN lp THEN 1 ELSE 2 END THEN NULL
  ELSE 'dias pasado-futuro' END AS reason FROM dated),
ranked AS (SELECT *, row_number() OVER
   (PARTITION BY {_KEY}, readingsValue ORDER BY identReading) AS i,
  count(*) OVER (PARTITION BY {_KEY}, readingsValue) AS copies
 FROM flagged WHERE reason IS NULL),
counted AS (SELECT *, count(*) OVER (PARTITION BY {_KEY}) AS n FROM ranked WHERE i = 1),
stored AS (SELECT {_VERSION_KEY}, CASE WHEN identReading % 2 = 0 THEN readingsValue
   ELSE '99' END AS storedValue, CAST(identReading % 4 + 1 AS INTEGER) AS storedVersion
 FROM (SELECT * REPLACE (CASE WHEN variableId = 'view' THEN 'FORMER-' || owner ELSE owner END
   AS owner) FROM readings) WHERE readingType <> 'EVENTS'
  AND readingUtcLocalTime >= (SELECT min(readingUtcLocalTime) FROM flagged
   WHERE reason IS NULL AND readingType <> 'EVENTS')),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_VERSION_KEY}
  ORDER BY storedVersion DESC, storedValue) AS r FROM stored) WHERE r = 1),
decided AS (SELECT c.*,
  CASE WHEN c.readingType = 'EVENTS' THEN 1 ELSE coalesce(storedVersion + 1, 1) END AS version,
  CASE WHEN n > 1 THEN 'Valores inconsitentes'
   WHEN c.readingType <> 'EVENTS' AND storedValue = c.readingsValue
   THEN 'Versionamiento duplicados' END AS later
 FROM counted c LEFT JOIN latest l ON c.servicePointId = l.servicePointId
  AND c.variableId = l.variableId AND c.logNumber IS NOT DISTINCT FROM l.logNumber
  AND c.readingUtcLocalTime = l.readingUtcLocalTime AND c.meteringType = l.meteringType
  AND c.readingsSource = l.readingsSource AND c.owner = l.owner)"""
)


@query(
    "clean_rejected",
    f"""WITH {_DECIDED}
 SELECT identReading, servicePointId, variableId, reason AS rejectReason FROM flagged
  WHERE reason IS NOT NULL
 UNION ALL SELECT identReading, servicePointId, variableId, later FROM decided
  WHERE later IS NOT NULL
 UNION ALL SELECT identReading, servicePointId, variableId, 'Duplicados' FROM decided
  WHERE copies > 1""",
)
def clean_rejected(spark, sf):
    return _cleaned(spark, sf).rejected.select(
        "identReading", "servicePointId", "variableId", "rejectReason"
    )


@query(
    "clean_accepted",
    f"""WITH {_DECIDED},
profile AS (SELECT *, {FLAG_SQL} FROM decided WHERE later IS NULL AND lp),
{SERIES_SQL},
used AS (
 SELECT m.servicePointId, m.variableId, m.readingType, step AS t, filledValue AS v,
  multiplier, version, CASE WHEN isOriginal THEN identReading END AS number,
  (expected = actual OR intervalMark IS NOT NULL) AS usageValid
 FROM marked m JOIN summary s ON m.servicePointId = s.servicePointId
  AND m.variableId = s.variableId AND m.logNumber IS NOT DISTINCT FROM s.logNumber
 UNION ALL SELECT servicePointId, variableId, readingType, readingUtcLocalTime,
  readingsValue, multiplier, version, identReading, NULL FROM decided
  WHERE later IS NULL AND NOT lp)
 SELECT servicePointId, variableId, readingType, {sql_time('t')} AS readingUtcLocalTime,
  CAST(v AS FLOAT) AS readingsValue, CAST(version AS INTEGER) AS version,
  CAST(number AS BIGINT) AS identReading, usageValid,
  CAST(strftime(t, '%Y%m%d') AS INTEGER) AS idDateYmd,
  CAST(CASE WHEN readingType = 'EVENTS' OR multiplier IS NULL THEN NULL
   WHEN multiplier LIKE '%0.25%' THEN 0.75 * CAST(v AS DOUBLE)
   ELSE CAST(v AS DOUBLE) END AS FLOAT) AS usageReading FROM used""",
)
def clean_accepted(spark, sf):
    return shown(
        _cleaned(spark, sf).accepted,
        "servicePointId", "variableId", "readingType", "readingUtcLocalTime",
        "readingsValue", "version", "identReading", "usageValid", "idDateYmd",
        "usageReading",
    )


_FILLED = f"""{_DECIDED},
profile AS (SELECT *, {FLAG_SQL} FROM decided WHERE later IS NULL AND lp),
{SERIES_SQL}"""


@query(
    "clean_reading_audit",
    f"""WITH {_FILLED}, rows AS (
 SELECT guidFile, owner, servicePointId, deviceId, readingType, variableId, readingUtcLocalTime AS t,
  CASE WHEN reason = 'dias pasado-futuro' THEN 'Discard lapse time' ELSE 'Discard' END AS action,
  'Discarded' AS result FROM flagged WHERE reason IS NOT NULL
 UNION ALL SELECT guidFile, owner, servicePointId, deviceId, readingType, variableId, readingUtcLocalTime,
  'Discard', 'Discarded' FROM decided WHERE later IS NOT NULL
 UNION ALL SELECT guidFile, owner, servicePointId, deviceId, readingType, variableId, readingUtcLocalTime,
  'Discard', 'Discarded' FROM decided WHERE copies > 1
 UNION ALL SELECT guidFile, owner, servicePointId, deviceId, readingType, variableId, step,
  'ZeroFilling', 'Filled' FROM marked WHERE NOT isOriginal AND quality_flag = '1-2-32')
 SELECT guidFile, owner, servicePointId, deviceId, readingType, variableId,
  {sql_time('t')} AS readingUtcLocalTime, action, result AS categoryResult, {sql_time('t')} AS start,
  guidFile AS transaction, 'HES' AS hes FROM rows""",
)
def clean_reading_audit(spark, sf):
    records = shown(_cleaned(spark, sf).reading_audit)
    return _audit_fields(records, "action", "start", "transaction", "hes").drop("readingsSource", "categoryAction")


@query(
    "clean_interval_audit",
    f"""WITH {_FILLED}, audited AS (SELECT {_SERIES}, min(step) AS minTime, max(step) AS maxTime,
  date_diff('minute', min(step), max(step)) // 60 + 1 AS expected,
  count(intervalMark) AS actual, min(owner) AS owner, min(guidFile) AS guidFile FROM marked GROUP BY {_SERIES})
 SELECT guidFile, owner, servicePointId, deviceId, variableId, {sql_time('minTime')} AS minTime,
  {sql_time('maxTime')} AS maxTime,
  CAST(CASE WHEN expected = actual THEN actual ELSE expected - actual END AS BIGINT) AS readings,
  CASE WHEN expected = actual THEN 'Successful' ELSE 'Failed' END AS result,
  'Interval Validation' AS action, 'VALIDATION' AS process FROM audited""",
)
def clean_interval_audit(spark, sf):
    records = shown(_cleaned(spark, sf).interval_audit)
    return _audit_fields(records, "action", "process").drop("readingsSource", "readingType")


@query(
    "clean_lifecycle_audit",
    f"""WITH {_FILLED}, files AS (SELECT guidFile, owner, readingsSource, 1 AS came, 0 AS went FROM flagged
 UNION ALL SELECT guidFile, owner, readingsSource, 0, 1 FROM decided WHERE later IS NULL AND NOT lp
 UNION ALL SELECT guidFile, owner, readingsSource, 0, 1 FROM marked),
 per_file AS (SELECT guidFile, owner, readingsSource, CAST(sum(came) AS BIGINT) AS came, CAST(sum(went) AS BIGINT) AS went
  FROM files GROUP BY ALL)
 SELECT guidFile, owner, readingsSource, 'Cleaning' AS stage, status, n AS registerCount,
  'CLEANING' AS process, CAST(n AS VARCHAR) AS count_text
 FROM (SELECT *, 'processing_started' AS status, came AS n FROM per_file
  UNION ALL SELECT *, 'processing_ended', went FROM per_file)""",
)
def clean_lifecycle_audit(spark, sf):
    return _audit_fields(_cleaned(spark, sf).lifecycle_audit, "process", "count_text")


_NONE = dict.fromkeys(
    "dstStatus primarySource estatus registersNumber eventsCode agentId agentDescription deviceMaster "
    "deviceDescription serial accountNumber connectionType relationEndDate deviceType "
    "estimationValid editionReading".split(),
    "NULL::VARCHAR",
)
_SAME = {
    **_NONE,
    "deviceStatus": "'ENABLE'",
    "idVdi": "NULL::BIGINT",
    "idenEvent": "NULL::BIGINT",
    "dateCreation": "DATE '2024-01-25'",
    "estimationReading": "NULL::FLOAT",
    "editionReading": "NULL::FLOAT",
    "editionValid": "CASE WHEN readingType <> 'EVENTS' AND version > 1 THEN 'true' END",
    "version": "CAST(version AS INTEGER)",
}
_USED = """CAST(CASE WHEN readingType = 'EVENTS' OR multiplier IS NULL THEN NULL
   WHEN multiplier LIKE '%0.25%' THEN 0.75 * CAST({v} AS DOUBLE) ELSE CAST({v} AS DOUBLE) END AS FLOAT)"""


def _dated(time: str) -> dict[str, str]:
    return {
        "readingUtcLocalTime": sql_time(time),
        "idDateYmd": f"CAST(strftime({time}, '%Y%m%d') AS INTEGER)",
        "idDateYw": f"CAST(CAST(isoyear({time}) AS VARCHAR) || CAST(week({time}) AS VARCHAR) AS INTEGER)",
    }


_LOCAL = sql_time("CASE WHEN isOriginal THEN readingLocalTime ELSE step + to_minutes(CAST(hours * 60 AS INTEGER)) END")
_PROFILE_ROW = {
    **_SAME,
    **_dated("step"),
    "readingLocalTime": _LOCAL,
    "readingDateSource": _LOCAL,
    **{c: f"CASE WHEN isOriginal THEN {c} END" for c in ("qualityCodesSystemId", "qualityCodesCategorization", "qualityCodesIndex")},
    "identReading": "CAST(CASE WHEN isOriginal THEN identReading END AS BIGINT)",
    "readingsValue": "CAST(filledValue AS FLOAT)",
    "usageReading": _USED.format(v="filledValue"),
    "usageValid": "complete OR intervalMark IS NOT NULL",
    "ValidationDetail": "CASE WHEN NOT (complete OR intervalMark IS NOT NULL) THEN '{''Usage'':{''IntervalsError'':''Interval not exist''}}' END",
    "IsGrouped": "FALSE",
}
_OTHER_ROW = {
    **_SAME,
    **_dated("readingUtcLocalTime"),
    "readingLocalTime": sql_time("readingLocalTime"),
    "readingDateSource": "NULL::VARCHAR",
    "identReading": "CAST(identReading AS BIGINT)",
    "readingsValue": "CAST(readingsValue AS FLOAT)",
    "usageReading": _USED.format(v="readingsValue"),
    "usageValid": "NULL::BOOLEAN",
    "ValidationDetail": "NULL::VARCHAR",
    "IsGrouped": "NULL::BOOLEAN",
}


def _final(row: dict[str, str]) -> str:
    return ", ".join(f"{row.get(c, c)} AS {c}" for c in S.FINAL_COLUMNS)


@query(
    "clean_accepted_whole",
    f"""WITH {_FILLED},
judged AS (SELECT m.*, expected = actual AS complete, hours FROM marked m
 JOIN summary s ON m.servicePointId = s.servicePointId AND m.variableId = s.variableId
  AND m.logNumber IS NOT DISTINCT FROM s.logNumber
 JOIN zones ON code = servicePointTimeZone)
 SELECT {_final(_PROFILE_ROW)} FROM judged
 UNION ALL SELECT {_final(_OTHER_ROW)} FROM decided WHERE later IS NULL AND NOT lp""",
)
def clean_accepted_whole(spark, sf):
    """All columns of the accepted readings."""
    return shown(_cleaned(spark, sf).accepted)
