"""Flags, window, copies, conflicts, versions and final shape."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.base import AS_OF, READINGS, event_readings, query, shown, sql_time, table
from gaugeline import schema as S
from gaugeline.functions import times
from gaugeline.operators import keyed, output, quality, versioning
from gaugeline.settings import Settings
from gaugeline.sources import store
from gaugeline.sources.scratch import fresh_path

SETTINGS = Settings(
    load_profile_past_days=3,
    load_profile_future_days=1,
    other_past_days=6,
    other_future_days=2,
)

_KEY = "servicePointId, deviceId, meteringType, variableId, readingLocalTime, logNumber"


@query(
    "c01_reject_unassociated",
    f"""WITH {READINGS} SELECT identReading, servicePointId, variableId,
 CASE WHEN result_rD THEN NULL ELSE 'Estado de asociacion' END AS rejectReason
 FROM readings""",
)
def c01(spark, sf):
    df = quality.reject_unassociated(event_readings(spark, sf))
    return df.select("identReading", "servicePointId", "variableId", "rejectReason")


@query(
    "c02_reject_unstorable",
    f"""WITH {READINGS} SELECT identReading, servicePointId, variableId,
 CASE WHEN result_rD IS NOT TRUE THEN 'Estado de asociacion'
  WHEN result_sPV IS NOT TRUE OR toStock IS NOT TRUE THEN 'result variable - to stock '
  END AS rejectReason FROM readings""",
)
def c02(spark, sf):
    df = quality.reject_unassociated(event_readings(spark, sf))
    df = quality.reject_unstorable(df)
    return df.select("identReading", "servicePointId", "variableId", "rejectReason")


@query(
    "c03_require_utc",
    f"""WITH {READINGS} SELECT identReading, servicePointId,
 {sql_time('readingUtcLocalTime')} AS readingUtcLocalTime,
 CASE WHEN readingUtcLocalTime IS NULL THEN 'missing utc time' END AS rejectReason
 FROM readings""",
)
def c03(spark, sf):
    df = quality.require_utc(event_readings(spark, sf))
    return shown(
        df, "identReading", "servicePointId", "readingUtcLocalTime", "rejectReason"
    )


@query(
    "c04_reject_out_of_window",
    f"""WITH {READINGS}, dated AS (
 SELECT *, greatest(CAST(left(lastReadDate, 10) AS DATE),
   CAST(left(relationStartDate, 10) AS DATE)) AS opening,
  CAST(readingUtcLocalTime AS DATE) AS day,
  readingType = 'LOAD PROFILE READING' AS profile FROM readings)
 SELECT identReading, {sql_time('readingUtcLocalTime')} AS readingUtcLocalTime,
  CASE WHEN day >= opening - CASE WHEN profile THEN 3 ELSE 6 END
   AND day <= DATE '2024-01-25' + CASE WHEN profile THEN 1 ELSE 2 END
   THEN NULL ELSE 'dias pasado-futuro' END AS rejectReason FROM dated""",
)
def c04(spark, sf):
    df = quality.reject_out_of_window(event_readings(spark, sf), SETTINGS, AS_OF)
    return shown(df, "identReading", "readingUtcLocalTime", "rejectReason")


_COPY_COLUMNS = [
    "servicePointId", "variableId", "readingLocalTime", "logNumber", "readingsValue",
    "identReading", "model",
]
_COPY_SQL = f"""servicePointId, variableId,
 {sql_time('readingLocalTime')} AS readingLocalTime, logNumber, readingsValue,
 identReading, model"""


@query(
    "c05_duplicate_report",
    f"""WITH {READINGS}, ranked AS (
 SELECT *, count(*) OVER (PARTITION BY {_KEY}, readingsValue) AS n,
  row_number() OVER (PARTITION BY {_KEY}, readingsValue ORDER BY identReading) AS i
 FROM readings)
 SELECT {_COPY_SQL}, 'Duplicados' AS rejectReason FROM ranked WHERE n > 1 AND i = 1""",
)
def c05(spark, sf):
    df = quality.duplicate_report(event_readings(spark, sf))
    return shown(df, *_COPY_COLUMNS, "rejectReason")


@query(
    "c06_drop_duplicates",
    f"""WITH {READINGS}, ranked AS (
 SELECT *, row_number() OVER
  (PARTITION BY {_KEY}, readingsValue ORDER BY identReading) AS i FROM readings)
 SELECT {_COPY_SQL} FROM ranked WHERE i = 1""",
)
def c06(spark, sf):
    return shown(quality.drop_duplicates(event_readings(spark, sf)), *_COPY_COLUMNS)


@query(
    "c07_conflict_rejects",
    f"""WITH {READINGS}, ranked AS (
 SELECT *, row_number() OVER
  (PARTITION BY {_KEY}, readingsValue ORDER BY identReading) AS i FROM readings),
 counted AS (SELECT *, count(*) OVER (PARTITION BY {_KEY}) AS n FROM ranked WHERE i = 1)
 SELECT {_COPY_SQL},
  CASE WHEN n > 1 THEN 'Valores inconsitentes' END AS rejectReason FROM counted""",
)
def c07(spark, sf):
    df = quality.reject_conflicts(quality.drop_duplicates(event_readings(spark, sf)))
    return shown(df, *_COPY_COLUMNS, "rejectReason")


@query(
    "c07_resolve_duplicates",
    f"""WITH {READINGS}, ranked AS (
 SELECT *, row_number() OVER
  (PARTITION BY {_KEY}, readingsValue ORDER BY identReading) AS i,
  count(*) OVER (PARTITION BY {_KEY}, readingsValue) AS copies FROM readings),
 counted AS (SELECT *, count(*) OVER (PARTITION BY {_KEY}) AS n FROM ranked WHERE i = 1)
 SELECT {_COPY_SQL}, copies,
  CASE WHEN n > 1 THEN 'Valores inconsitentes' END AS rejectReason FROM counted""",
)
def c07_resolve(spark, sf):
    df = quality.resolve_duplicates(event_readings(spark, sf))
    return shown(df, *_COPY_COLUMNS, "copies", "rejectReason")


@query(
    "c07a_set_difference",
    """SELECT l_orderkey AS orderkey, l_suppkey AS suppkey FROM lineitem
 EXCEPT SELECT o_orderkey, o_custkey FROM orders""",
)
def c07a_difference(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_suppkey").alias("suppkey")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return keyed.set_difference(lines, orders)


@query(
    "c07a_anti_join",
    """SELECT l_orderkey, l_linenumber, nullif(l_linenumber, 7) AS logNumber
 FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey
  AND nullif(o_custkey % 8, 7) IS NOT DISTINCT FROM nullif(l_linenumber, 7))""",
)
def c07a_anti(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("logNumber"),
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.nullif(F.col("o_custkey") % 8, F.lit(7)).cast("int").alias("logNumber"),
    )
    return keyed.anti_join(lines, orders, ["l_orderkey", "logNumber"])


# Stored readings: all orders in up to three versions, a sixth under another owner,
# some without a value or with a first version that is no number. New ones: all
# orders, some with another total, some unseen, some events.
_STORED_SQL = """stored AS (
 SELECT 'SP-' || o_custkey AS servicePointId, o_orderpriority AS variableId,
  CASE WHEN o_orderkey % 4 <> 0 THEN 1 END AS logNumber,
  o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS readingUtcLocalTime,
  'MAIN' AS meteringType, 'HES' AS readingsSource,
  CASE WHEN o_orderkey % 6 = 0 THEN 'FORMER-' ELSE 'OWNER-' END || o_orderkey AS owner,
  CASE WHEN o_orderkey % 10 <> 0
   THEN CAST(CAST(floor(o_totalprice + v) AS INTEGER) AS VARCHAR) || ' ' END AS readingsValue,
  CASE WHEN o_orderkey % 9 = 0 AND v = 1 THEN 'none' ELSE CAST(v AS VARCHAR) END AS version, 'E' || v AS estimationReading,
  'true' AS estimationValid, NULL::VARCHAR AS editionReading, 'D' || v AS editionValid
 FROM orders, (VALUES (1), (2), (3)) AS copies(v)
 WHERE v <= 1 + o_orderkey % 3)"""

_NEW_SQL = """fresh AS (
 SELECT o_orderkey AS identReading, 'SP-' || o_custkey AS servicePointId,
  o_orderpriority AS variableId, CASE WHEN o_orderkey % 4 <> 0 THEN 1 END AS logNumber,
  o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS readingUtcLocalTime,
  'MAIN' AS meteringType, 'HES' AS readingsSource, 'OWNER-' || o_orderkey AS owner,
  CASE o_orderstatus WHEN 'O' THEN 'REGISTERS' WHEN 'F' THEN 'LOAD PROFILE READING'
   ELSE 'EVENTS' END AS readingType,
  CAST(CAST(floor(o_totalprice + 1 + o_orderkey % 3 - CASE WHEN o_orderkey % 5 = 0
   THEN 1 ELSE 0 END) AS INTEGER) AS VARCHAR) AS readingsValue, 1 AS version
 FROM orders)"""


def _order_key(number):
    minutes = F.timestamp_add("MINUTE", number % 1440, F.col("o_orderdate"))
    return [
        F.concat(F.lit("SP-"), "o_custkey").alias("servicePointId"),
        F.col("o_orderpriority").alias("variableId"),
        F.when(number % 4 != 0, 1).alias("logNumber"),
        minutes.alias("readingUtcLocalTime"),
        F.lit("MAIN").alias("meteringType"),
        F.lit("HES").alias("readingsSource"),
        F.concat(F.lit("OWNER-"), number).alias("owner"),
    ]


def stored_readings(spark, sf):
    number, v = F.col("o_orderkey"), F.col("v")
    versions = F.sequence(F.lit(1), (F.lit(1) + number % 3).cast("int"))
    # One order in six is stored under another owner, so that it is new below.
    copies = table(spark, sf, "orders").withColumn("v", F.explode(versions))
    return copies.select(
        *_order_key(number)[:-1],
        F.concat(F.when(number % 6 == 0, "FORMER-").otherwise("OWNER-"), number).alias("owner"),
        F.when(
            number % 10 != 0,
            F.concat(F.floor(F.col("o_totalprice") + v).cast("int"), F.lit(" ")),
        ).alias("readingsValue"),
        F.when((number % 9 == 0) & (v == 1), "none").otherwise(v.cast("string")).alias("version"),
        F.concat(F.lit("E"), v).alias("estimationReading"),
        F.lit("true").alias("estimationValid"),
        F.lit(None).cast("string").alias("editionReading"),
        F.concat(F.lit("D"), v).alias("editionValid"),
    )


def new_readings(spark, sf):
    number = F.col("o_orderkey")
    value = F.col("o_totalprice") + 1 + number % 3 - F.when(number % 5 == 0, 1).otherwise(0)
    return table(spark, sf, "orders").select(
        number.alias("identReading"),
        *_order_key(number),
        F.when(F.col("o_orderstatus") == "O", "REGISTERS")
        .when(F.col("o_orderstatus") == "F", "LOAD PROFILE READING")
        .otherwise("EVENTS")
        .alias("readingType"),
        F.floor(value).cast("int").cast("string").alias("readingsValue"),
        F.lit(1).alias("version"),
    )


_VERSION_KEY = """servicePointId, variableId, logNumber, readingUtcLocalTime, meteringType,
  readingsSource, owner"""
_LATEST_SQL = f"""latest AS (SELECT * EXCLUDE (i) FROM (
 SELECT *, row_number() OVER (PARTITION BY {_VERSION_KEY} ORDER BY TRY_CAST(version AS INTEGER) DESC NULLS LAST) AS i
 FROM stored) WHERE i = 1)"""


@query(
    "c08_latest_version",
    f"""WITH {_STORED_SQL}, {_LATEST_SQL} SELECT servicePointId, variableId, logNumber,
 {sql_time('readingUtcLocalTime')} AS readingUtcLocalTime, owner, readingsValue, version,
 estimationReading, editionReading, editionValid FROM latest""",
)
def c08(spark, sf):
    return shown(
        versioning.latest_version(stored_readings(spark, sf)),
        "servicePointId", "variableId", "logNumber", "readingUtcLocalTime", "owner",
        "readingsValue", "version", "estimationReading", "editionReading", "editionValid",
    )


@query(
    "c08_versions_of_batch",
    f"""WITH {_STORED_SQL}, {_LATEST_SQL}, {_NEW_SQL}
 SELECT l.servicePointId, l.variableId, l.logNumber, {sql_time('l.readingUtcLocalTime')} AS readingUtcLocalTime,
  l.owner, l.readingsValue, l.version FROM latest l SEMI JOIN fresh f
  ON f.servicePointId = l.servicePointId AND f.variableId = l.variableId
  AND f.logNumber IS NOT DISTINCT FROM l.logNumber AND f.readingUtcLocalTime = l.readingUtcLocalTime
  AND f.owner = l.owner AND f.readingType <> 'EVENTS'
 WHERE EXTRACT(month FROM l.readingUtcLocalTime) IN (3, 11)""",
)
def c08_batch(spark, sf):
    """All orders stored by week, and a batch of those of two months of each year."""
    kind = F.lit("REGISTERS").alias("readingType")
    name = f"versions_{uuid.uuid4().hex}"
    store.append_versions(
        stored_readings(spark, sf).select("*", kind), name, path=fresh_path(spark, "versions"), buckets=2
    )
    batch = new_readings(spark, sf).filter(F.month("readingUtcLocalTime").isin(3, 11))
    found = store.versions_of_batch(store.read_versions(spark, name), batch)
    return shown(
        versioning.latest_version(found),
        "servicePointId", "variableId", "logNumber", "readingUtcLocalTime", "owner", "readingsValue", "version",
    )


@query(
    "c09_assign_version",
    f"""WITH {_STORED_SQL}, {_LATEST_SQL}, {_NEW_SQL}
 SELECT f.identReading, f.readingType, f.readingsValue,
  CASE WHEN f.readingType = 'EVENTS' THEN f.version
   WHEN l.owner IS NULL THEN 1 ELSE coalesce(TRY_CAST(l.version AS INTEGER), 0) + 1 END AS version,
  CASE WHEN f.readingType <> 'EVENTS' AND l.owner IS NOT NULL
    AND trim(l.readingsValue) IS NOT DISTINCT FROM trim(f.readingsValue)
   THEN 'Versionamiento duplicados' END AS rejectReason,
  CASE WHEN f.readingType <> 'EVENTS' THEN l.estimationReading END AS estimationReading,
  CASE WHEN f.readingType <> 'EVENTS' THEN l.editionValid END AS editionValid
 FROM fresh f LEFT JOIN latest l
  ON f.servicePointId = l.servicePointId AND f.variableId = l.variableId
  AND f.logNumber IS NOT DISTINCT FROM l.logNumber
  AND f.readingUtcLocalTime = l.readingUtcLocalTime
  AND f.meteringType = l.meteringType AND f.readingsSource = l.readingsSource
  AND f.owner = l.owner""",
)
def c09(spark, sf):
    latest = versioning.latest_version(stored_readings(spark, sf))
    return versioning.assign_version(new_readings(spark, sf), latest).select(
        "identReading", "readingType", "readingsValue", "version", "rejectReason",
        "estimationReading", "editionValid",
    )


@query(
    "c10_usage_reading",
    """SELECT l_orderkey, l_linenumber, round(CAST(l_quantity AS INTEGER) *
  CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 1.0
   ELSE CAST(CAST(l_tax AS DECIMAL(8,2)) AS DOUBLE)
    * CASE WHEN l_returnflag = 'A' THEN 1.0
       ELSE CAST(CAST(l_discount AS DECIMAL(8,2)) AS DOUBLE) END END, 6) AS usageReading
 FROM lineitem""",
)
def c10(spark, sf):
    number = F.col("l_linenumber")
    two = lambda c: F.col(c).cast("decimal(8,2)").cast("string")
    factors = F.concat(
        F.lit("'MultiplierValues':{'ke':'"),
        F.when(number > 2, two("l_tax")).otherwise(""),
        F.lit("','sf':'"),
        F.when((number > 2) & (F.col("l_returnflag") != "A"), two("l_discount")).otherwise(""),
        F.lit("'}"),
    )
    readings = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.lit("REGISTERS").alias("readingType"),
        F.col("l_quantity").cast("int").cast("string").alias("readingsValue"),
        F.when(number != 1, factors).alias("multiplier"),
    )
    return versioning.usage_reading(readings).select(
        "l_orderkey", "l_linenumber", F.round("usageReading", 6).alias("usageReading")
    )


@query(
    "c20_final_projection",
    f"""WITH {READINGS} SELECT
 {', '.join(
     (sql_time(c) + ' AS ' + c) if c in ('readingUtcLocalTime', 'readingLocalTime')
     else c if c in (
        'servicePointId readingType variableId deviceId meteringType channel '
        'unitOfMeasure qualityCodesSystemId qualityCodesCategorization '
        'qualityCodesIndex intervalSize logNumber readingsValue guidFile multiplier '
        'servicePointTimeZone relationStartDate brand model identReading owner '
        'readingsSource').split()
     else "'ENABLE' AS deviceStatus" if c == 'deviceStatus'
     else f'NULL::VARCHAR AS {c}' for c in S.FINAL_COLUMNS)} FROM readings""",
)
def c20(spark, sf):
    return shown(output.final_projection(event_readings(spark, sf)))


@query(
    "c21_final_casts",
    """SELECT o_orderkey AS row_key, TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN ''
   ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER) AS channel,
  CAST(NULL AS INTEGER) AS version,
  CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS idDateYmd,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey + 2147483000 END AS identReading,
  TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'none'
   ELSE CAST(CAST(floor(o_totalprice) AS INTEGER) AS VARCHAR) END AS FLOAT) AS readingsValue
 FROM orders""",
)
def c21(spark, sf):
    number = F.col("o_orderkey")
    readings = table(spark, sf, "orders").select(
        number.alias("row_key"),
        F.when(number % 3 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("channel"),
        F.lit("Original").alias("version"),
        times.date_key(F.col("o_orderdate")).alias("idDateYmd"),
        F.when(number % 7 != 0, (number + 2147483000).cast("string")).alias("identReading"),
        F.when(number % 5 == 0, "none")
        .otherwise(F.floor("o_totalprice").cast("int").cast("string"))
        .alias("readingsValue"),
    )
    return output.final_casts(
        readings, ["channel", "version", "idDateYmd"], ["readingsValue"], ["identReading"]
    )


@query(
    "c22_route_by_type",
    f"""WITH {READINGS}, typed AS (SELECT identReading, CASE WHEN identReading % 11 = 0 THEN NULL
   WHEN identReading % 13 = 0 THEN 'OTHER' ELSE readingType END AS readingType FROM readings)
 SELECT identReading, readingType,
 CASE WHEN readingType = 'LOAD PROFILE READING' THEN 'interval' ELSE 'single' END AS route
 FROM typed""",
)
def c22(spark, sf):
    number = F.col("identReading")
    kind = F.when(number % 11 == 0, None).when(number % 13 == 0, "OTHER")
    readings = event_readings(spark, sf).select(
        "identReading",
        F.when((number % 11 == 0) | (number % 13 == 0), kind)
        .otherwise(F.col("readingType"))
        .alias("readingType"),
    )
    return output.route_by_type(
        readings,
        lambda df: df.withColumn("route", F.lit("interval")),
        lambda df: df.withColumn("route", F.lit("single")),
    )
