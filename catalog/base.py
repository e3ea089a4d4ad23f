"""Registration and the inputs shared by many queries, each once as a DataFrame
and once as SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions import times
from gaugeline.sources.sinks import rendered

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = dt.date(2024, 1, 25)
STAMP = "2024-01-25T00:00:00.000000"


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly: each becomes a document many times its size, of which
    the scan's split of the table knows nothing."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """The wanted columns with times as text."""
    return rendered(df.select(*columns) if columns else df)


def text(column: str, digits: int | None = None):
    """Number to text the same way on every engine."""
    kind = "int" if digits is None else f"decimal(14,{digits})"
    return F.col(column).cast(kind).cast("string")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched readings made of the events: a user is a service point, an event
    type a variable, the hour the reading time."""
    user, kind, number = F.col("user_id"), F.col("event_type"), F.col("event_id")
    code = number % 4
    quality = lambda first, second: F.when(code == 0, first).when(code == 1, second)
    readings = table(spark, sf_dir, "events").select(
        F.concat(F.lit("SP-"), user).alias("servicePointId"),
        F.concat(F.lit("D-"), user).alias("deviceId"),
        F.lit("MAIN").alias("meteringType"),
        kind.alias("variableId"),
        F.when(kind == "error", "EVENTS")
        .when(kind == "signup", "REGISTERS")
        .otherwise("LOAD PROFILE READING")
        .alias("readingType"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("readingLocalTime"),
        F.when(kind != "purchase", 1).alias("logNumber"),
        F.floor(F.col("value") / 20).cast("int").cast("string").alias("readingsValue"),
        (user % 58).cast("string").alias("servicePointTimeZone"),
        number.alias("identReading"),
        F.lit(60).alias("intervalSize"),
        F.lit(1).alias("channel"),
        F.lit(74).alias("unitOfMeasure"),
        quality("1", "1").alias("qualityCodesSystemId"),
        quality("2", "4").alias("qualityCodesCategorization"),
        quality("32", "16").alias("qualityCodesIndex"),
        F.when(number % 5 == 1, "'MultiplierValues':{'ke':''}")
        .when(number % 5 > 1, "'MultiplierValues':{'ke':'0.25','sf':'','pt':'3'}")
        .alias("multiplier"),
        F.lit("HES").alias("readingsSource"),
        F.concat(F.lit("OWNER-"), user % 3).alias("owner"),
        F.concat(F.lit("file-"), F.date_format("ts", "yyyyMMdd")).alias("guidFile"),
        F.when(user % 13 != 0, user % 11 != 0).alias("result_rD"),
        (user % 7 != 3).alias("result_sPV"),
        ((kind != "click") | (user % 5 != 0)).alias("toStock"),
        F.when(user % 17 != 1, F.lit("2024-01-10T13:42:22")).alias("lastReadDate"),
        F.when(
            user % 3 != 1,
            F.concat(
                F.lit("2024-01-"),
                F.lpad((user % 28 + 1).cast("string"), 2, "0"),
                F.lit(" 22:44:23"),
            ),
        ).alias("relationStartDate"),
        F.lit(None).cast("string").alias("relationEndDate"),
        F.concat(F.lit("Brand-"), user % 4).alias("brand"),
        F.concat(F.lit("M"), number % 3).alias("model"),
        F.lit(None).cast("string").alias("deviceDescription"),
        F.lit("ENABLE").alias("deviceStatus"),
    )
    return readings.withColumn(
        "readingUtcLocalTime",
        times.to_utc(F.col("readingLocalTime"), F.col("servicePointTimeZone")),
    )


ZONES = """zones(code, hours) AS (VALUES
 ('0',-12),('1',-11),('2',-10),('3',-9),('4',-8),('5',-7),('6',-7),('7',-6),('8',-6),
 ('9',-6),('10',-5),('11',-5),('12',-5),('13',-4),('14',-4),('15',-3.5),('16',-3),
 ('17',-3),('18',-2),('19',-1),('20',0),('21',0),('22',1),('23',1),('24',1),('25',2),
 ('26',2),('27',2),('28',2),('29',2),('30',3),('31',3),('32',3.5),('33',4),('34',4.5),
 ('35',5),('36',5.5),('37',6),('38',7),('39',8),('40',8),('41',9),('42',9.5),
 ('43',9.5),('44',10),('45',10),('46',10),('47',11),('48',12),('49',12),('50',-8),
 ('51',-7),('52',-6),('53',-6),('54',-6),('55',-6),('56',10))"""

READINGS = (
    ZONES
    + """,
base AS (
 SELECT 'SP-' || user_id AS servicePointId, 'D-' || user_id AS deviceId,
  'MAIN' AS meteringType, event_type AS variableId,
  CASE event_type WHEN 'error' THEN 'EVENTS' WHEN 'signup' THEN 'REGISTERS'
   ELSE 'LOAD PROFILE READING' END AS readingType,
  date_trunc('hour', ts) AS readingLocalTime,
  CASE WHEN event_type <> 'purchase' THEN 1 END AS logNumber,
  CAST(CAST(floor(value / 20) AS INTEGER) AS VARCHAR) AS readingsValue,
  CAST(user_id % 58 AS VARCHAR) AS servicePointTimeZone,
  event_id AS identReading, 60 AS intervalSize, 1 AS channel, 74 AS unitOfMeasure,
  CASE WHEN event_id % 4 < 2 THEN '1' END AS qualityCodesSystemId,
  CASE event_id % 4 WHEN 0 THEN '2' WHEN 1 THEN '4' END AS qualityCodesCategorization,
  CASE event_id % 4 WHEN 0 THEN '32' WHEN 1 THEN '16' END AS qualityCodesIndex,
  CASE WHEN event_id % 5 = 1 THEN '''MultiplierValues'':{''ke'':''''}'
   WHEN event_id % 5 > 1 THEN '''MultiplierValues'':{''ke'':''0.25'',''sf'':'''',''pt'':''3''}'
   END AS multiplier,
  'HES' AS readingsSource, 'OWNER-' || (user_id % 3) AS owner,
  'file-' || strftime(ts, '%Y%m%d') AS guidFile,
  CASE WHEN user_id % 13 <> 0 THEN user_id % 11 <> 0 END AS result_rD,
  user_id % 7 <> 3 AS result_sPV,
  (event_type <> 'click' OR user_id % 5 <> 0) AS toStock,
  CASE WHEN user_id % 17 <> 1 THEN '2024-01-10T13:42:22' END AS lastReadDate,
  CASE WHEN user_id % 3 <> 1 THEN
   '2024-01-' || lpad(CAST(user_id % 28 + 1 AS VARCHAR), 2, '0') || ' 22:44:23' END
   AS relationStartDate,
  'Brand-' || (user_id % 4) AS brand, 'M' || (event_id % 3) AS model
 FROM events),
readings AS (
 SELECT base.*,
  readingLocalTime - to_minutes(CAST(hours * 60 AS INTEGER)) AS readingUtcLocalTime
 FROM base LEFT JOIN zones ON code = servicePointTimeZone)"""
)


def sql_time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"
