"""Column rules: codes, labels, times and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import READINGS, event_readings, query, shown, sql_time, table, text
from catalog.documents import _keyed, meter_documents, readings_sql
from gaugeline.functions import normalize as norm
from gaugeline.operators import readings as rd
from gaugeline.operators.flatten import flatten_readings, project_readings


def _choice(column, values):
    """One of the values by a number column."""
    return F.element_at(F.array(*map(F.lit, values)), (column + 1).cast("int"))


def _choice_sql(column, values):
    branches = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {column} {branches} END"


_SOURCES = ["Visual", "Remote", "LocalRF", "Optical", "Manually Estimated",
            "LegacySystem", "Phone"]
_LABELS = ["Visual", "Remoto", "LAN", "Optical", "Visual", "HES", "Phone"]


@query(
    "n01_source_label",
    f"SELECT event_id, {_choice_sql('event_id % 7', _LABELS)} AS label FROM events",
)
def n01(spark, sf):
    source = _choice(F.col("event_id") % 7, _SOURCES)
    return table(spark, sf, "events").select(
        "event_id", norm.source_label(source).alias("label")
    )


@query(
    "n02_service_point",
    """SELECT o_orderkey, coalesce('SP' || nullif(o_custkey % 4, 0), 'M' || c_custkey)
 AS servicePointId FROM orders LEFT JOIN customer ON o_custkey = c_custkey + 3""",
)
def n02(spark, sf):
    customers = table(spark, sf, "customer").withColumn("shifted", F.col("c_custkey") + 3)
    joined = table(spark, sf, "orders").join(
        customers, F.col("o_custkey") == F.col("shifted"), "left"
    )
    part = F.col("o_custkey") % 4
    sdp = F.when(part != 0, F.concat(F.lit("SP"), part))
    meter = F.concat(F.lit("M"), "c_custkey")
    return joined.select("o_orderkey", norm.service_point(sdp, meter).alias("servicePointId"))


_UNITS = ["kW", "kWh", "kVAr", "kVArh", "kVA", "kVAh", "kQ", "kQh", "-", "V", "A", "ccf",
          "gal", "cgal", "m^3", "ft^3", "in^3", "yd^3", "imp gal", "L", "af", "Count",
          "Hz", "°", "acre", "17", "KW"]
_CODES = [96, 74, 75, 77, 78, 80, 81, 82, 70, 12, 1, 85, 86, 87, 88, 89, 90, 91, 94, 92,
          93, 99, 97, 98, None, 17, None]


@query(
    "n03_uom_code",
    "SELECT event_id, TRY_CAST("
    + _choice_sql("event_id % 27", ["" if c is None else c for c in _CODES])
    + " AS INTEGER) AS unitOfMeasure FROM events",
)
def n03(spark, sf):
    unit = _choice(F.col("event_id") % 27, _UNITS)
    return table(spark, sf, "events").select(
        "event_id", norm.uom_code(unit).alias("unitOfMeasure")
    )


_TYPES = ["A3", "Alpha", "A3_ILN", "A3_Collector", "REX", "EAWater", "EAGas", "Solar"]


@query(
    "n04_device_profile",
    f"""SELECT p_partkey,
 {_choice_sql('p_size % 8', ['Electric meter'] * 5 + ['Water meter', 'Gas meter', 'Solar'])}
  AS deviceType,
 {_choice_sql('p_size % 8', ['Elster'] * 7 + ['Solar'])} AS brand,
 {_choice_sql('p_size % 8', ['Alpha A3', 'Alpha', 'A3 ILN', 'A3 Collector', 'REX',
                             'EAWater', 'EAGas', 'Solar'])} AS model FROM part""",
)
def n04(spark, sf):
    profile = norm.device_profile(_choice(F.col("p_size") % 8, _TYPES))
    return table(spark, sf, "part").select(
        "p_partkey", *[c.alias(name) for name, c in profile.items()]
    )


@query(
    "n05_device_status",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'ENABLE' WHEN 'F' THEN 'DISABLE'
 END AS deviceStatus FROM orders""",
)
def n05(spark, sf):
    status = F.col("o_orderstatus")
    active = F.when(status == "O", "true").when(status == "F", "false").otherwise(status)
    return table(spark, sf, "orders").select(
        "o_orderkey", norm.device_status(active).alias("deviceStatus")
    )


@query(
    "n06_connection_type",
    """SELECT o_orderkey,
 CASE o_orderstatus WHEN 'O' THEN 'TCP/Ethernet' WHEN 'F' THEN 'RF'
  ELSE nullif(o_orderpriority, '5-LOW') END AS connectionType,
 CASE o_orderstatus WHEN 'O' THEN 'TCP/Ethernet' WHEN 'F' THEN 'RF' ELSE '_MediaType' END
  AS literalConnection FROM orders""",
)
def n06(spark, sf):
    status = F.col("o_orderstatus")
    media = (
        F.when(status == "O", "Ethernet WIC")
        .when(status == "F", "900Mhz")
        .otherwise(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        norm.connection_type(media).alias("connectionType"),
        norm.connection_type(media, literal_for_unknown=True).alias("literalConnection"),
    )


_FLAGS = ["_TimeChanged", "_ClockSetBackward", "_LongInterval", "_ClockSetForward",
          "_PartialInterval", "_InvalidTime", "_SkippedInterval", "_CompleteOutage",
          "_PartialOutage", "_PulseOverflow", "_TestMode", "_Tamper",
          "_SuspectedOutage", "_Restoration", "_DST", "_InvalidValue"]
_RESULTS = ["2-4-9", "1-4-128", "1-4-3", "1-4-64", "1-4-2", "1-1-9", "1-4-4", "1-2-32",
            "1-2-32", "1-4-1", "1-4-5", "1-3-0", "1-2-0", "1-2-0", "1-4-16", "2-5-256"]


@query(
    "n07_quality_codes",
    "SELECT l_orderkey, l_linenumber, CASE "
    + " ".join(
        f"WHEN l_partkey % {i + 3} = 0 THEN '{r}'" for i, r in enumerate(_RESULTS)
    )
    + " END AS codes, CASE WHEN l_partkey % 17 = 0 AND "
    + " AND ".join(f"l_partkey % {i + 3} <> 0" for i in range(14))
    + " THEN '1' END AS dst FROM lineitem",
)
def n07(spark, sf):
    flags = F.struct(
        *[
            F.when(F.col("l_partkey") % (i + 3) == 0, "1").alias(name)
            for i, name in enumerate(_FLAGS)
        ]
    )
    codes = F.col("codes")
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_linenumber", norm.quality_codes(flags).alias("codes"))
        .select(
            "l_orderkey",
            "l_linenumber",
            norm.quality_flag(
                codes.getField("system"),
                codes.getField("categorization"),
                codes.getField("index"),
            ).alias("codes"),
            codes.getField("dst").alias("dst"),
        )
    )


@query(
    "n08_multiplier",
    """SELECT o_orderkey, '''MultiplierValues'':{''ke'':''' ||
 CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(o_custkey AS VARCHAR) END
 || '''}' AS multiplier FROM orders""",
)
def n08(spark, sf):
    number = F.col("o_orderkey") % 3
    ke = F.when(number == 1, "").when(number == 2, text("o_custkey"))
    return table(spark, sf, "orders").select(
        "o_orderkey", norm.multiplier_text(ke).alias("multiplier")
    )


@query(
    "n09_union_readings",
    """SELECT user_id, event_type, value FROM events
 UNION ALL BY NAME SELECT event_type, user_id, value + 1 AS value FROM events
 UNION ALL BY NAME SELECT value + 2 AS value, event_type, user_id FROM events""",
)
def n09(spark, sf):
    events = table(spark, sf, "events")
    return rd.union_readings(
        events.select("user_id", "event_type", "value"),
        events.select("event_type", "user_id", (F.col("value") + 1).alias("value")),
        events.select((F.col("value") + 2).alias("value"), "event_type", "user_id"),
    )


_HOLED_SQL = "nullif(o_orderpriority, '3-MEDIUM')"


def _holed(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("variableId"),
        F.when(F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "yyyy-MM-dd")).alias(
            "relationStartDate"
        ),
        F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).alias(
            "relationEndDate"
        ),
    )


@query(
    "n10_drop_unnamed",
    f"""SELECT o_orderkey, {_HOLED_SQL} AS variableId FROM orders
 WHERE {_HOLED_SQL} IS NOT NULL""",
)
def n10(spark, sf):
    return rd.drop_unnamed(_holed(spark, sf)).select("o_orderkey", "variableId")


@query(
    "n11_fill_relation_dates",
    f"""SELECT o_orderkey, {_HOLED_SQL} AS variableId,
 CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END
  AS relationStartDate,
 CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END
  AS relationEndDate FROM orders""",
)
def n11(spark, sf):
    return rd.fill_relation_dates(_holed(spark, sf))


@query("n12_project_readings", readings_sql(["profile_summary", "reverse_energy"]))
def n12(spark, sf):
    docs = meter_documents(spark, sf, ["LoadProfileSummary", "ReverseEnergySummary"])
    elements = flatten_readings(_keyed(docs), ["profile_summary", "reverse_energy"])
    return rd.cast_readings(project_readings(rd.drop_unnamed(elements)))


@query(
    "n13_cast_readings",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 1 THEN CAST(o_custkey AS INTEGER) END
  AS channel, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS logNumber,
 CAST(NULL AS INTEGER) AS unitOfMeasure, CAST(o_orderkey AS INTEGER) AS intervalSize
 FROM orders""",
)
def n13(spark, sf):
    number = F.col("o_orderkey") % 3
    texts = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(number == 0, "").when(number == 1, text("o_custkey")).otherwise("1x").alias("channel"),
        F.substring("o_orderpriority", 1, 1).alias("logNumber"),
        F.col("o_orderstatus").alias("unitOfMeasure"),
        text("o_orderkey").alias("intervalSize"),
    )
    return rd.cast_readings(texts)


@query(
    "e12_to_utc",
    f"""WITH {READINGS} SELECT identReading, servicePointTimeZone,
 {sql_time('readingUtcLocalTime')} AS readingUtcLocalTime FROM readings""",
)
def e12(spark, sf):
    return shown(
        event_readings(spark, sf),
        "identReading", "servicePointTimeZone", "readingUtcLocalTime",
    )
