"""Identifiers, topology lists, lookups and calendar keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import AS_OF, READINGS, event_readings, query, shown, sql_time, table
from gaugeline.functions import times
from gaugeline.operators import enrich as en


@query(
    "e01_add_ids",
    """SELECT o_orderkey, CAST(NULL AS BIGINT) AS idVdi, CAST(NULL AS BIGINT) AS idenEvent,
 DATE '2024-01-25' AS dateCreation FROM orders""",
)
def e01(spark, sf):
    return en.add_ids(table(spark, sf, "orders").select("o_orderkey"), AS_OF)


@query(
    "e02_number_rows",
    """SELECT o_orderkey, o_custkey, row_number() OVER
 (ORDER BY o_custkey DESC, o_orderkey) - 1 AS identReading FROM orders""",
)
def e02(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return en.number_rows(orders, [F.desc("o_custkey"), "o_orderkey"])


@query(
    "e02_number_rows_hot_ties",
    """SELECT count(*) AS rows, count(DISTINCT i) AS numbers, min(i) AS first,
 max(i) AS last FROM (SELECT row_number() OVER (ORDER BY event_type) - 1 AS i FROM events)""",
)
def e02_ties(spark, sf):
    """Numbers stay consecutive when few values order all rows."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    return en.number_rows(events, ["event_type"]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("identReading").alias("numbers"),
        F.min("identReading").alias("first"),
        F.max("identReading").alias("last"),
    )


@query(
    "e03_distinct_service_points",
    f"WITH {READINGS} SELECT DISTINCT servicePointId FROM readings",
)
def e03(spark, sf):
    return en.distinct_service_points(event_readings(spark, sf))


@query(
    "e04_distinct_devices",
    f"""WITH {READINGS} SELECT deviceId, brand, model, NULL::VARCHAR AS deviceDescription,
 'ENABLE' AS deviceStatus, 'METER' AS deviceCategory FROM (SELECT *, row_number() OVER
  (PARTITION BY deviceId ORDER BY identReading) AS i FROM readings) WHERE i = 1""",
)
def e04(spark, sf):
    return en.distinct_devices(event_readings(spark, sf))


@query(
    "e05_distinct_relations",
    f"""WITH {READINGS} SELECT servicePointId, deviceId, meteringType, relationStartDate,
 NULL::VARCHAR AS relationEndDate FROM (SELECT *, row_number() OVER
  (PARTITION BY servicePointId, deviceId ORDER BY identReading) AS i FROM readings)
 WHERE i = 1""",
)
def e05(spark, sf):
    return en.distinct_relations(event_readings(spark, sf))


_PROFILE = "readingType, variableId, servicePointId, meteringType, unitOfMeasure"


@query(
    "e06_distinct_profile_variables",
    f"""WITH {READINGS} SELECT DISTINCT {_PROFILE}, logNumber, channel, intervalSize
 FROM readings WHERE readingType = 'LOAD PROFILE READING'""",
)
def e06(spark, sf):
    return en.distinct_profile_variables(event_readings(spark, sf))


@query(
    "e07_distinct_register_event_variables",
    f"""WITH {READINGS} SELECT DISTINCT {_PROFILE} FROM readings
 WHERE readingType IN ('REGISTERS', 'EVENTS')""",
)
def e07(spark, sf):
    return en.distinct_register_event_variables(event_readings(spark, sf))


@query(
    "e07_service_point_variables",
    f"""WITH {READINGS} SELECT DISTINCT {_PROFILE}, logNumber, channel, intervalSize
 FROM readings WHERE readingType = 'LOAD PROFILE READING'
 UNION ALL SELECT DISTINCT {_PROFILE}, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
  CAST(NULL AS INTEGER) FROM readings WHERE readingType IN ('REGISTERS', 'EVENTS')""",
)
def e07_both(spark, sf):
    return en.service_point_variables(event_readings(spark, sf))


_REQUEST = (
    "owner struct<hes: string, owner: string, guidFile: string>,"
    "servicePoint array<struct<servicePointId: string>>,"
    "device array<struct<deviceId: string, brand: string, model: string,"
    " deviceCategory: string>>,"
    "relationDevice array<struct<servicePointId: string, deviceId: string,"
    " relationStartDate: string>>,"
    "servicePointVariable array<struct<variableId: string, servicePointId: string,"
    " intervalSize: int>>"
)


@query(
    "e08_topology_request",
    f"""WITH {READINGS}, files AS (SELECT *, min(identReading) OVER
   (PARTITION BY guidFile, owner, deviceId) AS lowest FROM readings),
 entries AS (
  SELECT DISTINCT guidFile, owner, 'servicePoint' AS list, servicePointId AS name,
   NULL AS detail FROM files
  UNION ALL SELECT guidFile, owner, 'device', deviceId, brand || ' ' || model || ' METER'
   FROM files WHERE identReading = lowest
  UNION ALL SELECT DISTINCT guidFile, owner, 'relationDevice', servicePointId || ' ' ||
   deviceId, relationStartDate FROM files
  UNION ALL SELECT DISTINCT guidFile, owner, 'servicePointVariable',
   servicePointId || ' ' || variableId,
   CASE WHEN readingType = 'LOAD PROFILE READING' THEN '60' END FROM files)
 SELECT guidFile, owner, 'HES' AS hes, list, name, detail FROM entries""",
)
def e08(spark, sf):
    """The requests, read back from their JSON as one row per list entry."""
    requests = en.topology_request(event_readings(spark, sf), chunk=40)
    parsed = requests.select(F.from_json("request", _REQUEST).alias("r"))
    join = lambda e, *names: F.concat_ws(" ", *[e.getField(n) for n in names])
    lists = {
        "servicePoint": lambda e: (e.getField("servicePointId"), F.lit(None)),
        "device": lambda e: (e.getField("deviceId"), join(e, "brand", "model", "deviceCategory")),
        "relationDevice": lambda e: (join(e, "servicePointId", "deviceId"), e.getField("relationStartDate")),
        "servicePointVariable": lambda e: (join(e, "servicePointId", "variableId"), e.getField("intervalSize")),
    }
    # The lists of a request side by side, so that its text is parsed once.
    beside = parsed.select("r.owner.*", F.explode(F.arrays_zip(*[F.col(f"r.{n}") for n in lists])).alias("e"))
    rows = []
    for name, fields in lists.items():
        entry = F.col(f"e.{name}")
        label, detail = fields(entry)
        row = F.struct(
            F.lit(name).alias("list"), label.alias("name"), detail.cast("string").alias("detail")
        )
        rows.append(F.when(entry.isNotNull(), row))
    each = beside.select("guidFile", "owner", "hes", F.explode(F.array(*rows)).alias("row"))
    return each.filter(F.col("row").isNotNull()).select("guidFile", "owner", "hes", "row.*")


_ENTRIES_SQL = """files AS (SELECT *, min(identReading) OVER (PARTITION BY guidFile, owner, deviceId) AS lowest FROM readings),
 lists AS (
  SELECT DISTINCT guidFile, owner, 0 AS number, [servicePointId] AS fields, servicePointId AS name FROM files
  UNION ALL SELECT guidFile, owner, 1, [deviceId, brand, model, '', 'ENABLE', 'METER'], deviceId FROM files WHERE identReading = lowest
  UNION ALL SELECT DISTINCT guidFile, owner, 2, [servicePointId, deviceId, 'MAIN', coalesce(relationStartDate, ''), ''],
   servicePointId || ' ' || deviceId FROM files
  UNION ALL SELECT DISTINCT guidFile, owner, 3, [readingType, variableId, servicePointId, 'MAIN', '74',
   CASE WHEN readingType = 'LOAD PROFILE READING' THEN coalesce(CAST(logNumber AS VARCHAR), '') ELSE '' END,
   CASE WHEN readingType = 'LOAD PROFILE READING' THEN '1' ELSE '' END,
   CASE WHEN readingType = 'LOAD PROFILE READING' THEN '60' ELSE '' END], servicePointId || ' ' || variableId FROM files),
 entries AS (SELECT *, row_number() OVER (PARTITION BY guidFile, owner ORDER BY number, fields) - 1 AS position FROM lists)"""


@query(
    "e08_topology_entries",
    f"""WITH {READINGS}, {_ENTRIES_SQL} SELECT guidFile, owner, 'HES' AS readingsSource, position,
 CASE number WHEN 0 THEN 'servicePoint' WHEN 1 THEN 'device' WHEN 2 THEN 'relationDevice' ELSE 'servicePointVariable' END AS list,
 name FROM entries""",
)
def e08_entries(spark, sf):
    entries = en.topology_entries(event_readings(spark, sf))
    name = F.coalesce(
        "servicePoint.servicePointId",
        "device.deviceId",
        F.concat_ws(" ", F.nullif("relationDevice.servicePointId", F.lit("")), "relationDevice.deviceId"),
    )
    variable = F.concat_ws(" ", "servicePointVariable.servicePointId", "servicePointVariable.variableId")
    name = F.when(F.col("list") == "servicePointVariable", variable).otherwise(name)
    return entries.select("guidFile", "owner", "readingsSource", "position", "list", name.alias("name"))


@query(
    "e08_topology_parts",
    f"""WITH {READINGS}, {_ENTRIES_SQL} SELECT guidFile, owner, 'HES' AS readingsSource, position // 25 AS part,
 coalesce(string_agg(name, ',' ORDER BY position) FILTER (number = 0), '') AS points,
 coalesce(string_agg(name, ',' ORDER BY position) FILTER (number = 1), '') AS devices,
 coalesce(string_agg(name, ',' ORDER BY position) FILTER (number = 2), '') AS relations,
 coalesce(string_agg(name, ',' ORDER BY position) FILTER (number = 3), '') AS variables
 FROM entries GROUP BY ALL""",
)
def e08_parts(spark, sf):
    """Which entries each request of 25 holds, read from its JSON."""
    requests = en.topology_request(event_readings(spark, sf), chunk=25)
    parsed = requests.withColumn("r", F.from_json("request", _REQUEST))

    def names(listed, *fields):
        each = F.transform(f"r.{listed}", lambda e: F.concat_ws(" ", *[e.getField(f) for f in fields]))
        return F.array_join(each, ",")

    return parsed.select(
        "guidFile",
        "owner",
        "readingsSource",
        "part",
        names("servicePoint", "servicePointId").alias("points"),
        names("device", "deviceId").alias("devices"),
        names("relationDevice", "servicePointId", "deviceId").alias("relations"),
        names("servicePointVariable", "servicePointId", "variableId").alias("variables"),
    )


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("SP"), "l_suppkey").alias("servicePointId"),
        F.concat(F.lit("M"), "l_partkey").alias("deviceId"),
        F.col("l_returnflag").alias("variableId"),
        F.col("l_linestatus").alias("readingType"),
    )


@query(
    "e09_join_relation_flags",
    """SELECT l_orderkey, l_linenumber, l_suppkey, p_size > 25 AS result_rD
 FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type <> 'SMALL'""",
)
def e09(spark, sf):
    """The relations are the pairs of supplier and part. Parts of one type have
    another device there, so that their lines find none."""
    device = F.when(F.col("p_type") == "SMALL", "X").otherwise("M")
    parts = table(spark, sf, "part")
    pairs = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct()
    relation = pairs.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("SP"), "l_suppkey").alias("servicePointId"),
        F.concat(device, "l_partkey").alias("deviceId"),
        (F.col("p_size") > 25).alias("result_rD"),
    )
    joined = en.join_relation_flags(_lines(spark, sf), relation)
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        F.regexp_replace("servicePointId", "SP", "").cast("bigint").alias("l_suppkey"),
        "result_rD",
    )


@query(
    "e10_join_variable_flags",
    """SELECT l_orderkey, l_linenumber, s_acctbal > 5000 AS result_sPV,
 l_returnflag <> 'R' AS toStock, '2020-07-07T10:00:00' AS lastReadDate
 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
 WHERE s_acctbal > 1000 AND (l_returnflag <> 'N' OR l_linestatus = 'O')""",
)
def e10(spark, sf):
    pairs = F.array(
        *[
            F.struct(F.lit(v).alias("variableId"), F.lit(t).alias("readingType"))
            for v, t in (("A", "O"), ("A", "F"), ("R", "O"), ("R", "F"), ("N", "O"))
        ]
    )
    variable = (
        table(spark, sf, "supplier")
        .withColumn("pair", F.explode(pairs))
        .select(
            "pair.*",
            # Suppliers with little money have another service point there.
            F.concat(F.when(F.col("s_acctbal") > 1000, "SP").otherwise("XP"), "s_suppkey").alias(
                "servicePointId"
            ),
            (F.col("s_acctbal") > 5000).alias("result_sPV"),
            (F.col("pair.variableId") != "R").alias("toStock"),
            F.lit("2020-07-07T10:00:00").alias("lastReadDate"),
        )
    )
    joined = en.join_variable_flags(_lines(spark, sf), variable)
    return joined.select(
        "l_orderkey", "l_linenumber", "result_sPV", "toStock", "lastReadDate"
    )


@query(
    "e11_require_timezone",
    """SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS servicePointTimeZone FROM customer
 WHERE c_mktsegment <> 'MACHINERY'""",
)
def e11(spark, sf):
    zone = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_nationkey").cast("string"))
    customers = table(spark, sf, "customer").select(
        "c_custkey", zone.alias("servicePointTimeZone")
    )
    return en.require_timezone(customers)


@query(
    "e13_date_key",
    f"""WITH {READINGS} SELECT identReading,
 strftime(readingUtcLocalTime, '%Y%m%d') AS idDateYmd FROM readings""",
)
def e13(spark, sf):
    return event_readings(spark, sf).select(
        "identReading", times.date_key(F.col("readingUtcLocalTime")).alias("idDateYmd")
    )


@query(
    "e14_week_key",
    """SELECT o_orderkey, CAST(isoyear(o_orderdate) AS VARCHAR) ||
 CAST(week(o_orderdate) AS VARCHAR) AS idDateYw FROM orders""",
)
def e14(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", times.week_key(F.col("o_orderdate")).alias("idDateYw")
    )


@query(
    "e12_add_utc",
    f"""WITH {READINGS} SELECT identReading,
 {sql_time('readingUtcLocalTime')} AS readingUtcLocalTime,
 strftime(readingUtcLocalTime, '%Y%m%d') AS idDateYmd,
 CAST(isoyear(readingUtcLocalTime) AS VARCHAR) || CAST(week(readingUtcLocalTime) AS VARCHAR)
  AS idDateYw FROM readings""",
)
def e12_all(spark, sf):
    """Times arrive as text, as the documents hold them."""
    local = times.time_text(F.col("readingLocalTime"))
    texts = event_readings(spark, sf).withColumns(
        {"readingLocalTime": local, "readingDateSource": local}
    )
    return shown(
        en.add_utc(texts), "identReading", "readingUtcLocalTime", "idDateYmd", "idDateYw"
    )


@query("e15_init_version", "SELECT event_id, CAST(1 AS INTEGER) AS version FROM events")
def e15(spark, sf):
    return en.init_version(table(spark, sf, "events").select("event_id"))
