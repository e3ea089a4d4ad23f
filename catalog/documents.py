"""Nested documents made of line items: sources, every reading kind, round trips."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from xml.sax.saxutils import quoteattr

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.base import AS_OF, READINGS, event_readings, query, shown, spread, sql_time, table
from gaugeline import schema as S
from gaugeline.operators.flatten import (
    DEFAULT_KINDS,
    KINDS,
    flatten_readings,
    project_readings,
    read_schema,
)
from gaugeline.operators.readings import cast_readings, drop_unnamed
from gaugeline.functions.times import time_text
from gaugeline.sources import documents, sinks, tables
from gaugeline.sources.scratch import fresh_path

_FIELDS = {f.name: f.dataType for f in S.DOCUMENT_SCHEMA.fields}


@dataclass(frozen=True)
class _Given:
    """A part of a document that is there where the condition holds."""

    condition: Column
    part: dict | list


def _column(kind: T.DataType, part) -> Column:
    """A part of a document as a column of its type: a dict is a struct, a list an array,
    a fixed text or a column a text; what a part does not name is null. No casts, which
    would make every struct a second time."""
    if part is None:
        return F.lit(None).cast(kind)
    if isinstance(part, _Given):
        return F.when(part.condition, _column(kind, part.part))
    if isinstance(kind, T.ArrayType):
        return F.array(*[_column(kind.elementType, entry) for entry in part])
    if isinstance(kind, T.StructType):
        return F.struct(
            *[_column(f.dataType, part.get(f.name)).alias(f.name) for f in kind.fields]
        )
    return F.lit(part)


def _lines(rows):
    """The texts of a line item that documents are made of, each made once."""
    li = F.col
    number = li("l_linenumber")
    open_line = li("l_linestatus") == "O"
    hour = lambda h: time_text(F.timestamp_add("HOUR", h, li("l_shipdate")))
    stamp = hour(number)
    kinds = li("l_suppkey") % 9
    texts = dict(
        number=number,
        open=open_line,
        tier=li("l_returnflag"),
        quantity=li("l_quantity").cast("int").cast("string"),
        price=li("l_extendedprice").cast("decimal(12,2)").cast("string"),
        stamp=stamp,
        open_stamp=F.when(open_line, stamp),
        collected=hour(F.lit(9)),
        installed=hour(F.lit(0)),
        source=F.when(li("l_returnflag") == "A", "Remote")
        .when(li("l_returnflag") == "N", "LocalRF")
        .otherwise("Phone"),
        supplier=li("l_suppkey").cast("string"),
        meter=F.concat(F.lit("M"), li("l_partkey")),
        point=F.when(number % 2 == 1, F.concat(F.lit("SP"), li("l_suppkey"))),
        active=F.when(open_line, "true").when(number > 1, "false"),
        order=li("l_orderkey").cast("string"),
        account=F.concat(F.lit("AC"), li("l_orderkey")),
        zone=(li("l_partkey") % 57).cast("string"),
        meter_type=F.when(kinds != 7, F.element_at(
            F.array(*map(F.lit, ["A3", "Alpha", "A3_ILN", "A3_Collector", "REX", "EAWater",
                                 "EAGas", "", "Other"])), (kinds + 1).cast("int"))),
        media=F.element_at(F.array(*map(F.lit, ["Ethernet WIC", "900Mhz", "Fiber"])),
                           number % 3 + 1),
    )
    return rows.select(
        *[text.alias(name) for name, text in texts.items()],
        *[name for name in rows.columns if not name.startswith("l_")],
    )


def _document(wanted=None) -> dict:
    """The parts of a line's document with the wanted sections (default all); the
    sections hold two or three elements, and some miss times, names, flags, sections or
    the meter."""
    number, open_line, tier = F.col("number"), F.col("open"), F.col("tier")
    quantity, price = F.col("quantity"), F.col("price")
    stamp, open_stamp, collected = F.col("stamp"), F.col("open_stamp"), F.col("collected")
    received = F.when(number != 3, "Received")

    def demand(section, first_unit):
        spec = section.removesuffix("Data") + "Spec"
        return _Given(number != 5, [
            {
                spec: dict(_UOM=first_unit, _Direction="Delivered", _TouBucket=tier,
                           _Multiplier="1"),
                "Reading": dict(_Value=quantity, _TimeStamp=open_stamp),
            },
            {
                spec: dict(_UOM="kVA", _Direction=received, _TouBucket="Total"),
                "Reading": dict(_Value=price, _TimeStamp=stamp),
            },
        ])

    flag = lambda condition: F.when(condition, "1")
    sections = dict(
        MaxDemandData=demand("MaxDemandData", "kW"),
        ConsumptionData=demand("ConsumptionData", "Degree"),
        CoincidentDemandData=demand("CoincidentDemandData", "kVAr"),
        CumulativeDemandData=demand("CumulativeDemandData", "acre"),
        DemandResetCount=[
            dict(_Count=quantity, _TimeStamp=stamp, _UOM="Times"),
            dict(_Count="3", _UOM="kQ"),
        ],
        DemandReset=[dict(_TimeStamp=stamp), {}],
        InstrumentationValue=[
            dict(_Name="Current", _Phase="A", _Timestamp=stamp, _Value=quantity),
            dict(_Name="Humidity", _Phase="B", _Timestamp=collected, _Value=price),
            dict(_Name="Voltage", _Timestamp=stamp, _Value=price),
        ],
        Statuses=[
            dict(Status=[
                dict(_Category="Service", _Id=quantity, _Name="Door", _Value="true"),
                dict(_Category="Service", _Id="61", _Name="Relay", _Value="false"),
            ]),
            dict(Status=_Given(open_line, [
                dict(_Category="Tamper", _Id="7", _Name="Count", _Value=price)])),
        ],
        LoadProfileSummary=[
            dict(Channel=dict(_UOM="kWh", _Direction="Delivered", _Multiplier="0.01",
                              _SumOfIntervalValues=price)),
            dict(Channel=dict(_UOM="kWh", _SumOfIntervalValues=quantity)),
        ],
        OutageCountSummary=[
            dict(OutageCount=dict(_ReadingTime=stamp, _Value=quantity,
                                  _PreviousReadingTime=collected, _PreviousValue="0")),
        ],
        ReverseEnergySummary=[
            dict(ReverseEnergy=dict(_CurrentValue=quantity, _PreviousValue=price)),
        ],
        EventData=[
            dict(Event=[
                dict(_TimeStamp=stamp, _DiscoveredAt=collected, EventAttribute=[
                    dict(_Name="Magnitude1", _Value=quantity), dict(_Value=price)]),
                dict(_DiscoveredAt=collected, EventAttribute=[
                    dict(_Name="Magnitude2", _Value=price)]),
                dict(_TimeStamp=stamp),
            ]),
            {},
        ],
        IntervalData=[
            dict(
                IntervalSpec=dict(_UOM="kWh", _Direction="Delivered", _Interval="15",
                                  _Channel="2", _Multiplier="0.01"),
                Reading=[
                    dict(_RawReading=quantity, _TimeStamp=stamp),
                    dict(_RawReading=price, _TimeStamp=collected, QualityFlags=dict(
                        _TimeChanged=flag(number == 1),
                        _PartialOutage=flag(tier == "R"),
                        _Tamper=flag(tier == "A"),
                        _DST=flag(open_line),
                        _Restoration=flag(number == 2),
                        _InvalidValue=flag(number > 3))),
                ],
            ),
        ],
    )
    meter = _Given(number != 7, dict(
        _MeterIrn=F.col("meter"),
        _SdpIdent=F.col("point"),
        _IsActive=F.col("active"),
        _SerialNumber=F.col("order"),
        _MeterType=F.col("meter_type"),
        _AccountIdent=F.col("account"),
        _TimeZoneIndex=F.col("zone"),
        _MediaType=F.col("media"),
        _InstallDate=F.col("installed"),
    ))
    return dict(
        _CollectionTime=collected,
        _Source=F.col("source"),
        _SourceIrn=F.col("supplier"),
        Meter=meter,
        **{name: part for name, part in sections.items() if wanted is None or name in wanted},
    )


def meter_documents(spark, sf, wanted=None):
    """One document per line item with the wanted sections (default all)."""
    lines = _lines(spread(table(spark, sf, "lineitem")))
    return lines.select(
        *[_column(_FIELDS[name], part).alias(name) for name, part in _document(wanted).items()]
    )


def _keyed(df):
    return df.withColumns(
        {"hes": F.lit("HES"), "owner": F.lit("OWNER"), "guidFile": F.lit("guid")}
    )


def readings_of(docs, kinds=DEFAULT_KINDS):
    return cast_readings(
        project_readings(drop_unnamed(flatten_readings(docs, kinds)))
    )


# ---- the same in SQL: elements per kind, then the common columns -----------------

_LINES = f"""lines AS (SELECT *,
 CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q,
 CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS p,
 {sql_time('l_shipdate + to_hours(l_linenumber)')} AS stamp,
 {sql_time('l_shipdate + INTERVAL 9 HOUR')} AS collected,
 l_linestatus = 'O' AS open FROM lineitem)"""

_FIELD_SQL = """SELECT *, '{kind}' AS readingType, {variable} AS variableId, {unit} AS uom,
 {time} AS readingTime, {value} AS readingsValue, {ke} AS ke, {channel} AS channel,
 {size} AS intervalSize, {log} AS logNumber, {version} AS version, {code} AS eventsCode,
 {qs} AS qs, {qc} AS qc, {qi} AS qi, {dst} AS dst FROM lines WHERE {where}"""


def _element(kind, variable, unit, time, value, ke="''", where="TRUE", **more):
    parts = dict(channel="NULL", size="NULL", log="NULL", version="NULL", code="NULL",
                 qs="NULL", qc="NULL", qi="NULL", dst="NULL")
    parts.update(more)
    parts = {k: ("NULL::VARCHAR" if v == "NULL" else v) for k, v in parts.items()}
    return _FIELD_SQL.format(kind=kind, variable=variable, unit=unit, time=time,
                             value=value, ke=ke, where=where, **parts)


_NULL = "NULL::VARCHAR"


def _demand_sql(first, first_unit, fallback):
    time = "CASE WHEN open THEN stamp" + (" ELSE collected END" if fallback else " END")
    return [
        _element("REGISTERS", f"'{first} Delivered ' || l_returnflag", f"'{first_unit}'",
                 time, "q", "'1'", "l_linenumber <> 5"),
        _element("REGISTERS", "'kVA Received Total'", "'kVA'", "stamp", "p", _NULL,
                 "l_linenumber NOT IN (3, 5)"),
    ]


_QUALITY = dict(
    qs="""CASE WHEN l_linenumber = 1 THEN '2' WHEN l_returnflag IN ('R', 'A') THEN '1'
 WHEN l_linenumber = 2 OR open THEN '1' WHEN l_linenumber > 3 THEN '2' END""",
    qc="""CASE WHEN l_linenumber = 1 THEN '4' WHEN l_returnflag = 'R' THEN '2'
 WHEN l_returnflag = 'A' THEN '3' WHEN l_linenumber = 2 THEN '2' WHEN open THEN '4'
 WHEN l_linenumber > 3 THEN '5' END""",
    qi="""CASE WHEN l_linenumber = 1 THEN '9' WHEN l_returnflag = 'R' THEN '32'
 WHEN l_returnflag = 'A' THEN '0' WHEN l_linenumber = 2 THEN '0' WHEN open THEN '16'
 WHEN l_linenumber > 3 THEN '256' END""",
    dst="""CASE WHEN l_linenumber NOT IN (1, 2) AND l_returnflag = 'N' AND open
 THEN '1' END""",
)
_INTERVAL = dict(channel="'2'", size="'15'", log="'1'", version="'Original'")

ELEMENTS = {
    "max_demand": _demand_sql("kW", "kW", True),
    "demand_reset_count": [
        _element("REGISTERS", "'Demand Reset Count'", "'Count'", "stamp", "q"),
        _element("REGISTERS", "'Demand Reset Count'", "'kQ'", _NULL, "'3'"),
    ],
    "consumption": _demand_sql("Degree", "°", False),
    "coincident_demand": _demand_sql("kVAr", "kVAr", True),
    "cumulative_demand": _demand_sql("acre", "acre", True),
    "demand_reset": [
        _element("EVENTS", "'Demand Reset'", "'-'", "stamp", "'0'"),
        _element("EVENTS", "'Demand Reset'", "'-'", _NULL, "'0'"),
    ],
    "instrumentation": [
        _element("REGISTERS", "'Current A'", "'A'", "stamp", "q"),
        _element("REGISTERS", "'Humidity B'", "'-'", "collected", "p"),
    ],
    "status": [
        _element("EVENTS", "'Service Door'", "'-'", "collected", "'0'",
                 where="l_linenumber <> 7", log="'1'", version="'Original'", code="q"),
        _element("EVENTS", "'Tamper Count'", "'-'", "collected", "p",
                 where="l_linenumber <> 7 AND open", log="'1'", version="'Original'",
                 code="'7'"),
    ],
    "profile_summary": [
        _element("REGISTERS", "'kWh Delivered'", "'kWh'", _NULL, "p", "'0.01'"),
    ],
    "outage_count": [_element("EVENTS", "'Outage count'", "'Count'", "stamp", "q")],
    "previous_outage_count": [
        _element("EVENTS", "'Outage count'", "'Count'", "collected", "q")
    ],
    "reverse_energy": [
        _element("REGISTERS", "'Reverse energy summary'", "'-'", _NULL, "q")
    ],
    "event_attribute": [
        _element("EVENTS", "'Magnitude1'", "'-'", "stamp", "q"),
        _element("EVENTS", "'Magnitude2'", "'-'", "collected", "p"),
    ],
    "interval": [
        _element("LOAD PROFILE READING", "'kWh Delivered'", "'kWh'", "stamp", "q",
                 "'0.01'", "l_linenumber <> 7", **_INTERVAL),
        _element("LOAD PROFILE READING", "'kWh Delivered'", "'kWh'", "collected", "p",
                 "'0.01'", "l_linenumber <> 7", **_INTERVAL, **_QUALITY),
    ],
}

_METER = "CASE WHEN l_linenumber <> 7 THEN {} END"
_TYPE = """CASE WHEN l_linenumber = 7 THEN NULL ELSE CASE l_suppkey % 9
 WHEN 0 THEN {} WHEN 1 THEN {} WHEN 2 THEN {} WHEN 3 THEN {} WHEN 4 THEN {}
 WHEN 5 THEN {} WHEN 6 THEN {} WHEN 7 THEN NULL ELSE 'Other' END END"""


def _type(*labels):
    return _TYPE.format(*[f"'{label}'" for label in labels])


_COMMON = {
    "servicePointId": _METER.format(
        "CASE WHEN l_linenumber % 2 = 1 THEN 'SP' || l_suppkey ELSE 'M' || l_partkey END"),
    "readingType": "readingType",
    "variableId": "variableId",
    "deviceId": _METER.format("'M' || l_partkey"),
    "meteringType": "'MAIN'",
    "readingDateSource": "readingTime",
    "readingLocalTime": "readingTime",
    "dstStatus": "dst",
    "channel": "CAST(channel AS INTEGER)",
    "unitOfMeasure": """CAST(CASE uom WHEN 'kW' THEN 96 WHEN 'kWh' THEN 74 WHEN 'kVAr' THEN 75
  WHEN 'kVA' THEN 78 WHEN 'kQ' THEN 81 WHEN '-' THEN 70 WHEN 'A' THEN 1
  WHEN 'Count' THEN 99 WHEN '°' THEN 98 END AS INTEGER)""",
    "qualityCodesSystemId": "qs",
    "qualityCodesCategorization": "qc",
    "qualityCodesIndex": "qi",
    "intervalSize": "CAST(intervalSize AS INTEGER)",
    "logNumber": "CAST(logNumber AS INTEGER)",
    "version": "version",
    "readingsValue": "readingsValue",
    "primarySource": "CASE l_returnflag WHEN 'A' THEN 'Remoto' WHEN 'N' THEN 'LAN' ELSE 'Phone' END",
    "readingsSource": "'HES'",
    "owner": "'OWNER'",
    "guidFile": "'guid'",
    "estatus": "'Activo'",
    "eventsCode": "eventsCode",
    "multiplier": "'''MultiplierValues'':{''ke'':''' || ke || '''}'",
    "deviceMaster": "CAST(l_suppkey AS VARCHAR)",
    "deviceStatus": _METER.format(
        "CASE WHEN open THEN 'ENABLE' WHEN l_linenumber > 1 THEN 'DISABLE' END"),
    "serial": _METER.format("CAST(l_orderkey AS VARCHAR)"),
    "accountNumber": _METER.format("'AC' || l_orderkey"),
    "servicePointTimeZone": _METER.format("CAST(l_partkey % 57 AS VARCHAR)"),
    "connectionType": _METER.format(
        "CASE l_linenumber % 3 WHEN 0 THEN 'TCP/Ethernet' WHEN 1 THEN 'RF' ELSE 'Fiber' END"),
    "relationStartDate": _METER.format(sql_time("l_shipdate")),
    "deviceType": _type(*["Electric meter"] * 5, "Water meter", "Gas meter"),
    "brand": _type(*["Elster"] * 7),
    "model": _type("Alpha A3", "Alpha", "A3 ILN", "A3 Collector", "REX", "EAWater", "EAGas"),
}


def readings_sql(kinds, without=()):
    elements = [e for kind in kinds for e in ELEMENTS[kind]]
    columns = ", ".join(
        f"{_COMMON.get(name, _NULL)} AS {name}"
        for name in S.READING_COLUMNS
        if name not in without
    )
    return (
        f"WITH {_LINES}, elements AS (" + "\nUNION ALL ".join(elements)
        + f") SELECT {columns} FROM elements"
    )


_NAMES = [
    "f01_max_demand", "f02_demand_reset_count", "f03_consumption",
    "f04_coincident_demand", "f05_cumulative_demand", "f06_demand_reset",
    "f07_instrumentation", "f08_status", "f09_profile_summary", "f10_outage_count",
    "f11_previous_outage_count", "f12_reverse_energy", "f13_event_attribute",
    "f14_interval",
]


def _register(name):
    kind = name[4:]

    @query(name, readings_sql([kind]))
    def run(spark, sf):
        docs = meter_documents(spark, sf, [KINDS[kind].path[0]])
        return readings_of(_keyed(docs), [kind])


for _name in _NAMES:
    _register(_name)


@query(
    "f_all_kinds",
    f"""WITH all_readings AS ({readings_sql(DEFAULT_KINDS)})
 SELECT readingType, variableId, unitOfMeasure, primarySource, model, count(*) AS readings,
  count(readingLocalTime) AS timed, count(readingsValue) AS valued,
  count(DISTINCT servicePointId) AS points
 FROM all_readings GROUP BY ALL""",
)
def all_kinds(spark, sf):
    """All kinds in one pass over the documents."""
    readings = readings_of(_keyed(meter_documents(spark, sf)))
    return readings.groupBy(
        "readingType", "variableId", "unitOfMeasure", "primarySource", "model"
    ).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count("readingLocalTime").alias("timed"),
        F.count("readingsValue").alias("valued"),
        F.count_distinct("servicePointId").alias("points"),
    )


# ---- sources and sinks -----------------------------------------------------------

_XML_KINDS = ["max_demand", "interval"]
_FILE_KEYS = ["readingsSource", "owner", "guidFile"]
_FILE_RECORDS = 50_000


_FRAME = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>', f"<{S.ROOT_TAG}>", f"</{S.ROOT_TAG}>")


def _joined(parts) -> Column:
    """Texts and columns of text one after the other; fixed ones next to each other as one."""
    merged = []
    for part in parts:
        if isinstance(part, str) and merged and isinstance(merged[-1], str):
            merged[-1] += part
        else:
            merged.append(part)
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in merged])


def _element(name, kind, part, depth, attributes) -> list:
    """The lines of an element as Spark's writer lays them out: attributes that are not
    null, then the children. ``attributes`` collects the texts of the attributes that are
    no fixed ones, by name and column, under the name of a column."""
    lead = "    " * depth
    head, children = [f"{lead}<{name}"], []
    for field in kind.fields:
        value = part.get(field.name)
        if value is None:
            continue
        if isinstance(field.dataType, T.StringType):
            start = f" {field.name.removeprefix('_')}="
            if isinstance(value, str):
                head.append(start + quoteattr(value))
            else:
                key = (start, id(value))
                text = F.concat(F.lit(f'{start}"'), value, F.lit('"'))
                attributes.setdefault(key, (f"_attribute{len(attributes)}", F.coalesce(text, F.lit(""))))
                head.append(F.col(attributes[key][0]))
        else:
            children += _elements(field.name, field.dataType, value, depth + 1, attributes)
    if not children:
        return [*head, "/>\n"]
    if any(isinstance(child, str) for child in children):
        return [*head, ">\n", *children, f"{lead}</{name}>\n"]
    body = _joined(children)
    around = F.concat(F.lit(">\n"), body, F.lit(f"{lead}</{name}>\n"))
    return [*head, F.when(body == "", "/>\n").otherwise(around)]


def _elements(name, kind, part, depth, attributes) -> list:
    if isinstance(part, _Given):
        given = _joined(_elements(name, kind, part.part, depth, attributes))
        return [F.when(part.condition, given).otherwise("")]
    entries, kind = (part, kind.elementType) if isinstance(part, list) else ([part], kind)
    return [text for entry in entries for text in _element(name, kind, entry, depth, attributes)]


def _escaped(text: Column) -> Column:
    for sign, code in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;"), ("\t", "&#x9;"), ("\n", "&#xa;"), ("\r", "&#xd;")):
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def _xml_folder(spark, sf, sections):
    """Documents in files of the layout of Spark's XML writer, which walks every value of
    every document by itself; here the texts between the values are fixed and compiled.
    Tags and attribute names fill most of the text. A packed file is read by one task, so
    files are kept small."""
    root = fresh_path(spark, "documents")
    items = table(spark, sf, "lineitem")
    tasks = spark.sparkContext.defaultParallelism
    files = tasks * max(1, math.ceil(items.count() / (_FILE_RECORDS * tasks)))
    numbered = items.withColumns(
        {"file": (F.monotonically_increasing_id() % files).cast("int"), "place": F.lit(0)}
    )
    ends = spark.range(files).select(
        F.col("id").cast("int").alias("file"),
        F.explode(F.array(F.lit(-1), F.lit(1))).alias("place"),
    )
    dealt = numbered.unionByName(ends, allowMissingColumns=True).repartitionById(files, "file")
    lines = _lines(dealt.sortWithinPartitions("place"))
    # The only text that comes from the table as it is.
    lines = lines.withColumn("tier", _escaped(F.col("tier")))
    document = _document(sections)
    kind = T.StructType([T.StructField(name, _FIELDS[name]) for name in document])
    attributes: dict = {}
    *parts, end = _element(S.ROW_TAG, kind, document, 1, attributes)
    # The text sink ends the line; an element that may have no child ends in a column.
    if isinstance(end, str):
        text = _joined([*parts, end.rstrip("\n")])
    else:
        text = F.rtrim(_joined([*parts, end]), F.lit("\n"))
    start, opening, closing = _FRAME
    value = F.when(F.col("place") < 0, f"{start}\n{opening}").when(F.col("place") > 0, closing)
    lines = lines.select("*", *[column.alias(name) for name, column in attributes.values()])
    lines.select(value.otherwise(text).alias("value")).write.option("compression", "gzip").text(
        f"{root}/OWNER/HES/day"
    )
    return root


def _from_xml(spark, sf, kinds, split_files):
    sections = list(dict.fromkeys(KINDS[kind].path[0] for kind in kinds))
    root = _xml_folder(spark, sf, sections)
    docs = documents.read_readings_xml(
        spark, f"{root}/OWNER/HES/day", None, split_files, read_schema(kinds)
    )
    return readings_of(documents.with_source_keys(docs, root), kinds).drop("guidFile")


@query("s01_read_readings_xml", readings_sql(_XML_KINDS, ["guidFile"]))
def s01(spark, sf):
    return _from_xml(spark, sf, _XML_KINDS, split_files=False)


@query("s01_read_readings_xml_split", readings_sql(_XML_KINDS, ["guidFile"]))
def s01_split(spark, sf):
    return _from_xml(spark, sf, _XML_KINDS, split_files=True)


@query("s01_read_all_sections", readings_sql(DEFAULT_KINDS, ["guidFile"]))
def s01_all(spark, sf):
    """All sections through the XML reader."""
    return _from_xml(spark, sf, list(DEFAULT_KINDS), split_files=True)


@query(
    "s02_source_keys",
    """SELECT o_orderkey, 'order-' || o_orderkey AS guidFile, o_orderpriority AS owner,
 o_orderstatus AS hes FROM orders""",
)
def s02(spark, sf):
    path = F.concat_ws(
        "/",
        F.lit("s3://landing"),
        "o_orderpriority",
        "o_orderstatus",
        F.date_format("o_orderdate", "yyyy/MM"),
        F.concat(F.lit("order-"), "o_orderkey", F.lit(".xml")),
    )
    orders = table(spark, sf, "orders")
    keys = documents.source_keys(path)
    return orders.select("o_orderkey", *[c.alias(name) for name, c in keys.items()])


_ORDER_TEXT_SQL = f"""CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
 CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END
 AS readingsValue, {sql_time('o_orderdate')} AS readingUtcLocalTime"""


def _order_texts(spark, sf):
    number = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return table(spark, sf, "orders").select(
        number.cast("string").alias("o_orderkey"),
        "o_orderstatus",
        F.when(number % 4 == 0, "").when(number % 4 != 0, price).alias("readingsValue"),
        F.col("o_orderdate").alias("readingUtcLocalTime"),
    )


@query("s03_read_staged_csv", f"SELECT {_ORDER_TEXT_SQL} FROM orders")
def s03(spark, sf):
    path = fresh_path(spark, "staged")
    source = _order_texts(spark, sf)
    sinks.write_csv(source, path)
    return tables.read_staged_csv(spark, path, source.columns)


_STORED_TYPE_SQL = """CASE o_orderstatus WHEN 'O' THEN 'REGISTERS'
 WHEN 'F' THEN 'LOAD PROFILE READING' ELSE 'EVENTS' END"""


def _stored_orders(spark, sf):
    status = F.col("o_orderstatus")
    return _order_texts(spark, sf).withColumn(
        "readingType",
        F.when(status == "O", "REGISTERS")
        .when(status == "F", "LOAD PROFILE READING")
        .otherwise("EVENTS"),
    )


_S04_SQL = f"""SELECT o_orderkey, readingType, readingUtcLocalTime FROM (
 SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, {_STORED_TYPE_SQL} AS readingType,
 o_orderdate AS t, {sql_time('o_orderdate')} AS readingUtcLocalTime FROM orders)
 WHERE readingType <> 'EVENTS' AND t >= """


@query(
    "s04_read_stored",
    _S04_SQL + "(SELECT min(l_shipdate) FROM lineitem WHERE l_returnflag = 'R') + INTERVAL 400 DAY",
)
def s04(spark, sf):
    """Stored rows from a batch's earliest time on, found without a driver trip."""
    path = fresh_path(spark, "stored")
    _stored_orders(spark, sf).write.parquet(path)
    batch = table(spark, sf, "lineitem").select(
        F.timestamp_add("DAY", F.lit(400), "l_shipdate").alias("readingUtcLocalTime"),
        F.when(F.col("l_returnflag") == "R", "REGISTERS").otherwise("EVENTS").alias("readingType"),
    )
    stored = tables.read_stored(spark, path, tables.earliest_time(batch), fmt="parquet")
    return shown(stored, "o_orderkey", "readingType", "readingUtcLocalTime")


@query("s04_read_stored_csv", _S04_SQL + "TIMESTAMP '1998-03-01 00:00:00'")
def s04_csv(spark, sf):
    path = fresh_path(spark, "stored")
    source = _stored_orders(spark, sf)
    sinks.write_csv(source, path)
    since = dt.datetime(1998, 3, 1)
    stored = tables.read_stored(spark, path, since, columns=source.columns)
    return shown(stored, "o_orderkey", "readingType", "readingUtcLocalTime")


@query("s05_write_csv", f"SELECT {_ORDER_TEXT_SQL} FROM orders")
def s05(spark, sf):
    path = fresh_path(spark, "out")
    sinks.write_csv(_order_texts(spark, sf), path)
    return spark.read.option("header", True).csv(path)


@query(
    "s06_write_final",
    f"""WITH {READINGS} SELECT CAST(identReading AS VARCHAR) AS identReading, variableId,
 {sql_time('readingUtcLocalTime')} AS readingUtcLocalTime,
 CAST(isoyear(DATE '2024-01-25') AS INTEGER) AS isoYear,
 CAST(week(DATE '2024-01-25') AS INTEGER) AS isoWeek,
 CASE WHEN variableId = 'view' THEN 'first' ELSE 'second' END AS batch FROM readings""",
)
def s06(spark, sf):
    path = fresh_path(spark, "final")
    df = event_readings(spark, sf).select("identReading", "variableId", "readingUtcLocalTime")
    # Two batches of one week; the second is run twice.
    first = F.col("variableId") == "view"
    sinks.write_final(df.filter(first), path, AS_OF, "first")
    for _ in range(2):
        sinks.write_final(df.filter(~first), path, AS_OF, "second")
    return spark.read.option("header", True).csv(path).withColumns(
        {c: F.col(c).cast("int") for c in ("isoYear", "isoWeek")}
    )
