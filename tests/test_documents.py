"""What is read of a document, and where its columns are made."""

import glob
import gzip

import pytest
from pyspark.sql import functions as F

from catalog.documents import _escaped, _keyed, _xml_folder, meter_documents, readings_of
from gaugeline import schema as S
from gaugeline.operators.flatten import DEFAULT_KINDS, flatten_readings, read_schema
from gaugeline.sources.documents import document_schema, read_readings_xml, with_source_keys

SF = "/root/testdata/sf0.001"

# Empty and unread parts, texts where attributes are expected, names in other letter case.
ODD = """<?xml version="1.0"?><AMRDEF>
<MeterReadings Source="Remote" CollectionTime="2024-03-02 08:00:00"><Meter/>
 <MaxDemandData><MaxDemandSpec MeasurementPeriod="5"/><Reading>9</Reading></MaxDemandData>
 <maxdemanddata><MaxDemandSpec uom="kW" DIRECTION="Delivered" TouBucket="A"/><Reading value="2"/></maxdemanddata>
 <MaxDemandData/> <!-- none -->
 <Statuses><Status Type="x"/><Status Category="a" Name="b" Value="true" Id="1">text</Status></Statuses><Statuses/>
 <EventData><EventSpec Category="c"/><Event EventInfo="i"/><Event TimeStamp="2024-03-01 08:00:00"><![CDATA[ <x> ]]>
  <EventAttribute Name="n &amp; m" Value="&lt;7"/><EventAttribute/></Event></EventData>
 <OutageCountSummary><OutageCount PreviousValue="3"/></OutageCountSummary>
 <DemandReset Other="1"/><DemandResetCount>4</DemandResetCount>
 <IntervalData><IntervalSpec UOM="kWh" Direction="Delivered" TimestampEnd="x"/>
  <Reading RawReading="1" TimeStamp="2024-03-01 08:00:00"><QualityFlags/></Reading>
  <Reading RawReading="2">text<QualityFlags Tamper="1" Unknown="1"/></Reading>
  <Reading><QualityFlags>text</QualityFlags></Reading></IntervalData>
</MeterReadings>
<MeterReadings Source="Remote" CollectionTime="2024-03-02 08:00:00">
 <Statuses><Status Category="a" Name="b" Value="true"/></Statuses>
</MeterReadings>
<MeterReadings><Meter Location="only this"/><Statuses><Status Category="a" Name="b"/></Statuses></MeterReadings>
<MeterReadings/>
</AMRDEF>"""


@pytest.mark.parametrize("split_files", [False, True], ids=["row tag", "split"])
def test_unread_parts_change_no_reading(spark, tmp_path, split_files):
    day = tmp_path / "OWNER" / "HES"
    day.mkdir(parents=True)
    (day / "odd.xml").write_text(ODD)

    def rows(kinds, schema):
        docs = read_readings_xml(spark, str(day), None, split_files, schema)
        assert [r["_corrupt"] for r in docs.collect()] == [None] * 4
        return sorted(map(str, readings_of(with_source_keys(docs, str(tmp_path)), kinds).collect()))

    whole = rows(DEFAULT_KINDS, None)
    # One demand, one status, one event attribute, an outage count, a reset, a reset count,
    # three intervals, and a status of the meter that is known by its location alone.
    assert len(whole) == 10
    assert rows(DEFAULT_KINDS, read_schema()) == whole
    for name in ("status", "previous_outage_count", "event_attribute", "interval"):
        assert rows([name], read_schema([name])) == rows([name], None)


def test_only_read_parts_are_parsed():
    schema = read_schema(["interval", "max_demand"])
    assert [f.name for f in schema.fields] == [
        name for name in document_schema(["IntervalData", "MaxDemandData"]).fieldNames()
        if name != S.CORRUPT_COLUMN
    ]
    text = "".join(f.simpleString() for f in schema.fields if f.name != "Meter")
    assert S.VALUE_TAG not in text and "_MeasurementPeriod" not in text
    assert schema["Meter"] == S.DOCUMENT_SCHEMA["Meter"]


def test_pieces_are_cut_once(spark, tmp_path):
    (tmp_path / "odd.xml").write_text(ODD)
    docs = read_readings_xml(spark, str(tmp_path), ["DemandReset"])
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(" not in plan and "length(" not in plan
    kept = [line for line in plan.splitlines() if "Project" in line]
    assert sum(line.count("split(") for line in kept) == 1


def test_documents_are_made_without_casts(spark):
    plan = meter_documents(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(array(" not in plan and "cast(struct(" not in plan


def test_columns_of_a_document_are_made_before_the_explode(spark):
    for kinds in (DEFAULT_KINDS, ["interval"]):
        plan = readings_of(_keyed(meter_documents(spark, SF)), kinds)
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        above = text[: text.index("Generate explode")]
        assert "Alpha A3" not in above and "Alpha A3" in text
        assert "Meter" not in above.replace("MeterIrn", "")


def test_prefix_of_flat_readings(spark):
    elements = flatten_readings(_keyed(meter_documents(spark, SF, ["DemandReset"])), ["demand_reset"])
    assert {"servicePointId", "model", "guidFile", "variableId", "quality"} <= set(elements.columns)
    assert elements.filter(F.col("serial").isNotNull()).count() > 0


@pytest.mark.parametrize("sections", [None, ["MaxDemandData", "IntervalData"], ["MaxDemandData"]], ids=["all", "two", "one"])
def test_files_are_those_of_the_xml_writer(spark, tmp_path, sections):
    """Every element as Spark's writer has it, in sound files of about equal size."""
    docs = meter_documents(spark, SF, sections)
    options = {"rootTag": S.ROOT_TAG, "rowTag": S.ROW_TAG, "attributePrefix": "_", "valueTag": S.VALUE_TAG}
    docs.write.format("xml").options(**options).save(str(tmp_path / "spark"))
    root = _xml_folder(spark, SF, sections).removeprefix("file:")
    written = {}
    for name, opened, pattern in (
        ("spark", open, f"{tmp_path}/spark/part-*"),
        ("compiled", gzip.open, f"{root}/OWNER/HES/day/part-*.gz"),
    ):
        texts = [opened(path, "rt", encoding="utf-8").read().rstrip("\n") for path in glob.glob(pattern)]
        heads = {text.split("    <MeterReadings ")[0] for text in texts}
        assert all(text.endswith("\n</AMRDEF>") for text in texts)
        records = [text.removesuffix("\n</AMRDEF>").split("    <MeterReadings ")[1:] for text in texts]
        written[name] = heads, sorted(record.rstrip("\n") for part in records for record in part)
    assert written["compiled"] == written["spark"]
    assert max(map(len, records)) - min(map(len, records)) <= 4


def test_texts_of_the_table_are_escaped(spark):
    row = spark.createDataFrame([('a<b&"c"\n',)], "text string").select(_escaped(F.col("text"))).first()
    assert row[0] == "a&lt;b&amp;&quot;c&quot;&#xa;"
