"""The three stages on a small hand-made document, and invariants between steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import gaugeline as g
from gaugeline import schema as S
from gaugeline.functions import normalize as norm
from gaugeline.operators import enrich as en
from gaugeline.operators import intervals as iv
from gaugeline.operators import quality, versioning
from gaugeline.sources import sinks, tables
from gaugeline.sources.documents import read_readings_xml

DOCUMENT = """<?xml version="1.0"?><AMRDEF Purpose="Test">
<MeterReadings Irn="1" Source="Remote" SourceIrn="9" CollectionTime="2024-03-02 08:00:00">
 <Meter MeterIrn="1" IsActive="true" SerialNumber="77" MeterType="REX" SdpIdent="SP-A"
  TimeZoneIndex="11" MediaType="900Mhz" InstallDate="2024-02-20 10:00:00" RemovalDate=""/>
 <MaxDemandData><MaxDemandSpec UOM="kW" Direction="Delivered" TouBucket="Total" Multiplier="1"/>
  <Reading Value="9.5"/></MaxDemandData>
 <MaxDemandData><MaxDemandSpec UOM="kW" Direction="Delivered" TouBucket="TierA" Multiplier="1"/>
  <Reading Value="0" TimeStamp="2020-01-01 00:00:00"/></MaxDemandData>
 <ReverseEnergySummary><ReverseEnergy CurrentValue="4" PreviousValue="3"/></ReverseEnergySummary>
 <Statuses><Status Id="71" Name="Warning" Category="Tamper" Value="true"/>
  <Status Id="72" Name="Relay" Category="Service" Value="false"/></Statuses>
 <IntervalData><IntervalSpec UOM="kWh" Direction="Delivered" Interval="15" Channel="1" Multiplier="0.5"/>
  <Reading TimeStamp="2024-03-01 23:30:00" RawReading="2"/>
  <Reading TimeStamp="2024-03-01 23:30:00" RawReading="2"/>
  <Reading TimeStamp="2024-03-01 23:45:00" RawReading="4"><QualityFlags PartialOutage="1"/></Reading>
  <Reading TimeStamp="2024-03-02 00:30:00" RawReading="6"/>
  <Reading TimeStamp="2024-03-02 01:00:00" RawReading="7"/>
  <Reading TimeStamp="2024-03-02 01:15:00" RawReading="8"/>
  <Reading TimeStamp="2024-03-02 01:15:00" RawReading="9"/></IntervalData>
</MeterReadings>
<MeterReadings Irn="2" Source="LocalRF" CollectionTime="2024-03-02 08:00:00">
 <Meter MeterIrn="2" IsActive="false" TimeZoneIndex="99" MeterType="Solar" MediaType="Fiber"
  InstallDate="2024-02-20 10:00:00"/>
 <DemandReset TimeStamp="2024-03-01 10:00:00"/>
 <InstrumentationValue Name="" Value="1" Timestamp="2024-03-01 10:00:00" Phase="A"/>
</MeterReadings>
</AMRDEF>"""

AS_OF = dt.date(2024, 3, 3)
SETTINGS = g.Settings(outage_flags=("1-2-32",))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    day = root / "ACME" / "HEAD" / "2024"
    day.mkdir(parents=True)
    (day / "readings-1.xml").write_text(DOCUMENT)
    return root


@pytest.fixture(scope="module", params=[False, True], ids=["row tag", "split"])
def translated(spark, folder, request):
    return g.translate(
        spark, f"{folder}/ACME/HEAD/2024", root=str(folder), split_files=request.param
    ).cache()


@pytest.fixture(scope="module")
def lookups(spark):
    relation = spark.createDataFrame(
        [("SP-A", "1", True), ("2", "2", True)],
        "servicePointId string, deviceId string, result_rD boolean",
    )
    rows = [
        ("REGISTERS", "kW Delivered Total", "SP-A", True, True, "2024-02-25T00:00:00"),
        ("REGISTERS", "kW Delivered TierA", "SP-A", True, True, "2024-02-25T00:00:00"),
        ("REGISTERS", "Reverse energy summary", "SP-A", True, True, "2024-02-25T00:00:00"),
        ("EVENTS", "Tamper Warning", "SP-A", True, False, "2024-02-25T00:00:00"),
        ("LOAD PROFILE READING", "kWh Delivered", "SP-A", True, True, "2024-02-25T00:00:00"),
        ("EVENTS", "Demand Reset", "2", True, True, "2024-02-25T00:00:00"),
    ]
    variable = spark.createDataFrame(
        rows,
        "readingType string, variableId string, servicePointId string,"
        "result_sPV boolean, toStock boolean, lastReadDate string",
    )
    return relation, variable


def test_translate(translated):
    rows = translated.collect()
    assert translated.columns == S.READING_COLUMNS
    # Two demands, one reverse energy, one status, seven intervals, one reset.
    assert len(rows) == 12
    first = next(r for r in rows if r.variableId == "kW Delivered Total")
    assert first.readingLocalTime == "2024-03-02 08:00:00"
    assert (first.servicePointId, first.unitOfMeasure, first.primarySource) == ("SP-A", 96, "Remoto")
    assert (first.owner, first.readingsSource, first.guidFile) == ("ACME", "HEAD", "readings-1")
    assert (first.deviceStatus, first.connectionType, first.model) == ("ENABLE", "RF", "REX")
    assert first.multiplier == "'MultiplierValues':{'ke':'1'}"
    assert first.relationEndDate is None
    status = next(r for r in rows if r.variableId == "Tamper Warning")
    assert (status.readingsValue, status.eventsCode, status.logNumber) == ("0", "71", 1)
    reset = next(r for r in rows if r.variableId == "Demand Reset")
    assert (reset.servicePointId, reset.deviceStatus, reset.connectionType) == ("2", "DISABLE", "Fiber")
    assert reset.multiplier == "'MultiplierValues':{'ke':''}"


def test_stages(spark, translated, lookups):
    enriched = g.enrich(translated, *lookups, AS_OF)
    rows = enriched.collect()
    assert sorted(r.identReading for r in rows) == list(range(12))
    total = next(r for r in rows if r.variableId == "kW Delivered Total")
    assert total.readingUtcLocalTime == dt.datetime(2024, 3, 2, 13)
    assert (total.idDateYmd, total.idDateYw, total.dateCreation) == ("20240302", "20249", AS_OF)

    stored = spark.createDataFrame(
        [
            ("SP-A", "kWh Delivered", 1, dt.datetime(2024, 3, 2, 5, 30), "MAIN", "HEAD",
             "ACME", "LOAD PROFILE READING", "5", 3, "E", None, None, None),
            ("SP-A", "kWh Delivered", 1, dt.datetime(2024, 3, 2, 5, 30), "MAIN", "HEAD",
             "ACME", "LOAD PROFILE READING", "6", 2, "old", None, None, None),
            ("SP-A", "kWh Delivered", 1, dt.datetime(2024, 3, 2, 6, 0), "MAIN", "HEAD",
             "ACME", "LOAD PROFILE READING", "7 ", 1, None, None, None, None),
        ],
        "servicePointId string, variableId string, logNumber int,"
        "readingUtcLocalTime timestamp_ntz, meteringType string, readingsSource string,"
        "owner string, readingType string, readingsValue string, version int,"
        "estimationReading string, estimationValid string, editionReading string,"
        "editionValid string",
    )
    done = g.clean(enriched, stored, SETTINGS, AS_OF)
    reasons = {
        r.rejectReason: r["count"]
        for r in done.rejected.groupBy("rejectReason").count().collect()
    }
    assert reasons == {
        "result variable - to stock ": 1,
        "missing utc time": 2,
        "dias pasado-futuro": 1,
        "Duplicados": 1,
        "Valores inconsitentes": 2,
        "Versionamiento duplicados": 1,
    }
    assert done.accepted.columns == S.FINAL_COLUMNS
    series = sorted(
        done.accepted.filter("readingType like 'LOAD%'").collect(),
        key=lambda r: r.readingUtcLocalTime,
    )
    # 23:30, 23:45 with two outage gaps, 00:30; the repeated 01:00 and the
    # conflicting 01:15 are gone.
    assert [(r.readingLocalTime.hour, r.readingLocalTime.minute) for r in series] == [
        (23, 30), (23, 45), (0, 0), (0, 15), (0, 30),
    ]
    assert [r.readingsValue for r in series] == [2.0, 4.0, 0.0, 0.0, 6.0]
    assert [r.usageReading for r in series] == [1.0, 2.0, 0.0, 0.0, 3.0]
    assert [r.version for r in series] == [1, 1, 1, 1, 4]
    assert [r.estimationReading for r in series] == [None] * 5
    assert all(r.usageValid and r.IsGrouped is False for r in series)
    assert [r.identReading is None for r in series] == [False, False, True, True, False]
    actions = {
        r.categoryAction: r["count"]
        for r in done.reading_audit.groupBy("categoryAction").count().collect()
    }
    assert actions == {"Discard": 7, "Discard lapse time": 1, "ZeroFilling": 2}
    (record,) = done.interval_audit.collect()
    assert (record.result, record.readings) == ("Successful", 5)


def test_final_output(spark, tmp_path):
    df = spark.createDataFrame([(1, None, ""), (2, "x", "y")], "a int, b string, c string")
    path = str(tmp_path / "out")
    sinks.write_final(df, path, dt.date(2021, 1, 3), "run-1")
    sinks.write_final(df.filter("a = 1"), path, dt.date(2021, 1, 4), "run-2")
    for _ in range(2):  # another batch of a week, run twice
        sinks.write_final(df.filter("a = 2"), path, dt.date(2021, 1, 4), "run-3")
    found = spark.read.option("header", True).csv(path)
    weeks = sorted((r.isoYear, r.isoWeek, r["count"]) for r in found.groupBy("isoYear", "isoWeek").count().collect())
    assert weeks == [(2020, 53, 2), (2021, 1, 2)]
    assert {r.c for r in found.filter("a = 1").collect()} == {None}
    text = next((tmp_path / "out" / "isoYear=2021" / "isoWeek=1" / "batch=run-2").glob("*.csv")).read_text()
    assert text.splitlines()[1] == "1,,"


BROKEN = """<?xml version="1.0"?><AMRDEF Purpose="Test">
<MeterReadings Source="One"><Meter MeterIrn="1"/></MeterReadings>
<MeterReadings Source="Two"><Meter MeterIrn="2"/>
<MeterReadings Source="Three"><Meter MeterIrn="3"/></MeterReadings>
<MeterReadings Source="Four" />
<MeterReadings Source="Five"><Meter MeterIrn="5"></MeterReadings>
<MeterReadings Source="Six"><Meter MeterIrn="6"/>"""


def test_broken_elements_are_kept_apart(spark, tmp_path):
    day = tmp_path / "OWNER" / "HES"
    day.mkdir(parents=True)
    (day / "a.xml").write_text(BROKEN)
    (day / "b.xml").write_text(BROKEN[: BROKEN.index("Two")])
    docs = read_readings_xml(spark, str(day))
    read = [(r["_Source"], r["_corrupt"]) for r in docs.filter("_corrupt is null").collect()]
    assert sorted(read) == [("Four", None), ("One", None), ("One", None), ("Three", None)]
    lost = g.unparsed(spark, str(day), root=str(tmp_path)).collect()
    assert sorted(r.record.split('"')[1] for r in lost if r.guidFile == "a") == ["Five", "Six", "Two"]
    assert [r.record for r in lost if r.guidFile == "b"] == ['<MeterReadings Source="']
    assert {(r.owner, r.hes) for r in lost} == {("OWNER", "HES")}


def test_unknown_types_are_refused(spark):
    kinds = ["REGISTERS", "OTHER", None, "EVENTS", "LOAD PROFILE READING"]
    df = spark.createDataFrame(list(enumerate(kinds)), "n int, readingType string")
    marked = {r.n: r[quality.REASON] for r in quality.reject_unknown_type(df).collect()}
    reason = "unknown reading type"
    assert marked == {0: None, 1: reason, 2: reason, 3: None, 4: None}


def test_staged_csv_checks_header(spark, tmp_path):
    path = str(tmp_path / "staged")
    sinks.write_csv(spark.createDataFrame([("1", "2")], "a string, b string"), path)
    assert tables.read_staged_csv(spark, path, ["a", "b"]).collect() == [("1", "2")]
    with pytest.raises(Exception):
        tables.read_staged_csv(spark, path, ["b", "a"]).collect()


def test_settings_document():
    settings = g.Settings.from_document(
        {
            "configPastFutureDays": [
                {"type": "LP", "past": 5, "future": 1},
                {"type": "RE", "past": 7, "future": 2},
            ],
            "withNullsOrCero": {"withCeros": False},
            "QualityCode": {"PowerOutage": ["1-2-32"]},
        }
    )
    assert settings == g.Settings(5, 1, 7, 2, False, ("1-2-32",))


def test_utc_and_back(spark):
    times = spark.range(57).select(
        F.col("id").cast("string").alias("zone"),
        F.lit("2024-02-29 23:59:59").cast("timestamp_ntz").alias("local"),
    )
    from gaugeline.functions import times as t

    back = times.select(
        "local", t.to_local(t.to_utc(F.col("local"), F.col("zone")), F.col("zone")).alias("back")
    )
    assert back.filter("local <> back OR back IS NULL").count() == 0


def test_usage_value(spark):
    rows = [
        ("2", "'MultiplierValues':{'ke':'0.5'}", 1.0),
        ("2", "'MultiplierValues':{'ke':''}", 2.0),
        ("2", "'MultiplierValues':{'ke':'0.5','ct':'3','pt':''}", 3.0),
        ("2", "'MultiplierValues': {'ke': '0.5'}", 1.0),
        ("2", "'MultiplierValues':{'ke':'half'}", None),
        ("two", "'MultiplierValues':{'ke':'1'}", None),
        (None, "'MultiplierValues':{'ke':'1'}", None),
        ("2", None, None),
    ]
    df = spark.createDataFrame(rows, "v string, m string, expected double")
    found = df.select(norm.usage_value(F.col("v"), F.col("m")).alias("u"), "expected")
    assert [r.u for r in found.collect()] == [r[2] for r in rows]


def series(spark, times, step=15, key=("P", "D", "MAIN", "V", None)):
    rows = [
        (*key, dt.datetime.fromisoformat(t), step, i) for i, t in enumerate(times)
    ]
    return spark.createDataFrame(
        rows,
        "servicePointId string, deviceId string, meteringType string,"
        "variableId string, logNumber int, readingUtcLocalTime timestamp_ntz,"
        "intervalSize int, identReading int",
    )


def test_fill_matches_brute_force(spark):
    times = [
        "2024-01-01 00:05:00", "2024-01-01 00:20:00", "2024-01-01 00:22:00",
        "2024-01-01 23:50:00", "2024-01-04 00:00:00", "2024-01-04 00:15:00",
    ]
    filled = iv.fill_gaps(series(spark, times))
    found = sorted((r.readingUtcLocalTime, r.identReading, r.isOriginal) for r in filled.collect())
    stamps = [dt.datetime.fromisoformat(t) for t in times]
    expected = []
    for i, start in enumerate(stamps):
        stop = stamps[i + 1] if i + 1 < len(stamps) else start
        at, first = start, True
        while first or at < stop:
            expected.append((at, i, first))
            at, first = at + dt.timedelta(minutes=15), False
    assert found == sorted(expected)


def test_long_gap_is_filled_whole(spark):
    df = series(spark, ["2020-01-01 00:00:00", "2024-01-01 00:00:00"], step=5)
    minutes = (dt.datetime(2024, 1, 1) - dt.datetime(2020, 1, 1)).total_seconds() / 60
    assert iv.fill_gaps(df).count() == minutes / 5 + 1
    assert iv.expected_grid(df).count() == minutes / 5 + 1


def test_bad_step_fills_nothing(spark):
    times = ["2024-01-01 00:00:00", "2024-01-02 00:00:00"]
    for step in (0, -5, None):
        assert iv.fill_gaps(series(spark, times, step)).count() == 2


def test_conflicts_count_null_as_value(spark):
    df = spark.createDataFrame(
        [("a", "1"), ("a", "1"), ("b", "1"), ("b", None), ("c", None), ("c", None), ("d", "1"), ("d", "2")],
        "k string, readingsValue string",
    )
    found = quality.conflicting_keys(df, ["k"]).collect()
    assert sorted(r.k for r in found) == ["b", "d"]


def test_dedupe_is_idempotent(spark):
    from catalog.base import event_readings

    readings = event_readings(spark, "/root/testdata/sf0.001")
    once = quality.resolve_duplicates(readings)
    kept, _ = quality.split(once.drop("copies"))
    again = quality.resolve_duplicates(kept)
    assert again.filter("copies > 1 OR rejectReason IS NOT NULL").count() == 0
    assert again.count() == kept.count()
    assert once.agg(F.sum("copies")).first()[0] == readings.count()


def test_accepted_and_rejected_make_the_input(spark):
    from catalog.base import event_readings

    readings = event_readings(spark, "/root/testdata/sf0.001")
    flagged = quality.require_utc(
        quality.reject_unstorable(quality.reject_unassociated(readings))
    )
    accepted, rejected = quality.split(flagged)
    assert accepted.count() + rejected.count() == readings.count()


def test_number_rows_keeps_input_order(spark):
    df = spark.range(1000).repartition(7)
    order = [r.id for r in df.collect()]
    numbered = en.number_rows(df).collect()
    assert sorted(r.identReading for r in numbered) == list(range(1000))
    assert {r.identReading: r.id for r in numbered} == dict(enumerate(order))


def test_topology_request_parts_hold_everything(spark):
    from catalog.base import event_readings

    readings = event_readings(spark, "/root/testdata/sf0.001")
    one = en.topology_request(readings, chunk=10**6)
    many = en.topology_request(readings, chunk=10)
    assert one.select("part").distinct().count() == 1
    assert many.count() > one.count()


def test_changed_value_takes_next_version(spark):
    key = "servicePointId string, variableId string, logNumber int, readingUtcLocalTime string, meteringType string, readingsSource string, owner string"
    new = spark.createDataFrame(
        [("p", "v", None, "t", "m", "s", "o", "REGISTERS", "5")], key + ", readingType string, readingsValue string"
    )
    stored = spark.createDataFrame(
        [("p", "v", None, "t", "m", "s", "o", "4", n, "e", "x", None, None) for n in (1, 2)],
        key + ", readingsValue string, version int, estimationReading string,"
        "estimationValid string, editionReading string, editionValid string",
    )
    (row,) = versioning.assign_version(new, versioning.latest_version(stored)).collect()
    assert (row.version, row.estimationReading, row.rejectReason) == (3, "e", None)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_session_zone_does_not_matter(spark, zone):
    """Spring clock changes of the session zone leave times and gaps alone."""
    from gaugeline.functions import times as t

    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = series(spark, ["2024-03-10 01:30:00", "2024-03-10 03:30:00"], step=30)
        filled = iv.fill_gaps(df).select(
            t.time_text(F.col("readingUtcLocalTime")).alias("x"),
            t.date_key(F.col("readingUtcLocalTime")).alias("d"),
        )
        found = sorted(tuple(r) for r in filled.collect())
        span = df.agg(
            t.minutes_between(F.min("readingUtcLocalTime"), F.max("readingUtcLocalTime"))
        ).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert span == 120
    assert found == [
        (f"2024-03-10 {at}:00", "20240310")
        for at in ("01:30", "02:00", "02:30", "03:00", "03:30")
    ]


def test_segments_against_a_walk_along_each_series(spark):
    import random

    rng = random.Random(5)
    rows = []
    for point in range(40):
        minute, size = rng.randrange(3000), rng.choice([15, 60])
        for _ in range(rng.randrange(1, 60)):
            rows.append((f"P{point}", minute, size))
            minute += (size or 7) * rng.choice([1, 1, 1, 2, 40])
            size = rng.choice([size] * 8 + [15, 30, 60, None])
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    table = spark.createDataFrame(rows, "p string, minute long, intervalSize int").repartition(7)
    df = table.withColumn("readingUtcLocalTime", F.timestamp_add("MINUTE", F.col("minute"), start))
    found = {(r["p"], r["minute"]): r["segment"] for r in iv.with_segment(df, ["p"]).collect()}
    want, last = {}, None
    for point, minute, size in sorted(rows, key=lambda r: (r[0], r[1])):
        number = 0 if last is None or last[0] != point else last[2] + (size != last[1])
        want[point, minute] = number
        last = (point, size, number)
    assert found == want and max(want.values()) > 3


def test_a_series_that_changes_its_interval_can_be_complete(spark):
    rows = [("A", m, 60) for m in range(0, 600, 60)] + [("A", m, 15) for m in range(600, 3000, 15)]
    rows += [("B", m, 60) for m in range(0, 600, 60)] + [("B", m, 15) for m in range(600, 3000, 15) if m != 900]
    rows += [("C", 0, 15), ("C", 15, None), ("C", 30, 15)]
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    table = spark.createDataFrame(rows, "p string, minute long, intervalSize int")
    df = table.withColumn("readingUtcLocalTime", F.timestamp_add("MINUTE", F.col("minute"), start))
    filled = iv.fill_gaps(df, ["p"], order=["minute"])
    marked = filled.withColumn("intervalMark", F.when(F.col("isOriginal"), "1"))
    got = {r["p"]: r for r in iv.series_summary(marked, ["p"]).collect()}
    assert (got["A"]["expected"], got["A"]["actual"], got["A"]["missing"], got["A"]["result"]) == (170, 170, 0, "Successful")
    assert (got["B"]["expected"], got["B"]["actual"], got["B"]["missing"], got["B"]["result"]) == (170, 169, 1, "Failed")
    assert got["C"]["expected"] is None and got["C"]["result"] == "Failed"


def test_positions_in_a_group_that_holds_most_rows(spark):
    from gaugeline.operators.keyed import with_position

    number = F.col("id")
    df = spark.range(4000).select(
        F.when(number % 10 < 8, "hot").when(number % 10 == 8, F.concat(F.lit("g"), number % 7)).alias("g"), (number % 100).alias("o"), "id"
    ).repartition(5)
    rows = with_position(df, ["g"], ["o", "id"]).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r["o"], r["id"])):
        by.setdefault(r["g"], []).append(r["position"])
    assert all(p == list(range(len(p))) for p in by.values()) and len(by) == 9
    assert len(by["hot"]) == 3200 and len(by[None]) == 400


def test_documents_of_the_round_trip_are_packed(spark):
    from pathlib import Path

    from catalog.documents import _xml_folder

    root = _xml_folder(spark, "/root/testdata/sf0.001", ["MaxDemandData"])
    files = [f for f in Path(root).rglob("part-*")]
    text = sum(len(row.value) for row in spark.read.text([str(f) for f in files]).collect())
    assert files and 8 * sum(f.stat().st_size for f in files) < text


def test_unit_that_is_no_number_is_not_cast(spark):
    rows = [("acre",), ("",), (None,), ("7",), (" +8 ",), ("-9",), ("1e3",), (".5",), ("5x",), ("\t6",)]
    df = spark.createDataFrame(rows, "u string")
    found = df.select(norm.whole_number(F.col("u")).alias("a"), F.col("u").try_cast("int").alias("b")).collect()
    assert [r.a for r in found] == [r.b for r in found]
    assert "RLIKE" in df.select(norm.uom_code(F.col("u")))._jdf.queryExecution().analyzed().toString()


def test_no_value_needs_no_factors(spark):
    df = spark.createDataFrame([(None, "'MultiplierValues':{'ke':'1','pt':'2'}")], "v string, m string")
    usage = df.select(norm.usage_value(F.col("v"), F.col("m")).alias("u"))
    plan = usage._jdf.queryExecution().analyzed().toString()
    assert "isnull" in plan[: plan.index("from_json")] and usage.first().u is None


def test_one_kind_needs_no_lambda(spark):
    from catalog.documents import _keyed, meter_documents
    from gaugeline.operators.flatten import KINDS, flatten_readings

    for name, kind in KINDS.items():
        docs = _keyed(meter_documents(spark, "/root/testdata/sf0.001", [kind.path[0]]))
        plan = flatten_readings(docs, [name])._jdf.queryExecution().optimizedPlan().toString()
        assert "lambda" not in plan
