"""What the physical plans must show for large data."""

import pytest
from pyspark.sql import functions as F

from catalog.base import event_readings
from gaugeline import schema as S
from gaugeline.operators import enrich, intervals as iv
from gaugeline.operators import keyed, quality, versioning
from gaugeline.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "step", [quality.drop_duplicates, quality.duplicate_report, quality.reject_conflicts, quality.resolve_duplicates]
)
def test_copies_are_found_by_hash_aggregates_of_numbers(spark, step):
    """No sort of rows to group them, no row inside an aggregate, no window."""
    text = plan(step(event_readings(spark, SF)))
    assert "SortAggregate" not in text and "Window" not in text
    aggregates = [line for line in text.splitlines() if "HashAggregate" in line]
    assert not any("multiplier" in line for line in aggregates)


SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


@pytest.fixture
def split_early(spark):
    """Adaptive skew handling at test sizes."""
    for name, value in SPLIT_EARLY.items():
        spark.conf.set(name, value)
    yield
    for name in SPLIT_EARLY:
        spark.conf.unset(name)


def hot_readings(spark, rows=100_000):
    """One key has most readings: many instants, or many values at one instant."""
    number = F.col("id")
    hot = number % 10 < 8
    return spark.range(0, rows, numPartitions=8).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("P"), number)).alias("servicePointId"),
        F.lit("D").alias("deviceId"),
        F.lit("MAIN").alias("meteringType"),
        F.lit("V").alias("variableId"),
        F.lit(None).cast("int").alias("logNumber"),
        F.lit("LOAD PROFILE READING").alias("readingType"),
        F.lit("HES").alias("readingsSource"),
        F.lit("OWNER").alias("owner"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("readingLocalTime"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("readingUtcLocalTime"),
        number.cast("string").alias("readingsValue"),
        number.alias("identReading"),
        F.lit(15).alias("intervalSize"),
        F.lit("1").alias("intervalMark"),
        F.sha2(number.cast("string"), 256).alias("payload"),
    )


def _conflicts(df):
    return quality.resolve_duplicates(df)


def _conflicts_only(df):
    return quality.reject_conflicts(df)


def _versions(df):
    kept = {c: F.lit("x") for c in versioning._KEPT}
    stored = df.filter("identReading % 10 > 6").withColumns({"version": F.lit(1), **kept})
    return versioning.assign_version(df, versioning.latest_version(stored))


def _relations(df):
    relation = df.select("servicePointId", "deviceId").distinct()
    return enrich.join_relation_flags(df, relation.withColumn("result_rD", F.lit(True)))


def _variables(df):
    variable = df.select("variableId", "servicePointId", "readingType").distinct()
    flags = {"result_sPV": F.lit(True), "toStock": F.lit(True), "lastReadDate": F.lit("")}
    return enrich.join_variable_flags(df, variable.withColumns(flags))


def _validation(df):
    return iv.validate_intervals(df, iv.series_summary(df))


def _anti(df):
    return keyed.anti_join(df, df.filter("servicePointId <> 'HOT'"), ["servicePointId", "deviceId"])


@pytest.mark.parametrize(
    "step",
    [_conflicts, _conflicts_only, _versions, _relations, _variables, _validation, _anti],
)
def test_hot_key_join_is_split(spark, split_early, step):
    """A key with most rows is cut into several tasks on the row side."""
    joined = step(hot_readings(spark))
    total = joined.agg(F.count("payload"), F.max("payload"))
    assert total.collect()[0][0] == (80_000 if step is _anti else 100_000)
    assert "skew=true" in plan(total)


def test_next_time_shuffles_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(iv.with_next_time(event_readings(spark, SF)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows once; the small table of slice starts by slice, series and slice.
    assert text.count("Exchange hashpartitioning") == 4
    wide = [line for line in text.splitlines() if "Exchange" in line and "_slice" in line]
    assert wide


def test_stored_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "stored")
    event_readings(spark, SF).write.parquet(path)
    since = tables.earliest_time(event_readings(spark, SF))
    text = formatted(tables.read_stored(spark, path, since, fmt="parquet"))
    assert "GreaterThanOrEqual(readingUtcLocalTime,ScalarSubquery" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_versions_read_only_needed_columns(spark, tmp_path):
    path = str(tmp_path / "stored")
    event_readings(spark, SF).withColumn("version", F.lit(1)).write.parquet(path)
    stored = spark.read.parquet(path).select(
        "servicePointId", "variableId", "logNumber", "readingUtcLocalTime",
        "meteringType", "readingsSource", "owner", "readingsValue", "version",
    )
    text = formatted(versioning.latest_version(stored))
    assert "readingsValue" in text and "multiplier" not in text


def test_summary_needs_no_window(spark):
    df = event_readings(spark, SF).withColumn("intervalMark", F.lit("1"))
    text = plan(iv.series_bounds(df, S.SERIES_KEY, iv.TIME, iv.STEP, "intervalMark", ["owner"]))
    assert "Window" not in text and text.count("Exchange") == 1


def _series(spark, rows):
    """(point, minute, interval) as readings of series."""
    table = spark.createDataFrame(rows, "servicePointId string, minute long, intervalSize int")
    start = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return table.select(
        "servicePointId",
        *[F.lit("x").alias(c) for c in ("deviceId", "meteringType", "variableId")],
        F.lit(1).alias("logNumber"),
        F.timestamp_add("MINUTE", F.col("minute"), start).alias("readingUtcLocalTime"),
        "intervalSize",
        F.lit(0).alias("identReading"),
    )


def _per_task(df):
    counts = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return sorted(r["count"] for r in counts)


def test_grid_of_one_huge_and_many_tiny_series_is_even(spark):
    rows = [("HUGE", 0, 1), ("HUGE", 3_000_000, 1)]
    rows += [(f"P{n}", m, 15) for n in range(3000) for m in (0, 15 * (n % 40))]
    tasks = _per_task(iv.expected_grid(_series(spark, rows)))
    assert sum(tasks) == 3_000_001 + sum(n % 40 + 1 for n in range(3000))
    assert len(tasks) == 4 and tasks[-1] <= 2 * tasks[len(tasks) // 2]
    assert tasks[-1] - tasks[0] <= 4


def test_one_long_gap_is_filled_by_all_tasks(spark):
    rows = [("LONG", 0, 1), ("LONG", 10_000_000, 1), ("P", 0, 15), ("P", 60, 15), ("P", 50_000, 15)]
    filled = iv.fill_gaps(_series(spark, rows))
    tasks = _per_task(filled.filter("servicePointId = 'LONG' and not isOriginal"))
    assert sum(tasks) == 9_999_999 and len(tasks) == 4
    assert tasks[-1] <= 1.5 * tasks[0]
    other = filled.filter("servicePointId = 'P'")
    assert other.filter("isOriginal").count() == 3
    assert other.count() == 1 + 50_000 // 15 + 1


@pytest.mark.parametrize("gap", [9_999, 10_000, 10_001, 10_002, 11_520, 20_000, 20_001, 20_002])
@pytest.mark.parametrize("first", [0, 1439])
def test_gaps_at_the_edge_of_a_chunk(spark, gap, first):
    rows = [("P", first, 1), ("P", first + gap, 1), ("P", first + gap + 1, 1)]
    got = iv.fill_gaps(_series(spark, rows)).select("readingUtcLocalTime", "isOriginal").collect()
    assert len(got) == gap + 2 and len({r[0] for r in got}) == gap + 2
    assert sum(r[1] for r in got) == 3


def test_row_numbers_force_no_broadcast(spark):
    df = event_readings(spark, SF).drop("identReading")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = enrich.number_rows(df, ["readingLocalTime"])
        assert "Broadcast" not in plan(numbered)
        numbers = sorted(r[0] for r in numbered.select("identReading").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert numbers == list(range(df.count()))


def test_summary_with_attributes_hashes_numbers(spark):
    """Texts to carry along are keys of a hash aggregate: filled rows are not sorted."""
    df = event_readings(spark, SF).withColumn("intervalMark", F.lit("1"))
    text = plan(iv.series_bounds(df, S.SERIES_KEY, iv.TIME, iv.STEP, "intervalMark", ["owner", "guidFile"]))
    assert "HashAggregate" in text and "Sort" not in text


def test_attributes_are_the_least_of_their_series(spark):
    rows = [("P", 0, 15), ("P", 15, 15), ("Q", 0, 15)]
    df = _series(spark, rows).withColumns(
        {"intervalMark": F.lit("1"), "guidFile": F.concat(F.lit("f"), F.minute("readingUtcLocalTime"))}
    )
    got = iv.series_summary(df, attributes=["guidFile"]).collect()
    assert {(r["servicePointId"], r["guidFile"], r["actual"], r["result"]) for r in got} == {
        ("P", "f0", 2, "Successful"), ("Q", "f0", 1, "Successful")
    }


def test_gaps_that_are_not_long_pass_the_rows_once(spark):
    rows = [("P", 0, 15), ("P", 60, 15), ("P", 50_000, 15)]
    text = plan(iv.fill_gaps(_series(spark, rows)))
    assert "Union" not in text and text.count("Sort [_slice") == 1


def test_segments_pass_the_rows_once(spark):
    """What numbers the stretches is one row per day and stretch, written before."""
    text = plan(iv.segment_summary(_series(spark, [("P", 0, 15), ("P", 1440, 60)]).withColumn("intervalMark", F.lit("1"))))
    assert "LocalTableScan" not in text and "ExistingRDD" not in text and "stretches-" in text


def _cleaned(spark):
    from pathlib import Path

    from catalog.stages import _cleaned as cleaned

    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.glob("filled-*"))
    return cleaned(spark, SF), lambda: set(folder.glob("filled-*")) - before


def test_rejects_and_audits_make_no_filled_table(spark):
    result, made = _cleaned(spark)
    assert result.rejected.count() > 0 and result.reading_audit.count() > 0
    assert result.lifecycle_audit.count() > 0 and not made()
    assert result.accepted.count() > 0 and len(made()) == 1


def test_fill_counts_are_the_rows_that_filling_makes(spark):
    rows = [("LONG", 0, 1), ("LONG", 30_000, 1), ("P", 0, 15), ("P", 67, 15), ("P", 5000, 15), ("N", 0, 0), ("N", 90, 0)]
    series = _series(spark, rows)
    counted = iv.fill_counts(series).groupBy("servicePointId").agg(F.sum("rows"))
    filled = iv.fill_gaps(series).groupBy("servicePointId").count()
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, filled.collect()))


def test_topology_request_is_parsed_once(spark):
    from catalog import QUERIES

    text = QUERIES["e08_topology_request"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_least_order_of_topology_is_hashed(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(enrich, "written", lambda df, name: steps.append((name, plan(df))) or df)
    enrich.topology_entries(event_readings(spark, SF))
    assert "SortAggregate" not in dict(steps)["topology"]


def test_position_gives_up_its_order(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "g string, o int").withColumn("v", F.col("o") * 10)
    rows = keyed.with_position(df, ["g"], ["o"], keep_order=False)
    assert rows.columns == ["g", "v", "position"]
    assert sorted(map(tuple, rows.collect())) == [("a", 10, 0), ("a", 20, 1), ("b", 50, 0)]
