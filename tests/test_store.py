"""The versioned store: what a batch reads of it."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

import gaugeline as g
from catalog import stages
from gaugeline.operators import versioning
from gaugeline.sources import store
from gaugeline.sources.scratch import written


def readings(spark, rows):
    """(point, time text or null, value, version) as stored readings."""
    table = spark.createDataFrame(rows, "servicePointId string, t string, readingsValue string, version string")
    constant = {"variableId": "V", "meteringType": "MAIN", "readingsSource": "HES", "owner": "O", "readingType": "REGISTERS"}
    return table.select(
        "servicePointId",
        F.col("t").cast("timestamp_ntz").alias("readingUtcLocalTime"),
        *[F.lit(v).alias(k) for k, v in constant.items()],
        F.lit(None).cast("int").alias("logNumber"),
        "readingsValue",
        "version",
        *[F.lit(None).cast("string").alias(c) for c in versioning._KEPT],
    )


@pytest.fixture
def table(spark, tmp_path):
    name = f"store_{uuid.uuid4().hex}"
    days = [dt.date(2023, 12, 1) + dt.timedelta(days=n) for n in range(120)]
    rows = [(f"P{k}", f"{d} 12:00:00", str(v), str(v)) for d in days for k in range(3) for v in (1, 2)]
    store.append_versions(readings(spark, rows + [("P0", None, "9", "9")]), name, str(tmp_path / name), buckets=2)
    yield name
    spark.sql(f"DROP TABLE {name}")


def scans(plan):
    """The leaf scans of a plan that ran, also those inside its stages."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return scans(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return scans(plan.plan())
    if name == "ReusedExchangeExec":
        return scans(plan.child())
    if name == "FileSourceScanExec":
        return [plan]
    children = plan.children()
    return [scan for n in range(children.size()) for scan in scans(children.apply(n))]


def test_a_batch_of_one_day_reads_one_week(spark, table):
    batch = written(readings(spark, [("P1", "2024-01-10 12:00:00", "5", "1"), ("P2", "2024-01-10 12:00:00", "5", "1")]))
    found = versioning.latest_version(store.versions_of_batch(store.read_versions(spark, table), batch))
    rows = found.collect()
    assert sorted((r["servicePointId"], r["version"]) for r in rows) == [("P1", "2"), ("P2", "2")]
    mine = [s for s in scans(found._jdf.queryExecution().executedPlan()) if "readingWeek" in s.toString() and "storeKey" in s.toString()]
    assert mine
    for scan in mine:
        assert scan.metrics().apply("numPartitions").value() == 1
        assert scan.metrics().apply("numFiles").value() <= 2  # the week's buckets


def test_weeks_far_apart_do_not_read_what_is_between(spark, table):
    batch = written(readings(spark, [("P1", "2023-12-02 12:00:00", "5", "1"), ("P1", "2024-03-05 12:00:00", "5", "1"), ("P1", None, "5", "1")]))
    found = store.versions_of_batch(store.read_versions(spark, table), batch)
    assert len(found.collect()) == 4
    weeks = [s.metrics().apply("numPartitions").value() for s in scans(found._jdf.queryExecution().executedPlan()) if "storeKey" in s.toString()]
    assert weeks == [2]


def test_stored_side_is_not_shuffled(spark, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        batch = written(readings(spark, [("P1", "2024-01-10 12:00:00", "5", "1")]))
        found = store.versions_of_batch(store.read_versions(spark, table), batch)
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    joined = text[text.index("SortMergeJoin") :]
    stored = joined[: joined.index("FileScan")]
    assert "storeKey" in stored and "hashpartitioning" not in stored


def test_versions_grow_by_appending(spark, table, tmp_path):
    for v in (3, 4):
        store.append_versions(readings(spark, [("P1", "2024-01-10 12:00:00", str(v), str(v))]), table, buckets=2)
    batch = written(readings(spark, [("P1", "2024-01-10 12:00:00", "5", "1")]))
    found = versioning.latest_version(store.versions_of_batch(store.read_versions(spark, table), batch))
    assert [r["version"] for r in found.collect()] == ["4"]


def test_clean_gives_the_same_from_a_store(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    name = f"store_{uuid.uuid4().hex}"
    enriched, stored = stages._enriched(spark, sf), stages._stored(spark, sf)
    store.append_versions(stored, name, str(tmp_path / name), buckets=2)
    plain = g.clean(enriched, stored, stages.SETTINGS, stages.AS_OF)
    laid = g.clean(enriched, store.read_versions(spark, name), stages.SETTINGS, stages.AS_OF)
    for part in ("accepted", "rejected"):
        a, b = getattr(plain, part), getattr(laid, part)
        assert a.columns == b.columns and a.count() == b.count()
        assert a.exceptAll(b).isEmpty()
    spark.sql(f"DROP TABLE {name}")
