"""What the plans look like, and that hot keys are split."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from farelight.operators import enrich
from farelight.operators.filters import keep_valid, recent_weeks
from farelight.operators.quality import trip_profile
from farelight.plans.kpis import calculate_kpis
from farelight.sources.readers import read_trips
from tests.frames import kpi_trips, rows, trips, zones

PACKAGE = Path(__file__).resolve().parents[1] / "farelight"


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trip_file(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "trips")
    kpi_trips(spark).write.parquet(path)
    return path


def scans(text):
    return re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[(.*?)\], ReadSchema: (\S+)", text)


def test_rules_reach_the_scan_and_unused_columns_do_not(spark, trip_file):
    kept = keep_valid(read_trips(spark, trip_file)).agg(F.sum("total_amount"))
    kept_plan = kept._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = re.search(r"PushedFilters: \[(.*)\]", kept_plan).group(1)
    for part in (
        "GreaterThanOrEqual(fare_amount,0.0)",
        "GreaterThan(trip_distance,0.0)",
        "LessThanOrEqual(passenger_count,8)",
        "IsNull(tip_amount)",
        "IsNull(payment_type)",
    ):
        assert part in pushed
    schema = re.search(r"ReadSchema: (.*)", kept_plan).group(1)
    for unused in ("VendorID", "airport_fee", "extra", "PULocationID"):
        assert unused not in schema


def test_recency_bound_reaches_the_scan(spark, trip_file):
    recent = recent_weeks(read_trips(spark, trip_file)).agg(F.sum("total_amount"))
    text = recent._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert re.search(r"GreaterThanOrEqual\(tpep_pickup_datetime,ScalarSubquery", text)


def test_kpis_read_trips_twice_and_broadcast_the_lookup(spark, trip_file):
    kpis = calculate_kpis(keep_valid(read_trips(spark, trip_file)), zones(spark))
    text = plan(kpis, final=True).split("Initial Plan")[0]
    assert "SortMergeJoin" not in text
    assert "BroadcastHashJoin" in text and "BuildLeft" not in text
    whole = plan(kpis)
    assert not re.search("Python|MapElements|CartesianProduct|BroadcastNestedLoopJoin", whole)
    slot = re.search(r"hashpartitioning\(slot#\d+L, borough#\d+", whole)
    assert slot, "rows are combined per quarter-hour before they are shuffled"
    assert not re.search("SortAggregate|ObjectHashAggregate", whole)


def test_gates_read_trips_once(spark, trip_file):
    text = plan(trip_profile(read_trips(spark, trip_file)))
    assert text.count("FileScan") == 1


def test_a_large_lookup_is_not_broadcast(spark):
    assert "broadcast" in plan_hint(enrich.sized(zones(spark), 3))
    assert "broadcast" not in plan_hint(enrich.sized(zones(spark), 2))


def plan_hint(df):
    return df._jdf.queryExecution().logical().toString().lower()


@pytest.fixture
def shuffled_joins(spark, monkeypatch):
    """No broadcast, and thresholds at which the small test data count as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    }
    monkeypatch.setattr(enrich, "BROADCAST_ROWS", 1)
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_trips(spark):
    """A third of the trips start at one location."""
    n = F.col("id")
    one = trips(spark, {}).drop("PULocationID", "DOLocationID")
    ids = spark.range(0, 30_000, 1, 8).select(
        F.when(n % 3 == 0, F.lit(1)).otherwise(n % 50 + 2).cast("long").alias("PULocationID"),
        (n % 60 + 1).alias("DOLocationID"),
        F.uuid().alias("note"),
    )
    return ids.join(F.broadcast(one))


def lookup(spark):
    return zones(spark, *[(i, f"B{i % 5}", f"Z{i}", "s") for i in range(1, 61)])


def test_hot_location_is_split_and_nothing_is_lost(spark, tmp_path, shuffled_joins):
    hot_trips(spark).write.parquet(str(tmp_path / "hot"))
    stored = spark.read.parquet(str(tmp_path / "hot"))
    joined = enrich.enrich_pickup(stored, lookup(spark))
    text = plan(joined, final=True).split("Initial Plan")[0]
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "skew=true" in text or "isSkew" in text or "skewed" in text
    assert joined.count() == 30_000


def test_kpis_are_the_same_by_broadcast_and_by_shuffle(spark, tmp_path, request):
    hot_trips(spark).write.parquet(str(tmp_path / "hot"))
    stored = spark.read.parquet(str(tmp_path / "hot"))
    by_broadcast = rows(calculate_kpis(stored, lookup(spark)))
    request.getfixturevalue("shuffled_joins")
    by_shuffle = rows(calculate_kpis(stored, lookup(spark)))
    assert len(by_broadcast) == 5
    for a, b in zip(by_broadcast, by_shuffle):
        assert a == pytest.approx(b)


def test_library_keeps_data_off_the_driver():
    found = []
    for path in PACKAGE.rglob("*.py"):
        if path.parent.name == "llm":  # has a test of its own
            continue
        for n, line in enumerate(path.read_text().splitlines(), 1):
            if re.search(r"\.collect\(\)|toPandas|\.rdd\b|localCheckpoint|crossJoin|pandas_udf|\.udf\(", line):
                found.append(f"{path.name}:{n}: {line.strip()}")
    # The failing gate rows, at most eight, and the names of the files that are to be read.
    bounded = ("failed = report.filter(~F.col(\"passed\")).collect()", "self.new_files(path).collect()")
    assert [f for f in found if not any(b in f for b in bounded)] == []
    assert len(found) == 2
