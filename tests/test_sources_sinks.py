import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from farelight.job import KpiJob, arguments, count_words
from farelight.plans.kpis import calculate_kpis
from farelight.schemas import KPI_SCHEMA, TRIP_SCHEMA, ZONE_SCHEMA, MissingColumnsError, conform
from farelight.sources import readers, writers
from farelight.streaming import status
from tests.frames import kpi_trips, rows, span, trips, zones


def save(df, path):
    df.write.parquet(str(path))
    return str(path)


def test_trip_scan_binds_and_widens(spark, tmp_path):
    raw = (
        trips(spark, {}, span("2025-10-11 08:00:00", "2025-10-11 08:10:00"))
        .withColumn("passenger_count", F.col("passenger_count").cast("int"))
        .withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp_ntz"))
        .withColumn("note", F.lit("x"))
        .withColumn("trip_id", F.lit("t"))
    )
    found = readers.read_trips(spark, save(raw, tmp_path / "t"))
    assert found.columns == [*TRIP_SCHEMA.names, "trip_id"]
    assert [f.dataType for f in found.schema.fields][:19] == [f.dataType for f in TRIP_SCHEMA.fields]
    assert sorted(r.tpep_pickup_datetime for r in found.collect()) == [
        datetime(2025, 10, 10, 10), datetime(2025, 10, 11, 8),
    ]


def test_trip_scan_rejects_missing_and_narrowed_columns(spark, tmp_path):
    with pytest.raises(MissingColumnsError, match="airport_fee"):
        readers.read_trips(spark, save(trips(spark, {}).drop("airport_fee"), tmp_path / "a"))
    narrowed = trips(spark, {}).withColumn("passenger_count", F.lit(1.5))
    with pytest.raises(TypeError, match="passenger_count: double to bigint"):
        readers.read_trips(spark, save(narrowed, tmp_path / "b"))


def test_zone_scan_keeps_plain_words(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n264,"Unknown","N/A","N/A"\n'
    )
    found = readers.read_zones(spark, str(path))
    assert found.schema == ZONE_SCHEMA
    assert rows(found) == [(1, "EWR", "Newark Airport", "EWR"), (264, "Unknown", "N/A", "N/A")]


def test_zone_scan_goes_by_name(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("Zone,more,LocationID,service_zone,Borough\nNewark,x,1,s,EWR\n")
    assert rows(readers.read_zones(spark, str(path))) == [(1, "EWR", "Newark", "s")]
    path.write_text("Zone,LocationID,Borough\nNewark,1,EWR\n")
    with pytest.raises(MissingColumnsError, match="service_zone"):
        readers.read_zones(spark, str(path))


def test_kpi_roundtrip(spark, tmp_path):
    kpis = calculate_kpis(kpi_trips(spark), zones(spark))
    for out in (f"{tmp_path}/out", f"{tmp_path}/out/"):
        path = writers.write_kpis(kpis, out)
        assert path == f"{tmp_path}/out/kpis"
        assert rows(readers.read_kpis(spark, path)) == rows(kpis)
    assert readers.read_kpis(spark, f"{tmp_path}/nothing") is None


def test_partitioned_kpis_replace_only_their_weeks(spark, tmp_path):
    one = [("2025-10-06", "Bronx", 1, 1.0, 1, 1.0, 1, 1.0, 1.0), ("2025-10-13", "Bronx", 2, 1.0, 1, 1.0, 1, 1.0, 1.0)]
    two = [("2025-10-13", "Bronx", 3, 1.0, 1, 1.0, 1, 1.0, 1.0)]
    for table in (one, two):
        path = writers.write_kpis(spark.createDataFrame(table, KPI_SCHEMA), str(tmp_path), by_week=True)
    found = readers.read_kpis(spark, path)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in KPI_SCHEMA]
    assert {(r.week_start, r.total_trips) for r in found.collect()} == {("2025-10-06", 1), ("2025-10-13", 3)}


def test_csv_export_has_a_header(spark, tmp_path):
    kpis = calculate_kpis(kpi_trips(spark), zones(spark)).coalesce(1)
    writers.write_csv(kpis, f"{tmp_path}/csv")
    text = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()
    assert text[0] == ",".join(KPI_SCHEMA.names)
    assert len(text) == 3


def test_word_count_lines(spark, tmp_path):
    (tmp_path / "in.txt").write_text("The cat\nthe dog!\n\n")
    count_words(spark, f"{tmp_path}/in.txt", f"{tmp_path}/out", "reference")
    lines = sorted(r.value for r in readers.read_lines(spark, f"{tmp_path}/out").collect())
    assert lines == ["(,1)", "(cat,1)", "(dog,1)", "(the,2)"]


def test_status_events_are_sent_once(spark, tmp_path):
    kpis = calculate_kpis(kpi_trips(spark), zones(spark))
    table = writers.write_kpis(kpis, str(tmp_path))

    def send():
        query = status.stream_status_events(spark, table, f"{tmp_path}/offsets", "parquet", path=f"{tmp_path}/events")
        query.awaitTermination()
        return spark.read.schema("key string, value string").parquet(f"{tmp_path}/events")

    for _ in range(2):
        events = send()
        assert {r.key for r in events.collect()} == {"2025-10-06|Manhattan", "2025-10-06|Queens"}
        assert events.count() == 2
    assert rows(status.read_status_events(events).drop("key")) == rows(kpis)
    later = [("2025-10-13", "Bronx", 3, 1.0, 1, 1.0, 1, 1.0, 1.0)]
    spark.createDataFrame(later, KPI_SCHEMA).write.mode("append").parquet(table)
    assert send().count() == 3


def test_status_events_in_batch(spark, tmp_path):
    kpis = calculate_kpis(kpi_trips(spark), zones(spark))
    status.send_status_events(kpis, "parquet", path=f"{tmp_path}/batch")
    assert spark.read.parquet(f"{tmp_path}/batch").count() == 2


def test_job_writes_kpis_and_weekly_metrics(spark, tmp_path):
    trips_path = save(kpi_trips(spark), tmp_path / "trips")
    zones(spark).write.option("header", True).csv(f"{tmp_path}/zones")
    saved = KpiJob(trips_path, f"{tmp_path}/zones", f"{tmp_path}/out", weekly_metrics=True).run(spark)
    assert {r.borough: r.total_trips for r in saved.collect()} == {"Manhattan": 2, "Queens": 1}
    assert spark.read.parquet(f"{tmp_path}/out/weekly_metrics").count() == 2
    with pytest.raises(ValueError, match="align_to_week"):
        KpiJob(trips_path, "z", "o", by_week=True)
    aligned = KpiJob(trips_path, f"{tmp_path}/zones", f"{tmp_path}/part", align_to_week=True, by_week=True)
    assert aligned.run(spark).count() == 2


def test_job_arguments():
    given = arguments(["--trips", "t", "--zones", "z", "--out", "o"])
    assert (given.weeks, given.mode, given.by_week) == ("4", "strict", False)
    with pytest.raises(SystemExit):
        arguments(["--trips", "t"])


def test_conform_keeps_only_what_is_asked(spark):
    df = spark.createDataFrame([(1, "b", "z", "s", 9)], "LocationID int, Borough string, Zone string, service_zone string, x int")
    assert conform(df, ZONE_SCHEMA).columns == ZONE_SCHEMA.names
    assert conform(df, ZONE_SCHEMA, keep=("x", "y")).columns == [*ZONE_SCHEMA.names, "x"]


def test_command_line(spark, tmp_path):
    script = Path(__file__).resolve().parents[1] / "kpi_job.py"
    trips_path = save(kpi_trips(spark), tmp_path / "trips")
    zones(spark).write.option("header", True).csv(f"{tmp_path}/zones")
    base = [sys.executable, str(script), "--zones", f"{tmp_path}/zones", "--out", f"{tmp_path}/out"]
    good = subprocess.run([*base, "--trips", trips_path, "--weeks", "many"], capture_output=True, text=True, timeout=180)
    assert good.returncode == 0
    assert "Manhattan" in good.stdout
    assert readers.read_kpis(spark, f"{tmp_path}/out/kpis").count() == 2
    bad = subprocess.run([*base, "--trips", f"{tmp_path}/nothing"], capture_output=True, text=True, timeout=180)
    assert bad.returncode == 1
