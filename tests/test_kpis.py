import pytest

from farelight.operators.enrich import enrich_pickup, enrich_zones, unmatched_locations
from farelight.plans import kpis
from farelight.schemas import KPI_SCHEMA
from tests.frames import kpi_trips, rows, span, trips, zones


def test_golden_week(spark):
    result = kpis.calculate_kpis(kpi_trips(spark), zones(spark))
    assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in KPI_SCHEMA]
    found = {r.borough: r for r in result.collect()}
    assert set(found) == {"Manhattan", "Queens"}
    m, q = found["Manhattan"], found["Queens"]
    assert tuple(m) == ("2025-10-06", "Manhattan", 2, 16.5, 10, 100.0, 10, 5.5, 0.0)
    assert tuple(q)[:7] == ("2025-10-06", "Queens", 1, 22.0, 2, 100.0, 10)
    assert q.avg_revenue_per_mile == pytest.approx(22 / 3)
    assert q.night_trip_percentage == 100.0


def test_sunday_and_monday_are_different_weeks(spark):
    df = trips(
        spark,
        span("2025-10-12 23:59:59", "2025-10-13 00:10:00"),
        span("2025-10-13 00:00:00", "2025-10-13 00:10:00"),
    )
    weeks = kpis.calculate_kpis(df, zones(spark)).select("week_start").collect()
    assert sorted(r.week_start for r in weeks) == ["2025-10-06", "2025-10-13"]


def test_peak_hour_tie_takes_the_smaller_hour(spark):
    hours = [13, 9, 9, 13, 20]
    df = trips(spark, *[span(f"2025-10-06 {h:02d}:00:00", f"2025-10-06 {h:02d}:30:00") for h in hours])
    found = kpis.calculate_kpis(df, zones(spark)).first()
    assert (found.peak_hour, found.peak_hour_trip_percentage) == (9, 40.0)
    peak = kpis.peak_hours(enrich_zones(df, zones(spark))).first()
    assert (peak.peak_hour, peak.peak_trips, peak.total_trips) == (9, 2, 5)


def test_night_is_midnight_to_before_six(spark):
    df = trips(
        spark,
        span("2025-10-06 00:00:00", "2025-10-06 00:30:00"),
        span("2025-10-06 05:59:59", "2025-10-06 06:30:00"),
        span("2025-10-06 06:00:00", "2025-10-06 06:30:00"),
        span("2025-10-06 23:59:59", "2025-10-07 00:30:00"),
    )
    assert kpis.calculate_kpis(df, zones(spark)).first().night_trip_percentage == 50.0


def test_minutes_are_cut_and_exact_is_optional(spark):
    df = trips(spark, span("2025-10-06 10:00:00", "2025-10-06 10:20:00", trip_distance=3.0))
    found = kpis.calculate_kpis(df, zones(spark), exact=True).first()
    assert found.avg_minutes_per_mile == 6
    assert found.avg_minutes_per_mile_exact == pytest.approx(20 / 3)


def test_tiny_distance_does_not_overflow(spark):
    df = trips(spark, span("2025-10-06 10:00:00", "2025-10-06 10:20:00", trip_distance=5e-324, total_amount=0.0))
    assert kpis.calculate_kpis(df, zones(spark)).first().avg_minutes_per_mile > 9 * 10**18


def test_both_ends_need_a_zone(spark):
    df = trips(
        spark,
        {},
        dict(PULocationID=99),
        dict(DOLocationID=99),
        dict(PULocationID=None),
        dict(DOLocationID=None),
    )
    joined = enrich_zones(df, zones(spark))
    assert joined.count() == 1
    first = joined.first()
    assert (first.PU_Borough, first.PU_Zone, first.PU_service_zone) == ("Manhattan", "Zone 1", "Yellow Zone")
    assert (first.DO_Borough, first.DO_Zone, first.DO_service_zone) == ("Queens", "Zone 2", "Boro Zone")
    assert "PU_LocationID" not in joined.columns
    assert enrich_pickup(df, zones(spark)).count() == 3
    assert rows(unmatched_locations(df, zones(spark))) == [
        ("dropoff", 99, 1), ("dropoff", None, 1), ("pickup", 99, 1), ("pickup", None, 1),
    ]


def test_repeated_lookup_ids_fan_out(spark):
    twice = zones(spark, (1, "A", "a", "s"), (1, "B", "b", "s"), (2, "C", "c", "s"))
    assert enrich_zones(trips(spark, {}), twice).count() == 2


def test_hours_and_weeks_follow_a_zone_with_a_half_hour_offset(spark):
    df = trips(
        spark,
        span("2025-10-12 18:29:59", "2025-10-12 18:40:00"),  # Sunday 23:59:59 there
        span("2025-10-12 18:30:00", "2025-10-12 18:40:00"),  # Monday 00:00
    )
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        found = rows(kpis.trips_by_hour(enrich_zones(df, zones(spark))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [("2025-10-06", "Manhattan", 23, 1), ("2025-10-13", "Manhattan", 0, 1)]


def test_trips_before_the_epoch(spark):
    df = trips(spark, span("1969-12-31 23:59:59", "1970-01-01 00:10:00"))
    assert rows(kpis.trips_by_hour(enrich_zones(df, zones(spark)))) == [("1969-12-29", "Manhattan", 23, 1)]


def test_empty_in_empty_out(spark):
    assert kpis.calculate_kpis(kpi_trips(spark).limit(0), zones(spark)).count() == 0
    nowhere = zones(spark, (500, "X", "x", "s"))
    assert kpis.calculate_kpis(kpi_trips(spark), nowhere).count() == 0


def test_latest_pickup_is_taken_after_the_joins(spark):
    df = trips(
        spark,
        span("2025-10-06 10:00:00", "2025-10-06 10:20:00"),
        span("2026-10-06 10:00:00", "2026-10-06 10:20:00", DOLocationID=99),
    )
    assert kpis.calculate_kpis(df, zones(spark)).count() == 1


def test_stage_counts(spark):
    df = kpi_trips(spark).unionByName(
        trips(
            spark,
            dict(fare_amount=-1.0),
            span("2025-10-08 10:00:00", "2025-10-08 10:20:00", PULocationID=99),
            span("2025-01-01 10:00:00", "2025-01-01 10:20:00"),
        )
    )
    counts = {r.stage: r.n_rows for r in kpis.stage_counts(df, zones(spark)).collect()}
    assert counts == {"raw": 6, "clean": 5, "enriched": 4, "recent": 3, "kpis": 2}
