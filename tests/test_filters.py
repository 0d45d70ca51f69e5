import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farelight.functions.rules import ROW_RULES
from farelight.operators.filters import (
    filter_audit,
    keep_valid,
    missing_weeks,
    parse_weeks,
    recency_cutoff,
    recent_weeks,
    time_bounds,
)
from tests.frames import span, trips

BAD = {
    "fare_not_negative": dict(fare_amount=-5.0),
    "total_not_negative": dict(total_amount=-0.01),
    "distance_positive": dict(trip_distance=0.0),
    "passengers_0_to_8": dict(passenger_count=9),
    "times_present": dict(tpep_dropoff_datetime=None),
    "dropoff_not_before_pickup": dict(tpep_dropoff_datetime="2025-10-10 09:59:59"),
    "tip_missing_or_not_negative": dict(tip_amount=-1.0),
    "payment_missing_or_1_to_6": dict(payment_type=10),
}


def test_only_the_valid_trip_is_kept(spark):
    kept = keep_valid(trips(spark, {}, *BAD.values())).collect()
    assert [(r.fare_amount, r.trip_distance) for r in kept] == [(10.0, 2.0)]


@pytest.mark.parametrize("rule", sorted(ROW_RULES))
def test_audit_names_the_rule(spark, rule):
    audit = {r.rule: (r.n_rows, r.n_rejected) for r in filter_audit(trips(spark, {}, BAD[rule])).collect()}
    assert set(audit) == set(ROW_RULES)
    assert audit[rule] == (2, 1)
    if rule != "times_present":  # a missing time also has no order
        assert sum(n for _, n in audit.values()) == 1


@pytest.mark.parametrize(
    "edge",
    [
        dict(fare_amount=0.0),
        dict(total_amount=0.0),
        dict(passenger_count=0),
        dict(passenger_count=8),
        dict(tpep_dropoff_datetime="2025-10-10 10:00:00"),
        dict(tip_amount=None),
        dict(tip_amount=0.0),
        dict(payment_type=None),
        dict(payment_type=1),
        dict(payment_type=6),
    ],
    ids=str,
)
def test_edges_kept(spark, edge):
    assert keep_valid(trips(spark, edge)).count() == 1


@pytest.mark.parametrize(
    "edge",
    [
        dict(fare_amount=None),
        dict(total_amount=None),
        dict(trip_distance=None),
        dict(passenger_count=None),
        dict(tpep_pickup_datetime=None),
        dict(passenger_count=-1),
        dict(payment_type=0),
        dict(payment_type=7),
    ],
    ids=str,
)
def test_edges_dropped(spark, edge):
    assert keep_valid(trips(spark, edge)).count() == 0


@pytest.mark.parametrize("name", ["fare_amount", "total_amount", "trip_distance", "tip_amount"])
def test_nan_passes_in_reference_mode_only(spark, name):
    odd = trips(spark, {name: math.nan})
    assert keep_valid(odd, "strict").count() == 0
    assert keep_valid(odd, "reference").count() == 1


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        keep_valid(trips(spark, {}), "lenient")


def test_text_times_are_cast(spark):
    text = trips(spark, {}, {}).withColumn("tpep_pickup_datetime", F.lit("2025-10-10 10:00:00"))
    assert keep_valid(text).count() == 2
    assert keep_valid(text.withColumn("tpep_pickup_datetime", F.lit("no time"))).count() == 0


def test_recent_weeks_is_inclusive(spark):
    df = trips(
        spark,
        span("2025-10-29 12:00:00", "2025-10-29 12:10:00"),
        span("2025-10-01 12:00:00", "2025-10-01 12:10:00"),
        span("2025-10-01 11:59:59", "2025-10-01 12:10:00"),
    )
    kept = sorted(r.tpep_pickup_datetime for r in recent_weeks(df, 4).collect())
    assert kept == [datetime(2025, 10, 1, 12), datetime(2025, 10, 29, 12)]
    assert recent_weeks(df, 0).count() == 1


def test_recent_weeks_cuts_at_milliseconds(spark):
    df = trips(
        spark,
        span("2025-10-29 12:00:00.123456", "2025-10-29 12:10:00"),
        span("2025-10-22 12:00:00.123000", "2025-10-22 12:10:00"),
        span("2025-10-22 12:00:00.122999", "2025-10-22 12:10:00"),
    )
    assert recent_weeks(df, 1).count() == 2


def test_recent_weeks_aligned_holds_whole_weeks(spark):
    df = trips(
        spark,
        span("2025-10-15 12:00:00", "2025-10-15 12:10:00"),  # Wednesday
        span("2025-10-06 00:00:00", "2025-10-06 00:10:00"),  # Monday before last
        span("2025-10-05 23:59:59", "2025-10-06 00:10:00"),
    )
    assert recent_weeks(df, 2, align_to_week=True).count() == 2
    assert recent_weeks(df, 1, align_to_week=True).count() == 1


def test_recency_is_held_at_the_epoch_and_empty_stays_empty(spark):
    old = trips(spark, span("1970-01-05 00:00:00", "1970-01-05 01:00:00"))
    assert recency_cutoff(old, 4).first().cutoff == datetime(1970, 1, 1)
    assert recent_weeks(old.limit(0)).count() == 0
    assert recency_cutoff(old.filter("false")).first().cutoff is None


def test_parse_weeks():
    assert parse_weeks("8") == 8
    assert parse_weeks("eight") == 4
    assert parse_weeks(None) == 4


def test_time_bounds(spark):
    df = trips(spark, {}, span("2025-10-01 12:00:00", "2025-10-01 12:10:00"))
    assert tuple(time_bounds(df).first()) == (datetime(2025, 10, 1, 12), datetime(2025, 10, 10, 10))


def test_missing_weeks_across_the_year_end(spark):
    df = trips(
        spark,
        span("2024-12-23 10:00:00", "2024-12-23 10:10:00"),
        span("2025-01-08 10:00:00", "2025-01-08 10:10:00"),
        dict(tpep_pickup_datetime=None),
    )
    assert [r.week_start for r in missing_weeks(df).collect()] == ["2024-12-30"]
    assert missing_weeks(df.limit(0)).count() == 0
