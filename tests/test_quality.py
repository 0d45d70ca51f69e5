import pytest
from pyspark.sql import functions as F

from farelight.operators import quality
from farelight.schemas import TRIP_SCHEMA, MissingColumnsError
from tests.frames import span, trips


def test_missing_columns(spark):
    bare = spark.createDataFrame([(1, "N")], "VendorID long, store_and_fwd_flag string")
    with pytest.raises(ValueError, match="Missing required columns: tpep_pickup_datetime, .*total_amount"):
        quality.clean(bare)
    renamed = trips(spark, {}).withColumnRenamed("fare_amount", "Fare_Amount")
    assert quality.missing_columns(renamed) == ["fare_amount"]
    report = {r.column_name: (r.present, r.non_null_rows) for r in quality.required_columns_report(renamed).collect()}
    assert report["fare_amount"] == (False, 0)
    assert report["total_amount"] == (True, 1)


def test_null_rate_above_limit(spark):
    df = trips(spark, {}, {}, *[dict(fare_amount=None)] * 3)
    with pytest.raises(quality.QualityGateError, match=r"High null rates detected: fare_amount:60\.0%"):
        quality.clean(df)


def test_null_rate_at_limit_passes(spark):
    df = trips(spark, {}, {}, {}, {}, dict(fare_amount=None))
    assert quality.clean(df).count() == 4
    rates = {r.column_name: (r.null_rate, r.passed) for r in quality.null_rate_report(df).collect()}
    assert rates["fare_amount"] == (0.2, True)


def test_empty_table_fails_the_null_gate(spark):
    empty = spark.createDataFrame([], TRIP_SCHEMA)
    assert {r.null_rate for r in quality.null_rate_report(empty).collect()} == {1.0}
    with pytest.raises(quality.QualityGateError, match="total_amount:100.0%"):
        quality.clean(empty)


def test_duplicate_ids(spark):
    df = trips(spark, {}, {}, {}).withColumn("trip_id", F.monotonically_increasing_id())
    assert quality.clean(df).count() == 3
    with pytest.raises(quality.QualityGateError, match="Duplicate trip_id"):
        quality.clean(df.withColumn("trip_id", F.lit(7)))
    with pytest.raises(quality.QualityGateError, match="Duplicate trip_id"):
        quality.clean(df.withColumn("trip_id", F.lit(None).cast("long")))


def test_null_rates_are_reported_before_duplicates(spark):
    df = trips(spark, dict(fare_amount=None), {}).withColumn("trip_id", F.lit(7))
    with pytest.raises(quality.QualityGateError, match="High null rates"):
        quality.enforce(df)


def hole(spark):
    return trips(
        spark,
        span("2025-10-01 10:00:00", "2025-10-01 10:10:00"),
        span("2025-10-20 10:00:00", "2025-10-20 10:10:00"),
    )


def test_week_continuity(spark):
    strict = quality.week_continuity_report(hole(spark)).first()
    assert (strict.expected_weeks, strict.actual_weeks, strict.passed) == (4, 2, False)
    old = quality.week_continuity_report(hole(spark), "reference").first()
    assert (old.expected_weeks, old.actual_weeks, old.passed) == (3, 2, False)
    with pytest.raises(quality.QualityGateError, match="found 2 weeks, expected 4"):
        quality.enforce(hole(spark))
    with pytest.raises(quality.QualityGateError, match="found 2 weeks, expected 3"):
        quality.enforce(hole(spark), "reference")


def test_missing_time_counts_as_a_week_in_reference_mode_only(spark):
    df = hole(spark).unionByName(trips(spark, dict(tpep_pickup_datetime=None)))
    assert quality.week_continuity_report(df, "reference").first().passed
    assert not quality.week_continuity_report(df).first().passed


def test_calendar_weeks_find_the_hole_that_day_spans_hide(spark):
    # Sunday to the Monday eight days on touches three weeks; the middle one is empty.
    df = trips(
        spark,
        span("2025-10-05 10:00:00", "2025-10-05 10:10:00"),
        span("2025-10-13 10:00:00", "2025-10-13 10:10:00"),
    )
    assert quality.week_continuity_report(df, "reference").first().passed
    assert not quality.week_continuity_report(df).first().passed


def test_year_end_is_continuous(spark):
    df = trips(
        spark,
        span("2024-12-23 10:00:00", "2024-12-23 10:10:00"),
        span("2024-12-31 10:00:00", "2024-12-31 10:10:00"),
        span("2025-01-07 10:00:00", "2025-01-07 10:10:00"),
    )
    assert quality.week_continuity_report(df).first().passed


def test_no_times_at_all(spark):
    df = trips(spark, dict(tpep_pickup_datetime=None))
    with pytest.raises(quality.QualityGateError, match="No valid pickup timestamps"):
        quality.enforce(df, limit=1.0)


def test_clean_binds_to_the_trip_layout(spark):
    extra = trips(spark, {}).withColumn("note", F.lit("x")).withColumn("trip_id", F.lit(1))
    assert quality.clean(extra).columns == [*TRIP_SCHEMA.names, "trip_id"]
    with pytest.raises(MissingColumnsError, match="airport_fee"):
        quality.clean(extra.drop("airport_fee"))


def test_profile_counts_valid_rows(spark):
    df = trips(spark, {}, dict(fare_amount=-1.0), span("2025-10-13 10:00:00", "2025-10-13 10:10:00"))
    profile = {str(r.period): (r.n_rows, r.n_valid) for r in quality.trip_profile(df).collect()}
    assert profile == {"2025-10-06": (2, 1), "2025-10-13": (1, 1)}
