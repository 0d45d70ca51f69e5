"""Weekly KPIs per pickup borough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from farelight.functions.rules import all_rules, per_mile, percentage, truncated
from farelight.functions.timecols import (
    as_time,
    is_night,
    minutes_between,
    slot_start,
    time_slot,
    week_date,
)
from farelight.operators.enrich import enrich_zones
from farelight.operators.filters import keep_valid, recency_cutoff, recent_weeks
from farelight.schemas import DROPOFF, KPI_SCHEMA, PICKUP

WEEK, BOROUGH, HOUR = "week_start", "borough", "hour"
SLOT = "slot"


def trip_ratios(trips: DataFrame) -> DataFrame:
    """Enriched trips reduced to what the KPIs need, one row per trip."""
    pickup, dropoff = as_time(PICKUP), as_time(DROPOFF)
    distance = F.col("trip_distance")
    return trips.select(
        time_slot(pickup).alias(SLOT),
        F.col("PU_Borough").alias(BOROUGH),
        F.col("total_amount").alias("amount"),
        per_mile(minutes_between(pickup, dropoff), distance).alias("minutes_per_mile"),
        per_mile(F.col("total_amount"), distance).alias("revenue_per_mile"),
    )


def _per_slot(trips: DataFrame, *sums: Column) -> DataFrame:
    """Trip counts and sums per quarter-hour and borough, with the week (a date) and hour.

    All of it adds up, so tasks combine rows before the shuffle, and what is rolled up to
    weeks is 672 rows per week and borough at most, however many trips a borough has.
    """
    per_slot = trip_ratios(trips).groupBy(SLOT, BOROUGH).agg(F.count("*").alias("n_trips"), *sums)
    return with_week_and_hour(per_slot)


def _night_trips() -> Column:
    return F.sum(F.when(is_night(F.col(HOUR)), F.col("n_trips")).otherwise(0))


def _trips_per_hour() -> Column:
    sums = [f"sum(if({HOUR} = {hour}, n_trips, 0))" for hour in range(24)]
    return F.expr(f"array({', '.join(sums)})")


# Over the array of trips per hour. The first position of the largest count is the smallest
# such hour on a tie.
_PEAK_TRIPS = "array_max(hours)"
_PEAK_HOUR = "CAST(array_position(hours, array_max(hours)) - 1 AS int)"


def _week_text(df: DataFrame) -> DataFrame:
    return df.withColumn(WEEK, F.date_format(WEEK, "yyyy-MM-dd"))


def trips_by_hour(trips: DataFrame) -> DataFrame:
    """Trips per week, borough and hour of the day."""
    per_hour = _per_slot(trips).groupBy(WEEK, BOROUGH, HOUR).agg(F.sum("n_trips").alias("n_trips"))
    return _week_text(per_hour)


def trips_by_week(trips: DataFrame) -> DataFrame:
    """Trips and revenue per week and borough."""
    return _week_text(
        _per_slot(trips, F.sum("amount").alias("amount"))
        .groupBy(WEEK, BOROUGH)
        .agg(F.sum("n_trips").alias("total_trips"), F.sum("amount").alias("total_revenue"))
    )


def peak_hours(trips: DataFrame) -> DataFrame:
    """Busiest hour per week and borough, and its share of the trips."""
    per_group = _per_slot(trips).groupBy(WEEK, BOROUGH).agg(
        F.sum("n_trips").alias("total_trips"), _trips_per_hour().alias("hours")
    )
    peaks = per_group.select(
        WEEK,
        BOROUGH,
        "total_trips",
        F.expr(_PEAK_HOUR).alias("peak_hour"),
        F.expr(_PEAK_TRIPS).alias("peak_trips"),
    )
    share = percentage(F.col("peak_trips"), F.col("total_trips"))
    return _week_text(peaks.withColumn("peak_hour_trip_percentage", share))


def night_share(trips: DataFrame) -> DataFrame:
    """Night trips per week and borough, and their share."""
    per_group = _per_slot(trips).groupBy(WEEK, BOROUGH).agg(
        F.sum("n_trips").alias("total_trips"), _night_trips().alias("night_trips")
    )
    share = percentage(F.col("night_trips"), F.col("total_trips"))
    return _week_text(per_group.withColumn("night_trip_percentage", share))


def slot_sums(trips: DataFrame) -> DataFrame:
    """What the KPIs are made of, per quarter-hour and borough; it adds up over any parts of the trips."""
    return (
        trip_ratios(trips)
        .groupBy(SLOT, BOROUGH)
        .agg(
            F.count("*").alias("n_trips"),
            F.sum("amount").alias("amount"),
            F.sum("minutes_per_mile").alias("minutes_sum"),
            F.count("minutes_per_mile").alias("minutes_n"),
            F.sum("revenue_per_mile").alias("revenue_sum"),
            F.count("revenue_per_mile").alias("revenue_n"),
        )
    )


def with_week_and_hour(per_slot: DataFrame) -> DataFrame:
    start = slot_start(F.col(SLOT))
    return per_slot.withColumns({WEEK: week_date(start), HOUR: F.hour(start)})


def weekly_metrics(trips: DataFrame, exact: bool = False) -> DataFrame:
    """KPI table from enriched trips.

    ``avg_minutes_per_mile`` is cut to whole minutes; ``exact`` adds the uncut mean as
    ``avg_minutes_per_mile_exact``.
    """
    return metrics_of_slots(slot_sums(trips), exact)


def metrics_of_slots(sums: DataFrame, exact: bool = False) -> DataFrame:
    """KPI table from :func:`slot_sums`; a slot may come in several rows, which add up."""
    weekly = with_week_and_hour(sums).groupBy(WEEK, BOROUGH).agg(
        F.sum("n_trips").alias("total_trips"),
        F.sum("amount").alias("total_revenue"),
        _trips_per_hour().alias("hours"),
        F.try_divide(F.sum("minutes_sum"), F.sum("minutes_n")).alias("minutes_mean"),
        F.try_divide(F.sum("revenue_sum"), F.sum("revenue_n")).alias("revenue_mean"),
        _night_trips().alias("night_trips"),
    )
    total = F.col("total_trips")
    columns = {
        WEEK: F.date_format(WEEK, "yyyy-MM-dd"),
        BOROUGH: F.col(BOROUGH),
        "total_trips": total,
        "total_revenue": F.coalesce("total_revenue", F.lit(0.0)),
        "peak_hour": F.expr(_PEAK_HOUR),
        "peak_hour_trip_percentage": percentage(F.expr(_PEAK_TRIPS), total),
        "avg_minutes_per_mile": F.coalesce(truncated(F.col("minutes_mean")), F.lit(0)),
        "avg_revenue_per_mile": F.coalesce("revenue_mean", F.lit(0.0)),
        "night_trip_percentage": percentage(F.col("night_trips"), total),
    }
    kpis = [columns[f.name].cast(f.dataType).alias(f.name) for f in KPI_SCHEMA.fields]
    if exact:
        kpis.append(F.col("minutes_mean").alias("avg_minutes_per_mile_exact"))
    return weekly.select(*kpis)


def calculate_kpis(
    trips: DataFrame,
    zones: DataFrame,
    weeks: int = 4,
    align_to_week: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Clean trips and zones to the KPI table of the most recent ``weeks``."""
    enriched = enrich_zones(trips, zones)
    return weekly_metrics(recent_weeks(enriched, weeks, align_to_week), exact)


def stage_counts(trips: DataFrame, zones: DataFrame, weeks: int = 4, mode: str = "strict") -> DataFrame:
    """Rows after each stage: raw, clean, enriched, recent, kpis.

    Raw and clean share one scan; so do the three later stages, through sums per week and
    borough.
    """
    early = trips.agg(
        F.count("*").alias("raw"), F.count_if(all_rules(mode)).alias("clean")
    ).unpivot([], ["raw", "clean"], "stage", "n_rows")
    enriched = enrich_zones(keep_valid(trips, mode), zones)
    pickup = as_time(PICKUP)
    cutoff = recency_cutoff(enriched, weeks).scalar()
    per_slot = enriched.groupBy(time_slot(pickup).alias(SLOT), "PU_Borough").agg(
        F.count("*").alias("enriched"), F.count_if(pickup >= cutoff).alias("recent")
    )
    per_group = per_slot.groupBy(week_date(slot_start(F.col(SLOT))), "PU_Borough").agg(
        F.sum("enriched").alias("enriched"), F.sum("recent").alias("recent")
    )
    late = per_group.agg(
        F.coalesce(F.sum("enriched"), F.lit(0)).alias("enriched"),
        F.coalesce(F.sum("recent"), F.lit(0)).alias("recent"),
        F.count_if(F.col("recent") > 0).alias("kpis"),
    ).unpivot([], ["enriched", "recent", "kpis"], "stage", "n_rows")
    return early.unionByName(late)
