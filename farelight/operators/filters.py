"""Row filters on trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from farelight.functions.rules import all_rules, row_rules
from farelight.functions.timecols import as_time, week_date
from farelight.schemas import PICKUP


def keep_valid(trips: DataFrame, mode: str = "strict") -> DataFrame:
    """Trips that pass every row rule."""
    return trips.filter(all_rules(mode))


def filter_audit(trips: DataFrame, mode: str = "strict") -> DataFrame:
    """Rows seen and rejected per rule, each rule on its own, in one pass."""
    rules = row_rules(mode)
    totals = trips.agg(
        F.count("*").alias("n_rows"),
        *[F.expr(f"count_if(NOT coalesce({rule}, false))").alias(name) for name, rule in rules.items()],
    )
    return totals.unpivot(["n_rows"], list(rules), "rule", "n_rejected")


def recency_cutoff(
    trips: DataFrame, weeks: int = 4, align_to_week: bool = False, time_column: str = PICKUP
) -> DataFrame:
    """One row, ``cutoff``: the earliest time kept by :func:`recent_weeks`."""
    latest = F.max(as_time(time_column))
    if align_to_week:
        cutoff = F.date_trunc("week", latest) - F.make_dt_interval(F.lit(7 * (weeks - 1)))
    else:
        cutoff = F.date_trunc("millisecond", latest) - F.make_dt_interval(F.lit(7 * weeks))
    # greatest() skips nulls, so an empty input has to be kept null explicitly.
    epoch = F.timestamp_seconds(F.lit(0))
    return trips.agg(F.when(latest.isNotNull(), F.greatest(epoch, cutoff)).alias("cutoff"))


def recent_weeks(
    trips: DataFrame, weeks: int = 4, align_to_week: bool = False, time_column: str = PICKUP
) -> DataFrame:
    """Trips of the trailing ``weeks * 7`` days, counted back from the latest pickup.

    The window may start in the middle of a week and so touch ``weeks + 1`` calendar
    weeks. With ``align_to_week`` it holds exactly ``weeks`` calendar weeks. The cutoff
    is a scalar subquery: it stays inside the plan and reaches the parquet scan.
    """
    cutoff = recency_cutoff(trips, weeks, align_to_week, time_column)
    return trips.filter(as_time(time_column) >= cutoff.scalar())


def parse_weeks(text: str | None, default: int = 4) -> int:
    """Number of weeks from a job argument; anything that is no number gives the default."""
    try:
        return int(text)
    except (TypeError, ValueError):
        return default


def time_bounds(trips: DataFrame, time_column: str = PICKUP) -> DataFrame:
    """Earliest and latest time in one pass."""
    ts = as_time(time_column)
    return trips.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def missing_weeks(rows: DataFrame, time_column: str = PICKUP) -> DataFrame:
    """Calendar weeks without a row, between the first and the last week with one.

    One scan. What is left of it to put in order are the distinct weeks, at most 53 per
    calendar year.
    """
    days = rows.select(as_time(time_column).cast("date").alias("day")).dropna().distinct()
    present = days.select(week_date(F.col("day")).alias("week")).distinct()
    following = F.lead("week").over(Window.orderBy("week"))
    gaps = present.withColumn("next", following).filter(F.datediff("next", "week") > 7)
    inside = F.sequence(F.date_add("week", 7), F.date_sub("next", 7), F.expr("interval 7 days"))
    missing = gaps.select(F.explode(inside).alias("week"))
    return missing.select(F.date_format("week", "yyyy-MM-dd").alias("week_start"))
