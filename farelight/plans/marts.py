"""Summary tables over the KPI table, which holds one row per week and borough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from farelight.functions.rules import percentage
from farelight.functions.timecols import hour_range

TOP = 10


def _best(df: DataFrame, measure: str, n: int = TOP, smallest: bool = False) -> DataFrame:
    """The best rows by a measure; rows without it come last either way."""
    order = F.col(measure).asc_nulls_last() if smallest else F.col(measure).desc_nulls_last()
    return df.orderBy(order, F.col("borough").asc()).limit(n)


def latest_week(kpis: DataFrame) -> DataFrame:
    """KPI rows of the last week at hand."""
    last = kpis.agg(F.max("week_start").alias("week_start"))
    return kpis.filter(F.col("week_start") == last.scalar())


def _latest_by_borough(kpis: DataFrame, *measures: str) -> DataFrame:
    """Trips of the latest week per borough, next to measures that have one value there."""
    return (
        latest_week(kpis)
        .filter(F.col("borough").isNotNull())
        .groupBy("borough")
        .agg(F.sum("total_trips").alias("total_trips"), *[F.max(m).alias(m) for m in measures])
    )


def summary(kpis: DataFrame) -> DataFrame:
    """The headline figures, in one row.

    Means are plain means over the KPI rows; those ending in ``_weighted`` weigh each row
    by its trips. A measure whose column is missing is 0.
    """
    have = set(kpis.columns)

    def over(name: str, measure: Column, kind: str) -> Column:
        value = F.coalesce(measure, F.lit(0)) if name in have else F.lit(0)
        return value.cast(kind)

    def weighted(name: str) -> Column:
        if not {name, "total_trips"} <= have:
            return F.lit(0.0)
        return F.coalesce(
            F.try_divide(F.sum(F.col(name) * F.col("total_trips")), F.sum("total_trips")), F.lit(0.0)
        )

    peak = over("peak_hour", F.mode("peak_hour", True), "int")
    return kpis.agg(
        over("total_trips", F.sum("total_trips"), "long").alias("total_trips"),
        over("total_revenue", F.sum("total_revenue"), "double").alias("total_revenue"),
        over("avg_revenue_per_mile", F.avg("avg_revenue_per_mile"), "double").alias("avg_revenue_per_mile"),
        over("avg_minutes_per_mile", F.avg("avg_minutes_per_mile"), "long").alias("avg_minutes_per_mile"),
        peak.alias("peak_hour"),
        hour_range(peak).alias("peak_hour_range"),
        over("peak_hour_trip_percentage", F.avg("peak_hour_trip_percentage"), "double").alias("peak_hour_pct"),
        over("night_trip_percentage", F.avg("night_trip_percentage"), "double").alias("night_trip_pct"),
        over("week_start", F.countDistinct("week_start"), "long").alias("weeks"),
        weighted("avg_revenue_per_mile").alias("avg_revenue_per_mile_weighted"),
        weighted("night_trip_percentage").alias("night_trip_pct_weighted"),
    )


def volume_top(kpis: DataFrame, n: int = TOP) -> DataFrame:
    """Boroughs with most trips in the latest week."""
    return _best(_latest_by_borough(kpis), "total_trips", n)


def revenue_distribution(kpis: DataFrame, n: int = TOP) -> DataFrame:
    """Revenue split of the latest week.

    ``borough_revenue`` is the share of trips times the borough's own revenue, as the
    distribution chart shows it; ``revenue_share`` is the share of the week's revenue in percent.
    """
    # One week has as many rows as there are boroughs, so the window stays small.
    week = Window.partitionBy("week_start")
    boroughs = _latest_by_borough(kpis, "total_revenue", "week_start")
    trip_share = F.try_divide(F.col("total_trips"), F.sum("total_trips").over(week))
    return _best(
        boroughs.select(
            "borough",
            "total_trips",
            "total_revenue",
            (trip_share * F.col("total_revenue")).alias("borough_revenue"),
            percentage(F.col("total_revenue"), F.sum("total_revenue").over(week)).alias("revenue_share"),
        ),
        "borough_revenue",
        n,
    )


def top_revenue_per_mile(kpis: DataFrame, n: int = TOP, floor: int = 100) -> DataFrame:
    """Best revenue per mile in the latest week among boroughs with more than ``floor`` trips."""
    boroughs = _latest_by_borough(kpis, "avg_revenue_per_mile").filter(F.col("total_trips") > floor)
    return _best(boroughs, "avg_revenue_per_mile", n)


def most_efficient(kpis: DataFrame, n: int = TOP, floor: int = 100) -> DataFrame:
    """Fewest minutes per mile in the latest week among boroughs with more than ``floor`` trips."""
    boroughs = _latest_by_borough(kpis, "avg_minutes_per_mile").filter(F.col("total_trips") > floor)
    return _best(boroughs, "avg_minutes_per_mile", n, smallest=True)


def efficiency_scatter(kpis: DataFrame, floor: int = 50) -> DataFrame:
    """Time and revenue per mile in the latest week per borough with more than ``floor`` trips."""
    boroughs = _latest_by_borough(kpis, "avg_minutes_per_mile", "avg_revenue_per_mile")
    return boroughs.filter(F.col("total_trips") > floor)


def time_vs_revenue(kpis: DataFrame, n: int = TOP, floor: int = 50) -> DataFrame:
    """The scatter's boroughs with most trips."""
    return _best(efficiency_scatter(kpis, floor), "total_trips", n)


def weekly_volume(kpis: DataFrame) -> DataFrame:
    """Trips per week and borough: weeks upward, trips downward."""
    return _volumes(kpis).orderBy(
        F.col("week_start").asc(), F.col("total_trips").desc(), F.col("borough").asc()
    )


def _volumes(kpis: DataFrame) -> DataFrame:
    return (
        kpis.filter(F.col("week_start").isNotNull() & F.col("borough").isNotNull())
        .groupBy("week_start", "borough")
        .agg(F.sum("total_trips").alias("total_trips"))
    )


def _busiest(kpis: DataFrame, n: int) -> DataFrame:
    totals = (
        kpis.filter(F.col("borough").isNotNull())
        .groupBy("borough")
        .agg(F.sum("total_trips").alias("all_trips"))
    )
    return _best(totals, "all_trips", n).select("borough")


def weekly_top(kpis: DataFrame, n: int = TOP) -> DataFrame:
    """Weekly volume of the ``n`` boroughs with most trips overall."""
    return (
        _volumes(kpis)
        .join(_busiest(kpis, n), "borough", "left_semi")
        .select("week_start", "borough", "total_trips")
        .orderBy(F.col("week_start").asc(), F.col("total_trips").desc(), F.col("borough").asc())
    )


def heatmap(kpis: DataFrame, n: int = 15) -> DataFrame:
    """Long-form week by borough grid of the ``n`` busiest boroughs, with the share of the
    borough's own trips that fall in the week."""
    cells = _volumes(kpis).join(_busiest(kpis, n), "borough", "left_semi")
    totals = cells.groupBy("borough").agg(F.sum("total_trips").alias("all_trips"))
    return cells.join(totals, "borough").select(
        "week_start",
        "borough",
        "total_trips",
        percentage(F.col("total_trips"), F.col("all_trips")).alias("share_of_borough"),
    )


def heatmap_grid(kpis: DataFrame, n: int = 15) -> DataFrame:
    """The grid as drawn: a row per week, a column of trips for each of the ``n`` busiest boroughs."""
    cells = _volumes(kpis).join(_busiest(kpis, n), "borough", "left_semi")
    return cells.groupBy("week_start").pivot("borough").agg(F.sum("total_trips"))


def weekly_trend(kpis: DataFrame) -> DataFrame:
    """Trips and revenue per week."""
    return (
        kpis.groupBy("week_start")
        .agg(F.sum("total_trips").alias("total_trips"), F.sum("total_revenue").alias("total_revenue"))
        .orderBy("week_start")
    )


def describe(kpis: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column.

    Long and double columns only, so the 32-bit ``peak_hour`` is left out. The quartiles
    are exact: the KPI table has few rows, weeks times boroughs. For a table of any size
    there is :func:`farelight.operators.describe.describe`.
    """
    numeric = [f.name for f in kpis.schema.fields if isinstance(f.dataType, (T.LongType, T.DoubleType))]
    long_form = kpis.select([F.col(c).cast("double") for c in numeric]).unpivot([], numeric, "metric", "value")
    quartiles = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    stats = long_form.groupBy("metric").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        quartiles.alias("q"),
        F.max("value").alias("max"),
    )
    return stats.select(
        "metric",
        "n",
        "mean",
        "std",
        "min",
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
        "max",
    )


def listing(kpis: DataFrame) -> DataFrame:
    """All KPI rows: latest week first, then most trips first."""
    return kpis.orderBy(
        F.col("week_start").desc(), F.col("total_trips").desc(), F.col("borough").asc()
    )
