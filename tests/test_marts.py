import pandas as pd
import pytest

from farelight.plans import marts
from farelight.schemas import KPI_SCHEMA

# Weeks by borough: trips, revenue, peak hour, peak %, minutes, revenue per mile, night %.
ROWS = [
    ("2025-10-06", "Bronx", 60, 600.0, 8, 20.0, 7, 4.0, 10.0),
    ("2025-10-06", "Queens", 300, 9000.0, 17, 12.5, 5, 6.0, 20.0),
    ("2025-10-13", "Bronx", 101, 1010.0, 8, 22.0, 6, 4.5, 11.0),
    ("2025-10-13", "Brooklyn", 101, 2020.0, 17, 15.0, 6, 5.0, 12.0),
    ("2025-10-13", "Queens", 400, 8000.0, 18, 11.0, 4, 6.5, 21.0),
    ("2025-10-13", "Staten Island", 100, 900.0, 7, 30.0, 3, 9.0, 2.0),
    ("2025-10-13", "Unknown", 50, 100.0, 7, 30.0, 1, 19.0, 2.0),
]


@pytest.fixture(scope="module")
def kpis(spark):
    return spark.createDataFrame(ROWS, KPI_SCHEMA)


@pytest.fixture(scope="module")
def frame():
    return pd.DataFrame(ROWS, columns=KPI_SCHEMA.names)


def boroughs(df):
    return [r.borough for r in df.collect()]


def test_latest_week(kpis):
    assert marts.latest_week(kpis).count() == 5
    assert {r.week_start for r in marts.latest_week(kpis).collect()} == {"2025-10-13"}


def test_summary_matches_pandas(kpis, frame):
    s = marts.summary(kpis).first()
    assert s.total_trips == frame.total_trips.sum()
    assert s.total_revenue == pytest.approx(frame.total_revenue.sum())
    assert s.avg_revenue_per_mile == pytest.approx(frame.avg_revenue_per_mile.mean())
    assert s.avg_minutes_per_mile == int(frame.avg_minutes_per_mile.mean())
    assert s.peak_hour == frame.peak_hour.mode()[0] == 7
    assert s.peak_hour_range == "07-09"
    assert s.peak_hour_pct == pytest.approx(frame.peak_hour_trip_percentage.mean())
    assert s.night_trip_pct == pytest.approx(frame.night_trip_percentage.mean())
    assert s.weeks == 2
    weighted = (frame.avg_revenue_per_mile * frame.total_trips).sum() / frame.total_trips.sum()
    assert s.avg_revenue_per_mile_weighted == pytest.approx(weighted)


def test_summary_without_a_column_is_zero(kpis):
    s = marts.summary(kpis.drop("peak_hour", "avg_revenue_per_mile")).first()
    assert (s.peak_hour, s.peak_hour_range, s.avg_revenue_per_mile) == (0, "00-02", 0.0)


def test_hour_range_wraps(spark):
    late = spark.createDataFrame([("2025-10-06", "Bronx", 1, 1.0, 23, 1.0, 1, 1.0, 1.0)], KPI_SCHEMA)
    assert marts.summary(late).first().peak_hour_range == "23-01"


def test_volume_top_breaks_ties_by_name(kpis):
    assert boroughs(marts.volume_top(kpis)) == ["Queens", "Bronx", "Brooklyn", "Staten Island", "Unknown"]
    assert boroughs(marts.volume_top(kpis, 2)) == ["Queens", "Bronx"]


def test_floors_are_strict(kpis):
    assert boroughs(marts.top_revenue_per_mile(kpis)) == ["Queens", "Brooklyn", "Bronx"]
    assert boroughs(marts.most_efficient(kpis)) == ["Queens", "Bronx", "Brooklyn"]
    assert set(boroughs(marts.efficiency_scatter(kpis))) == {"Queens", "Bronx", "Brooklyn", "Staten Island"}
    assert boroughs(marts.time_vs_revenue(kpis, 2)) == ["Queens", "Bronx"]


def test_revenue_distribution(kpis, frame):
    latest = frame[frame.week_start == "2025-10-13"]
    found = {r.borough: r for r in marts.revenue_distribution(kpis).collect()}
    for r in latest.itertuples():
        assert found[r.borough].borough_revenue == pytest.approx(
            r.total_trips / latest.total_trips.sum() * r.total_revenue
        )
        assert found[r.borough].revenue_share == pytest.approx(r.total_revenue / latest.total_revenue.sum() * 100)


def test_weekly_tables(kpis, frame):
    volume = [tuple(r) for r in marts.weekly_volume(kpis).collect()]
    expected = frame.sort_values(["week_start", "total_trips", "borough"], ascending=[True, False, True])
    assert volume == list(expected[["week_start", "borough", "total_trips"]].itertuples(index=False, name=None))
    top = {r.borough for r in marts.weekly_top(kpis, 2).collect()}
    assert top == {"Queens", "Bronx"}
    cells = marts.heatmap(kpis, 1).collect()
    assert sorted(round(r.share_of_borough, 2) for r in cells) == [42.86, 57.14]
    grid = marts.heatmap_grid(kpis, 2)
    assert grid.columns == ["week_start", "Bronx", "Queens"]
    assert sorted(tuple(r) for r in grid.collect()) == [("2025-10-06", 60, 300), ("2025-10-13", 101, 400)]
    trend = [tuple(r) for r in marts.weekly_trend(kpis).collect()]
    assert trend == [("2025-10-06", 360, 9600.0), ("2025-10-13", 752, 12030.0)]
    first = marts.listing(kpis).first()
    assert (first.week_start, first.borough) == ("2025-10-13", "Queens")


def test_null_borough_is_no_group(spark, kpis):
    odd = spark.createDataFrame([("2025-10-13", None, 999, 1.0, 1, 1.0, 1, 1.0, 1.0)], KPI_SCHEMA)
    assert None not in boroughs(marts.volume_top(kpis.unionByName(odd)))


def test_describe_matches_pandas(kpis, frame):
    found = {r.metric: r for r in marts.describe(kpis).collect()}
    numeric = frame.drop(columns="peak_hour").select_dtypes(["int64", "float64"]).describe()
    assert set(found) == set(numeric.columns)
    for name in numeric:
        r, e = found[name], numeric[name]
        got = (r.n, r.mean, r.std, r.min, r.q25, r.q50, r.q75, r.max)
        assert got == pytest.approx(tuple(e))
