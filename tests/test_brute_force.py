"""Library results against plain Python on random rows."""

import math
import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from farelight.operators.filters import filter_audit, keep_valid
from farelight.operators.text import word_counts
from farelight.plans.kpis import calculate_kpis, stage_counts
from tests.frames import trips, zones

ZONES = [(i, f"B{i % 4}", f"Z{i}", "s") for i in range(1, 21)]


def random_trip(rng):
    start = datetime(2024, 12, 1) + timedelta(seconds=rng.randrange(60 * 86_400), microseconds=rng.randrange(10**6))
    # A third of all trips start at zone 1.
    pickup_zone = 1 if rng.random() < 0.33 else rng.choice([None, *range(1, 24)])
    maybe = lambda value, share=0.05: None if rng.random() < share else value
    return dict(
        tpep_pickup_datetime=maybe(start, 0.02),
        tpep_dropoff_datetime=maybe(start + timedelta(seconds=rng.randrange(-300, 5_400)), 0.02),
        passenger_count=maybe(rng.randrange(-1, 11)),
        trip_distance=maybe(rng.choice([0.0, -1.0, math.nan, *[round(rng.uniform(0.1, 20), 2)] * 20])),
        payment_type=maybe(rng.randrange(0, 8), 0.2),
        fare_amount=maybe(rng.choice([math.nan, *[round(rng.uniform(-2, 60), 2)] * 20])),
        tip_amount=maybe(round(rng.uniform(-1, 10), 2), 0.2),
        total_amount=maybe(round(rng.uniform(-2, 80), 2)),
        PULocationID=pickup_zone,
        DOLocationID=rng.choice([None, *range(1, 24)]),
    )


def is_valid(t):
    def at_least(value, bound, strict=False):
        return value is not None and not math.isnan(value) and (value > bound if strict else value >= bound)

    pickup, dropoff = t["tpep_pickup_datetime"], t["tpep_dropoff_datetime"]
    return (
        at_least(t["fare_amount"], 0)
        and at_least(t["total_amount"], 0)
        and at_least(t["trip_distance"], 0, strict=True)
        and t["passenger_count"] is not None
        and 0 <= t["passenger_count"] <= 8
        and pickup is not None
        and dropoff is not None
        and dropoff >= pickup
        and (t["tip_amount"] is None or t["tip_amount"] >= 0)
        and (t["payment_type"] is None or 1 <= t["payment_type"] <= 6)
    )


def expected_kpis(rows, weeks):
    boroughs = {z[0]: z[1] for z in ZONES}
    enriched = [t for t in rows if is_valid(t) and t["PULocationID"] in boroughs and t["DOLocationID"] in boroughs]
    latest = max(t["tpep_pickup_datetime"] for t in enriched)
    latest -= timedelta(microseconds=latest.microsecond % 1000)
    recent = [t for t in enriched if t["tpep_pickup_datetime"] >= latest - timedelta(weeks=weeks)]
    groups = defaultdict(list)
    for t in recent:
        day = t["tpep_pickup_datetime"].date()
        monday = day - timedelta(days=day.weekday())
        groups[(monday.isoformat(), boroughs[t["PULocationID"]])].append(t)
    kpis = {}
    for key, group in groups.items():
        hours = Counter(t["tpep_pickup_datetime"].hour for t in group)
        peak, most = min(hours.items(), key=lambda item: (-item[1], item[0]))
        seconds = [
            math.floor(t["tpep_dropoff_datetime"].timestamp()) - math.floor(t["tpep_pickup_datetime"].timestamp())
            for t in group
        ]
        minutes = [s / 60 / t["trip_distance"] for s, t in zip(seconds, group)]
        revenue = [t["total_amount"] / t["trip_distance"] for t in group]
        n = len(group)
        kpis[key] = (
            n,
            sum(t["total_amount"] for t in group),
            peak,
            most / n * 100,
            math.trunc(sum(minutes) / n),
            sum(revenue) / n,
            sum(1 for t in group if t["tpep_pickup_datetime"].hour <= 5) / n * 100,
        )
    return kpis, len(enriched), len(recent)


@pytest.mark.parametrize("seed,weeks", [(1, 4), (2, 1), (3, 20)])
def test_kpis(spark, seed, weeks):
    rng = random.Random(seed)
    rows = [random_trip(rng) for _ in range(3_000)]
    df = trips(spark, *rows).repartition(8)
    lookup = zones(spark, *ZONES)
    valid = sum(map(is_valid, rows))
    assert keep_valid(df).count() == valid

    kpis, enriched, recent = expected_kpis(rows, weeks)
    found = {(r.week_start, r.borough): tuple(r)[2:] for r in calculate_kpis(keep_valid(df), lookup, weeks).collect()}
    assert set(found) == set(kpis)
    for key, row in kpis.items():
        assert found[key] == pytest.approx(row), key

    stages = {r.stage: r.n_rows for r in stage_counts(df, lookup, weeks).collect()}
    assert stages == dict(raw=3_000, clean=valid, enriched=enriched, recent=recent, kpis=len(kpis))
    assert {r.n_rows for r in filter_audit(df).collect()} == {3_000}


def split_like_a_line_reader(line):
    tokens = re.split(r"[^A-Za-z0-9_]+", line)
    if line:
        while tokens and not tokens[-1]:
            tokens.pop()
    return tokens


@pytest.mark.parametrize("seed", range(3))
def test_word_counts(spark, seed):
    rng = random.Random(seed)
    lines = ["".join(rng.choice("abAB_1é \t-.!İK") for _ in range(rng.randrange(0, 9))) for _ in range(2_000)]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    expected = Counter(t.lower() for line in lines for t in split_like_a_line_reader(line))
    assert {r["word"]: r["count"] for r in word_counts(df, mode="reference").collect()} == expected
    expected.pop("", None)
    assert {r["word"]: r["count"] for r in word_counts(df).collect()} == expected
