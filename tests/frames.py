"""Small literal trip and zone frames."""

from __future__ import annotations

from datetime import datetime

from farelight.schemas import TRIP_SCHEMA, ZONE_SCHEMA

# A trip that passes every rule; tests override what they look at.
GOOD = dict(
    VendorID=1,
    tpep_pickup_datetime="2025-10-10 10:00:00",
    tpep_dropoff_datetime="2025-10-10 10:20:00",
    passenger_count=2,
    trip_distance=2.0,
    RatecodeID=1,
    store_and_fwd_flag="N",
    PULocationID=1,
    DOLocationID=2,
    payment_type=1,
    fare_amount=10.0,
    extra=0.5,
    mta_tax=0.5,
    tip_amount=1.0,
    tolls_amount=0.0,
    improvement_surcharge=0.0,
    total_amount=12.0,
    congestion_surcharge=0.0,
    airport_fee=0.0,
)


def _row(overrides):
    row = {**GOOD, **overrides}
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        if isinstance(row[name], str):
            row[name] = datetime.fromisoformat(row[name])
    return tuple(row[name] for name in TRIP_SCHEMA.names)


def trips(spark, *overrides):
    return spark.createDataFrame([_row(o) for o in overrides], TRIP_SCHEMA)


def span(start, end, **more):
    return dict(tpep_pickup_datetime=start, tpep_dropoff_datetime=end, **more)


def zones(spark, *rows):
    rows = rows or (
        (1, "Manhattan", "Zone 1", "Yellow Zone"),
        (2, "Queens", "Zone 2", "Boro Zone"),
        (3, "Brooklyn", "Zone 3", "Boro Zone"),
    )
    return spark.createDataFrame(list(rows), ZONE_SCHEMA)


def kpi_trips(spark):
    """Three trips in one week: two from zone 1 at ten, one from zone 2 at night."""
    return trips(
        spark,
        span("2025-10-06 10:00:00", "2025-10-06 10:20:00", trip_distance=2.0, total_amount=11.0),
        span("2025-10-07 10:00:00", "2025-10-07 10:10:00", trip_distance=1.0, total_amount=5.5),
        span(
            "2025-10-08 02:00:00", "2025-10-08 02:30:00",
            trip_distance=3.0, total_amount=22.0, PULocationID=2, DOLocationID=3,
        ),
    )


def rows(df, *order):
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r)) if not order else found
