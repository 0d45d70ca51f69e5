"""Zone enrichment.

A lookup is broadcast only after its rows and bytes have been measured. A larger one
is joined by shuffle, where adaptive execution splits a location that holds a large part
of the trips (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farelight.schemas import ZONE_SCHEMA

PICKUP_ZONE, DROPOFF_ZONE = "PULocationID", "DOLocationID"

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 10 << 20


def sized(lookup: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Mark a lookup for broadcast if it is at most so large; else leave it be.

    Bytes are those of the rows as text. The bounds are ``BROADCAST_ROWS`` and
    ``BROADCAST_BYTES`` unless given.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    rows, size = lookup.limit(max_rows + 1).agg(F.count("*"), size).first()
    return F.broadcast(lookup) if rows <= max_rows and size <= max_bytes else lookup


def _join_zone(trips: DataFrame, zones: DataFrame, location: str, prefix: str) -> DataFrame:
    lookup = zones.select(*[F.col(c).alias(f"{prefix}{c}") for c in ZONE_SCHEMA.names])
    key = f"{prefix}LocationID"
    return trips.join(lookup, F.col(location) == F.col(key), "inner").drop(key)


def enrich_pickup(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Add ``PU_`` zone columns; trips without a known pickup zone are dropped."""
    return _join_zone(trips, sized(zones), PICKUP_ZONE, "PU_")


def enrich_dropoff(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Add ``DO_`` zone columns; trips without a known dropoff zone are dropped."""
    return _join_zone(trips, sized(zones), DROPOFF_ZONE, "DO_")


def enrich_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Both enrichments: a trip needs a known zone at either end."""
    lookup = sized(zones)
    with_pickup = _join_zone(trips, lookup, PICKUP_ZONE, "PU_")
    return _join_zone(with_pickup, lookup, DROPOFF_ZONE, "DO_")


def unmatched_locations(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Location ids, per end of the trip, that the lookup does not hold.

    Trips are counted per id before the anti-join, so only distinct ids are shuffled.
    """
    ends = trips.select(
        F.col(PICKUP_ZONE).alias("pickup"), F.col(DROPOFF_ZONE).alias("dropoff")
    ).unpivot([], ["pickup", "dropoff"], "trip_end", "location_id")
    counted = ends.groupBy("trip_end", "location_id").agg(F.count("*").alias("n_trips"))
    known = zones.select(F.col("LocationID").alias("location_id"))
    return counted.join(known, "location_id", "left_anti").select("trip_end", "location_id", "n_trips")
