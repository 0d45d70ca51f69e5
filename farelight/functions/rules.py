"""Row rules for trips, each a named condition, and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from farelight.schemas import DROPOFF, PICKUP

# Columns every trip file must have.
REQUIRED_COLUMNS = (
    PICKUP,
    DROPOFF,
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
)

MODES = ("strict", "reference")


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")


# The keep-condition of each row rule. A null condition rejects the row,
# so only tip and payment may be missing.
_PICKUP_TIME = f"try_cast({PICKUP} AS timestamp)"
_DROPOFF_TIME = f"try_cast({DROPOFF} AS timestamp)"
ROW_RULES = {
    "fare_not_negative": "fare_amount >= 0",
    "total_not_negative": "total_amount >= 0",
    "distance_positive": "trip_distance > 0",
    "passengers_0_to_8": "passenger_count BETWEEN 0 AND 8",
    "times_present": f"{_PICKUP_TIME} IS NOT NULL AND {_DROPOFF_TIME} IS NOT NULL",
    "dropoff_not_before_pickup": f"{_DROPOFF_TIME} >= {_PICKUP_TIME}",
    "tip_missing_or_not_negative": "tip_amount IS NULL OR tip_amount >= 0",
    "payment_missing_or_1_to_6": "payment_type IS NULL OR payment_type BETWEEN 1 AND 6",
}

# NaN compares above every number in Spark and would pass these.
NOT_NAN = {
    "fare_not_negative": "fare_amount",
    "total_not_negative": "total_amount",
    "distance_positive": "trip_distance",
    "tip_missing_or_not_negative": "tip_amount",
}


def row_rules(mode: str = "strict") -> dict[str, str]:
    """Rule name to SQL keep-condition.

    ``strict`` also rejects NaN in numeric columns; ``reference`` lets it through.
    """
    check_mode(mode)
    if mode == "reference":
        return dict(ROW_RULES)
    return {
        name: f"({rule}) AND NOT isnan({NOT_NAN[name]})" if name in NOT_NAN else rule
        for name, rule in ROW_RULES.items()
    }


def all_rules(mode: str = "strict") -> Column:
    return F.expr(" AND ".join(f"({rule})" for rule in row_rules(mode).values()))


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, and 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole) * F.lit(100.0), F.lit(0.0))


def per_mile(amount: Column, distance: Column) -> Column:
    return F.try_divide(amount, distance)


# The long range, and the first double beyond it.
LONGEST, BEYOND = 2**63 - 1, 2.0**63


def truncated(value: Column) -> Column:
    """Toward zero as a long; NaN gives 0, and what is beyond the long range its edge."""
    return (
        F.when(F.isnan(value), F.lit(0).cast("long"))
        .when(value >= F.lit(BEYOND), F.lit(LONGEST))
        .when(value < F.lit(-BEYOND), F.lit(-LONGEST - 1))
        .otherwise(value.cast("long"))
    )
