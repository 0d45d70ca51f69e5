"""Record layouts and the by-name, widening-only binding of frames to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def _layout(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_LONG, _DOUBLE, _TEXT, _TIME = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()

# Public yellow-taxi trip record layout.
TRIP_SCHEMA = _layout(
    VendorID=_LONG,
    tpep_pickup_datetime=_TIME,
    tpep_dropoff_datetime=_TIME,
    passenger_count=_LONG,
    trip_distance=_DOUBLE,
    RatecodeID=_LONG,
    store_and_fwd_flag=_TEXT,
    PULocationID=_LONG,
    DOLocationID=_LONG,
    payment_type=_LONG,
    fare_amount=_DOUBLE,
    extra=_DOUBLE,
    mta_tax=_DOUBLE,
    tip_amount=_DOUBLE,
    tolls_amount=_DOUBLE,
    improvement_surcharge=_DOUBLE,
    total_amount=_DOUBLE,
    congestion_surcharge=_DOUBLE,
    airport_fee=_DOUBLE,
)

# Public taxi zone lookup layout.
ZONE_SCHEMA = _layout(LocationID=_LONG, Borough=_TEXT, Zone=_TEXT, service_zone=_TEXT)

# Layout of the weekly KPI table.
KPI_SCHEMA = _layout(
    week_start=_TEXT,
    borough=_TEXT,
    total_trips=_LONG,
    total_revenue=_DOUBLE,
    peak_hour=T.IntegerType(),
    peak_hour_trip_percentage=_DOUBLE,
    avg_minutes_per_mile=_LONG,
    avg_revenue_per_mile=_DOUBLE,
    night_trip_percentage=_DOUBLE,
)

# Layout of the retail transaction file.
RETAIL_SCHEMA = _layout(customerId=_TEXT, transactionDate=_TEXT, transactionAmount=_DOUBLE)

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class MissingColumnsError(ValueError):
    """A frame lacks columns it must have."""

    def __init__(self, missing: list[str]):
        self.missing = missing
        super().__init__(f"Missing required columns: {', '.join(missing)}")


def widens(found: T.DataType, wanted: T.DataType) -> bool:
    if found == wanted or isinstance(found, T.NullType) or isinstance(wanted, T.StringType):
        return True
    if isinstance(wanted, T.LongType):
        return isinstance(found, _INTEGRAL)
    if isinstance(wanted, T.IntegerType):
        return isinstance(found, _INTEGRAL[:3])
    if isinstance(wanted, T.DoubleType):
        return isinstance(found, (*_INTEGRAL, T.FloatType))
    if isinstance(wanted, T.TimestampType):
        return isinstance(found, (T.DateType, T.TimestampNTZType))
    return False


class AmbiguousColumnsError(ValueError):
    """Several columns of a frame have a wanted name, up to case."""


def case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def match_names(found: Sequence[str], wanted: Sequence[str], exact_case: bool) -> dict[str, str]:
    """Wanted name to the found one, by Spark's rule for case; raises if there are several."""
    known: dict[str, list[str]] = {}
    for name in found:
        known.setdefault(name if exact_case else name.lower(), []).append(name)
    matched = {name: known.get(name if exact_case else name.lower(), []) for name in wanted}
    several = [f"{name}: {', '.join(names)}" for name, names in matched.items() if len(names) > 1]
    if several:
        raise AmbiguousColumnsError(f"Ambiguous columns: {'; '.join(several)}")
    return {name: names[0] for name, names in matched.items() if names}


def check_fields(found: T.StructType, wanted: T.StructType, exact_case: bool = False) -> dict[str, str]:
    """Wanted name to found name.

    Raises when a wanted column is absent or would lose information in the cast.
    """
    names = match_names(found.names, wanted.names, exact_case)
    missing = [c for c in wanted.names if c not in names]
    if missing:
        raise MissingColumnsError(missing)
    types = {f.name: found[names[f.name]].dataType for f in wanted.fields}
    narrowed = [
        f"{f.name}: {types[f.name].simpleString()} to {f.dataType.simpleString()}"
        for f in wanted.fields
        if not widens(types[f.name], f.dataType)
    ]
    if narrowed:
        raise TypeError(f"Cannot widen columns: {', '.join(narrowed)}")
    return names


def as_scanned(found: T.DataType, wanted: T.DataType) -> T.DataType:
    """The type to read a parquet column with: the wanted one where the scan can widen to it.

    The files of a folder may then differ in width. Anything else is cast above the scan.
    """
    if isinstance(wanted, T.LongType) and isinstance(found, _INTEGRAL):
        return wanted
    if isinstance(wanted, T.IntegerType) and isinstance(found, _INTEGRAL[:3]):
        return wanted
    if isinstance(wanted, T.DoubleType) and isinstance(found, (*_INTEGRAL[:3], T.FloatType)):
        return wanted
    if isinstance(wanted, T.TimestampType) and isinstance(found, T.TimestampNTZType):
        return wanted
    return found


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bind ``df`` to ``schema`` by name; ``keep`` lists further columns to carry along.

    Names are compared by Spark's rule for case; the output has the spelling of ``schema``.
    """
    exact_case = case_sensitive(df.sparkSession)
    names = check_fields(df.schema, schema, exact_case)
    others = match_names(df.columns, [c for c in keep if c not in schema.names], exact_case)
    return df.select(
        *[F.col(names[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields],
        *[F.col(found).alias(name) for name, found in others.items()],
    )
