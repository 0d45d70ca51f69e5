"""Sources: trips, zones, text lines, retail files and saved KPI tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from farelight.schemas import (
    KPI_SCHEMA,
    RETAIL_SCHEMA,
    TRIP_SCHEMA,
    ZONE_SCHEMA,
    MissingColumnsError,
    as_scanned,
    case_sensitive,
    check_fields,
    conform,
    match_names,
)

CORRUPT = "_corrupt_record"


def _checked(good: Column, message: Column) -> Column:
    """A filter that keeps what is good and fails the query otherwise; no query can prune it."""
    return F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """Trip parquet, of files or folders, bound to the trip layout; ``trip_id`` is carried along when present.

    The scan itself reads the wanted types, so that the files of a folder may differ in
    width and in the kind of their timestamps, and filters still reach the row groups.
    """
    found = spark.read.parquet(*paths).schema
    names = check_fields(found, TRIP_SCHEMA, case_sensitive(spark))
    wanted = {names[f.name]: f.dataType for f in TRIP_SCHEMA.fields}
    as_read = T.StructType(
        [T.StructField(f.name, as_scanned(f.dataType, wanted.get(f.name, f.dataType)), f.nullable) for f in found.fields]
    )
    return conform(spark.read.schema(as_read).parquet(*paths), TRIP_SCHEMA, keep=("trip_id",))


FILES = "path string, length long, modified timestamp"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modified`` of the parquet files below a path; their contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    return listed.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV, bound by the names in its header.

    Only the header is read ahead; all columns are text, and an id that is no whole number
    fails the query, whatever it selects. A missing id is null.
    """
    csv = spark.read.option("header", True)
    header = csv.csv(path).columns
    names = match_names(header, ZONE_SCHEMA.names, case_sensitive(spark))
    missing = [c for c in ZONE_SCHEMA.names if c not in names]
    if missing:
        raise MissingColumnsError(missing)
    rows = csv.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).csv(path)
    bound = rows.select(*[F.col(names[c]).alias(c) for c in ZONE_SCHEMA.names])
    number = F.col("LocationID").try_cast("long")
    good = F.col("LocationID").isNull() | number.isNotNull()
    message = F.concat(F.lit("Malformed zone id: "), F.col("LocationID"))
    return bound.filter(_checked(good, message)).withColumn("LocationID", number)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(path)


def _retail_rows(spark: SparkSession, path: str) -> DataFrame:
    """Each line as it stands in the file, its three columns, and whether they are sound.

    A line is read as one column, by a separator and without quotes, and parsed above that.
    """
    names = RETAIL_SCHEMA.names
    lines = (
        spark.read.schema(T.StructType([T.StructField("line", T.StringType())]))
        .option("header", True)
        .option("sep", "\u0001")
        .option("quote", "")
        .csv(path)
    )
    layout = ", ".join(f"{c} string" for c in (*names, CORRUPT))
    record = F.from_csv("line", layout, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.select("line", record.alias("r")).select("line", "r.*")
    amount = F.col("transactionAmount").try_cast("double")
    good = F.col(CORRUPT).isNull() & amount.isNotNull()
    return rows.select("line", "customerId", "transactionDate", amount.alias("transactionAmount"), good.alias("good"))


def read_retail(spark: SparkSession, path: str) -> DataFrame:
    """Retail CSV with header; a malformed row fails the query, whatever it selects."""
    message = F.concat(F.lit("Malformed line: "), F.col("line"))
    return _retail_rows(spark, path).filter(_checked(F.col("good"), message)).select(*RETAIL_SCHEMA.names)


def read_retail_quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Retail CSV with header; ``rejected_line`` holds a malformed row as it stands in the
    file, and its other columns are null.
    """
    rows = _retail_rows(spark, path)
    return rows.select(
        *[F.when(F.col("good"), F.col(c)).alias(c) for c in RETAIL_SCHEMA.names],
        F.when(~F.col("good"), F.col("line")).alias("rejected_line"),
    )


def read_kpis(spark: SparkSession, path: str) -> DataFrame | None:
    """Saved KPI table, or None when the path does not exist.

    The schema is given, so ``week_start`` stays text in a partitioned table too.
    """
    try:
        return spark.read.schema(KPI_SCHEMA).parquet(path).select(*KPI_SCHEMA.names)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def names_frame(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """In-memory names as a one-column frame."""
    return spark.createDataFrame([(n,) for n in names], "name string")


def parse_retail_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Positional text lines to retail columns; a malformed line fails the query."""
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RETAIL_SCHEMA.fields)
    record = F.from_csv(F.col(line), layout, {"mode": "FAILFAST"})
    return lines.select(record.alias("r")).select("r.*")
