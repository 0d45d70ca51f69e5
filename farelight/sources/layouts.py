"""Folders of parquet files whose columns differ from file to file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from farelight.schemas import TRIP_SCHEMA, MissingColumnsError, as_scanned, case_sensitive, match_names, widens
from farelight.sources.readers import list_files

SOURCE_FILE, RESCUED = "source_file", "rescued"

_COMPLEX = (T.StructType, T.ArrayType, T.MapType)


def _merged(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """The columns of all files, from their footers in one job, or None if two files clash."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*files).schema
    except (Py4JJavaError, PySparkException) as error:
        if len(files) > 1 and "CANNOT_MERGE_SCHEMAS" in str(error):
            return None
        raise


def _joined(one: T.StructType, other: T.StructType, exact_case: bool) -> T.StructType | None:
    """Both layouts in one, or None if a column has two types."""

    def key(name: str) -> str:
        return name if exact_case else name.lower()

    known = {key(f.name): f.dataType for f in one.fields}
    if any(known.get(key(f.name), f.dataType) != f.dataType for f in other.fields):
        return None
    return T.StructType(one.fields + [f for f in other.fields if key(f.name) not in known])


def file_layouts(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """The parquet files below a path in as few lots as have one type for each column.

    Spark merges the footers of many files in one job. Files in order of their names are
    halved where that fails, so the jobs grow with the number of places where the
    types change, times the logarithm of the number of files; lots that agree are then
    put together. The driver holds the names of the files, as Spark's own file index does.
    """
    todo = [sorted(unquote(f) for f in list_files(spark, path).inputFiles())]
    lots: list[tuple[T.StructType, list[str]]] = []
    while todo:
        files = todo.pop()
        if not files:
            continue
        found = _merged(spark, files)
        if found is None:
            half = len(files) // 2
            todo += [files[half:], files[:half]]
            continue
        for i, (layout, others) in enumerate(lots):
            both = _joined(layout, found, case_sensitive(spark))
            if both is not None:
                lots[i] = (both, others + files)
                break
        else:
            lots.append((found, files))
    return lots


def _as_text(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, _COMPLEX):
        return F.to_json(column)
    return F.hex(column) if isinstance(kind, T.BinaryType) else column.cast("string")


def _fitted(column: Column, found: T.DataType, wanted: T.DataType) -> tuple[Column, Column | None]:
    """A column in the wanted type, and the text of values that do not fit, null for the rest."""
    if widens(found, wanted):
        return column.cast(wanted), None
    number = isinstance(found, T.NumericType) and isinstance(wanted, T.NumericType)
    if not number and not isinstance(found, T.StringType):
        return F.lit(None).cast(wanted), _as_text(column, found)
    value = column.try_cast(wanted)
    fits = value.isNotNull()
    if number:
        fits = fits & F.coalesce(value.try_cast(found) == column, F.lit(False))
    return F.when(fits, value), F.when(~fits, _as_text(column, found))


def _bound(spark: SparkSession, layout: T.StructType, files: list[str], wanted: T.StructType, keep: Sequence[str]) -> DataFrame:
    exact_case = case_sensitive(spark)
    more = [c for c in keep if c not in wanted.names]
    names = match_names(layout.names, [*wanted.names, *more], exact_case)
    kinds = {names[f.name]: f.dataType for f in wanted.fields if f.name in names}
    as_read = T.StructType(
        [T.StructField(f.name, as_scanned(f.dataType, kinds.get(f.name, f.dataType)), True) for f in layout.fields]
    )
    columns, misfits = [], []
    for f in wanted.fields:
        if f.name not in names:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value, misfit = _fitted(F.col(f"`{names[f.name]}`"), as_read[names[f.name]].dataType, f.dataType)
        columns.append(value.alias(f.name))
        if misfit is not None:
            misfits.append(F.struct(F.lit(f.name).alias("key"), misfit.alias("value")))
    kept = F.filter(F.array(*misfits), lambda e: e["value"].isNotNull()) if misfits else None
    rescued = F.when(F.size(kept) > 0, F.map_from_entries(kept)) if misfits else F.lit(None)
    others = [F.col(f"`{names[c]}`").alias(c) for c in more if c in names]
    rows = spark.read.schema(as_read).parquet(*files)
    provenance = F.col("_metadata.file_path").alias(SOURCE_FILE)
    return rows.select(*columns, *others, rescued.cast("map<string,string>").alias(RESCUED), provenance)


def read_layouts(
    spark: SparkSession,
    path: str,
    wanted: T.StructType = TRIP_SCHEMA,
    required: Sequence[str] = (),
    keep: Sequence[str] = ("trip_id",),
) -> DataFrame:
    """All parquet files below a path, bound by name to one layout, whatever columns each has.

    A column that a file lacks is null; one of ``required`` that no file has is an error.
    Types that widen are widened by the scan or above it. Other numbers and texts are
    converted where that loses nothing: a fraction is no whole number, a word no amount. A
    value that does not fit is null, and ``rescued``, a map from column to text, has it as it
    was; it is null where all fit. ``source_file`` is the file of the row. ``keep`` lists
    columns to carry along where a file has them; all files must have the same type for those.
    Columns that only folder names give are not read. No files give no rows.

    There is one scan per lot of :func:`file_layouts`, so filters reach the files of all
    columns that are not converted, and unused columns are not read.
    """
    lots = file_layouts(spark, path)
    found = {f for layout, _ in lots for f in match_names(layout.names, required, case_sensitive(spark))}
    missing = [c for c in required if c not in found]
    if lots and missing:
        raise MissingColumnsError(missing)
    if not lots:
        extra = [T.StructField(RESCUED, T.MapType(T.StringType(), T.StringType())), T.StructField(SOURCE_FILE, T.StringType())]
        return spark.createDataFrame([], T.StructType(wanted.fields + extra))
    parts = [_bound(spark, layout, files, wanted, keep) for layout, files in lots]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


def rescued_report(rows: DataFrame) -> DataFrame:
    """``source_file, column_name, n_rows, n_rescued`` for each file and column that holds misfits.

    ``n_rows`` counts all rows of the file. Combined before the shuffle: a row per file
    and column and task.
    """
    per_file = rows.groupBy(SOURCE_FILE).agg(F.count("*").alias("n_rows"))
    misfits = rows.filter(F.col(RESCUED).isNotNull()).select(SOURCE_FILE, F.explode(F.map_keys(RESCUED)).alias("column_name"))
    counted = misfits.groupBy(SOURCE_FILE, "column_name").agg(F.count("*").alias("n_rescued"))
    return counted.join(per_file, SOURCE_FILE).select(SOURCE_FILE, "column_name", "n_rows", "n_rescued")
