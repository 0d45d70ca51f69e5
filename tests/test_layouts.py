"""Folders whose parquet files differ in columns and types."""

import re
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from farelight.schemas import TRIP_SCHEMA, MissingColumnsError
from farelight.sources import layouts, read_layouts, rescued_report

WANTED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("note", T.StringType()),
    ]
)


def put(spark, path, kind, rows):
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(path))


def plain(rows):
    """Rows in one order, with NaN equal to itself and maps in order of their keys."""
    return sorted(repr((*r[:4], r[4] and sorted(r[4].items()))) for r in rows)


def test_values_that_fit_are_converted_and_the_rest_is_rescued(spark, tmp_path):
    noon = datetime(2024, 1, 1, 12)
    put(spark, tmp_path / "a b", "id long, amount double, at timestamp, note string", [(1, 1.5, noon, "x")])
    put(spark, tmp_path / "b", "ID int, amount float, at date", [(2, 2.5, date(2024, 1, 1))])
    words = [("3", "3.5", "2024-01-01 12:00:00"), ("c", "much", "soon"), (None, None, None), ("4.5", "NaN", None)]
    put(spark, tmp_path / "c", "id string, amount string, at string", words)
    fractions = [(5.0, True), (5.5, None), (float("nan"), False), (1e300, None), (None, None)]
    put(spark, tmp_path / "d", "id double, amount boolean", fractions)
    put(spark, tmp_path / "e", "id long, at long, note struct<k: int>", [(6, 7, (8,))])
    found = read_layouts(spark, str(tmp_path), WANTED).select(*WANTED.names, "rescued").collect()
    expected = [
        (1, 1.5, noon, "x", None),
        (2, 2.5, datetime(2024, 1, 1), None, None),
        (3, 3.5, noon, None, None),
        (None, None, None, None, {"id": "c", "amount": "much", "at": "soon"}),
        (None, None, None, None, None),
        (None, float("nan"), None, None, {"id": "4.5"}),
        (5, None, None, None, {"amount": "true"}),
        (None, None, None, None, {"id": "5.5"}),
        (None, None, None, None, {"id": "NaN", "amount": "false"}),
        (None, None, None, None, {"id": "1.0E300"}),
        (None, None, None, None, None),
        (6, None, None, "{8}", {"at": "7"}),
    ]
    assert plain(found) == plain(expected)


def test_each_row_names_its_file(spark, tmp_path):
    put(spark, tmp_path / "a", "id long", [(1,), (2,)])
    put(spark, tmp_path / "b", "id string", [("3",), ("x",), ("y",)])
    rows = read_layouts(spark, str(tmp_path), WANTED)
    counts = {re.search("/([ab])/", r.source_file)[1]: r["count"] for r in rows.groupBy("source_file").count().collect()}
    assert counts == {"a": 2, "b": 3}
    (report,) = rescued_report(rows).collect()
    assert "/b/" in report.source_file and tuple(report)[1:] == ("id", 3, 2)


def test_files_of_one_layout_make_one_lot(spark, tmp_path):
    for i in range(7):
        put(spark, tmp_path / f"{i}", ("id long", "id string, note string")[i % 2], [(i,), (i,)] if i % 2 == 0 else [(str(i), "n")])
    put(spark, tmp_path / "8", "amount double", [(1.0,)])
    lots = layouts.file_layouts(spark, str(tmp_path))
    assert sorted(len(files) for _, files in lots) == [3, 5]
    rows = read_layouts(spark, str(tmp_path), WANTED)
    assert sorted(r.id for r in rows.filter("id is not null").collect()) == [0, 0, 1, 2, 2, 3, 4, 4, 5, 6, 6]


def test_required_columns_and_folders_without_files(spark, tmp_path):
    put(spark, tmp_path / "a", "id long", [(1,)])
    put(spark, tmp_path / "b", "AMOUNT double", [(1.0,)])
    assert read_layouts(spark, str(tmp_path), WANTED, required=("id", "amount")).count() == 2
    with pytest.raises(MissingColumnsError, match="note"):
        read_layouts(spark, str(tmp_path), WANTED, required=("id", "note"))
    (tmp_path / "none").mkdir()
    empty = read_layouts(spark, str(tmp_path / "none"), WANTED, required=("id",))
    assert empty.columns == [*WANTED.names, "rescued", "source_file"] and empty.count() == 0
    with pytest.raises(PySparkException):
        read_layouts(spark, str(tmp_path / "absent"), WANTED)


def test_columns_to_keep_may_be_missing_in_some_files(spark, tmp_path):
    put(spark, tmp_path / "a", "id long, trip_id long", [(1, 10)])
    put(spark, tmp_path / "b", "id string, extra int", [("2", 5)])
    rows = read_layouts(spark, str(tmp_path), WANTED)
    assert sorted((r.id, r.trip_id) for r in rows.collect()) == [(1, 10), (2, None)]
    assert "extra" not in rows.columns


def test_filters_and_columns_reach_every_scan(spark, tmp_path):
    put(spark, tmp_path / "a", "VendorID int, total_amount float, fare_amount double", [(1, 2.0, 3.0)])
    put(spark, tmp_path / "b", "VendorID long, total_amount double, fare_amount string", [(1, 2.0, "3.0")])
    rows = read_layouts(spark, str(tmp_path), TRIP_SCHEMA).filter("total_amount > 1").select("VendorID")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 2
    assert plan.count("GreaterThan(total_amount,1.0)") == 2
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    read = [sorted(c.split(":")[0] for c in s.split(",")) for s in schemas]
    # Row numbers are made by the reader, for the column of file names; they are not in the files.
    assert [[c for c in names if not c.startswith("_tmp_metadata")] for names in read] == [["VendorID", "total_amount"]] * 2
