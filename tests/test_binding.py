"""Binding by name, widening scans, malformed rows, missing values and the job's log."""

import logging
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelight.functions.rules import truncated
from farelight.operators.ranking import exact_quantiles
from farelight.operators.tables import median_and_maximum
from farelight.plans import marts
from farelight.schemas import TRIP_SCHEMA, AmbiguousColumnsError, MissingColumnsError, conform
from farelight.sources import readers
from tests.frames import kpi_trips as trip_rows, zones

INF, NAN = math.inf, math.nan


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_quantiles_with_odd_values(spark, accuracy):
    values = [*range(200), INF, INF, -INF, NAN, NAN, NAN, None]
    rows = [("a", None if v is None else float(v)) for v in values] + [("none", None), ("none", None), ("b", -INF), ("b", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    levels = [0.0, 0.003, 0.5, 0.97, 1.0]
    got = {(r.g, r.probability): r.quantile for r in exact_quantiles(df, ["g"], "v", levels, accuracy).collect()}
    want = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in levels])).alias("q")).collect()
    for r in want:
        for p, q in zip(levels, r.q or [None] * len(levels), strict=True):
            found = got[r.g, p]
            assert found == q or (math.isnan(found) and math.isnan(q))
    assert len(got) == 3 * len(levels)


def test_maximum_keeps_type_and_groups(spark):
    rows = [("a", 2**53 + 1), ("a", 1), ("none", None)]
    found = median_and_maximum(spark.createDataFrame(rows, "g string, v long"), "v", "g")
    assert {r.g: r.maximum for r in found.collect()} == {"a": 2**53 + 1, "none": None}
    assert found.schema["maximum"].dataType == T.LongType()


def test_truncated(spark):
    values = [NAN, INF, -INF, 1e300, -1e300, 2.9, -2.9, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", truncated(F.col("v")).alias("t"))
    assert [r.t for r in df.collect()] == [0, 2**63 - 1, -(2**63), 2**63 - 1, -(2**63), 2, -2, None]


def test_best_puts_missing_measures_last(spark):
    df = spark.createDataFrame([("x", None), ("y", 2.0), ("z", 1.0)], "borough string, m double")
    assert [r.borough for r in marts._best(df, "m", smallest=True).collect()] == ["z", "y", "x"]
    assert [r.borough for r in marts._best(df, "m").collect()] == ["y", "z", "x"]


def test_names_by_case(spark, tmp_path):
    trips = trip_rows(spark)
    spelled = trips.withColumnRenamed("airport_fee", "Airport_fee")
    spelled.write.parquet(str(tmp_path / "t"))
    read = readers.read_trips(spark, str(tmp_path / "t"))
    assert set(TRIP_SCHEMA.names) <= set(read.columns) and read.count() == trips.count()
    pair = spelled.select("*", F.lit(1.0).alias("AIRPORT_FEE"))
    with pytest.raises(AmbiguousColumnsError):
        conform(pair, TRIP_SCHEMA)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(MissingColumnsError):
            conform(spelled, TRIP_SCHEMA)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_folder_of_two_widths(spark, tmp_path):
    trips, path = trip_rows(spark), str(tmp_path / "t")
    trips.write.parquet(path)
    trips.withColumn("VendorID", F.lit(7)).write.mode("append").parquet(path)
    read = readers.read_trips(spark, path).filter("fare_amount >= 0")
    assert read.filter("VendorID = 7").count() > 0
    assert "GreaterThanOrEqual(fare_amount" in read._jdf.queryExecution().executedPlan().toString()


def test_malformed_rows_cannot_be_overlooked(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("customer_id,trans_date,tran_amount\nCS1,15-Jan-14,98\nCS2,16-Jan-14,52x\n")
    retail = readers.read_retail(spark, str(bad))
    for action in (retail.select("customerId").collect, retail.count):
        with pytest.raises(Exception, match="Malformed line: CS2"):
            action()
    lookup = tmp_path / "zones.csv"
    lookup.write_text("LocationID,Borough,Zone,service_zone\n1,Queens,a,s\n2x,Queens,b,s\n")
    with pytest.raises(Exception, match="Malformed zone id: 2x"):
        readers.read_zones(spark, str(lookup)).select("Borough").collect()


def test_quarantine_keeps_the_line(spark, tmp_path):
    path = tmp_path / "dirty.csv"
    path.write_text('id,date,amount\n"Smith, A",01-Jan-14,52x\n"Smith, B",01-Jan-14,52\nno commas\n')
    rows = readers.read_retail_quarantined(spark, str(path)).collect()
    assert [r.rejected_line for r in rows] == ['"Smith, A",01-Jan-14,52x', None, "no commas"]
    assert (rows[1].customerId, rows[1].transactionAmount) == ("Smith, B", 52.0)


def test_job_logs_rows(spark, tmp_path, caplog):
    from farelight.job import KpiJob

    trip_rows(spark).write.parquet(str(tmp_path / "t"))
    lookup = tmp_path / "zones.csv"
    lookup.write_text("LocationID,Borough,Zone,service_zone\n1,Manhattan,a,s\n2,Queens,b,s\n3,Brooklyn,c,s\n")
    with caplog.at_level(logging.INFO):
        KpiJob(str(tmp_path / "t"), str(lookup), str(tmp_path / "out")).run(spark)
    said = " ".join(r.getMessage() for r in caplog.records)
    assert "zones, rows=3" in said and "raw rows=3, clean rows=3" in said and "rows=2" in said


@pytest.mark.parametrize("by_week", [False, True])
def test_job_counts_kpi_rows_where_it_writes_them(spark, tmp_path, caplog, monkeypatch, by_week):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    from farelight.job import KpiJob

    trip_rows(spark).write.parquet(str(tmp_path / "t"))
    zones(spark).write.option("header", True).csv(str(tmp_path / "z"))
    counted, count = [], Classic.count
    monkeypatch.setattr(Classic, "count", lambda df: counted.append(df.columns) or count(df))
    job = KpiJob(str(tmp_path / "t"), str(tmp_path / "z"), str(tmp_path / "out"), align_to_week=by_week, by_week=by_week)
    with caplog.at_level("INFO", "farelight"):
        saved = job.run(spark)
    assert "total_trips" not in sum(counted, [])
    monkeypatch.undo()
    assert f"rows={saved.count()}" in caplog.messages[-1] and saved.count() == 2
