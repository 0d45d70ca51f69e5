"""Whether keys repeat, by bitmaps where they pay and by shuffle elsewhere."""

import pytest
from pyspark.sql import functions as F

from farelight.operators.quality import QualityGateError, enforce, repeated_key_report
from tests.frames import trips


def repeats(df, *keys):
    report = repeated_key_report(df, keys or ("trip_id",))
    (row,) = report.collect()
    assert row.key_columns == ",".join(keys or ("trip_id",))
    return row.repeated, "bitmap_construct_agg" in report._jdf.queryExecution().analyzed().toString()


def ids(spark, n, parts=4):
    return spark.range(-n // 2, n - n // 2, 1, parts).withColumnRenamed("id", "trip_id")


def test_ids_in_order_go_by_bitmap(spark):
    assert repeats(ids(spark, 100_000)) == (False, True)
    assert repeats(ids(spark, 100_000).withColumn("trip_id", F.col("trip_id").cast("int"))) == (False, True)


@pytest.mark.parametrize("again", [-50_000, -1, 0, 32_767, 32_768, 49_999])
def test_one_repeated_id_is_found(spark, again):
    """In another task, and in the same one."""
    more = spark.range(again, again + 1).withColumnRenamed("id", "trip_id")
    both = ids(spark, 100_000).union(more)
    assert repeats(both) == (True, True)
    assert repeats(both.coalesce(1)) == (True, True)


def test_scattered_ids_are_shuffled(spark):
    far = ids(spark, 5_000).withColumn("trip_id", F.xxhash64("trip_id"))
    assert repeats(far) == (False, False)
    assert repeats(far.union(far.limit(1))) == (True, False)


def test_nulls_count_as_one_value(spark):
    null = spark.createDataFrame([(None,)], "trip_id long")
    assert repeats(ids(spark, 10_000).union(null)) == (False, True)
    assert repeats(ids(spark, 10_000).union(null).union(null))[0]


def test_other_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "name string, n int")
    assert repeats(rows, "name") == (True, False)
    assert repeats(rows, "name", "n") == (False, False)
    assert repeats(rows.filter("false"), "name") == (False, False)
    assert not repeats(rows.filter("false"), "n")[0]


def test_bitmaps_are_smaller_than_ids(spark):
    """Unique ids in order: what is shuffled is one bitmap of 32,768 ids per task and bitmap."""
    report = repeated_key_report(ids(spark, 1_000_000))
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_bitmap" in plan and "hashpartitioning(trip_id" not in plan
    read = ids(spark, 1_000_000).select(F.shiftright("trip_id", 15).alias("b"), F.spark_partition_id().alias("t")).distinct()
    assert read.count() * 4096 < 1_000_000 * 8 / 30


def test_gate(spark):
    one = trips(spark, {}).withColumn("trip_id", F.lit(7))
    assert enforce(one) == (1, 1)
    with pytest.raises(QualityGateError, match="Duplicate trip_id"):
        enforce(one.union(one))
