from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from farelight.session import build_session, pin_utc, scratch_path, written


def stub(folder, master):
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf={"spark.checkpoint.dir": folder} if folder else {}, sparkContext=context)


def test_scratch_is_in_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"{base}/farelight/{spark.sparkContext.applicationId}/x-")
    assert first != second
    assert scratch_path(stub("hdfs://shared/", "yarn"), "x").startswith("hdfs://shared/farelight/app-1/x-")


def test_local_folder_only_with_a_local_master():
    assert "/farelight/app-1/x-" in scratch_path(stub(None, "local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(stub(None, "spark://host:7077"), "x")


def test_written_rows_stay_the_same(spark):
    stable = written(spark.range(100).withColumn("r", F.rand()), "random")
    assert stable.collect() == stable.collect()
    assert "FileScan" in stable._jdf.queryExecution().executedPlan().toString()


def test_zone_is_pinned(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert pin_utc(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    assert build_session() is not None
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
