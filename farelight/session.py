"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # Hours and weeks are cut in the session zone, so it is pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A location or key that holds a large part of the rows is split at run time
    # when a join has to shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


PARTITIONS = "spark.sql.shuffle.partitions"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS_PER_CORE = 8


def build_session(app_name: str = "farelight", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; the master is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.getConf().contains(PARTITIONS):
        # Many small shuffle partitions to start from: a large shuffle then fits in memory
        # task by task, and adaptive execution merges what turns out small.
        start = max(200, PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism)
        spark.conf.set(INITIAL_PARTITIONS, str(start))
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone on a session that somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@lru_cache(maxsize=None)
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="farelight-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only when nothing is configured and the master
    is local, as in tests; on a cluster an unset folder is an error.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_folder(app)
    return f"{base.rstrip('/')}/farelight/{app}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to scratch and read it back.

    The result has short lineage, survives the loss of executors, holds the same
    rows each time it is read, and has a size Spark knows when it plans a join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
