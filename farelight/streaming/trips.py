"""Trips as a stream: the KPI table kept by micro-batch, with a watermark and a table of late trips.

A micro-batch is merged into a :class:`GoldTable` under its number, once: after a restart
Spark repeats the batch it had not confirmed, and the ledger knows it. The watermark of a
batch is the latest pickup of all batches before it less the allowed delay, as in Spark's
own windowed aggregation. That one drops late rows without a trace; here they are kept in a
table of their own. The state per quarter-hour and borough are the sums of the gold table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from farelight.functions.timecols import as_time
from farelight.operators.enrich import enrich_zones
from farelight.operators.filters import keep_valid
from farelight.plans.gold import GoldTable, week_text
from farelight.schemas import PICKUP, TRIP_SCHEMA
from farelight.sources.writers import child

LATE = "late"


def merge_micro_batch(gold: GoldTable, trips: DataFrame, zones: DataFrame, number: int, delay: str, mode: str) -> None:
    """Merge one micro-batch; trips behind the watermark go to ``<root>/late``."""
    batch = f"stream-{number}"
    if gold.has(batch):
        return
    enriched = enrich_zones(keep_valid(trips, mode), zones)
    bound = gold.latest().select((F.col("latest") - F.expr(f"interval {delay}")).alias("bound")).scalar()
    late = F.coalesce(as_time(PICKUP) < bound, F.lit(False))
    behind = enriched.filter(late)
    # Under the number of the batch, so that a repeated batch replaces what it has written.
    behind.write.mode("overwrite").parquet(child(gold.root, f"{LATE}/batch={batch}"))
    gold.merge(enriched.filter(~late), batch)


def stream_trips(
    spark: SparkSession,
    path: str,
    zones: DataFrame,
    root: str,
    checkpoint: str,
    delay: str = "7 days",
    mode: str = "strict",
    max_files: int | None = None,
) -> StreamingQuery:
    """Merge the trip files of a folder that have not been merged yet, then stop.

    ``delay`` is how long after the latest pickup a trip may still come in. The checkpoint
    and the root have to be on storage that all executors share.
    """
    gold = GoldTable(spark, root)
    source = spark.readStream.schema(TRIP_SCHEMA)
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)

    def each(batch: DataFrame, number: int) -> None:
        merge_micro_batch(gold, batch, zones, number, delay, mode)

    return (
        source.parquet(path)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_trips(spark: SparkSession, root: str) -> DataFrame:
    """Late trips per batch, week and borough: ``batch, week_start, borough, n_late``.

    Counts only batches that are in the ledger.
    """
    gold = GoldTable(spark, root)
    rows = spark.read.option("basePath", child(root, LATE)).parquet(child(root, LATE))
    counted = rows.groupBy(F.col("batch").cast("string").alias("batch"), week_text().alias("week_start"), F.col("PU_Borough").alias("borough"))
    known = gold.ledger().select("batch").distinct()
    return counted.agg(F.count("*").alias("n_late")).join(known, "batch", "left_semi")
