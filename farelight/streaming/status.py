"""KPI rows as status events: key and JSON value, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from farelight.schemas import KPI_SCHEMA
from farelight.streaming import outbox


def status_events(kpis: DataFrame) -> DataFrame:
    """``key`` is week and borough, ``value`` the whole row as JSON, as a message sink takes them."""
    key = F.concat_ws("|", "week_start", "borough")
    return kpis.select(key.alias("key"), F.to_json(F.struct(*KPI_SCHEMA.names)).alias("value"))


def read_status_events(events: DataFrame) -> DataFrame:
    """KPI rows back from the JSON values."""
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in KPI_SCHEMA.fields)
    return events.select("key", F.from_json("value", layout).alias("row")).select("key", "row.*")


def send_status_events(kpis: DataFrame, sink: str = "kafka", **options: str) -> None:
    """Batch send, e.g. ``sink="kafka"`` with ``kafka.bootstrap.servers`` and ``topic``, or
    ``sink="outbox"`` with ``path`` and, to send a batch once however often it is tried, ``batch``."""
    if sink == outbox.FORMAT:
        outbox.register(kpis.sparkSession)
    status_events(kpis).write.format(sink).options(**options).mode("append").save()


def stream_status_events(
    spark: SparkSession,
    kpi_path: str,
    checkpoint: str,
    sink: str = "kafka",
    max_files: int | None = None,
    **options: str,
) -> StreamingQuery:
    """Send what a saved KPI table holds and has not been sent yet, then stop.

    The checkpoint remembers the files already sent, so a rerun sends new ones only. The
    checkpoint has to be on storage that all executors share. A sink of files or an
    ``outbox`` gets each event once; a broker may get those of a batch that failed again.
    """
    if sink == outbox.FORMAT:
        outbox.register(spark)
    source = spark.readStream.schema(KPI_SCHEMA)
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)
    rows = source.parquet(kpi_path)
    return (
        status_events(rows)
        .writeStream.format(sink)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
