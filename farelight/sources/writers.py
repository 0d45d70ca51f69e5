"""Sinks: parquet, CSV and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farelight.schemas import KPI_SCHEMA


def child(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_kpis(kpis: DataFrame, out: str, by_week: bool = False) -> str:
    """Write ``<out>/kpis`` and return that path.

    With ``by_week`` the table is partitioned by week and only the weeks at hand are
    replaced. Use it with week-aligned recency only: an unaligned window starts in the
    middle of a week and would replace a whole week by a part of it.
    """
    path = child(out, "kpis")
    frame = kpis.select(*KPI_SCHEMA.names)
    if by_week:
        (
            frame.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("week_start")
            .parquet(path)
        )
    else:
        write_parquet(frame, path)
    return path


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_word_counts(counts: DataFrame, path: str) -> None:
    """One line per pair, as ``(word,count)``."""
    line = F.format_string("(%s,%d)", F.col("word"), F.col("count"))
    counts.select(line.alias("value")).write.mode("overwrite").text(path)
