"""Jobs for spark-submit.

    spark-submit kpi_job.py --trips IN --zones CSV --out DIR [--weeks 4]
    spark-submit word_count_job.py --input TEXT --output DIR
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from farelight.operators.filters import parse_weeks
from farelight.operators.quality import enforce, valid_trips
from farelight.operators.text import word_counts
from farelight.plans.gold import GoldTable
from farelight.plans.kpis import calculate_kpis
from farelight.plans.marts import weekly_volume
from farelight.session import build_session
from farelight.sources.readers import read_kpis, read_lines, read_trips, read_zones
from farelight.sources.writers import child, write_kpis, write_parquet, write_word_counts

log = logging.getLogger("farelight")


@dataclass
class KpiJob:
    """One run. Trips are scanned once for the gates (twice when they carry ids), and
    twice for the KPIs: once for the latest pickup and once for the recent weeks."""

    trips_path: str
    zones_path: str
    out: str
    weeks: int = 4
    mode: str = "strict"
    align_to_week: bool = False
    by_week: bool = False
    weekly_metrics: bool = False
    incremental: bool = False

    def __post_init__(self) -> None:
        if self.incremental and not self.by_week:
            raise ValueError("incremental needs by_week, as it replaces the weeks that new files touch")
        if self.by_week and not self.align_to_week:
            raise ValueError("by_week needs align_to_week, or a part of a week replaces the whole week")

    def run(self, spark: SparkSession) -> DataFrame:
        """Write the KPI table once and return it as saved."""
        zones = read_zones(spark, self.zones_path)
        log.info("zones, rows=%d", zones.count())
        if self.incremental:
            return self._merge_new_files(spark, zones)
        raw = read_trips(spark, self.trips_path)
        n_raw, n_clean = enforce(raw, self.mode)
        log.info("trips, raw rows=%d, clean rows=%d", n_raw, n_clean)
        trips = valid_trips(raw, self.mode)
        # Counted by the tasks that write, where each counts once however often it is tried.
        sent = Observation("kpis")
        kpis = calculate_kpis(trips, zones, self.weeks, self.align_to_week)
        path = write_kpis(kpis.observe(sent, F.count(F.lit(1)).alias("n_rows")), self.out, self.by_week)
        saved = read_kpis(spark, path)
        if self.weekly_metrics:
            write_parquet(weekly_volume(saved), child(self.out, "weekly_metrics"))
        log.info("KPIs saved to %s, rows=%d", path, sent.get["n_rows"])
        return saved


    def _merge_new_files(self, spark: SparkSession, zones: DataFrame) -> DataFrame:
        """Read only the trip files that are new since the last run; see :class:`GoldTable`."""
        gold = GoldTable(spark, self.out)
        log.info("new trip files=%d", gold.merge_files(self.trips_path, zones, self.mode))
        saved = gold.kpis(self.weeks)
        if saved is None:
            raise FileNotFoundError(f"No trip files below {self.trips_path}")
        if self.weekly_metrics:
            write_parquet(weekly_volume(saved), child(self.out, "weekly_metrics"))
        return saved


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Weekly trip KPIs per borough")
    parser.add_argument("--trips", required=True, help="trip parquet file or folder")
    parser.add_argument("--zones", required=True, help="zone lookup CSV")
    parser.add_argument("--out", required=True, help="output folder; the table goes to <out>/kpis")
    parser.add_argument("--weeks", default="4", help="trailing weeks to keep; no number means 4")
    parser.add_argument("--mode", choices=("strict", "reference"), default="strict")
    parser.add_argument("--align-to-week", action="store_true", help="keep whole calendar weeks")
    parser.add_argument("--by-week", action="store_true", help="partition by week, replace only these weeks")
    parser.add_argument("--incremental", action="store_true", help="merge new trip files only; needs --by-week")
    parser.add_argument("--weekly-metrics", action="store_true", help="also save trips per week and borough")
    return parser.parse_args(argv)


def _submit(name: str, run: Callable[[SparkSession], None]) -> int:
    """Run on a fresh session; a failure is logged and gives exit code 1."""
    logging.basicConfig(level=logging.INFO)
    spark = build_session(name)
    try:
        run(spark)
        return 0
    except Exception:
        log.exception("job failed")
        return 1
    finally:
        spark.stop()


def main(argv: list[str] | None = None) -> int:
    given = arguments(argv)
    job = KpiJob(
        given.trips,
        given.zones,
        given.out,
        parse_weeks(given.weeks),
        given.mode,
        given.align_to_week,
        given.by_week,
        given.weekly_metrics,
        given.incremental,
    )
    return _submit("farelight-kpis", lambda spark: job.run(spark).show(truncate=False))


def count_words(spark: SparkSession, source: str, out: str, mode: str = "strict") -> None:
    """Word frequencies of text files, saved as ``(word,count)`` lines."""
    write_word_counts(word_counts(read_lines(spark, source), mode=mode), out)


def word_count_main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Word frequencies of text files")
    parser.add_argument("--input", required=True, help="text file or folder")
    parser.add_argument("--output", required=True, help="output folder")
    parser.add_argument("--mode", choices=("strict", "reference"), default="strict")
    given = parser.parse_args(argv)
    return _submit("farelight-words", lambda spark: count_words(spark, given.input, given.output, given.mode))
