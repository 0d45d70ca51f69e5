"""The KPI table kept up to date batch by batch, without reading old trips again.

Under one root folder:

- ``sums/batch=B/week_start=W``: sums per quarter-hour and borough of the trips of a batch.
  They add up, so the KPIs of a week come from the sums of all batches for it.
- ``ledger/batch=B``: what a batch consists of. A batch counts from the moment its ledger
  entry, a single file, is there. What a run that broke off before has left behind is
  ignored, and overwritten when the batch is run again.
- ``kpis``: the KPI table by week. A batch replaces the weeks it has trips in, no others,
  and does so before its entry is written; a run after a broken one does it again.

One writer at a time. Trips have to stay as they are once they are merged.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from farelight.functions.timecols import as_time, week_date
from farelight.operators.enrich import enrich_zones
from farelight.operators.quality import enforce, valid_trips
from farelight.plans.kpis import BOROUGH, SLOT, WEEK, metrics_of_slots, slot_sums, with_week_and_hour
from farelight.schemas import PICKUP
from farelight.sources.readers import FILES, list_files, read_kpis, read_trips
from farelight.sources.writers import child, write_kpis

_SUMS = (
    f"{SLOT} long, {BOROUGH} string, n_trips long, amount double, minutes_sum double, minutes_n long, "
    f"revenue_sum double, revenue_n long, batch string, {WEEK} string"
)
_LEDGER = f"{FILES}, latest timestamp, replaces string, batch string"
_ADDED = ("n_trips", "amount", "minutes_sum", "minutes_n", "revenue_sum", "revenue_n")


class ChangedFileError(RuntimeError):
    """A file that had been merged is no longer what it was."""


class GoldTable:
    """KPI table with the partial sums and the ledger it is made from."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _read(self, name: str, layout: str) -> DataFrame:
        try:
            return self.spark.read.schema(layout).parquet(child(self.root, name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], layout)

    def ledger(self) -> DataFrame:
        """Entries of all batches: files with length and time, latest pickup, batches replaced."""
        return self._read("ledger", _LEDGER)

    def active(self) -> DataFrame:
        """``batch`` of those that count: with an entry and not replaced by a compacted one."""
        entries = self.ledger()
        replaced = entries.select(F.col("replaces").alias("batch")).dropna()
        return entries.select("batch").distinct().join(replaced, "batch", "left_anti")

    def has(self, batch: str) -> bool:
        return not self.ledger().filter(F.col("batch") == batch).isEmpty()

    def sums(self, *more: str) -> DataFrame:
        """Partial sums of the batches that count, and of ``more`` batches."""
        batches = self.active()
        if more:
            batches = batches.union(self.spark.createDataFrame([(b,) for b in more], "batch string"))
        # One short row per batch since the last compaction; it prunes the folders to read.
        return self._read("sums", _SUMS).join(F.broadcast(batches.distinct()), "batch", "left_semi")

    def latest(self) -> DataFrame:
        """One row, ``latest``: the latest pickup merged so far, null before the first."""
        return self.ledger().agg(F.max("latest").alias("latest"))

    def new_files(self, path: str) -> DataFrame:
        """Files below a path that are not merged yet. A merged one that has changed is an error."""
        known = self.ledger().filter("path is not null").select("path", F.struct("length", "modified").alias("was"))
        joined = list_files(self.spark, path).join(known, "path", "left")
        changed = joined.filter(F.col("was").isNotNull() & (F.struct("length", "modified") != F.col("was")))
        first = changed.select("path").head()
        if first:
            raise ChangedFileError(f"Changed since it was merged: {first.path}")
        return joined.filter("was is null").drop("was")

    def merge_files(self, path: str, zones: DataFrame, mode: str = "strict", batch: str | None = None) -> int:
        """Merge the trip files below a path that are new; returns their number.

        All gates but continuity are enforced on the new files. Only they are read. Their
        names come to the driver, which lists them in any case.
        """
        files = [tuple(row) for row in self.new_files(path).collect()]
        if not files:
            return 0
        raw = read_trips(self.spark, *[name for name, *_ in files])
        enforce(raw, mode, continuity=False)
        entry = self.spark.createDataFrame(files, FILES)
        self.merge(enrich_zones(valid_trips(raw, mode), zones), batch or uuid.uuid4().hex, entry)
        return len(files)

    def merge(self, enriched: DataFrame, batch: str, files: DataFrame | None = None) -> bool:
        """Merge enriched trips as a batch; a batch that is in the ledger is not merged again."""
        if self.has(batch):
            return False
        sums = with_week_and_hour(slot_sums(enriched)).drop("hour").withColumn(WEEK, F.date_format(WEEK, "yyyy-MM-dd"))
        self._write_sums(sums, batch)
        self._replace_weeks(batch)
        if files is None:
            files = self.spark.createDataFrame([(None, None, None)], FILES)
        latest = enriched.agg(F.max(as_time(PICKUP)).alias("latest"))
        self._commit(files.withColumn("latest", latest.scalar()).withColumn("replaces", F.lit(None).cast("string")), batch)
        return True

    def _write_sums(self, sums: DataFrame, batch: str) -> None:
        # One row per quarter-hour and borough: 672 rows a week and borough, so a file a week is small.
        by_week = sums.repartition(WEEK).write.mode("overwrite").partitionBy(WEEK)
        by_week.parquet(child(self.root, f"sums/batch={batch}"))

    def _replace_weeks(self, batch: str) -> None:
        mine = self._read("sums", _SUMS).filter(F.col("batch") == batch)
        # At most 53 weeks a year.
        weeks = F.broadcast(mine.select(WEEK).distinct())
        write_kpis(metrics_of_slots(self.sums(batch).join(weeks, WEEK, "left_semi").drop(WEEK)), self.root, by_week=True)

    def _commit(self, entry: DataFrame, batch: str) -> None:
        """The ledger entry in one file, which is there as a whole or not at all."""
        rows = entry.select("path", "length", "modified", "latest", "replaces")
        rows.coalesce(1).write.mode("overwrite").parquet(child(self.root, f"ledger/batch={batch}"))

    def compact(self, batch: str | None = None) -> str:
        """Add up the sums of all batches into one; the KPI table stays as it is."""
        batch = batch or uuid.uuid4().hex
        added = self.sums().groupBy(SLOT, BOROUGH, WEEK).agg(*[F.sum(c).alias(c) for c in _ADDED])
        self._write_sums(added, batch)
        nothing = F.lit(None)
        entry = self.active().select(
            nothing.cast("string").alias("path"),
            nothing.cast("long").alias("length"),
            nothing.cast("timestamp").alias("modified"),
            nothing.cast("timestamp").alias("latest"),
            F.col("batch").alias("replaces"),
        )
        self._commit(entry, batch)
        return batch

    def kpis(self, weeks: int | None = None) -> DataFrame | None:
        """The KPI table, of the last ``weeks`` calendar weeks if given; None before the first batch."""
        saved = read_kpis(self.spark, child(self.root, "kpis"))
        if saved is None or weeks is None:
            return saved
        last = saved.agg(F.max(WEEK).cast("date").alias("last")).scalar()
        return saved.filter(F.col(WEEK) >= F.date_format(F.date_sub(last, 7 * (weeks - 1)), "yyyy-MM-dd"))

    def rebuilt(self) -> DataFrame:
        """The whole KPI table computed anew from all sums."""
        return metrics_of_slots(self.sums().drop(WEEK))


def week_text(time: str = PICKUP):
    """Monday of a trip's week as text, as the KPI table has it."""
    return F.date_format(week_date(as_time(time)), "yyyy-MM-dd")
