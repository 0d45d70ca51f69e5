"""The KPI table kept up to date by files and by a stream."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelight.job import KpiJob
from farelight.operators.enrich import enrich_zones
from farelight.operators.filters import keep_valid
from farelight.operators.quality import QualityGateError
from farelight.plans.gold import ChangedFileError, GoldTable
from farelight.plans.kpis import calculate_kpis
from farelight.streaming.trips import late_trips, merge_micro_batch, stream_trips
from tests.frames import rows, span, trips, zones

START = datetime(2025, 10, 6)  # a Monday


def some_trips(spark, weeks, each=12, **more):
    """Trips in the given weeks, of every borough, by day and night."""
    made = []
    for week in weeks:
        for i in range(each):
            start = START + timedelta(weeks=week, hours=13 * i % 168, minutes=7 * i)
            end = start + timedelta(minutes=5 + i)
            made.append(span(str(start), str(end), PULocationID=1 + i % 3, trip_distance=1.0 + i / 4, total_amount=3.0 + i, **more))
    return trips(spark, *made)


def put(frame, folder, name=None):
    """One file more in a folder."""
    frame.coalesce(1).write.mode("append").parquet(str(folder))


def full(spark, folder, weeks=4):
    return rows(calculate_kpis(keep_valid(spark.read.parquet(str(folder))), zones(spark), weeks, align_to_week=True))


def close(found, expected):
    assert len(found) == len(expected) > 0
    for a, b in zip(found, expected, strict=True):
        assert a == pytest.approx(b)


@pytest.fixture
def place(spark, tmp_path):
    return tmp_path / "incoming", GoldTable(spark, str(tmp_path / "gold"))


def written_at(root, week):
    folder = os.path.join(root, "kpis", f"week_start={week}")
    return {f: os.stat(os.path.join(folder, f)).st_mtime_ns for f in os.listdir(folder) if f.startswith("part-")}


def test_batches_add_up_to_a_full_run(spark, place):
    folder, gold = place
    assert gold.kpis() is None
    put(some_trips(spark, [0, 1, 2]), folder)
    assert gold.merge_files(str(folder), zones(spark)) == 1
    close(rows(gold.kpis(4)), full(spark, folder))
    put(some_trips(spark, [2, 3, 4], each=9), folder)
    put(some_trips(spark, [5]), folder)
    assert gold.merge_files(str(folder), zones(spark)) == 2
    close(rows(gold.kpis(4)), full(spark, folder))
    close(rows(gold.kpis()), full(spark, folder, 99))
    close(rows(gold.rebuilt()), full(spark, folder, 99))


def test_nothing_new_reads_and_writes_nothing(spark, place):
    folder, gold = place
    put(some_trips(spark, [0]), folder)
    gold.merge_files(str(folder), zones(spark))
    before = rows(gold.ledger())
    assert gold.merge_files(str(folder), zones(spark)) == 0
    assert rows(gold.ledger()) == before


def test_a_late_file_changes_only_its_weeks(spark, place):
    folder, gold = place
    put(some_trips(spark, [0, 1, 2, 3]), folder)
    gold.merge_files(str(folder), zones(spark))
    weeks = [str((START + timedelta(weeks=w)).date()) for w in range(4)]
    before = {w: written_at(gold.root, w) for w in weeks}
    put(some_trips(spark, [1], each=5), folder)
    gold.merge_files(str(folder), zones(spark))
    after = {w: written_at(gold.root, w) for w in weeks}
    assert [w for w in weeks if after[w] != before[w]] == [weeks[1]]
    close(rows(gold.kpis(4)), full(spark, folder))


def test_only_new_files_are_read(spark, place):
    """A merged file may even go; its sums stay."""
    folder, gold = place
    put(some_trips(spark, [0, 1]), folder)
    gold.merge_files(str(folder), zones(spark))
    expected = rows(gold.kpis())
    for name in os.listdir(folder):
        if name.startswith("part-"):
            os.rename(folder / name, folder / f"_{name}")
    put(some_trips(spark, [6]), folder)
    assert gold.merge_files(str(folder), zones(spark)) == 1
    last = str((START + timedelta(weeks=6)).date())
    close(rows(gold.kpis().filter(F.col("week_start") < last)), expected)


def test_a_run_that_breaks_off_leaves_no_trace(spark, place, monkeypatch):
    folder, gold = place
    put(some_trips(spark, [0, 1]), folder)
    gold.merge_files(str(folder), zones(spark))
    put(some_trips(spark, [1, 2]), folder)
    for step in ("_replace_weeks", "_commit"):

        def broken(self, *_):
            raise RuntimeError("lost")

        with monkeypatch.context() as patched:
            patched.setattr(GoldTable, step, broken)
            with pytest.raises(RuntimeError, match="lost"):
                gold.merge_files(str(folder), zones(spark))
        assert gold.active().count() == 1
    assert gold.merge_files(str(folder), zones(spark)) == 1
    close(rows(gold.kpis(4)), full(spark, folder))


def test_a_batch_is_merged_once(spark, place):
    folder, gold = place
    put(some_trips(spark, [0, 1]), folder)
    gold.merge_files(str(folder), zones(spark), batch="b")
    expected = rows(gold.kpis())
    assert not gold.merge(enrich_zones(some_trips(spark, [0]), zones(spark)), "b")
    assert rows(gold.kpis()) == expected


def test_compaction_keeps_sums_files_and_latest(spark, place):
    folder, gold = place
    for weeks in ([0, 1], [1, 2], [0]):
        put(some_trips(spark, weeks), folder)
        gold.merge_files(str(folder), zones(spark))
    expected, latest = rows(gold.kpis()), gold.latest().first()[0]
    gold.compact()
    assert gold.active().count() == 1 and gold.latest().first()[0] == latest
    close(rows(gold.rebuilt()), expected)
    assert gold.merge_files(str(folder), zones(spark)) == 0
    put(some_trips(spark, [1], each=3), folder)
    gold.merge_files(str(folder), zones(spark))
    close(rows(gold.kpis(4)), full(spark, folder))
    gold.compact()
    close(rows(gold.rebuilt()), full(spark, folder, 99))


def test_a_changed_file_is_an_error(spark, place):
    folder, gold = place
    put(some_trips(spark, [0]), folder)
    gold.merge_files(str(folder), zones(spark))
    name = next(n for n in os.listdir(folder) if n.startswith("part-"))
    os.utime(folder / name, (1, 1))
    with pytest.raises(ChangedFileError, match=name):
        gold.merge_files(str(folder), zones(spark))


def test_gates_hold_for_new_files(spark, place):
    folder, gold = place
    put(some_trips(spark, [0]), folder)
    gold.merge_files(str(folder), zones(spark))
    put(some_trips(spark, [5], passenger_count=None), folder)
    with pytest.raises(QualityGateError, match="passenger_count"):
        gold.merge_files(str(folder), zones(spark))
    assert gold.active().count() == 1


def test_files_without_valid_trips_are_merged_too(spark, place):
    folder, gold = place
    put(some_trips(spark, [0], fare_amount=-1.0), folder)
    assert gold.merge_files(str(folder), zones(spark)) == 1
    assert gold.merge_files(str(folder), zones(spark)) == 0
    put(some_trips(spark, [0]), folder)
    gold.merge_files(str(folder), zones(spark))
    close(rows(gold.kpis(4)), full(spark, folder))


def test_job(spark, tmp_path):
    zones(spark).coalesce(1).write.option("header", True).csv(str(tmp_path / "zones"))
    job = KpiJob(
        str(tmp_path / "in"), str(tmp_path / "zones"), str(tmp_path / "out"), align_to_week=True, by_week=True,
        weekly_metrics=True, incremental=True,
    )
    for weeks in ([0, 1], [1, 2]):
        put(some_trips(spark, weeks), tmp_path / "in")
        found = job.run(spark)
    close(rows(found), full(spark, tmp_path / "in"))
    assert spark.read.parquet(str(tmp_path / "out" / "weekly_metrics")).count() > 0
    with pytest.raises(ValueError, match="by_week"):
        KpiJob("a", "b", "c", incremental=True)


# --- stream ----------------------------------------------------------------------------


def stream(spark, place, tmp_path, **options):
    folder, gold = place
    query = stream_trips(spark, str(folder), zones(spark), gold.root, str(tmp_path / "offsets"), **options)
    query.awaitTermination()
    return query


def test_stream_of_shuffled_files_gives_the_batch_table(spark, place, tmp_path):
    folder, gold = place
    for weeks in ([3], [0, 2], [1], [2, 3]):
        put(some_trips(spark, weeks), folder)
    stream(spark, place, tmp_path, delay="60 days", max_files=1)
    close(rows(gold.kpis(4)), full(spark, folder))
    assert gold.active().count() == 4 and late_trips(spark, gold.root).count() == 0
    put(some_trips(spark, [0], each=2), folder)  # a restart goes on from the checkpoint
    stream(spark, place, tmp_path, delay="60 days", max_files=1)
    close(rows(gold.kpis(4)), full(spark, folder))
    assert gold.active().count() == 5


def test_trips_behind_the_watermark_are_counted(spark, place, tmp_path):
    folder, gold = place
    for weeks in ([1, 2], [0, 2], [0, 3]):
        put(some_trips(spark, weeks), folder)
        stream(spark, place, tmp_path, delay="10 days", max_files=1)
    # The second file is 10 days behind only with week 0 up to the latest of week 2; so is the third.
    bound = START + timedelta(weeks=2, hours=13 * 11 % 168, minutes=77)
    latest = some_trips(spark, [1, 2]).agg(F.max("tpep_pickup_datetime")).first()[0]
    assert latest >= bound
    behind = some_trips(spark, [0]).filter(F.col("tpep_pickup_datetime") < F.lit(latest - timedelta(days=10)))
    late = late_trips(spark, gold.root)
    assert late.agg(F.sum("n_late")).first()[0] == 2 * behind.count() > 0
    assert {r.week_start for r in late.collect()} == {"2025-10-06"}
    everything = spark.read.parquet(str(folder)).count()
    assert gold.sums().agg(F.sum("n_trips")).first()[0] + 2 * behind.count() == everything


def test_a_repeated_micro_batch_is_merged_once(spark, place, tmp_path):
    """The batch was merged, but the stream broke before its checkpoint said so."""
    folder, gold = place
    put(some_trips(spark, [0, 1]), folder)
    merge_micro_batch(gold, spark.read.parquet(str(folder)), zones(spark), 0, "9 days", "strict")
    stream(spark, place, tmp_path, delay="9 days")
    close(rows(gold.kpis(4)), full(spark, folder))
    assert gold.active().count() == 1


def test_a_micro_batch_that_fails_is_repeated(spark, place, tmp_path, monkeypatch):
    folder, gold = place
    put(some_trips(spark, [0, 1]), folder)
    with monkeypatch.context() as patched:
        patched.setattr(GoldTable, "_commit", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            stream(spark, place, tmp_path)
    stream(spark, place, tmp_path)
    close(rows(gold.kpis(4)), full(spark, folder))
