"""One query per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from farelight.functions.rules import per_mile
from farelight.functions.timecols import as_time, minutes_between, year_week
from farelight.operators import describe, enrich, filters, quality, retail, tables, text
from farelight.plans import kpis, marts
from farelight.plans.gold import GoldTable
from farelight.schemas import DROPOFF, PICKUP
from farelight.session import pin_utc
from farelight.sources import layouts, readers, writers
from farelight.streaming import outbox, status
from farelight.streaming.trips import late_trips, stream_trips
from registry import adapters

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _above_mean(mart: Callable[..., DataFrame], saved: DataFrame) -> DataFrame:
    """A mart whose volume floor is the mean of the latest week, so that it cuts at any size."""
    mean = marts.latest_week(saved).filter("borough is not null").agg(F.avg("total_trips")).first()[0]
    return mart(saved, floor=int(mean or 0))


def _rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, because the order of a sum is not fixed."""
    return df.select(
        *[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )


# --- sources -----------------------------------------------------------------


def _trip_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "trip_id",
        _text(F.col(PICKUP)).alias("pickup"),
        _text(F.col(DROPOFF)).alias("dropoff"),
        # As text: an integer column with nulls has no common form in both engines' frames.
        F.col("passenger_count").cast("string").alias("passenger_count"),
        F.round("trip_distance", 4).alias("trip_distance"),
        "PULocationID",
        "DOLocationID",
        F.col("payment_type").cast("string").alias("payment_type"),
        F.round("fare_amount", 4).alias("fare_amount"),
        F.round("tip_amount", 4).alias("tip_amount"),
        F.round("total_amount", 4).alias("total_amount"),
        *more,
    )


@query
def scan_trips(spark, sf_dir):
    """Trip parquet written, read back and bound to the trip layout."""
    path = adapters.saved(rows := adapters.trips(spark, sf_dir), "trips")
    writers.write_parquet(rows, path)
    return _trip_columns(readers.read_trips(spark, path))


@query
def scan_zones(spark, sf_dir):
    """Zone CSV with header, read with its fixed schema."""
    path = adapters.saved(rows := adapters.zones(spark, sf_dir), "zones")
    writers.write_csv(rows, path)
    return readers.read_zones(spark, path)


@query
def retail_scan(spark, sf_dir):
    path = adapters.saved(rows := adapters.retail(spark, sf_dir), "retail")
    writers.write_csv(rows, path)
    return readers.read_retail(spark, path)


@query
def retail_parse_lines(spark, sf_dir):
    lines = adapters.retail(spark, sf_dir).select(
        F.concat_ws(",", "customerId", "transactionDate", F.col("transactionAmount").cast("string")).alias("value")
    )
    return readers.parse_retail_lines(lines)


@query
def retail_dirty_split(spark, sf_dir):
    """Clean and rejected rows of a CSV with bad numbers and short lines."""
    lines = adapters.retail_dirty_lines(spark, sf_dir)
    path = adapters.saved(lines, "dirty")
    # Another separator keeps the writer from quoting lines for their commas.
    headed = lines.withColumnRenamed("value", "customer_id,trans_date,tran_amount")
    headed.write.option("header", True).option("sep", "\u0001").csv(path)
    return readers.read_retail_quarantined(spark, path)


@query
def kpi_roundtrip(spark, sf_dir):
    """KPI table saved and read back."""
    rows = adapters.kpis(spark, sf_dir)
    path = writers.write_kpis(rows, adapters.saved(rows, "out"))
    return _rounded(readers.read_kpis(spark, path))


@query
def kpi_csv(spark, sf_dir):
    """KPI table exported as CSV with header and read back."""
    rows = adapters.kpis(spark, sf_dir)
    writers.write_csv(rows, path := adapters.saved(rows, "csv"))
    return _rounded(spark.read.schema(rows.schema).option("header", True).csv(path))


@query
def status_events(spark, sf_dir):
    """KPI rows streamed as JSON events into a file sink, and parsed back."""
    rows = adapters.kpis(spark, sf_dir)
    table = writers.write_kpis(rows, adapters.saved(rows, "out"))
    sink = adapters.saved(rows, "events")
    sent = status.stream_status_events(spark, table, adapters.saved(rows, "offsets"), "parquet", path=sink)
    sent.awaitTermination()
    events = spark.read.schema("key string, value string").parquet(sink)
    return _rounded(status.read_status_events(events))


@query
def greeting(spark, sf_dir):
    return tables.greet(adapters.table(spark, sf_dir, "customer"), "c_name")


# --- filters and gates -------------------------------------------------------


@query
def clean_trips(spark, sf_dir):
    """Gates enforced, then row rules."""
    return _trip_columns(quality.clean(adapters.trips(spark, sf_dir)))


@query
def filter_audit(spark, sf_dir):
    return filters.filter_audit(adapters.trips(spark, sf_dir))


@query
def gate_required_columns(spark, sf_dir):
    return quality.required_columns_report(adapters.trips(spark, sf_dir))


@query
def gate_null_rates(spark, sf_dir):
    return _rounded(quality.null_rate_report(adapters.trips(spark, sf_dir)), 6)


@query
def gate_duplicate_ids(spark, sf_dir):
    """Trip ids, which are unique, and order lines, which are not."""
    trips = quality.duplicate_key_report(adapters.trips(spark, sf_dir))
    lines = adapters.table(spark, sf_dir, "lineitem")
    return trips.unionByName(quality.duplicate_key_report(lines, ("l_orderkey", "l_linenumber")))


@query
def gate_week_continuity(spark, sf_dir):
    trips = adapters.trips(spark, sf_dir)
    both = [
        quality.week_continuity_report(trips, mode).withColumn("mode", F.lit(mode))
        for mode in ("strict", "reference")
    ]
    return both[0].unionByName(both[1])


@query
def quality_report(spark, sf_dir):
    return _rounded(quality.quality_report(adapters.trips(spark, sf_dir)), 6)


@query
def missing_weeks(spark, sf_dir):
    """Weeks without a large urgent order."""
    large = adapters.orders(spark, sf_dir).filter("o_totalprice > 490000 and o_orderpriority = '1-URGENT'")
    return filters.missing_weeks(large, "o_orderdate")


@query
def recent_weeks(spark, sf_dir):
    recent = filters.recent_weeks(adapters.enriched(spark, sf_dir))
    return _trip_columns(recent, "PU_Borough", "DO_Borough")


@query
def recent_weeks_aligned(spark, sf_dir):
    """The variant that keeps whole calendar weeks."""
    recent = filters.recent_weeks(adapters.enriched(spark, sf_dir), 2, align_to_week=True)
    return _rounded(kpis.trips_by_week(recent))


@query
def trip_time_bounds(spark, sf_dir):
    bounds = filters.time_bounds(adapters.trips(spark, sf_dir))
    return bounds.select(_text(F.col("min_ts")).alias("min_ts"), _text(F.col("max_ts")).alias("max_ts"))


@query
def year_week_key(spark, sf_dir):
    days = adapters.trips(spark, sf_dir).select(as_time(PICKUP).cast("date").alias("day")).distinct()
    return days.select(year_week(F.col("day")).alias("year_week")).distinct()


# --- enrichment --------------------------------------------------------------


@query
def enrich_pickup(spark, sf_dir):
    rows = enrich.enrich_pickup(adapters.clean_trips(spark, sf_dir), adapters.zones(spark, sf_dir))
    return _trip_columns(rows, "PU_Borough", "PU_Zone", "PU_service_zone")


@query
def enrich_zones(spark, sf_dir):
    zone_columns = [f"{end}_{c}" for end in ("PU", "DO") for c in ("Borough", "Zone", "service_zone")]
    return _trip_columns(adapters.enriched(spark, sf_dir), *zone_columns)


@query
def unmatched_locations(spark, sf_dir):
    return enrich.unmatched_locations(adapters.clean_trips(spark, sf_dir), adapters.zones(spark, sf_dir))


# --- KPIs --------------------------------------------------------------------


@query
def weekly_borough_kpis(spark, sf_dir):
    """The KPI table, with the uncut minutes per mile next to the cut ones."""
    rows = kpis.calculate_kpis(
        adapters.clean_trips(spark, sf_dir), adapters.zones(spark, sf_dir), exact=True
    )
    return _rounded(rows)


@query
def trips_by_hour(spark, sf_dir):
    return kpis.trips_by_hour(adapters.enriched(spark, sf_dir))


@query
def trips_by_week(spark, sf_dir):
    return _rounded(kpis.trips_by_week(adapters.enriched(spark, sf_dir)))


@query
def peak_hour(spark, sf_dir):
    return _rounded(kpis.peak_hours(adapters.enriched(spark, sf_dir)))


@query
def night_share(spark, sf_dir):
    return _rounded(kpis.night_share(adapters.enriched(spark, sf_dir)))


@query
def trip_minutes_per_mile(spark, sf_dir):
    minutes = minutes_between(as_time(PICKUP), as_time(DROPOFF))
    ratio = per_mile(minutes, F.col("trip_distance")).alias("minutes_per_mile")
    return _rounded(adapters.clean_trips(spark, sf_dir).select("trip_id", ratio), 8)


@query
def trip_revenue_per_mile(spark, sf_dir):
    ratio = per_mile(F.col("total_amount"), F.col("trip_distance")).alias("revenue_per_mile")
    return _rounded(adapters.clean_trips(spark, sf_dir).select("trip_id", ratio), 8)


@query
def stage_counts(spark, sf_dir):
    return kpis.stage_counts(adapters.trips(spark, sf_dir), adapters.zones(spark, sf_dir))


# --- marts -------------------------------------------------------------------


@query
def mart_summary(spark, sf_dir):
    return _rounded(marts.summary(adapters.saved_kpis(spark, sf_dir)))


@query
def mart_latest_week(spark, sf_dir):
    return _rounded(marts.latest_week(adapters.saved_kpis(spark, sf_dir)))


@query
def mart_volume_top(spark, sf_dir):
    return marts.volume_top(adapters.saved_kpis(spark, sf_dir))


@query
def mart_revenue_share(spark, sf_dir):
    return _rounded(marts.revenue_distribution(adapters.saved_kpis(spark, sf_dir)))


@query
def mart_top_rev_per_mile(spark, sf_dir):
    return _rounded(_above_mean(marts.top_revenue_per_mile, adapters.saved_kpis(spark, sf_dir)))


@query
def mart_most_efficient(spark, sf_dir):
    return _rounded(_above_mean(marts.most_efficient, adapters.saved_kpis(spark, sf_dir)))


@query
def mart_efficiency_scatter(spark, sf_dir):
    return _rounded(_above_mean(marts.efficiency_scatter, adapters.saved_kpis(spark, sf_dir)))


@query
def mart_time_vs_revenue(spark, sf_dir):
    return _rounded(_above_mean(marts.time_vs_revenue, adapters.saved_kpis(spark, sf_dir)))


@query
def mart_weekly_volume(spark, sf_dir):
    return marts.weekly_volume(adapters.saved_kpis(spark, sf_dir))


@query
def mart_weekly_top(spark, sf_dir):
    return marts.weekly_top(adapters.saved_kpis(spark, sf_dir), 3)


@query
def mart_heatmap(spark, sf_dir):
    return _rounded(marts.heatmap(adapters.saved_kpis(spark, sf_dir)))


@query
def mart_heatmap_grid(spark, sf_dir):
    return marts.heatmap_grid(adapters.saved_kpis(spark, sf_dir))


@query
def mart_weekly_trend(spark, sf_dir):
    return _rounded(marts.weekly_trend(adapters.saved_kpis(spark, sf_dir)))


@query
def mart_describe(spark, sf_dir):
    return _rounded(marts.describe(adapters.saved_kpis(spark, sf_dir)), 3)


@query
def mart_listing(spark, sf_dir):
    return _rounded(marts.listing(adapters.saved_kpis(spark, sf_dir)))


# --- text --------------------------------------------------------------------


@query
def word_count(spark, sf_dir):
    return text.word_counts(adapters.table(spark, sf_dir, "documents"), "text")


@query
def word_count_lines(spark, sf_dir):
    """Line by line from a text file, empty tokens kept."""
    docs = adapters.table(spark, sf_dir, "documents").select("text")
    docs.write.text(path := adapters.saved(docs, "lines"))
    return text.word_counts(readers.read_lines(spark, path), mode="reference")


@query
def word_count_text(spark, sf_dir):
    """Counts saved as text lines and read back."""
    counts = text.word_counts(adapters.table(spark, sf_dir, "documents"), "text")
    writers.write_word_counts(counts, path := adapters.saved(counts, "counts"))
    return readers.read_lines(spark, path)


@query
def char_counts(spark, sf_dir):
    return text.char_counts(adapters.table(spark, sf_dir, "documents"), "text")


@query
def top_chars(spark, sf_dir):
    return text.top_n(text.char_counts(adapters.table(spark, sf_dir, "documents"), "text"), 10)


@query
def text_stats(spark, sf_dir):
    return text.text_stats(adapters.table(spark, sf_dir, "documents"), "source", "text")


@query
def top_words(spark, sf_dir):
    """The twenty most frequent words."""
    return text.top_words(adapters.table(spark, sf_dir, "documents"), 20, "text")


@query
def rare_top_customers(spark, sf_dir):
    """The ten customers with most orders, among keys too even for a small sketch."""
    keys = adapters.orders(spark, sf_dir).select("o_custkey")
    return text.most_frequent(keys, 10, "o_custkey", tracked=64)


@query
def text_stats_by_file(spark, sf_dir):
    """Characters and lines of text files, a folder for each source, summed by folder.

    Each text is a line or several, and each file ends in a line feed.
    """
    docs = adapters.table(spark, sf_dir, "documents").select("source", F.coalesce("text", F.lit("")).alias("text"))
    docs.write.partitionBy("source").text(path := adapters.saved(docs, "texts"))
    source = F.regexp_extract("path", "/source=([^/]*)/", 1).alias("source")
    files = text.file_stats(spark, path)
    return files.groupBy(source).agg(F.sum("n_chars").alias("n_chars"), F.sum("n_lines").alias("n_lines"))


# --- files of several layouts --------------------------------------------------


def _kind_of_file() -> Column:
    return F.regexp_extract("source_file", "/([a-z]+)/[^/]*$", 1).alias("kind")


@query
def trips_of_mixed_files(spark, sf_dir):
    rows = layouts.read_layouts(spark, adapters.mixed_trip_files(spark, sf_dir))
    return _rounded(
        rows.groupBy(_kind_of_file()).agg(
            F.count("*").alias("n_rows"),
            F.count("rescued").alias("n_rescued"),
            F.count("passenger_count").alias("n_passengers"),
            F.sum("passenger_count").alias("passengers"),
            F.sum("fare_amount").alias("fares"),
            F.count("congestion_surcharge").alias("n_surcharges"),
        ),
        2,
    )


@query
def rescued_values(spark, sf_dir):
    rows = layouts.read_layouts(spark, adapters.mixed_trip_files(spark, sf_dir))
    report = layouts.rescued_report(rows)
    return report.groupBy(_kind_of_file(), "column_name").agg(F.sum("n_rescued").alias("n_rescued"))


# --- retail ------------------------------------------------------------------


@query
def retail_high_value(spark, sf_dir):
    return retail.high_value(adapters.retail(spark, sf_dir), 400_000)


@query
def retail_high_value_total(spark, sf_dir):
    return _rounded(retail.high_value_total(adapters.retail(spark, sf_dir), 200_000.0), 2)


@query
def retail_avg(spark, sf_dir):
    return _rounded(retail.average_amount(adapters.retail(spark, sf_dir)))


@query
def retail_avg_by_month(spark, sf_dir):
    return _rounded(retail.average_by_month(adapters.retail(spark, sf_dir)))


# --- tables ------------------------------------------------------------------


@query
def names_by_key(spark, sf_dir):
    customers = adapters.table(spark, sf_dir, "customer")
    return tables.names_by_key(customers, "c_name", F.col("c_mktsegment") == "BUILDING")


@query
def names_by_flag(spark, sf_dir):
    suppliers = adapters.table(spark, sf_dir, "supplier").withColumn("in_credit", F.col("s_acctbal") > 0)
    return tables.names_by_key(suppliers, "s_name", F.col("in_credit"))


@query
def totals_by_key(spark, sf_dir):
    return tables.totals_by_key(adapters.table(spark, sf_dir, "customer"), "c_nationkey")


@query
def median_by_group(spark, sf_dir):
    """Exact median and maximum price per return flag."""
    lines = adapters.table(spark, sf_dir, "lineitem")
    return _rounded(tables.median_and_maximum(lines, "l_extendedprice", "l_returnflag"))


@query
def avg_by_key(spark, sf_dir):
    lines = adapters.table(spark, sf_dir, "lineitem")
    return _rounded(tables.averages_by_key(lines, "l_quantity", "l_suppkey"))


@query
def avg_by_two_keys(spark, sf_dir):
    lines = adapters.table(spark, sf_dir, "lineitem")
    return _rounded(tables.averages_by_key(lines, "l_quantity", "l_returnflag", "l_linestatus"))


@query
def regex_validity(spark, sf_dir):
    """Valid and invalid addresses among the blank-separated tokens that hold an ``@``."""
    docs = adapters.table(spark, sf_dir, "documents")
    tokens = docs.select("lang", F.explode(F.split("text", "[ \\t\\r\\n]+")).alias("token"))
    return tables.regex_validity(tokens.filter(F.col("token").contains("@")), "token", "lang")


@query
def avg_first_n(spark, sf_dir):
    """Mean balance of the first 100 customers in credit."""
    customers = adapters.table(spark, sf_dir, "customer")
    flag = F.col("c_acctbal") > 0
    return _rounded(tables.average_of_first(customers, "c_acctbal", flag, [F.col("c_custkey").asc()], 100))


@query
def first_five(spark, sf_dir):
    """The five dearest order lines."""
    lines = adapters.table(spark, sf_dir, "lineitem")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")]
    columns = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"]
    return tables.first_rows(lines.select(*columns), order)


@query
def sorted_by_amount(spark, sf_dir):
    """All orders in order of price, then customer, with their position."""
    rows = adapters.orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    return tables.sorted_rows(rows, "o_totalprice", "o_custkey", "o_orderkey")


@query
def sorted_by_name(spark, sf_dir):
    """All customers by name with their position."""
    rows = adapters.table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    return tables.sorted_rows(rows, "c_name", "c_custkey")


@query
def monoid_sum(spark, sf_dir):
    lines = adapters.table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("long").alias("line_numbers"),
        F.col("l_extendedprice").alias("prices"),
        (F.col("l_quantity") > 49).alias("any_large"),
        (F.col("l_quantity") > 1000).alias("any_huge"),
    )
    return _rounded(tables.monoid_sum(lines), 2)


@query
def avg_score_for_ids(spark, sf_dir):
    """Balances of the customers that have an urgent order."""
    scores = adapters.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id")
    urgent = adapters.orders(spark, sf_dir).filter("o_orderpriority = '1-URGENT'")
    ids = urgent.withColumnRenamed("o_custkey", "id")
    return _rounded(tables.average_for_ids(scores, ids, "id", "c_acctbal", 5000))


@query
def describe_lines(spark, sf_dir):
    """Count, mean, deviation, minimum, quartiles and maximum of the numbers of all order lines."""
    return _rounded(describe.describe(adapters.table(spark, sf_dir, "lineitem")), 3)


@query
def column_quantiles(spark, sf_dir):
    """Tails and medians of three columns, of which one lacks values and one has none."""
    rows = adapters.orders(spark, sf_dir).select(
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.lit(None).cast("double").alias("nothing"),
    )
    return _rounded(describe.column_quantiles(rows, rows.columns, [0.0, 0.001, 0.5, 0.99, 1.0], accuracy=1000), 3)


@query
def median_with_missing(spark, sf_dir):
    """Median and maximum per priority, of which one has no value and the others lack some."""
    known = (F.col("o_orderpriority") != "5-LOW") & (F.col("o_orderstatus") != "P")
    rows = adapters.orders(spark, sf_dir).withColumn("price", F.when(known, F.col("o_totalprice")))
    return _rounded(tables.median_and_maximum(rows, "price", "o_orderpriority"))


@query
def gate_null_rates_high(spark, sf_dir):
    """Null rates of trips that lack many values."""
    return _rounded(quality.null_rate_report(adapters.sparse_trips(spark, sf_dir)), 6)


@query
def filter_times_present(spark, sf_dir):
    """Valid trips where some have no pickup time."""
    return filters.keep_valid(adapters.sparse_trips(spark, sf_dir)).select("trip_id")


@query
def weekly_kpis_reference(spark, sf_dir):
    """KPI table over trips cleaned by the older rules."""
    trips = filters.keep_valid(adapters.trips(spark, sf_dir), "reference")
    return _rounded(kpis.calculate_kpis(trips, adapters.zones(spark, sf_dir)))


@query
def weekly_volume_csv(spark, sf_dir):
    """Trips per week and borough exported as CSV with header and read back."""
    rows = marts.weekly_volume(adapters.saved_kpis(spark, sf_dir))
    writers.write_csv(rows, path := adapters.saved(rows, "csv"))
    return spark.read.schema(rows.schema).option("header", True).csv(path)


# --- KPI table kept up to date ------------------------------------------------------------

_PARTS = ("payment_type IS NULL", "payment_type = 1", "payment_type > 1")


@query
def kpi_incremental(spark, sf_dir):
    """KPI table of the last four calendar weeks from three batches of files.

    The trips come in three parts, each spread over all weeks, so the later ones are late
    everywhere; the sums are compacted in between.
    """
    rows = adapters.trips(spark, sf_dir)
    folder = adapters.saved(rows, "incoming")
    gold = GoldTable(spark, adapters.saved(rows, "gold"))
    for n, part in enumerate(_PARTS):
        rows.filter(part).write.mode("append").parquet(folder)
        gold.merge_files(folder, adapters.zones(spark, sf_dir))
        if n == 1:
            gold.compact()
    return _rounded(gold.kpis(weeks=4))


@query
def kpi_stream(spark, sf_dir):
    """KPI table of the last four calendar weeks from a stream of files in no order of time."""
    rows = adapters.trips(spark, sf_dir)
    folder, root = adapters.saved(rows, "incoming"), adapters.saved(rows, "gold")
    for part in _PARTS:
        rows.filter(part).write.mode("append").parquet(folder)
    checkpoint = adapters.saved(rows, "offsets")
    zones = adapters.zones(spark, sf_dir)
    stream_trips(spark, folder, zones, root, checkpoint, delay="10000 days", max_files=4).awaitTermination()
    return _rounded(GoldTable(spark, root).kpis(weeks=4))


@query
def stream_late_trips(spark, sf_dir):
    """Trips per week and borough that a stream finds more than two days late.

    The trips with a known kind of payment come first, those without it after them.
    """
    rows = adapters.trips(spark, sf_dir)
    folder, root = adapters.saved(rows, "incoming"), adapters.saved(rows, "gold")
    checkpoint, zones = adapters.saved(rows, "offsets"), adapters.zones(spark, sf_dir)
    for part in ("payment_type IS NOT NULL", "payment_type IS NULL"):
        rows.filter(part).write.mode("append").parquet(folder)
        stream_trips(spark, folder, zones, root, checkpoint, delay="2 days").awaitTermination()
    late = late_trips(spark, root).groupBy("week_start", "borough")
    return late.agg(F.sum("n_late").alias("n_late"))


@query
def status_events_once(spark, sf_dir):
    """KPI rows streamed into an outbox, one file at a time, and again after a batch was lost.

    The offsets are forgotten in between, so the whole stream is sent twice under the same
    batch numbers; the events are there once.
    """
    rows = adapters.kpis(spark, sf_dir)
    table = writers.write_kpis(rows, adapters.saved(rows, "out"))
    box = adapters.saved(rows, "outbox")
    for _ in range(2):
        offsets = adapters.saved(rows, "offsets")
        sent = status.stream_status_events(spark, table, offsets, outbox.FORMAT, max_files=1, path=box)
        sent.awaitTermination()
    return _rounded(status.read_status_events(outbox.read_messages(spark, box)))


@query
def gate_repeated_ids(spark, sf_dir):
    """Whether ids repeat: trips and orders by bitmaps, order lines by number and by pair."""
    lines = adapters.table(spark, sf_dir, "lineitem")
    frames = {
        "trips": (adapters.trips(spark, sf_dir), ("trip_id",)),
        "orders": (adapters.orders(spark, sf_dir), ("o_orderkey",)),
        "lines": (lines, ("l_orderkey",)),
        "pairs": (lines, ("l_orderkey", "l_linenumber")),
    }
    reports = [quality.repeated_key_report(*f).withColumn("source", F.lit(name)) for name, f in frames.items()]
    return reduce(DataFrame.unionByName, reports)
