"""Data-quality gates. Each gate is a report frame; :func:`enforce` makes them fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from farelight.functions.rules import REQUIRED_COLUMNS, all_rules, check_mode
from farelight.functions.timecols import as_time, week_date, year_week
from farelight.operators.filters import keep_valid
from farelight.schemas import PICKUP, TRIP_SCHEMA, MissingColumnsError, conform

# The share of nulls allowed, the optional id column, and what a failing gate
# says.
NULL_RATE_LIMIT = 0.20
TRIP_ID = "trip_id"
HIGH_NULLS = "High null rates detected: {rates}"
REPEATED_IDS = "Duplicate trip_id values found"
NO_TIMES = "No valid pickup timestamps found"
LOST_WEEKS = "Incomplete time series: found {found:.0f} weeks, expected {expected:.0f}"

_PROFILE_KEY = "period"


class QualityGateError(RuntimeError):
    """A gate on the data itself failed."""


def missing_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> list[str]:
    """Required names absent from the schema, compared with their exact case."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def required_columns_report(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """One row per required column: whether it is there, and how many values it holds."""
    absent = set(missing_columns(df, required))
    filled = df.agg(*[(F.lit(0) if c in absent else F.count(c)).cast("long").alias(c) for c in required])
    long_form = filled.unpivot([], list(required), "column_name", "non_null_rows")
    return long_form.withColumn("present", ~F.col("column_name").isin(*absent) if absent else F.lit(True))


def _rate(nulls: Column, rows: Column) -> Column:
    # An empty table counts as entirely null.
    return F.coalesce(F.try_divide(nulls, rows), F.lit(1.0))


def null_rate_report(
    df: DataFrame,
    required: tuple[str, ...] = REQUIRED_COLUMNS,
    limit: float = NULL_RATE_LIMIT,
) -> DataFrame:
    """Null share per required column in one pass; a share above ``limit`` fails."""
    totals = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in required],
    )
    long_form = totals.unpivot(["n_rows"], list(required), "column_name", "n_null")
    rate = _rate(F.col("n_null"), F.col("n_rows"))
    return long_form.withColumn("null_rate", rate).withColumn("passed", rate <= F.lit(limit))


def duplicate_key_report(df: DataFrame, keys: tuple[str, ...] = (TRIP_ID,)) -> DataFrame:
    """Number of key values that occur more than once; null keys count as one value."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.agg(F.count("*").alias("n_duplicate_keys")).select(
        F.lit(",".join(keys)).alias("key_columns"),
        "n_duplicate_keys",
        (F.col("n_duplicate_keys") == 0).alias("passed"),
    )


# Bits of one of Spark's bitmaps, which has 4 KB; and the values it has to stand for in a task
# before it is smaller than they are, at 16 bytes each.
BITMAP_BITS = 15
BITMAP_VALUES = 256


def repeated_key_report(df: DataFrame, keys: tuple[str, ...] = (TRIP_ID,)) -> DataFrame:
    """Whether any key value occurs more than once: ``key_columns, repeated``, one row.

    Null keys count as one value. Whole numbers that stand close together in the tasks that
    read them, as ids given in order do, are shuffled as bitmaps: a number is one bit of one
    bitmap, so a bitmap with fewer bits than rows has a repeated one, exactly. That is about a
    bit for each id. Whether it pays is measured in a scan of the key alone. Keys of any
    other kind are shuffled as they are, once, until one is found twice.
    """
    names = F.lit(",".join(keys)).alias("key_columns")
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        key = F.col(keys[0]).cast("long")
        numbers = df.select(
            F.shiftright(key, BITMAP_BITS).alias("_bitmap"),
            key.bitwiseAND((1 << BITMAP_BITS) - 1).alias("_bit"),
            F.spark_partition_id().alias("_task"),
        )
        read = numbers.agg(
            F.count("_bit").alias("n"),
            F.count_if(F.col("_bit").isNull()).alias("nulls"),
            F.approx_count_distinct(F.when(F.col("_bit").isNotNull(), F.struct("_task", "_bitmap"))).alias("bitmaps"),
        ).first()
        if read.nulls > 1:
            return df.sparkSession.range(1).select(names, F.lit(True).alias("repeated"))
        if read.n >= BITMAP_VALUES * read.bitmaps:
            per_bitmap = numbers.filter("_bit is not null").groupBy("_bitmap").agg(
                F.count("*").alias("n"), F.bitmap_count(F.bitmap_construct_agg("_bit")).alias("bits")
            )
            return _any_row(per_bitmap.filter("n > bits")).select(names, "repeated")
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    return _any_row(repeated).select(names, "repeated")


def _any_row(df: DataFrame) -> DataFrame:
    """``repeated``: whether there is any row; tasks stop at their first one."""
    return df.limit(1).agg((F.count("*") > 0).alias("repeated"))


_DAY = "day"


def _period(day: Column, mode: str) -> Column:
    return week_date(day) if mode == "strict" else year_week(day)


def _by_period(df: DataFrame, mode: str, **measures: tuple[str, Column]) -> DataFrame:
    """Measures, each given as roll-up function and row-level aggregate, per week or week key.

    Rows are combined per day, and weeks are told from the days.
    """
    check_mode(mode)
    per_day = df.groupBy(as_time(PICKUP).cast("date").alias(_DAY)).agg(
        *[measure.alias(name) for name, (_, measure) in measures.items()]
    )
    return per_day.groupBy(_period(F.col(_DAY), mode).alias(_PROFILE_KEY)).agg(
        *[F.expr(f"{roll_up}({name})").alias(name) for name, (roll_up, _) in measures.items()]
    )


def _bounds() -> dict[str, tuple[str, Column]]:
    pickup = as_time(PICKUP)
    return {"min_ts": ("min", F.min(pickup)), "max_ts": ("max", F.max(pickup))}


def trip_profile(df: DataFrame, mode: str = "strict") -> DataFrame:
    """Rows, valid rows, nulls and time bounds per week: one scan feeds all gates but duplicate ids.

    There are at most 53 weeks per calendar year, so the result is small whatever the
    number of trips.
    """
    nulls = {f"null_{c}": ("sum", F.count_if(F.col(c).isNull())) for c in REQUIRED_COLUMNS}
    return _by_period(
        df,
        mode,
        n_rows=("sum", F.count("*")),
        n_valid=("sum", F.count_if(all_rules(mode))),
        **nulls,
        **_bounds(),
    )


def week_continuity_report(df: DataFrame, mode: str = "strict") -> DataFrame:
    """Weeks expected against weeks seen.

    ``strict`` compares calendar weeks with calendar weeks and ignores missing times.
    ``reference`` expects one more than the whole 7-day spans between the first and last
    date and counts year-week keys, among them the empty key of missing times.
    """
    return _by_period(df, mode, **_bounds()).agg(*_continuity(mode)).withColumn(
        "passed", F.coalesce(F.col("actual_weeks") >= F.col("expected_weeks"), F.lit(False))
    )


def _continuity(mode: str) -> list[Column]:
    first, last = F.min("min_ts"), F.max("max_ts")
    if mode == "strict":
        expected = F.datediff(week_date(last), week_date(first)) / 7 + 1
        actual = F.count_if(F.col("min_ts").isNotNull())
    else:
        expected = F.floor(F.datediff(last.cast("date"), first.cast("date")) / 7) + 1
        actual = F.count("*")
    return [expected.cast("long").alias("expected_weeks"), actual.alias("actual_weeks")]


def quality_report(df: DataFrame, mode: str = "strict", limit: float = NULL_RATE_LIMIT) -> DataFrame:
    """Every gate in one frame: ``gate, subject, measure, bound, passed``.

    Null rates and week continuity share one scan; duplicate ids need their own shuffle.
    """
    return _report_from_profile(df, trip_profile(df, mode), mode, limit)


def _report_from_profile(
    df: DataFrame, profile: DataFrame, mode: str, limit: float, with_rows: bool = False
) -> DataFrame:
    totals = profile.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_valid"), F.lit(0)).alias("n_valid"),
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(c) for c in REQUIRED_COLUMNS],
        *_continuity(mode),
    )

    def line(gate: str, subject: Column, measure: Column, bound: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(gate).alias("gate"),
            subject.alias("subject"),
            measure.cast("double").alias("measure"),
            bound.cast("double").alias("bound"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    nulls = []
    for c in REQUIRED_COLUMNS:
        rate = _rate(F.col(c), F.col("n_rows"))
        nulls.append(line("null_rate", F.lit(c), rate, F.lit(limit), rate <= F.lit(limit)))
    weeks = line(
        "week_continuity",
        F.lit(PICKUP),
        F.col("actual_weeks"),
        F.col("expected_weeks"),
        F.col("actual_weeks") >= F.col("expected_weeks"),
    )
    # No gate, but it comes with them for nothing: all rows, and those that the rules keep.
    rows = [line("rows", F.lit("raw, valid"), F.col("n_rows"), F.col("n_valid"), F.lit(False))] if with_rows else []
    report = totals.select(F.inline(F.array(*nulls, weeks, *rows)))
    if TRIP_ID in df.columns and not with_rows:
        ids = duplicate_key_report(df, (TRIP_ID,)).select(
            F.lit("duplicate_id").alias("gate"),
            F.col("key_columns").alias("subject"),
            F.col("n_duplicate_keys").cast("double").alias("measure"),
            F.lit(0.0).alias("bound"),
            "passed",
        )
        report = report.unionByName(ids)
    return report


def enforce(
    df: DataFrame, mode: str = "strict", limit: float = NULL_RATE_LIMIT, continuity: bool = True
) -> tuple[int, int]:
    """Raise on the first failing gate: columns, null rates, duplicate ids, continuity.

    Without ``continuity`` gaps between weeks and missing times pass, as they may in a part
    of the trips.

    Gives the number of rows and of those that the row rules keep, from the same scan.
    Brings at most nine report rows to the driver.
    """
    check_mode(mode)
    absent = missing_columns(df)
    if absent:
        raise MissingColumnsError(absent)
    report = _report_from_profile(df, trip_profile(df, mode), mode, limit, with_rows=True)
    failed = report.filter(~F.col("passed")).collect()
    by_gate: dict[str, list] = {}
    for row in failed:
        by_gate.setdefault(row.gate, []).append(row)
    if "null_rate" in by_gate:
        rates = ", ".join(f"{r.subject}:{r.measure * 100:.1f}%" for r in by_gate["null_rate"])
        raise QualityGateError(HIGH_NULLS.format(rates=rates))
    # Only whether there is one matters here, so they are not counted.
    if TRIP_ID in df.columns and repeated_key_report(df).first().repeated:
        raise QualityGateError(REPEATED_IDS)
    if continuity and "week_continuity" in by_gate:
        weeks = by_gate["week_continuity"][0]
        if weeks.bound is None:
            raise QualityGateError(NO_TIMES)
        raise QualityGateError(LOST_WEEKS.format(found=weeks.measure, expected=weeks.bound))
    rows = by_gate["rows"][0]
    return int(rows.measure), int(rows.bound)


def clean(df: DataFrame, mode: str = "strict", limit: float = NULL_RATE_LIMIT) -> DataFrame:
    """Gates, then row rules, then binding to the trip layout."""
    enforce(df, mode, limit)
    return valid_trips(df, mode)


def valid_trips(df: DataFrame, mode: str = "strict") -> DataFrame:
    """Row rules and binding alone, for trips that have passed the gates."""
    return conform(keep_valid(df, mode), TRIP_SCHEMA, keep=(TRIP_ID,))
