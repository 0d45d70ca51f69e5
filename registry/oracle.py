"""SQL twins of the queries, for DuckDB on the same parquet tables."""

from __future__ import annotations

TRIPS = """
trips AS (
  SELECT user_id AS VendorID,
         ts AS pickup_ts,
         ts + to_minutes(CAST(minute(ts) - 1 AS BIGINT)) AS dropoff_ts,
         CASE WHEN value >= 1 THEN CAST(floor(value / 25) AS BIGINT) END AS passenger_count,
         k / 10.0::DOUBLE AS trip_distance,
         CAST(floor(second(ts) * 0.45::DOUBLE) AS BIGINT) AS PULocationID,
         CAST(floor(k * 0.27::DOUBLE) AS BIGINT) AS DOLocationID,
         CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2
                              WHEN 'signup' THEN 6 WHEN 'error' THEN 7 END AS BIGINT) AS payment_type,
         value - 2 AS fare_amount,
         CASE WHEN event_type <> 'click' THEN value / 10 - 0.3::DOUBLE END AS tip_amount,
         value - 1 AS total_amount,
         event_id AS trip_id
  FROM (SELECT *, (microsecond(ts) - second(ts) * 1000000) // 10000 AS k FROM events)
)"""

MIXED = """
kinds AS (
  SELECT *, CASE payment_type WHEN 1 THEN 'plain' WHEN 2 THEN 'lean' ELSE 'loose' END AS kind FROM trips
),
mixed AS (
  SELECT *, kind = 'loose' AND passenger_count IS NOT NULL AND trip_distance < 3 AS half,
         kind = 'loose' AND fare_amount < 0 AS word
  FROM kinds
)"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS LocationID, r_name AS Borough, n_name AS Zone,
         r_name || ' zone' AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

# The row rules, by name.
RULES = {
    "fare_not_negative": "fare_amount >= 0",
    "total_not_negative": "total_amount >= 0",
    "distance_positive": "trip_distance > 0",
    "passengers_0_to_8": "passenger_count BETWEEN 0 AND 8",
    "times_present": "pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL",
    "dropoff_not_before_pickup": "dropoff_ts >= pickup_ts",
    "tip_missing_or_not_negative": "tip_amount IS NULL OR tip_amount >= 0",
    "payment_missing_or_1_to_6": "payment_type IS NULL OR payment_type BETWEEN 1 AND 6",
}

CLEAN = f"""
clean AS (SELECT * FROM trips WHERE {" AND ".join(f"({r})" for r in RULES.values())})"""

ENRICHED = """
enriched AS (
  SELECT t.*,
         p.Borough AS PU_Borough, p.Zone AS PU_Zone, p.service_zone AS PU_service_zone,
         d.Borough AS DO_Borough, d.Zone AS DO_Zone, d.service_zone AS DO_service_zone
  FROM clean t
  JOIN zones p ON t.PULocationID = p.LocationID
  JOIN zones d ON t.DOLocationID = d.LocationID
)"""

RECENT = """
recent AS (
  SELECT * FROM enriched
  WHERE pickup_ts >= (SELECT date_trunc('millisecond', max(pickup_ts)) - INTERVAL 28 DAY FROM enriched)
)"""


def ratios(source: str) -> str:
    return f"""
ratios AS (
  SELECT strftime(date_trunc('week', pickup_ts), '%Y-%m-%d') AS week_start, PU_Borough AS borough,
         CAST(hour(pickup_ts) AS INTEGER) AS hour, total_amount,
         (floor(epoch(dropoff_ts)) - floor(epoch(pickup_ts))) / 60.0::DOUBLE / trip_distance AS minutes,
         total_amount / trip_distance AS revenue
  FROM {source}
),
hours AS (
  SELECT week_start, borough, hour, count(*) AS n,
         row_number() OVER (PARTITION BY week_start, borough ORDER BY count(*) DESC, hour) AS place
  FROM ratios GROUP BY week_start, borough, hour
),
peaks AS (SELECT week_start, borough, hour AS peak_hour, n AS peak_trips FROM hours WHERE place = 1)"""


KPIS = (
    ratios("recent")
    + """,
kpis AS (
  SELECT week_start, borough, count(*) AS total_trips, sum(total_amount) AS total_revenue,
         any_value(peak_hour) AS peak_hour,
         any_value(peak_trips) / count(*)::DOUBLE * 100 AS peak_hour_trip_percentage,
         CAST(trunc(avg(minutes)) AS BIGINT) AS avg_minutes_per_mile,
         avg(revenue) AS avg_revenue_per_mile,
         count(*) FILTER (WHERE hour BETWEEN 0 AND 5) / count(*)::DOUBLE * 100 AS night_trip_percentage,
         avg(minutes) AS avg_minutes_per_mile_exact
  FROM ratios JOIN peaks USING (week_start, borough)
  GROUP BY week_start, borough
)"""
)

RETAIL = """
retail AS (
  SELECT 'CS' || o_custkey AS customerId, strftime(o_orderdate, '%d-%b-%y') AS transactionDate,
         o_totalprice AS transactionAmount, o_orderstatus, o_orderpriority
  FROM orders
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def rounded(*columns: str, digits: int = 4) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


TO_CLEAN = (TRIPS, CLEAN)
TO_ENRICHED = (TRIPS, CLEAN, ZONES, ENRICHED)
TO_KPIS = (*TO_ENRICHED, RECENT, KPIS)
WHOLE_WEEKS = """
recent AS (
  SELECT * FROM enriched
  WHERE pickup_ts >= (SELECT date_trunc('week', max(pickup_ts)) - INTERVAL 21 DAY FROM enriched)
)"""
TO_WHOLE_WEEKS = (*TO_ENRICHED, WHOLE_WEEKS, KPIS)

TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
TRIP_COLUMNS = f"""trip_id, {TIME.format("pickup_ts")} AS pickup, {TIME.format("dropoff_ts")} AS dropoff,
 CAST(passenger_count AS VARCHAR) AS passenger_count, round(trip_distance, 4) AS trip_distance,
 PULocationID, DOLocationID, CAST(payment_type AS VARCHAR) AS payment_type,
 {rounded("fare_amount", "tip_amount", "total_amount")}"""
KPI_COLUMNS = f"""week_start, borough, total_trips, peak_hour, avg_minutes_per_mile,
 {rounded("total_revenue", "peak_hour_trip_percentage", "avg_revenue_per_mile", "night_trip_percentage")}"""
PU_ZONE = "PU_Borough, PU_Zone, PU_service_zone"
DO_ZONE = "DO_Borough, DO_Zone, DO_service_zone"

# Columns every trip file must have, as named by the queries and here.
REQUIRED = {
    "tpep_pickup_datetime": "pickup_ts",
    "tpep_dropoff_datetime": "dropoff_ts",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "total_amount": "total_amount",
}


def union(selects: list[str]) -> str:
    return "\nUNION ALL ".join(selects)


SPARSE = """
sparse AS (SELECT * REPLACE (
  CASE WHEN payment_type IS NOT NULL THEN passenger_count END AS passenger_count,
  CASE WHEN payment_type IS NOT NULL OR total_amount < 40 THEN pickup_ts END AS pickup_ts) FROM trips)"""
NULL_RATES = union(
    [
        f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
        f"round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS null_rate, "
        f"(count(*) - count({c})) / count(*)::DOUBLE <= 0.2 AS passed FROM trips"
        for name, c in REQUIRED.items()
    ]
)

STRICT_WEEKS = """
SELECT CAST(date_diff('day', date_trunc('week', min(pickup_ts)), date_trunc('week', max(pickup_ts))) AS BIGINT) // 7 + 1
         AS expected_weeks,
       count(DISTINCT date_trunc('week', pickup_ts)) AS actual_weeks
FROM trips"""
REFERENCE_WEEKS = """
SELECT date_diff('day', CAST(min(pickup_ts) AS DATE), CAST(max(pickup_ts) AS DATE)) // 7 + 1 AS expected_weeks,
       count(DISTINCT coalesce(year(pickup_ts) || '-' || lpad(CAST(weekofyear(pickup_ts) AS VARCHAR), 2, '0'), ''))
         AS actual_weeks
FROM trips"""

LATEST = "latest AS (SELECT * FROM kpis WHERE week_start = (SELECT max(week_start) FROM kpis))"

# The regions of the test tables.
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

METRICS = (
    "total_trips",
    "total_revenue",
    "peak_hour_trip_percentage",
    "avg_minutes_per_mile",
    "avg_revenue_per_mile",
    "night_trip_percentage",
)

WORDS = "SELECT lower(unnest(regexp_extract_all(text, '[A-Za-z0-9_]+'))) AS word FROM documents"

LINE_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
)

ORDER_VALUES = {
    "o_custkey": "o_custkey::DOUBLE",
    "price": "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END",
    "nothing": "CAST(NULL AS DOUBLE)",
}

ORACLE: dict[str, str] = {
    # sources
    "scan_trips": with_(TRIPS) + f"SELECT {TRIP_COLUMNS} FROM trips",
    "scan_zones": with_(ZONES) + "SELECT * FROM zones",
    "retail_scan": with_(RETAIL) + "SELECT customerId, transactionDate, transactionAmount FROM retail",
    "retail_parse_lines": with_(RETAIL) + "SELECT customerId, transactionDate, transactionAmount FROM retail",
    "retail_dirty_split": with_(RETAIL)
    + """
SELECT CASE WHEN ok THEN customerId END AS customerId,
       CASE WHEN ok THEN transactionDate END AS transactionDate,
       CASE WHEN ok THEN transactionAmount END AS transactionAmount,
       CASE WHEN NOT ok THEN customerId || gap || transactionDate || gap ||
            CAST(CAST(transactionAmount AS DECIMAL(18, 2)) AS VARCHAR) || tail END AS rejected_line
FROM (SELECT *, o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AS ok,
             CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE ',' END AS gap,
             CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE '' END AS tail FROM retail)""",
    "kpi_roundtrip": with_(*TO_KPIS) + f"SELECT {KPI_COLUMNS} FROM kpis",
    "kpi_csv": with_(*TO_KPIS) + f"SELECT {KPI_COLUMNS} FROM kpis",
    "status_events": with_(*TO_KPIS)
    + f"SELECT week_start || '|' || borough AS key, {KPI_COLUMNS} FROM kpis",
    "greeting": "SELECT 'Hello, ' || c_name AS greeting FROM customer",
    # filters and gates
    "clean_trips": with_(*TO_CLEAN) + f"SELECT {TRIP_COLUMNS} FROM clean",
    "filter_audit": with_(TRIPS)
    + union(
        [
            f"SELECT count(*) AS n_rows, '{name}' AS rule, "
            f"count(*) FILTER (WHERE NOT coalesce({rule}, false)) AS n_rejected FROM trips"
            for name, rule in RULES.items()
        ]
    ),
    "gate_required_columns": with_(TRIPS)
    + union(
        [
            f"SELECT '{name}' AS column_name, count({c}) AS non_null_rows, true AS present FROM trips"
            for name, c in REQUIRED.items()
        ]
    ),
    "gate_null_rates": with_(TRIPS) + NULL_RATES,
    "gate_duplicate_ids": """
SELECT 'trip_id' AS key_columns, count(*) AS n_duplicate_keys, count(*) = 0 AS passed
FROM (SELECT event_id FROM events GROUP BY event_id HAVING count(*) > 1)
UNION ALL
SELECT 'l_orderkey,l_linenumber', count(*), count(*) = 0
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
    "gate_week_continuity": with_(TRIPS)
    + f"""
SELECT *, actual_weeks >= expected_weeks AS passed, 'strict' AS mode FROM ({STRICT_WEEKS})
UNION ALL
SELECT *, actual_weeks >= expected_weeks, 'reference' FROM ({REFERENCE_WEEKS})""",
    "quality_report": with_(TRIPS)
    + f"""
SELECT 'null_rate' AS gate, column_name AS subject, null_rate AS measure, 0.2::DOUBLE AS bound, passed
FROM ({NULL_RATES})
UNION ALL
SELECT 'week_continuity', 'tpep_pickup_datetime', actual_weeks::DOUBLE, expected_weeks::DOUBLE,
       actual_weeks >= expected_weeks FROM ({STRICT_WEEKS})
UNION ALL
SELECT 'duplicate_id', 'trip_id', count(*)::DOUBLE, 0.0::DOUBLE, count(*) = 0
FROM (SELECT trip_id FROM trips GROUP BY trip_id HAVING count(*) > 1)""",
    "missing_weeks": """
WITH present AS (
  SELECT DISTINCT CAST(date_trunc('week', o_orderdate) AS DATE) AS week FROM orders
  WHERE o_totalprice > 490000 AND o_orderpriority = '1-URGENT'
),
every AS (
  SELECT CAST(unnest(generate_series((SELECT min(week) FROM present)::TIMESTAMP,
                                     (SELECT max(week) FROM present)::TIMESTAMP, INTERVAL 7 DAY)) AS DATE) AS week
)
SELECT strftime(week, '%Y-%m-%d') AS week_start FROM every WHERE week NOT IN (SELECT week FROM present)""",
    "recent_weeks": with_(*TO_ENRICHED, RECENT)
    + f"SELECT {TRIP_COLUMNS}, PU_Borough, DO_Borough FROM recent",
    "recent_weeks_aligned": with_(*TO_ENRICHED)
    + """
SELECT strftime(date_trunc('week', pickup_ts), '%Y-%m-%d') AS week_start, PU_Borough AS borough,
       count(*) AS total_trips, round(sum(total_amount), 4) AS total_revenue
FROM enriched
WHERE pickup_ts >= (SELECT date_trunc('week', max(pickup_ts)) - INTERVAL 7 DAY FROM enriched)
GROUP BY ALL""",
    "trip_time_bounds": with_(TRIPS)
    + f"SELECT {TIME.format('min(pickup_ts)')} AS min_ts, {TIME.format('max(pickup_ts)')} AS max_ts FROM trips",
    "year_week_key": with_(TRIPS)
    + "SELECT DISTINCT year(pickup_ts) || '-' || lpad(CAST(weekofyear(pickup_ts) AS VARCHAR), 2, '0') "
    "AS year_week FROM trips",
    # enrichment
    "enrich_pickup": with_(*TO_CLEAN, ZONES)
    + f"""
SELECT {TRIP_COLUMNS}, Borough AS PU_Borough, Zone AS PU_Zone, service_zone AS PU_service_zone
FROM clean JOIN zones ON PULocationID = LocationID""",
    "enrich_zones": with_(*TO_ENRICHED) + f"SELECT {TRIP_COLUMNS}, {PU_ZONE}, {DO_ZONE} FROM enriched",
    "unmatched_locations": with_(*TO_CLEAN, ZONES)
    + """
SELECT 'pickup' AS trip_end, PULocationID AS location_id, count(*) AS n_trips FROM clean
WHERE PULocationID IS NULL OR PULocationID NOT IN (SELECT LocationID FROM zones) GROUP BY ALL
UNION ALL
SELECT 'dropoff', DOLocationID, count(*) FROM clean
WHERE DOLocationID IS NULL OR DOLocationID NOT IN (SELECT LocationID FROM zones) GROUP BY ALL""",
    # KPIs
    "weekly_borough_kpis": with_(*TO_KPIS)
    + f"SELECT {KPI_COLUMNS}, {rounded('avg_minutes_per_mile_exact')} FROM kpis",
    "trips_by_hour": with_(*TO_ENRICHED, ratios("enriched"))
    + "SELECT week_start, borough, hour, n AS n_trips FROM hours",
    "trips_by_week": with_(*TO_ENRICHED, ratios("enriched"))
    + "SELECT week_start, borough, count(*) AS total_trips, round(sum(total_amount), 4) AS total_revenue "
    "FROM ratios GROUP BY week_start, borough",
    "peak_hour": with_(*TO_ENRICHED, ratios("enriched"))
    + """
SELECT week_start, borough, CAST(sum(n) AS BIGINT) AS total_trips, any_value(peak_hour) AS peak_hour,
       any_value(peak_trips) AS peak_trips,
       round(any_value(peak_trips) / sum(n)::DOUBLE * 100, 4) AS peak_hour_trip_percentage
FROM hours JOIN peaks USING (week_start, borough) GROUP BY week_start, borough""",
    "night_share": with_(*TO_ENRICHED, ratios("enriched"))
    + """
SELECT week_start, borough, count(*) AS total_trips, count(*) FILTER (WHERE hour < 6) AS night_trips,
       round(count(*) FILTER (WHERE hour < 6) / count(*)::DOUBLE * 100, 4) AS night_trip_percentage
FROM ratios GROUP BY week_start, borough""",
    "trip_minutes_per_mile": with_(*TO_CLEAN)
    + """
SELECT trip_id, round((floor(epoch(dropoff_ts)) - floor(epoch(pickup_ts))) / 60.0::DOUBLE / trip_distance, 8)
  AS minutes_per_mile FROM clean""",
    "trip_revenue_per_mile": with_(*TO_CLEAN)
    + "SELECT trip_id, round(total_amount / trip_distance, 8) AS revenue_per_mile FROM clean",
    "stage_counts": with_(*TO_KPIS)
    + union(
        [
            f"SELECT '{stage}' AS stage, count(*) AS n_rows FROM {source}"
            for stage, source in (
                ("raw", "trips"),
                ("clean", "clean"),
                ("enriched", "enriched"),
                ("recent", "recent"),
                ("kpis", "kpis"),
            )
        ]
    ),
    # marts
    "mart_summary": with_(*TO_KPIS)
    + """,
top AS (SELECT peak_hour FROM kpis GROUP BY peak_hour ORDER BY count(*) DESC, peak_hour LIMIT 1)
SELECT CAST(sum(total_trips) AS BIGINT) AS total_trips, round(sum(total_revenue), 4) AS total_revenue,
       round(avg(avg_revenue_per_mile), 4) AS avg_revenue_per_mile,
       CAST(trunc(avg(avg_minutes_per_mile)) AS BIGINT) AS avg_minutes_per_mile,
       (SELECT peak_hour FROM top) AS peak_hour,
       (SELECT printf('%02d-%02d', peak_hour, (peak_hour + 2) % 24) FROM top) AS peak_hour_range,
       round(avg(peak_hour_trip_percentage), 4) AS peak_hour_pct,
       round(avg(night_trip_percentage), 4) AS night_trip_pct,
       count(DISTINCT week_start) AS weeks,
       round(sum(avg_revenue_per_mile * total_trips) / sum(total_trips)::DOUBLE, 4) AS avg_revenue_per_mile_weighted,
       round(sum(night_trip_percentage * total_trips) / sum(total_trips)::DOUBLE, 4) AS night_trip_pct_weighted
FROM kpis""",
    "mart_latest_week": with_(*TO_KPIS, LATEST) + f"SELECT {KPI_COLUMNS} FROM latest",
    "mart_volume_top": with_(*TO_KPIS, LATEST)
    + "SELECT borough, total_trips FROM latest ORDER BY total_trips DESC, borough LIMIT 10",
    "mart_revenue_share": with_(*TO_KPIS, LATEST)
    + """
SELECT borough, total_trips, round(total_revenue, 4) AS total_revenue,
       round(total_trips / (sum(total_trips) OVER ())::DOUBLE * total_revenue, 4) AS borough_revenue,
       round(total_revenue / sum(total_revenue) OVER () * 100, 4) AS revenue_share
FROM latest ORDER BY borough_revenue DESC, borough LIMIT 10""",
    "mart_top_rev_per_mile": with_(*TO_KPIS, LATEST)
    + f"""
SELECT borough, total_trips, {rounded("avg_revenue_per_mile")} FROM latest
WHERE total_trips > (SELECT floor(avg(total_trips)) FROM latest) ORDER BY latest.avg_revenue_per_mile DESC, borough LIMIT 10""",
    "mart_most_efficient": with_(*TO_KPIS, LATEST)
    + """
SELECT borough, total_trips, avg_minutes_per_mile FROM latest
WHERE total_trips > (SELECT floor(avg(total_trips)) FROM latest) ORDER BY avg_minutes_per_mile, borough LIMIT 10""",
    "mart_efficiency_scatter": with_(*TO_KPIS, LATEST)
    + f"""
SELECT borough, total_trips, avg_minutes_per_mile, {rounded("avg_revenue_per_mile")} FROM latest
WHERE total_trips > (SELECT floor(avg(total_trips)) FROM latest)""",
    "mart_time_vs_revenue": with_(*TO_KPIS, LATEST)
    + f"""
SELECT borough, total_trips, avg_minutes_per_mile, {rounded("avg_revenue_per_mile")} FROM latest
WHERE total_trips > (SELECT floor(avg(total_trips)) FROM latest) ORDER BY total_trips DESC, borough LIMIT 10""",
    "mart_weekly_volume": with_(*TO_KPIS)
    + "SELECT week_start, borough, total_trips FROM kpis ORDER BY week_start, total_trips DESC, borough",
    "mart_weekly_top": with_(*TO_KPIS)
    + """,
busy AS (SELECT borough FROM kpis GROUP BY borough ORDER BY sum(total_trips) DESC, borough LIMIT 3)
SELECT week_start, borough, total_trips FROM kpis WHERE borough IN (SELECT borough FROM busy)""",
    "mart_heatmap": with_(*TO_KPIS)
    + """,
busy AS (SELECT borough FROM kpis GROUP BY borough ORDER BY sum(total_trips) DESC, borough LIMIT 15)
SELECT week_start, borough, total_trips,
       round(total_trips / (sum(total_trips) OVER (PARTITION BY borough))::DOUBLE * 100, 4) AS share_of_borough
FROM kpis WHERE borough IN (SELECT borough FROM busy)""",
    "mart_heatmap_grid": with_(*TO_KPIS)
    + "SELECT week_start, "
    + ", ".join(
        f"CAST(sum(total_trips) FILTER (WHERE borough = '{b}') AS BIGINT) AS \"{b}\"" for b in REGIONS
    )
    + " FROM kpis GROUP BY week_start",
    "mart_weekly_trend": with_(*TO_KPIS)
    + """
SELECT week_start, CAST(sum(total_trips) AS BIGINT) AS total_trips, round(sum(total_revenue), 4) AS total_revenue
FROM kpis GROUP BY week_start ORDER BY week_start""",
    "mart_describe": with_(*TO_KPIS)
    + union(
        [
            f"SELECT '{m}' AS metric, count({m}) AS n, round(avg({m}), 3) AS mean, "
            f"round(stddev_samp({m}), 3) AS std, round(min({m})::DOUBLE, 3) AS min, "
            + ", ".join(
                f"round(quantile_cont({m}::DOUBLE, {q / 100}), 3) AS q{q}" for q in (25, 50, 75)
            )
            + f", round(max({m})::DOUBLE, 3) AS max FROM kpis"
            for m in METRICS
        ]
    ),
    "mart_listing": with_(*TO_KPIS)
    + f"SELECT {KPI_COLUMNS} FROM kpis ORDER BY week_start DESC, kpis.total_trips DESC, borough",
    # text
    "word_count": f'SELECT word, count(*) AS "count" FROM ({WORDS}) GROUP BY word',
    "word_count_lines": r"""
WITH lines AS (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line,
                      len(regexp_split_to_array(text, '\r\n|\r|\n')) AS n,
                      generate_subscripts(regexp_split_to_array(text, '\r\n|\r|\n'), 1) AS i
               FROM documents),
kept AS (SELECT line FROM lines WHERE NOT (i = n AND n > 1 AND line = '')),
tokens AS (
  SELECT lower(unnest(regexp_extract_all(line, '[A-Za-z0-9_]+'))) AS word FROM kept
  UNION ALL
  SELECT '' FROM kept WHERE line = '' OR regexp_matches(line, '^[^A-Za-z0-9_]+[A-Za-z0-9_]')
)
SELECT word, count(*) AS "count" FROM tokens GROUP BY word""",
    "word_count_text": f"SELECT '(' || word || ',' || count(*) || ')' AS value FROM ({WORDS}) GROUP BY word",
    "char_counts": """
SELECT "char", count(*) AS "count" FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS "char" FROM documents)
GROUP BY "char\"""",
    "top_chars": """
SELECT "char", count(*) AS "count" FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS "char" FROM documents)
GROUP BY "char" ORDER BY count(*) DESC, "char" LIMIT 10""",
    "text_stats": r"""
SELECT source, count(*) AS n_texts, CAST(sum(length(text)) AS BIGINT) AS n_chars,
       CAST(sum(len(regexp_extract_all(text, '\r\n|\r|\n')) +
                CASE WHEN text <> '' AND right(text, 1) NOT IN (chr(10), chr(13)) THEN 1 ELSE 0 END) AS BIGINT) AS n_lines
FROM documents GROUP BY source""",
    "top_words": f'SELECT word, count(*) AS "count" FROM ({WORDS}) GROUP BY word ORDER BY count(*) DESC, word LIMIT 20',
    "rare_top_customers": """
SELECT o_custkey, count(*) AS "count" FROM orders WHERE o_custkey IS NOT NULL
GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 10""",
    "text_stats_by_file": r"""
SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS BIGINT) AS n_chars,
       CAST(sum(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1) AS BIGINT) AS n_lines
FROM documents GROUP BY source""",
    # retail
    "retail_high_value": with_(RETAIL)
    + "SELECT customerId, transactionDate, transactionAmount FROM retail WHERE transactionAmount > 400000",
    "retail_high_value_total": "SELECT round(sum(o_totalprice), 2) AS total FROM orders WHERE o_totalprice > 200000",
    "retail_avg": "SELECT round(avg(o_totalprice), 4) AS avg_amount FROM orders",
    "retail_avg_by_month": """
SELECT strftime(o_orderdate, '%b') AS month, strftime(o_orderdate, '%y') AS year,
       round(avg(o_totalprice), 4) AS avg_amount FROM orders GROUP BY ALL""",
    # tables
    "describe_lines": union(
        [
            f"SELECT '{m}' AS metric, count({m}) AS n, round(avg({m}), 3) AS mean, "
            f"round(stddev_samp({m}), 3) AS std, round(min({m})::DOUBLE, 3) AS min, "
            + ", ".join(f"round(quantile_cont({m}::DOUBLE, {q / 100}), 3) AS q{q}" for q in (25, 50, 75))
            + f", round(max({m})::DOUBLE, 3) AS max FROM lineitem"
            for m in LINE_NUMBERS
        ]
    ),
    "column_quantiles": union(
        [
            f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS probability, "
            f"round(quantile_cont({value}, {p}), 3) AS quantile FROM orders"
            for c, value in ORDER_VALUES.items()
            for p in (0.0, 0.001, 0.5, 0.99, 1.0)
        ]
    ),
    "names_by_key": "SELECT c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING'",
    "names_by_flag": "SELECT s_name AS name FROM supplier WHERE s_acctbal > 0",
    "totals_by_key": "SELECT c_nationkey, count(*) AS total FROM customer GROUP BY c_nationkey",
    "median_by_group": """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
       round(max(l_extendedprice), 4) AS maximum FROM lineitem GROUP BY l_returnflag""",
    "avg_by_key": "SELECT l_suppkey, round(avg(l_quantity), 4) AS average FROM lineitem GROUP BY l_suppkey",
    "avg_by_two_keys": """
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 4) AS average FROM lineitem GROUP BY ALL""",
    "regex_validity": r"""
WITH tokens AS (SELECT lang, unnest(regexp_split_to_array(text, '[ \t\r\n]+')) AS token FROM documents)
SELECT lang,
       count(*) FILTER (WHERE regexp_matches(token, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')) AS n_valid,
       count(*) FILTER (WHERE NOT regexp_matches(token, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')) AS n_invalid,
       CAST(0 AS BIGINT) AS n_missing
FROM tokens WHERE contains(token, '@') GROUP BY lang""",
    "avg_first_n": """
SELECT round(avg(c_acctbal), 4) AS average
FROM (SELECT c_acctbal FROM customer WHERE c_acctbal > 0 ORDER BY c_custkey LIMIT 100)""",
    "first_five": """
SELECT l_extendedprice, l_orderkey, l_linenumber, l_partkey FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 5""",
    "sorted_by_amount": """
SELECT o_orderkey, o_custkey, o_totalprice,
       row_number() OVER (ORDER BY o_totalprice, o_custkey, o_orderkey) AS position FROM orders""",
    "sorted_by_name": """
SELECT c_name, c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS position FROM customer""",
    "monoid_sum": """
SELECT CAST(sum(l_linenumber) AS BIGINT) AS line_numbers, round(sum(l_extendedprice), 2) AS prices,
       bool_or(l_quantity > 49) AS any_large, bool_or(l_quantity > 1000) AS any_huge FROM lineitem""",
    "avg_score_for_ids": """
SELECT round(avg(c_acctbal), 4) AS average, count(c_acctbal) AS n_scores,
       count(*) FILTER (WHERE c_acctbal >= 5000) AS n_passed
FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "median_with_missing": """
SELECT o_orderpriority, round(quantile_cont(price, 0.5), 4) AS median, round(max(price), 4) AS maximum
FROM (SELECT o_orderpriority,
             CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders)
GROUP BY o_orderpriority""",
    "gate_null_rates_high": with_(TRIPS, SPARSE) + NULL_RATES.replace("FROM trips", "FROM sparse"),
    "filter_times_present": with_(TRIPS, SPARSE)
    + f"SELECT trip_id FROM sparse WHERE {' AND '.join(f'({r})' for r in RULES.values())}",
    "weekly_kpis_reference": with_(*TO_KPIS) + f"SELECT {KPI_COLUMNS} FROM kpis",
    "weekly_volume_csv": with_(*TO_KPIS) + "SELECT week_start, borough, total_trips FROM kpis",
    "kpi_incremental": with_(*TO_WHOLE_WEEKS) + f"SELECT {KPI_COLUMNS} FROM kpis",
    "kpi_stream": with_(*TO_WHOLE_WEEKS) + f"SELECT {KPI_COLUMNS} FROM kpis",
    "stream_late_trips": with_(*TO_ENRICHED)
    + """
SELECT strftime(date_trunc('week', pickup_ts), '%Y-%m-%d') AS week_start, PU_Borough AS borough, count(*) AS n_late
FROM enriched
WHERE payment_type IS NULL
  AND pickup_ts < (SELECT max(pickup_ts) FROM enriched WHERE payment_type IS NOT NULL) - INTERVAL 2 DAY
GROUP BY ALL""",
    "status_events_once": with_(*TO_KPIS)
    + f"SELECT week_start || '|' || borough AS key, {KPI_COLUMNS} FROM kpis",
    "trips_of_mixed_files": with_(TRIPS, MIXED)
    + """
SELECT kind, count(*) AS n_rows, count_if(half OR word) AS n_rescued,
       count(passenger_count) FILTER (NOT half) AS n_passengers,
       CAST(sum(passenger_count) FILTER (NOT half) AS BIGINT) AS passengers,
       round(sum(fare_amount) FILTER (NOT word), 2) AS fares, count_if(kind <> 'lean') AS n_surcharges
FROM mixed GROUP BY kind""",
    "rescued_values": with_(TRIPS, MIXED)
    + """
SELECT kind, 'passenger_count' AS column_name, count(*) AS n_rescued FROM mixed WHERE half GROUP BY kind
UNION ALL
SELECT kind, 'fare_amount', count(*) FROM mixed WHERE word GROUP BY kind""",
    "gate_repeated_ids": union(
        [
            f"SELECT '{source}' AS source, '{keys.replace(' ', '')}' AS key_columns, "
            f"EXISTS (SELECT 1 FROM {table} GROUP BY {columns} HAVING count(*) > 1) AS repeated"
            for source, table, keys, columns in (
                ("trips", "events", "trip_id", "event_id"),
                ("orders", "orders", "o_orderkey", "o_orderkey"),
                ("lines", "lineitem", "l_orderkey", "l_orderkey"),
                ("pairs", "lineitem", "l_orderkey, l_linenumber", "l_orderkey, l_linenumber"),
            )
        ]
    ),
}
