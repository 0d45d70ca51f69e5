"""The driver's tables in the shapes the library works on.

Trips are made from every row of ``events``; zones from all of ``nation`` and
``region``; retail transactions from all of ``orders``. The columns are derived from
values of the same row, chosen so that each row rule rejects something, but for the rule that
times are present: ``events`` has all of them, and ``sparse_trips`` takes some away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from farelight.operators.enrich import enrich_zones
from farelight.operators.filters import keep_valid
from farelight.plans.kpis import calculate_kpis
from farelight.session import scratch_path
from farelight.sources.readers import read_kpis
from farelight.sources.writers import write_kpis

# Table layouts. With them no file is opened to find a schema, and the
# scan reads the zone-less times as timestamps.
LAYOUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


# Hundredths of the second, 0 to 99.
_K = "floor((unix_micros(ts) - unix_micros(date_trunc('second', ts))) / 10000)"

TRIP_COLUMNS = f"""
user_id AS VendorID
ts AS tpep_pickup_datetime
ts + make_dt_interval(0, 0, minute(ts) - 1) AS tpep_dropoff_datetime
CASE WHEN value >= 1 THEN floor(value / 25) END AS passenger_count
{_K} / 10.0D AS trip_distance
1L AS RatecodeID
if(event_type = 'error', 'Y', 'N') AS store_and_fwd_flag
floor(second(ts) * 0.45D) AS PULocationID
floor({_K} * 0.27D) AS DOLocationID
CASE event_type WHEN 'view' THEN 1L WHEN 'click' THEN 2L WHEN 'signup' THEN 6L WHEN 'error' THEN 7L END AS payment_type
value - 2 AS fare_amount
0.5D AS extra
0.5D AS mta_tax
CASE WHEN event_type <> 'click' THEN value / 10 - 0.3D END AS tip_amount
0.0D AS tolls_amount
0.3D AS improvement_surcharge
value - 1 AS total_amount
0.0D AS congestion_surcharge
CAST(NULL AS double) AS airport_fee
event_id AS trip_id
"""


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*TRIP_COLUMNS.strip().splitlines())


def sparse_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose passengers, and now and then pickup time, are unknown if the payment is."""
    paid = F.col("payment_type").isNotNull()
    return trips(spark, sf_dir).withColumns(
        {
            "passenger_count": F.when(paid, F.col("passenger_count")),
            "tpep_pickup_datetime": F.when(paid | (F.col("total_amount") < 40), F.col("tpep_pickup_datetime")),
        }
    )


def mixed_trip_files(spark: SparkSession, sf_dir: str) -> str:
    """All trips in files of three layouts below one path, by kind of payment.

    ``plain`` is the trip layout; ``lean`` has narrower passengers and lacks two columns;
    ``loose`` has half passengers on short trips, and amounts as text, one of them a word.
    """
    rows = trips(spark, sf_dir)
    path = saved(rows, "mixed")
    plain, lean = F.col("payment_type").eqNullSafe(1), F.col("payment_type").eqNullSafe(2)
    rows.filter(plain).write.parquet(f"{path}/plain")
    narrow = rows.filter(lean).withColumn("passenger_count", F.col("passenger_count").cast("int"))
    narrow.drop("congestion_surcharge", "airport_fee").write.parquet(f"{path}/lean")
    half = F.col("passenger_count") + F.when(F.col("trip_distance") < 3, 0.5).otherwise(0.0)
    fare = F.when(F.col("fare_amount") < 0, "unknown").otherwise(F.col("fare_amount").cast("string"))
    loose = rows.filter(~plain & ~lean).withColumns({"passenger_count": half, "fare_amount": fare})
    loose.write.parquet(f"{path}/loose")
    return path


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("long").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.col("r_name"), F.lit(" zone")).alias("service_zone"),
    )


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row rules only; the gates have queries of their own."""
    return keep_valid(trips(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_zones(clean_trips(spark, sf_dir), zones(spark, sf_dir))


def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calculate_kpis(clean_trips(spark, sf_dir), zones(spark, sf_dir))


def saved_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI table as the marts meet it: computed once, saved and read back."""
    rows = kpis(spark, sf_dir)
    return read_kpis(spark, write_kpis(rows, saved(rows, "marts")))


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(
        F.concat(F.lit("CS"), F.col("o_custkey")).alias("customerId"),
        F.date_format("o_orderdate", "dd-MMM-yy").alias("transactionDate"),
        F.col("o_totalprice").alias("transactionAmount"),
    )


def retail_dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail text lines: amounts of pending orders end in ``x``, low-priority lines lack commas."""
    amount = F.concat(
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.when(F.col("o_orderstatus") == "P", "x").otherwise(""),
    )
    gap = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(",")
    customer = F.concat(F.lit("CS"), F.col("o_custkey"))
    date = F.date_format("o_orderdate", "dd-MMM-yy")
    return orders(spark, sf_dir).select(F.concat(customer, gap, date, gap, amount).alias("value"))


def saved(df: DataFrame, name: str) -> str:
    """A new scratch path for a query whose feature is writing or reading files."""
    return scratch_path(df.sparkSession, name)
