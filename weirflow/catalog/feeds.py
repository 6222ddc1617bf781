"""Dirty feeds derived from whole driver tables.

They carry what the loads have to cope with: exact copies, missing fields, a
missing key, wrong signs, three date formats, unparsable dates and times,
unknown customers and dirty codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_LOAD = "2026-01-27"
SECOND_LOAD = "2026-01-28"
# Loads of customers, among the dates of the orders.
VERSION_LOADS = ("1994-01-01", "1996-06-01", "1997-01-01")
# A key for the test tables only; real ones come at run time.
PSEUDONYM_KEY = bytes(range(40))

# Runs unchanged in Spark and in the oracle; {orders} is the table.
ORDERS_FEED_SQL = """
SELECT concat('O', CAST(o_orderkey AS STRING)) AS order_id,
  CASE WHEN o_orderkey % 17 = 4 THEN NULL
       WHEN o_orderkey % 10 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS customer_id,
  CASE WHEN o_orderkey % 5 = 1 THEN -o_totalprice ELSE o_totalprice END AS amount,
  CASE WHEN o_orderkey % 2 = 0 THEN 'BRL' ELSE 'USD' END AS currency,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'Cancelled' ELSE 'PENDING' END AS status,
  CASE o_orderkey % 4 WHEN 0 THEN d
       WHEN 1 THEN concat(substr(d,9,2),'-',substr(d,6,2),'-',substr(d,1,4))
       WHEN 2 THEN concat(substr(d,9,2),'/',substr(d,6,2),'/',substr(d,1,4))
       ELSE 'bogus' END AS order_date
FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders}) t
"""

EVENTS_FEED_SQL = """
SELECT concat('E', CAST(event_id AS STRING)) AS event_id, user_id AS customer_id,
  CASE WHEN event_id % 3 = 0 THEN concat(event_type, '_1') ELSE event_type END AS event_type,
  CASE WHEN event_id % 19 = 7 THEN 'invalid_timestamp'
       ELSE concat(substr(t,1,10),'T',substr(t,12,8),'Z') END AS event_timestamp
FROM (SELECT *, CAST(ts AS STRING) AS t FROM {events}) x
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with exact copies (one scan: a row is exploded into its copies)."""
    key = F.col("c_custkey")
    original, copy, keyless = F.lit(1), F.when(key % 7 == 3, 2), F.when(key == 1, 3)
    copies = F.array_compact(F.array(original, copy, keyless))
    return (
        table(spark, sf_dir, "customer")
        .withColumn("copy", F.explode(copies))
        .select(
            F.when(F.col("copy") != 3, key).alias("customer_id"),
            F.when(key % 11 != 5, F.col("c_name")).alias("name"),
            F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
            F.when(key % 13 != 6, F.col("c_mktsegment")).alias("country"),
            F.date_add(F.lit("2022-01-01").cast("date"), (key % 365).cast("int")).alias("created_at"),
        )
    )


def changed_customers_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of the second load: even customers have a newer version."""
    newer = F.when(F.col("customer_id") % 2 == 0, F.date_add("created_at", 1))
    feed = customers_feed(spark, sf_dir)
    return feed.withColumn("created_at", F.coalesce(newer, F.col("created_at")))


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ORDERS_FEED_SQL, orders=table(spark, sf_dir, "orders"))


def changed_orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load: every third order comes again, a week later and settled."""
    keys = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0")
    later = keys.withColumn("o_orderdate", F.expr("o_orderdate + INTERVAL 7 DAYS"))
    settled = later.withColumn("o_orderstatus", F.lit("F"))
    return spark.sql(ORDERS_FEED_SQL, orders=settled)


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EVENTS_FEED_SQL, events=table(spark, sf_dir, "events"))


TRIPS_YEAR = 2001


def trips_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the trips of one year: order date to ship date, about half
    of them negative. ``drop`` is the month of the file a trip arrives in, which
    for some trips is the month after the pickup."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    to_year = F.make_ym_interval(F.lit(TRIPS_YEAR) - F.year("o_orderdate"))
    trips = joined.select(
        "l_orderkey",
        F.col("l_linenumber").alias("VendorID"),
        (F.col("o_orderdate") + to_year).alias("tpep_pickup_datetime"),
        (F.col("l_shipdate") + to_year).alias("tpep_dropoff_datetime"),
        F.col("l_suppkey").alias("PULocationID"),
        (F.col("l_quantity") - 5).alias("trip_distance"),
        F.col("l_extendedprice").alias("total_amount"),
    )
    late = F.when(F.col("l_orderkey") % 50 == 0, 1).otherwise(0)
    arrival = F.add_months("tpep_pickup_datetime", late)
    return trips.withColumn("drop", F.date_format(arrival, "yyyy-MM"))
