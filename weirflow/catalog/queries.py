"""``name -> callable(spark, sf_dir)`` over the whole driver tables.

Queries that write use a fresh folder below the cluster's shared folder.
Clock columns never appear in a result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow import schemas
from weirflow.catalog import feeds
from weirflow.catalog.feeds import FIRST_LOAD, SECOND_LOAD, table
from weirflow.functions import (
    duration_hms,
    duration_secs,
    letters_upper,
    month_number,
    month_text,
    parse_date_any,
    surrogate_key,
    year_number,
)
from weirflow.operators import (
    enrich,
    latest_by_key,
    quarantine_incomplete,
    rank_groups,
    stamp_date,
    stamp_reject,
)
from weirflow.operators.rules import Rule
from weirflow.plans import customers, events, lookups, orders, trips
from weirflow.session import scratch_path
from weirflow.sinks import (
    preview_rows,
    write_partitions,
    write_rejects,
    write_snapshot,
    write_table,
)
from weirflow.sources import (
    month_spine,
    read_csv,
    read_dataset,
    read_json_array,
    read_months,
    static_dim,
)
from weirflow.streaming import (
    Audit,
    await_all,
    dedup_stream,
    dedup_stream_by_id,
    stream_parquet,
    stream_to_parquet,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _both_loads(df: DataFrame) -> DataFrame:
    """The same rows loaded on two dates, as a reprocessed drop is."""
    dates = F.array(*[F.lit(d).cast("date") for d in (FIRST_LOAD, SECOND_LOAD)])
    return df.select("*", F.explode(dates).alias("processing_date"))


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension as a written table, as fact jobs read it: its
    size is known when the join is planned."""
    path = scratch_path(spark, "dim")
    clean = customers.split_customers(feeds.customers_feed(spark, sf_dir)).clean
    write_table(customers.latest_customers(stamp_date(clean, FIRST_LOAD)), path)
    return read_dataset(spark, path)


# --- ranking and star joins -------------------------------------------------


@query
def fact_orders_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = orders.split_orders(feeds.orders_feed(spark, sf_dir)).clean
    loaded = _both_loads(orders.clean_orders(complete))
    return orders.fact_orders(loaded, _dim(spark, sf_dir))


@query
def fact_events_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = events.clean_events(feeds.events_feed(spark, sf_dir))
    loaded = _both_loads(events.valid_events(cleaned).drop("processing_timestamp", "processing_date"))
    return events.fact_events(loaded, _dim(spark, sf_dir))


@query
def dim_latest_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = customers.split_customers(feeds.customers_feed(spark, sf_dir)).clean
    second = customers.split_customers(feeds.changed_customers_feed(spark, sf_dir)).clean
    loads = stamp_date(first, FIRST_LOAD).unionByName(stamp_date(second, SECOND_LOAD))
    return customers.latest_customers(loads)


@query
def dedup_lineitem_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return latest_by_key(lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# --- quarantine -------------------------------------------------------------


@query
def customers_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.split_customers(feeds.customers_feed(spark, sf_dir)).clean


@query
def customers_clean_nullkey_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feeds.customers_feed(spark, sf_dir)
    return customers.split_customers(feed, keep_null_keys=True).clean


@query
def customers_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = customers.split_customers(feeds.customers_feed(spark, sf_dir))
    return stamp_reject(split.duplicates, schemas.REASON_DUPLICATE).drop("error_timestamp")


@query
def customers_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = customers.split_customers(feeds.customers_feed(spark, sf_dir))
    return stamp_reject(split.invalid, schemas.REASON_MISSING).drop("error_timestamp")


@query
def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.clean_orders(orders.split_orders(feeds.orders_feed(spark, sf_dir)).clean)


@query
def orders_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = orders.split_orders(feeds.orders_feed(spark, sf_dir))
    return stamp_reject(split.invalid, schemas.REASON_NULLS).drop("error_timestamp")


# --- heavy keys: a threshold low enough for the small tables -----------------


@query
def rank_heavy_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A handful of event types hold all rows: every rank comes from the sort."""
    source = table(spark, sf_dir, "events").select("event_type", "ts", "event_id")
    return rank_groups(source, ["event_type"], ["ts"], "newest", heavy_rows=100)


@query
def orders_of_untainted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order without a priority taints all orders of its customer."""
    source = table(spark, sf_dir, "orders")
    priority = F.when(F.col("o_orderkey") % 97 != 3, F.col("o_orderpriority"))
    dirty = source.withColumn("o_orderpriority", priority)
    return quarantine_incomplete(dirty, "o_custkey").clean


# --- scalar cleaning and derivation -----------------------------------------


@query
def normalise_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feeds.events_feed(spark, sf_dir)
    return feed.select("event_id", letters_upper("event_type").alias("event_type"))


@query
def events_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = events.clean_events(feeds.events_feed(spark, sf_dir))
    return events.valid_events(cleaned).drop("processing_timestamp", "processing_date")


@query
def events_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = events.clean_events(feeds.events_feed(spark, sf_dir))
    return events.rejected_events(cleaned).drop(
        "event_timestamp", "processing_timestamp", "processing_date", "raw_line"
    )


@query
def bronze_partition_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        year_number("o_orderdate").alias("year"),
        month_number("o_orderdate").alias("month"),
        month_text("o_orderdate").alias("month_text"),
    )


@query
def silver_trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = duration_secs("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return feeds.trips_feed(spark, sf_dir).select(
        "l_orderkey", "VendorID", seconds.alias("secs"), duration_hms(seconds).alias("hms")
    )


@query
def silver_trip_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", surrogate_key("user_id", "ts", "event_type").alias("trip_id")
    )


@query
def silver_positive_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = trips.positive_trips(feeds.trips_feed(spark, sf_dir))
    return kept.select("l_orderkey", "VendorID", "total_amount", "trip_distance")


@query
def customers_positive_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)


def _coded_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        (F.col("l_linenumber") % 2 + 1).cast("long").alias("vendor_id"),
        F.col("l_linenumber").cast("long").alias("rate_code_id"),
    )


@query
def trips_with_static_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    vendors = static_dim(spark, schemas.VENDORS, schemas.VENDOR)
    rate_codes = static_dim(spark, schemas.RATE_CODES, schemas.RATE_CODE)
    named = enrich(_coded_lineitem(spark, sf_dir), vendors, "vendor_id", ["vendor_name"])
    return enrich(named, rate_codes, "rate_code_id", ["rate_code_desc"])


# --- files ------------------------------------------------------------------


@query
def month_spine_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as monthly drops; a range of months is read back by path."""
    landing = scratch_path(spark, "month-drops")
    source = table(spark, sf_dir, "orders")
    drops = source.withColumn("drop", F.date_format("o_orderdate", "yyyy-MM"))
    write_snapshot(drops, landing, ["drop"])
    months = month_spine("1996-10-31", "1998-02-28")
    return read_months(spark, landing + "/drop={month}", months)


@query
def trips_out_of_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly drops, and the trips that arrived in the wrong one."""
    landing = scratch_path(spark, "trip-drops")
    write_snapshot(feeds.trips_feed(spark, sf_dir), landing, ["drop"])
    months = month_spine("2001-01-31", "2002-01-01")
    return trips.split_months(read_months(spark, landing + "/drop={month}", months), months).outside


@query
def zone_dim_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup CSV through bronze into a dimension; ``part`` is the lookup."""
    root = scratch_path(spark, "lookup")
    part = table(spark, sf_dir, "part")
    write_table(part, f"{root}/landing/{lookups.TOPIC}/{lookups.TOPIC}.csv", fmt="csv")
    lookups.load_zones_bronze(spark, root, FIRST_LOAD, schema=part.schema)
    lookups.build_dim_zone(spark, root, SECOND_LOAD)
    return read_dataset(spark, f"{root}/silver/dim_zone")


def _array_document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of a JSON array document, one document per partition."""
    lead = "["
    for batch in batches:
        lines = "," + batch["value"]
        if len(lines) and lead:
            lines.iloc[0] = lead + lines.iloc[0][1:]
            lead = ""
        yield lines.to_frame()
    yield pd.DataFrame({"value": [lead + "]"]})


def _write_array_documents(feed: DataFrame, path: str) -> None:
    lines = feed.select(F.to_json(F.struct(*feed.columns)).alias("value"))
    lines.mapInPandas(_array_document, "value string").write.text(path)


@query
def json_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json-arrays")
    _write_array_documents(feeds.orders_feed(spark, sf_dir), path)
    return read_json_array(spark, path, schemas.ORDERS)


@query
def json_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents, each shared by several tasks."""
    path = scratch_path(spark, "json-arrays")
    _write_array_documents(feeds.orders_feed(spark, sf_dir), path)
    return read_json_array(spark, path, schemas.ORDERS, split=True)


@query
def dynamic_overwrite_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything from 1998 on is loaded again, with changed amounts."""
    path = scratch_path(spark, "dynamic")
    dated = table(spark, sf_dir, "orders").withColumns(
        {"year": year_number("o_orderdate"), "month": month_number("o_orderdate")}
    )
    by = ["year", "month"]
    write_partitions(dated, path, by, rebalance=True)
    again = dated.where(F.col("year") >= 1998)
    write_partitions(again.withColumn("o_totalprice", F.lit(0.0)), path, by, rebalance=True)
    return read_dataset(spark, path)


@query
def static_snapshot_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows move to a newer date: the old partition has to go."""
    path = scratch_path(spark, "static")
    source = table(spark, sf_dir, "orders")
    for date in (FIRST_LOAD, SECOND_LOAD):
        write_snapshot(stamp_date(source, date), path, ["processing_date"])
    return read_dataset(spark, path)


@query
def rejects_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rejects")
    split = customers.split_customers(feeds.customers_feed(spark, sf_dir))
    rejects = stamp_reject(split.invalid, schemas.REASON_MISSING)
    dated = stamp_date(rejects, FIRST_LOAD)
    write_rejects(dated, path, dt.date.fromisoformat(FIRST_LOAD))
    return read_csv(spark, path, dated.schema).drop("error_timestamp")


@query
def preview_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_rows(table(spark, sf_dir, "events"), by=["event_id"])


# --- whole jobs over a lake -------------------------------------------------


def _loaded_lake(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "lake")
    drop = f"{root}/input/customers/{FIRST_LOAD}/customers.csv"
    write_table(feeds.customers_feed(spark, sf_dir), drop, fmt="csv")
    customers.load_customers(spark, root, FIRST_LOAD)
    customers.build_dim_customer(spark, root)
    return root


@query
def lake_bad_csv_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some customers have a creation date that is none; their lines are kept."""
    root = scratch_path(spark, "bad-csv")
    feed = feeds.customers_feed(spark, sf_dir)
    bad = F.when(F.col("customer_id") % 29 == 3, F.lit("soon"))
    dirty = feed.withColumn("created_at", F.coalesce(bad, F.col("created_at").cast("string")))
    write_table(dirty, f"{root}/input/customers/{FIRST_LOAD}/customers.csv", fmt="csv")
    customers.load_customers(spark, root, FIRST_LOAD)
    rejects = spark.read.option("header", True).csv(f"{root}/rejected_data/customers/null_fields")
    return rejects.select(F.col("customer_id").cast("long"), "name", "raw_line", "error_reason")


@query
def lake_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV drop and JSON array documents -> loads -> dimension -> order fact."""
    root = _loaded_lake(spark, sf_dir)
    drop = f"{root}/input/orders/{FIRST_LOAD}/orders.json"
    _write_array_documents(feeds.orders_feed(spark, sf_dir), drop)
    orders.load_orders(spark, root, FIRST_LOAD)
    orders.build_fact_orders(spark, root)
    return read_dataset(spark, f"{root}/output/fact_orders")


def _drop_customers(feed: DataFrame, root: str, date: str) -> None:
    write_table(feed, f"{root}/input/customers/{date}/customers.csv", fmt="csv")


def _merged_lake(spark: SparkSession, sf_dir: str) -> str:
    """Two daily loads of customers and orders, each merged when it has come."""
    root = scratch_path(spark, "merged")
    days = [
        (FIRST_LOAD, feeds.customers_feed(spark, sf_dir), feeds.orders_feed(spark, sf_dir)),
        (SECOND_LOAD, feeds.changed_customers_feed(spark, sf_dir), feeds.changed_orders_feed(spark, sf_dir)),
    ]
    for date, customers_drop, orders_drop in days:
        _drop_customers(customers_drop, root, date)
        customers.load_customers(spark, root, date)
        customers.merge_dim_customer(spark, root, date)
        orders_drop.write.json(f"{root}/input/orders/{date}/orders.json")
        orders.load_orders(spark, root, date, json_lines=True)
        orders.merge_fact_orders(spark, root, date)
    return root


@query
def lake_dim_customer_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after two merges: what a rebuild from both loads gives."""
    return customers.read_dim_customer(spark, _merged_lake(spark, sf_dir))


@query
def lake_fact_orders_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact after two merges, with orders and customers that changed."""
    return orders.read_fact_orders(spark, _merged_lake(spark, sf_dir))


@query
def lake_fact_orders_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customers of their time. Of three loads of customers the
    second one changes half of them and the third one none."""
    root = scratch_path(spark, "versions")
    feed, changed = feeds.customers_feed(spark, sf_dir), feeds.changed_customers_feed(spark, sf_dir)
    for date, drop in zip(feeds.VERSION_LOADS, (feed, changed, changed)):
        _drop_customers(drop, root, date)
        customers.load_customers(spark, root, date)
    customers.build_customer_versions(spark, root)
    feeds.orders_feed(spark, sf_dir).write.json(f"{root}/input/orders/{FIRST_LOAD}/orders.json")
    orders.load_orders(spark, root, FIRST_LOAD, json_lines=True)
    orders.build_fact_orders_as_of(spark, root)
    return read_dataset(spark, f"{root}/output/fact_orders_as_of")


@query
def lake_masked_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The masked order fact joined with the masked dimension by mail address."""
    root = _loaded_lake(spark, sf_dir)
    feeds.orders_feed(spark, sf_dir).write.json(f"{root}/input/orders/{FIRST_LOAD}/orders.json")
    orders.load_orders(spark, root, FIRST_LOAD, json_lines=True)
    orders.build_fact_orders(spark, root)
    customers.mask_reports(spark, root, feeds.PSEUDONYM_KEY)
    facts = read_dataset(spark, f"{root}/masked/fact_orders").select("order_id", "email", "name")
    dim = read_dataset(spark, f"{root}/masked/dim_customer").withColumnRenamed("customer_id", "found_by_email")
    return enrich(facts, dim, "email", ["found_by_email"])


def _reported_lake(spark: SparkSession, sf_dir: str) -> str:
    """Two loads of orders with their partials; the second one comes twice."""
    root = scratch_path(spark, "reported")
    first, second = feeds.orders_feed(spark, sf_dir), feeds.changed_orders_feed(spark, sf_dir)
    for date, drop in ((FIRST_LOAD, first), (SECOND_LOAD, second)):
        drop.write.json(f"{root}/input/orders/{date}/orders.json")
    for date in (FIRST_LOAD, SECOND_LOAD, SECOND_LOAD):
        orders.load_orders(spark, root, date, json_lines=True)
        orders.add_report_partials(spark, root, date)
    return root


def _in_cents(report: DataFrame) -> DataFrame:
    return report.withColumn("amount", (F.col("amount") * 100).cast("long"))


@query
def report_orders_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order amounts, in cents, with subtotals from the finest level to the total."""
    return _in_cents(orders.report_orders(spark, _reported_lake(spark, sf_dir)))


@query
def report_orders_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtotals that are no rollup: by status and year, by currency, by year."""
    sets = [["status", "order_year"], ["currency"], ["order_year"]]
    return _in_cents(orders.report_orders(spark, _reported_lake(spark, sf_dir), sets))


@query
def order_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many orders of a load break which rule, as its one pass has counted."""
    root = scratch_path(spark, "rules")
    feeds.orders_feed(spark, sf_dir).write.json(f"{root}/input/orders/{FIRST_LOAD}/orders.json")
    rules = [
        Rule("no_customer", F.col("customer_id").isNull(), most=0.5),
        Rule("negative_amount", "amount < 0"),
        Rule("unknown_status", "lower(status) NOT IN ('completed', 'cancelled')"),
        Rule("no_date", parse_date_any("order_date").isNull()),
    ]
    counts = orders.load_orders(spark, root, FIRST_LOAD, json_lines=True, rules=rules)
    return spark.createDataFrame(list(counts.items()), "rule string, broken long")


@query
def lake_fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV drop and event stream -> dimension -> event fact."""
    root = _loaded_lake(spark, sf_dir)
    feeds.events_feed(spark, sf_dir).write.json(f"{root}/input_streaming/events")
    await_all(*events.stream_events(spark, root, every=None))
    events.build_fact_events(spark, root)
    return read_dataset(spark, f"{root}/output/fact_events").drop("processing_date")


@query
def lake_fact_events_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chained streams: the fact stream tails the output of the load. Which
    event of a key survives is open, so the result is the keys."""
    root = _streamed_events(spark, sf_dir)
    await_all(events.stream_fact_events(spark, root, every=None))
    facts = read_dataset(spark, f"{root}/output/fact_events_streaming")
    return facts.select("customer_id", "event_timestamp")


@query
def lake_first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the data check of the event stream prints."""
    root = _streamed_events(spark, sf_dir)
    return events.first_events(spark, root).drop("processing_timestamp", "processing_date")


@query
def lake_static_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the vendors and rate codes that the job has written."""
    root = scratch_path(spark, "dims")
    lookups.build_static_dims(spark, root)
    coded = _coded_lineitem(spark, sf_dir)
    named = enrich(coded, read_dataset(spark, f"{root}/silver/dim_vendor"), "vendor_id", ["vendor_name"])
    rate_codes = read_dataset(spark, f"{root}/silver/dim_rate_code")
    return enrich(named, rate_codes, "rate_code_id", ["rate_code_desc"])


@query
def lake_fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly drops -> bronze -> silver trips."""
    root = scratch_path(spark, "trips")
    write_snapshot(feeds.trips_feed(spark, sf_dir), f"{root}/landing/trips", ["drop"])
    drop = "landing/trips/drop={month}"
    trips.load_trips_bronze(spark, root, "2001-01-31", "2002-01-01", FIRST_LOAD, drop=drop)
    trips.build_fact_trips(spark, root, SECOND_LOAD)
    return read_dataset(spark, f"{root}/silver/fact_trips")


@query
def lake_trips_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly drops of three generations, each loaded when it has come: keys get
    wider, a fee is added, then it is spelled in another way and gets wider too."""
    root = scratch_path(spark, "generations")
    # Joined once, not by each generation again. Every task writes the drops it has,
    # so that they take no shuffle: a generation reads its own ones alone.
    made = feeds.trips_feed(spark, sf_dir)
    write_partitions(made, f"{root}/feed", ["drop"])
    feed = read_dataset(spark, f"{root}/feed", made.schema)
    fee = F.col("l_orderkey") % 8 * 0.25
    generations = [
        ("2001-01", "2001-04", {"VendorID": F.col("VendorID").cast("int")}),
        ("2001-05", "2001-08", {"VendorID": F.col("VendorID").cast("long"), "airport_fee": fee.cast("float")}),
        ("2001-09", "2002-01", {"VendorID": F.col("VendorID").cast("long"), "Airport_Fee": fee.cast("double")}),
    ]
    for first, last, columns in generations:
        some = feed.where(F.col("drop").between(first, last)).withColumns(columns)
        write_partitions(some, f"{root}/landing/trips", ["drop"])
        trips.load_trips_bronze(
            spark, root, f"{first}-01", f"{last}-01", FIRST_LOAD, drop="landing/trips/drop={month}", evolve=True
        )
    trips.build_fact_trips(spark, root, SECOND_LOAD, evolve=True)
    return read_dataset(spark, f"{root}/silver/fact_trips")


# --- streams ----------------------------------------------------------------


def _streamed_events(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "events")
    feeds.events_feed(spark, sf_dir).write.json(f"{root}/input_streaming/events")
    await_all(*events.stream_events(spark, root, every=None))
    return root


@query
def stream_events_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _streamed_events(spark, sf_dir)
    valid = read_dataset(spark, f"{root}/raw_data/events")
    return valid.drop("processing_timestamp", "processing_date")


@query
def stream_events_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the events comes after their date was compacted, and
    makes it compacted again."""
    root = scratch_path(spark, "compacted")
    feed = feeds.events_feed(spark, sf_dir)
    later = F.crc32("event_id") % 2 == 1
    far = dt.date.today() + dt.timedelta(days=2)
    for half in (feed.where(~later), feed.where(later)):
        half.write.mode("append").json(f"{root}/input_streaming/events")
        await_all(*events.stream_events(spark, root, every=None))
        events.compact_events(spark, root, far)
    return events.read_events(spark, root).drop("processing_timestamp", "processing_date")


@query
def stream_events_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _streamed_events(spark, sf_dir)
    rejected = read_dataset(spark, f"{root}/rejected_data/events")
    return rejected.drop("event_timestamp", "processing_timestamp", "processing_date", "raw_line")


@query
def stream_events_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 23rd event has a broken line behind it, which becomes a reject."""
    root = scratch_path(spark, "malformed")
    feed = feeds.events_feed(spark, sf_dir)
    line = F.to_json(F.struct(*feed.columns))
    broken = F.when(F.substring("event_id", 2, 20).cast("long") % 23 == 5, F.concat(F.lit("no json "), "event_id"))
    lines = feed.select(F.explode(F.array_compact(F.array(line, broken))).alias("value"))
    lines.write.text(f"{root}/input_streaming/events")
    await_all(*events.stream_events(spark, root, every=None))
    rejected = read_dataset(spark, f"{root}/rejected_data/events")
    return rejected.select("event_id", "raw_event_timestamp", "raw_line", "error_reason")


@query
def stream_events_single_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both routes of the stream that reads its source once."""
    root = scratch_path(spark, "routed")
    feeds.events_feed(spark, sf_dir).write.json(f"{root}/input_streaming/events")
    await_all(events.stream_events_once(spark, root, every=None))
    valid = events.read_checked_events(spark, root, valid=True)
    rejected = events.read_checked_events(spark, root, valid=False)
    columns = ["event_id", "customer_id", "event_type"]
    return valid.select(*columns, F.lit(True).alias("is_valid")).unionByName(
        rejected.select(*columns, F.lit(False).alias("is_valid"))
    )


@query
def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads and a restart between them. The second load brings everything
    again: rows older than the watermark are late, the recent ones are known
    to the state, and only the rest is new."""
    root = scratch_path(spark, "dedup")
    source = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
    )
    source = stamp_date(source, FIRST_LOAD)
    for load in (source.where("event_timestamp < '2024-01-15'"), source.unionAll(source)):
        load.write.mode("append").partitionBy("processing_date").parquet(f"{root}/in")
        stream = stream_parquet(spark, f"{root}/in", source.schema)
        deduped = dedup_stream(stream, ["customer_id", "event_timestamp"])
        await_all(stream_to_parquet(deduped, f"{root}/out", f"{root}/checkpoint", every=None))
    return read_dataset(spark, f"{root}/out").drop("processing_date")


@query
def stream_customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of two loads with the customers of their load: the dimension is
    built again between the two batches, and the stream starts anew."""
    root = _loaded_lake(spark, sf_dir)
    feed = feeds.events_feed(spark, sf_dir)
    for early in (True, False):
        load = feed.where((F.col("event_timestamp") < "2024-01-15") == early)
        load.write.mode("append").json(f"{root}/input_streaming/events")
        await_all(*events.stream_events(spark, root, every=None))
        await_all(events.stream_customer_events(spark, root, every=None))
        if early:
            _drop_customers(feeds.changed_customers_feed(spark, sf_dir), root, SECOND_LOAD)
            customers.load_customers(spark, root, SECOND_LOAD)
            customers.build_dim_customer(spark, root)
    return events.read_customer_events(spark, root).drop("processing_date")


@query
def stream_events_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event comes three times, with up to two minutes between the times of
    its copies; the first copy stays."""
    root = scratch_path(spark, "by-id")
    source = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("event_timestamp"))
    copies = source.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(2))))
    later = F.col("event_timestamp") + F.make_dt_interval(mins=F.col("copy"))
    stamp_date(copies.withColumn("event_timestamp", later), FIRST_LOAD).write.partitionBy(
        "processing_date"
    ).parquet(f"{root}/in")
    stream = stream_parquet(spark, f"{root}/in", read_dataset(spark, f"{root}/in").schema)
    deduped = dedup_stream_by_id(stream, ["event_id"])
    await_all(stream_to_parquet(deduped, f"{root}/out", f"{root}/checkpoint", every=None))
    return read_dataset(spark, f"{root}/out").select("event_id")


@query
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every row of two loads: the second one brings all events
    twice, of which the old ones are late and the recent ones known."""
    root = scratch_path(spark, "audit")
    source = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("event_timestamp"))
    source = stamp_date(source, FIRST_LOAD)
    audit = Audit(spark, f"{root}/audit")
    spark.streams.addListener(audit)
    try:
        for load in (source.where("event_timestamp < '2024-01-15'"), source.unionAll(source)):
            load.write.mode("append").partitionBy("processing_date").parquet(f"{root}/in")
            deduped = dedup_stream_by_id(stream_parquet(spark, f"{root}/in", source.schema), ["event_id"])
            stream = stream_to_parquet(deduped, f"{root}/out", f"{root}/checkpoint", every=None)
            await_all(stream)
            audit.wait(stream)
    finally:
        spark.streams.removeListener(audit)
    found = read_dataset(spark, f"{root}/audit").where("rows_in > 0")
    return found.select("rows_in", "kept", "duplicates", "late")
