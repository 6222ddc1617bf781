"""Time every catalogue query, and naive shapes of the main ones, warm.

Prints one JSON line. ``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the
cores, ``BENCH_RUNS`` the timed runs per query (the best one counts).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weirflow.catalog import QUERIES, feeds  # noqa: E402
from weirflow.catalog.feeds import FIRST_LOAD, SECOND_LOAD, table  # noqa: E402
from weirflow.functions import any_null  # noqa: E402
from weirflow.operators import stamp_date  # noqa: E402
from weirflow.plans import customers, events, orders  # noqa: E402
from weirflow.session import get_session, scratch_path  # noqa: E402
from weirflow.sinks import write_partitions, write_table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


# --- baseline: the obvious shape of the same work ----------------------------
# One window per use, a self anti join for the taint, every output recomputed.


def _naive_split(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    newest = Window.partitionBy("customer_id").orderBy(F.desc("created_at"))
    ranked = df.withColumn("duplicate_regs", F.row_number().over(newest))
    invalid = ranked.where(any_null(ranked.columns))
    first = ranked.where("duplicate_regs = 1")
    clean = first.join(invalid, "customer_id", "left_anti").drop("duplicate_regs")
    return clean, ranked.where("duplicate_regs > 1"), invalid


def naive_customers_load(spark, sf_dir):
    path = scratch_path(spark, "naive")
    write_table(feeds.customers_feed(spark, sf_dir), f"{path}/in", fmt="csv")
    drop = spark.read.option("header", True).option("inferSchema", True).csv(f"{path}/in")
    clean, copies, invalid = _naive_split(stamp_date(drop, FIRST_LOAD))
    for name, df, fmt in (("copies", copies, "csv"), ("invalid", invalid, "csv"), ("clean", clean, "parquet")):
        write_partitions(df, f"{path}/{name}", ["processing_date"], fmt=fmt)
    return spark.read.parquet(f"{path}/clean")


def customers_load(spark, sf_dir):
    root = scratch_path(spark, "load")
    drop = f"{root}/input/customers/{FIRST_LOAD}/customers.csv"
    write_table(feeds.customers_feed(spark, sf_dir), drop, fmt="csv")
    customers.load_customers(spark, root, FIRST_LOAD)
    return spark.read.parquet(f"{root}/raw_data/customers")


def naive_customers_clean(spark, sf_dir):
    return _naive_split(feeds.customers_feed(spark, sf_dir))[0]


def naive_orders_clean(spark, sf_dir):
    feed = feeds.orders_feed(spark, sf_dir)
    invalid = feed.where(any_null(feed.columns))
    return orders.clean_orders(feed.join(invalid, "order_id", "left_anti"))


def naive_dedup_lineitem_latest(spark, sf_dir):
    """Ordered by date alone: which of several equally new rows stays is open."""
    newest = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(F.desc("l_shipdate"))
    ranked = table(spark, sf_dir, "lineitem").withColumn("rn", F.row_number().over(newest))
    return ranked.where("rn = 1").drop("rn")


def _naive_latest(df, key, newest):
    order = Window.partitionBy(key).orderBy(*[F.desc(c) for c in newest])
    return df.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def _naive_loads(df):
    return stamp_date(df, FIRST_LOAD).unionByName(stamp_date(df, SECOND_LOAD))


def _naive_dim(spark, sf_dir):
    return _naive_latest(naive_customers_clean(spark, sf_dir), "customer_id", ["created_at"])


def naive_fact_orders_left(spark, sf_dir):
    loads = _naive_loads(naive_orders_clean(spark, sf_dir))
    latest = _naive_latest(loads, "order_id", ["order_date", "processing_date"])
    return latest.join(_naive_dim(spark, sf_dir), "customer_id", "left")


def naive_fact_events_inner(spark, sf_dir):
    cleaned = events.valid_events(events.clean_events(feeds.events_feed(spark, sf_dir)))
    loads = _naive_loads(cleaned.drop("processing_timestamp", "processing_date"))
    latest = _naive_latest(loads, "event_id", ["event_timestamp", "processing_date"])
    return latest.join(_naive_dim(spark, sf_dir), "customer_id")


def naive_orders_of_untainted_customers(spark, sf_dir):
    priority = F.when(F.col("o_orderkey") % 97 != 3, F.col("o_orderpriority"))
    dirty = table(spark, sf_dir, "orders").withColumn("o_orderpriority", priority)
    return dirty.join(dirty.where(any_null(dirty.columns)), "o_custkey", "left_anti")


def naive_rank_heavy_event_types(spark, sf_dir):
    """One window: an event type is one task's work."""
    newest = Window.partitionBy("event_type").orderBy(F.desc("ts"), F.desc("event_id"))
    rows = table(spark, sf_dir, "events").select("event_type", "ts", "event_id")
    return rows.withColumn("newest", F.row_number().over(newest))


BASELINE = {
    "fact_orders_left": naive_fact_orders_left,
    "fact_events_inner": naive_fact_events_inner,
    "orders_of_untainted_customers": naive_orders_of_untainted_customers,
    "rank_heavy_event_types": naive_rank_heavy_event_types,
    "customers_load": naive_customers_load,
    "customers_clean": naive_customers_clean,
    "orders_clean": naive_orders_clean,
    "dedup_lineitem_latest": naive_dedup_lineitem_latest,
}


def timed(spark, query) -> float:
    best = float("inf")
    for run in range(RUNS + 1):
        start = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        if run:  # the first run warms up
            best = min(best, time.perf_counter() - start)
    return round(best, 4)


def main() -> None:
    spark = get_session(
        "weirflow-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: timed(spark, query) for name, query in {**QUERIES, "customers_load": customers_load}.items()}
    baseline = {name: timed(spark, query) for name, query in BASELINE.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "baseline": baseline,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
