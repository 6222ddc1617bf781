"""Order load and order fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow import schemas
from weirflow.functions import parse_date_any, repair_sign
from weirflow.operators import (
    Incomplete,
    enrich,
    latest_by_key,
    quarantine_incomplete,
    stamp_date,
    stamp_reject,
)
from weirflow.operators.merge import merge_latest
from weirflow.operators.report import partials, report
from weirflow.operators.rules import Rule, staged_with_counts
from weirflow.operators.stamps import resolve_process_date
from weirflow.operators.versions import enrich_as_of
from weirflow.plans.customers import ATTRIBUTES, customer_snapshot
from weirflow.session import staging
from weirflow.sinks import KeyedSnapshot, replace_partitions, write_rejects, write_snapshot
from weirflow.sources import read_dataset, read_json_array, read_json_lines

DATA_COLUMNS = schemas.ORDERS.fieldNames()


def split_orders(orders: DataFrame, **options) -> Incomplete:
    """Complete / incomplete orders of one load, still as text."""
    return quarantine_incomplete(orders, "order_id", required=DATA_COLUMNS, **options)


def clean_orders(orders: DataFrame) -> DataFrame:
    """Repair amounts, parse dates, normalise the status."""
    cleaned = {
        "amount": repair_sign("amount"),
        "order_date": parse_date_any("order_date"),
        "status": F.upper("status"),
    }
    columns = ["order_id", "amount", "currency", "customer_id", "order_date", "status"]
    columns += [c for c in orders.columns if c == "processing_date"]
    return orders.withColumns(cleaned).select(*columns)


def load_orders(
    spark: SparkSession,
    root: str,
    process_date: str | dt.date | None = None,
    now: dt.datetime | None = None,
    json_lines: bool = False,
    reject_unparsed_dates: bool = False,
    rules: Sequence[Rule] = (),
    **options,
) -> dict[str, int]:
    """``input`` JSON of a date -> clean rows and rejects. Returns how many rows
    there were and how many broke each of ``rules``; one that is broken too often
    stops the load before anything is replaced.

    A date text that no format matches is a null date in the clean rows;
    ``reject_unparsed_dates`` moves those rows to a reject set of their own.
    """
    date = resolve_process_date(process_date)
    path = f"{root}/input/orders/{date}/orders.json"
    read = read_json_lines if json_lines else read_json_array
    drop = stamp_date(read(spark, path, schemas.ORDERS), date)
    # Parsed once for all passes.
    with staging(spark, root) as stage:
        drop, counts = staged_with_counts(drop, f"{stage}/drop", rules)
        split = split_orders(drop, stage=stage, **options)
        write_rejects(
            stamp_reject(split.invalid, schemas.REASON_NULLS, now),
            f"{root}/rejected_data/orders/null_fields",
            date,
        )
        complete = split.clean
        if reject_unparsed_dates:
            parsed = parse_date_any("order_date").isNotNull()
            write_rejects(
                stamp_reject(complete.where(~parsed), schemas.REASON_ORDER_DATE, now),
                f"{root}/rejected_data/orders/unparsed_dates",
                date,
            )
            complete = complete.where(parsed)
        replace_partitions(
            clean_orders(complete), f"{root}/raw_data/orders", [{"processing_date": date}]
        )
    return counts


# What makes a row the newest of its order.
LATEST = ["order_date", "processing_date"]


def fact_orders(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Latest version of each order with its customer; an unknown customer
    leaves the attributes null."""
    return _with_customers(latest_by_key(orders, ["order_id"], LATEST), dim_customer)


def _with_customers(latest: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return enrich(latest, dim_customer, "customer_id", ATTRIBUTES, how="left").select(
        "order_id",
        "amount",
        "currency",
        "status",
        "order_date",
        "customer_id",
        *ATTRIBUTES,
        "processing_date",
    )


def build_fact_orders(
    spark: SparkSession, root: str, dates: Iterable[str | dt.date] | None = None
) -> None:
    orders = read_dataset(spark, f"{root}/raw_data/orders", dates=dates)
    dim = read_dataset(spark, f"{root}/output/dim_customer")
    write_snapshot(fact_orders(orders, dim), f"{root}/output/fact_orders", ["processing_date"])


def fact_orders_as_of(orders: DataFrame, versions: DataFrame, **options) -> DataFrame:
    """Latest version of each order with its customer as it was on the order's date."""
    latest = latest_by_key(orders, ["order_id"], LATEST)
    return enrich_as_of(latest, versions, ["customer_id"], "order_date", ATTRIBUTES, **options)


def build_fact_orders_as_of(spark: SparkSession, root: str, **options) -> None:
    orders = read_dataset(spark, f"{root}/raw_data/orders")
    versions = read_dataset(spark, f"{root}/output/dim_customer_versions")
    facts = fact_orders_as_of(orders, versions, **options)
    write_snapshot(facts, f"{root}/output/fact_orders_as_of", ["processing_date"])


def merge_fact_orders(
    spark: SparkSession, root: str, process_date: str | dt.date | None = None, **options
) -> list[int]:
    """Bring one load of orders, and what the merged dimension has changed since
    the last time, into the merged fact. It then equals what ``build_fact_orders``
    makes from all merged loads. Returns the partitions that were replaced.

    Partitions without a new order, and without an order of a customer whose
    attributes changed, stay as they are.
    """
    date = str(resolve_process_date(process_date))
    latest = KeyedSnapshot(spark, f"{root}/output/latest_orders", ["order_id"], **options)
    fact = KeyedSnapshot(spark, f"{root}/output/fact_orders_merged", ["order_id"], **options)
    customers = customer_snapshot(spark, root, **options)
    history = read_dataset(spark, f"{root}/raw_data/orders")
    seen = fact.facts()
    merge_latest(latest, history, date, LATEST)
    # Also what an earlier run has merged, if it ended before the fact was replaced.
    buckets = set(latest.changed_buckets(seen.get("orders", 0)))
    since, now = seen.get("customers", 0), customers.version()
    changed = _changed_customers(customers, since)
    if changed is not None:
        moved = latest.read().join(changed, "customer_id", "left_semi")
        buckets |= {row[0] for row in moved.select(latest.bucket()).distinct().collect()}
    dim = customers.read(version=now)
    if dim is None:
        raise RuntimeError("the customer dimension has not been merged yet")
    rows = _with_customers(latest.read(buckets), dim)
    fact.replace(rows, buckets, date, orders=latest.version(), customers=now)
    return sorted(buckets)


def _changed_customers(customers: KeyedSnapshot, since: int) -> DataFrame | None:
    """Customers that look different in facts than at version ``since``."""
    buckets = customers.changed_buckets(since)
    columns = ["customer_id", *ATTRIBUTES]
    before, after = customers.read(buckets, since), customers.read(buckets)
    if not buckets or before is None:
        return after if after is None else after.select("customer_id")
    before, after = before.select(*columns), after.select(*columns)
    gone, come = before.exceptAll(after), after.exceptAll(before)
    return gone.unionByName(come).select("customer_id").distinct()


def read_fact_orders(spark: SparkSession, root: str) -> DataFrame | None:
    """The merged fact; None before the first merge."""
    return KeyedSnapshot(spark, f"{root}/output/fact_orders_merged", ["order_id"]).read()


# The report of order amounts: dimensions from the coarsest on, and measures.
REPORT_BY = ["currency", "status", "order_year"]
REPORT_MEASURES = {
    "n_orders": ("count", "order_id"),
    "amount": ("sum", "exact_amount"),
    "least": ("min", "amount"),
    "most": ("max", "amount"),
}


def add_report_partials(spark: SparkSession, root: str, process_date: str | dt.date | None = None) -> None:
    """Aggregate one load of orders; doing it again replaces its partials."""
    date = resolve_process_date(process_date)
    load = read_dataset(spark, f"{root}/raw_data/orders", dates=[date])
    dated = load.withColumns(
        {"order_year": F.year("order_date"), "exact_amount": F.col("amount").cast("decimal(18,2)")}
    )
    parts = partials(dated, ["processing_date", *REPORT_BY], REPORT_MEASURES)
    replace_partitions(
        parts,
        f"{root}/output/order_partials",
        [{"processing_date": date}],
        rebalance=True,
    )


def report_orders(spark: SparkSession, root: str, sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """All loads by currency, status and year of the order, with subtotals."""
    parts = read_dataset(spark, f"{root}/output/order_partials")
    return report(parts, REPORT_BY, REPORT_MEASURES, sets)
