"""Customer load and customer dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from weirflow import schemas
from weirflow.operators import Quarantine, latest_by_key, stamp_date, stamp_reject
from weirflow.operators.merge import merge_latest
from weirflow.operators.pseudonyms import Pseudonyms
from weirflow.operators.rules import Rule, staged_with_counts
from weirflow.operators.stamps import resolve_process_date
from weirflow.operators.versions import versions
from weirflow.session import staging
from weirflow.sinks import (
    KeyedSnapshot,
    replace_partitions,
    write_rejects,
    write_snapshot,
    write_table,
)
from weirflow.sources import read_csv, read_dataset

DATA_COLUMNS = schemas.CUSTOMERS.fieldNames()
# The text of a line with a value that does not fit its column.
RAW_LINE = "raw_line"


def split_customers(customers: DataFrame, **options) -> Quarantine:
    """Clean / duplicate / incomplete customers of one load."""
    return Quarantine(
        customers, "customer_id", latest=["created_at"], required=DATA_COLUMNS, **options
    )


def load_customers(
    spark: SparkSession,
    root: str,
    process_date: str | dt.date | None = None,
    now: dt.datetime | None = None,
    rules: Sequence[Rule] = (),
    **options,
) -> dict[str, int]:
    """``input`` CSV of a date -> clean rows and two reject sets. Running it
    again for the same date replaces exactly that date. A value that does not
    fit makes its row incomplete; the reject keeps the line.

    Returns how many rows there were and how many broke each of ``rules``; one
    that is broken too often stops the load before anything is replaced."""
    date = resolve_process_date(process_date)
    path = f"{root}/input/customers/{date}/customers.csv"
    drop = read_csv(spark, path, schemas.CUSTOMERS, RAW_LINE)
    split = split_customers(stamp_date(drop, date), **options)
    # Three outputs, one ranking shuffle: the ranked rows are staged.
    with staging(spark, root) as stage:
        split.ranked, counts = staged_with_counts(split.ranked, f"{stage}/ranked", rules)
        write_rejects(
            stamp_reject(split.duplicates, schemas.REASON_DUPLICATE, now),
            f"{root}/rejected_data/customers/duplicated_ids",
            date,
        )
        write_rejects(
            stamp_reject(split.invalid, schemas.REASON_MISSING, now),
            f"{root}/rejected_data/customers/null_fields",
            date,
        )
        replace_partitions(
            split.clean_of_ranked.drop(RAW_LINE),
            f"{root}/raw_data/customers",
            [{"processing_date": date}],
        )
    return counts


# What makes a row the newest of its customer.
LATEST = ["processing_date", "created_at"]


def latest_customers(customers: DataFrame) -> DataFrame:
    """One row per customer over all loads."""
    return latest_by_key(customers, ["customer_id"], LATEST)


def build_dim_customer(
    spark: SparkSession, root: str, dates: Iterable[str | dt.date] | None = None
) -> None:
    customers = read_dataset(spark, f"{root}/raw_data/customers", dates=dates)
    write_snapshot(latest_customers(customers), f"{root}/output/dim_customer", ["processing_date"])


def customer_snapshot(spark: SparkSession, root: str, **options) -> KeyedSnapshot:
    return KeyedSnapshot(spark, f"{root}/output/dim_customer_merged", ["customer_id"], **options)


def merge_dim_customer(
    spark: SparkSession, root: str, process_date: str | dt.date | None = None, **options
) -> list[int]:
    """Bring one load into the merged dimension, which then equals the one that
    ``build_dim_customer`` makes from all merged loads. Loads may come in any order
    and more than once. Returns the partitions that were replaced."""
    date = resolve_process_date(process_date)
    history = read_dataset(spark, f"{root}/raw_data/customers")
    return merge_latest(customer_snapshot(spark, root, **options), history, str(date), LATEST)


def read_dim_customer(spark: SparkSession, root: str) -> DataFrame | None:
    """The merged dimension; None before the first merge."""
    return customer_snapshot(spark, root).read()


# What a version of a customer consists of.
ATTRIBUTES = ["name", "email", "country", "created_at"]


def customer_versions(customers: DataFrame) -> DataFrame:
    """Every state of every customer over all loads, with the dates it was valid."""
    each = latest_by_key(customers, ["customer_id", "processing_date"], ["created_at"])
    return versions(each, ["customer_id"], ATTRIBUTES)


def build_customer_versions(spark: SparkSession, root: str) -> None:
    customers = read_dataset(spark, f"{root}/raw_data/customers")
    write_table(customer_versions(customers), f"{root}/output/dim_customer_versions")


# Columns of reports that name a person, with their kinds.
PERSONAL = {"name": "name", "email": "mail"}


def mask_reports(spark: SparkSession, root: str, key: bytes) -> None:
    """Copies of the customer dimension and the order fact for readers who must
    not see names and mail addresses. They still join, and count, by them."""
    pseudonyms = Pseudonyms(spark, key)
    for report in ("dim_customer", "fact_orders"):
        masked = pseudonyms.mask(read_dataset(spark, f"{root}/output/{report}"), PERSONAL)
        # The report's files hold one date each, so no rebalance is needed.
        write_snapshot(masked, f"{root}/masked/{report}", ["processing_date"], rebalance=False)
