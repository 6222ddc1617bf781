"""Customer and order loads end to end on hand-made dirty samples."""

import datetime as dt
import json
import os
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from weirflow.operators.report import partials, report
from weirflow.operators.rules import BrokenRules, Rule
from weirflow.plans import customers, gold, orders

DATES = ("2026-01-27", "2026-01-28")
NOW = dt.datetime(2026, 1, 28, 12, 0)

HEADER = "customer_id,name,email,country,created_at\n"
COLUMNS = HEADER.strip().split(",")
# What is wrong with the customer of a number, by its last digit: one field that is
# missing, the key itself, a copy, several older versions, or a bad and a good line.
MISSING = {2: "name", 3: "email", 5: "country", 6: "created_at"}
PEOPLE = range(40, 62)


def person(n, **changed):
    row = dict(customer_id=n, name=f"Person {n}", email=f"p{n}@post.test", country="ABCD"[n % 4] * 2, created_at=f"20{n % 20 + 1:02d}-03-{n % 28 + 1:02d}")
    return row | changed


def lines_of(n):
    """All rows of a customer, the one that is to be kept first."""
    digit = n % 10
    if digit in MISSING:
        return [person(n, **{MISSING[digit]: None})]
    if digit == 7:
        return [person(n)] + [person(n, created_at=f"1999-0{k}-01") for k in (3, 1, 2)]
    if digit == 8:
        return [person(n), person(n)]
    if digit == 9:
        return [person(n), person(n, country=None, created_at="1998-01-01")]
    return [person(n)]


def kept_people(numbers=PEOPLE):
    return [n for n in numbers if n % 10 not in MISSING and n % 10 != 9]


def broken_people(numbers=PEOPLE):
    return [n for n in numbers if n % 10 in MISSING or n % 10 == 9]


def csv(rows):
    return HEADER + "".join(",".join("" if r[c] is None else str(r[c]) for c in COLUMNS) + "\n" for r in rows)


CUSTOMERS_CSV = csv([*(r for n in PEOPLE for r in reversed(lines_of(n))), person(0, customer_id=None, name="Nobody")])

# The parts of an order that go through its number in turn.
FORMS = ("%Y-%m-%d", "%d-%m-%Y", "%d/%m/%Y")
STATES = ("open", "Paid", "SENT", "baCk")
ORDER_FIELDS = ("customer_id", "amount", "currency", "status", "order_date", "order_id")
PURCHASES = range(1, 36)


def order(n, **changed):
    day = dt.date(2023, 12, 20) + dt.timedelta(days=n)
    row = dict(
        order_id=f"K-{n}",
        customer_id=PEOPLE[n * 5 % len(PEOPLE)] if n % 8 else 5_000 + n,
        amount=(-1) ** n * (n + 0.25),
        currency="NOK",
        status=STATES[n % 4],
        order_date=day.strftime(FORMS[n % 3]) if n % 11 else "some day",
    )
    if n % 6 == 5:
        row[ORDER_FIELDS[n // 6 % 6]] = None
    return row | changed


def complete_orders(numbers=PURCHASES):
    return [n for n in numbers if None not in order(n).values()]


ORDERS_JSON = [order(n) for n in PURCHASES]


def drop_customers(root, date, text=CUSTOMERS_CSV):
    folder = f"{root}/input/customers/{date}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/customers.csv", "w") as out:
        out.write(text)


def drop_orders(root, date, rows=ORDERS_JSON):
    folder = f"{root}/input/orders/{date}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/orders.json", "w") as out:
        json.dump(rows, out, indent=2)


def table(spark, path, *columns):
    df = spark.read.parquet(path)
    return sorted((tuple(r) for r in df.select(*(columns or sorted(df.columns))).collect()), key=repr)


def rejects(spark, path):
    return spark.read.option("header", True).csv(path)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def load_all(spark, root):
    for date in DATES:
        drop_customers(root, date)
        drop_orders(root, date)
        customers.load_customers(spark, root, date, NOW)
        orders.load_orders(spark, root, date, NOW)
    customers.build_dim_customer(spark, root)
    orders.build_fact_orders(spark, root)


def test_both_dates_to_facts(spark, root):
    load_all(spark, root)
    first, second = map(dt.date.fromisoformat, DATES)

    clean = table(spark, f"{root}/raw_data/customers", "customer_id", "processing_date")
    assert clean == sorted(((n, d) for n in kept_people() for d in (first, second)), key=repr)
    copies = rejects(spark, f"{root}/rejected_data/customers/duplicated_ids").collect()
    wanted = [(n, k) for n in PEOPLE for k in range(2, len(lines_of(n)) + 1)]
    assert sorted((int(r["customer_id"]), int(r["duplicate_regs"])) for r in copies) == sorted(wanted * 2)
    assert {r["error_reason"] for r in copies} == {"Duplicated regs"}
    nulls = rejects(spark, f"{root}/rejected_data/customers/null_fields").collect()
    assert sorted(r["customer_id"] or "" for r in nulls) == sorted([*map(str, broken_people()), ""] * 2)
    assert {r["error_reason"] for r in nulls} == {"Missing data fields"}

    latest = spark.read.parquet(f"{root}/raw_data/orders").where(F.col("processing_date") == second)
    got = latest.select("order_id", "amount", "status", "order_date").collect()
    assert sorted(map(tuple, got)) == sorted(
        (
            f"K-{n}",
            n + 0.25,
            STATES[n % 4].upper(),
            dt.date(2023, 12, 20) + dt.timedelta(days=n) if n % 11 else None,
        )
        for n in complete_orders()
    )
    bad = rejects(spark, f"{root}/rejected_data/orders/null_fields").collect()
    incomplete = [order(n)["order_id"] or "" for n in PURCHASES if n not in complete_orders()]
    assert sorted(r["order_id"] or "" for r in bad) == sorted(incomplete * 2)
    assert {r["error_reason"] for r in bad} == {"null fields regs"}

    dim = table(spark, f"{root}/output/dim_customer", "customer_id", "processing_date")
    assert dim == [(n, second) for n in kept_people()]
    facts = table(spark, f"{root}/output/fact_orders", "order_id", "name", "created_at", "processing_date")

    def of_customer(n):
        c = order(n)["customer_id"]
        return (f"Person {c}", dt.date.fromisoformat(person(c)["created_at"])) if c in kept_people() else (None, None)

    assert facts == sorted(((f"K-{n}", *of_customer(n), second) for n in complete_orders()), key=repr)
    assert {name is None for _, name, _, _ in facts} == {True, False}


def test_loading_a_date_again_changes_nothing(spark, root):
    load_all(spark, root)
    paths = ["raw_data/customers", "raw_data/orders", "output/dim_customer", "output/fact_orders"]
    before = {p: table(spark, f"{root}/{p}") for p in paths}
    csvs = ["rejected_data/customers/null_fields", "rejected_data/orders/null_fields"]
    rejected = {p: sorted(map(tuple, rejects(spark, f"{root}/{p}").collect()), key=repr) for p in csvs}
    load_all(spark, root)
    assert before == {p: table(spark, f"{root}/{p}") for p in paths}
    assert rejected == {p: sorted(map(tuple, rejects(spark, f"{root}/{p}").collect()), key=repr) for p in csvs}


def test_a_corrected_drop_clears_old_rejects_of_its_date_only(spark, root):
    load_all(spark, root)
    mended = broken_people()[0]
    drop_customers(root, DATES[1], csv([person(mended)]))
    customers.load_customers(spark, root, DATES[1], NOW)
    nulls = rejects(spark, f"{root}/rejected_data/customers/null_fields").collect()
    assert sorted((r["customer_id"] or "", str(r["processing_date"])) for r in nulls) == [
        (n, DATES[0]) for n in sorted(["", *map(str, broken_people())])
    ]
    clean = table(spark, f"{root}/raw_data/customers", "customer_id", "processing_date")
    assert [c for c, d in clean if d == dt.date.fromisoformat(DATES[1])] == [mended]


def test_a_drop_without_clean_rows_empties_its_date(spark, root):
    load_all(spark, root)
    drop_customers(root, DATES[1], csv([person(1, country=None), person(2, email=None)]))
    customers.load_customers(spark, root, DATES[1], NOW)
    dates = {d for (d,) in table(spark, f"{root}/raw_data/customers", "processing_date")}
    assert dates == {dt.date.fromisoformat(DATES[0])}


def test_dimension_keeps_one_row_per_key_when_keys_move_to_a_newer_date(spark, root):
    drop_customers(root, DATES[0])
    customers.load_customers(spark, root, DATES[0], NOW)
    customers.build_dim_customer(spark, root)
    drop_customers(root, DATES[1])
    customers.load_customers(spark, root, DATES[1], NOW)
    customers.build_dim_customer(spark, root)
    assert [i for (i,) in table(spark, f"{root}/output/dim_customer", "customer_id")] == kept_people()


def test_heavy_key_path_gives_the_same_load(spark, root):
    drop_customers(root, DATES[0], csv([person(n) for n in (4, 9)] + [person(4)] * 300 + [person(1, name=None)]))
    customers.load_customers(spark, root, DATES[0], NOW, heavy_rows=50)
    copies = rejects(spark, f"{root}/rejected_data/customers/duplicated_ids").collect()
    assert sorted(int(r["duplicate_regs"]) for r in copies) == list(range(2, 302))
    assert [i for (i,) in table(spark, f"{root}/raw_data/customers", "customer_id")] == [4, 9]


def test_unparsed_order_dates_can_be_rejected(spark, root):
    drop_orders(root, DATES[0])
    orders.load_orders(spark, root, DATES[0], NOW)
    undated = [f"K-{n}" for n in complete_orders() if n % 11 == 0]
    dates = table(spark, f"{root}/raw_data/orders", "order_id", "order_date")
    assert sorted(i for i, d in dates if d is None) == sorted(undated) != []
    orders.load_orders(spark, root, DATES[0], NOW, reject_unparsed_dates=True)
    kept = table(spark, f"{root}/raw_data/orders", "order_id")
    assert sorted(i for (i,) in kept) == sorted(f"K-{n}" for n in complete_orders() if n % 11)
    bad = rejects(spark, f"{root}/rejected_data/orders/unparsed_dates").collect()
    assert sorted((r["order_id"], r["order_date"]) for r in bad) == sorted((i, "some day") for i in undated)


def test_facts_can_be_built_from_some_dates(spark, root):
    load_all(spark, root)
    orders.build_fact_orders(spark, root, dates=[DATES[0]])
    dates = {d for (d,) in table(spark, f"{root}/output/fact_orders", "processing_date")}
    assert dates == {dt.date.fromisoformat(DATES[0])}


def test_missing_drop_and_bad_date_raise(spark, root):
    with pytest.raises(AnalysisException):
        customers.load_customers(spark, root, "2030-01-01")
    with pytest.raises(ValueError):
        orders.load_orders(spark, root, "not-a-date")


def test_header_that_does_not_match_the_schema_raises(spark, root):
    drop_customers(root, DATES[0], "name,customer_id,email,country,created_at\nP,1,p@x,AA,2024-02-29\n")
    with pytest.raises(Exception, match="header"):
        customers.load_customers(spark, root, DATES[0], NOW)


def test_a_value_that_does_not_fit_keeps_its_line(spark, root):
    lines = ["70,Seventy,s@post.test,AA,soon", "x1,Letter,l@post.test,AA,2024-01-01"]
    drop_customers(root, DATES[0], CUSTOMERS_CSV + "".join(f"{line}\n" for line in lines))
    customers.load_customers(spark, root, DATES[0], NOW)
    nulls = rejects(spark, f"{root}/rejected_data/customers/null_fields").collect()
    kept = {r["email"]: (r["customer_id"], r["raw_line"]) for r in nulls}
    assert kept["s@post.test"] == ("70", lines[0])
    assert kept["l@post.test"] == (None, lines[1])
    assert kept["p42@post.test"] == ("42", None)
    clean = spark.read.parquet(f"{root}/raw_data/customers")
    assert "raw_line" not in clean.columns
    assert sorted(r["customer_id"] for r in clean.collect()) == kept_people()


def test_rules_are_counted_and_stop_a_load(spark, root):
    drop_customers(root, DATES[0])
    drop_orders(root, DATES[0])
    counting = [Rule("no_name", "name IS NULL"), Rule("early", F.col("created_at") < "2000-01-01")]
    counts = customers.load_customers(spark, root, DATES[0], NOW, rules=counting)
    rows = [r for n in PEOPLE for r in lines_of(n)]
    assert counts == {
        "rows": len(rows) + 1,
        "no_name": sum(r["name"] is None for r in rows),
        "early": sum((r["created_at"] or "9") < "2000" for r in rows),
    }
    assert orders.load_orders(spark, root, DATES[0], NOW) == {"rows": len(ORDERS_JSON)}
    paths = [f"{root}/raw_data/orders", f"{root}/raw_data/customers"]
    before = [table(spark, p) for p in paths]
    with pytest.raises(BrokenRules, match="negative in") as stopped:
        drop_orders(root, DATES[0], [order(n, amount=-1.0) for n in (1, 2)] + [order(3)])
        orders.load_orders(spark, root, DATES[0], NOW, rules=[Rule("negative", "amount < 0", most=0.9)])
    assert stopped.value.counts == {"rows": 3, "negative": 3}
    with pytest.raises(BrokenRules):
        drop_customers(root, DATES[0], csv([person(1, name=None)]))
        customers.load_customers(spark, root, DATES[0], NOW, rules=[Rule("no_name", "name IS NULL", most=0.0)])
    assert before == [table(spark, p) for p in paths]
    assert not os.listdir(f"{root}/_staging")


def test_reports_from_partials(spark, root):
    for date, numbers in zip(DATES, (PURCHASES, range(30, 50)), strict=True):
        drop_orders(root, date, [order(n) for n in numbers])
        orders.load_orders(spark, root, date, NOW)
        orders.add_report_partials(spark, root, date)
    orders.add_report_partials(spark, root, DATES[0])
    found = orders.report_orders(spark, root).collect()
    numbers = [*complete_orders(), *complete_orders(range(30, 50))]
    (total,) = [r for r in found if r["level"] == 7]
    assert (total["n_orders"], float(total["amount"])) == (len(numbers), sum(n + 0.25 for n in numbers))
    assert (total["least"], total["most"]) == (min(numbers) + 0.25, max(numbers) + 0.25)
    by_status = {r["status"]: r["n_orders"] for r in found if r["level"] == 1}
    assert by_status == Counter(STATES[n % 4].upper() for n in numbers)
    undated = [r["n_orders"] for r in found if r["level"] == 0 and r["order_year"] is None]
    assert sum(undated) == sum(n % 11 == 0 for n in numbers)


def test_distinct_counts_merge(spark):
    rows = [(n % 3, n % 500, n % 2) for n in range(4_000)]
    df = spark.createDataFrame(rows, "a int, who int, day int")
    measures = {"people": ("distinct", "who"), "n": ("count", "who")}
    parts = [partials(df.where(F.col("day") == d), ["a"], measures) for d in (0, 1)]
    found = report(parts[0].unionByName(parts[1]), ["a"], measures).collect()
    assert {r["a"]: r["n"] for r in found} == {**Counter(a for a, _, _ in rows), None: 4_000}
    assert all(abs(r["people"] - 500) < 25 for r in found)
    with pytest.raises(ValueError):
        partials(df, ["a"], {"x": ("median", "who")})


def test_gold_tables_are_published_with_the_default_number_of_connections(spark, root, monkeypatch):
    seen = []
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", lambda self, url, table, mode, properties: seen.append((table, properties)))
    for name in gold.TABLES:
        spark.range(3).write.parquet(f"{root}/silver/{name}")
    gold.publish(spark, root, "jdbc:none", {"user": "u"})
    assert [name for name, _ in seen] == list(gold.TABLES)
    assert all(p == {"batchsize": "10000", "numPartitions": "16", "user": "u"} for _, p in seen)
    with pytest.raises((TypeError, ValueError)):
        gold.publish(spark, root, "jdbc:none", {}, connections=None)
