import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow import schemas
from weirflow.operators import stamp_date
from weirflow.plans import events
from weirflow.streaming import (
    Audit,
    await_all,
    dedup_stream,
    dedup_stream_by_id,
    stream_parquet,
    stream_to_parquet,
)

START = dt.datetime(2024, 11, 30, 23, 50)
# Texts that are no time of the feed's form, and event types with what they become.
NO_TIMES = ["", "2024-11-31T00:00:00Z", "30.11.2024", None]
TYPES = {"page view": "PAGEVIEW", "add-to-cart": "ADDTOCART", "Refund!": "REFUND", "ping": "PING"}


def event(n, **changed):
    """The n-th event: every seventh has no time, every fifth a customer without
    a row in the dimension, every type comes in turn, seven minutes apart."""
    time = (START + dt.timedelta(minutes=7 * n)).strftime("%Y-%m-%dT%H:%M:%SZ")
    row = dict(
        event_id=f"n{n:03d}",
        customer_id=900 + n if n % 5 == 3 else n % 4 + 1,
        event_type=list(TYPES)[n % len(TYPES)],
        event_timestamp=NO_TIMES[n // 7 % len(NO_TIMES)] if n % 7 == 6 else time,
    )
    return row | changed


def valid(numbers):
    return [f"n{n:03d}" for n in numbers if n % 7 != 6]


def rejected(numbers):
    return [f"n{n:03d}" for n in numbers if n % 7 == 6]


def known(numbers):
    return [f"n{n:03d}" for n in numbers if n % 7 != 6 and n % 5 != 3]


ALL = range(31)
EVENTS = [event(n) for n in ALL]


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def drop(root, name, lines):
    folder = f"{root}/input_streaming/events"
    os.makedirs(folder, exist_ok=True)
    text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
    with open(f"{folder}/{name}.jsonl", "w") as out:
        out.write(text + "\n")


def ids(spark, path):
    return sorted(r["event_id"] or "" for r in spark.read.parquet(path).collect())


def run_raw(spark, root):
    await_all(*events.stream_events(spark, root, every=None))


def run_fact(spark, root, **options):
    await_all(events.stream_fact_events(spark, root, every=None, **options))


def dim(spark, root, keys=(1, 2, 3, 4)):
    rows = [(k, f"name {k}", "e", "BR", dt.date(2022, 1, 1), dt.date(2026, 1, 27)) for k in keys]
    schema = "customer_id long, name string, email string, country string, created_at date, processing_date date"
    spark.createDataFrame(rows, schema).write.partitionBy("processing_date").parquet(
        f"{root}/output/dim_customer"
    )


def test_stream_to_batch_and_streaming_facts(spark, root):
    drop(root, "a", EVENTS)
    run_raw(spark, root)
    assert ids(spark, f"{root}/raw_data/events") == valid(ALL)
    raw = spark.read.parquet(f"{root}/raw_data/events").collect()
    assert all(r["event_type"] == TYPES[event(int(r["event_id"][1:]))["event_type"]] for r in raw)
    assert {r["processing_date"] for r in raw} <= {dt.date.today(), dt.date.today() - dt.timedelta(1)}
    bad = spark.read.parquet(f"{root}/rejected_data/events").collect()
    assert {r["event_id"]: r["raw_event_timestamp"] for r in bad} == {
        e["event_id"]: e["event_timestamp"] for e in EVENTS if e["event_id"] in rejected(ALL)
    }
    assert {r["error_reason"] for r in bad} == {"Unparsable event timestamp"}
    dim(spark, root)
    events.build_fact_events(spark, root)
    assert ids(spark, f"{root}/output/fact_events") == known(ALL)
    run_fact(spark, root)
    assert ids(spark, f"{root}/output/fact_events_streaming") == valid(ALL)
    events.check_events(spark, root)


def test_restart_reads_only_new_files(spark, root):
    drop(root, "a", EVENTS[:12])
    run_raw(spark, root)
    run_raw(spark, root)
    drop(root, "b", EVENTS[12:])
    run_raw(spark, root)
    assert ids(spark, f"{root}/raw_data/events") == valid(ALL)
    run_fact(spark, root)
    drop(root, "c", [event(40)])
    run_raw(spark, root)
    run_fact(spark, root)
    assert ids(spark, f"{root}/output/fact_events_streaming") == valid([*ALL, 40])


def test_a_line_that_is_not_json_is_rejected(spark, root):
    drop(root, "a", [EVENTS[0], "not json"])
    run_raw(spark, root)
    assert ids(spark, f"{root}/raw_data/events") == valid([0])
    bad = spark.read.parquet(f"{root}/rejected_data/events").collect()
    assert [(r["event_id"], r["raw_line"]) for r in bad] == [(None, "not json")]


def test_single_read_matches_two_queries_whatever_the_number_of_batches(spark, root):
    for i in range(0, len(EVENTS), 8):
        drop(root, f"f{i}", EVENTS[i : i + 8])
        await_all(events.stream_events_once(spark, root, every=None))
    good = events.read_checked_events(spark, root, valid=True)
    assert sorted(r["event_id"] for r in good.collect()) == valid(ALL)
    bad = events.read_checked_events(spark, root, valid=False).collect()
    assert sorted(r["event_id"] for r in bad) == rejected(ALL)
    run_raw(spark, root)
    two = spark.read.parquet(f"{root}/raw_data/events")
    assert good.columns == two.columns
    folders = [d for d, _, files in os.walk(f"{root}/raw_data/checked_events") if any(f.endswith(".parquet") for f in files)]
    dates = {r["processing_date"] for r in good.collect()}
    assert len(folders) <= 2 * len(dates) + 1


def test_an_older_file_of_a_backlog_is_not_late(spark, root):
    """Files are not cut into batches that would move the watermark between them."""
    for i, n in enumerate((300, 301, 1, 2)):
        drop(root, f"f{i}", [event(n)])
        run_raw(spark, root)
    run_fact(spark, root)
    assert ids(spark, f"{root}/output/fact_events_streaming") == valid([1, 2, 300, 301])


def test_two_events_in_one_second_collapse_unless_the_key_has_the_id(spark, root):
    drop(root, "a", [event(0), event(0, event_id="twin"), event(1)])
    run_raw(spark, root)
    run_fact(spark, root)
    assert len(ids(spark, f"{root}/output/fact_events_streaming")) == 2
    other = f"{root}/by_id"
    source = stream_parquet(
        spark, f"{root}/raw_data/events", spark.read.parquet(f"{root}/raw_data/events").schema
    )
    deduped = dedup_stream(source, ["customer_id", "event_timestamp", "event_id"])
    await_all(stream_to_parquet(deduped, other, f"{root}/ck_by_id", every=None))
    assert ids(spark, other) == [*valid([0, 1]), "twin"]


def test_fact_stream_starts_before_its_source_has_files(spark, root):
    os.makedirs(f"{root}/raw_data/events")
    run_fact(spark, root)
    drop(root, "a", EVENTS[:1])
    run_raw(spark, root)
    run_fact(spark, root)
    assert ids(spark, f"{root}/output/fact_events_streaming") == valid([0])


SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("processing_date", T.DateType()),
    ]
)


def test_watermark_boundary_over_a_restart(spark, root):
    def batch(*events):
        df = spark.createDataFrame([(c, f"2026-01-27 {t}") for c, t in events], "customer_id string, t string")
        df = df.select("customer_id", F.to_timestamp("t").alias("event_timestamp"))
        df = stamp_date(df, "2026-01-27").coalesce(1)
        df.write.mode("append").partitionBy("processing_date").parquet(f"{root}/in")
        source = stream_parquet(spark, f"{root}/in", SCHEMA)
        deduped = dedup_stream(source, ["customer_id", "event_timestamp"])
        await_all(stream_to_parquet(deduped, f"{root}/out", f"{root}/ck", every=None))
        time.sleep(0.1)

    batch(("c1", "10:00:00"), ("c1", "09:00:00"), ("c1", "10:00:00"))
    # The watermark is now 09:50:00: at or before it is late.
    batch(("c2", "09:55:00"), ("c2", "09:50:00"), ("c2", "09:49:59"), ("c1", "10:00:00"))
    out = spark.read.parquet(f"{root}/out").collect()
    got = sorted((r["customer_id"], r["event_timestamp"].strftime("%H:%M:%S")) for r in out)
    assert got == [("c1", "09:00:00"), ("c1", "10:00:00"), ("c2", "09:55:00")]


def test_state_must_be_able_to_expire(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        dedup_stream(stream, ["value"], "timestamp")


def test_interval_trigger_and_backlog_limit(spark, root):
    for name in "abc":
        drop(root, name, [event(0, event_id=name)])
    queries = events.stream_events(spark, root, every="1 second", max_bytes=1)
    try:
        for query in queries:
            query.processAllAvailable()
            assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 3
    finally:
        for query in queries:
            query.stop()
    assert ids(spark, f"{root}/raw_data/events") == ["a", "b", "c"]


def test_batch_use_of_the_cleaning(spark):
    rows = [(1, "v1", "2024-11-30T23:59:59Z", "a1")]
    df = spark.createDataFrame(rows, schemas.EVENTS)
    now = F.lit("2026-01-27 12:00:00").cast("timestamp")
    row = events.valid_events(events.clean_events(df, now)).first()
    assert row["processing_date"] == dt.date(2026, 1, 27)
    assert row["event_type"] == "A"


def test_stream_and_batch_fact_agree_with_copies_and_restarts(spark, root):
    """The dimension grows between two batches: each batch has the one of its time."""
    dim(spark, root, keys=(1, 2))
    drop(root, "a", [*EVENTS[:10], *EVENTS[:5]])
    run_raw(spark, root)
    await_all(events.stream_customer_events(spark, root, every=None))
    before = {n for n in known(range(10)) if event(int(n[1:]))["customer_id"] in (1, 2)}
    assert {r["event_id"] for r in events.read_customer_events(spark, root).collect()} == before
    rows = [(k, f"new {k}", "e", "BR", dt.date(2022, 1, 1), dt.date(2026, 1, 28)) for k in (1, 2, 3, 4)]
    schema = "customer_id long, name string, email string, country string, created_at date, processing_date date"
    spark.createDataFrame(rows, schema).write.mode("overwrite").partitionBy("processing_date").parquet(f"{root}/output/dim_customer")
    drop(root, "b", [*EVENTS[8:], *EVENTS[20:]])
    run_raw(spark, root)
    await_all(events.stream_customer_events(spark, root, every=None))
    await_all(events.stream_customer_events(spark, root, every=None))
    found = events.read_customer_events(spark, root).collect()
    assert sorted(r["event_id"] for r in found) == sorted(before | set(known(range(10, 31))))
    assert {r["event_id"] for r in found if r["name"].startswith("name")} == before


def test_state_by_id_expires(spark, root):
    def run(times):
        rows = [(f"i{t}", dt.datetime(2026, 1, 1) + dt.timedelta(minutes=t), dt.date(2026, 1, 1)) for t in times]
        schema = "event_id string, event_timestamp timestamp, processing_date date"
        df = spark.createDataFrame(rows, schema).coalesce(1)
        df.write.mode("append").partitionBy("processing_date").parquet(f"{root}/in")
        deduped = dedup_stream_by_id(stream_parquet(spark, f"{root}/in", df.schema), ["event_id"])
        query = stream_to_parquet(deduped, f"{root}/out", f"{root}/ck", every=None)
        await_all(query)
        time.sleep(0.1)
        return query.lastProgress.stateOperators[0].numRowsTotal

    run(range(0, 100))
    # The watermark has gone to minute 990: nothing of the first batch is held.
    assert run(range(1_000, 1_003)) <= 3
    assert run([1_001, 1_002, 1_004]) <= 4
    assert ids(spark, f"{root}/out") == sorted(f"i{t}" for t in [*range(100), *range(1_000, 1_003), 1_004])


def test_audit_accounts_for_every_row(spark, root):
    schema = "event_id string, event_timestamp timestamp, processing_date date"
    audit = Audit(spark, f"{root}/audit")
    spark.streams.addListener(audit)
    try:
        for minutes in ([0, 1, 1, 60], [60, 45, 49, 55, 55, 70]):
            rows = [(f"i{m}", dt.datetime(2026, 1, 1) + dt.timedelta(minutes=m), dt.date(2026, 1, 1)) for m in minutes]
            df = spark.createDataFrame(rows, schema).coalesce(1)
            df.write.mode("append").partitionBy("processing_date").parquet(f"{root}/in")
            deduped = dedup_stream_by_id(stream_parquet(spark, f"{root}/in", df.schema), ["event_id"])
            query = stream_to_parquet(deduped, f"{root}/out", f"{root}/ck", every=None)
            await_all(query)
            audit.wait(query)
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(audit)
    found = spark.read.parquet(f"{root}/audit").where("rows_in > 0").orderBy("batch").collect()
    assert [(r["rows_in"], r["kept"], r["duplicates"], r["late"]) for r in found] == [(4, 3, 1, 0), (6, 2, 2, 2)]
