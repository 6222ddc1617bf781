"""The results of ``queries`` as plain SQL over the driver tables."""

from __future__ import annotations

from weirflow.catalog.feeds import EVENTS_FEED_SQL, ORDERS_FEED_SQL, PSEUDONYM_KEY, TRIPS_YEAR, VERSION_LOADS

_CUSTOMER_COPY = """
SELECT {key} AS customer_id,
  CASE WHEN c_custkey % 11 = 5 THEN NULL ELSE c_name END AS name,
  concat('c', CAST(c_custkey AS STRING), '@example.com') AS email,
  CASE WHEN c_custkey % 13 = 6 THEN NULL ELSE c_mktsegment END AS country,
  DATE '2022-01-01' + CAST(c_custkey % 365 AS INT) AS created_at
FROM customer WHERE {which}
"""
CUSTOMERS_FEED = " UNION ALL ".join(
    _CUSTOMER_COPY.format(key=key, which=which)
    for key, which in [
        ("c_custkey", "true"),
        ("c_custkey", "c_custkey % 7 = 3"),
        ("CAST(NULL AS BIGINT)", "c_custkey = 1"),
    ]
)
ORDERS_FEED = ORDERS_FEED_SQL.format(orders="orders")
EVENTS_FEED = EVENTS_FEED_SQL.format(events="events")

_NULL_CUSTOMER = """(customer_id IS NULL OR name IS NULL OR email IS NULL
  OR country IS NULL OR created_at IS NULL)"""
_NULL_ORDER = """(order_id IS NULL OR customer_id IS NULL OR amount IS NULL
  OR currency IS NULL OR status IS NULL OR order_date IS NULL)"""


def _customer_ctes(feed: str, p: str = "") -> str:
    return f"""
{p}feed AS ({feed}),
{p}ranked AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC NULLS LAST,
    name DESC NULLS LAST, email DESC NULLS LAST, country DESC NULLS LAST) AS duplicate_regs
  FROM {p}feed),
{p}bad AS (SELECT customer_id FROM {p}feed WHERE {_NULL_CUSTOMER}),
{p}clean AS (
  SELECT customer_id, name, email, country, created_at FROM {p}ranked r
  WHERE duplicate_regs = 1 AND customer_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM {p}bad b WHERE b.customer_id = r.customer_id))"""


_CUSTOMERS = _customer_ctes(CUSTOMERS_FEED)

_CHANGED_FEED = f"""
SELECT customer_id, name, email, country,
  CASE WHEN customer_id % 2 = 0 THEN created_at + 1 ELSE created_at END AS created_at
FROM ({CUSTOMERS_FEED}) c"""

def _order_ctes(feed: str, p: str = "") -> str:
    return f"""
{p}ofeed AS ({feed}),
{p}oclean AS (
  SELECT order_id, abs(amount) AS amount, currency, customer_id,
    CAST(coalesce(try_strptime(order_date, '%Y-%m-%d'), try_strptime(order_date, '%d-%m-%Y'),
      try_strptime(order_date, '%d/%m/%Y')) AS DATE) AS order_date,
    upper(status) AS status
  FROM {p}ofeed o
  WHERE NOT EXISTS (
    SELECT 1 FROM {p}ofeed b WHERE b.order_id = o.order_id AND {_NULL_ORDER.replace('(', '(b.', 1)
        .replace('OR ', 'OR b.')}))"""


_ORDERS = _order_ctes(ORDERS_FEED)
_CHANGED_ORDERS = ORDERS_FEED_SQL.format(
    orders="""(SELECT * REPLACE (o_orderdate + INTERVAL 7 DAY AS o_orderdate, 'F' AS o_orderstatus)
      FROM orders WHERE o_orderkey % 3 = 0)"""
)

_EVENTS = f"""
efeed AS ({EVENTS_FEED}),
eparsed AS (
  SELECT event_id, customer_id,
    upper(regexp_replace(event_type, '[^a-zA-Z]', '', 'g')) AS event_type,
    try_strptime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp,
    event_timestamp AS raw_event_timestamp
  FROM efeed)"""

_TRIPS = f"""
moved AS (
  SELECT *, o_orderdate + to_years({TRIPS_YEAR} - CAST(year(o_orderdate) AS INTEGER)) AS pickup,
    l_shipdate + to_years({TRIPS_YEAR} - CAST(year(o_orderdate) AS INTEGER)) AS dropoff
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
trips AS (
  SELECT l_orderkey, l_linenumber AS VendorID, pickup AS tpep_pickup_datetime,
    dropoff AS tpep_dropoff_datetime, l_suppkey AS PULocationID,
    l_quantity - 5 AS trip_distance, l_extendedprice AS total_amount,
    CAST(date_diff('second', pickup, dropoff) AS BIGINT) AS secs,
    strftime(pickup, '%Y-%m') AS pickup_month,
    strftime(pickup + to_months(CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END), '%Y-%m')
      AS source_month
  FROM moved)"""
_HMS = "printf('%02d:%02d:%02d', secs // 3600, (secs % 3600) // 60, secs % 60)"

_EVENTS_VALID = f"""WITH {_EVENTS}
SELECT event_id, customer_id, event_type, event_timestamp
FROM eparsed WHERE event_timestamp IS NOT NULL"""
_EVENTS_REJECTED = f"""WITH {_EVENTS}
SELECT event_id, customer_id, event_type, raw_event_timestamp,
  'Unparsable event timestamp' AS error_reason
FROM eparsed WHERE event_timestamp IS NULL"""

_INVALID_CUSTOMERS = f"""WITH {_CUSTOMERS}
SELECT *, 'Missing data fields' AS error_reason FROM ranked WHERE {_NULL_CUSTOMER}"""


def _fact_orders(processing_date: str) -> str:
    return f"""WITH {_CUSTOMERS}, {_ORDERS}
SELECT o.order_id, o.amount, o.currency, o.status, o.order_date, o.customer_id,
  c.name, c.email, c.country, c.created_at, DATE '{processing_date}' AS processing_date
FROM oclean o LEFT JOIN clean c ON o.customer_id = c.customer_id"""


def _fact_events(extra: str) -> str:
    return f"""WITH {_CUSTOMERS}, {_EVENTS}
SELECT e.event_id, e.customer_id, c.name, c.email, c.country, e.event_type, c.created_at,
  e.event_timestamp{extra}
FROM eparsed e JOIN clean c ON e.customer_id = c.customer_id
WHERE e.event_timestamp IS NOT NULL"""


_STATIC_DIMS = """SELECT l_orderkey, l_partkey,
  CAST(l_linenumber % 2 + 1 AS BIGINT) AS vendor_id, CAST(l_linenumber AS BIGINT) AS rate_code_id,
  vendor_name, rate_code_desc
FROM lineitem
LEFT JOIN (VALUES (1, 'Creative Mobile Technologies, LLC'), (2, 'VeriFone Inc.'))
  v(id, vendor_name) ON v.id = l_linenumber % 2 + 1
LEFT JOIN (VALUES (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau or Westchester'),
  (5, 'Negotiated fare'), (6, 'Group ride')) r(id, rate_code_desc) ON r.id = l_linenumber"""



def _hmac(text: str) -> str:
    """HMAC-SHA256 with the key of the test tables, null for null."""
    block = PSEUDONYM_KEY.ljust(64, b"\0")
    inner, outer = ("".join(f"\\x{byte ^ pad:02X}" for byte in block) for pad in (0x36, 0x5C))
    once = f"unhex(sha256('{inner}'::BLOB || encode({text})))"
    return f"CASE WHEN {text.split(', ')[-1][:-1]} IS NOT NULL THEN sha256('{outer}'::BLOB || {once}) END"


def _report(groups: str) -> str:
    return f"""WITH {_ORDERS}, {_order_ctes(_CHANGED_ORDERS, 'second_')},
loads AS (
  SELECT *, CAST(year(order_date) AS INTEGER) AS order_year
  FROM (SELECT * FROM oclean UNION ALL SELECT * FROM second_oclean))
SELECT currency, status, order_year, count(*) AS n_orders,
  CAST(100 * sum(CAST(amount AS DECIMAL(18,2))) AS BIGINT) AS amount,
  min(amount) AS least, max(amount) AS most,
  CAST(grouping_id(currency, status, order_year) AS BIGINT) AS level
FROM loads GROUP BY {groups}"""


def _fact_trips(vendor: str) -> str:
    return f"""WITH {_TRIPS}
SELECT l_orderkey, {vendor}, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID,
  trip_distance, total_amount, DATE '2026-01-28' AS processing_date,
  CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
  CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
  {_HMS} AS tpep_total_trip_time_str, secs AS tpep_total_trip_time_secs,
  md5(concat_ws('|', VendorID, tpep_pickup_datetime, PULocationID)) AS trip_id
FROM trips WHERE total_amount > 0 AND trip_distance > 0 AND source_month = pickup_month"""


ORACLE_SQL: dict[str, str] = {
    # Both loads hold the same rows, so the latest version is the second one.
    "fact_orders_left": f"""WITH {_CUSTOMERS}, {_ORDERS},
loads AS (
  SELECT *, DATE '2026-01-27' AS processing_date FROM oclean
  UNION ALL SELECT *, DATE '2026-01-28' AS processing_date FROM oclean),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY order_date DESC NULLS LAST, processing_date DESC) AS rn FROM loads)
SELECT o.order_id, o.amount, o.currency, o.status, o.order_date, o.customer_id,
  c.name, c.email, c.country, c.created_at, o.processing_date
FROM latest o LEFT JOIN clean c ON o.customer_id = c.customer_id WHERE o.rn = 1""",
    "fact_events_inner": f"""WITH {_CUSTOMERS}, {_EVENTS},
loads AS (
  SELECT *, DATE '2026-01-27' AS processing_date FROM eparsed
  UNION ALL SELECT *, DATE '2026-01-28' AS processing_date FROM eparsed),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY event_id
    ORDER BY event_timestamp DESC, processing_date DESC) AS rn
  FROM loads WHERE event_timestamp IS NOT NULL)
SELECT e.event_id, e.customer_id, c.name, c.email, c.country, e.event_type, c.created_at,
  e.event_timestamp, e.processing_date
FROM latest e JOIN clean c ON e.customer_id = c.customer_id WHERE e.rn = 1""",
    "dim_latest_customer": f"""WITH {_CUSTOMERS}, {_customer_ctes(_CHANGED_FEED, 'second_')},
loads AS (
  SELECT *, DATE '2026-01-27' AS processing_date FROM clean
  UNION ALL SELECT *, DATE '2026-01-28' AS processing_date FROM second_clean)
SELECT * FROM loads QUALIFY row_number() OVER (PARTITION BY customer_id
  ORDER BY processing_date DESC, created_at DESC) = 1""",
    "dedup_lineitem_latest": """SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
  l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
  l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
    "customers_clean": f"WITH {_CUSTOMERS} SELECT * FROM clean",
    "customers_clean_nullkey_parity": f"""WITH {_CUSTOMERS}
SELECT customer_id, name, email, country, created_at
FROM (SELECT * FROM ranked WHERE duplicate_regs = 1) r
  ANTI JOIN bad ON r.customer_id = bad.customer_id""",
    "customers_duplicates": f"""WITH {_CUSTOMERS}
SELECT *, 'Duplicated regs' AS error_reason FROM ranked WHERE duplicate_regs > 1""",
    "customers_invalid": _INVALID_CUSTOMERS,
    "orders_clean": f"WITH {_ORDERS} SELECT * FROM oclean",
    "orders_invalid": f"""WITH {_ORDERS}
SELECT *, 'null fields regs' AS error_reason FROM ofeed WHERE {_NULL_ORDER}""",
    "rank_heavy_event_types": """SELECT event_type, ts, event_id, row_number() OVER (
  PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS newest FROM events""",
    "orders_of_untainted_customers": """SELECT * FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM orders b WHERE b.o_custkey = o.o_custkey AND b.o_orderkey % 97 = 3)""",
    "normalise_event_type": f"WITH {_EVENTS} SELECT event_id, event_type FROM eparsed",
    "events_valid": _EVENTS_VALID,
    "events_rejected": _EVENTS_REJECTED,
    "bronze_partition_cols": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month, strftime(o_orderdate, '%m') AS month_text
FROM orders""",
    "silver_trip_duration": f"""WITH {_TRIPS}
SELECT l_orderkey, VendorID, secs, {_HMS} AS hms FROM trips""",
    "silver_trip_key": """SELECT event_id, md5(concat_ws('|', user_id, ts, event_type)) AS trip_id
FROM events""",
    "silver_positive_filter": f"""WITH {_TRIPS}
SELECT l_orderkey, VendorID, total_amount, trip_distance FROM trips
WHERE total_amount > 0 AND trip_distance > 0""",
    "customers_positive_balance": "SELECT * FROM customer WHERE c_acctbal > 0",
    "trips_with_static_dims": _STATIC_DIMS,
    "month_spine_load": """SELECT *, strftime(o_orderdate, '%Y-%m') AS source_month FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-10-01' AND o_orderdate < TIMESTAMP '1998-03-01'""",
    "trips_out_of_month": f"""WITH {_TRIPS}
SELECT l_orderkey, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID,
  trip_distance, total_amount, source_month
FROM trips WHERE source_month <> pickup_month""",
    "zone_dim_csv_roundtrip": "SELECT *, DATE '2026-01-28' AS processing_date FROM part",
    "json_array_roundtrip": ORDERS_FEED,
    "json_array_split": ORDERS_FEED,
    "dynamic_overwrite_reload": """SELECT * REPLACE (
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 0.0::DOUBLE ELSE o_totalprice END
    AS o_totalprice),
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""",
    "static_snapshot_reload": "SELECT *, DATE '2026-01-28' AS processing_date FROM orders",
    "rejects_csv_roundtrip": f"""SELECT *, DATE '2026-01-27' AS processing_date
FROM ({_INVALID_CUSTOMERS}) i""",
    "preview_events": "SELECT * FROM events ORDER BY event_id LIMIT 20",
    "lake_bad_csv_values": f"""WITH dirty AS (
  SELECT *, customer_id IS NOT NULL AND customer_id % 29 = 3 AS bad FROM ({CUSTOMERS_FEED}))
SELECT customer_id, name,
  CASE WHEN bad THEN concat(customer_id, ',', name, ',', email, ',', country, ',soon') END AS raw_line,
  'Missing data fields' AS error_reason
FROM dirty WHERE bad OR {_NULL_CUSTOMER}""",
    "lake_fact_orders": _fact_orders("2026-01-27"),
    "lake_dim_customer_merged": f"""WITH {_CUSTOMERS}, {_customer_ctes(_CHANGED_FEED, 'second_')},
loads AS (
  SELECT *, DATE '2026-01-27' AS processing_date FROM clean
  UNION ALL SELECT *, DATE '2026-01-28' AS processing_date FROM second_clean)
SELECT * FROM loads QUALIFY row_number() OVER (PARTITION BY customer_id
  ORDER BY processing_date DESC, created_at DESC) = 1""",
    "lake_fact_orders_merged": f"""WITH {_customer_ctes(_CHANGED_FEED)}, {_ORDERS},
{_order_ctes(_CHANGED_ORDERS, 'second_')},
loads AS (
  SELECT *, DATE '2026-01-27' AS processing_date FROM oclean
  UNION ALL SELECT *, DATE '2026-01-28' AS processing_date FROM second_oclean),
latest AS (
  SELECT * FROM loads QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY order_date DESC NULLS LAST, processing_date DESC) = 1)
SELECT o.order_id, o.amount, o.currency, o.status, o.order_date, o.customer_id,
  c.name, c.email, c.country, c.created_at, o.processing_date
FROM latest o LEFT JOIN clean c ON o.customer_id = c.customer_id""",
    "lake_fact_orders_as_of": f"""WITH {_CUSTOMERS}, {_customer_ctes(_CHANGED_FEED, 'second_')}, {_ORDERS},
states AS (
  SELECT *, DATE '{VERSION_LOADS[0]}' AS valid_from,
    CASE WHEN customer_id % 2 = 0 THEN DATE '{VERSION_LOADS[1]}' END AS valid_to FROM clean
  UNION ALL
  SELECT *, DATE '{VERSION_LOADS[1]}', NULL FROM second_clean WHERE customer_id % 2 = 0)
SELECT o.*, s.name, s.email, s.country, s.created_at, s.valid_from, DATE '2026-01-27' AS processing_date
FROM oclean o LEFT JOIN states s ON o.customer_id = s.customer_id AND order_date >= valid_from
  AND (valid_to IS NULL OR order_date < valid_to)""",
    "lake_masked_reports": f"""WITH {_CUSTOMERS}, {_ORDERS}
SELECT order_id, {_hmac("concat('mail', chr(0), email)")} AS email,
  {_hmac("concat('name', chr(0), name)")} AS name, c.customer_id AS found_by_email
FROM oclean o LEFT JOIN clean c ON o.customer_id = c.customer_id""",
    "lake_fact_events": _fact_events(""),
    "lake_fact_events_streaming": f"""WITH {_EVENTS}
SELECT DISTINCT customer_id, event_timestamp FROM eparsed WHERE event_timestamp IS NOT NULL""",
    "lake_first_events": f"""{_EVENTS_VALID} ORDER BY event_id LIMIT 20""",
    "lake_static_dims": _STATIC_DIMS,
    "lake_fact_trips": _fact_trips("VendorID"),
    "lake_trips_generations": _fact_trips(
        """CAST(VendorID AS BIGINT) AS VendorID,
  CASE WHEN source_month >= '2001-05' THEN CAST(l_orderkey % 8 * 0.25 AS DOUBLE) END AS airport_fee"""
    ),
    "stream_events_valid": _EVENTS_VALID,
    "stream_events_compacted": _EVENTS_VALID,
    "stream_events_rejected": _EVENTS_REJECTED,
    "stream_events_malformed": f"""WITH {_EVENTS}
SELECT event_id, raw_event_timestamp, CAST(NULL AS VARCHAR) AS raw_line,
  'Unparsable event timestamp' AS error_reason
FROM eparsed WHERE event_timestamp IS NULL
UNION ALL
SELECT NULL, NULL, concat('no json ', event_id), 'Unparsable event timestamp' FROM eparsed
WHERE CAST(substr(event_id, 2) AS BIGINT) % 23 = 5""",
    "stream_events_single_read": f"""WITH {_EVENTS}
SELECT event_id, customer_id, event_type, event_timestamp IS NOT NULL AS is_valid FROM eparsed""",
    "stream_dedup_watermark": """SELECT DISTINCT user_id AS customer_id, ts AS event_timestamp
FROM events""",
    "stream_customer_events": f"""WITH {_CUSTOMERS}, {_customer_ctes(_CHANGED_FEED, 'second_')}, {_EVENTS},
dims AS (SELECT *, 0 AS half FROM clean UNION ALL SELECT *, 1 AS half FROM second_clean)
SELECT event_id, e.customer_id, name, email, country, event_type, created_at, event_timestamp
FROM eparsed e JOIN dims d ON e.customer_id = d.customer_id
  AND half = CAST(event_timestamp >= TIMESTAMP '2024-01-15' AS INTEGER)
WHERE event_timestamp IS NOT NULL""",
    "stream_events_by_id": "SELECT event_id FROM events",
    "stream_audit": """WITH first_load AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15'),
mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS watermark, max(ts) AS newest FROM first_load)
SELECT count(*) AS rows_in, count(*) AS kept, CAST(0 AS BIGINT) AS duplicates, CAST(0 AS BIGINT) AS late
FROM first_load
UNION ALL
SELECT 2 * count(*), count(*) FILTER (ts > newest),
  2 * count(*) FILTER (ts > watermark AND ts <= newest) + count(*) FILTER (ts > newest),
  2 * count(*) FILTER (ts <= watermark)
FROM events, mark""",
    "report_orders_rollup": _report("ROLLUP (currency, status, order_year)"),
    "report_orders_sets": _report("GROUPING SETS ((status, order_year), (currency), (order_year))"),
    "order_rule_counts": f"""WITH ofeed AS ({ORDERS_FEED})
SELECT unnest(['rows', 'no_customer', 'negative_amount', 'unknown_status', 'no_date']) AS rule,
  unnest([count(*), count(*) FILTER (customer_id IS NULL), count(*) FILTER (amount < 0),
    count(*) FILTER (lower(status) NOT IN ('completed', 'cancelled')),
    count(*) FILTER (order_date = 'bogus')]) AS broken
FROM ofeed""",
}
