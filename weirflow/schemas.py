"""Declared schemas and fixed values of the datasets."""

from __future__ import annotations

from pyspark.sql import types as T

# Input columns and types of the three feeds.
CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("created_at", T.DateType()),
    ]
)

ORDERS = T.StructType(
    [
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("event_timestamp", T.StringType()),
        T.StructField("event_type", T.StringType()),
    ]
)

# The cleaned events as the streaming fact reads them. ``processing_date`` is
# declared so that the stream also starts on an empty directory.
CLEAN_EVENTS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("processing_date", T.DateType()),
    ]
)

VENDOR = T.StructType(
    [T.StructField("vendor_id", T.LongType()), T.StructField("vendor_name", T.StringType())]
)

RATE_CODE = T.StructType(
    [
        T.StructField("rate_code_id", T.LongType()),
        T.StructField("rate_code_desc", T.StringType()),
    ]
)

# The rows of the two static dimensions.
VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "VeriFone Inc."),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]

# Reject reasons.
REASON_DUPLICATE = "Duplicated regs"
REASON_MISSING = "Missing data fields"
REASON_NULLS = "null fields regs"
# Reasons of our own, for rejects that would otherwise carry none.
REASON_TIMESTAMP = "Unparsable event timestamp"
REASON_ORDER_DATE = "Unparsable order date"
REASON_MONTH = "Outside the month of its file"
