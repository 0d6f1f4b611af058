"""Explicit schemas for every source and report table (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

# S1: monthly usage, one or more rows per product and month.
USAGE = T.StructType([
    T.StructField("product", T.StringType(), False),
    T.StructField("month", T.DateType(), False),
    T.StructField("tier", T.StringType(), True),
    T.StructField("total_customer", T.LongType(), True),
    T.StructField("mau", T.LongType(), True),
    T.StructField("ratio", T.DoubleType(), True),
])

# S2: orders, one row per order.
ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), True),
    T.StructField("order_created_date", T.DateType(), True),
    T.StructField("fulfillment_status", T.StringType(), True),
    T.StructField("product", T.StringType(), True),
    T.StructField("regional", T.StringType(), True),
    T.StructField("nation", T.StringType(), True),
])

# S3: daily cumulative counters per customer type.
DAILY_METRICS = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("customer_type", T.StringType(), True),
    T.StructField("cumulative_a", T.LongType(), True),
    T.StructField("cumulative_b", T.LongType(), True),
    T.StructField("cumulative_c", T.LongType(), True),
    T.StructField("cumulative_d", T.LongType(), True),
])

# S4: raw traffic events.
TRAFFIC_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("property", T.StringType(), False),
])

# K6 output: traffic metrics per property and period.
TRAFFIC_METRICS = T.StructType([
    T.StructField("property", T.StringType(), False),
    T.StructField("period", T.StringType(), False),
    T.StructField("period_start", T.DateType(), False),
    T.StructField("total_users", T.LongType(), False),
    T.StructField("page_views", T.LongType(), False),
    T.StructField("sessions", T.LongType(), False),
    T.StructField("engaged_sessions", T.LongType(), False),
    T.StructField("engagement_rate", T.DoubleType(), True),
    T.StructField("bounce_rate", T.DoubleType(), True),
    T.StructField("avg_session_duration", T.DoubleType(), True),
])

# Report tables.
LABEL_SUFFIX = T.StructType([
    T.StructField("label", T.StringType(), False),
    T.StructField("suffix", T.StringType(), False),
])
SLOTS = T.StructType([
    T.StructField("report_id", T.StringType(), False),
    T.StructField("slot", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
])
PLACEHOLDERS = T.StructType([
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("placeholder", T.StringType(), False),
    T.StructField("slot", T.StringType(), False),
])
TEMPLATES = T.StructType([
    T.StructField("deck_id", T.StringType(), False),
    T.StructField("template_id", T.StringType(), False),
    T.StructField("text", T.StringType(), False),
])
