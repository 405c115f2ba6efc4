"""Declared schemas of the inputs and results (no inference anywhere)."""

from pyspark.sql import types as T

# Declared schemas of the driver tables the queries read (fixed values; same at every scale factor).
# Reading with a declared schema skips Spark's footer-reading inference job.
DRIVER_TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# The visit log: one row per user action (the reference's 13-column fact, minus unused columns
# that no operator reads; extra columns pass through untouched).
VISIT_LOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.TimestampNTZType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

# One ad click, as parsed from a log line ``epoch_ms area city userid adid``.
ADS_LOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("dt", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("userid", T.StringType()),
    T.StructField("adid", T.StringType()),
])

CATEGORY_TOP10 = ["category_id", "click_count", "order_count", "pay_count"]
CATEGORY_SESSION_TOP10 = ["category_id", "session_id", "click_count"]
PAGE_CONVERSION = ["from_page", "to_page", "num", "den", "rate"]
PAGE_AVG_DWELL = ["page_id", "avg_ms"]
ADS_CLICK_DAILY = ["dt", "area", "city", "adid", "clicks"]
ADS_AREA_TOP3_JSON = ["dt", "area", "top3"]
ADS_TREND = ["bucket", "clicks"]
BLACKLIST = ["userid", "since"]
