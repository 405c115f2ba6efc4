"""The registered queries: each a ``(spark, sf_dir) -> DataFrame`` over the driver's tables.

Parameters match ``clicklens.plans.oracle`` (flow ``1..7``, blacklist threshold 3 -- at most ~10
clicks per user-day exist in the tables, so the reference's 100 would list nobody). Timestamps are
returned as formatted strings so that both engines compare the same text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens import operators as op
from clicklens.plans.oracle import FLOW, RANGE, THRESHOLD
from clicklens.sources import adlines, tables

TS_US = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_MS = "yyyy-MM-dd HH:mm:ss.SSS"

Query = Callable[[SparkSession, str], DataFrame]


def _visits(spark: SparkSession, sf: str) -> DataFrame:
    return tables.visit_log(spark, sf)


def _visit_cols(df: DataFrame) -> DataFrame:
    return df.select("event_id", "date", "user_id", "session_id", "page_id",
                     F.date_format("action_time", TS_US).alias("action_time"),
                     "click_category_id", "order_category_ids", "pay_category_ids")


def _text_times(df: DataFrame) -> DataFrame:
    """The log with its times as text, as the reference's log has them."""
    return df.withColumn("action_time", F.date_format("action_time", "yyyy-MM-dd HH:mm:ss"))


def _typed(df: DataFrame) -> DataFrame:
    """SRC2: the log bound by name to the reference's full 13-column schema (absent columns null)."""
    from clicklens.schemas import VISIT_LOG
    t = tables.bind_schema(df, VISIT_LOG)
    return t.withColumn("action_time", F.date_format("action_time", TS_US))


def _user_ad_day(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks per (dt, adid, userid) straight from ``events``: the early aggregate every ad counter
    starts from. A hot user collapses to one row per (day, ad) before the geography join."""
    return op.ad_user_daily_counts(tables.ad_clicks(spark, sf))


def _ads_counted(spark: SparkSession, sf: str) -> DataFrame:
    """(dt, adid, userid, area, city, clicks): pre-counted clicks with their geography."""
    return tables.with_geo(_user_ad_day(spark, sf), tables.geo_dim(spark, sf))


def _with_since_text(df: DataFrame) -> DataFrame:
    return df.select("userid", F.date_format("since", TS_MS).alias("since"))


def batch_queries() -> dict[str, Query]:
    lo, hi = RANGE
    n = THRESHOLD
    return {
        # sources and filters (SRC1, SRC2, F1, A1)
        "visit_log": lambda s, d: _visit_cols(_visits(s, d)),
        "visit_date_range": lambda s, d: _visit_cols(tables.visit_log(s, d, lo, hi)),
        "visit_row_count": lambda s, d: _visits(s, d).agg(F.count(F.lit(1)).alias("n")),
        "visit_log_typed": lambda s, d: _typed(_visits(s, d)),
        # Q1 (F2-F4, X1, E1, A2, A3, T1)
        "action_routing": lambda s, d: op.action_routing(_visits(s, d), keep=["event_id"]),
        "category_metric_counts": lambda s, d: op.category_metric_counts(_visits(s, d)),
        "category_metric_pivot": lambda s, d: op.category_metric_pivot(_visits(s, d)),
        "hot_category_top10": lambda s, d: op.hot_category_top10(_visits(s, d)),
        "category_top10_stamped": lambda s, d: op.hot_category_top10(_visits(s, d), task_id="run-1"),
        "hot_category_top10_ranged": lambda s, d: op.hot_category_top10(tables.visit_log(s, d, lo, hi)),
        # Q2 (J1, A4, W3)
        "top_category_clicks": lambda s, d: op.top_category_clicks(
            _visits(s, d), op.hot_category_top10(_visits(s, d))),
        "category_session_counts": lambda s, d: op.category_session_counts(
            op.top_category_clicks(_visits(s, d), op.hot_category_top10(_visits(s, d)))),
        "hot_category_session_top10": lambda s, d: op.hot_category_session_top10(_visits(s, d)),
        "hot_category_session_top10_ranged": lambda s, d: op.hot_category_session_top10(
            tables.visit_log(s, d, lo, hi)),
        # Q3 (F5, F6, F9, W1, J3, J4, A5-A7)
        "page_visits": lambda s, d: op.page_visits(_visits(s, d), FLOW),
        "page_transitions": lambda s, d: op.page_transitions(_visits(s, d)),
        "page_conversion": lambda s, d: op.page_conversion(_visits(s, d), FLOW),
        "page_conversion_all_hops": lambda s, d: op.page_conversion(_visits(s, d), FLOW, include_zero=True),
        "page_conversion_ranged": lambda s, d: op.page_conversion(tables.visit_log(s, d, lo, hi), FLOW),
        # Q8 (W2, X4, X6, A8)
        "page_dwell": lambda s, d: op.page_dwell(_visits(s, d)),
        "page_dwell_text": lambda s, d: op.page_dwell(tables.visit_actions(_text_times(_visits(s, d)))),
        "page_avg_dwell": lambda s, d: op.page_avg_dwell(_visits(s, d)),
        "page_avg_dwell_ranged": lambda s, d: op.page_avg_dwell(tables.visit_log(s, d, lo, hi)),
        # ad log (SNK8, X2, X3, X10)
        "ads_log": lambda s, d: tables.ads_log(s, d).select(
            "event_id", F.date_format("ts", TS_US).alias("ts"), "dt", "area", "city", "userid", "adid"),
        "ads_log_parse": lambda s, d: adlines.parse_lines(adlines.encode_lines(tables.ads_log(s, d))).select(
            "event_id", F.date_format("ts", TS_MS).alias("ts"), "dt", "area", "city", "userid", "adid"),
        # Q5 / Q6 (A9, A10, W3, X7)
        "ad_user_daily_counts": lambda s, d: _user_ad_day(s, d),
        "ads_click_daily": lambda s, d: op.ads_click_daily(_ads_counted(s, d)),
        "ads_area_rollup": lambda s, d: op.ads_area_rollup(_ads_counted(s, d)),
        "ads_area_top3": lambda s, d: op.ads_area_top3(_ads_counted(s, d)),
        "ads_area_top3_json": lambda s, d: op.ads_area_top3_json(_ads_counted(s, d)),
        # Q7 (X5, T2, ST4)
        "ads_trend_10s": lambda s, d: op.ads_trend_10s(tables.ad_clicks(s, d)),
        "ads_sliding_60s": lambda s, d: op.ads_sliding_60s(tables.ad_clicks(s, d)),
        "ads_last_minute": lambda s, d: op.ads_trend_10s(tables.ad_clicks(s, d, last_s=60)),
        # Q4 (ST2, F7, J2, ST8)
        "blacklist_users": lambda s, d: _with_since_text(op.blacklist_users(tables.ad_clicks(s, d), n)),
        "blacklist_filtered_counts": lambda s, d: op.blacklist_filtered_counts(tables.ad_clicks(s, d), n),
        "blacklist_users_by_batch": lambda s, d: op.blacklist_users_by_batch(
            tables.ad_clicks(s, d).withColumn("batch", F.col("event_id") % 5), n),
        "blacklist_filtered_counts_by_batch": lambda s, d: op.blacklist_filtered_counts_by_batch(
            tables.ad_clicks(s, d).withColumn("batch", F.col("event_id") % 5), n),
    }


def queries() -> dict[str, Query]:
    q = batch_queries()
    from clicklens.plans import replays
    q.update(replays.stream_queries())
    return q


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship: Q1, the top-10 hot categories."""
    return op.hot_category_top10(tables.visit_log(spark, sf_dir))


__all__ = ["queries", "batch_queries", "entry"]
