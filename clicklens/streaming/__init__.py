"""Streaming jobs. Functions and processors that run in tasks travel with the job, so executors need no copy of the package."""

import sys

from pyspark import cloudpickle

from clicklens.streaming.jobs import (
    ads_arrival_trend_stream,
    ads_area_top3_stream,
    ads_click_daily_stream,
    ads_window_stream,
    blacklist_stream,
    clicks_from,
    dropped_rows,
    line_counts,
    read_ads_area_top3,
    read_ads_arrival_trend,
    read_ads_click_daily,
    read_ads_windows,
    read_bad_lines,
    read_blacklist,
    read_blacklist_counts,
    read_clicks,
    read_counter_state,
    split_lines_stream,
)

__all__ = [
    "ads_area_top3_stream", "ads_arrival_trend_stream", "ads_click_daily_stream", "ads_window_stream",
    "blacklist_stream", "clicks_from", "dropped_rows", "line_counts", "read_ads_area_top3",
    "read_ads_arrival_trend", "read_ads_click_daily", "read_ads_windows", "read_bad_lines", "read_blacklist",
    "read_blacklist_counts", "read_clicks", "read_counter_state", "split_lines_stream",
]

cloudpickle.register_pickle_by_value(sys.modules[__name__])
