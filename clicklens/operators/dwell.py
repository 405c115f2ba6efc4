"""Q8: average dwell time per page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.functions.columns import epoch_seconds_ntz
from clicklens.operators.pageflow import session_pairs


def page_dwell(visits: DataFrame, slice_width_s: int | None = 60, hot_sample: float | None = 0.001,
               rows_per_slice: int = 1_000_000) -> DataFrame:
    """W2 (X4, X6): (session_id, page_id, dwell_ms) = next action time - this one, in ms.

    Times count at second precision, as the reference parses ``yyyy-MM-dd HH:mm:ss``. The last action
    of a session has no successor and contributes nothing.
    """
    nxt = session_pairs(visits, ["action_time"], ["page_id"], slice_width_s, hot_sample,
                        rows_per_slice=rows_per_slice)
    dwell = (epoch_seconds_ntz("next_action_time") - epoch_seconds_ntz("action_time")) * F.lit(1000)
    return nxt.select("session_id", "page_id", dwell.cast("long").alias("dwell_ms"))


def page_avg_dwell(visits: DataFrame, slice_width_s: int | None = 60,
                   hot_sample: float | None = 0.001, rows_per_slice: int = 1_000_000) -> DataFrame:
    """Q8 (A8): (page_id, avg_ms) -- integer mean (``sum div count``) of the dwell times."""
    d = page_dwell(visits, slice_width_s, hot_sample, rows_per_slice)
    return d.groupBy("page_id").agg(F.expr("sum(dwell_ms) div count(dwell_ms)").alias("avg_ms"))
