"""Q5-Q7 on ad clicks: daily counters, top ads per area, 10-second trend and sliding minute.

Every operator accepts either raw clicks (one row per click) or pre-counted rows carrying a
``clicks`` column (e.g. ``ad_user_daily_counts``); counts are additive, so a plan can aggregate
early -- before a join or a window expansion -- and finish with the same operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.defaults import TOP_ADS, TREND_SLIDE_S, TREND_WINDOW_S
from clicklens.functions.columns import TS_FORMAT, floor_seconds, ranked_json
from clicklens.operators.common import top_n_per_group


def _weight(df: DataFrame) -> Column:
    return F.col("clicks") if "clicks" in df.columns else F.lit(1)


def _count(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(_weight(df)).cast("long").alias("clicks"))


def ad_user_daily_counts(ads: DataFrame) -> DataFrame:
    """ST2 (batch form): clicks per (dt, adid, userid) -- the blacklist counter, never expiring."""
    return _count(ads, "dt", "adid", "userid")


def ads_click_daily(ads: DataFrame) -> DataFrame:
    """Q5 (A9): clicks per (dt, area, city, adid)."""
    return _count(ads, "dt", "area", "city", "adid")


def ads_area_rollup(ads: DataFrame) -> DataFrame:
    """A10: clicks per (dt, area, adid) -- the city dropped."""
    return _count(ads, "dt", "area", "adid")


def ads_area_top3(ads: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """Q6 (W3): the ``n`` most clicked ads of each (dt, area), with their rank; ties -> smaller adid."""
    return top_n_per_group(ads_area_rollup(ads), ["dt", "area"], [F.desc("clicks"), F.asc("adid")], n,
                           rank_col="rank")


def ads_area_top3_json(ads: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """Q6 (X7): (dt, area, top3) with ``top3`` a JSON object ``{"adid": clicks, ...}`` in rank order."""
    top = ads_area_top3(ads, n)
    return top.groupBy("dt", "area").agg(ranked_json("rank", "adid", "clicks").alias("top3"))


def trend_buckets(ads: DataFrame, width_s: int = TREND_SLIDE_S) -> DataFrame:
    """Clicks per ``width_s``-second bucket start (an instant); the shared pre-aggregate of Q7."""
    return _count(ads, floor_seconds("ts", width_s).alias("bucket_ts"))


def ads_trend_10s(ads: DataFrame, width_s: int = TREND_SLIDE_S) -> DataFrame:
    """(bucket ``yyyy-MM-dd HH:mm:s0``, clicks) for every non-empty bucket, ascending."""
    b = trend_buckets(ads, width_s)
    return b.select(F.date_format("bucket_ts", TS_FORMAT).alias("bucket"), "clicks").orderBy("bucket")


def ads_sliding_60s(ads: DataFrame, window_s: int = TREND_WINDOW_S, slide_s: int = TREND_SLIDE_S) -> DataFrame:
    """ST4 (batch form): (win_start, win_end, clicks) for every sliding event-time window.

    Same windows as ``F.window(ts, "60 seconds", "10 seconds")``, but counted per slide bucket first
    and only then fanned out to the ``window_s / slide_s`` windows each bucket belongs to, so the
    expansion runs over buckets, not over clicks.
    """
    if window_s % slide_s:
        raise ValueError("window_s must be a multiple of slide_s")
    k = window_s // slide_s
    b = trend_buckets(ads, slide_s)
    fan = b.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_k"), "bucket_ts", "clicks")
    start = F.timestamp_seconds(F.unix_seconds("bucket_ts") - F.col("_k") * F.lit(slide_s))
    w = fan.groupBy(start.alias("ws")).agg(F.sum("clicks").cast("long").alias("clicks"))
    return w.select(F.date_format("ws", TS_FORMAT).alias("win_start"),
                    F.date_format(F.timestamp_seconds(F.unix_seconds("ws") + F.lit(window_s)), TS_FORMAT)
                    .alias("win_end"),
                    "clicks")


def ads_last_minute(ads: DataFrame, window_s: int = TREND_WINDOW_S, slide_s: int = TREND_SLIDE_S) -> DataFrame:
    """Q7: the newest ``window_s`` window aligned to ``slide_s`` -- at most ``window_s/slide_s`` buckets.

    The window ends at floor(max ts) + slide; the newest timestamp is a scalar subquery, so the
    filter runs on the executors and nothing is collected to the driver.
    """
    newest = ads.agg(F.max("ts").alias("m")).scalar()
    lower = F.timestamp_seconds(F.floor(F.unix_seconds(newest) / F.lit(slide_s)) * F.lit(slide_s)
                                - F.lit(window_s - slide_s))
    return ads_trend_10s(ads.filter(F.col("ts") >= lower), slide_s)
