"""Q2: the most active sessions inside each hot category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.defaults import TOP_CATEGORIES, TOP_SESSIONS
from clicklens.operators.categories import hot_category_top10
from clicklens.operators.common import top_n_per_group


def clicks(visits: DataFrame) -> DataFrame:
    """click rows as (category_id string, session_id)."""
    cid = F.coalesce(F.col("click_category_id"), F.lit(-1))
    return visits.filter(cid != -1).select(cid.cast("string").alias("category_id"), "session_id")


def top_category_clicks(visits: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks whose category is one of ``top`` (a semi join).

    ``top`` is a ranked top-N result (``limit``), so its size is bounded by N and broadcasting it is
    safe; the click side is never shuffled for this join.
    """
    return clicks(visits).join(F.broadcast(top.select("category_id")), "category_id", "left_semi")


def category_session_counts(click_rows: DataFrame) -> DataFrame:
    """A4: (category_id, session_id, click_count)."""
    return click_rows.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))


def hot_category_session_top10(visits: DataFrame, n_categories: int = TOP_CATEGORIES,
                               n_sessions: int = TOP_SESSIONS,
                               top: DataFrame | None = None) -> DataFrame:
    """Q2 (W3): the top ``n_sessions`` sessions by clicks in each of Q1's top ``n_categories``.

    Shares Q1's plan instead of re-running it; ties on the count go to ``session_id`` ascending.
    The per-category limit is a partial WindowGroupLimit, so even a category with billions of sessions
    ships only ``n_sessions`` rows per task to its final ranking.
    """
    if top is None:
        top = hot_category_top10(visits, n_categories)
    counts = category_session_counts(top_category_clicks(visits, top))
    return top_n_per_group(counts, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n_sessions)
