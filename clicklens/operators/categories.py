"""Q1: hot categories ranked by (clicks, orders, payments)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.defaults import TOP_CATEGORIES
from clicklens.functions.columns import csv_ids, non_blank

METRICS = ("click", "order", "pay")


def action_routing(visits: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (category_id, metric) occurrence.

    A row is *one* kind of action, first match wins: a click (``click_category_id != -1``; null is
    treated as -1), else an order (non-blank ``order_category_ids``), else a payment. Every id of a
    comma list counts, duplicates included. ``category_id`` is a string, as the lists are.
    """
    click_id = F.coalesce(F.col("click_category_id"), F.lit(-1))
    is_click = click_id != -1
    is_order = non_blank("order_category_ids")
    is_pay = non_blank("pay_category_ids")
    metric = F.when(is_click, F.lit("click")).when(is_order, F.lit("order")).when(is_pay, F.lit("pay"))
    ids = (F.when(is_click, F.array(click_id.cast("string")))
           .when(is_order, csv_ids("order_category_ids"))
           .when(is_pay, csv_ids("pay_category_ids")))
    # one kind per row: explode its id list next to the kind (a row with no kind has no ids)
    return visits.select(*keep, F.explode(ids).alias("category_id"), metric.alias("metric"))


def category_metric_counts(visits: DataFrame) -> DataFrame:
    """A2: (category_id, metric, n) -- the accumulator's ``"<cat>-<metric>" -> count`` map as rows.

    A map-side partial aggregate collapses each task's rows to at most (#categories x 3) before the
    shuffle, so a hot category costs nothing extra.
    """
    return action_routing(visits).groupBy("category_id", "metric").agg(F.count(F.lit(1)).alias("n"))


def category_metric_pivot(visits: DataFrame) -> DataFrame:
    """A3: (category_id, click_count, order_count, pay_count), a missing metric is 0. One aggregate."""
    routed = action_routing(visits)
    return routed.groupBy("category_id").agg(
        *[F.count_if(F.col("metric") == m).alias(f"{m}_count") for m in METRICS])


def hot_category_top10(visits: DataFrame, n: int = TOP_CATEGORIES, task_id: str | None = None) -> DataFrame:
    """Q1 (T1, X8): the top ``n`` categories by click, then order, then pay count (all desc).

    Ties, arbitrary in the reference, are broken by ``category_id`` ascending. ``orderBy + limit`` is
    planned as TakeOrderedAndProject: each task keeps its own top ``n``; no global sort.
    ``task_id`` (one value per run) is stamped on every row when given.
    """
    ranked = (category_metric_pivot(visits)
              .orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id"))
              .limit(n))
    if task_id is not None:
        ranked = ranked.select(F.lit(task_id).alias("task_id"), *ranked.columns)
    return ranked
