"""Q3: single-hop page conversion along a target flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clicklens.functions.columns import epoch_seconds_ntz
from clicklens.operators.common import hot_slices, next_in_session, slice_number

SESSION_ORDER = ("action_time", "event_id")


def parse_flow(pages: str | Sequence) -> list[int]:
    """``"1,2,3"`` (or a list) -> [1, 2, 3]."""
    items = pages.split(",") if isinstance(pages, str) else list(pages)
    return [int(str(p).strip()) for p in items if str(p).strip()]


def flow_pairs(pages: str | Sequence) -> list[tuple[int, int]]:
    """consecutive pairs of the flow, ``zip(tail)``, without repeats: 1,2,3 -> (1,2), (2,3)."""
    ids = parse_flow(pages)
    return list(dict.fromkeys(zip(ids, ids[1:])))


def target_flow(spark: SparkSession, pages: str | Sequence) -> DataFrame:
    """F9 as a DataFrame (from_page, to_page). Its size is bounded by the parameter, not the data."""
    pairs = flow_pairs(pages)
    return spark.createDataFrame(pairs, "from_page long, to_page long")


def session_slice(width_s: int = 60) -> Column:
    """The skew slice of ``next_in_session``: the ``width_s``-second bucket of ``action_time``."""
    return F.floor(epoch_seconds_ntz("action_time") / F.lit(width_s)).cast("long")


def session_pairs(visits: DataFrame, carry: Sequence[str], extra: Sequence[str] = (),
                  slice_width_s: int | None = 60, hot_sample: float | None = 0.001,
                  keep_last: bool = False, rows_per_slice: int = 1_000_000) -> DataFrame:
    """Each action with the next action of its session (see ``next_in_session``).

    ``slice_width_s=None``: one plain window over every session. ``hot_sample=None``: every session
    is cut into fixed ``slice_width_s`` slices. Default: only sessions of more than ``rows_per_slice`` rows,
    by a ``hot_sample`` fraction of the rows (chosen by content), are cut, each into slices of about
    so many rows, also within one time; the rest are one slice each.
    """
    if not slice_width_s:
        return next_in_session(visits, "session_id", SESSION_ORDER, carry, None, extra, None, keep_last)
    if not hot_sample:
        return next_in_session(visits, "session_id", SESSION_ORDER, carry, session_slice(slice_width_s),
                               extra, None, keep_last)
    hot = hot_slices(visits, "session_id", SESSION_ORDER, hot_sample, rows_per_slice)
    number = F.when(F.col("_bounds").isNotNull(), slice_number(SESSION_ORDER))
    return next_in_session(visits, "session_id", SESSION_ORDER, carry, number, extra, hot, keep_last)


def page_visits(visits: DataFrame, pages: str | Sequence) -> DataFrame:
    """F5 + A5: visits of each target page -- the denominator, session-final visits included."""
    ids = parse_flow(pages)
    return (visits.filter(F.col("page_id").isin(ids))
            .groupBy("page_id").agg(F.count(F.lit(1)).alias("visits")))


def page_steps(visits: DataFrame, slice_width_s: int | None = 60, hot_sample: float | None = 0.001,
               rows_per_slice: int = 1_000_000) -> DataFrame:
    """(session_id, from_page, to_page) for every consecutive pair of actions of a session.

    Pairs are taken over *all* pages in time order before any target filter (1 -> 9 -> 2 is not a
    1 -> 2 hop). Ties in time go to ``event_id``.
    """
    nxt = session_pairs(visits, ["page_id"], (), slice_width_s, hot_sample, rows_per_slice=rows_per_slice)
    return nxt.select("session_id", F.col("page_id").alias("from_page"), F.col("next_page_id").alias("to_page"))


def hop_filter(pages: str | Sequence) -> Column:
    """``(from_page, to_page)`` is one of the flow's hops -- an IN list bounded by the parameter."""
    return F.struct("from_page", "to_page").isin(
        [F.struct(F.lit(a).cast("long").alias("from_page"), F.lit(b).cast("long").alias("to_page"))
         for a, b in flow_pairs(pages)])


def page_transitions(visits: DataFrame, pages: str | Sequence | None = None,
                     slice_width_s: int | None = 60, hot_sample: float | None = 0.001,
                     rows_per_slice: int = 1_000_000) -> DataFrame:
    """A6 (+F6): (from_page, to_page, num); transitions that never occur have no row.

    ``pages`` (a target flow) keeps only its hops; the predicate runs before the partial aggregate.
    """
    steps = page_steps(visits, slice_width_s, hot_sample, rows_per_slice)
    if pages is not None:
        steps = steps.filter(hop_filter(pages))
    return steps.groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("num"))


def page_conversion(visits: DataFrame, pages: str | Sequence, include_zero: bool = False,
                    slice_width_s: int | None = 60, hot_sample: float | None = 0.001,
                    rows_per_slice: int = 1_000_000) -> DataFrame:
    """Q3 (F6, A7, J3): (from_page, to_page, num, den, rate) for the hops of the target flow.

    ``den`` counts every visit of ``from_page``; ``rate = num / den`` as a double. With
    ``include_zero`` every target hop is listed, unseen ones with ``num = 0``.

    One count: the session window returns every visit once (the last of a session with no next
    page), so a single (page, next page) count over the target pages yields both the numerator
    (the hops) and the denominator (the sum over a page's rows, a window over that tiny aggregate).
    Next pages that form no hop count together as null, so the aggregate's size follows the flow. The
    sample that finds hot sessions is a second, narrow scan.
    """
    ids = parse_flow(pages)
    steps = session_pairs(visits, ["page_id"], (), slice_width_s, hot_sample, keep_last=True,
                          rows_per_slice=rows_per_slice)
    hops = steps.filter(F.col("page_id").isin(ids)).select(F.col("page_id").alias("from_page"), F.col("next_page_id").alias("to_page"))
    per = (hops.select("from_page", F.when(hop_filter(pages), F.col("to_page")).alias("to_page"))
           .groupBy("from_page", "to_page")
           .agg(F.count(F.lit(1)).alias("num"))
           .withColumn("den", F.sum("num").over(Window.partitionBy("from_page"))))
    out = per.filter(F.col("to_page").isNotNull())
    if include_zero:
        # unseen hops need their page's denominator too: a second (small) read of the aggregate
        den = per.groupBy("from_page").agg(F.max("den").alias("den"))
        pairs = target_flow(visits.sparkSession, pages)
        out = (F.broadcast(pairs).join(out.drop("den"), ["from_page", "to_page"], "left").fillna(0, ["num"])
               .join(F.broadcast(den), "from_page", "left"))
    # the reference's default denominator 1 is unreachable for a seen hop: its from_page was visited
    den_c = F.coalesce(F.col("den"), F.lit(1)).cast("long")
    return out.select("from_page", "to_page", F.col("num").cast("long").alias("num"), den_c.alias("den"),
                      (F.col("num").cast("double") / den_c).alias("rate"))
