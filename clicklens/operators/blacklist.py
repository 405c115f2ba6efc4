"""Q4: the dynamic ad-click blacklist, as exact batch operators.

Rule (reference): a user whose click count on one ad on one day reaches ``threshold`` (>=) is listed,
and from then on all of the user's clicks -- every ad, every day -- are dropped before counting.

The feedback looks circular but is not: before a user is listed, nothing of theirs is dropped, so
the moment of listing is the earliest time at which *any* of their (day, ad) groups reaches its
``threshold``-th click. Two orderings define "earlier":

* ``event_time`` -- by event time (``ts``, then ``event_id``); independent of how a stream was cut
  into micro-batches, so a stream and its batch twin agree exactly.
* ``micro_batch`` -- by arrival batch: the reference's behaviour, where a batch's counts are merged
  first and the list filters the *next* batch onwards.

Only the first ``threshold`` clicks of a group can matter (later ones fall after the listing), so the
event-time form keeps at most ``threshold`` rows per group with a per-group limit that is applied
before the shuffle: a hot (user, day, ad) costs the same as any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.defaults import BLACKLIST_THRESHOLD
from clicklens.operators.common import top_n_per_group

GROUP = ("dt", "adid", "userid")
EVENT_ORDER = ("ts", "event_id")


def first_clicks(ads: DataFrame, threshold: int = BLACKLIST_THRESHOLD, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """The first ``threshold`` clicks of every (dt, adid, userid), numbered ``rn`` in event order."""
    cols = list(dict.fromkeys([*GROUP, *order]))
    return top_n_per_group(ads.select(*cols), GROUP, [F.col(c) for c in order], threshold, "rn")


def _key(order: Sequence[str]):
    return F.struct(*[F.col(c) for c in order])


def blacklist_users(ads: DataFrame, threshold: int = BLACKLIST_THRESHOLD, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Q4/F7 (event time): (userid, since) -- ``since`` is the time of the click that listed the user."""
    first = first_clicks(ads, threshold, order)
    hit = first.filter(F.col("rn") == threshold)
    # the tie-break columns cannot change the earliest time itself, so a plain min keeps this a hash
    # aggregate (a struct min would force a sort aggregate)
    return hit.groupBy("userid").agg(F.min(order[0]).alias("since"))


def blacklist_filtered_counts(ads: DataFrame, threshold: int = BLACKLIST_THRESHOLD,
                              order: Sequence[str] = EVENT_ORDER, prior: DataFrame | None = None) -> DataFrame:
    """J2/ST8 (event time): (dt, adid, userid, clicks) counting only clicks not yet dropped.

    A listed user's clicks up to and including the listing click count; later ones are dropped. Only
    the per-group limited rows (at most ``threshold`` per (day, ad)) take part. The listing key (one
    row per listed user) is joined back rather than spread with a window over ``userid``: a user with
    clicks on a huge number of (day, ad) pairs is then a skewed join partition that AQE splits (or
    the listed users are broadcast when small), not one task holding all of that user's rows.

    ``prior`` (userid, since) lists users already listed before ``ads`` begins (a stream's settled
    days): their clicks after ``since`` are dropped as well.
    """
    first = first_clicks(ads, threshold, order)
    k = _key(order)
    listed = (first.filter(F.col("rn") == threshold).groupBy("userid").agg(F.min(k).alias("_since")))
    kept = first.join(listed, "userid", "left").filter(F.col("_since").isNull() | (k <= F.col("_since")))
    if prior is not None:
        earlier = prior.select("userid", F.col("since").alias("_prior"))
        kept = kept.join(earlier, "userid", "left").filter(
            F.col("_prior").isNull() | (F.col(order[0]) <= F.col("_prior")))
    return kept.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("clicks"))


def _batch_counts(ads: DataFrame, threshold: int, batch_col: str) -> tuple[DataFrame, DataFrame]:
    """Per (group, batch) counts with their running total, and (userid, since_batch) of listed users."""
    c = ads.groupBy(*GROUP, batch_col).agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.partitionBy(*GROUP).orderBy(batch_col)
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    c = c.withColumn("_running", running)
    listed = (c.filter(F.col("_running") >= threshold).groupBy("userid")
              .agg(F.min(batch_col).alias("since_batch")))
    return c, listed


def blacklist_users_by_batch(ads: DataFrame, threshold: int = BLACKLIST_THRESHOLD, batch_col: str = "batch") -> DataFrame:
    """Q4 (micro-batch): (userid, since_batch) -- the first batch after which a counter was >= threshold.

    Counts are pre-aggregated per (group, batch) before the running-total window, so no window ever
    sees raw clicks, and a group's window holds one row per batch.
    """
    return _batch_counts(ads, threshold, batch_col)[1]


def blacklist_filtered_counts_by_batch(ads: DataFrame, threshold: int = BLACKLIST_THRESHOLD,
                                       batch_col: str = "batch") -> DataFrame:
    """J2/ST8 (micro-batch): counts of clicks that arrived up to and including the listing batch."""
    c, listed = _batch_counts(ads, threshold, batch_col)
    kept = c.join(listed, "userid", "left").filter(
        F.col("since_batch").isNull() | (F.col(batch_col) <= F.col("since_batch")))
    return kept.groupBy(*GROUP).agg(F.sum("n").cast("long").alias("clicks"))
