"""Shared building blocks: per-group top-N, size-checked broadcast, next row in a session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each group under ``order`` (add a unique tie-break to ``order``).

    ``row_number() <= n`` is planned as a *partial* WindowGroupLimit before the shuffle and a final
    one after it, so a group with millions of rows sends at most ``n`` rows per map task -- a hot
    group never lands whole in one task. The planner does so up to its own limit (1,000 rows unless the session says
    otherwise). Beyond it there are two levels: groups are cut by the rows' hash into parts, each ranked by a task of
    its own, and only a part's first ``n`` rows go on to the group's ranking, ``n`` times the parts at most.
    """
    rn = rank_col or "_rn"
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        parts = max(2, min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2_000_000 // n))
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(parts))
        w = Window.partitionBy(*group, "_part").orderBy(*order)
        df = df.withColumn("_part", salt).withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n).drop("_part", rn)
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out.withColumn(rn, F.col(rn).cast("long")) if rank_col else out.drop(rn)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if it provably has at most ``max_rows`` rows, else return it unhinted.

    The check reads at most ``max_rows + 1`` rows (a bounded job). Beyond the bound the planner is left
    to pick a sort-merge or shuffled-hash join, with AQE re-planning from measured shuffle sizes.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


SLICES = 128


def hot_keys(df: DataFrame, key: str, fraction: float = 0.001, min_sampled: int = 50, max_keys: int = 1000,
             time_us: Column | None = None, rows_per_slice: int = 1_000_000, content: Sequence[str] | None = None) -> DataFrame:
    """Keys that hold a large share of the rows, from about ``fraction`` of the rows, chosen by their content.

    A row is in the sample if the hash of its ``content`` columns (all by default) says so: the choice never
    depends on where a row lies, so every evaluation agrees. A key is hot with ``min_sampled`` sampled rows
    (50,000 rows by default); the ``max_keys`` largest are kept, which bounds the result for a broadcast. Used
    only to *route* work; a key that is missed is slower, never wrong. Null is a key like any other.

    With ``time_us`` (a microsecond time of each row) every hot key also gets ``_bounds``: ascending times
    that cut it into slices of about ``rows_per_slice`` rows (``SLICES`` at most). They are quantiles
    of the sampled times, so a burst inside a long thin session is cut as finely as its rows ask for. Rows
    of one key with one and the same time stay together.
    """
    picked = F.pmod(F.xxhash64(*[F.col(c) for c in content or df.columns]), F.lit(1_000_000)) < int(fraction * 1_000_000)
    cols = [F.col(key)] + ([time_us.alias("_t")] if time_us is not None else [])
    sampled = df.filter(picked).select(*cols)
    aggs = [F.count(F.lit(1)).alias("_n")]
    if time_us is not None:
        cuts = F.array(*[F.lit((i + 1) / SLICES) for i in range(SLICES - 1)])
        aggs.append(F.percentile_approx("_t", cuts, 10_000).alias("_q"))
    hot = (sampled.groupBy(key).agg(*aggs).filter(F.col("_n") >= min_sampled)
           .orderBy(F.desc("_n"), F.asc(key)).limit(max_keys))
    if time_us is None:
        return hot.select(key)
    wanted = F.least(F.lit(SLICES), F.ceil(F.col("_n") / F.lit(fraction) / F.lit(rows_per_slice)))
    step = F.greatest(F.lit(1), F.floor(F.lit(SLICES) / wanted)).cast("int")
    return hot.select(key, F.filter("_q", lambda q, i: (i + 1) % step == 0).alias("_bounds"))


def hot_slices(df: DataFrame, key: str, order: Sequence[str], fraction: float = 0.001, rows_per_slice: int = 1_000_000,
               slices: int = 50_000, most_sampled: int = 5_000_000) -> DataFrame:
    """Keys with more than a slice of rows, with the rows that begin their slices: (key, _bounds, _heads, _width).

    A slice is ``rows_per_slice`` rows, or 1 / ``slices`` of all rows if that is more: so there are about twice
    ``slices`` bounds over all keys at most, whatever the input, and the result may be broadcast. No key and no number
    of slices of a key is left out. Bounds are rows (``order``, a unique order), not times: rows of one time are cut too.

    They come from about ``fraction`` of the rows, ``most_sampled`` at most, chosen by their content, so that every
    evaluation agrees. They only *route* work. ``_heads`` is every ``_width``-th bound: see ``slice_number``.
    """
    total = df.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).cast("double").alias("n")).scalar()
    share = F.least(F.lit(float(fraction)), F.lit(float(most_sampled)) / total)
    per = F.greatest(F.lit(float(rows_per_slice)), total / F.lit(slices))
    picked = F.pmod(F.xxhash64(key, *order), F.lit(1 << 30)) < share * F.lit(1 << 30)
    found = df.filter(picked).groupBy(key).agg(F.array_sort(F.collect_set(F.struct(*order))).alias("_s"))
    k = F.ceil(F.size("_s") / share / per).alias("_k")
    hot = found.select(key, "_s", k).filter(F.col("_k") > 1)
    cuts = F.transform(F.sequence(F.lit(1).cast("long"), F.col("_k") - 1),
                       lambda i: F.get("_s", F.floor(i * F.size("_s") / F.col("_k")).cast("int")))
    width = F.ceil(F.sqrt(F.col("_k") - 1)).cast("int").alias("_width")
    hot = hot.select(key, cuts.alias("_bounds"), width)
    heads = F.transform(F.sequence(F.lit(0), F.size("_bounds") - 1, F.col("_width")), lambda i: F.get("_bounds", i))
    return hot.select(key, "_bounds", heads.alias("_heads"), "_width")


def slice_number(order: Sequence[str]) -> Column:
    """The number of ``_bounds`` at or before a row: found among the ``_heads`` first, then between two of them, so
    that a row is compared with about twice the root of the number of bounds."""
    at = F.struct(*order)
    blocks = F.size(F.filter("_heads", lambda b: b <= at))
    inside = F.slice("_bounds", (blocks - 1) * F.col("_width") + 1, F.col("_width"))
    return F.when(blocks == 0, F.lit(0)).otherwise((blocks - 1) * F.col("_width") + F.size(F.filter(inside, lambda b: b <= at)))


def next_in_session(df: DataFrame, session: str, order: Sequence[str], carry: Sequence[str],
                    slice_col: Column | None = None, extra: Sequence[str] = (),
                    hot: DataFrame | None = None, keep_last: bool = False) -> DataFrame:
    """Pair every row with the next row of its session (``list.zip(list.tail)``).

    Returns every input row that has a successor (its ``session``, ``order``, ``extra`` and ``carry``
    columns) with ``next_<c>`` for each ``c`` in ``carry``; the last row of a session has no successor
    and is dropped.

    Skew: a plain ``lead`` over ``partitionBy(session)`` sorts a whole session in one task, so a
    single hot (bot) session holding a third of the log would stall the job. When ``slice_col`` is
    given (a number that does not decrease in ``order``), rows are windowed per (session, slice) instead
    and only the first and last row of every slice take part in a second window over the session (two
    rows per slice) that links the last row of one slice to the first row of the next.

    With ``hot`` (``hot_slices``) only those sessions are sliced; every other session is one
    slice and is finished by the first window. All rows take the same window, so a row can neither be
    lost nor doubled whatever ``hot`` holds.
    ``keep_last`` also returns each session's last row, with null ``next_<c>``: every input row once.
    """
    order_cols = [F.col(c) for c in order]
    keep = list(dict.fromkeys([session, *order, *extra, *carry]))
    nxt = [f"next_{c}" for c in carry]
    if slice_col is None and hot is None:
        w = Window.partitionBy(session).orderBy(*order_cols)
        out = df.select(*keep, *[F.lead(c).over(w).alias(f"next_{c}") for c in carry],
                        F.lead(F.lit(1)).over(w).isNotNull().alias("_has_next"))
        return (out if keep_last else out.filter("_has_next")).select(*keep, *nxt)

    if hot is not None:
        bounds = F.broadcast(hot.withColumnRenamed(session, "_hot_key"))
        flagged = df.join(bounds, F.col(session).eqNullSafe(F.col("_hot_key")), "left")
        sliced = flagged.select(*keep, F.col("_bounds").isNotNull().alias("_cut"),
                                F.coalesce(slice_col, F.lit(0)).cast("long").alias("_slice"))
    else:
        sliced = df.select(*keep, F.lit(True).alias("_cut"), slice_col.alias("_slice"))
    w1 = Window.partitionBy(session, "_slice").orderBy(*order_cols)
    tagged = sliced.select(*keep, "_cut", *[F.lead(c).over(w1).alias(f"next_{c}") for c in carry],
                           F.lag(F.lit(1)).over(w1).isNotNull().alias("_has_prev"),
                           F.lead(F.lit(1)).over(w1).isNotNull().alias("_has_next"))
    done = F.col("_has_next") | ~F.col("_cut") if keep_last else F.col("_has_next")
    inside = tagged.filter(done).select(*keep, *nxt)
    # First and last row of every slice of a cut session: at most two rows per (session, slice).
    edges = tagged.filter(F.col("_cut") & (~F.col("_has_prev") | ~F.col("_has_next")))
    w2 = Window.partitionBy(session).orderBy(*order_cols)
    linked = edges.select(*keep, "_has_next", *[F.lead(c).over(w2).alias(f"next_{c}") for c in carry],
                          F.lead(F.lit(1)).over(w2).isNotNull().alias("_linked"))
    last = ~F.col("_has_next") if keep_last else ~F.col("_has_next") & F.col("_linked")
    return inside.unionByName(linked.filter(last).select(*keep, *nxt))
