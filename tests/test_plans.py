"""Plan-shape checks: the properties the design relies on at scale, read from the physical plans."""

import re

import pytest

from clicklens import operators as op
from clicklens.plans.registry import batch_queries
from clicklens.session import shared_dir
from clicklens.sources import tables, visit_actions
from clicklens.functions import date_range
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_reaches_the_parquet_scan(spark):
    p = plan_of(op.hot_category_top10(tables.visit_log(spark, SF_SMALL, "2024-01-08", "2024-01-21")))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", p).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_q1_reads_only_the_columns_it_needs(spark):
    p = plan_of(op.hot_category_top10(tables.visit_log(spark, SF_SMALL)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["event_id", "event_type"]


def test_top_n_per_group_is_limited_before_the_shuffle(spark):
    p = plan_of(op.hot_category_session_top10(tables.visit_log(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "BroadcastExchange" in p           # the bounded top-10 side of the semi join
    p4 = plan_of(op.blacklist_users(tables.ad_clicks(spark, SF_SMALL), 3))
    assert "Partial" in p4 and "SortAggregate" not in p4


@pytest.mark.parametrize("name", sorted(batch_queries()))
def test_no_python_in_any_batch_plan(spark, name):
    p = plan_of(batch_queries()[name](spark, SF_SMALL))
    assert not any(k in p for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                    "MapInPandas", "PythonUDF"))


def test_q5_counts_before_the_geography_join(spark):
    p = plan_of(batch_queries()["ads_click_daily"](spark, SF_SMALL))
    join = p.find("Join")
    first_agg_below_join = p.find("HashAggregate", join)
    assert join > 0 and first_agg_below_join > join  # an aggregate sits under the join's input


def test_partitioned_log_prunes_dates(spark):
    root = shared_dir(spark)
    v = tables.visit_log(spark, SF_SMALL).select("date", "session_id", "page_id", "action_time", "event_id")
    v.write.partitionBy("date").parquet(f"{root}/uva")
    pruned = date_range(visit_actions(spark.read.parquet(f"{root}/uva")), "2024-01-08", "2024-01-09")
    p = plan_of(op.page_avg_dwell(pruned))
    parts = re.search(r"PartitionFilters: \[([^\]]*)\]", p).group(1)
    assert "date" in parts and "2024-01-08" in parts


def test_bounded_broadcast_only_below_its_bound(spark):
    from clicklens.operators import bounded_broadcast
    big = spark.range(0, 5000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only our hint may broadcast
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = plan_of(big.join(bounded_broadcast(small, 100), "k"))
        unhinted = plan_of(big.join(bounded_broadcast(big.select("k"), 100), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in hinted
    assert "BroadcastHashJoin" not in unhinted and "SortMergeJoin" in unhinted


def test_hot_keys_are_bounded(spark):
    from pyspark.sql import functions as F
    from clicklens.operators import hot_keys
    df = spark.range(0, 20000).select((F.col("id") % 40).alias("s"))   # 40 keys of 500 rows
    assert hot_keys(df, "s", fraction=1.0, min_sampled=100, max_keys=7).count() == 7
    assert hot_keys(df, "s", fraction=1.0, min_sampled=1000).count() == 0


def test_last_minute_bound_reaches_the_scan(spark, tmp_path):
    """The newest minute is read from the row groups that hold it: the scan of the events returns few rows."""
    import datetime as dt

    from pyspark.sql import functions as F

    from clicklens.sources import tables
    base = dt.datetime(2024, 1, 1)
    rows = spark.range(40_000).select(
        F.col("id").alias("event_id"), (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("ts"),
        F.col("id").alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 3}').alias("props"))
    rows.coalesce(1).sortWithinPartitions("ts").write.option("parquet.block.size", 64 * 1024).parquet(f"{tmp_path}/events.parquet")
    df = tables.ad_clicks(spark, str(tmp_path), last_s=60)
    out = df.agg(F.count("adid").alias("n"), F.min("event_id").alias("least"))
    (row,) = out.collect()
    assert (row.n, row.least) == (60, 39_940)
    # the filter compares the raw column with the subquery's value and nothing else
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Filter \(isnotnull\(ts#\d+\) AND \(ts#\d+ >= scalar-subquery", plan), plan


def _catalog_table(spark, name):
    from clicklens.sinks import replace_table
    v = tables.visit_log(spark, SF_SMALL).select("date", "session_id", "page_id", "event_id")
    replace_table(v, name, path=f"{shared_dir(spark)}/{name}", partition_by=["date"])
    return name


def test_a_catalog_scan_prunes_partitions_by_its_range(spark):
    name = _catalog_table(spark, "uva_ranged")
    p = plan_of(tables.catalog_scan(spark, name, "2024-01-08", "2024-01-09", columns=["date", "page_id"]))
    parts = re.search(r"PartitionFilters: \[([^\]]*)\]", p).group(1)
    assert "2024-01-08" in parts and "2024-01-09" in parts
    assert re.search(r"ReadSchema: struct<([^>]*)>", p).group(1) == "page_id:bigint"


def test_a_catalog_scan_prunes_partitions_by_a_join_at_run_time(spark):
    name = _catalog_table(spark, "uva_days")
    days = tables.calendar(spark.table(name).withColumn("t", date_of("date")), "t").filter("weekday = 6")
    out = tables.catalog_scan_days(spark, name, days, columns=["date", "page_id"])
    sundays = sorted(r.date for r in days.collect())
    assert sorted(r.date for r in out.select("date").distinct().collect()) == sundays and 0 < len(sundays) < 9
    p = plan_of(out)
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", p)


def date_of(c):
    from pyspark.sql import functions as F
    return F.col(c).cast("date")


def _burst(spark, n=60_000):
    """A third of all rows in one session at one time; the others in sessions of 100 rows."""
    from pyspark.sql import functions as F
    i = F.col("id")
    bot = i % 3 == 0
    return spark.range(n).select(
        F.when(bot, "bot").otherwise(F.concat(F.lit("s"), F.floor(i / 150).cast("string"))).alias("session_id"), i.alias("event_id"),
        F.timestamp_seconds(F.when(bot, F.lit(1_700_000_000)).otherwise(i)).cast("timestamp_ntz").alias("action_time"), (i % 7).alias("page_id"))


def test_a_session_at_one_time_is_spread_evenly(spark):
    from pyspark.sql import functions as F
    df = _burst(spark)
    order = ["action_time", "event_id"]
    hot = op.hot_slices(df, "session_id", order, fraction=0.5, rows_per_slice=200)
    assert [r.session_id for r in hot.collect()] == ["bot"]
    cut = df.join(F.broadcast(hot), "session_id", "left").withColumn(
        "_slice", F.when(F.col("_bounds").isNotNull(), op.slice_number(order)).otherwise(0))
    # numbers rise with the order, and the exchange of the window deals (session, slice) like this one
    w = cut.where("session_id = 'bot'").groupBy("_slice").agg(F.min("event_id").alias("a"), F.max("event_id").alias("z"), F.count("*").alias("n"))
    rows_ = sorted(tuple(r) for r in w.collect())
    assert len(rows_) > 80 and all(x[2] < y[1] for x, y in zip(rows_, rows_[1:])) and max(r[3] for r in rows_) < 600
    sizes = sorted(r["count"] for r in cut.repartition(16, "session_id", "_slice").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 1.5 * sizes[8]
    steps = lambda **kw: sorted(map(tuple, op.page_steps(df, **kw).groupBy("from_page", "to_page").count().collect()))
    assert steps(hot_sample=0.5, rows_per_slice=200) == steps(slice_width_s=None)


def test_any_number_of_sessions_and_slices_may_be_hot(spark):
    from pyspark.sql import functions as F
    df = spark.range(60_000).select((F.col("id") % 1500).alias("session_id"), F.col("id").alias("event_id"),
                                    F.timestamp_seconds(F.floor(F.col("id") / 6000)).cast("timestamp_ntz").alias("action_time"), (F.col("id") % 5).alias("page_id"))
    hot = op.hot_slices(df, "session_id", ["action_time", "event_id"], fraction=1.0, rows_per_slice=10)
    assert hot.count() == 1500 and hot.where("size(_bounds) <> 3").count() == 0
    steps = lambda **kw: sorted(map(tuple, op.page_steps(df, **kw).collect()))
    assert steps(hot_sample=1.0, rows_per_slice=10) == steps(slice_width_s=None)
    # a slice is a share of all rows at least, so that the bounds have a proven size
    few = op.hot_slices(df, "session_id", ["action_time", "event_id"], fraction=1.0, rows_per_slice=1, slices=100)
    assert few.count() == 0


def test_top_n_beyond_the_planners_limit(spark):
    from pyspark.sql import functions as F
    n = 5000
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"),
                                    F.pmod(F.hash("id"), F.lit(1000)).alias("v"), F.col("id").alias("i"))
    out = op.top_n_per_group(df, ["g"], [F.desc("v"), F.asc("i")], n, "rank")
    p = plan_of(out)
    assert p.count("Window [row_number()") == 2 and "_part" in p
    got = sorted((r.g, r["rank"], r.i) for r in out.collect())
    rows_: dict = {}
    for r in df.collect():
        rows_.setdefault(r.g, []).append((-r.v, r.i))
    assert got == sorted((g, k + 1, i) for g, vs in rows_.items() for k, (_, i) in enumerate(sorted(vs)[:n]))
    clicks = df.select(F.lit("d").alias("dt"), F.lit("1").alias("adid"), F.col("g").alias("userid"), F.timestamp_seconds("v").alias("ts"), F.col("i").alias("event_id"))
    first = op.first_clicks(clicks, 3000)
    assert first.where("userid = 'hot'").count() == 3000 and first.agg(F.max("rn")).first()[0] == 3000
    want = sorted((g, i) for g, vs in rows_.items() for _, i in sorted((-v, i) for v, i in vs)[:3000])
    assert sorted((r.userid, r.event_id) for r in first.collect()) == want
