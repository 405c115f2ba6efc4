"""Registered streaming twins: replay the ad log as a stream and read the sink back.

Each callable encodes the ad log of the tables as wire lines, writes them as several text files
below the cluster's shared checkpoint folder, and runs the streaming job with ``availableNow`` and
``maxFilesPerTrigger`` so the log arrives in several micro-batches *out of event order* (every file
holds clicks of every day). The result must equal the batch twin -- and therefore the same oracle
SQL -- whatever the split. The rows the stream read are checked against the rows written, so an
empty or partly dropped stream cannot pass.
"""

from __future__ import annotations

import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklens.plans.oracle import ARRIVAL_BATCHES, ARRIVAL_START, ARRIVAL_STEP_S, BROKEN, LATE_BATCHES, LATE_EACH, RANGE, THRESHOLD
from clicklens.session import shared_dir
from clicklens.sources import adlines, tables
from clicklens.streaming import jobs

TS_MS = "yyyy-MM-dd HH:mm:ss.SSS"


class Replay:
    """An ad-log replay folder: ``input`` (text lines), ``out`` (sink tables), ``cp`` (checkpoint)."""

    def __init__(self, spark: SparkSession, sf_dir: str, batches: int = 4, batch_of: Column | None = None,
                 by_day: bool = False, late: Column | None = None, arrival_of=None, bad_of=None):
        """``batch_of``: a number 0 .. batches - 1 of each click; its clicks are the batch of that number.
        ``by_day``: days arrive in order, some in each batch, but for the ``late`` clicks, which come last; else every
        file holds clicks of every day. ``arrival_of``: batch number -> the ``arrival`` time that its folder names.
        ``bad_of``: ad log -> lines (``value``) that are no clicks, sent with the first batch."""
        self.spark = spark
        self.root = shared_dir(spark)
        self.input, self.out, self.cp = f"{self.root}/input", f"{self.root}/out", f"{self.root}/cp"
        self.arrives = arrival_of is not None
        ads = tables.ads_log(spark, sf_dir)
        # round-robin into files of ~100k lines (at most the session's shuffle width -- thousands on a
        # cluster): every file holds clicks of every day, and no task writes more than its share
        rows = tables.read_table(spark, sf_dir, "events", ["event_id"]).count()
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        files = max(batches, min(width, batches * -(-rows // 100_000)))
        self.per_trigger = -(-files // batches)
        if by_day:
            day = F.unix_date(F.col("dt").cast("date"))
            ends = ads.agg(F.min(day).alias("a"), F.max(day).alias("z")).first()
            if ends.a is not None:
                batch_of = F.floor((day - ends.a) * batches / (ends.z - ends.a + 1))
                batch_of = batch_of if late is None else F.when(late, batches - 1).otherwise(batch_of)
        if batch_of is None:
            lines = adlines.encode_lines(ads)
            lines = lines if bad_of is None else lines.unionByName(bad_of(ads))
            lines.repartition(files).write.text(self.input)
        else:  # files are read in the order of their times: one write after another
            for b in range(batches):
                lines = adlines.encode_lines(ads.filter(batch_of == b)).repartition(self.per_trigger)
                folder = self.input if not self.arrives else f"{self.input}/arrival={quote(arrival_of(b), safe=' ')}"
                lines.write.mode("append").text(folder)
        self.written = spark.read.text(self.input).count()

    def lines(self) -> DataFrame:
        partitions = {"partitions": "arrival timestamp"} if self.arrives else {}
        return adlines.read_line_stream(self.spark, "text", path=self.input, maxFilesPerTrigger=self.per_trigger, **partitions)

    def clicks(self) -> DataFrame:
        return adlines.parse_lines(self.lines(), ["arrival"] if self.arrives else [])

    def run(self, start, source: DataFrame | None = None) -> StreamingQuery:
        # a stateful query keeps the shuffle width it starts with as its number of state stores: size
        # it from the input (~100k lines each, never above the session's setting) for this query only;
        # the query clones the session's settings when it starts
        conf = self.spark.conf
        before = conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", str(max(2, min(int(before), -(-self.written // 100_000)))))
        try:
            q = start(self.clicks() if source is None else source, self.out, self.cp, trigger={"availableNow": True})
        finally:
            conf.set("spark.sql.shuffle.partitions", before)
        q.awaitTermination()
        read = sum(p["numInputRows"] for p in q.recentProgress)
        batches = len(q.recentProgress)
        if read != self.written:
            raise RuntimeError(f"stream read {read} of {self.written} lines")
        if batches < 2:
            raise RuntimeError("replay ran as a single micro-batch")
        return q


def _stream_click_daily(spark: SparkSession, sf: str) -> DataFrame:
    r = Replay(spark, sf)
    r.run(jobs.ads_click_daily_stream)
    return jobs.read_ads_click_daily(spark, r.out)


def _stream_counter_state(spark: SparkSession, sf: str) -> DataFrame:
    """SRC6: the same counters, read from the query's state instead of its output."""
    r = Replay(spark, sf)
    r.run(jobs.ads_click_daily_stream)
    return jobs.read_counter_state(spark, r.cp)


def _stream_area_top3(spark: SparkSession, sf: str) -> DataFrame:
    r = Replay(spark, sf)
    r.run(jobs.ads_area_top3_stream)
    return jobs.read_ads_area_top3(spark, r.out)


def _stream_trend(spark: SparkSession, sf: str) -> DataFrame:
    r = Replay(spark, sf)
    r.run(lambda c, o, cp, trigger: jobs.ads_window_stream(c, o, cp, 10, trigger=trigger))
    return jobs.read_ads_windows(spark, r.out).select(F.col("win_start").alias("bucket"), "clicks")


def _stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    r = Replay(spark, sf)
    r.run(lambda c, o, cp, trigger: jobs.ads_window_stream(c, o, cp, 60, 10, trigger=trigger))
    return jobs.read_ads_windows(spark, r.out)


def _stream_blacklist_run(spark: SparkSession, sf: str) -> Replay:
    r = Replay(spark, sf)
    r.run(lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, THRESHOLD, trigger=trigger))
    return r


def _stream_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    r = _stream_blacklist_run(spark, sf)
    bl = jobs.read_blacklist(spark, r.out, THRESHOLD)
    return bl.select("userid", F.date_format("since", TS_MS).alias("since"))


def _stream_blacklist_counts(spark: SparkSession, sf: str) -> DataFrame:
    r = _stream_blacklist_run(spark, sf)
    return jobs.read_blacklist_counts(spark, r.out, THRESHOLD)


def _stream_micro_batch_run(spark: SparkSession, sf: str) -> Replay:
    r = Replay(spark, sf, 5, F.col("event_id") % 5)
    r.run(lambda c, o, cp, trigger: jobs.blacklist_stream(c, o, cp, THRESHOLD, mode="micro_batch", trigger=trigger))
    return r


def _stream_micro_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The reference's rule (SRC5, SNK6, J2, ST8): a batch lists users, later batches drop them."""
    r = _stream_micro_batch_run(spark, sf)
    return jobs.read_blacklist(spark, r.out, THRESHOLD, "micro_batch").select("userid", "since_batch")


def _stream_micro_batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    r = _stream_micro_batch_run(spark, sf)
    return jobs.read_blacklist_counts(spark, r.out, THRESHOLD, "micro_batch")


def _stream_trend_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """ST9: clicks in event order under a watermark that drops closed windows' state."""
    r = Replay(spark, sf, by_day=True)
    r.run(lambda c, o, cp, trigger: jobs.ads_window_stream(c, o, cp, 10, trigger=trigger, watermark="1 minute"))
    return jobs.read_ads_windows(spark, r.out).select(F.col("win_start").alias("bucket"), "clicks")


def _stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """ST9 with late clicks: the windows that had closed when they came do not count them."""
    r = Replay(spark, sf, LATE_BATCHES, by_day=True, late=F.col("event_id") % LATE_EACH == 0)
    q = r.run(lambda c, o, cp, trigger: jobs.ads_window_stream(c, o, cp, 10, trigger=trigger, watermark="1 minute"))
    if not jobs.dropped_rows(q):
        raise RuntimeError("no late click was dropped")
    return jobs.read_ads_windows(spark, r.out).select(F.col("win_start").alias("bucket"), "clicks")


def _arrival(batch: int) -> str:
    """The declared clock of the arrival replay: a batch each 20 seconds."""
    return str(datetime.datetime.fromisoformat(ARRIVAL_START) + datetime.timedelta(seconds=ARRIVAL_STEP_S * batch))


def _stream_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """ST4 by arrival: windows of the times at which the lines were delivered, with old event times inside."""
    r = Replay(spark, sf, ARRIVAL_BATCHES, F.col("event_id") % ARRIVAL_BATCHES, arrival_of=_arrival)
    r.run(lambda c, o, cp, trigger: jobs.ads_arrival_trend_stream(c, o, cp, trigger=trigger, arrival="arrival"))
    return jobs.read_ads_arrival_trend(spark, r.out)


def _broken(ads: DataFrame) -> DataFrame:
    """Lines that are no clicks, made from some clicks: too few fields, and a time that is no number."""
    few = ads.filter(F.col("event_id") % BROKEN[0] == 0).select(F.concat(F.lit("broken "), F.col("event_id").cast("string")).alias("value"))
    timeless = ads.filter(F.col("event_id") % BROKEN[1] == 0).select(
        F.concat_ws(" ", F.lit("noon"), F.lit("a"), F.lit("c"), "userid", "adid", F.col("event_id").cast("string")).alias("value"))
    return few.unionByName(timeless)


def _stream_split(spark: SparkSession, sf: str) -> DataFrame:
    """X2/ST6: one pass over the lines gives the clicks and the rejects; together they are all lines read."""
    r = Replay(spark, sf, bad_of=_broken)
    n = jobs.line_counts(r.run(jobs.split_lines_stream, r.lines()))
    if n["good"] + n["bad"] != n["read"] or n["read"] != r.written:
        raise RuntimeError(f"{n} of {r.written} lines")
    good = jobs.read_clicks(spark, r.out).select(F.lit("good").alias("kind"), "event_id", F.date_format("ts", TS_MS).alias("ts"), "dt",
                                                 "area", "city", "userid", "adid", F.lit(None).cast("string").alias("value"))
    bad = jobs.read_bad_lines(spark, r.out).withColumn("kind", F.lit("bad"))
    return good.unionByName(bad, allowMissingColumns=True)


def _catalog(spark: SparkSession, sf: str) -> str:
    """The visit log as a catalog table with a partition for each day; returns its name."""
    from clicklens.sinks import replace_table
    root = shared_dir(spark)
    name = "user_visit_action_" + root.rsplit("-", 1)[-1]
    replace_table(tables.visit_log(spark, sf).hint("rebalance", "date"), name, path=f"{root}/{name}", partition_by=["date"])
    return name


def _catalog_ranged(spark: SparkSession, sf: str) -> DataFrame:
    """SRC1 + F1: a range of days of the catalog table; other days' folders are not read."""
    return tables.catalog_scan(spark, _catalog(spark, sf), *RANGE, columns=["event_id", "date", "session_id", "page_id"])


def _catalog_days(spark: SparkSession, sf: str) -> DataFrame:
    """SRC1 + F1: the days that a join names; the scan prunes partitions when the days are known, at run time."""
    days = tables.calendar(tables.read_table(spark, sf, "events", ["ts"]), "ts").filter("weekday = 6")
    return tables.catalog_scan_days(spark, _catalog(spark, sf), days, columns=["event_id", "date", "session_id", "page_id"])


def _sink_replace_table(spark: SparkSession, sf: str) -> DataFrame:
    """SNK1: write Q1 as a catalog table (data below the shared folder) and read it back."""
    from clicklens.operators import hot_category_top10
    from clicklens.sinks import replace_table
    root = shared_dir(spark)
    name = "category_top10_" + root.rsplit("-", 1)[-1]
    replace_table(hot_category_top10(tables.visit_log(spark, sf)), name, path=f"{root}/{name}")
    return spark.table(name)


def stream_queries() -> dict:
    return {
        "stream_ads_click_daily": _stream_click_daily,
        "stream_ads_area_top3": _stream_area_top3,
        "stream_ads_trend": _stream_trend,
        "stream_ads_sliding_60s": _stream_sliding,
        "stream_blacklist": _stream_blacklist,
        "stream_blacklist_counts": _stream_blacklist_counts,
        "stream_blacklist_micro_batch": _stream_micro_batch,
        "stream_blacklist_micro_batch_counts": _stream_micro_batch_counts,
        "stream_ads_trend_watermark": _stream_trend_watermark,
        "stream_counter_state": _stream_counter_state,
        "stream_ads_late": _stream_late,
        "stream_ads_arrival_trend": _stream_arrival,
        "stream_ads_log_split": _stream_split,
        "catalog_scan_ranged": _catalog_ranged,
        "catalog_scan_days": _catalog_days,
        "sink_replace_table": _sink_replace_table,
    }
