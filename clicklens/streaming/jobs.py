"""Structured Streaming jobs for the live ad-click requirements (Q4-Q7).

Each job takes a parsed click stream (``sources.parse_lines(read_line_stream(...))``) and keeps its running values in
Spark's state store (RocksDB), nowhere else. A batch emits the keys it changed with their absolute values, and
``foreachBatch`` writes them as one plain partition of that batch's number: a batch that is replayed after a failure
writes its own partition again. A reader takes the value of the newest batch for each key; a running query's counters
can also be read from its state (``read_counter_state``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicklens.defaults import BLACKLIST_THRESHOLD, TOP_ADS, TREND_SLIDE_S, TREND_WINDOW_S, TRIGGER_INTERVAL_S
from clicklens.functions.columns import TS_FORMAT, floor_seconds
from clicklens.operators.ads import ads_area_top3_json
from clicklens.operators.blacklist import GROUP
from clicklens.sinks.writers import BATCH, latest_per_key, read_batch, read_batches, replace_partitions, write_batch
from clicklens.sources.adlines import CLICK, LINE_KINDS, split_lines
from clicklens.streaming.blacklist import CHANGES, blacklist_changes

DEFAULT_TRIGGER = {"processingTime": f"{TRIGGER_INTERVAL_S} seconds"}

TOTALS_SCHEMA = "dt string, area string, city string, adid string, clicks long"
ROLLUP_SCHEMA = "dt string, area string, adid string, clicks long"
TOP3_SCHEMA = "dt string, area string, top3 string"
WINDOW_SCHEMA = "win_start string, win_end string, clicks long"
ARRIVAL_SCHEMA = "win_start string, win_end string, bucket string, clicks long"

# Spark's own settings for state off the JVM heap, with a batch's changes (not whole files) sent to the checkpoint.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_settings(spark: SparkSession, always: bool = False) -> Iterator[None]:
    """``STATE_CONF`` for queries started inside (a query keeps the settings it starts with), where the session does
    not say otherwise; ``always`` for operators that only this state store supports."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    own = [k for k in STATE_CONF if always or before[k] is None]
    for k in own:
        spark.conf.set(k, STATE_CONF[k])
    try:
        yield
    finally:
        for k in own:
            if before[k] is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, before[k])


def _start(df: DataFrame, sink, checkpoint: str, trigger: dict | None, rocksdb: bool = False) -> StreamingQuery:
    w = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
    with state_settings(df.sparkSession, rocksdb):
        return w.trigger(**(trigger or DEFAULT_TRIGGER)).start()


def _day_keys(clicks: DataFrame, watermark: str | None) -> tuple[DataFrame, list]:
    """With a watermark the day is also an event-time window, so Spark can drop closed days' state.

    The window runs over the wall-clock time (``from_utc_timestamp`` with the session zone), so its
    days are exactly the ``dt`` days whatever the session time zone; one ``dt`` never straddles two
    windows.
    """
    if watermark is None:
        return clicks, []
    tz = clicks.sparkSession.conf.get("spark.sql.session.timeZone")
    local = clicks.withColumn("_wall", F.from_utc_timestamp("ts", tz))
    return local.withWatermark("_wall", watermark), [F.window("_wall", "1 day").alias("_day")]


def dropped_rows(query: StreamingQuery) -> int:
    """ST9: rows that the query's operators dropped because they came after the watermark, by its progress.

    An aggregate drops rows after its partial sums, so equal keys of one task may count once."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


# ---------------------------------------------------------------- lines: clicks and rejects in one pass
def split_lines_stream(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """X2/ST6: one read of the source gives the parsed clicks and the rejected lines, below ``out``/lines by kind.

    Spark's file sink keeps a log of the files of each batch, so each line is stored exactly once; the numbers of lines
    read, good and bad of each batch are observed on the way (``line_counts``)."""
    rows = split_lines(lines)
    kinds = [F.count_if(F.col("kind") == k).alias(k) for k in LINE_KINDS]
    rows = rows.observe("lines", F.count(F.lit(1)).alias("read"), *kinds)
    return (rows.writeStream.format("parquet").partitionBy("kind").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER)).start(f"{out}/lines"))


def line_counts(query: StreamingQuery) -> dict[str, int]:
    """{read, good, bad}: lines of the batches in the query's progress."""
    seen = [p["observedMetrics"]["lines"] for p in query.recentProgress if "lines" in (p["observedMetrics"] or {})]
    return {k: sum(row[k] for row in seen) for k in ("read", *LINE_KINDS)}


def _split(reader, out: str) -> DataFrame:
    return reader.schema(f"value string, {CLICK}, kind string").parquet(f"{out}/lines")


def clicks_from(spark: SparkSession, out: str, **options) -> DataFrame:
    """The clicks that ``split_lines_stream`` stores, as a stream of their own."""
    return _split(spark.readStream.options(**options), out).where("kind = 'good'").drop("value", "kind")


def read_clicks(spark: SparkSession, out: str) -> DataFrame:
    return _split(spark.read, out).where("kind = 'good'").drop("value", "kind")


def read_bad_lines(spark: SparkSession, out: str) -> DataFrame:
    """(value): the rejected lines so far, unchanged."""
    return _split(spark.read, out).where("kind = 'bad'").select("value")


# ---------------------------------------------------------------- Q5: daily counters per area/city/ad
def ads_click_daily_stream(clicks: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                           watermark: str | None = None) -> StreamingQuery:
    """Q5 (A9, ST2, SNK4): running clicks per (dt, area, city, adid); absolute totals per batch."""
    c, extra = _day_keys(clicks, watermark)
    agg = c.groupBy(*extra, "dt", "area", "city", "adid").agg(F.count(F.lit(1)).alias("clicks"))
    agg = agg.select("dt", "area", "city", "adid", "clicks")
    return _start(agg, lambda batch, k: write_batch(batch, f"{out}/totals", k), checkpoint, trigger)


def read_ads_click_daily(spark: SparkSession, out: str) -> DataFrame:
    return latest_per_key(read_batches(spark, f"{out}/totals", TOTALS_SCHEMA), ["dt", "area", "city", "adid"], ["clicks"])


def read_counter_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """SRC6: the counters of a counting query, read from its state by Spark's state data source.

    The last committed batch, without the query's output: one row for each key that is in the state (with a watermark,
    the open days)."""
    state = spark.read.format("statestore").load(checkpoint)
    keys = [f.name for f in state.schema["key"].dataType.fields if f.name != "_day"]
    count = state.schema["value"].dataType.fields[0].name
    return state.select(*[F.col(f"key.`{k}`").alias(k) for k in keys], F.col(f"value.`{count}`").alias("clicks"))


# ---------------------------------------------------------------- Q6: top ads per (day, area) as JSON
def _rollup_of(spark: SparkSession, out: str, days: list[str]) -> DataFrame:
    """The totals of some days: only their folders are listed and read."""
    log = read_batches(spark, f"{out}/rollup", ROLLUP_SCHEMA, parts=[f"dt={d}" for d in days])
    return latest_per_key(log, ["dt", "area", "adid"], ["clicks"])


def ads_area_top3_stream(clicks: DataFrame, out: str, checkpoint: str, n: int = TOP_ADS,
                         trigger: dict | None = None, watermark: str | None = None) -> StreamingQuery:
    """Q6 (A10, W3, X7, SNK5): the top-``n`` JSON of every (dt, area), replaced for the days a batch touched.

    Streaming ``row_number`` is not supported, so the stream keeps one aggregate at (dt, area, adid); each batch writes
    the totals it changed by day and batch, ranks its days' newest totals and replaces those days' documents (dynamic
    partition overwrite). Other days keep their files; a replayed batch writes the same documents.
    """
    c, extra = _day_keys(clicks, watermark)
    agg = (c.groupBy(*extra, "dt", "area", "adid").agg(F.count(F.lit(1)).alias("clicks"))
           .select("dt", "area", "adid", "clicks"))
    spark = clicks.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{out}/rollup", batch_id, ["dt"])
        mine = read_batch(spark, f"{out}/rollup", ROLLUP_SCHEMA, batch_id)
        days = sorted(r.dt for r in mine.select("dt").distinct().collect())    # the days of one batch
        if days:
            replace_partitions(ads_area_top3_json(_rollup_of(spark, out, days), n), f"{out}/top3", ["dt"])

    return _start(agg, sink, checkpoint, trigger)


def read_ads_area_top3(spark: SparkSession, out: str) -> DataFrame:
    try:
        return spark.read.schema(TOP3_SCHEMA).parquet(f"{out}/top3").select("dt", "area", "top3")
    except AnalysisException:
        return spark.createDataFrame([], TOP3_SCHEMA)


# ---------------------------------------------------------------- Q7: trend buckets / sliding windows
def ads_window_stream(clicks: DataFrame, out: str, checkpoint: str, window_s: int = 10,
                      slide_s: int | None = None, trigger: dict | None = None,
                      watermark: str | None = None, echo: int = 0) -> StreamingQuery:
    """Q7 (X5, ST4): clicks per event-time window (tumbling ``window_s`` or sliding by ``slide_s``).

    Event time is used here so results do not depend on when lines arrive (``ads_arrival_trend_stream`` windows
    arrivals). Without a watermark every window stays open (late lines still count, as in the reference's per-event
    days); with one, closed windows' state is dropped. ``echo > 0`` prints the newest ``echo`` windows that the batch
    changed, ascending (SNK7, the reference's per-batch print).
    """
    c = clicks if watermark is None else clicks.withWatermark("ts", watermark)
    win = (F.window("ts", f"{window_s} seconds", f"{slide_s} seconds") if slide_s
           else F.window("ts", f"{window_s} seconds"))
    agg = c.groupBy(win.alias("w")).agg(F.count(F.lit(1)).alias("clicks")).select(
        F.date_format("w.start", TS_FORMAT).alias("win_start"),
        F.date_format("w.end", TS_FORMAT).alias("win_end"), "clicks")
    spark = clicks.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{out}/windows", batch_id)
        if echo > 0:
            newest = read_batch(spark, f"{out}/windows", WINDOW_SCHEMA, batch_id).orderBy(F.desc("win_start")).limit(echo)
            newest.orderBy("win_start").show(echo, truncate=False)

    return _start(agg, sink, checkpoint, trigger)


def read_ads_windows(spark: SparkSession, out: str) -> DataFrame:
    return latest_per_key(read_batches(spark, f"{out}/windows", WINDOW_SCHEMA), ["win_start", "win_end"], ["clicks"])


def ads_arrival_trend_stream(clicks: DataFrame, out: str, checkpoint: str, window_s: int = TREND_WINDOW_S,
                             slide_s: int = TREND_SLIDE_S, bucket_s: int = TREND_SLIDE_S, trigger: dict | None = None,
                             echo: bool = False, arrival: str | None = None) -> StreamingQuery:
    """Q7 with the reference's window: the last ``window_s`` seconds of *arrivals*, sliding every
    ``slide_s``, and inside it clicks per ``bucket_s`` event-time bucket.

    ``arrival`` names a column with the time at which a line arrived (a topic's record time, or the folder it was
    delivered in): a declared clock, with results that can be repeated. Without it a line arrives at its micro-batch's
    time (``current_timestamp()``). A zero-delay watermark on arrival time lets Spark drop each window's state once it
    has closed. ``echo`` prints, after every batch, the window that ends next (the last minute of arrivals).
    """
    at = F.current_timestamp() if arrival is None else F.col(arrival)
    arrived = clicks.withColumn("_arrival", at).withWatermark("_arrival", "0 seconds")
    agg = (arrived.groupBy(F.window("_arrival", f"{window_s} seconds", f"{slide_s} seconds").alias("w"),
                           floor_seconds("ts", bucket_s).alias("_b"))
           .agg(F.count(F.lit(1)).alias("clicks"))
           .select(F.date_format("w.start", TS_FORMAT).alias("win_start"),
                   F.date_format("w.end", TS_FORMAT).alias("win_end"),
                   F.date_format("_b", TS_FORMAT).alias("bucket"), "clicks"))
    spark = clicks.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{out}/arrival", batch_id)
        if echo:
            mine = read_batch(spark, f"{out}/arrival", ARRIVAL_SCHEMA, batch_id)
            last = mine.filter(F.col("win_end") == mine.agg(F.min("win_end")).scalar())
            last.select("bucket", "clicks").orderBy("bucket").show(window_s // bucket_s * 10, truncate=False)

    return _start(agg, sink, checkpoint, trigger)


def read_ads_arrival_trend(spark: SparkSession, out: str) -> DataFrame:
    """(win_start, win_end, bucket, clicks) for every arrival window seen."""
    return latest_per_key(read_batches(spark, f"{out}/arrival", ARRIVAL_SCHEMA), ["win_start", "win_end", "bucket"], ["clicks"])


# ---------------------------------------------------------------- Q4: dynamic blacklist
def blacklist_stream(clicks: DataFrame, out: str, checkpoint: str, threshold: int = BLACKLIST_THRESHOLD,
                     mode: str = "event_time", trigger: dict | None = None, retain_days: int | None = None,
                     echo: int = 0) -> StreamingQuery:
    """Q4 (ST2, ST3, ST5, ST6, ST8, SRC5, SNK6): the blacklist, fed back into the counting.

    ``event_time`` (default): the listing is the ``threshold``-th click of a (dt, adid) in event time, whatever the
    batch split or arrival order; only clicks up to it count.

    ``micro_batch``: the reference's rule. A batch drops the clicks of users listed by earlier batches, adds the others
    to the running totals, then lists users whose total on any (day, ad) reached ``threshold``.

    Counters and listings are one stateful operator by user (``streaming.blacklist``); no store is read back.
    ``retain_days`` (default: keep everything, as the reference does): clicks older than the newest one by more are
    dropped and counted in the query's progress (``dropped_rows``), and timers drop closed days from the state; their
    final counters and all listings stay. ``echo > 0`` prints, after every batch, up to ``echo`` of the (day, ad, user)
    counters the batch changed (SNK7, like the reference's per-batch print of its running counts).
    """
    if mode not in ("event_time", "micro_batch"):
        raise ValueError(f"unknown blacklist mode {mode!r}")
    spark = clicks.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{out}/changes", batch_id, ["kind"])    # one write: the operator runs once
        if echo > 0:
            mine = read_batch(spark, f"{out}/changes", CHANGES, batch_id).where("kind = 'count'")
            mine.select(*GROUP, "clicks").orderBy(*GROUP).show(echo, truncate=False)

    return _start(blacklist_changes(clicks, threshold, mode, retain_days), sink, checkpoint, trigger, rocksdb=True)


def _changes(spark: SparkSession, out: str, kind: str) -> DataFrame:
    return read_batches(spark, f"{out}/changes", CHANGES).where(F.col("kind") == kind)


def read_blacklist(spark: SparkSession, out: str, threshold: int = BLACKLIST_THRESHOLD, mode: str = "event_time") -> DataFrame:
    """(userid, since) for ``event_time``; (userid, since_batch) for ``micro_batch``, as the stream listed them (by its
    own threshold)."""
    listed = _changes(spark, out, "listed")
    if mode == "micro_batch":
        return listed.select("userid", F.col(BATCH).alias("since_batch"))
    return latest_per_key(listed, ["userid"], ["since"]).select("userid", F.timestamp_micros("since").alias("since"))


def read_blacklist_counts(spark: SparkSession, out: str, threshold: int = BLACKLIST_THRESHOLD,
                          mode: str = "event_time") -> DataFrame:
    """(dt, adid, userid, clicks): the counters after the blacklist filter."""
    return latest_per_key(_changes(spark, out, "count"), list(GROUP), ["clicks"]).where("clicks > 0")
