"""Command-line jobs, one per requirement of the reference (its nine ``main`` programs).

    python -m clicklens hot-categories   --table user_visit_action --start-date 2019-01-01 --output-table category_top10
    python -m clicklens category-sessions --table user_visit_action --output-path s3://.../category_top10_session_count
    python -m clicklens page-flow        --table user_visit_action --flow 1,2,3,4,5,6,7
    python -m clicklens page-dwell       --parquet /data/user_visit_action
    python -m clicklens ads-blacklist    --bootstrap-servers host:9092 --topic ads_log --out /shared/bl --checkpoint /shared/bl-cp
    python -m clicklens ads-daily | ads-top3 | ads-trend   (same stream options)

Batch jobs read a visit log in the reference's format (catalog table or Parquet path), take the
reference's conditions as arguments (``startDate``/``endDate``/``targetPageFlow``) and write to a
catalog table, a Parquet path or a JDBC table; with no output they print the result. Stream jobs
read ``epoch_ms area city userid adid`` lines from Kafka (connector jar required) or a folder.
The session is whatever ``spark-submit`` configures; only the time zone is pinned when asked.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens import operators as op
from clicklens import sinks
from clicklens.defaults import (BLACKLIST_THRESHOLD, TOP_ADS, TOP_CATEGORIES, TOP_SESSIONS, TREND_SLIDE_S,
                                TRIGGER_INTERVAL_S)
from clicklens.functions.columns import date_range
from clicklens.sources import adlines
from clicklens.sources.tables import visit_actions
from clicklens.streaming import jobs


def _visits(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    df = spark.table(a.table) if a.table else spark.read.parquet(a.parquet)
    return date_range(visit_actions(df), a.start_date, a.end_date)


def _emit(df: DataFrame, a: argparse.Namespace) -> None:
    if a.output_table:
        sinks.replace_table(df, a.output_table)
    elif a.output_path:
        df.write.mode("overwrite").parquet(a.output_path)
    elif a.jdbc_url:
        props = {k: v for k, v in (("user", a.jdbc_user), ("password", a.jdbc_password),
                                   ("driver", a.jdbc_driver)) if v}
        sinks.jdbc_append(sinks.as_jdbc_table(df, a.jdbc_table), a.jdbc_url, a.jdbc_table, props)
    else:
        sinks.console(df, a.show)


def _hot_categories(spark, a):
    return op.hot_category_top10(_visits(spark, a), a.top, task_id=a.task_id or str(uuid.uuid4()))


def _category_sessions(spark, a):
    out = op.hot_category_session_top10(_visits(spark, a), a.top, a.top_sessions)
    return out.select(F.lit(a.task_id or str(uuid.uuid4())).alias("task_id"), *out.columns)


def _page_flow(spark, a):
    return op.page_conversion(_visits(spark, a), a.flow, include_zero=a.include_zero)


def _page_dwell(spark, a):
    return op.page_avg_dwell(_visits(spark, a))


BATCH = {
    "hot-categories": _hot_categories,
    "category-sessions": _category_sessions,
    "page-flow": _page_flow,
    "page-dwell": _page_dwell,
}


def _lines(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.bootstrap_servers:
        limit = {"maxOffsetsPerTrigger": a.max_offsets} if a.max_offsets else {}
        return adlines.read_line_stream(spark, "kafka", bootstrap_servers=a.bootstrap_servers, topic=a.topic,
                                        starting_offsets=a.starting_offsets, **limit)
    limit = {"maxFilesPerTrigger": a.max_files} if a.max_files else {}
    return adlines.read_line_stream(spark, "text", path=a.input_path, **limit)


STATE_STORES = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


def _stream(spark: SparkSession, a: argparse.Namespace):
    # large keyed state belongs off the JVM heap; the provider is fixed when a checkpoint is created
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORES[a.state_store])
    trig = {"availableNow": True} if a.available_now else {"processingTime": f"{a.interval} seconds"}
    c = jobs.clicks_from(spark, a.out)
    if a.job == "ads-blacklist":
        return jobs.blacklist_stream(c, a.out, a.checkpoint, a.threshold, a.mode, trig,
                                     retain_days=a.retain_days, echo=a.echo)
    if a.job == "ads-daily":
        return jobs.ads_click_daily_stream(c, a.out, a.checkpoint, trig, a.watermark)
    if a.job == "ads-top3":
        return jobs.ads_area_top3_stream(c, a.out, a.checkpoint, TOP_ADS, trig, a.watermark)
    if a.arrival:
        return jobs.ads_arrival_trend_stream(c, a.out, a.checkpoint, trigger=trig, echo=a.echo > 0)
    return jobs.ads_window_stream(c, a.out, a.checkpoint, TREND_SLIDE_S, None, trig, a.watermark, echo=a.echo)


STREAM = ("ads-blacklist", "ads-daily", "ads-top3", "ads-trend")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m clicklens")
    p.add_argument("job", choices=[*BATCH, *STREAM])
    src = p.add_argument_group("batch input")
    src.add_argument("--table")
    src.add_argument("--parquet")
    src.add_argument("--start-date")
    src.add_argument("--end-date")
    src.add_argument("--flow", default="1,2,3,4,5,6,7")
    src.add_argument("--include-zero", action="store_true")
    src.add_argument("--top", type=int, default=TOP_CATEGORIES)
    src.add_argument("--top-sessions", type=int, default=TOP_SESSIONS)
    src.add_argument("--task-id")
    out = p.add_argument_group("batch output")
    out.add_argument("--output-table")
    out.add_argument("--output-path")
    out.add_argument("--jdbc-url")
    out.add_argument("--jdbc-table")
    out.add_argument("--jdbc-user")
    out.add_argument("--jdbc-password")
    out.add_argument("--jdbc-driver")
    out.add_argument("--show", type=int, default=100)
    st = p.add_argument_group("streams")
    st.add_argument("--bootstrap-servers")
    st.add_argument("--topic", default="ads_log")
    st.add_argument("--input-path")
    st.add_argument("--starting-offsets", default="latest", help="Kafka: where a new checkpoint starts")
    st.add_argument("--max-offsets", type=int, help="Kafka: records of a batch at most, e.g. after an outage")
    st.add_argument("--max-files", type=int, help="text: files of a batch at most")
    st.add_argument("--out")
    st.add_argument("--checkpoint")
    st.add_argument("--interval", type=int, default=TRIGGER_INTERVAL_S)
    st.add_argument("--available-now", action="store_true")
    st.add_argument("--threshold", type=int, default=BLACKLIST_THRESHOLD)
    st.add_argument("--mode", choices=["event_time", "micro_batch"], default="event_time")
    st.add_argument("--watermark")
    st.add_argument("--retain-days", type=int, help="ads-blacklist (event time): settle days older than this")
    st.add_argument("--echo", type=int, default=6,
                    help="ads-trend: newest N 10 s buckets per batch; ads-blacklist: N changed counters per batch")
    st.add_argument("--state-store", choices=sorted(STATE_STORES), default="rocksdb")
    st.add_argument("--arrival", action="store_true",
                    help="ads-trend: window the last minute by arrival time, as the reference did")
    p.add_argument("--time-zone")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"clicklens-{a.job}").getOrCreate()
    if a.time_zone:
        spark.conf.set("spark.sql.session.timeZone", a.time_zone)
    if a.job in BATCH:
        _emit(BATCH[a.job](spark, a), a)
        return
    trig = {"availableNow": True} if a.available_now else {"processingTime": f"{a.interval} seconds"}
    # the source is read once: clicks and rejected lines are stored, and the job follows the stored clicks
    split = jobs.split_lines_stream(_lines(spark, a), a.out, a.checkpoint.rstrip("/") + "-lines", trig)
    if a.available_now:
        split.awaitTermination()
    _stream(spark, a).awaitTermination()
    if not a.available_now:
        split.stop()
