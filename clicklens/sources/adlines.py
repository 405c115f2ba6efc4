"""The ad-click wire format: one space-separated line ``epoch_ms area city userid adid`` per click.

``encode_lines`` is the producer side (SNK8), ``parse_lines`` the consumer side (X2). Parsing is
positional like the reference, and user and ad ids are text as there; bad lines (too few fields, a time that
is no number or outside the years 1 to 9999, an empty id) go to a side DataFrame instead of failing the job. An optional sixth field carries the event id, which the
reference ignores (it reads fields 0-4 only) and which we use as a deterministic tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.defaults import LINE_SEPARATOR
from clicklens.functions.columns import DAY_FORMAT


def encode_lines(ads: DataFrame, with_id: bool = True) -> DataFrame:
    """(ts, area, city, userid, adid[, event_id]) -> ``value`` string lines."""
    fields = [F.unix_millis("ts").cast("string"), F.col("area"), F.col("city"),
              F.col("userid").cast("string"), F.col("adid").cast("string")]
    if with_id:
        fields.append(F.col("event_id").cast("string"))
    return ads.select(F.concat_ws(LINE_SEPARATOR, *fields).alias("value"))


def write_lines(ads: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str | None = None, **options):
    """SNK8: send lines to a topic (needs the Kafka connector). A streaming frame also needs ``checkpoint``
    and returns its running query."""
    lines = encode_lines(ads)
    writer = lines.writeStream.option("checkpointLocation", checkpoint) if lines.isStreaming else lines.write
    writer = writer.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
    for k, v in options.items():
        writer = writer.option(k, v)
    return writer.start() if lines.isStreaming else writer.save()


def _parsed(lines: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    parts = F.split(F.col("value"), LINE_SEPARATOR)
    return lines.select(
        *carry,
        F.col("value"),
        F.size(parts).alias("_n"),
        F.get(parts, 0).try_cast("long").alias("_ms"),
        F.get(parts, 1).alias("area"),
        F.get(parts, 2).alias("city"),
        F.get(parts, 3).alias("userid"),
        F.get(parts, 4).alias("adid"),
        F.get(parts, 5).try_cast("long").alias("event_id"),
    )


# Times that have a four-digit year (0001 to 9999): the day is text of that form, and no instant overflows.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def _is_good():
    return ((F.col("_n") >= 5) & F.coalesce(F.col("_ms").between(FIRST_MS, LAST_MS), F.lit(False))
            & (F.col("userid") != "") & (F.col("adid") != ""))


def parse_lines(lines: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Good lines -> (event_id, ts, dt, area, city, userid, adid) and the columns of ``carry``. Works on batch and
    streaming frames."""
    p = _parsed(lines, carry).filter(_is_good())
    ts = F.timestamp_millis("_ms")
    return p.select("event_id", ts.alias("ts"), F.date_format(ts, DAY_FORMAT).alias("dt"),
                    "area", "city", "userid", "adid", *carry)


def bad_lines(lines: DataFrame) -> DataFrame:
    """The side output: every line ``parse_lines`` rejects, unchanged."""
    return _parsed(lines).filter(~F.coalesce(_is_good(), F.lit(False))).select("value")


CLICK = "event_id long, ts timestamp, dt string, area string, city string, userid string, adid string"
LINE_KINDS = ("good", "bad")


def split_lines(lines: DataFrame) -> DataFrame:
    """Every line once: ``kind`` good with the click's columns, or bad with the line itself (``value``)."""
    p = _parsed(lines).withColumn("_good", F.coalesce(_is_good(), F.lit(False)))
    ts = F.timestamp_millis("_ms")
    fields = {"event_id": F.col("event_id"), "ts": ts, "dt": F.date_format(ts, DAY_FORMAT)}
    fields |= {c: F.col(c) for c in ("area", "city", "userid", "adid")}
    return p.select(F.when(~F.col("_good"), F.col("value")).alias("value"), *[F.when(F.col("_good"), c).alias(k) for k, c in fields.items()],
                    F.when(F.col("_good"), "good").otherwise("bad").alias("kind"))


def read_line_stream(spark: SparkSession, source: str = "kafka", **options) -> DataFrame:
    """SRC3: a streaming DataFrame with one string column ``value``.

    ``source="kafka"`` needs the Kafka connector on the class path and takes ``bootstrap_servers``
    and ``topic`` (offsets start at ``latest`` as in the reference); ``source="text"`` reads new
    files of a folder (``path``) and is what the tests use; ``partitions`` (column definitions) names columns that the
    folder names below it carry, such as ``arrival timestamp``.
    """
    if source == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", options.pop("bootstrap_servers"))
                  .option("subscribe", options.pop("topic"))
                  .option("startingOffsets", options.pop("starting_offsets", "latest")))
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if source == "text":
        path, partitions = options.pop("path"), options.pop("partitions", None)
        reader = spark.readStream.schema(", ".join(["value string", *([partitions] if partitions else [])]))
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.text(path)
    raise ValueError(f"unknown line source {source!r}")
