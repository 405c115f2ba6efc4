"""Scalar column helpers (all JVM-side built-ins, so they stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.defaults import CSV_SEPARATOR, DAY_FORMAT, TREND_SLIDE_S, TS_FORMAT  # noqa: F401

EPOCH_NTZ = "1970-01-01 00:00:00"
TS_MICROS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_blank(c: str | Column) -> Column:
    """Not null and not empty after trimming (trim = drop every char <= U+0020, as the JVM does)."""
    c = _c(c)
    return c.isNotNull() & c.rlike(r"[^\x00-\x20]")


def csv_ids(c: str | Column) -> Column:
    """Split a comma list like the JVM's ``String.split(",")``: trailing empty items are dropped,
    leading and inner ones kept; a value made only of commas yields no ids."""
    stripped = F.regexp_replace(_c(c), r",+\z", "")
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, CSV_SEPARATOR, -1))


def date_range(df: DataFrame, start: str | None = None, end: str | None = None,
               col: str = "date") -> DataFrame:
    """Optional inclusive range on a ``yyyy-MM-dd`` string column; a blank bound is open.

    Expressed as column predicates so the filter reaches the Parquet scan (and partition pruning
    when the log is stored ``partitionBy(col)``).
    """
    if start is not None and start.strip():
        df = df.filter(F.col(col) >= F.lit(start.strip()))
    if end is not None and end.strip():
        df = df.filter(F.col(col) <= F.lit(end.strip()))
    return df


def epoch_micros_ntz(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 for a TIMESTAMP_NTZ wall clock, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _c(c))


def epoch_seconds_ntz(c: str | Column) -> Column:
    """Whole seconds since the epoch (floor), i.e. the wall clock truncated to the second."""
    return F.floor(epoch_micros_ntz(c) / F.lit(1_000_000)).cast("long")


def format_epoch_ms(c: str | Column, fmt: str = TS_FORMAT) -> Column:
    """Epoch milliseconds -> formatted string in the session time zone."""
    return F.date_format(F.timestamp_millis(_c(c)), fmt)


def to_epoch_ms(c: str | Column, fmt: str = TS_FORMAT) -> Column:
    """Formatted string -> epoch milliseconds (session time zone)."""
    return F.unix_millis(F.to_timestamp(_c(c), fmt))


def floor_seconds(ts: str | Column, width_s: int) -> Column:
    """Floor an instant to a ``width_s``-second bucket aligned to the epoch (10 s: 15:11 -> 15:10)."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(_c(ts)) / F.lit(width_s)) * F.lit(width_s))


def bucket_label(ts: str | Column, width_s: int = TREND_SLIDE_S) -> Column:
    """The reference's trend label: ``yyyy-MM-dd HH:mm:s0`` for 10 s buckets."""
    return F.date_format(floor_seconds(ts, width_s), TS_FORMAT)


def ranked_json(rank: str | Column, key: str | Column, value: str | Column) -> Column:
    """Aggregate expression: a JSON object ``{"key": value, ...}`` whose entries follow ``rank``.

    Use inside ``agg`` over an already-limited group (top-N), never over an unbounded one.
    """
    entries = F.array_sort(F.collect_list(F.struct(_c(rank).alias("r"), _c(key).cast("string").alias("k"),
                                                   _c(value).alias("v"))))
    # a field of an array of structs is the array of that field, still in rank order
    return F.to_json(F.map_from_arrays(entries.getField("k"), entries.getField("v")))
