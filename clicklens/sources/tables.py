"""Batch sources: the driver's Parquet tables and the two logs derived from them.

The visit log and the ad log are *views*: lazy column expressions over ``events`` (plus the
customer -> nation -> region geography for ads). Nothing is materialised, so filters and column
pruning of a downstream query reach the Parquet scan of ``events``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.functions.columns import date_range
from clicklens.schemas import DRIVER_TABLES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan of one driver table; ``columns`` narrows the read schema.

    Tables with a declared schema (``schemas.DRIVER_TABLES``) are read with it -- only the requested
    columns -- so no inference job runs; others fall back to Parquet's own schema.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    ddl = DRIVER_TABLES.get(name)
    if ddl is None:
        df = spark.read.parquet(path)
        return df.select(*columns) if columns else df
    schema = T.StructType.fromDDL(ddl)
    if columns:
        schema = T.StructType([schema[c] for c in columns])
    return spark.read.schema(schema).parquet(path)


def _props_number(props: Column) -> Column:
    return F.regexp_extract(props, r"([0-9]+)", 1).try_cast("long")


def visit_log_from_events(events: DataFrame) -> DataFrame:
    """Map ``events`` onto the visit-log schema (one session = one user-day).

    click/view -> a click on category ``event_id % 20 + 1``; signup -> an order of two categories;
    purchase -> a payment of two categories; error -> a search (no category). Some lists repeat a
    category on purpose: duplicates count twice, as in the reference.
    """
    day = F.col("ts").cast("date").cast("string")
    cat = (F.col("event_id") % 20 + 1).cast("string")
    et = F.col("event_type")
    return events.select(
        F.col("event_id"),
        day.alias("date"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), day).alias("session_id"),
        (_props_number(F.col("props")) % 10 + 1).alias("page_id"),
        F.col("ts").alias("action_time"),
        F.when(et.isin("click", "view"), F.col("event_id") % 20 + 1).otherwise(F.lit(-1)).cast("long")
        .alias("click_category_id"),
        F.when(et == "signup", F.concat(cat, F.lit(","), ((F.col("event_id") * 7) % 20 + 1).cast("string")))
        .alias("order_category_ids"),
        F.when(et == "purchase", F.concat(cat, F.lit(","), ((F.col("event_id") * 3) % 20 + 1).cast("string")))
        .alias("pay_category_ids"),
    )


def visit_log(spark: SparkSession, sf_dir: str, start_date: str | None = None,
              end_date: str | None = None) -> DataFrame:
    """SRC1 + F1: the visit log of a table directory, optionally restricted to a date range.

    The range is stated on the derived ``date`` (exact) and, equivalently, on the raw ``ts``
    (``start 00:00 <= ts < end + 1 day``), which Spark pushes into the Parquet scan so row groups
    outside the range are skipped.
    """
    events = read_table(spark, sf_dir, "events")
    return date_range(visit_log_from_events(ts_day_range(events, "ts", start_date, end_date)), start_date, end_date)


def ts_day_range(df: DataFrame, ts_col: str, start: str | None, end: str | None) -> DataFrame:
    """Inclusive day range on a TIMESTAMP_NTZ column as pushable bounds on the column itself."""
    if start is not None and start.strip():
        df = df.filter(F.col(ts_col) >= F.lit(start.strip()).cast("date").cast("timestamp_ntz"))
    if end is not None and end.strip():
        df = df.filter(F.col(ts_col) < F.date_add(F.lit(end.strip()).cast("date"), 1).cast("timestamp_ntz"))
    return df


def visit_actions(df: DataFrame) -> DataFrame:
    """Normalise a visit log in the reference's format for the operators.

    ``action_time`` given as ``yyyy-MM-dd HH:mm:ss`` text becomes a TIMESTAMP_NTZ (a timestamp is
    taken as its wall clock). A log without ``event_id`` gets a hash of (session, time, page) instead:
    a deterministic tie-break for a session's actions with equal times -- rows equal on all three are
    interchangeable for page pairs and dwell times. Only those columns feed the hash, so column
    pruning still reaches the scan.
    """
    types = dict(df.dtypes)
    out = df
    if types.get("action_time") == "string":
        out = out.withColumn("action_time", F.to_timestamp_ntz(F.col("action_time"), F.lit("yyyy-MM-dd HH:mm:ss")))
    elif types.get("action_time") == "timestamp":
        out = out.withColumn("action_time", F.col("action_time").cast("timestamp_ntz"))
    if "event_id" not in types:
        basis = [c for c in ("session_id", "action_time", "page_id") if c in types] or list(df.columns)
        out = out.withColumn("event_id", F.xxhash64(*[F.col(c) for c in basis]))
    return out


def catalog_scan(spark: SparkSession, table: str, start_date: str | None = None,
                 end_date: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """SRC1 over a catalog table (``spark.table``) -- the reference's Hive read, as expressions.

    ``columns`` narrows the read; the date bounds become column predicates that reach the scan
    (and prune partitions when the table is partitioned by ``date``).
    """
    df = spark.table(table)
    if columns:
        df = df.select(*columns)
    return date_range(df, start_date, end_date)


def catalog_scan_days(spark: SparkSession, table: str, days: DataFrame, columns: Sequence[str] | None = None,
                      day: str = "date") -> DataFrame:
    """SRC1 over the days of a (small) frame ``days`` with a column ``day``: a semi join on the partition column.

    The planner turns it into dynamic partition pruning: the days are evaluated first and only their folders are read.
    ``columns`` must hold ``day``."""
    df = spark.table(table)
    if columns:
        df = df.select(*columns)
    return df.join(days.select(day).distinct(), day, "left_semi")


def calendar(df: DataFrame, ts: str) -> DataFrame:
    """(date, weekday: 0 is Monday) for every day on which ``df`` has rows."""
    return (df.select(F.col(ts).cast("date").alias("d")).distinct()
            .select(F.col("d").cast("string").alias("date"), F.weekday("d").alias("weekday")))


def bind_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """SRC2: bind by column *name* to a declared schema (cast each present field; absent -> null)."""
    cols = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in cols else F.lit(None).cast(f.dataType))
                       .alias(f.name) for f in schema.fields])


def local_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """SRC4: a small driver-side list as a DataFrame (fixtures, parameters)."""
    return spark.createDataFrame(list(rows), schema)


def geo_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userid, area, city): customer -> nation -> region.

    ``nation`` and ``region`` are fixed-size dimensions (25 and 5 rows) and fall under Spark's
    broadcast threshold on their own; ``customer`` grows with the scale factor, so no hint is given
    for it -- the planner (and AQE at run time) chooses broadcast or sort-merge from its measured size.
    Area names may contain a space (``MIDDLE EAST``), which would break the space-separated log line,
    so spaces become ``-``.
    """
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (customer
            .join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("c_custkey").cast("string").alias("userid"),
                    F.regexp_replace("r_name", " ", "-").alias("area"),
                    F.col("n_name").alias("city")))


def ad_clicks(spark: SparkSession, sf_dir: str, last_s: int | None = None, slide_s: int = 10) -> DataFrame:
    """The ad log without geography: (event_id, ts, dt, userid, adid); ids are text, as in the log lines.

    ``last_s``: only the newest window of so many seconds, aligned to ``slide_s``. Its lower bound is stated on
    the raw column, so the Parquet scan skips row groups before it.
    ``ts`` is cast to an instant (TIMESTAMP) so it can carry a watermark; ``dt`` is the event's day.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "props"])
    if last_s is not None:
        # the whole bound is the subquery's value, so the scan can compare it with row-group statistics
        newest = F.unix_seconds(F.col("m").cast("timestamp"))
        start = F.timestamp_seconds(F.floor(newest / F.lit(slide_s)) * F.lit(slide_s) - F.lit(last_s - slide_s))
        lower = ev.agg(F.max("ts").alias("m")).select(start.cast("timestamp_ntz")).scalar()
        ev = ev.filter(F.col("ts") >= lower)
    return ev.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("ts").cast("date").cast("string").alias("dt"),
        F.col("user_id").cast("string").alias("userid"),
        (_props_number(F.col("props")) % 6 + 1).cast("string").alias("adid"),
    )


def with_geo(df: DataFrame, geo: DataFrame) -> DataFrame:
    """Attach (area, city) by ``userid``. Left join: an event of an unknown user keeps null geography."""
    return df.join(geo, "userid", "left")


def ads_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full ad log (event_id, ts, dt, area, city, userid, adid), one row per event."""
    return with_geo(ad_clicks(spark, sf_dir), geo_dim(spark, sf_dir)).select(
        "event_id", "ts", "dt", "area", "city", "userid", "adid")
