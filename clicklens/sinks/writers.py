"""Sinks (SNK1-SNK7) as plain DataFrame writers.

The reference's keyed stores (counter hashes, JSON documents, a user set) live in the state of streaming queries; what
a batch changes is written as absolute values, one plain Parquet partition for each batch, which a replayed batch
writes again. Readers take the newest batch's value of each key (SNK4, SNK6). Documents that replace others (SNK5)
are partitions written over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"


def replace_table(df: DataFrame, table: str, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """SNK1: drop-and-recreate a catalog table (``overwrite``), optionally stored at ``path``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 1000) -> None:
    """SNK2/SNK3: append rows to a JDBC table. Each task opens one connection and inserts in batches."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.jdbc(url, table, mode="append", properties=props)


# Columns of the target tables of SNK2 and SNK3 by ours (fixed values).
JDBC_COLUMNS = {
    "category_top10": {"task_id": "taskId"},
    "category_top10_session_count": {"task_id": "taskId", "category_id": "categoryId", "session_id": "sessionId",
                                     "click_count": "clickCount"},
}


def as_jdbc_table(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the column names of a known target table (others stay as they are)."""
    return df.withColumnsRenamed(JDBC_COLUMNS.get(table, {}))


def console(df: DataFrame, n: int = 20) -> None:
    """SNK7: print the first ``n`` rows (``DStream.print`` / ``show``)."""
    df.show(n, truncate=False)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write one micro-batch's rows as partition ``batch_id`` (replay overwrites only that partition).

    ``partition_by`` adds columns above ``batch_id`` (e.g. the day), so that a reader lists and reads only the folders it needs.
    """
    # AQE rebalance: few files per partition value, and a hot value is still split across tasks
    out = df.withColumn(BATCH, F.lit(int(batch_id)).cast("long")).hint("rebalance", *partition_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, BATCH).parquet(path))


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """SNK5: replace the documents of the partitions that ``df`` holds (dynamic overwrite); others keep their files.

    ``df`` must hold these partitions whole, so that writing it again changes nothing."""
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str, upto: int | None = None,
                 parts: Sequence[str] | None = None) -> DataFrame:
    """All batches written so far (``upto`` inclusive) with their ``batch_id``; empty if none yet.

    ``parts``: only these folders below ``path`` (such as ``dt=2024-01-01``) are listed."""
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    full = T.StructType(list(schema.fields) + [T.StructField(BATCH, T.LongType())])
    try:
        paths = [path] if parts is None else [f"{path}/{p}" for p in parts]
        df = spark.read.schema(full).option("basePath", path).parquet(*paths)
    except AnalysisException:
        return spark.createDataFrame([], full)
    return df if upto is None else df.filter(F.col(BATCH) <= upto)


def read_batch(spark: SparkSession, path: str, schema: T.StructType | str, batch_id: int) -> DataFrame:
    """Exactly the rows of one batch's partition (empty if that batch wrote nothing)."""
    return read_batches(spark, path, schema).filter(F.col(BATCH) == int(batch_id)).drop(BATCH)


def latest_per_key(log: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """SNK4/SNK5 read side: the newest value of every key across batches (``max_by`` on batch_id)."""
    newest = F.max_by(F.struct(*values), F.col(BATCH)).alias("_v")
    return log.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])
