"""Session and sample helpers: lineage is cut with ``DataFrame.checkpoint()`` in the folder that the cluster shares; Arrow batches stay small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.session import shared_dir


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed below ``spark.checkpoint.dir``; where that is unset, as in tests, below a folder of our own."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Arrow batches of at most ``rows`` rows in this session: of whole texts, the usual 10,000 take tens of
    megabytes several times over in the executor and in its Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def chosen(digest: Column, most: int, total: int) -> Column:
    """Is a row in a sample of about ``most`` of ``total`` rows? ``digest`` is its 64-bit hash, compared whole, so
    that the share is exact however many rows there are."""
    if most >= total:
        return F.lit(True)
    return digest < F.lit((most << 64) // total - (1 << 63))
