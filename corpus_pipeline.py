"""The corpus pipeline: toxicity, SimHash near-dedup, benchmark decontamination, PII, BPE, one after another.

Each stage takes what its predecessor kept, is written as Parquet below the shared folder and read again, so
a lost executor costs tasks of one stage and nothing is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clicklens.llm import bpe, decontaminate, pii, simhash, toxicity
from clicklens.llm.lineage import small_batches
from clicklens.llm.queries import toxicity_model, vocabulary
from clicklens.session import shared_dir
from clicklens.sources.tables import read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is trained on the labelled rows among ``docs``."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, toxicity_model(spark, sf_dir, docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=3, distance=2)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; the others stay as they are."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    from pyspark.sql import functions as F
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    small_batches(spark)
    carry = [c for c in docs.columns if c in ("doc_id", "lang", "source")]
    return bpe.encode_documents(docs, vocabulary(), ("n_tokens", "ids", "decoded_sha256"), carry=carry)


STAGES = [("toxicity", toxicity_stage), ("near_dedup", near_dedup_stage), ("decontaminate", decontaminate_stage),
          ("pii", pii_stage), ("bpe", bpe_stage)]

#: The classifier, XXH64 and BPE cannot be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    base = shared_dir(spark)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}_{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
