"""From raw documents to encoded training data, in five stages.

Each stage works on all rows its predecessor kept; what it returns is written
as Parquet and read again before the next. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import mixing, ordinal_quality, secret_ledger, sentencepiece_codec, simhash
from txnrisk.llm.common import read_table, staged
from txnrisk.session import scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are clean by the ordinal classifier, which is fitted on the rated ones among them."""
    model = ordinal_quality.train(docs, read_table(spark, sf_dir, "labels"))
    return ordinal_quality.score(docs, model).where("kept").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return simhash.keep_first(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a sign and ``n_chars`` counted anew where that changed the text."""
    ledger = secret_ledger.Ledger(spark, scratch(spark, "secret-ledger"))
    secret_ledger.scan(docs, ledger)
    found = secret_ledger.with_findings(docs, ledger)
    clean = secret_ledger.redacted(F.col("text"), F.col("spans"))
    rows = found.withColumn("text", clean)
    if "n_chars" in docs.columns:
        changed = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        rows = rows.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return rows.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as many times as it is taken."""
    return mixing.take(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids."""
    return sentencepiece_codec.encode(docs).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

#: Classifier, fingerprints and subword segmentation have no SQL form; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
