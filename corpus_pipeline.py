"""A corpus from raw documents to sampled pieces, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all documents the stage
before it kept. All but the last return the columns of ``documents``. ``run``
writes what a stage returns to the shared folder and reads it for the next, so
a lost executor costs one stage at most.

Every stage takes empty tables (and returns none), nulls in any column, empty and very
long texts, repeated rows, and further columns of any name, which pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmill.llm import decontaminate, minhash, pieces, pii, quality_rules
from opsmill.session import materialise

# The tagger and the sampled pieces lie outside SQL; tests/llm/test_pipeline.py
# holds run() against a plain version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject: null, empty and short texts
    among them. Repeated rows are judged alike; texts without failing lines lose blank lines only."""
    return quality_rules.clean_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of least id. Of rows that share
    an id one stays. Rows without id, and texts without words, are copies of nothing and stay."""
    return minhash.clean_documents(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and empty texts hold
    none; without items all stay; repeated rows share one fate."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind; where spans overlap the earlier and then the
    longer one counts. Null and empty texts stay as they are, and all rows stay."""
    return pii.mask_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of each text, and whether they decode to it. A null text has null
    pieces, an empty one none. Rows with equal id and text have equal pieces."""
    made = pieces.round_trip(spark, docs.select("doc_id", "text"))
    return made.select(
        "doc_id", "pieces", F.size("pieces").cast("long").alias("n_pieces"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("sentencepiece", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
