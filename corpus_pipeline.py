"""A corpus from raw documents: quality, exact copies, near copies, mixture, token ids.

``STAGES`` in order; each takes (spark, docs, sf_dir), where docs is what the stage before kept, and
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertable.llm import bpe, exact_dedup, minhash, mixing, quality
from rastertable.llm.common import shared_table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; learned from ``labels``."""
    model = quality.fit(shared_table(quality.features(docs), "features"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model)
    return scored.where(F.col("score") >= quality.THRESHOLD).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies that links connect, the document with the smallest doc_id."""
    return minhash.near_duplicates(docs).where("kept").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice is two rows."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the text they decode to."""
    return bpe.round_trip(docs)


STAGES = [("quality classifier", good), ("exact dedup", exact), ("near dedup", near), ("mixing", mixture),
          ("token ids", token_ids)]

#: No SQL for learned scores, similarity groups and subword ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from the table that the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
