"""The corpus pipeline over ``documents``: toxic documents go, then those the
weighed quality rules reject, then all but one document of each group of near
duplicates; personal data is masked, and what remains is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next stage's documents.  All but the last return the
columns of ``documents``.  Documents with null or empty text fail the base test
of the quality rules and go there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from martforge.llm import near_dedup, packing, pii, quality_rules, toxicity
from martforge.llm.common import documents
from martforge.llm.queries import toxicity_model, vocabulary
from martforge.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=1, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_good),
    ("near_dedup", keep_first),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline/{uuid.uuid4().hex}/{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# the stages train models and decide near duplicates; SQL cannot express them
ORACLE_SQL = None
