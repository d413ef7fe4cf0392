"""The registered queries of this package: each applies one operator, with the
parameters of production, to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import (
    bpe_transducer, divergence, log_bilinear, near_dedup, packing, phrase_graph, pii, quality_rules, token_store, toxicity,
    trigram_index, vector_dedup, warc)
from martforge.llm.common import crc_mod, documents
from martforge.session import scratch_path


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Trained on labels of keys whose crc32 modulo 3 is not 1."""
    return toxicity.train(*toxicity.sample(docs, documents(spark, sf_dir, "labels"), "toxic", crc_mod("doc_id", 3) != 1))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return (toxicity.scores(docs, toxicity_model(spark, docs, sf_dir))
            .withColumn("held_out", crc_mod("doc_id", 3) == 1))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(documents(spark, sf_dir))


def op5_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.score(documents(spark, sf_dir), crc_mod("doc_id", 5) != 1)


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, f"token-store/{uuid.uuid4().hex}")
    token_store.write(documents(spark, sf_dir), folder, vocabulary("word_bpe_49k.json"), end_id=2)
    return token_store.digests(token_store.read(spark, folder))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=1, with_ids=False)


def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(documents(spark, sf_dir, "embeddings"), threshold=0.93)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolved_pages(documents(spark, sf_dir, "pages"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe_transducer.round_trip_digests(
        documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trigram_index.digests(trigram_index.scan(documents(spark, sf_dir)))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_graph.collocations(documents(spark, sf_dir))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_near_dedup, op3_toxicity, op4_pii, op5_log_bilinear, op6_token_store, op7_packing,
        op8_vector_dedup, op9_warc, op10_bpe, op11_divergence, op12_secrets, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return {"op9_warc": warc.ORACLE, "op11_divergence": divergence.ORACLE, "op12_secrets": trigram_index.ORACLE,
            "op13_phrases": phrase_graph.ORACLE}
