"""Corpus pipeline: documents through filtering, de-duplication, decontamination and mixing to stored token ids.

``STAGES`` are applied in order; each stage reads what its predecessor kept.  All but the last return
the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowloom.functions.sized import keep
from flowloom.llm import decontaminate, mixing, near_dedup, token_store, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.remove_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target shares of sources, languages and topics."""
    return mixing.sample(docs, docs.columns)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, written in id order and read back: one row per document."""
    import public_tokenizers

    return token_store.store_and_read(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("tokens", store_tokens),
]

#: No SQL form: toxicity scores and near-duplicate groups cannot be stated in it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
