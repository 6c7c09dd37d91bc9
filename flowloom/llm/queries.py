"""Registered queries of the training-data operators; each runs over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import cross_tokens, decontaminate, disclosure, knn, licenses, main_text, mixing, near_dedup, periodic_runs, secrets, token_store, toxicity, warc
from flowloom.llm.oracles import ORACLE


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark, sf_dir):
    return secrets.report(read(spark, sf_dir, "documents"))


def op2_token_store(spark, sf_dir):
    import public_tokenizers

    return token_store.store_and_read(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_licenses(spark, sf_dir):
    """Documents as files: source and ranges of ids are the directories, round ids their licence files."""
    source = F.coalesce("source", F.lit("unknown"))
    number = F.coalesce(F.col("doc_id"), F.lit(-1))
    wide, narrow = F.floor(number / 1024).cast("string"), F.floor(number / 32).cast("string")
    path = (
        F.when(number % 32768 == 0, F.concat_ws("/", source, F.lit("LICENSE")))
        .when(number % 1024 == 0, F.concat_ws("/", source, wide, F.lit("LICENSE")))
        .when(number % 32 == 0, F.concat_ws("/", source, wide, narrow, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", source, wide, narrow, F.concat(number.cast("string"), F.lit(".txt"))))
    )
    files = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), path.alias("path"), "text")
    return licenses.scan(files).withColumn("cosine", F.round("cosine", 6)).withColumnRenamed("id", "doc_id")


def op4_near_dedup(spark, sf_dir):
    return near_dedup.group_documents(read(spark, sf_dir, "documents"))


def op5_mixing(spark, sf_dir):
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("_row.doc_id").alias("doc_id"), "source", "lang", "topic", "n_tokens", F.round("weight", 9).alias("weight"), F.round("p", 6).alias("p"), "sampled"
    )


def op6_warc(spark, sf_dir):
    found = warc.archive_and_read(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_main_text(spark, sf_dir):
    return main_text.report(read(spark, sf_dir, "pages"))


def op8_decontaminate(spark, sf_dir):
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("n_near_items")


def op9_knn(spark, sf_dir):
    return knn.top_k(read(spark, sf_dir, "embeddings"))


def op10_toxicity(spark, sf_dir):
    return toxicity.report(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_cross_tokens(spark, sf_dir):
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return cross_tokens.report(read(spark, sf_dir, "documents"), *paths)


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.report(read(spark, sf_dir, "documents"), periodic=True)


def op13_disclosure(spark, sf_dir):
    return disclosure.report(read(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_token_store": op2_token_store,
    "op3_licenses": op3_licenses,
    "op4_near_dedup": op4_near_dedup,
    "op5_mixing": op5_mixing,
    "op6_warc": op6_warc,
    "op7_main_text": op7_main_text,
    "op8_decontaminate": op8_decontaminate,
    "op9_knn": op9_knn,
    "op10_toxicity": op10_toxicity,
    "op11_cross_tokens": op11_cross_tokens,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_disclosure": op13_disclosure,
    "pipeline": pipeline,
}
__all__ = ["ORACLE", "QUERIES", "read"]
