"""The pipeline keeps what each stage promises."""

import corpus_pipeline
from flowloom.llm.queries import QUERIES


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "mix", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(stage(spark, docs, sf))
        after = docs.count()
        assert docs.columns == columns and 0 < after <= before, name
        before = after
    stored = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert stored.count() == before


def test_eleven_queries():
    assert [n for n in QUERIES if n.startswith("op")] == sorted([n for n in QUERIES if n.startswith("op")], key=lambda n: int(n[2:].split("_")[0]))
    assert len(QUERIES) == 11
