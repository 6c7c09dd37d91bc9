"""Small tables with the awkward cases every operator must take: nulls, blanks, repeats, extra columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score string, term int, _h string, rep string"


def documents(spark: SparkSession, texts: dict[int | None, str | None] | list[tuple]) -> DataFrame:
    rows = texts.items() if isinstance(texts, dict) else texts
    return spark.createDataFrame([(i, t, None, f"src{(i or 0) % 3}" if i != 5 else None, len(t or ""), "x", 1, "y", "z") for i, t in rows], DOCUMENTS)


def prose(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
