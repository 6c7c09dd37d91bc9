"""Mixing sources to target weights by iterative proportional fitting.

Token counts per cell (source, language, topic) are raked until their sums meet a target share per
source, per language and per topic.  Documents are then sampled with a probability in proportion to
the raked weight per token of their cell.  Only the cells, one row per combination that occurs, are
iterated over; documents are read twice and never shuffled.  DataFrame functions only.

Defined cases: nulls in source or language are a value of their own; null or empty texts have no
tokens and are kept with their cell's probability, or 1 in a cell without tokens; repeated rows are
sampled alike, because the draw is a hash of the document id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.sized import keep

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """Coarse kind of a text: table, legal, contact or prose."""
    return (
        F.when(F.coalesce(text, F.lit("")) == "", NONE)
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(text.rlike("(?i)licen[cs]ed? |rights reserved"), "legal")
        .when(F.contains(text, F.lit("@")), "contact")
        .otherwise("prose")
    )


def with_cells(documents: DataFrame) -> DataFrame:
    """The rows as one struct, with the three cell columns."""
    text = F.col("text")
    return documents.select(
        F.struct("*").alias("_row"), F.coalesce("source", F.lit(NONE)).alias("source"), F.coalesce("lang", F.lit(NONE)).alias("lang"),
        topic(text).alias("topic"), n_tokens(text).alias("n_tokens"),
    )


def tempered_targets(cells: DataFrame, power: float) -> dict[str, DataFrame]:
    """Target share per value of each dimension: its tokens to the given power, summing to 1."""
    out = {}
    for dim in DIMENSIONS:
        sums = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("t"))
        out[dim] = keep(sums.crossJoin(F.broadcast(sums.agg(F.sum("t").alias("all")))).select(dim, F.when(F.col("all") > 0, F.col("t") / F.col("all")).otherwise(0.0).alias("target")))
    return out


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], sweeps: int, tolerance: float = 1e-6, most: int = 100) -> DataFrame:
    """Scale ``weight`` to each dimension's target in turn, ``sweeps`` times, and again until the targets are met.

    A value that no target names keeps no weight; a value without tokens is left out of the sums.
    Targets are joined to the cells once; a sweep is window sums over the stored cells, so that neither
    its plan nor the driver's memory grows with the number of sweeps.  After ``sweeps`` sweeps more follow
    while some sum is off its target by more than ``tolerance``, up to ``most``: targets that contradict each
    other cannot all be met, see :func:`residual`.
    """
    columns = cells.columns
    for dim, target in targets.items():
        cells = cells.join(target.select(F.col(dim), F.col("target").alias(f"_to_{dim}")).hint("merge"), dim, "left")
    cells, done = keep(cells), 0
    while True:
        for _ in range(min(2, sweeps - done) if done < sweeps else 2):
            for dim in targets:
                total = F.sum("weight").over(Window.partitionBy(dim))
                factor = F.when(total > 0, F.coalesce(f"_to_{dim}", F.lit(0.0)) / total).otherwise(0.0)
                cells = cells.withColumn("weight", F.col("weight") * factor)
            done += 1
        cells = keep(cells)
        if done >= sweeps and (done >= most or residual(cells, list(targets)) <= tolerance):
            return cells.select(*columns)


def residual(cells: DataFrame, dims: Sequence[str]) -> float:
    """Largest distance of a dimension value's weight from its target, over values that have weight."""
    worst = 0.0
    for dim in dims:
        sums = cells.groupBy(dim).agg(F.sum("weight").alias("_sum"), F.first(f"_to_{dim}").alias("_to")).filter(F.col("_sum") > 0)
        worst = max(worst, sums.agg(F.max(F.abs(F.col("_sum") - F.coalesce("_to", F.lit(0.0))))).first()[0] or 0.0)
    return worst


def probabilities(cells: DataFrame, keep_share: float, rounds: int = 8) -> DataFrame:
    """Add ``p``, the keep probability, so that about ``keep_share`` of all tokens stay.

    ``p`` is in proportion to weight per token, at most 1; what the limit takes from a cell is
    given to the others in further rounds.
    """
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    rated = keep(cells.withColumn("ratio", ratio))
    total = rated.agg(F.sum("tokens")).first()[0] or 0
    scale = keep_share * total
    for _ in range(rounds):
        full = F.col("ratio") * F.lit(scale) >= 1
        capped, free = rated.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not capped or not free:
            break
        scale = max(scale, (keep_share * total - capped) / free)
    return rated.withColumn("p", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("ratio") * F.lit(float(scale)))).otherwise(1.0))


def draw(doc_id: Column) -> Column:
    """Uniform number in [0, 1) that depends on the id alone."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def mix(
    documents: DataFrame, keep_share: float = 0.5, power: float = 0.5, sweeps: int = 10, targets: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """All rows with ``source, lang, topic, n_tokens, weight`` (raked share of the cell), ``p``, ``sampled``.

    ``targets`` maps a dimension to a table (value, ``target``); without it tokens to the power
    ``power`` are the targets, which lifts small sources, languages and topics.  The original row
    is the struct ``_row``.
    """
    rows = with_cells(documents)
    cells = keep(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")).withColumn("weight", F.col("tokens").cast("double")))
    raked = rake(cells, targets or tempered_targets(cells, power), sweeps)
    rates = keep(probabilities(raked, keep_share).select(*DIMENSIONS, "weight", "p"))
    return rows.join(rates, list(DIMENSIONS)).withColumn("sampled", draw(F.col("_row.doc_id")) < F.col("p"))


def sample(documents: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """The sampled documents with their own columns."""
    chosen = mix(documents, **options).filter("sampled").select("_row.*")
    return chosen.select(*columns) if columns else chosen
