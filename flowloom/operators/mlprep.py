"""Training-set preparation over feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom import schema as S
from flowloom.functions.ordered import row_numbers
from flowloom.functions.scalar import idiv
from flowloom.functions.sized import lookup_join

#: Rows of one key that stay together while sequences are built.
SEQUENCE_BLOCK = 4096


def numeric_features(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def feature_stats(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per feature: count, mean, population deviation, minimum and maximum."""
    aggs = {"n": F.count, "mean": F.avg, "std": F.stddev_pop, "low": F.min, "high": F.max}
    wide = features.agg(*[
        F.struct(*[fn(F.col(c).cast("double")).alias(k) for k, fn in aggs.items()]).alias(c) for c in names
    ])
    listed = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in names])
    return wide.select(F.explode(listed).alias("f")).select("f.feature", "f.s.*")


def scale(features: DataFrame, names: Sequence[str], method: str = "standard") -> DataFrame:
    """Replace numeric columns by scaled ones.

    ``standard`` subtracts the mean and divides by the population deviation; ``minmax`` maps
    the range to 0..1.  Constant columns become 0.  One pass gathers one row of statistics.
    """
    if method not in ("standard", "minmax"):
        raise ValueError("method is 'standard' or 'minmax'")
    stats = {r["feature"]: r for r in feature_stats(features, names).collect()}

    def scaled(name: str) -> Column:
        s = stats[name]
        base, width = (s["mean"], s["std"]) if method == "standard" else (s["low"], (s["high"] or 0) - (s["low"] or 0))
        if not width:
            return F.lit(0.0)
        return (F.col(name).cast("double") - F.lit(base)) / F.lit(width)

    return features.withColumns({name: scaled(name) for name in names})


def class_weights(features: DataFrame, label: str = "anomaly_label") -> DataFrame:
    """Per label: its rows and the weight ``all rows / (labels * rows)``."""
    counts = features.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("_all"), F.count(F.lit(1)).alias("_labels")).withColumn("_one", F.lit(1))
    joined = counts.withColumn("_one", F.lit(1)).join(total, "_one")
    return joined.select(label, "rows", (F.col("_all") / (F.col("_labels") * F.col("rows"))).alias("weight"))


def with_class_weights(features: DataFrame, label: str = "anomaly_label") -> DataFrame:
    """Add ``weight`` to every row; most rows carry one label, so the table is joined by size."""
    spread = [c for c in ("flow_id", "timestamp", "window_id") if c in features.columns] or features.columns[:2]
    return lookup_join(features, class_weights(features, label).drop("rows"), [label], spread=spread)


def stratified_folds(
    features: DataFrame, k: int = 5, label: str = "anomaly_label", by: Sequence[str] = (*S.FLOW, "window_id")
) -> DataFrame:
    """Add ``fold`` 0..k-1 so that every fold has an even share of every label.

    Rows of a label are put in the order of an md5 over ``by`` and dealt out in turn.  Their
    positions are counted over slices of the hash, so a label that holds most rows is spread.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in by]))
    marked = features.withColumns({"_hash": digest, "_slice": F.conv(F.substring(digest, 1, 4), 16, 10).cast("long")})
    ranked = row_numbers(marked, [label], "_slice", ["_hash", *by], "_rank")
    fold = F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")
    return ranked.withColumn("fold", fold).select(*features.columns, "fold")


def sequences(
    features: DataFrame, names: Sequence[str], length: int = 5, keys: Sequence[str] = tuple(S.FLOW), order: str = "window_id",
    ties: Sequence[str] = (), carry: Sequence[str] = (),
) -> DataFrame:
    """Per row: the values of the last ``length`` windows of its flow, oldest first, and the columns ``carry`` as they are.

    A flow is a host and its addresses; the short hash ``flow_id`` can be shared by several.  Rows of
    equal ``order`` are put in the order of ``ties``, then of their values.  Rows are numbered per flow
    and cut into blocks of ``SEQUENCE_BLOCK`` or, if longer, ``length`` rows; the last rows of a block are
    repeated at the head of the next one, so long-lived flows are spread.
    """
    size = max(SEQUENCE_BLOCK, length)
    slim = features.select(*keys, order, *[c for c in ties if c not in names], *names, *carry).withColumn("_slice", idiv(order, SEQUENCE_BLOCK))
    numbered = row_numbers(slim, keys, "_slice", [order, *ties, *names], "_row")
    block = idiv(F.col("_row") - 1, size)
    at = F.pmod(F.col("_row") - 1, F.lit(size))
    lead_in = F.when(at > size - length, block + 1)
    spread = numbered.withColumn("_home", block).withColumn("_block", F.explode(F.array_compact(F.array(block, lead_in))))
    frame = Window.partitionBy(*keys, "_block").orderBy("_row").rowsBetween(-length + 1, 0)
    cols = [F.collect_list(F.col(c)).over(frame).alias(f"{c}_seq") for c in names]
    return spread.select(*keys, order, *carry, "_home", "_block", *cols).filter("_home = _block").drop("_home", "_block")


def feature_corr(features: DataFrame, names: Sequence[str], label: str = "anomaly_label") -> DataFrame:
    """Correlation of each feature with the label, in one pass; null where either is constant."""
    y = F.col(label).cast("double")

    def corr(name: str) -> Column:
        x = F.col(name).cast("double")
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    wide = features.agg(*[corr(c).alias(c) for c in names])
    listed = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in names])
    return wide.select(F.inline(listed))


def fit_baseline(features: DataFrame, names: Sequence[str], label: str = "anomaly_label", trees: int = 20, seed: int = 7):
    """A random forest over the given features; returns the fitted pipeline.

    Feature importances are in the last stage of the result.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=seed)
    return Pipeline(stages=[assembler, forest]).fit(features)


def feature_information(features: DataFrame, names: Sequence[str], label: str = "anomaly_label", bins: int = 10) -> DataFrame:
    """Mutual information of each feature with the label, in bits, and its share of the label's entropy.

    Features are cut at their quantiles, which come from mergeable sketches with an error of 1 in 100,000 ranks; equal values
    share a bin, nulls have one of their own.  One pass then counts (feature, bin, label) cells, which are all that is
    shuffled.  The share is null where the label is constant.
    """
    steps = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = features.agg(*[F.percentile_approx(F.col(c).cast("double"), steps, F.lit(100_000)).alias(f"_edges_{c}") for c in names])
    wide = features.select(F.col(label).alias("_label"), *names).crossJoin(F.broadcast(edges))

    def cell(name: str) -> Column:
        below = F.size(F.filter(f"_edges_{name}", lambda e: e < F.col(name).cast("double")))
        return F.struct(F.lit(name).alias("feature"), F.when(F.col(name).isNull(), F.lit(-1)).otherwise(below).alias("bin"))

    cells = wide.select("_label", F.inline(F.array(*map(cell, names)))).groupBy("feature", "bin", "_label").agg(F.count(F.lit(1)).alias("n"))
    # At most bins times labels rows per feature are left.
    of = lambda *keys: F.sum("n").over(Window.partitionBy("feature", *keys))
    totals = cells.select("feature", "n", of().alias("all"), of("bin").alias("b"), of("_label").alias("l"))
    bits = F.sum(F.col("n") / F.col("all") * F.log2(F.col("n") * F.col("all") / (F.col("b") * F.col("l"))))
    entropy = F.sum(F.col("n") / F.col("all") * F.log2(F.col("all") / F.col("l")))
    found = totals.groupBy("feature").agg(bits.alias("bits"), entropy.alias("_entropy"))
    return found.select("feature", "bits", F.when(F.col("_entropy") > 0, F.col("bits") / F.col("_entropy")).alias("share"))


def forest_importances(features: DataFrame, names: Sequence[str], label: str = "anomaly_label", trees: int = 20, seed: int = 7) -> DataFrame:
    """``feature, importance`` of a random forest over all rows; importances sum to 1."""
    model = fit_baseline(features, names, label, trees, seed).stages[-1]
    rows = [(name, float(x)) for name, x in zip(names, model.featureImportances.toArray(), strict=True)]
    return features.sparkSession.createDataFrame(rows, "feature string, importance double")


def baseline_by_fold(
    folds: DataFrame, names: Sequence[str], label: str = "anomaly_label", k: int = 5, trees: int = 20, seed: int = 7
) -> DataFrame:
    """Per fold of :func:`stratified_folds` and label: rows, and those that a forest over the other folds labels rightly."""
    from functools import reduce

    told = []
    for fold in range(k):
        model = fit_baseline(folds.filter(F.col("fold") != fold), names, label, trees, seed)
        told.append(model.transform(folds.filter(F.col("fold") == fold)).select("fold", F.col(label), (F.col("prediction") == F.col(label)).alias("_right")))
    return reduce(DataFrame.unionByName, told).groupBy("fold", label).agg(F.count(F.lit(1)).alias("rows"), F.count_if("_right").alias("correct"))
