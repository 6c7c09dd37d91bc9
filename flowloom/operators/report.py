"""Reports over feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.ordered import FAN, running_total
from flowloom.functions.scalar import idiv, size_ns
from flowloom.operators.flows import count_where

LABELS = 12
ROWS_PER_LABEL = 100
#: Blocked addresses that a status row names.
SHOWN = 5


def run_summary(features: DataFrame) -> DataFrame:
    """One row: feature rows, flow windows with retransmissions, highest retransmission rate."""
    again = F.col("retransmission_count") > 0
    return features.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_where(again).alias("flows_with_retransmissions"),
        F.coalesce(F.max("retransmission_rate"), F.lit(0.0)).alias("max_retransmission_rate"),
    )


def retransmission_rows(features: DataFrame, limit: int = 20) -> DataFrame:
    """The first rows with retransmissions, in a fixed order, with the columns that tell why."""
    names = ["timestamp", "flow_id", "retransmission_count", "retransmission_rate", "consecutive_retrans",
             "http_status_code", "anomaly_label"]
    shown = features.filter(F.col("retransmission_count") > 0).select(*names)
    return shown.orderBy("timestamp", "flow_id").limit(limit)


def flood_summary(syn: DataFrame, blocklist: DataFrame, show: int = 5) -> DataFrame:
    """One row: SYN packets over all sources, blocked sources, and the first few of them."""
    total = syn.agg(F.coalesce(F.sum("syn_in_window"), F.lit(0)).alias("total_syns"))
    few = blocklist.orderBy("block_ts", "src_ip").limit(show)
    named = few.agg(F.array_join(F.array_sort(F.collect_list("src_ip")), ", ").alias("blocked_ips"))
    counted = blocklist.agg(F.count(F.lit(1)).alias("blocked_sources"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    return one(total).join(one(counted), "_one").join(one(named), "_one").drop("_one")


def label_balance(features: DataFrame, per_label: int = ROWS_PER_LABEL) -> DataFrame:
    """Rows per label next to the number wanted, for all twelve labels."""
    spark = features.sparkSession
    labels = spark.range(LABELS).select(F.col("id").cast("int").alias("anomaly_label"))
    counts = features.groupBy("anomaly_label").agg(F.count(F.lit(1)).alias("rows"))
    rows = F.coalesce("rows", F.lit(0))
    return labels.join(counts, "anomaly_label", "left").select(
        "anomaly_label",
        rows.alias("rows"),
        F.lit(per_label).alias("wanted"),
        F.greatest(F.lit(0), per_label - rows).alias("missing"),
    )


def periodic_status(features: DataFrame, blocklist: DataFrame, interval_s: float = 30, size_s: float = 5.0) -> DataFrame:
    """Feature rows and blocked sources so far, at the end of each reporting interval, with the first five blocked addresses.

    ``features`` has host, window_id, cpu_usage_percent and memory_usage_percent; a row counts
    from the end of its window on.  CPU and memory are the highest values of the interval.  Intervals in
    which no window ended and no source was blocked have no row.
    """
    step = size_ns(interval_s)
    at = lambda ns: (idiv(ns, step) + 1).alias("interval")
    zero = F.lit(0).cast("long")
    rows = features.groupBy("host", at((F.col("window_id") + 1) * F.lit(size_ns(size_s)).cast("long") - 1)).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max("cpu_usage_percent").alias("cpu_usage_percent"),
        F.max("memory_usage_percent").alias("memory_usage_percent"),
    )
    blocks = blocklist.groupBy("host", at(F.col("block_ts"))).agg(F.count(F.lit(1)).alias("_blocked"))
    both = rows.join(blocks, ["host", "interval"], "full").fillna(0, ["_rows", "_blocked"])
    cut = both.withColumn("_block", idiv("interval", FAN))
    sums = {"feature_rows": F.coalesce("_rows", zero), "blocked_sources": F.coalesce("_blocked", zero)}
    total = running_total(cut, ["host"], "_block", ["interval"], sums)
    order = Window.partitionBy("host").orderBy("block_ts", "src_ip")
    first = blocklist.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= SHOWN)
    listed = first.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("_rank", at(F.col("block_ts")), "src_ip"))).alias("_first"))
    shown = F.transform(F.filter("_first", lambda b: b["interval"] <= F.col("interval")), lambda b: b["src_ip"])
    load = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("cpu_usage_percent", "memory_usage_percent")]
    return total.join(listed, "host", "left").select(
        "host", (F.col("interval") * F.lit(float(interval_s))).alias("elapsed_s"), "feature_rows", "blocked_sources", *load, F.coalesce(F.array_join(shown, ", "), F.lit("")).alias("blocked_ips")
    )

