"""Threshold rules that name faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.ordered import FAN, last_before
from flowloom.functions.scalar import idiv

# Label, fault, feature, comparison and threshold.
RULES = [
    (1, "cpu_throttling", "cpu_throttle_ratio", ">", 0.1),
    (2, "packet_loss", "retransmission_rate", ">", 0.05),
    (3, "latency_jitter", "inter_arrival_jitter", ">", 0.5),
    (4, "syn_flood", "syn_to_synack_ratio", ">", 10),
    (5, "memory_pressure", "memory_usage_percent", ">", 90),
    (6, "disk_saturation", "disk_queue_depth", ">", 10),
    (7, "backlog_overflow", "tcp_listen_overflows", ">", 0),
    (8, "zero_window", "zero_window_count", ">", 5),
    (9, "connection_churn", "tcp_resets", ">", 50),
    (10, "dns_failure", "dns_response_code", "=", 3),
    (11, "http_error", "http_status_code", ">=", 500),
]
FAULTS = {0: "normal", **{label: name for label, name, *_ in RULES}}


def _fires(feature: str, op: str, limit: float) -> Column:
    value = F.col(feature)
    test = {">": value > limit, ">=": value >= limit, "=": value == limit}[op]
    return F.coalesce(test, F.lit(False))


def detect_faults(features: DataFrame, thresholds: dict[int, float] | None = None) -> DataFrame:
    """Add one boolean per rule, all firing labels, and one label.

    ``fault_labels`` lists the labels of firing rules in ascending order.  ``rule_label`` is the
    smallest of them, 0 where none fires; no other precedence is defined.  ``thresholds``
    replaces limits by label.  ``normal_profile`` tells rows that look healthy: hardly any
    retransmission, SYNs answered one for one, and status 200 where there is one.
    """
    limits = thresholds or {}
    rules = {label: _fires(feature, op, limits.get(label, limit)) for label, _, feature, op, limit in RULES}
    out = features.withColumns({f"is_{FAULTS[label]}": fires for label, fires in rules.items()})
    labels = F.array_compact(F.array(*[F.when(F.col(f"is_{FAULTS[n]}"), F.lit(n)) for n in rules]))
    healthy = (
        (F.col("retransmission_rate") < 0.01)
        & F.col("syn_to_synack_ratio").between(0.5, 2.0)
        & F.col("http_status_code").isin(0, 200)
    )
    return out.withColumns(
        {
            "fault_labels": labels,
            "rule_label": F.coalesce(F.try_element_at(labels, F.lit(1)), F.lit(0)),
            "normal_profile": F.coalesce(healthy, F.lit(False)),
        }
    )


def label_confusion(detected: DataFrame) -> DataFrame:
    """Rows per pair of given label and rule label."""
    return detected.groupBy("anomaly_label", "rule_label").agg(F.count(F.lit(1)).alias("rows"))


def backlog_growth(host: DataFrame) -> DataFrame:
    """Windows in which the listen overflow counter grew, instead of ever having been above 0."""
    blocks = host.withColumn("_block", idiv("window_id", FAN))
    seen = last_before(blocks, ["host"], "_block", ["window_id"], {"_before": F.col("tcp_listen_overflows")})
    grew = F.col("tcp_listen_overflows") - F.coalesce("_before", F.lit(0))
    return seen.select(
        "host", "window_id", grew.alias("overflows_delta"), (grew > 0).cast("int").alias("is_backlog_overflow")
    )
