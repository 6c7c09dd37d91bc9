"""Further packet statistics: flag counts, sizes, directions, duplicate ACKs, goodput."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.ordered import last_before, split_hot_groups
from flowloom.functions.scalar import CONVERSATION, NS, endpoint_order, has_flag, window_id
from flowloom.functions.sized import lookup_join
from flowloom.operators.connections import MAX_ROWS, track_connections
from flowloom.operators.flows import GROUP, count_where
from flowloom.operators.packets import valid_size


def extra_packet_stats(packets: DataFrame, size_s: float = 5.0, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Flag counts, size spread, duration, jitter variance, goodput and overhead per flow window.

    ``jitter_variance`` is the sample variance of the absolute change between consecutive
    gaps, in square milliseconds.  Goodput counts payload that is no retransmission.
    """
    tracked = packets if "retransmission" in packets.columns else track_connections(packets, size_s, max_rows)
    gap = F.col("gap_ns")
    block = next((name for name in ("part_id", "slice_id") if name in tracked.columns), None)
    if block:
        held = {"_held": F.when(gap.isNotNull(), F.struct("window_id", "gap_ns"))}
        tracked = last_before(tracked, S.FLOW, block, S.ORDER, held)
        before = F.when(F.col("_held.window_id") == F.col("window_id"), F.col("_held.gap_ns"))
    else:
        earlier = Window.partitionBy(*GROUP).orderBy(*S.ORDER).rowsBetween(Window.unboundedPreceding, -1)
        before = F.last(gap, ignorenulls=True).over(earlier)
    tracked = tracked.withColumn("_change", F.abs(gap - before))
    valid = valid_size()
    tcp = valid & (F.col("protocol") == S.TCP)
    size, ts = F.when(valid, F.col("packet_size")), F.when(valid, F.col("ts_ns"))
    payload = F.when(valid, F.col("payload_size"))
    flags = {"ack_count": S.ACK, "urg_count": S.URG, "ece_count": S.ECE, "cwr_count": S.CWR}
    stats = tracked.groupBy(*GROUP).agg(
        *[count_where(tcp & has_flag(bit)).alias(name) for name, bit in flags.items()],
        F.min(size).alias("min_packet_size"),
        F.max(size).alias("max_packet_size"),
        F.coalesce(F.var_samp(size), F.lit(0.0)).alias("packet_size_variance"),
        ((F.max(ts) - F.min(ts)) / NS).alias("flow_duration"),
        (F.coalesce(F.avg(gap), F.lit(0.0)) / 1e6).alias("latency_mean_ms"),
        (F.coalesce(F.stddev_samp(gap), F.lit(0.0)) / 1e6).alias("latency_std_ms"),
        F.coalesce(F.var_samp(F.col("_change") / 1e6), F.lit(0.0)).alias("jitter_variance"),
        F.sum(F.when(F.col("retransmission"), F.lit(0)).otherwise(payload)).alias("_good"),
        F.sum(payload).alias("_payload"),
        F.sum(size).alias("_bytes"),
    )
    return stats.filter(F.col("_bytes") > 0).select(
        *[c for c in stats.columns if not c.startswith("_")],
        (F.col("_good") * 8 / F.lit(float(size_s)) / 1e6).alias("goodput_mbps"),
        (1 - F.col("_payload") / F.col("_bytes")).alias("overhead_ratio"),
    )


def flow_completion(packets: DataFrame) -> DataFrame:
    """Seconds from the first to the last packet of each flow, over all windows."""
    return packets.groupBy(*S.FLOW).agg(
        ((F.max("ts_ns") - F.min("ts_ns")) / NS).alias("flow_completion_time"), F.count(F.lit(1)).alias("packets")
    )


def with_completion(features: DataFrame, packets: DataFrame) -> DataFrame:
    """Add ``flow_completion_time`` to flow windows."""
    times = flow_completion(packets).drop("packets")
    return lookup_join(features, times, S.FLOW, spread=["window_id"])


def directional_features(packets: DataFrame, size_s: float = 5.0) -> DataFrame:
    """Packets and bytes by direction per conversation and window.

    Forward is the direction of the window's first packet.
    """
    slim = packets.filter(valid_size()).select(
        "host", "protocol", *endpoint_order_columns(), window_id(size_s=size_s).alias("window_id"), *S.ORDER, "packet_size"
    )
    way = F.col("dir")
    sums = slim.groupBy(*CONVERSATION, "window_id").agg(
        F.min_by("dir", F.struct(*S.ORDER)).alias("_first"),
        *[count_where(way == d).alias(f"_n{d}") for d in (0, 1)],
        *[F.coalesce(F.sum(F.when(way == d, F.col("packet_size"))), F.lit(0)).alias(f"_b{d}") for d in (0, 1)],
    )
    pick = lambda kind, flip: F.when(F.col("_first") == flip, F.col(f"_{kind}0")).otherwise(F.col(f"_{kind}1"))
    return sums.select(
        *CONVERSATION,
        "window_id",
        F.col("_first").alias("forward_dir"),
        pick("n", 0).alias("forward_packets"),
        pick("n", 1).alias("backward_packets"),
        pick("b", 0).alias("forward_bytes"),
        pick("b", 1).alias("backward_bytes"),
        (F.col("_n0") + F.col("_n1")).alias("bidirectional_packets"),
        (F.col("_b0") + F.col("_b1")).alias("bidirectional_bytes"),
    )


def endpoint_order_columns() -> list:
    return [c.alias(name) for name, c in endpoint_order().items()]


def dup_acks(packets: DataFrame, size_s: float = 5.0, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """TCP packets without payload that repeat the flow's preceding ACK number, per window."""
    tcp = packets.filter(F.col("protocol") == S.TCP).select(*S.FLOW, *S.ORDER, "tcp_ack", "payload_size")
    cut, block = split_hot_groups(tcp, S.FLOW, size_s, max_rows, tie="pkt_id")
    seen = last_before(cut, S.FLOW, block, S.ORDER, {"_before": F.col("tcp_ack")})
    same = (F.col("payload_size") == 0) & (F.col("tcp_ack") == F.col("_before"))
    return seen.groupBy(*GROUP).agg(count_where(same).alias("duplicate_acks"))
