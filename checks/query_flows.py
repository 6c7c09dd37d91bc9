"""Registered queries of packet, connection, flow and flood operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixtures import table
from flowloom import schema as S
from flowloom.functions.scalar import ip_to_long, long_to_ip
from flowloom.functions.sized import small_side
from flowloom.operators import connections, flood, flows
from flowloom.operators import packets as pk

GROUP = flows.GROUP
BURST_FLOW, BURST_NS = ("node-0", "10.0.0.1", 1000, "10.0.0.2", 80, 6), 12_000_000_000


def rounded(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Round doubles to six digits, or to ``digits``, by arithmetic both engines share."""
    digits = digits or {}

    def value(field):
        if not isinstance(field.dataType, T.DoubleType):
            return F.col(field.name)
        scale = float(10 ** digits.get(field.name, 6))
        return (F.floor(F.col(field.name) * scale + 0.5) / scale).alias(field.name)

    return df.select(*[value(field) for field in df.schema.fields])


def packets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "packets")


def annotated(spark: SparkSession, sf: str) -> DataFrame:
    return pk.annotate_packets(packets(spark, sf))


def _flow(*names: str, **options):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        feats = flows.flow_features(annotated(spark, sf), **options)
        return rounded(feats.select(*GROUP, *names), {"zero_window_duration": 9, "handshake_latency": 9})

    return run


def packet_annotate(spark, sf):
    flags = [f"is_{n}" for n in ("fin", "syn", "rst", "psh", "ack", "urg")]
    return annotated(spark, sf).select("pkt_id", "payload_size", "error_flags", "l7_protocol", "dns_flags", *flags)


def packet_annotate_compat(spark, sf):
    return pk.annotate_packets(packets(spark, sf), compat=True).select("pkt_id", "payload_size", "l7_protocol")


def ip_filter(spark, sf):
    kept = pk.gate_protocols(pk.valid_packets(pk.filter_ip(packets(spark, sf), "10.0.0.3")))
    return kept.select("pkt_id", "src_ip", "dst_ip", "packet_size")


def ip_number(spark, sf):
    per_ip = packets(spark, sf).groupBy("src_ip").agg(F.count("*").alias("n"))
    numbered = per_ip.withColumn("ip_number", ip_to_long("src_ip"))
    return numbered.withColumn("ip_text", long_to_ip("ip_number"))


def conn_track(spark, sf):
    tracked = connections.track_connections(annotated(spark, sf))
    return tracked.select(
        "pkt_id", "window_id", "prev_seq", "retransmission", "out_of_order", "conn_state", "error_flags"
    )


def burst(spark: SparkSession, sf: str) -> DataFrame:
    """The packets, every second one moved to one instant of one flow."""
    odd, values = F.col("pkt_id") % 2 == 1, {**dict(zip(S.FLOW, BURST_FLOW, strict=True)), "ts_ns": BURST_NS}
    source = packets(spark, sf)
    return source.withColumns({n: F.when(odd, F.lit(v).cast(source.schema[n].dataType)).otherwise(F.col(n)) for n, v in values.items()})


def conn_track_burst(spark, sf):
    """Tracking where half of all packets share one instant of one flow, cut to parts of at most 500 rows."""
    tracked = connections.track_connections(pk.annotate_packets(burst(spark, sf)), max_rows=500)
    return tracked.select("pkt_id", "window_id", "prev_seq", "retransmission", "out_of_order", "conn_state", "error_flags")


def flow_burst(spark, sf):
    feats = flows.flow_features(pk.annotate_packets(burst(spark, sf)), max_rows=500)
    names = ["latency_p50", "latency_p95", "latency_p99", "tail_latency_ratio"]
    return rounded(feats.select(*GROUP, *names))


def flow_dns_compat(spark, sf):
    compat = pk.annotate_packets(packets(spark, sf), compat=True)
    return flows.flow_features(compat).select(*GROUP, "dns_failures")


def flow_syn(spark, sf):
    source = annotated(spark, sf)
    feats = flows.flow_features(source, syn=flood.syn_cumulative(source))
    names = ["syn_count_flow", "syn_count", "syn_ack_count", "syn_to_synack_ratio", "connection_rate"]
    return rounded(feats.select(*GROUP, *names))


def flood_gate(spark, sf):
    return flood.flood_gate(packets(spark, sf), 12).select("pkt_id", "host", "src_ip", "dropped")


def flood_gate_aligned(spark, sf):
    return flood.flood_gate_aligned(packets(spark, sf), 12).select("pkt_id", "host", "src_ip", "dropped")


def flood_blocklist(spark, sf):
    return flood.flood_blocklist(packets(spark, sf), 10)


def flood_steady(spark, sf):
    """Two sources that send just what a rate window takes, in thousands of pieces of one window; one sends a packet too many."""
    steady = packets(spark, sf).selectExpr(
        "'node-0' AS host", "concat('10.9.0.', CAST(pkt_id % 2 AS STRING)) AS src_ip", "(pkt_id div 2) * 100000000 AS ts_ns", "pkt_id"
    )
    extra = steady.filter("pkt_id % 6000 = 5990").withColumn("pkt_id", F.col("pkt_id") + 1_000_000_000)
    return flood.flood_blocklist(steady.unionByName(extra), 3, 0.25, piece=1, fan=64)


def blocked_rows(spark, sf):
    source = packets(spark, sf)
    blocklist = small_side(flood.flood_blocklist(source, 10))
    syn = flood.syn_cumulative(flood.passed(flood.mark_dropped(source, blocklist)))
    rows = flood.blocked_rows(blocklist, syn)
    return pk.conform(rows).select(
        "timestamp", "flow_id", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "packet_count", "byte_count",
        "packets_per_second", "bytes_per_second", "avg_packet_size", "is_blocked_flow", "syn_count", "syn_ack_count",
        "syn_to_synack_ratio", "half_open_connections", "connection_state", "error_rate", "anomaly_label",
        "anomaly_severity", "remediation_action",
    )


def blocked_flag(spark, sf):
    source = annotated(spark, sf)
    feats = flows.flow_features(source).select(*GROUP, "dst_ip")
    return flood.flag_blocked(feats.select(*GROUP), flood.flood_blocklist(source, 12))


QUERIES = {
    "packet_annotate": packet_annotate,
    "packet_annotate_compat": packet_annotate_compat,
    "ip_filter": ip_filter,
    "ip_number": ip_number,
    "conn_track": conn_track,
    "conn_track_burst": conn_track_burst,
    "flow_burst": flow_burst,
    "flow_core": _flow(
        "flow_id", "packet_count", "byte_count", "packets_per_second", "bytes_per_second", "avg_packet_size",
        "connection_duration", "inter_arrival_mean_ms", "inter_arrival_std_ms", "inter_arrival_jitter",
    ),
    "flow_observed_rate": _flow("packets_per_second", "connection_duration", rate_base="observed"),
    "flow_latency": _flow("latency_p50", "latency_p95", "latency_p99", "tail_latency_ratio"),
    "flow_retrans": _flow("retransmission_count", "retransmission_rate", "consecutive_retrans", "out_of_order_count"),
    "flow_tcp_flags": _flow(
        "tcp_resets", "rst_count", "fin_count", "psh_count", "syn_ack_count", "half_open_connections",
        "connection_state", "handshake_latency", "connection_churn", "abnormal_termination_ratio",
    ),
    "flow_tcp_window": _flow(
        "zero_window_count", "zero_window_duration", "tcp_window_min", "tcp_window_avg", "tcp_window_drops"
    ),
    "flow_ttl_payload": _flow("ttl_min", "ttl_avg", "ttl_stddev", "payload_entropy", "error_rate"),
    "flow_l7_mode": _flow("l7_protocol"),
    "flow_dns_compat": flow_dns_compat,
    "flow_dns_failures": _flow("dns_queries", "dns_responses", "dns_failures", rcode_mask=15),
    "syn_cumulative": lambda spark, sf: flood.syn_cumulative(annotated(spark, sf)),
    "flow_syn": flow_syn,
    "flood_gate": flood_gate,
    "flood_gate_aligned": flood_gate_aligned,
    "flood_blocklist": flood_blocklist,
    "flood_steady": flood_steady,
    "blocked_rows": blocked_rows,
    "blocked_flag": blocked_flag,
}

__all__ = ["QUERIES", "S", "annotated", "packets", "rounded"]
