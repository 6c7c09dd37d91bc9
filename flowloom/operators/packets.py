"""Packet filters and per-packet annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom import schema as S
from flowloom.functions.scalar import has_flag, idiv, l7_protocol, size_ns

UINT32 = 4_294_967_296


def filter_ip(df: DataFrame, ip: str | None = None) -> DataFrame:
    """Keep packets from or to ``ip``; no address keeps everything.

    Apply it after the flood gate and the SYN totals, which count a source's whole traffic.
    """
    return df if ip is None else df.filter((F.col("src_ip") == ip) | (F.col("dst_ip") == ip))


def valid_size(c: str = "packet_size"):
    return F.coalesce((F.col(c) > 0) & (F.col(c) < 65_536), F.lit(False))


def valid_packets(df: DataFrame) -> DataFrame:
    """Keep packets whose size an IPv4 header can state."""
    return df.filter(valid_size())


def gate_protocols(df: DataFrame) -> DataFrame:
    """Keep TCP, UDP and ICMP."""
    return df.filter(F.col("protocol").isin(S.TCP, S.UDP, S.ICMP))


def time_range(df: DataFrame, start_ns: int | None = None, duration_s: float = 0) -> DataFrame:
    """Bounded run: packets from ``start_ns`` on, for ``duration_s`` seconds; 0 means no end.

    Without ``start_ns`` a duration counts from the first packet of the table, which is one value
    joined to all rows; a stream has no first packet and needs ``start_ns``.
    """
    if start_ns is not None:
        df = df.filter(F.col("ts_ns") >= F.lit(start_ns))
    if duration_s <= 0:
        return df
    length = int(duration_s * 1e9)
    if start_ns is not None:
        return df.filter(F.col("ts_ns") < F.lit(start_ns + length))
    if df.isStreaming:
        raise ValueError("a stream needs start_ns to end after duration_s")
    first = df.agg(F.min("ts_ns").alias("_first_ns"))
    return df.join(F.broadcast(first), F.col("ts_ns") < F.col("_first_ns") + F.lit(length)).select(*df.columns)


def dedup_interfaces(df: DataFrame, within_s: float = 0.001) -> DataFrame:
    """Drop copies of a TCP or UDP packet that another interface of the host reported just before.

    Copies share addressing, IP identification, sequence and flags, lie within ``within_s`` seconds of
    the earliest one and come from another ``ifindex``.  ICMP and packets without identification have
    nothing to tell copies by and pass.  Rows are compared inside time cells of that length, with the
    rows of the cell before, so an identification that comes round again or stays the same is no matter.
    """
    length = size_ns(within_s)
    marked = F.col("ip_id").isNotNull() & F.col("protocol").isin(S.TCP, S.UDP)
    cell = idiv("ts_ns", length)
    same = [*S.FLOW, "ip_id", "tcp_seq", "tcp_flags"]
    spread = df.filter(marked).withColumn("_home", cell).withColumn("_cell", F.explode(F.array(cell, cell + 1)))
    before = Window.partitionBy(*same, "_cell").orderBy("ts_ns").rangeBetween(-length, 0)
    first = F.min(F.struct("ts_ns", "pkt_id", "ifindex")).over(before)
    kept = spread.withColumn("_first", first).filter("_home = _cell AND _first.ifindex <=> ifindex")
    return kept.select(*df.columns).unionByName(df.filter(~F.coalesce(marked, F.lit(False))))


def payload_size(wrap: bool = False):
    """Bytes behind the transport header; ``wrap`` gives the unsigned 32-bit value below zero."""
    tcp = F.col("ip_total_len") - F.col("ip_header_len") - F.col("tcp_header_len")
    size = F.when(F.col("protocol") == S.TCP, tcp).when(F.col("protocol") == S.UDP, F.col("udp_len") - 8).otherwise(0)
    size = size.cast("long")
    return F.pmod(size, F.lit(UINT32)) if wrap else F.greatest(size, F.lit(0).cast("long"))


def base_error_flags():
    """Error bits one packet shows by itself; order-dependent bits come from tracking."""
    tcp = F.col("protocol") == S.TCP
    bits = [
        (F.col("ip_ttl") < 5, S.ERR_TTL),
        (tcp & has_flag(S.RST), S.ERR_RST),
        (tcp & (F.col("tcp_window") == 0) & has_flag(S.ACK), S.ERR_ZERO_WINDOW),
    ]
    return sum((F.when(cond, F.lit(bit)).otherwise(F.lit(0)) for cond, bit in bits), F.lit(0))


def annotate_packets(df: DataFrame, compat: bool = False) -> DataFrame:
    """Add payload size, error bits, layer-7 id, DNS error and the decoded TCP flags.

    ``compat`` wraps payload sizes at 32 bits and drops the DNS id like the collectors do.
    """
    tcp = F.col("protocol") == S.TCP
    l7 = l7_protocol(guard_dns=compat)
    out = df.withColumn("payload_size", payload_size(compat))
    return out.withColumns(
        {
            "error_flags": base_error_flags(),
            "l7_protocol": l7,
            "dns_flags": F.when(l7 == S.L7_DNS, F.coalesce("dns_flags", F.lit(0))).otherwise(F.lit(0)),
            **{
                f"is_{name}": tcp & has_flag(bit)
                for name, bit in [
                    ("fin", S.FIN), ("syn", S.SYN), ("rst", S.RST), ("psh", S.PSH), ("ack", S.ACK), ("urg", S.URG),
                ]
            },
        }
    )


def conform(df: DataFrame, layout: T.StructType = S.FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """Select exactly the columns of a feature layout, filling what is missing.

    Text columns become empty and numbers zero, both where the column is absent and where it
    is null.  Columns named in ``keep`` follow as they are, where they exist.
    """
    have = set(df.columns)
    cols = []
    for field in layout.fields:
        empty = F.lit("" if isinstance(field.dataType, T.StringType) else 0).cast(field.dataType)
        value = F.coalesce(F.col(field.name).cast(field.dataType), empty) if field.name in have else empty
        cols.append(value.alias(field.name))
    return df.select(*cols, *[c for c in keep if c in have])


def preview(features: DataFrame, rows: int = 2) -> DataFrame:
    """The first rows of a feature table in a fixed order, with eight telling columns."""
    shown = [
        "timestamp", "flow_id", "retransmission_rate", "http_status_code", "cpu_usage_percent",
        "memory_usage_percent", "disk_avg_latency_us", "anomaly_label",
    ]
    return features.orderBy("timestamp", "flow_id", "src_ip").select(*shown).limit(rows)
