"""The whole way from packets to labelled feature rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.scalar import size_ns, window_id
from flowloom.functions.sized import keep_bucketed, small_side
from flowloom.operators import dns, flood, flows, host, l7, packets
from flowloom.operators.connections import MAX_ROWS


#: Columns behind the 94 that make a row's key complete: two hosts may see the same flow, and windows
#: may be shorter than the whole seconds of ``timestamp``.
KEYS = ("host", "window_id")


@dataclass(frozen=True)
class Settings:
    """Parameters of a run."""

    size_s: float = 5.0
    filter_ip: str | None = None
    start_ns: int | None = None
    duration_s: float = 0
    label: int = 0
    threshold: int = flood.THRESHOLD
    rate_window_s: float = 1.0
    ttl_s: float = l7.TTL_S
    rate_base: str = "window"
    rcode_mask: int = 3
    label_scheme: str = "code"
    epoch_s: int = 0

    @property
    def max_rows(self) -> int | None:
        """None where the flood gate itself keeps every flow window small enough.

        A source passes at most ``2 * threshold`` packets per rate window.
        """
        passed = 2 * self.threshold * (self.size_s / self.rate_window_s + 1)
        return None if passed <= MAX_ROWS else MAX_ROWS


def union_features(flow_rows: DataFrame, blocked: DataFrame) -> DataFrame:
    """Flow rows and blocked-source rows in the 94-column layout, with their key columns behind it."""
    return packets.conform(flow_rows.unionByName(blocked, allowMissingColumns=True), keep=KEYS)


def merge_runs(runs: dict[str, DataFrame]) -> DataFrame:
    """Feature tables of several labelled runs as one, with ``run_id``."""
    named = [packets.conform(df, keep=KEYS).withColumn("run_id", F.lit(name)) for name, df in runs.items()]
    return reduce(DataFrame.unionByName, named)


def labelled(flow_rows: DataFrame, label: int = 0) -> DataFrame:
    """Add the label of the run; severity and remediation are 0 for traffic that was let through."""
    if not 0 <= label <= 11:
        raise ValueError("labels are 0 to 11")
    return flow_rows.withColumns(
        {"anomaly_label": F.lit(label), "anomaly_severity": F.lit(0), "remediation_action": F.lit(0)}
    )


def build_features(
    source: DataFrame,
    l7_records: DataFrame | None = None,
    host_features: DataFrame | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """Feature rows of a packet table: the 94 columns, then ``host`` and ``window_id``.

    ``l7_records`` are parsed records, ``host_features`` the table of
    :func:`flowloom.operators.host.host_features`.  The list of blocked sources, the host table, the
    SYN totals and, once, the packets that the gate lets through are stored on the way.
    """
    s = settings
    source = packets.time_range(source, s.start_ns, s.duration_s)
    blocklist = small_side(flood.flood_blocklist(source, s.threshold, s.rate_window_s))
    let_through = packets.gate_protocols(flood.passed(flood.mark_dropped(source, blocklist)))
    syn = small_side(flood.syn_cumulative(let_through, s.size_s))
    seen = packets.annotate_packets(packets.filter_ip(let_through, s.filter_ip)).withColumn("window_id", window_id(size_s=s.size_s))
    # Tracking, aggregation, answers and entries all read these; by flow and window the first two need no shuffle of their own.
    seen = keep_bucketed(seen, flows.GROUP, S.ORDER)
    rows = flows.flow_features(seen, s.size_s, s.rate_base, syn, s.max_rows, s.rcode_mask)
    rows = flood.flag_blocked(rows, blocklist, s.size_s)
    waits = dns.dns_latency(dns.dns_match(seen, size_s=s.size_s, max_rows=s.max_rows))
    rows = rows.join(waits.drop("dns_queries", "dns_unanswered"), flows.GROUP, "left")
    if l7_records is not None:
        rows = l7.enrich_l7(rows, seen, l7.entries_of(l7_records, s.ttl_s), s.size_s, s.ttl_s)
    hosts = None
    if host_features is not None:
        hosts = small_side(host_features)
        rows = host.join_host(rows, hosts)
    end_s = (F.col("window_id") + 1) * F.lit(size_ns(s.size_s)).cast("long") / 1e9 + F.lit(s.epoch_s)
    rows = labelled(rows.withColumn("timestamp", end_s.cast("long")), s.label)
    blocked = flood.blocked_rows(
        blocklist, syn[0], hosts and hosts[0], s.size_s, s.label_scheme, epoch_s=s.epoch_s
    )
    return union_features(rows, blocked)
