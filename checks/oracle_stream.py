"""Check queries of the streaming operators: the same results as over a table."""

from checks.oracle_base import GROUP, build
from checks.oracle_flows import BODIES, ORACLE as FLOWS
from checks.oracle_more import ORACLE as MORE, PACKET_HITS

_TTL = f"select {GROUP}, min(case when ip_ttl > 0 then ip_ttl end) as ttl_min from tracked group by {GROUP}"
_STD = f"select {GROUP}, coalesce(round(stddev_samp(gap_ns) / 1e6, 4), 0) as std from valid group by {GROUP}"
ORACLE = {
    "stream_flow_core": build(
        f"""with core as ({BODIES["flow_core"][0]}), lat as ({BODIES["flow_latency"][0]}),
              flags as ({BODIES["flow_tcp_flags"][0]}), win as ({BODIES["flow_tcp_window"][0]}), ttl as ({_TTL}),
              std as ({_STD})
            select {GROUP}, flow_id, packet_count, byte_count, packets_per_second, bytes_per_second, avg_packet_size,
              inter_arrival_mean_ms, std as inter_arrival_std_ms, latency_p50, latency_p95, latency_p99, syn_ack_count,
              half_open_connections, fin_count, rst_count, zero_window_count, ttl_min
            from core join lat using ({GROUP}) join flags using ({GROUP}) join win using ({GROUP}) join ttl using ({GROUP})
              join std using ({GROUP})""",
        "valid",
    ),
    "stream_flood_gate": FLOWS["flood_gate"],
    "stream_conn_track": build(
        "select pkt_id, prev_seq, retransmission, out_of_order, conn_state from tracked where protocol = 6", "tracked"
    ),
}
ORACLE["stream_late_repaired"] = ORACLE["stream_flow_core"]
ORACLE["stream_l7_windows"] = MORE["l7_asof"]
ORACLE["stream_l7_asof"] = PACKET_HITS
ORACLE["stream_flow_features"] = MORE["flow_features"]
ORACLE["stream_status"] = MORE["periodic_status"]
