"""Table layouts: packets, application-layer flows, host samples and feature rows."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


def _struct(spec: str) -> T.StructType:
    """A flat layout from ``name type`` pairs; works before a session exists."""
    fields = [item.split() for item in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


#: Identity of one directional flow as seen by one capture host.  A host is one
#: collector with its own connection, rate and SYN state.
FLOW = ["host", "src_ip", "src_port", "dst_ip", "dst_port", "protocol"]
SOURCE = ["host", "src_ip"]
#: Total order of packets inside any key.
ORDER = ["ts_ns", "pkt_id"]

TCP, UDP, ICMP = 6, 17, 1

# TCP flag bits.
FIN, SYN, RST, PSH, ACK, URG, ECE, CWR = 1, 2, 4, 8, 16, 32, 64, 128

# Packet error bits.
ERR_TTL, ERR_OUT_OF_ORDER, ERR_RETRANSMISSION, ERR_ZERO_WINDOW, ERR_RST = 2, 8, 16, 32, 64

# Layer-7 protocol ids.
L7_UNKNOWN, L7_HTTP, L7_HTTPS, L7_DNS = 0, 1, 2, 3

# Connection state ids and names.
CONN_STATES = {1: "NEW", 2: "ESTABLISHED", 3: "CLOSING", 4: "CLOSED"}

PACKETS = _struct(
    "pkt_id bigint, host string, ts_ns bigint, ifindex int, src_mac string, dst_mac string, "
    "src_ip string, dst_ip string, src_port int, dst_port int, protocol int, "
    "ip_ttl int, ip_tos int, ip_id int, ip_total_len int, ip_header_len int, tcp_header_len int, "
    "udp_len int, packet_size bigint, tcp_flags int, tcp_seq bigint, tcp_ack bigint, tcp_window int, "
    "payload_prefix string, dns_flags int, icmp_type int, icmp_code int"
)

SYSTEM_EVENTS = _struct("host string, ts_ns bigint, event_type int, pid int, oom_score int")

_L7_FLOW = (
    "IP struct<source:string, destination:string, source_xlated:string, destination_xlated:string>, "
    "l4 struct<TCP:struct<source_port:int, destination_port:int>, "
    "UDP:struct<source_port:int, destination_port:int>>, "
    "l7 struct<http:struct<code:int, method:string, url:string>, "
    "grpc:struct<status_code:int, method:string>, "
    "dns:struct<rcode:int, query:string, rrs:array<string>>, "
    "kafka:struct<api_key:int, error_code:int>>, "
    "source struct<namespace:string, pod_name:string>, "
    "destination struct<service_name:string>, "
    "verdict string, drop_reason_desc string, Summary string, time string, node_name string"
)
#: One JSON line, as DDL: the flow either sits under ``flow`` or is the whole object.  Its own time and
#: node name tell when and where it was observed; ``host``, ``ts_ns`` and an arrival number beside it,
#: where a collector added them, come first.
L7_LINE = f"flow struct<{_L7_FLOW}>, {_L7_FLOW}, host string, ts_ns bigint, rec_id bigint"

HOST_SAMPLES = _struct(
    "host string, ts_ns bigint, cpu_percent double, mem_percent double, mem_available_bytes bigint, "
    "swap_percent double, disk_read_bytes bigint, disk_write_bytes bigint, disk_read_count bigint, "
    "disk_write_count bigint, disk_read_time_ms bigint, disk_write_time_ms bigint, "
    "listen_overflows bigint, listen_drops bigint"
)
PROCESS_SAMPLES = _struct(
    "host string, ts_ns bigint, pid int, name string, cpu_percent double, status string"
)
CGROUP_SAMPLES = _struct(
    "host string, ts_ns bigint, cgroup string, version int, nr_periods bigint, nr_throttled bigint, throttled bigint"
)
DEVICE_SAMPLES = _struct(
    "host string, ts_ns bigint, device string, inflight_read int, inflight_write int"
)

# The 94 output columns, in output order, with their types.
FEATURES = _struct(
    # identity (8)
    "timestamp bigint, flow_id string, src_ip string, dst_ip string, src_port int, dst_port int, "
    "protocol int, l7_protocol int, "
    # network (30)
    "packet_count bigint, byte_count bigint, packets_per_second double, bytes_per_second double, "
    "avg_packet_size double, retransmission_count bigint, retransmission_rate double, "
    "consecutive_retrans bigint, out_of_order_count bigint, tcp_resets bigint, zero_window_count bigint, "
    "zero_window_duration double, syn_count bigint, syn_ack_count bigint, syn_to_synack_ratio double, "
    "fin_count bigint, rst_count bigint, psh_count bigint, duplicate_acks bigint, ttl_min int, "
    "ttl_avg double, ttl_stddev double, payload_entropy double, dns_failures bigint, "
    "connection_state string, connection_duration double, handshake_latency double, error_rate double, "
    "half_open_connections bigint, is_blocked_flow int, "
    # fault detection (13)
    "inter_arrival_mean_ms double, inter_arrival_std_ms double, inter_arrival_jitter double, "
    "latency_p50 double, latency_p95 double, latency_p99 double, tail_latency_ratio double, "
    "tcp_window_min bigint, tcp_window_avg double, tcp_window_drops bigint, "
    "connection_rate double, connection_churn double, abnormal_termination_ratio double, "
    # host (23)
    "cpu_usage_percent double, process_cpu_top3 string, cpu_nr_periods bigint, cpu_nr_throttled bigint, "
    "cpu_throttled_time_ms double, cpu_throttle_ratio double, memory_usage_percent double, "
    "memory_available_mb double, swap_usage_percent double, oom_kill_count bigint, disk_read_mb double, "
    "disk_write_mb double, disk_avg_latency_us double, disk_queue_depth bigint, "
    "tcp_listen_overflows bigint, tcp_listen_drops bigint, process_exits bigint, high_io_latency int, "
    "cpu_contention int, cpu_throttled int, memory_critical int, swap_active int, disk_saturated int, "
    # layer 7 (17)
    "http_status_code int, http_method string, http_latency_ms int, grpc_status_code int, "
    "grpc_method string, dns_response_code int, dns_num_answers int, dns_query_latency_ms double, "
    "dns_query_latency_p95 double, kafka_api_key int, kafka_error_code int, l7_protocol_detected string, "
    "namespace string, pod_name string, service_name string, verdict string, drop_reason string, "
    # labels (3)
    "anomaly_label int, anomaly_severity int, remediation_action int"
)

# Columns the two older layouts lack.
_NOT_IN_70 = """
    inter_arrival_mean_ms inter_arrival_std_ms inter_arrival_jitter latency_p50 latency_p95 latency_p99
    tail_latency_ratio tcp_window_min tcp_window_avg tcp_window_drops connection_rate connection_churn
    abnormal_termination_ratio cpu_nr_periods cpu_nr_throttled cpu_throttled_time_ms cpu_throttle_ratio
    disk_queue_depth tcp_listen_overflows tcp_listen_drops cpu_throttled disk_saturated
    dns_query_latency_ms dns_query_latency_p95
""".split()
_NOT_IN_55 = _NOT_IN_70 + """
    http_status_code http_method http_latency_ms grpc_status_code grpc_method dns_response_code
    dns_num_answers kafka_api_key kafka_error_code l7_protocol_detected namespace pod_name service_name
    verdict drop_reason
""".split()


def _without(names: list[str]) -> T.StructType:
    return T.StructType([f for f in FEATURES.fields if f.name not in names])


#: Feature layouts by column count.
LAYOUTS = {94: FEATURES, 70: _without(_NOT_IN_70), 55: _without(_NOT_IN_55)}

HOST_FEATURES = FEATURES.names[51:74]
L7_FEATURES = [
    "http_status_code", "http_method", "http_latency_ms", "grpc_status_code", "grpc_method",
    "dns_response_code", "dns_num_answers", "kafka_api_key", "kafka_error_code", "l7_protocol_detected",
    "namespace", "pod_name", "service_name", "verdict", "drop_reason",
]
