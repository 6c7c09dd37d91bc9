"""Check queries of DNS, layer-7, host, fault, report and training-set operators."""

from checks.oracle_base import CTES, GROUP, KEY, NEEDS, build, same_rounding
from checks.oracle_flows import BODIES, fold_steps

TTL = 30_000_000_000


def _first_answer(question: str, answer: str) -> str:
    return f"""select q.host, q.src_ip, q.src_port, q.dst_ip, q.dst_port, q.protocol, q.window_id, q.ts_ns, q.pkt_id,
        min(a.ts_ns) as answer_ns
      from (select * from annotated where {question}) q
      left join (select * from annotated where {answer}) a
        on a.host = q.host and a.protocol = q.protocol and a.src_ip = q.dst_ip and a.src_port = q.dst_port
        and a.dst_ip = q.src_ip and a.dst_port = q.src_port and a.ts_ns > q.ts_ns
      group by all"""


DNS = f"""select * exclude (answer_ns), case when answer_ns - ts_ns < 5000000000 then answer_ns - ts_ns end as latency_ns
  from ({_first_answer("protocol = 17 and dst_port = 53", "protocol = 17 and src_port = 53")})"""

DNS_LATENCY = f"""select {GROUP}, count(*) as dns_queries, count(*) - count(latency_ns) as dns_unanswered,
    round(coalesce(avg(latency_ns), 0) / 1e6, 6) as dns_query_latency_ms,
    round(coalesce(list_sort(list(latency_ns) filter (latency_ns is not null))
      [cast(floor(count(latency_ns) * cast(0.95 as double)) as bigint) + 1], 0) / 1e6, 6) as dns_query_latency_p95
  from ({DNS}) group by {GROUP}"""


def _text(path: str) -> str:
    return f"coalesce((f->>'$.{path}'), '')"


def _num(path: str) -> str:
    return f"cast(coalesce((f->>'$.{path}'), '0') as int)"


def _address(path: str) -> str:
    return f"list_max([cast(x as int) for x in string_split((f->>'$.{path}'), '.')]) <= 255"


L7_RECORDS = f"""
with w as (select try_cast(value as json) as w from l7_lines where json_valid(value)),
f as (select w, case when (w->'$.flow') is not null then w->'$.flow' else w end as f from w),
k as (select *, case when (f->'$.l7.http') is not null then 'http' when (f->'$.l7.grpc') is not null then 'grpc'
    when (f->'$.l7.dns') is not null then 'dns' when (f->'$.l7.kafka') is not null then 'kafka' else '' end as kind from f)
select w->>'$.host' as host, cast((w->>'$.ts_ns') as bigint) as ts_ns, cast((w->>'$.rec_id') as bigint) as rec_id,
  f->>'$.IP.source' as src_ip,
  cast(coalesce((f->>'$.l4.TCP.source_port'), (f->>'$.l4.UDP.source_port'), '0') as int) as src_port,
  f->>'$.IP.destination' as dst_ip,
  cast(coalesce((f->>'$.l4.TCP.destination_port'), (f->>'$.l4.UDP.destination_port'), '0') as int) as dst_port,
  case when (f->'$.l4.TCP') is not null then 6 else 17 end as protocol,
  {_text("IP.source_xlated")} as src_xlated, {_text("IP.destination_xlated")} as dst_xlated, kind <> '' as has_l7,
  case when kind = 'http' then {_num("l7.http.code")} else 0 end as http_status_code,
  case when kind = 'http' then {_text("l7.http.method")} else '' end as http_method,
  case when kind = 'http' then {_text("l7.http.url")} else '' end as http_url,
  case when kind = 'http' then coalesce(try_cast(regexp_extract({_text("Summary")}, '^(.*?)(\\S+)ms', 2) as int), 0)
       else 0 end as http_latency_ms,
  case when kind = 'grpc' then {_num("l7.grpc.status_code")} else 0 end as grpc_status_code,
  case when kind = 'grpc' then {_text("l7.grpc.method")} else '' end as grpc_method,
  case when kind = 'dns' then {_num("l7.dns.rcode")} else 0 end as dns_response_code,
  case when kind = 'dns' then {_text("l7.dns.query")} else '' end as dns_query_name,
  case when kind = 'dns' then coalesce(json_array_length(f, '$.l7.dns.rrs'), 0)::int else 0 end as dns_num_answers,
  case when kind = 'kafka' then {_num("l7.kafka.api_key")} else 0 end as kafka_api_key,
  case when kind = 'kafka' then {_num("l7.kafka.error_code")} else 0 end as kafka_error_code,
  kind as l7_protocol_detected,
  {_text("source.namespace")} as namespace, {_text("source.pod_name")} as pod_name,
  {_text("destination.service_name")} as service_name,
  coalesce((f->>'$.verdict'), 'UNKNOWN') as verdict, {_text("drop_reason_desc")} as drop_reason
from k where ((f->'$.l4.TCP') is not null or (f->'$.l4.UDP') is not null)
  and {_address("IP.source")} and {_address("IP.destination")}
"""

_TIME = "coalesce(f->>'$.time', w->>'$.time')"
L7_NATIVE = (
    L7_RECORDS.replace("from l7_lines", "from l7_native_lines").replace("select try_cast(value", "select value, try_cast(value").replace("select w, case", "select value, w, case")
    .replace("w->>'$.host' as host", "coalesce(f->>'$.node_name', w->>'$.node_name') as host")
    .replace("cast((w->>'$.ts_ns') as bigint) as ts_ns", f"epoch_us(cast({_TIME} as timestamptz)) // 1000000 * 1000000000 + cast(substr({_TIME}, 21, 9) as bigint) as ts_ns")
    .replace("cast((w->>'$.rec_id') as bigint) as rec_id", "cast('0x' || substr(md5(value), 1, 15) as bigint) as rec_id")
)

_SAME = "c.host = r.host and c.protocol = r.protocol and c.src_ip = r.src_ip and c.src_port = r.src_port and c.dst_ip = r.dst_ip and c.dst_port = r.dst_port"
_BACK = "c.host = r.host and c.protocol = r.protocol and c.src_ip = r.dst_ip and c.src_port = r.dst_port and c.dst_ip = r.src_ip and c.dst_port = r.src_port"

SESSIONS = f"""select *, sum(brk) over (partition by {KEY} order by ts_ns, rec_id) as session from (
    select *, case when ts_ns - lag(ts_ns) over (partition by {KEY} order by ts_ns, rec_id) <= {TTL} then 0 else 1 end as brk
    from {{source}})"""

NAT_CARRY = f"""
with s as materialized ({SESSIONS.format(source="l7_records")}),
own as (
  select r.rec_id,
    arg_max(c.src_xlated, c.rec_id) filter (c.src_xlated <> '') as fs,
    arg_max(c.dst_xlated, c.rec_id) filter (c.dst_xlated <> '') as fd
  from s r join s c on {_SAME} and c.session = r.session and (c.ts_ns < r.ts_ns or (c.ts_ns = r.ts_ns and c.rec_id <= r.rec_id))
  group by r.rec_id),
last_back as (
  select r.rec_id, arg_max(c.session, c.rec_id) as session, max(c.ts_ns) as seen
  from s r join s c on {_BACK} and c.ts_ns <= r.ts_ns group by r.rec_id having any_value(r.ts_ns) - max(c.ts_ns) <= {TTL}),
back as (
  select r.rec_id,
    arg_max(c.dst_xlated, c.rec_id) filter (c.dst_xlated <> '') as rs,
    arg_max(c.src_xlated, c.rec_id) filter (c.src_xlated <> '') as rd
  from s r join last_back l using (rec_id) join s c on {_BACK} and c.session = l.session and c.ts_ns <= r.ts_ns
  group by r.rec_id)
select l7_records.* replace (
    coalesce(case when fs is not null or fd is not null then fs else rs end, '') as src_xlated,
    coalesce(case when fs is not null or fd is not null then fd else rd end, '') as dst_xlated)
from l7_records left join own using (rec_id) left join back using (rec_id)
"""

NAT_EXPAND = """
with pairs as (
  select src_ip as p_src, dst_ip as p_dst, rec_id from l7_carried
  union select src_xlated, dst_ip, rec_id from l7_carried where src_xlated <> ''
  union select src_ip, dst_xlated, rec_id from l7_carried where dst_xlated <> ''
  union select src_xlated, dst_xlated, rec_id from l7_carried where src_xlated <> '' and dst_xlated <> '')
select l7_carried.* replace (p_src as src_ip, p_dst as dst_ip) from l7_carried join pairs using (rec_id)
"""

_PAYLOAD = (
    "http_status_code http_method http_url http_latency_ms grpc_status_code grpc_method dns_response_code "
    "dns_query_name dns_num_answers kafka_api_key kafka_error_code l7_protocol_detected"
).split()
_META = "namespace pod_name service_name verdict drop_reason".split()
_L7_OUT = [n for n in _PAYLOAD if n not in ("http_url", "dns_query_name")] + _META

MERGED = f"""
with s as materialized ({SESSIONS.format(source="l7_expanded")}),
kept as (
  select r.rec_id, r.src_ip, r.dst_ip, arg_max(row({", ".join("c." + n for n in _PAYLOAD)}), c.rec_id) as k
  from s r join s c on {_SAME} and c.session = r.session and c.ts_ns <= r.ts_ns and c.has_l7
  group by r.rec_id, r.src_ip, r.dst_ip)
select {", ".join("s." + k.strip() for k in KEY.split(","))}, s.ts_ns, s.rec_id,
  {", ".join(f"case when k is not null then k[{i + 1}] else s.{n} end as {n}" for i, n in enumerate(_PAYLOAD))},
  {", ".join(_META)}
from s left join kept using (rec_id, src_ip, dst_ip)
"""

_ENTRY = f"row({', '.join('c.' + n for n in [*_PAYLOAD, *_META])})"
ASOF = f"""
with looks as (
  select {KEY}, ts_ns, window_id, 1 as kind, pkt_id as id from annotated
  union all select distinct {KEY}, (window_id + 2) * 5000000000, window_id, 2, 0 from annotated),
fwd as (
  select {", ".join("r." + k.strip() for k in KEY.split(","))}, r.ts_ns, r.window_id, r.kind, r.id, arg_max({_ENTRY}, c.ts_ns) as e
  from looks r join l7_merged c on {_SAME} and c.ts_ns <= r.ts_ns and r.ts_ns - c.ts_ns < {TTL} group by all),
rev as (
  select {", ".join("r." + k.strip() for k in KEY.split(","))}, r.ts_ns, r.window_id, r.kind, r.id, arg_max({_ENTRY}, c.ts_ns) as e
  from looks r join l7_merged c on {_BACK} and c.ts_ns <= r.ts_ns and r.ts_ns - c.ts_ns < {TTL} group by all),
hits as (
  select {GROUP}, kind, ts_ns, id, coalesce(fwd.e, rev.e) as e
  from looks left join fwd using ({GROUP}, kind, ts_ns, id) left join rev using ({GROUP}, kind, ts_ns, id)
  where fwd.e is not null or rev.e is not null),
best as (select {GROUP}, arg_min(e, row(kind, ts_ns, id)) as e from hits group by {GROUP})
select {GROUP}, {", ".join(
    f"coalesce(e[{i + 1}], {chr(39) * 2 if n in _META or n in ('http_method', 'http_url', 'grpc_method', 'dns_query_name', 'l7_protocol_detected') else 0}) as {n}"
    for i, n in enumerate([*_PAYLOAD, *_META]))}
from groups left join best using ({GROUP})
"""

HOST = """
with s as (select *, ts_ns // 5000000000 as window_id from host_samples),
last as (select * from s qualify row_number() over (partition by host, window_id order by ts_ns desc) = 1),
cg as (
  select host, window_id, sum(nr_periods) as p, sum(nr_throttled) as t,
    sum(case when version = 1 then throttled / 1000 else throttled end) as u
  from (select *, ts_ns // 5000000000 as window_id, max(ts_ns) over (partition by host, ts_ns // 5000000000) as at_ns
        from cgroup_samples) where ts_ns = at_ns group by host, window_id),
cd as (
  select host, window_id, p - coalesce(lag(p) over w, 0) as dp, t - coalesce(lag(t) over w, 0) as dt,
    u - coalesce(lag(u) over w, 0) as du
  from cg window w as (partition by host order by window_id)),
dev as (
  select host, window_id, sum(inflight_read + inflight_write) as depth
  from (select *, ts_ns // 5000000000 as window_id, max(ts_ns) over (partition by host, ts_ns // 5000000000) as at_ns
        from device_samples where device not like 'loop%') where ts_ns = at_ns group by host, window_id),
pl as (
  select *, row_number() over (partition by host, window_id order by cpu_percent desc, name, pid) as rn
  from (select *, ts_ns // 5000000000 as window_id, max(ts_ns) over (partition by host, ts_ns // 5000000000) as at_ns
        from process_samples) where ts_ns = at_ns),
pr as (
  select host, window_id, count(*) filter (status = 'zombie') as zombies,
    coalesce(string_agg(printf('%s(%.1f%%)', name, cpu_percent), ',' order by rn) filter (rn <= 3 and cpu_percent > 0), 'idle')
      as top3
  from pl group by host, window_id),
m as (
  select host, window_id, cpu_percent as cpu_usage_percent, coalesce(top3, 'idle') as process_cpu_top3,
    cast(coalesce(dp, 0) as bigint) as cpu_nr_periods, cast(coalesce(dt, 0) as bigint) as cpu_nr_throttled,
    round(coalesce(du, 0) / 1000, 6) as cpu_throttled_time_ms,
    round(case when dp > 0 then dt / dp else 0 end, 6) as cpu_throttle_ratio,
    mem_percent as memory_usage_percent, mem_available_bytes / 1048576 as memory_available_mb, swap_percent as swap_usage_percent,
    (select count(*) from system_events e where e.host = last.host and e.event_type = 2 and e.oom_score > 0
       and e.ts_ns // 5000000000 <= last.window_id) as oom_kill_count,
    round(disk_read_bytes / 1048576, 6) as disk_read_mb, round(disk_write_bytes / 1048576, 6) as disk_write_mb,
    round(case when disk_read_count + disk_write_count > 0
      then (disk_read_time_ms + disk_write_time_ms) * 1000 / (disk_read_count + disk_write_count) else 0 end, 6)
      as disk_avg_latency_us,
    cast(coalesce(depth, 0) as bigint) as disk_queue_depth, cast(listen_overflows as bigint) as tcp_listen_overflows,
    cast(listen_drops as bigint) as tcp_listen_drops, cast(coalesce(zombies, 0) as bigint) as process_exits,
    disk_read_count, disk_write_count, disk_read_time_ms, disk_write_time_ms
  from last left join cd using (host, window_id) left join dev using (host, window_id) left join pr using (host, window_id))
select *, (disk_avg_latency_us > 10000)::int as high_io_latency, (cpu_usage_percent > 80)::int as cpu_contention,
  (cpu_throttle_ratio > 0.1)::int as cpu_throttled, (memory_usage_percent > 90)::int as memory_critical,
  (swap_usage_percent > 10)::int as swap_active, (disk_queue_depth > 10)::int as disk_saturated
from m
"""

CTES.update(
    l7_records=L7_RECORDS, l7_carried=NAT_CARRY, l7_expanded=NAT_EXPAND, l7_merged=MERGED, host_windows=HOST,
    dns_waits=DNS_LATENCY, l7_hits=ASOF,
)
NEEDS.update(
    l7_records=["l7_lines"], l7_carried=["l7_records"], l7_expanded=["l7_carried"], l7_merged=["l7_expanded"],
    host_windows=["host_samples", "process_samples", "cgroup_samples", "device_samples", "system_events"],
    dns_waits=["annotated"], l7_hits=["annotated", "groups", "l7_merged"],
)

_COPIES = """seen as (
  select * from packets union all
  select * replace (ifindex + 1 as ifindex, ts_ns + 400000 as ts_ns) from packets where pkt_id % 5 = 0 union all
  select * replace (ifindex + 1 as ifindex, ts_ns + 5400000 as ts_ns) from packets where pkt_id % 5 = 0),
firsts as (
  select *, min(row(ts_ns, pkt_id, ifindex)) over (partition by host, src_ip, src_port, dst_ip, dst_port, protocol, ip_id, tcp_seq, tcp_flags
    order by ts_ns range between 1000000 preceding and current row) as f from seen)
select pkt_id, ts_ns, ifindex from firsts where protocol = 1 or f[3] = ifindex"""

BASIC = {
    "bounded_run": ("select pkt_id, ts_ns from packets where ts_ns < (select min(ts_ns) from packets) + 60000000000", "packets"),
    "dedup_interfaces": (f"with {_COPIES}", "packets"),
    "dns_match": (f"select {GROUP}, pkt_id, ts_ns, latency_ns from ({DNS})", "annotated"),
    "dns_latency": ("select * from dns_waits", "dns_waits"),
    "rtt": (
        f"""select {KEY}, count(*) as syn_count, count(answer_ns) as rtt_samples,
              coalesce(round(avg((answer_ns - ts_ns) / 1e6), 5), 0) as rtt_estimate_ms,
              coalesce(round(var_samp((answer_ns - ts_ns) / 1e6), 3), 0) as rtt_variance
            from ({_first_answer("protocol = 6 and tcp_flags & 18 = 2", "protocol = 6 and tcp_flags & 18 = 18")})
            group by {KEY}""",
        "annotated",
    ),
    "bidirectional": (
        """with p as (select *, (src_ip, src_port) <= (dst_ip, dst_port) as up from annotated
                      where packet_size > 0 and packet_size < 65536),
           c as (select *, case when up then src_ip else dst_ip end as ip_a, case when up then src_port else dst_port end as port_a,
                   case when up then dst_ip else src_ip end as ip_b, case when up then dst_port else src_port end as port_b,
                   case when up then 0 else 1 end as dir from p),
           f as (select *, first_value(dir) over (partition by host, ip_a, port_a, ip_b, port_b, protocol, window_id
                   order by ts_ns, pkt_id) as forward_dir from c)
           select host, ip_a, port_a, ip_b, port_b, protocol, window_id, forward_dir,
             count(*) filter (dir = forward_dir) as forward_packets, count(*) filter (dir <> forward_dir) as backward_packets,
             cast(coalesce(sum(packet_size) filter (dir = forward_dir), 0) as bigint) as forward_bytes,
             cast(coalesce(sum(packet_size) filter (dir <> forward_dir), 0) as bigint) as backward_bytes,
             count(*) as bidirectional_packets, cast(sum(packet_size) as bigint) as bidirectional_bytes
           from f group by all""".replace("(src_ip, src_port) <= (dst_ip, dst_port)", "row(src_ip, src_port) <= row(dst_ip, dst_port)"),
        "annotated",
    ),
    "packet_size_stats": (
        f"""select {GROUP}, count(*) filter (protocol = 6 and tcp_flags & 16 <> 0) as ack_count,
              count(*) filter (protocol = 6 and tcp_flags & 32 <> 0) as urg_count,
              count(*) filter (protocol = 6 and tcp_flags & 64 <> 0) as ece_count,
              count(*) filter (protocol = 6 and tcp_flags & 128 <> 0) as cwr_count,
              min(packet_size) as min_packet_size, max(packet_size) as max_packet_size,
              coalesce(round(var_samp(packet_size), 4), 0) as packet_size_variance,
              round((max(ts_ns) - min(ts_ns)) / 1e9, 9) as flow_duration
            from valid group by {GROUP}""",
        "valid",
    ),
    "jitter_variance": (
        f"""with c as (select *, abs(gap_ns - lag(gap_ns) over (partition by {GROUP} order by ts_ns, pkt_id)) / 1e6 as change
                      from valid)
            select {GROUP}, coalesce(round(avg(gap_ns) / 1e6, 6), 0) as latency_mean_ms,
              coalesce(round(stddev_samp(gap_ns) / 1e6, 6), 0) as latency_std_ms,
              coalesce(round(var_samp(change), 3), 0) as jitter_variance
            from c group by {GROUP}""",
        "valid",
    ),
    "goodput": (
        f"""select {GROUP}, round(sum(case when retransmission then 0 else payload_size end) * 8 / 5.0 / 1e6, 6) as goodput_mbps,
              round(1 - sum(payload_size) / sum(packet_size), 6) as overhead_ratio
            from valid group by {GROUP}""",
        "valid",
    ),
    "flow_completion": (
        f"""select {KEY}, round((max(ts_ns) - min(ts_ns)) / 1e9, 6) as flow_completion_time, count(*) as packets
            from packets group by {KEY}""",
        "packets",
    ),
    "dup_acks": (
        f"""select {GROUP}, count(*) filter (payload_size = 0 and tcp_ack = prev_ack) as duplicate_acks
            from (select *, lag(tcp_ack) over (partition by {KEY} order by ts_ns, pkt_id) as prev_ack
                  from annotated where protocol = 6) group by {GROUP}""",
        "annotated",
    ),
    "host_window": ("select * from host_windows", "host_windows"),
    "host_top3": ("select host, window_id, process_cpu_top3, process_exits from host_windows", "host_windows"),
    "backlog_growth": (
        """select host, window_id, d as overflows_delta, (d > 0)::int as is_backlog_overflow from (
             select host, window_id, tcp_listen_overflows
               - coalesce(lag(tcp_listen_overflows) over (partition by host order by window_id), 0) as d from host_windows)""",
        "host_windows",
    ),
    "l7_parse": ("select * from l7_records", "l7_records"),
    "l7_parse_native": (L7_NATIVE, "l7_native_lines"),
    "l7_untimed": (f"select count(*) as rows, count(*) filter (ts_ns is null or host is null) as without_time from ({L7_NATIVE})", "l7_native_lines"),
    "nat_carry": ("select rec_id, src_ip, dst_ip, src_xlated, dst_xlated from l7_carried", "l7_carried"),
    "nat_alias": (f"select {KEY}, ts_ns, rec_id, has_l7 from l7_expanded", "l7_expanded"),
    "l7_merge": ("select * from l7_merged", "l7_merged"),
    "l7_asof": ("select * from l7_hits", "l7_hits"),
}

# ---- the whole pipeline, and what reads its rows -----------------------------------------

_THRESHOLD = 12
_FLOW_PARTS = [
    "flow_core", "flow_latency", "flow_retrans", "flow_tcp_flags", "flow_tcp_window", "flow_ttl_payload",
    "flow_l7_mode", "flow_dns", "flow_syn",
]


def _features() -> tuple[str, list[str]]:
    """The 94 columns, from packets that passed the gate."""
    host_cols = [
        "cpu_usage_percent", "process_cpu_top3", "cpu_nr_periods", "cpu_nr_throttled", "cpu_throttled_time_ms",
        "cpu_throttle_ratio", "memory_usage_percent", "memory_available_mb", "swap_usage_percent", "oom_kill_count",
        "disk_read_mb", "disk_write_mb", "disk_avg_latency_us", "disk_queue_depth", "tcp_listen_overflows",
        "tcp_listen_drops", "process_exits", "high_io_latency", "cpu_contention", "cpu_throttled", "memory_critical",
        "swap_active", "disk_saturated",
    ]
    host = ", ".join(
        f"coalesce(h.{c}, {chr(39) * 2 if c == 'process_cpu_top3' else 0}) as {c}" for c in host_cols
    )
    parts = dict(BODIES)
    parts["flow_dns"] = (BODIES["flow_dns_failures"][0].replace("& 15", "& 3"),)
    ctes = [f"{n}_part as materialized ({parts[n][0]})" for n in _FLOW_PARTS]
    joins = " ".join(f"join {n}_part using ({GROUP})" for n in _FLOW_PARTS[1:])
    l7 = ", ".join(_L7_OUT)
    no_l7 = ", ".join(
        f"{chr(39) * 2 if n in _META or n in ('http_method', 'grpc_method', 'l7_protocol_detected') else 0} as {n}" for n in _L7_OUT
    )
    flow = f"""
      select cast((window_id + 1) * 5 as bigint) as "timestamp", flow_id, src_ip, dst_ip, src_port, dst_port, protocol,
        l7_protocol, packet_count, byte_count, packets_per_second, bytes_per_second, avg_packet_size, retransmission_count,
        retransmission_rate, consecutive_retrans, out_of_order_count, tcp_resets, zero_window_count, zero_window_duration,
        syn_count, flow_syn_part.syn_ack_count, syn_to_synack_ratio, fin_count, rst_count, psh_count, cast(0 as bigint) as duplicate_acks, ttl_min, ttl_avg,
        ttl_stddev, payload_entropy, dns_failures, connection_state, connection_duration,
        case when syn_count > 0 then hand else 0 end as handshake_latency, error_rate, half_open_connections,
        cast(coalesce(block_ts < (window_id + 2) * 5000000000, false) as int) as is_blocked_flow,
        inter_arrival_mean_ms, inter_arrival_std_ms, inter_arrival_jitter, latency_p50, latency_p95, latency_p99,
        tail_latency_ratio, tcp_window_min, tcp_window_avg, tcp_window_drops, connection_rate, connection_churn,
        abnormal_termination_ratio, {host}, {l7},
        coalesce(dns_query_latency_ms, 0) as dns_query_latency_ms, coalesce(dns_query_latency_p95, 0) as dns_query_latency_p95,
        0 as anomaly_label, 0 as anomaly_severity, 0 as remediation_action, host, window_id
      from flow_core_part {joins} join hand_part using ({GROUP}) join l7_hits using ({GROUP})
        left join dns_waits w using ({GROUP}) left join blocks using (host, src_ip)
        left join host_windows h using (host, window_id)"""
    zeros = (
        "retransmission_count retransmission_rate consecutive_retrans out_of_order_count tcp_resets zero_window_count "
        "zero_window_duration"
    ).split()
    later = "fin_count rst_count psh_count duplicate_acks ttl_min ttl_avg ttl_stddev payload_entropy dns_failures".split()
    rest = (
        "inter_arrival_mean_ms inter_arrival_std_ms inter_arrival_jitter latency_p50 latency_p95 latency_p99 "
        "tail_latency_ratio tcp_window_min tcp_window_avg tcp_window_drops connection_rate connection_churn "
        "abnormal_termination_ratio"
    ).split()
    zero = lambda names: ", ".join(f"0 as {n}" for n in names)
    blocked = f"""
      select cast((block_ts // 5000000000 + 1) * 5 as bigint) as "timestamp",
        substr(md5(concat('BLOCKED_', src_ip)), 1, 8) as flow_id, src_ip, '0.0.0.0' as dst_ip, 0 as src_port, 0 as dst_port,
        6 as protocol, 0 as l7_protocol, {_THRESHOLD} as packet_count, {_THRESHOLD * 60} as byte_count,
        {_THRESHOLD} as packets_per_second, {_THRESHOLD * 60} as bytes_per_second, 60 as avg_packet_size, {zero(zeros)},
        coalesce(syn, {_THRESHOLD}) as syn_count, 0 as syn_ack_count, 9999 as syn_to_synack_ratio, {zero(later)},
        'NEW' as connection_state, 0 as connection_duration, 0 as handshake_latency, 0 as error_rate,
        {_THRESHOLD} as half_open_connections, 1 as is_blocked_flow, {zero(rest)}, {host}, {no_l7},
        0 as dns_query_latency_ms, 0 as dns_query_latency_p95, 2 as anomaly_label, 3 as anomaly_severity, 1 as remediation_action,
        blocks.host as host, block_ts // 5000000000 as window_id
      from blocks left join source_syn using (host, src_ip)
        left join host_windows h on h.host = blocks.host and h.window_id = block_ts // 5000000000"""
    chain = [
        f"raw_packets as materialized ({CTES['packets']})",
        fold_steps(_THRESHOLD, "raw_packets"),
        "packets as materialized (select r.* from raw_packets r join fold f using (pkt_id) where f.dropped = 0)",
        "blocks as materialized (select host, src_ip, min(ts_ns) as block_ts from fold where dropped = 1 group by host, src_ip)",
        *[f"{n} as materialized ({CTES[n]})" for n in (
            "annotated", "tracked", "valid", "groups", "l7_lines", "l7_records", "l7_carried", "l7_expanded", "l7_merged",
            "l7_hits", "host_samples", "process_samples", "cgroup_samples", "device_samples", "system_events", "host_windows",
            "dns_waits")],
        "source_syn as (select host, src_ip, count(*) as syn from annotated where protocol = 6 and tcp_flags & 18 = 2 "
        "group by host, src_ip)",
        f"hand_part as (select {GROUP}, round(coalesce(max(case when protocol = 6 and rn = 2 then gap_ns end), 0) / 1e9, 9) as hand "
        f"from valid group by {GROUP})",
        *ctes,
        f"features as materialized ({flow} union all by name {blocked})",
    ]
    return "with recursive " + ",\n".join(chain), host_cols


_CHAIN, _HOST_COLS = _features()

#: Per packet the newest entry of its flow, else of the reverse flow, younger than the time to live.
_PACKET_SIDE = """
{name} as (select p.pkt_id, arg_max({entry}, c.ts_ns) as e from annotated p join l7_merged c on {where}
  and c.ts_ns <= p.ts_ns and p.ts_ns - c.ts_ns < {ttl} group by p.pkt_id)"""
PACKET_HITS = build(
    "with "
    + _PACKET_SIDE.format(name="own", entry=_ENTRY, where=_SAME.replace("r.", "p."), ttl=TTL)
    + ","
    + _PACKET_SIDE.format(name="back", entry=_ENTRY, where=_BACK.replace("r.", "p."), ttl=TTL)
    + f""" select pkt_id, coalesce(own.e, back.e) is not null as matched,
      {", ".join(f"coalesce(own.e, back.e)[{i + 1}] as {n}" for i, n in enumerate([*_PAYLOAD, *_META]))}
      from annotated left join own using (pkt_id) left join back using (pkt_id)""",
    "annotated", "l7_merged",
)


def _on_features(body: str) -> str:
    return same_rounding(_CHAIN + "\n" + body)


_RULES = """select *, cpu_throttle_ratio > 0.1 as is_cpu_throttling, retransmission_rate > 0.05 as is_packet_loss,
    inter_arrival_jitter > 0.5 as is_latency_jitter, syn_to_synack_ratio > 10 as is_syn_flood,
    memory_usage_percent > 90 as is_memory_pressure, disk_queue_depth > 10 as is_disk_saturation,
    tcp_listen_overflows > 0 as is_backlog_overflow, zero_window_count > 5 as is_zero_window,
    tcp_resets > 50 as is_connection_churn, dns_response_code = 3 as is_dns_failure, http_status_code >= 500 as is_http_error
  from features"""
_FLAGS = [
    "is_cpu_throttling", "is_packet_loss", "is_latency_jitter", "is_syn_flood", "is_memory_pressure", "is_disk_saturation",
    "is_backlog_overflow", "is_zero_window", "is_connection_churn", "is_dns_failure", "is_http_error",
]
_LABEL = "case " + " ".join(f"when {f} then {i + 1}" for i, f in enumerate(_FLAGS)) + " else 0 end"
_LISTED = (
    "array_to_string([x for x in [" + ", ".join(f"case when {f} then {i + 1} end" for i, f in enumerate(_FLAGS))
    + "] if x is not null], ',')"
)
_RULED = f"with ruled as (select *, {_LABEL} as rule_label, {_LISTED} as fault_labels from ({_RULES}))"
_RULED = _RULED.replace("with ruled", ", ruled", 1)
SCALED = ["packet_count", "byte_count", "retransmission_rate", "inter_arrival_mean_ms", "cpu_usage_percent"]
CORR = ["packet_count", "retransmission_rate", "inter_arrival_jitter", "tcp_resets", "memory_usage_percent", "duplicate_acks"]


def _std(c: str) -> str:
    return (
        f"round(coalesce(({c} - (select avg({c}) from features)) / nullif((select stddev_pop({c}) from features), 0), 0), 6) as {c}"
    )


def _minmax(c: str) -> str:
    return (
        f"round(coalesce(({c} - (select min({c}) from features)) / "
        f"nullif((select max({c}) - min({c}) from features)::double, 0), 0), 6) as {c}"
    )


ON_FEATURES = {
    "flow_features": "select * from features",
    "fault_rules": f"""{_RULED} select "timestamp", flow_id, src_ip, {", ".join(_FLAGS)}, fault_labels, rule_label,
        retransmission_rate < 0.01 and syn_to_synack_ratio between 0.5 and 2.0 and http_status_code in (0, 200) as normal_profile
        from ruled""",
    "label_confusion": f"{_RULED} select anomaly_label, rule_label, count(*) as rows from ruled group by all",
    "run_summary": """select count(*) as total_rows, count(*) filter (retransmission_count > 0) as flows_with_retransmissions,
        max(retransmission_rate) as max_retransmission_rate from features""",
    "retransmission_rows": """select "timestamp", flow_id, retransmission_count, retransmission_rate, consecutive_retrans,
        http_status_code, anomaly_label from features where retransmission_count > 0 order by "timestamp", flow_id limit 20""",
    "preview": """select "timestamp", flow_id, retransmission_rate, http_status_code, cpu_usage_percent, memory_usage_percent,
        disk_avg_latency_us, anomaly_label from features order by "timestamp", flow_id, src_ip limit 2""",
    "flood_summary": """select (select sum(syn) from source_syn)::bigint as total_syns, count(*) as blocked_sources,
        (select string_agg(src_ip, ', ' order by src_ip) from (select src_ip from blocks order by block_ts, src_ip limit 5))
          as blocked_ips from blocks""",
    "label_balance": f"""{_RULED}, counted as (select rule_label as anomaly_label, count(*) as n from ruled group by 1)
        select r.range::int as anomaly_label, coalesce(n, 0) as rows, 100 as wanted, greatest(0, 100 - coalesce(n, 0)) as missing
        from range(12) r left join counted on anomaly_label = r.range""",
    "scale_features": f"""select "timestamp", flow_id, src_ip, {", ".join(map(_std, SCALED))} from features""",
    "scale_minmax": f"""select "timestamp", flow_id, src_ip, {", ".join(map(_minmax, SCALED))} from features""",
    "class_weights": f"""{_RULED} select rule_label, count(*) as rows, round((select count(*) from ruled)
        / ((select count(distinct rule_label) from ruled) * count(*)), 6) as weight from ruled group by rule_label""",
    "kfold": f"""{_RULED} select host, window_id, flow_id, "timestamp", rule_label, cast((row_number() over (partition by rule_label
        order by md5(concat_ws('|', host, src_ip, src_port, dst_ip, dst_port, protocol, window_id)),
        host, src_ip, src_port, dst_ip, dst_port, protocol, window_id) - 1) % 5 as int) as fold
        from ruled""",
    "sequences": """select host, flow_id, window_id,
        array_to_string(list(packet_count) over w, ',') as packet_count_seq,
        array_to_string(list(retransmission_count) over w, ',') as retransmission_count_seq
        from features window w as (partition by host, src_ip, src_port, dst_ip, dst_port, protocol
          order by window_id, packet_count, retransmission_count rows between 4 preceding and current row)""",
    "sink_csv": "select * exclude (host, window_id) from features",
    "sink_parquet": "select * exclude (host, window_id) from features",
    "newest_run": "select count(*) as rows, cast(sum(packet_count) as bigint) as packets from features",
    "feature_corr": " union all ".join(
        f"select '{c}' as feature, round(case when stddev_pop({c}) > 0 then corr({c}, {_LABEL}) end, 6) as correlation from ({_RULES})"
        for c in CORR
    ),
    "feature_information": f"{_RULED}, " + ", ".join(
        f"edges_{c} as (select quantile_disc({c}::double, [{', '.join(str(i / 10) for i in range(1, 10))}]) as e from ruled)" for c in CORR
    ) + ", cells as (" + " union all ".join(
        f"select '{c}' as feature, len(list_filter(e, lambda x: x < {c}::double)) as bin, rule_label as label, count(*) as n from ruled, edges_{c} group by all" for c in CORR
    ) + """), parts as (select feature, n, sum(n) over (partition by feature) as t, sum(n) over (partition by feature, bin) as b,
          sum(n) over (partition by feature, label) as l from cells),
        sums as (select feature, sum(n / t * log2(n * t / (b * l))) as bits, sum(n / t * log2(t / l)) as h from parts group by feature)
        select feature, round(bits, 6) as bits, round(case when h > 0 then bits / h end, 6) as share from sums""",
    "periodic_status": """, counted as (select host, ((window_id + 1) * 5000000000 - 1) // 30000000000 + 1 as interval, count(*) as n,
          max(cpu_usage_percent) as cpu, max(memory_usage_percent) as mem from features where dst_ip <> '0.0.0.0' group by 1, 2),
        stopped as (select host, block_ts // 30000000000 + 1 as interval, count(*) as n from blocks group by 1, 2),
        ranked as (select host, src_ip, block_ts // 30000000000 + 1 as interval, row_number() over (partition by host order by block_ts, src_ip) as r from blocks),
        both_kinds as (select host, interval, coalesce(c.n, 0) as n, coalesce(s.n, 0) as m, cpu, mem from counted c full join stopped s using (host, interval))
        select host, interval * 30.0::double as elapsed_s, cast(sum(n) over w as bigint) as feature_rows, cast(sum(m) over w as bigint) as blocked_sources,
          coalesce(cpu, 0.0) as cpu_usage_percent, coalesce(mem, 0.0) as memory_usage_percent,
          coalesce((select string_agg(src_ip, ', ' order by r) from ranked k where k.host = b.host and k.interval <= b.interval and r <= 5), '') as blocked_ips
        from both_kinds b window w as (partition by host order by interval)""",
    "merge_runs": """select run_id, anomaly_label, count(*) as rows, cast(sum(packet_count) as bigint) as packets from (
        select 'first' as run_id, * from features union all select 'second' as run_id, * from features) group by all""",
}

ORACLE = {name: build(body, *ctes) for name, (body, *ctes) in BASIC.items()}
ORACLE.update({name: _on_features(body) for name, body in ON_FEATURES.items()})
ORACLE.update({f"read_{name}": build(f"select * from {name}", name) for name in ("system_events", "host_samples", "process_samples", "cgroup_samples", "device_samples")})
