"""Check queries of packet, connection, flow and flood operators."""

from checks.oracle_base import CTES, GROUP, build, same_rounding


def _q(q: str) -> str:
    return (
        f"case when count(gap_ns) >= 2 then round(list_sort(list(gap_ns))"
        f"[cast(floor(count(gap_ns) * cast({q} as double)) as bigint) + 1] / 1e6, 6) else 0.0 end"
    )


#: Query text and the shared expressions it reads.
BODIES = {
    "packet_annotate": (
        """select pkt_id, payload_size, own_errors as error_flags, l7_protocol, dns_flags,
             protocol = 6 and tcp_flags & 1 <> 0 as is_fin, protocol = 6 and tcp_flags & 2 <> 0 as is_syn,
             protocol = 6 and tcp_flags & 4 <> 0 as is_rst, protocol = 6 and tcp_flags & 8 <> 0 as is_psh,
             protocol = 6 and tcp_flags & 16 <> 0 as is_ack, protocol = 6 and tcp_flags & 32 <> 0 as is_urg
           from annotated""",
        "annotated",
    ),
    "packet_annotate_compat": (
        """select pkt_id,
             cast((case protocol when 6 then ip_total_len - 40 when 17 then udp_len - 8 else 0 end
                   + 4294967296) % 4294967296 as bigint) as payload_size,
             case when protocol = 6 and ip_total_len <> 40 and (src_port = 80 or dst_port = 80)
                       and (ip_total_len >= 45 or ip_total_len < 40)
                       and regexp_matches(payload_prefix, '^(GET|POST|HTTP)') then 1
                  when protocol = 6 and (ip_total_len >= 45 or ip_total_len < 40)
                       and (src_port = 443 or dst_port = 443) then 2
                  else 0 end as l7_protocol
           from packets""",
        "packets",
    ),
    "ip_filter": (
        """select pkt_id, src_ip, dst_ip, packet_size from packets
           where (src_ip = '10.0.0.3' or dst_ip = '10.0.0.3') and packet_size > 0 and packet_size < 65536
             and protocol in (1, 6, 17)""",
        "packets",
    ),
    "ip_number": (
        """select src_ip,
             cast(split_part(src_ip, '.', 1) as bigint) * 16777216 + cast(split_part(src_ip, '.', 2) as bigint) * 65536
             + cast(split_part(src_ip, '.', 3) as bigint) * 256 + cast(split_part(src_ip, '.', 4) as bigint) as ip_number,
             src_ip as ip_text, cast(count(*) as bigint) as n
           from packets group by src_ip""",
        "packets",
    ),
    "conn_track": (
        """select pkt_id, window_id, prev_seq, retransmission, out_of_order, conn_state, error_flags from tracked""",
        "tracked",
    ),
    "flow_core": (
        f"""select {GROUP}, substr(md5(concat(src_ip, ':', src_port, '->', dst_ip, ':', dst_port, ':', protocol)), 1, 8)
             as flow_id,
             count(*) as packet_count, cast(sum(packet_size) as bigint) as byte_count,
             round(count(*) / 5.0, 6) as packets_per_second, round(sum(packet_size) / 5.0, 6) as bytes_per_second,
             round(greatest(40, least(9000, sum(packet_size) / count(*))), 6) as avg_packet_size,
             cast(5.0 as double) as connection_duration,
             coalesce(round(avg(gap_ns) / 1e6, 6), 0) as inter_arrival_mean_ms,
             coalesce(round(stddev_samp(gap_ns) / 1e6, 6), 0) as inter_arrival_std_ms,
             coalesce(round((case when avg(gap_ns) > 0 then coalesce(stddev_samp(gap_ns), 0) / 1e6 / (avg(gap_ns) / 1e6)
                                  end), 6), 0) as inter_arrival_jitter
           from valid group by {GROUP}""",
        "valid",
    ),
    "flow_observed_rate": (
        f"""with spans as (select {GROUP}, (max(ts_ns) - min(ts_ns)) / 1e9 as span from tracked group by {GROUP})
           select {GROUP}, round(count(*) / (case when any_value(span) = 0 then 0.001 else any_value(span) end), 6)
             as packets_per_second,
             round(case when any_value(span) = 0 then 0.001 else any_value(span) end, 6) as connection_duration
           from valid join spans using ({GROUP}) group by {GROUP}""",
        "valid",
    ),
    "flow_latency": (
        f"""select *, case when latency_p50 > 0 then round(latency_p99 / latency_p50, 6) else 0.0 end as tail_latency_ratio
           from (select {GROUP}, {_q("0.50")} as latency_p50, {_q("0.95")} as latency_p95, {_q("0.99")} as latency_p99
                 from valid group by {GROUP})""",
        "valid",
    ),
    "flow_retrans": (
        f"""with rt as (
             select {GROUP}, ts_ns, pkt_id,
               case when ts_ns - lag(ts_ns) over (partition by {GROUP} order by ts_ns, pkt_id) < 1000000000
                    then 0 else 1 end as brk
             from valid where retransmission),
           isl as (select {GROUP}, sum(brk) over (partition by {GROUP} order by ts_ns, pkt_id) as island from rt),
           runs as (select {GROUP}, max(n) as longest from
             (select {GROUP}, island, count(*) as n from isl group by {GROUP}, island) group by {GROUP})
           select {GROUP}, cast(sum(retransmission::int) as bigint) as retransmission_count,
             round(case when protocol = 6 then sum(retransmission::int) / count(*) else 0 end, 6) as retransmission_rate,
             cast(coalesce(any_value(longest), 0) as bigint) as consecutive_retrans,
             cast(sum(out_of_order::int) as bigint) as out_of_order_count
           from valid left join runs using ({GROUP}) group by {GROUP}""",
        "valid",
    ),
    "flow_tcp_flags": (
        f"""select {GROUP},
             count(*) filter (protocol = 6 and tcp_flags & 4 <> 0) as tcp_resets,
             count(*) filter (protocol = 6 and tcp_flags & 4 <> 0) as rst_count,
             count(*) filter (protocol = 6 and tcp_flags & 1 <> 0) as fin_count,
             count(*) filter (protocol = 6 and tcp_flags & 8 <> 0) as psh_count,
             count(*) filter (protocol = 6 and tcp_flags & 18 = 18) as syn_ack_count,
             count(*) filter (protocol = 6 and tcp_flags & 18 = 2) as half_open_connections,
             case when protocol <> 6 then 'ESTABLISHED' else
               case arg_max(conn_state, rn) when 1 then 'NEW' when 2 then 'ESTABLISHED' when 3 then 'CLOSING'
                 when 4 then 'CLOSED' else 'UNKNOWN' end end as connection_state,
             round(case when protocol = 6 and count(*) filter (tcp_flags & 18 = 2) > 0
                        then coalesce(max(case when rn = 2 then gap_ns end), 0) / 1e9 else 0 end, 9) as handshake_latency,
             round(count(*) filter (protocol = 6 and tcp_flags & 5 in (1, 4, 5)) / 5.0
                   + count(*) filter (protocol = 6 and tcp_flags & 5 = 5) / 5.0, 6) as connection_churn,
             coalesce(round(count(*) filter (protocol = 6 and tcp_flags & 4 <> 0)
                 / nullif(count(*) filter (protocol = 6 and tcp_flags & 4 <> 0)
                          + count(*) filter (protocol = 6 and tcp_flags & 1 <> 0), 0), 6), 0) as abnormal_termination_ratio
           from valid group by {GROUP}""",
        "valid",
    ),
    "flow_tcp_window": (
        f"""with marks as (
             select *, case when tcp_window > 0 then ts_ns end as pos_ts,
               protocol = 6 and tcp_window = 0 and (prev_window is null or prev_window > 0) as opens from valid),
           spans as (
             select *, min(pos_ts) over (partition by {GROUP} order by ts_ns, pkt_id
                       rows between current row and unbounded following) as close_ts from marks)
           select {GROUP},
             count(*) filter (protocol = 6 and tcp_window = 0) as zero_window_count,
             round(coalesce(sum(case when opens and close_ts is not null then close_ts - ts_ns end), 0) / 1e9, 9)
               as zero_window_duration,
             coalesce(min(case when protocol = 6 and tcp_window > 0 then tcp_window end), 0)::bigint as tcp_window_min,
             coalesce(round(avg(case when protocol = 6 and tcp_window > 0 then tcp_window end), 6), 0) as tcp_window_avg,
             count(*) filter (protocol = 6 and tcp_window < prev_window * 0.5) as tcp_window_drops
           from spans group by {GROUP}""",
        "valid",
    ),
    "flow_ttl_payload": (
        f"""with sizes as (select {GROUP}, count(*) filter (packet_size > 0 and packet_size < 65536) as n_valid
                          from tracked group by {GROUP})
           select {GROUP}, min(case when ip_ttl > 0 then ip_ttl end) as ttl_min,
             round(avg(case when ip_ttl > 0 then ip_ttl end), 6) as ttl_avg,
             round(stddev_pop(case when ip_ttl > 0 then ip_ttl end), 6) as ttl_stddev,
             case when max(payload_size) > 0 then round(least(1.0, count(distinct payload_size) / count(*)), 6) else 0 end
               as payload_entropy,
             round(count(*) filter (error_flags <> 0) / any_value(n_valid), 6) as error_rate
           from tracked join sizes using ({GROUP}) where n_valid > 0 group by {GROUP}""",
        "tracked",
    ),
    "flow_l7_mode": (
        f"""with votes as (
             select {GROUP}, l7_protocol, count(*) as n from tracked where l7_protocol > 0 group by {GROUP}, l7_protocol)
           select {GROUP}, coalesce((select v.l7_protocol from votes v
               where v.host = g.host and v.src_ip = g.src_ip and v.src_port = g.src_port and v.dst_ip = g.dst_ip
                 and v.dst_port = g.dst_port and v.protocol = g.protocol and v.window_id = g.window_id
               order by v.n desc, v.l7_protocol limit 1), 0) as l7_protocol
           from groups g""",
        "groups",
    ),
    "flow_dns_compat": (
        f"""select {GROUP}, greatest(0, count(*) filter (protocol = 17 and dst_port = 53)
               - count(*) filter (protocol = 17 and src_port = 53)) as dns_failures
           from tracked semi join groups using ({GROUP}) group by {GROUP}""",
        "groups",
    ),
    "flow_dns_failures": (
        f"""select {GROUP},
             count(*) filter (protocol = 17 and dst_port = 53) as dns_queries,
             count(*) filter (protocol = 17 and src_port = 53) as dns_responses,
             count(*) filter (l7_protocol = 3 and dns_flags & 15 <> 0)
             + greatest(0, count(*) filter (protocol = 17 and dst_port = 53)
                        - count(*) filter (protocol = 17 and src_port = 53)) as dns_failures
           from tracked semi join groups using ({GROUP}) group by {GROUP}""",
        "groups",
    ),
    "syn_cumulative": (
        """with per as (select host, src_ip, window_id,
               count(*) filter (protocol = 6 and tcp_flags & 18 = 2) as n from annotated group by all)
           select a.host, a.src_ip, a.window_id, a.n as syn_in_window,
             cast(sum(b.n) filter (b.window_id <= a.window_id) as bigint) as syn_total,
             cast(sum(b.n) as bigint) as syn_at_close
           from per a join per b on a.host = b.host and a.src_ip = b.src_ip and b.window_id <= a.window_id + 1
           group by all""",
        "annotated",
    ),
    "flow_syn": (
        f"""with syn as (select host, src_ip, window_id from annotated
                        where protocol = 6 and tcp_flags & 18 = 2),
           own as (select {GROUP}, protocol as proto, count(*) filter (protocol = 6 and tcp_flags & 18 = 18) as sa,
                     count(*) filter (protocol = 6 and tcp_flags & 18 = 2) as syn_count_flow from valid group by {GROUP}),
           tot as (select g.*, case when proto = 6 then (select count(*) from syn s where s.host = g.host
                     and s.src_ip = g.src_ip and s.window_id <= g.window_id + 1) else 0 end as syn_count from own g)
           select {GROUP}, syn_count_flow, syn_count, sa as syn_ack_count,
             round(case when sa > 0 then syn_count / sa else syn_count end, 6) as syn_to_synack_ratio,
             round(syn_count / 5.0, 6) as connection_rate
           from tot""",
        "valid",
    ),
}

ORACLE = {name: build(body, *ctes) for name, (body, *ctes) in BODIES.items()}


def fold_steps(threshold: int, source: str = "packets") -> str:
    """The rate gate packet by packet: each step is the next packet of every source."""
    return f"""ordered as materialized (select host, src_ip, pkt_id, ts_ns,
              row_number() over (partition by host, src_ip order by ts_ns, pkt_id) as rn from {source}),
            fold as (
              select host, src_ip, pkt_id, ts_ns, rn, ts_ns as reset, 1 as n, 0 as dropped from ordered where rn = 1
              union all
              select o.host, o.src_ip, o.pkt_id, o.ts_ns, o.rn,
                case when f.dropped = 1 then f.reset when o.ts_ns - f.reset > 1000000000 then o.ts_ns else f.reset end,
                case when f.dropped = 1 then f.n when o.ts_ns - f.reset > 1000000000 then 1
                     when f.n + 1 > {threshold} then f.n else f.n + 1 end,
                case when f.dropped = 1 then 1 when o.ts_ns - f.reset > 1000000000 then 0
                     when f.n + 1 > {threshold} then 1 else 0 end
              from fold f join ordered o on o.host = f.host and o.src_ip = f.src_ip and o.rn = f.rn + 1)"""


def _fold(threshold: int, select: str) -> str:
    return build(f"with {fold_steps(threshold)} {select}", "packets", recursive=True)


ORACLE["flood_gate"] = _fold(12, "select pkt_id, host, src_ip, dropped from fold")
ORACLE["flood_blocklist"] = _fold(
    10,
    """select host, src_ip, min(ts_ns) as block_ts, arg_min(pkt_id, rn) as block_id, cast(max(n) as bigint) as packet_count
       from fold where dropped = 1 group by host, src_ip""",
)
ORACLE["blocked_rows"] = _fold(
    10,
    """, b as (select host, src_ip, min(ts_ns) as block_ts from fold where dropped = 1 group by host, src_ip),
       s as (select host, src_ip, count(*) as syn from fold join packets using (host, src_ip, pkt_id)
             where dropped = 0 and protocol = 6 and tcp_flags & 18 = 2 group by host, src_ip)
       select cast((block_ts // 5000000000 + 1) * 5 as bigint) as "timestamp",
         substr(md5(concat('BLOCKED_', src_ip)), 1, 8) as flow_id, src_ip, '0.0.0.0' as dst_ip, 0 as src_port, 0 as dst_port,
         6 as protocol, cast(10 as bigint) as packet_count, cast(600 as bigint) as byte_count,
         cast(10.0 as double) as packets_per_second, cast(600.0 as double) as bytes_per_second, cast(60.0 as double) as avg_packet_size, 1 as is_blocked_flow,
         cast(coalesce(syn, 10) as bigint) as syn_count, cast(0 as bigint) as syn_ack_count, cast(9999.0 as double) as syn_to_synack_ratio,
         cast(10 as bigint) as half_open_connections, 'NEW' as connection_state, cast(0.0 as double) as error_rate,
         2 as anomaly_label, 3 as anomaly_severity, 1 as remediation_action
       from b left join s using (host, src_ip)""",
)
ORACLE["flood_gate_aligned"] = build(
    """with ranked as (select pkt_id, host, src_ip, ts_ns, row_number() over
           (partition by host, src_ip, ts_ns // 1000000000 order by ts_ns, pkt_id) as rn from packets),
       cut as (select host, src_ip, min(row(ts_ns, pkt_id)) as first_drop from ranked where rn = 13 group by host, src_ip)
       select pkt_id, host, src_ip, coalesce(row(ts_ns, pkt_id) >= first_drop, false)::int as dropped
       from ranked left join cut using (host, src_ip)""",
    "packets",
)
ORACLE["blocked_flag"] = _fold(
    12,
    f""", b as (select host, src_ip, min(ts_ns) as block_ts from fold where dropped = 1 group by host, src_ip)
       select {GROUP}, cast(coalesce(any_value(block_ts) < (window_id + 2) * 5000000000, false) as int) as is_blocked_flow
       from (select *, ts_ns // 5000000000 as window_id from packets where packet_size > 0 and packet_size < 65536)
       left join b using (host, src_ip) group by {GROUP}""",
)
#: Rate windows one after the other: each step is the next window of every source.
ORACLE["flood_steady"] = build(
    """with steady as (select 'node-0' as host, concat('10.9.0.', cast(pkt_id % 2 as varchar)) as src_ip, (pkt_id // 2) * 100000000 as ts_ns, pkt_id from packets),
       sent as materialized (select * from steady union all select host, src_ip, ts_ns, pkt_id + 1000000000 from steady where pkt_id % 6000 = 5990),
       ordered as materialized (select *, row_number() over (partition by host, src_ip order by ts_ns, pkt_id) as rn,
         count(*) over (partition by host, src_ip order by ts_ns range between current row and 250000000 following) as n from sent),
       opened as (select host, src_ip, rn, n from ordered where rn = 1
         union all select o.host, o.src_ip, o.rn, o.n from opened w join ordered o on o.host = w.host and o.src_ip = w.src_ip and o.rn = w.rn + w.n where w.n <= 3)
       select b.host, b.src_ip, b.ts_ns as block_ts, b.pkt_id as block_id, cast(3 as bigint) as packet_count
       from opened w join ordered b on b.host = w.host and b.src_ip = w.src_ip and b.rn = w.rn + 3 where w.n > 3""",
    "packets",
    recursive=True,
)
_PACKETS = same_rounding(CTES["packets"])
_BURST = f"""select * replace (case when odd then 12000000000 else ts_ns end as ts_ns, case when odd then 'node-0' else host end as host,
  case when odd then '10.0.0.1' else src_ip end as src_ip, case when odd then 1000 else src_port end as src_port,
  case when odd then '10.0.0.2' else dst_ip end as dst_ip, case when odd then 80 else dst_port end as dst_port,
  case when odd then 6 else protocol end as protocol) from (select *, pkt_id % 2 = 1 as odd from ({_PACKETS}))"""
for _name, _body in (("conn_track_burst", "conn_track"), ("flow_burst", "flow_latency")):
    ORACLE[_name] = ORACLE[_body].replace(_PACKETS, _BURST)
