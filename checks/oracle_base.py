"""Shared common table expressions of the DuckDB check queries.

They state the semantics over whole keys with plain window functions, without the slices
and carried rows the library uses, so agreement tests that machinery.
"""

from __future__ import annotations

from checks import fixtures

KEY = "host, src_ip, src_port, dst_ip, dst_port, protocol"
GROUP = KEY + ", window_id"
SIZE = 5_000_000_000

ANNOTATED = """
select pkt_id, host, ts_ns, ts_ns // 5000000000 as window_id, src_ip, src_port, dst_ip, dst_port, protocol, ip_ttl,
  packet_size, tcp_flags, tcp_seq, tcp_ack, tcp_window,
  cast(greatest(case protocol when 6 then ip_total_len - 40 when 17 then udp_len - 8 else 0 end, 0) as bigint)
    as payload_size,
  case when protocol = 17 and (src_port = 53 or dst_port = 53) and udp_len - 8 > 0 then 3
       when protocol = 6 and ip_total_len - 40 >= 5 and (src_port = 80 or dst_port = 80)
            and regexp_matches(payload_prefix, '^(GET|POST|HTTP)') then 1
       when protocol = 6 and ip_total_len - 40 >= 5 and (src_port = 443 or dst_port = 443) then 2
       else 0 end as l7_protocol,
  case when protocol = 17 and (src_port = 53 or dst_port = 53) and udp_len - 8 > 0 then dns_flags else 0 end
    as dns_flags,
  (case when ip_ttl < 5 then 2 else 0 end)
  + (case when protocol = 6 and tcp_flags & 4 <> 0 then 64 else 0 end)
  + (case when protocol = 6 and tcp_window = 0 and tcp_flags & 16 <> 0 then 32 else 0 end) as own_errors
from packets
"""

TRACKED = f"""
select *,
  case when retransmission then 16 when out_of_order then 8 else 0 end + own_errors as error_flags,
  case when protocol <> 6 then 0
       when tcp_flags & 2 <> 0 then 1
       when prev_seq is null then 2
       when tcp_flags & 5 <> 0 then 3
       when tcp_flags & 16 <> 0 then 2
       else 0 end as conn_state
from (
  select *,
    coalesce(protocol = 6 and tcp_flags & 2 = 0 and tcp_seq < prev_seq, false) as retransmission,
    coalesce(protocol = 6 and not (tcp_flags & 2 = 0 and tcp_seq < prev_seq)
             and tcp_seq > (prev_seq + 1500) % 4294967296, false) as out_of_order
  from (
    select *, case when protocol = 6 then lag(tcp_seq) over (partition by {KEY} order by ts_ns, pkt_id) end as prev_seq
    from annotated))
"""

VALID = f"""
select *, ts_ns - prev_ts as gap_ns from (
  select *,
    lag(ts_ns) over w as prev_ts,
    lag(tcp_window) over w as prev_window,
    row_number() over w as rn
  from tracked where packet_size > 0 and packet_size < 65536
  window w as (partition by {GROUP} order by ts_ns, pkt_id))
"""

ALLPK = f"select {GROUP}, count(*) as n_all from tracked group by {GROUP}"

CTES = {
    "packets": fixtures.sql("packets"),
    "annotated": ANNOTATED,
    "tracked": TRACKED,
    "valid": VALID,
    "groups": f"select distinct {GROUP} from valid",
    "l7_lines": fixtures.sql("l7_lines"),
    "l7_native_lines": fixtures.sql("l7_native_lines"),
    "host_samples": fixtures.sql("host_samples"),
    "process_samples": fixtures.sql("process_samples"),
    "cgroup_samples": fixtures.sql("cgroup_samples"),
    "device_samples": fixtures.sql("device_samples"),
    "system_events": fixtures.sql("system_events"),
}
NEEDS = {
    "annotated": ["packets"],
    "tracked": ["annotated"],
    "valid": ["tracked"],
    "groups": ["valid"],
}


def same_rounding(text: str) -> str:
    """Spell ``round(x, d)`` as ``floor(x * 10^d + 0.5) / 10^d``.

    Engines round exact halves differently; this form is plain IEEE arithmetic in both.
    """
    out, start = "", 0
    while (at := text.find("round(", start)) >= 0:
        depth, end, comma = 1, at + 6, None
        while depth:
            c = text[end]
            depth += (c in "([") - (c in ")]")
            if c == "," and depth == 1:
                comma = end
            end += 1
        inner, scale = same_rounding(text[at + 6 : comma]), f"1e{int(text[comma + 1 : end - 1])}"
        out += text[start:at] + f"(floor(({inner}) * {scale} + 0.5) / {scale})"
        start = end
    return out + text[start:]


def build(body: str, *names: str, recursive: bool = False) -> str:
    """``body`` behind the named expressions and everything they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = ",\n".join(f"{n} as materialized ({CTES[n]})" for n in order)
    body = body.strip()
    joined = f",\n{body[5:]}" if body.lower().startswith("with ") else f"\n{body}"
    return same_rounding(f"with {'recursive ' if recursive else ''}{parts}{joined}")
