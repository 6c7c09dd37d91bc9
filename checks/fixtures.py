"""Telemetry tables derived from the ``events`` test table.

The test data has no packets, so they are computed from each event by integer arithmetic
that Spark and DuckDB share.  Each table is a source and two lists of select items; the
same text runs in both engines, with ``//`` written as the engine's integer division.
Nothing outside ``checks``, ``tests`` and the benchmark uses this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BASE = """
event_id
event_type
cast(floor(value * 100 + 0.5) as bigint) AS v
user_id % 24 AS f
event_id % 3 AS dr
event_id * 20000000 + (event_id * 7919) % 19000000 AS ts_ns
"""

_PARTIES = """
*
concat('node-', cast(f % 2 as string)) AS host
concat('10.0.0.', cast(f % 6 + 1 as string)) AS client
concat('10.0.1.', cast(f % 4 + 1 as string)) AS server
cast(case when f < 18 then 6 when f < 22 then 17 else 1 end as int) AS protocol
cast(case when f >= 22 then 0 when f >= 18 then 53 when f % 2 = 0 then 80 else 443 end as int) AS sp
cast(case when f >= 22 then 0 else 40000 + f end as int) AS cp
case when v % 251 = 0 then 0 else 40 + v % 1460 end AS len
"""

_PACKETS = """
event_id AS pkt_id
host
ts_ns
cast(event_id % 4 as int) AS ifindex
cast(null as string) AS src_mac
cast(null as string) AS dst_mac
case when dr = 0 then server else client end AS src_ip
case when dr = 0 then client else server end AS dst_ip
case when dr = 0 then sp else cp end AS src_port
case when dr = 0 then cp else sp end AS dst_port
protocol
cast(case when v % 97 = 0 then 3 else 64 - v % 3 end as int) AS ip_ttl
0 AS ip_tos
cast(event_id % 65536 as int) AS ip_id
cast(len as int) AS ip_total_len
20 AS ip_header_len
20 AS tcp_header_len
cast(len - 20 as int) AS udp_len
len AS packet_size
cast(case when f >= 18 then 0 when event_type = 'signup' then (case when dr = 0 then 18 else 2 end) when event_type = 'click' then 16 when event_type = 'view' then 24 when event_type = 'purchase' then 17 else 4 end as int) AS tcp_flags
case when f >= 18 then 0 else (event_id * 1000 - (case when v % 7 = 0 then 200000 else 0 end) + 4294967296) % 4294967296 end AS tcp_seq
case when f >= 18 then 0 else (event_id - event_id % 200) * 500 % 4294967296 end AS tcp_ack
cast(case when f >= 18 or v % 9 = 0 then 0 else (v % 64) * 1024 end as int) AS tcp_window
case when protocol = 6 then (case v % 4 when 0 then 'GET /' when 1 then 'POST ' when 2 then 'HTTP/' else 'XXXXX' end) end AS payload_prefix
cast(case when protocol = 17 then v % 5 else 0 end as int) AS dns_flags
cast(case when protocol = 1 then v % 9 else 0 end as int) AS icmp_type
cast(case when protocol = 1 then v % 4 else 0 end as int) AS icmp_code
"""

_L7_PARTS = """
event_id
v
host
ts_ns - 500000 AS ts_ns
case when dr = 0 then (case when event_id % 5 < 2 then concat('10.96.0.', cast(f % 4 + 1 as string)) else server end) else client end AS src
case when dr = 0 then client when v % 59 = 0 then '10.0.0.999' when event_id % 5 < 2 then concat('10.96.0.', cast(f % 4 + 1 as string)) else server end AS dst
case when dr <> 0 and event_id % 5 = 0 then server else '' end AS dst_x
case when dr = 0 and event_id % 10 = 0 then server else '' end AS src_x
case when dr = 0 then sp else cp end AS s_port
case when dr = 0 then cp else sp end AS d_port
protocol
v % 6 AS kind
"""

_L7_LINES = """
concat('{"IP":{"source":"', src, '","destination":"', dst, '"', case when src_x = '' then '' else concat(',"source_xlated":"', src_x, '"') end, case when dst_x = '' then '' else concat(',"destination_xlated":"', dst_x, '"') end, '},"l4":{', case when protocol = 6 then concat('"TCP":{"source_port":', cast(s_port as string), ',"destination_port":', cast(d_port as string), '}') when protocol = 17 then concat('"UDP":{"source_port":', cast(s_port as string), ',"destination_port":', cast(d_port as string), '}') else '"ICMPv4":{}' end, '},', case kind when 0 then concat('"l7":{"http":{"code":', cast(200 + 100 * (v % 4) as string), ',"method":"GET","url":"/i/', cast(v % 10 as string), '"}},"Summary":"HTTP took ', cast(v % 90 as string), 'ms",') when 1 then concat('"l7":{"grpc":{"status_code":', cast(v % 17 as string), ',"method":"/svc.A/Get"}},') when 2 then concat('"l7":{"dns":{"rcode":', cast(v % 4 as string), ',"query":"host', cast(v % 7 as string), '.local","rrs":["a"', case when v % 2 = 0 then ',"b"' else '' end, ']}},') when 3 then concat('"l7":{"kafka":{"api_key":', cast(v % 19 as string), ',"error_code":', cast(v % 3 as string), '}},') when 4 then '' else '"l7":{"http":{"code":204,"method":"PUT"}},"Summary":"HTTP done in soon ms",' end, '"source":{"namespace":"ns', cast(v % 3 as string), '","pod_name":"pod-', cast(v % 11 as string), '"},"destination":{"service_name":"svc', cast(v % 5 as string), '"},', case when v % 8 = 0 then '"verdict":"DROPPED","drop_reason_desc":"POLICY_DENIED"' when v % 8 = 1 then '"is_reply":false' else '"verdict":"FORWARDED"' end, '}') AS body
host
ts_ns
event_id AS rec_id
v
"""

_L7_WRAP = """
case when v % 53 = 0 then substring(body, 1, 40) when rec_id % 2 = 0 then concat('{"flow":', body, ',"host":"', host, '","ts_ns":', cast(ts_ns as string), ',"rec_id":', cast(rec_id as string), '}') else concat(substring(body, 1, length(body) - 1), ',"host":"', host, '","ts_ns":', cast(ts_ns as string), ',"rec_id":', cast(rec_id as string), '}') end AS value
"""

_L7_NATIVE = """
case when v % 53 = 0 then substring(body, 1, 40) when v % 31 = 0 then body when rec_id % 2 = 0 then concat('{"flow":', substring(body, 1, length(body) - 1), stamp, '}') else concat(substring(body, 1, length(body) - 1), stamp) end AS value
"""

_L7_STAMP = """
*
concat(',"time":"1970-01-', lpad(cast(1 + (ts_ns + 1000000000) // 86400000000000 as string), 2, '0'), 'T', lpad(cast((ts_ns + 1000000000) // 3600000000000 % 24 as string), 2, '0'), ':', lpad(cast((ts_ns + 1000000000) // 60000000000 % 60 as string), 2, '0'), ':', lpad(cast((ts_ns + 1000000000) // 1000000000 % 60 as string), 2, '0'), '.', lpad(cast((ts_ns + 1000000000) % 1000000000 as string), 9, '0'), 'Z","node_name":"', host, '"}') AS stamp
"""

_TICK = """
event_id
event_id // 25 AS tick
cast(cents as bigint) AS v
event_id * 20000000 + (event_id * 7919) % 19000000 AS ts_ns
concat('node-', cast((event_id // 25) % 2 as string)) AS host
event_type
"""

_HOST = """
host
ts_ns
cast(v % 101 as double) AS cpu_percent
cast(v % 97 as double) AS mem_percent
cast(v % 1000 as bigint) * 1048576 AS mem_available_bytes
cast(v % 23 as double) AS swap_percent
tick * 524288 AS disk_read_bytes
tick * 262144 AS disk_write_bytes
tick - tick % 3 AS disk_read_count
tick - tick % 5 AS disk_write_count
tick * (v % 40) AS disk_read_time_ms
tick * 2 AS disk_write_time_ms
case when tick < 40 then 0 else tick % 7 end AS listen_overflows
tick // 50 AS listen_drops
"""

_PROC = """
host
ts_ns
cast(100 + n as int) AS pid
concat('proc', cast((v + n) % 6 as string)) AS name
cast(case when v % 13 = 0 then 0 else ((v + n * 37) % 400) end as double) / 8 AS cpu_percent
case when (v + n) % 10 = 0 then 'zombie' else 'running' end AS status
"""

_CGROUP = """
host
ts_ns
concat('pod', cast(n as string)) AS cgroup
cast(case when n = 0 then 1 else 2 end as int) AS version
case when tick % 90 = 89 then 0 else tick * 10 + n end AS nr_periods
case when tick % 90 = 89 then 0 else tick * 2 + v % 3 end AS nr_throttled
case when n = 0 then tick * 5000000 else tick * 7000 end AS throttled
"""

_DEVICE = """
host
ts_ns
case n when 0 then 'sda' when 1 then 'nvme0n1' else 'loop0' end AS device
cast(v % 9 as int) AS inflight_read
cast((v + n) % 5 as int) AS inflight_write
"""

_SYSTEM = """
host
ts_ns
cast(case when event_type = 'error' then 2 else 1 end as int) AS event_type
cast(v % 5000 as int) AS pid
cast(v % 2 as int) AS oom_score
"""

_FROM_EVENTS = "select {items} from events"
_TICKS = (
    "select {items} from (select min(event_id) as event_id, sum(cast(floor(value * 100 + 0.5) as bigint)) as cents,"
    " max(event_type) as event_type from events group by event_id // 25)"
)

#: Table -> steps; each step selects its items from the step before.
TABLES: dict[str, list[tuple[str, str]]] = {
    "packets": [(_FROM_EVENTS, _BASE), ("select {items} from ({prev})", _PARTIES), ("select {items} from ({prev})", _PACKETS)],
    "l7_lines": [
        (_FROM_EVENTS, _BASE),
        ("select {items} from ({prev})", _PARTIES),
        ("select {items} from ({prev})", _L7_PARTS),
        ("select {items} from ({prev})", _L7_LINES),
        ("select {items} from ({prev})", _L7_WRAP),
    ],
    "l7_native_lines": [
        (_FROM_EVENTS, _BASE),
        ("select {items} from ({prev})", _PARTIES),
        ("select {items} from ({prev})", _L7_PARTS),
        ("select {items} from ({prev})", _L7_LINES),
        ("select {items} from ({prev})", _L7_STAMP),
        ("select {items} from ({prev})", _L7_NATIVE),
    ],
    "host_samples": [(_TICKS, _TICK), ("select {items} from ({prev})", _HOST)],
    "process_samples": [(_TICKS, _TICK), ("select {items} from (select *, {series5} AS n from ({prev}))", _PROC)],
    "cgroup_samples": [(_TICKS, _TICK), ("select {items} from (select *, {series3} AS n from ({prev}))", _CGROUP)],
    "device_samples": [(_TICKS, _TICK), ("select {items} from (select *, {series3} AS n from ({prev}))", _DEVICE)],
    "system_events": [(_TICKS, _TICK), ("select {items} from ({prev})", _SYSTEM)],
}


def sql(table: str, dialect: str = "duckdb") -> str:
    """The query that derives ``table`` from ``events``."""
    series = {"duckdb": "unnest(range({n}))", "spark": "explode(sequence(cast(0 as bigint), cast({m} as bigint)))"}[dialect]
    prev = ""
    for template, items in TABLES[table]:
        listed = ", ".join(line for line in items.strip().splitlines())
        text = template.format(
            items=listed, prev=prev, series5=series.format(n=5, m=4), series3=series.format(n=3, m=2)
        )
        prev = text
    return prev.replace("//", "div" if dialect == "spark" else "//")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame over the events of ``sf_dir``."""
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("events")
    return spark.sql(sql(name, "spark"))
