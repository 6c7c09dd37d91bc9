"""Application-layer flow records: extraction, address translation, merging, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.ordered import last_before, remembered, split_hot_groups
from flowloom.functions.scalar import CONVERSATION, endpoint_order, is_ipv4, size_ns, window_id
from flowloom.functions.sized import keep
from flowloom.operators.connections import MAX_ROWS
from flowloom.operators.flows import GROUP

TTL_S = 30.0
RECORD = ["ts_ns", "rec_id"]
#: Fields a record carries about the application protocol.
PAYLOAD = [
    "http_status_code", "http_method", "http_url", "http_latency_ms", "grpc_status_code", "grpc_method",
    "dns_response_code", "dns_query_name", "dns_num_answers", "kafka_api_key", "kafka_error_code",
    "l7_protocol_detected",
]
#: Fields every record carries.
META = ["namespace", "pod_name", "service_name", "verdict", "drop_reason"]


def summary_latency(summary: Column) -> Column:
    """Integer right before the first ``ms`` of a summary text, else 0."""
    words = F.split(F.trim(F.split(summary, "ms")[0]), r"\s+")
    return F.coalesce(F.try_element_at(words, F.lit(-1)).try_cast("int"), F.lit(0))


def nanoseconds(time: Column) -> Column:
    """Nanoseconds since 1970 of a text like ``2024-01-31T12:00:00.123456789Z``; null if it is none."""
    whole = F.regexp_replace(time, r"\.[0-9]+", "").try_cast("timestamp")
    part = F.rpad(F.regexp_extract(time, r"\.([0-9]{1,9})", 1), 9, "0").cast("long")
    return F.unix_seconds(whole) * 1_000_000_000 + part


def untimed(records: DataFrame) -> DataFrame:
    """``rows, without_time``: parsed records, and those that say neither when nor where, which match nothing."""
    lost = F.col("ts_ns").isNull() | F.col("host").isNull()
    return records.agg(F.count(F.lit(1)).alias("rows"), F.count_if(lost).alias("without_time"))


def parse_l7(lines: DataFrame) -> DataFrame:
    """Flat records from JSON lines in column ``value``.

    Lines that are no JSON, have no TCP or UDP part or no IPv4 addresses are left out.  Host and time
    are the record's node name and time where the line has no ``host`` and ``ts_ns``; a line without
    ``rec_id`` is numbered by a hash of its text, so equal times have a lasting order.
    """
    # Generators run once per line; a plain projection would be copied into the filter below.
    raw = lines.select("value", F.inline(F.array(F.from_json("value", S.L7_LINE))))
    parts = ["IP", "l4", "l7", "source", "destination", "verdict", "drop_reason_desc", "Summary", "time", "node_name"]
    own = [F.col(c).alias(f"_{c}") for c in ("time", "node_name")]
    flow = raw.select("value", "host", "ts_ns", "rec_id", *own, F.inline(F.array(F.coalesce("flow", F.struct(*parts)))))
    number_of = F.conv(F.substring(F.md5("value"), 1, 15), 16, 10).cast("long")
    flow = flow.withColumns(
        {
            "host": F.coalesce("host", "node_name", "_node_name"),
            "ts_ns": F.coalesce("ts_ns", nanoseconds(F.coalesce("time", "_time"))),
            "rec_id": F.coalesce("rec_id", number_of),
        }
    )
    text = lambda path: F.coalesce(F.col(path), F.lit(""))
    number = lambda path: F.coalesce(F.col(path), F.lit(0))
    tcp, udp = F.col("l4.TCP").isNotNull(), F.col("l4.UDP").isNotNull()
    port = lambda side: F.coalesce(f"l4.TCP.{side}_port", f"l4.UDP.{side}_port", F.lit(0))
    kinds = ["http", "grpc", "dns", "kafka"]
    kind = F.coalesce(*[F.when(F.col(f"l7.{k}").isNotNull(), F.lit(k)) for k in kinds], F.lit(""))

    def of(name: str, value: Column, default) -> Column:
        """A field of one kind of record; kinds listed earlier take precedence."""
        mine = F.col(f"l7.{name}").isNotNull()
        for other in kinds[: kinds.index(name)]:
            mine = mine & F.col(f"l7.{other}").isNull()
        return F.when(mine, value).otherwise(F.lit(default))

    out = flow.filter((tcp | udp) & is_ipv4("IP.source") & is_ipv4("IP.destination"))
    return out.select(
        "host", "ts_ns", "rec_id",
        F.col("IP.source").alias("src_ip"), port("source").alias("src_port"),
        F.col("IP.destination").alias("dst_ip"), port("destination").alias("dst_port"),
        F.when(tcp, F.lit(S.TCP)).otherwise(F.lit(S.UDP)).alias("protocol"),
        text("IP.source_xlated").alias("src_xlated"), text("IP.destination_xlated").alias("dst_xlated"),
        (kind != "").alias("has_l7"),
        of("http", number("l7.http.code"), 0).alias("http_status_code"),
        of("http", text("l7.http.method"), "").alias("http_method"),
        of("http", text("l7.http.url"), "").alias("http_url"),
        of("http", summary_latency(F.col("Summary")), 0).alias("http_latency_ms"),
        of("grpc", number("l7.grpc.status_code"), 0).alias("grpc_status_code"),
        of("grpc", text("l7.grpc.method"), "").alias("grpc_method"),
        of("dns", number("l7.dns.rcode"), 0).alias("dns_response_code"),
        of("dns", text("l7.dns.query"), "").alias("dns_query_name"),
        of("dns", F.coalesce(F.size("l7.dns.rrs"), F.lit(0)), 0).alias("dns_num_answers"),
        of("kafka", number("l7.kafka.api_key"), 0).alias("kafka_api_key"),
        of("kafka", number("l7.kafka.error_code"), 0).alias("kafka_error_code"),
        kind.alias("l7_protocol_detected"),
        text("source.namespace").alias("namespace"), text("source.pod_name").alias("pod_name"),
        text("destination.service_name").alias("service_name"),
        F.coalesce("verdict", F.lit("UNKNOWN")).alias("verdict"),
        text("drop_reason_desc").alias("drop_reason"),
    )


def nat_carry(l7: DataFrame, ttl_s: float = TTL_S, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Fill in translated addresses seen earlier on the same conversation.

    A record's own translation wins.  Next come translations of its own direction, then, only
    if its direction has none at all, those of the opposite direction with the ends swapped.
    What a direction taught is forgotten when it had no record for longer than ``ttl_s``.
    """
    ttl = size_ns(ttl_s)
    rows, block = split_hot_groups(l7.withColumns(endpoint_order()), CONVERSATION, ttl_s, max_rows)
    known = lambda side: F.when(F.col(f"{side}_xlated") != "", F.col(f"{side}_xlated"))
    lines = [(F.col("dir") == d, {f"_{side}{d}": known(side) for side in ("src", "dst")}) for d in (0, 1)]
    rows = remembered(rows, CONVERSATION, block, RECORD, ttl, lines)
    by_dir = lambda pick: F.when(F.col("dir") == 0, pick(0)).otherwise(pick(1))
    rows = rows.withColumns(
        {
            "_fs": by_dir(lambda d: F.col(f"_src{d}")),
            "_fd": by_dir(lambda d: F.col(f"_dst{d}")),
            "_rs": by_dir(lambda d: F.col(f"_dst{1 - d}")),
            "_rd": by_dir(lambda d: F.col(f"_src{1 - d}")),
        }
    )
    own = F.col("_fs").isNotNull() | F.col("_fd").isNotNull()
    fill = lambda f, r: F.coalesce(F.when(own, F.col(f)).otherwise(F.col(r)), F.lit(""))
    return rows.withColumns({"src_xlated": fill("_fs", "_rs"), "dst_xlated": fill("_fd", "_rd")}).select(*l7.columns)


def nat_expand(l7: DataFrame) -> DataFrame:
    """One row per address pair a record is known under: original, either end, both ends."""
    pair = lambda src, dst: F.struct(src.alias("src_ip"), dst.alias("dst_ip"))
    src, dst, xsrc, xdst = (F.col(c) for c in ("src_ip", "dst_ip", "src_xlated", "dst_xlated"))
    has_src, has_dst = is_ipv4("src_xlated"), is_ipv4("dst_xlated")
    pairs = F.array(
        pair(src, dst),
        F.when(has_src, pair(xsrc, dst)),
        F.when(has_dst, pair(src, xdst)),
        F.when(has_src & has_dst, pair(xsrc, xdst)),
    )
    out = l7.withColumn("_pair", F.explode(F.array_distinct(F.array_compact(pairs))))
    return out.withColumns({"src_ip": F.col("_pair.src_ip"), "dst_ip": F.col("_pair.dst_ip")}).drop("_pair")


def merge_l7(l7: DataFrame, ttl_s: float = TTL_S, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """What is known about a flow right after each record.

    A record with application data replaces everything.  One without keeps the application
    data of earlier records, as long as no pause exceeded ``ttl_s``, and renews the rest.
    """
    ttl = size_ns(ttl_s)
    rows, block = split_hot_groups(l7, S.FLOW, ttl_s, max_rows)
    data = F.when(F.col("has_l7"), F.struct(*PAYLOAD))
    rows = remembered(rows, S.FLOW, block, RECORD, ttl, [(F.lit(True), {"_kept": data})])
    held = F.col("_kept").isNotNull()
    return rows.select(
        *S.FLOW,
        *RECORD,
        *[F.when(held, F.col(f"_kept.{n}")).otherwise(F.col(n)).alias(n) for n in PAYLOAD],
        *META,
    )


def l7_entries(lines: DataFrame, ttl_s: float = TTL_S, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """From JSON lines to merged entries, ready for :func:`enrich_l7`."""
    return entries_of(parse_l7(lines), ttl_s, max_rows)


def entries_of(records: DataFrame, ttl_s: float = TTL_S, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """From parsed records to merged entries, stored once because matching reads them repeatedly."""
    known = keep(nat_expand(nat_carry(keep(records), ttl_s, max_rows)))
    return keep(merge_l7(known, ttl_s, max_rows))


def match_l7(
    packets: DataFrame, entries: DataFrame, size_s: float = 5.0, ttl_s: float = TTL_S, max_rows: int | None = MAX_ROWS
) -> DataFrame:
    """The entry each flow window gets: columns of the window's key and a struct ``l7``.

    A packet sees the newest entry of its flow younger than ``ttl_s``, else of the reverse
    flow.  The first packet that sees one decides.  If none does, one more look is taken one
    window after the end.  Packets, entries and those late looks form one time line per flow;
    looking up an entry is remembering the last one, so nothing is joined by range.
    """
    size, ttl = size_ns(size_s), size_ns(ttl_s)
    names = [*PAYLOAD, *META]
    value = F.struct(F.col("ts_ns").alias("at"), F.struct(*names).alias("data"))
    empty = F.lit(None).cast(entries.select(value.alias("v")).schema["v"].dataType)
    look = packets.select(
        *S.FLOW, "ts_ns", F.col("pkt_id").alias("_id"), F.lit(1).alias("_kind"),
        window_id(size_s=size_s).alias("_for"), empty.alias("_fwd"), empty.alias("_rev"),
    )
    # One late look per flow window, at the time its row is written.
    late = (
        look.select(*S.FLOW, "_for")
        .distinct()
        .select(
            *S.FLOW, ((F.col("_for") + 2) * F.lit(size).cast("long")).alias("ts_ns"), F.lit(0).cast("long").alias("_id"),
            F.lit(2).alias("_kind"), "_for", empty.alias("_fwd"), empty.alias("_rev"),
        )
    )
    none = F.lit(None).cast("long")
    given = entries.select(
        *S.FLOW, "ts_ns", F.col("rec_id").alias("_id"), F.lit(0).alias("_kind"), none.alias("_for"),
        value.alias("_fwd"), empty.alias("_rev"),
    )
    turned = entries.select(
        "host", F.col("dst_ip").alias("src_ip"), F.col("dst_port").alias("src_port"),
        F.col("src_ip").alias("dst_ip"), F.col("src_port").alias("dst_port"), "protocol",
        "ts_ns", F.col("rec_id").alias("_id"), F.lit(0).alias("_kind"), none.alias("_for"),
        empty.alias("_fwd"), value.alias("_rev"),
    )
    line = look.unionByName(late).unionByName(given).unionByName(turned)
    cut, block = split_hot_groups(line, S.FLOW, size_s, max_rows)
    values = {"_f": F.col("_fwd"), "_r": F.col("_rev")}
    seen = last_before(cut, S.FLOW, block, ["ts_ns", "_kind", "_id"], values, inclusive=True)
    young = lambda c: F.when(F.col("ts_ns") - F.col(f"{c}.at") < ttl, F.col(f"{c}.data"))
    hits = seen.filter(F.col("_kind") > 0).select(
        *S.FLOW, F.col("_for").alias("window_id"), F.struct("_kind", "ts_ns", "_id").alias("_pos"),
        F.coalesce(young("_f"), young("_r")).alias("l7"),
    )
    return hits.filter(F.col("l7").isNotNull()).groupBy(*GROUP).agg(F.min_by("l7", "_pos").alias("l7"))


def enrich_l7(
    flows: DataFrame,
    packets: DataFrame,
    entries: DataFrame,
    size_s: float = 5.0,
    ttl_s: float = TTL_S,
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Add the application fields to flow windows; empty text and zeros where none matched."""
    return add_entries(flows, match_l7(packets, entries, size_s, ttl_s, max_rows))


def add_entries(flows: DataFrame, matched: DataFrame) -> DataFrame:
    """Flow windows with the fields of the entry ``l7`` that each was given; empty text and zeros where it has none."""
    names = [*S.L7_FEATURES, "http_url", "dns_query_name"]
    types = {f.name: f.dataType for f in matched.schema["l7"].dataType.fields}
    out = flows.join(matched, GROUP, "left")
    blank = {n: F.lit("" if types[n].simpleString() == "string" else 0) for n in names}
    return out.withColumns({n: F.coalesce(F.col(f"l7.{n}"), blank[n]) for n in names}).drop("l7")

