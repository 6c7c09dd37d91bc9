"""Features of one directional flow in one tumbling window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.scalar import NS, clamp, flow_id, has_flag, idiv, ratio, state_name
from flowloom.functions.sized import lookup_join, small_side
from flowloom.operators.connections import MAX_ROWS, track_connections
from flowloom.operators.packets import valid_size

GROUP = [*S.FLOW, "window_id"]
QUANTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}

# Plausibility limits of rates and of the mean packet size.
MAX_PPS, MAX_BPS, MIN_AVG_SIZE, MAX_AVG_SIZE = 1e7, 1e11, 40, 9000


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def rank_index(n: Column, q: float) -> Column:
    """0-based rank of quantile ``q`` among ``n`` sorted values, without interpolation."""
    return F.least(F.floor(n * F.lit(q)), n - 1).cast("int")


def longest_run(pieces: Column) -> Column:
    """Longest run over time-sorted ``(first, last, n)`` pieces; gaps below 1 s connect."""
    start = F.struct(
        F.lit(None).cast("long").alias("last"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("best")
    )

    def step(acc: Column, piece: Column) -> Column:
        run = F.when(piece["first"] - acc["last"] < NS, acc["run"] + piece["n"]).otherwise(piece["n"])
        return F.struct(piece["last"].alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(pieces, start, step)["best"]


def _crowded_stats(tracked: DataFrame) -> DataFrame:
    """Order statistics and retransmission runs of windows too crowded to gather.

    Gaps of a window are whole nanoseconds that add up to no more than its length, so a
    window of W ns has fewer than sqrt(2 W) distinct ones: 100,000 at 5 s.  Counting equal
    gaps first bounds the rows ranked per window by that.  Retransmissions within one
    second of the clock always belong to one run, so they are counted per second first.
    """
    crowded = tracked.filter("crowded")
    hist = crowded.filter(F.col("gap_ns").isNotNull()).groupBy(*GROUP, "gap_ns").agg(F.count(F.lit(1)).alias("n"))
    by_gap = Window.partitionBy(*GROUP).orderBy("gap_ns").rowsBetween(Window.unboundedPreceding, 0)
    ranked = hist.select(
        *GROUP, "gap_ns", F.sum("n").over(by_gap).alias("upto"), F.sum("n").over(Window.partitionBy(*GROUP)).alias("all")
    )
    quantiles = ranked.groupBy(*GROUP).agg(
        *[F.min(F.when(F.col("upto") > rank_index(F.col("all"), q), F.col("gap_ns"))).alias(f"_c_{name}")
          for name, q in QUANTILES.items()]
    )
    second = idiv("ts_ns", NS)
    runs = (
        crowded.filter(F.col("retransmission") & valid_size())
        .groupBy(*GROUP, second.alias("second"))
        .agg(F.min("ts_ns").alias("first"), F.max("ts_ns").alias("last"), F.count(F.lit(1)).alias("n"))
        .groupBy(*GROUP)
        .agg(longest_run(F.array_sort(F.collect_list(F.struct("first", "last", "n")))).alias("_c_run"))
    )
    return quantiles.join(runs, GROUP, "full")


def window_stats(tracked: DataFrame, rcode_mask: int = 3) -> DataFrame:
    """Aggregate tracked packets per flow and window; the raw numbers behind the features.

    Every aggregate merges, so a crowded window is reduced where its slices lie.  Lists are
    gathered only for windows known to be small.
    """
    valid = valid_size()
    tcp = valid & (F.col("protocol") == S.TCP)
    pos = F.struct(*S.ORDER)
    w, prev_w, ts, gap = F.col("tcp_window"), F.col("prev_window"), F.col("ts_ns"), F.col("gap_ns")
    small = ~F.col("crowded") if "crowded" in tracked.columns else F.lit(True)
    ttl = F.when(F.col("ip_ttl") > 0, F.col("ip_ttl"))
    one = F.struct(ts.alias("first"), ts.alias("last"), F.lit(1).cast("long").alias("n"))
    dns = F.col("protocol") == S.UDP
    stats = tracked.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n_all"),
        count_where(valid).alias("packet_count"),
        F.sum(F.when(valid, F.col("packet_size"))).alias("byte_count"),
        F.min(ts).alias("start_ns"),
        F.max(ts).alias("end_ns"),
        F.count(gap).alias("n_gaps"),
        F.avg(gap).alias("gap_mean"),
        F.stddev_samp(gap).alias("gap_std"),
        F.sort_array(F.collect_list(F.when(small, gap))).alias("gaps"),
        count_where(tcp).alias("tcp_count"),
        count_where(tcp & F.col("retransmission")).alias("retransmission_count"),
        F.array_sort(F.collect_list(F.when(small & tcp & F.col("retransmission"), one))).alias("runs"),
        count_where(tcp & F.col("out_of_order")).alias("out_of_order_count"),
        count_where(tcp & has_flag(S.RST)).alias("rst_count"),
        count_where(tcp & has_flag(S.FIN)).alias("fin_count"),
        count_where(tcp & has_flag(S.PSH)).alias("psh_count"),
        count_where(tcp & has_flag(S.SYN) & has_flag(S.ACK)).alias("syn_ack_count"),
        count_where(tcp & has_flag(S.SYN) & ~has_flag(S.ACK)).alias("half_open_connections"),
        count_where(tcp & (w == 0)).alias("zero_window_count"),
        F.min(F.when(tcp & (w > 0), w)).alias("tcp_window_min"),
        F.avg(F.when(tcp & (w > 0), w)).alias("tcp_window_avg"),
        count_where(tcp & (w < prev_w * 0.5)).alias("tcp_window_drops"),
        F.sum(F.when(tcp & (prev_w == 0), gap)).alias("zero_ns"),
        F.max(F.when(tcp & (w == 0) & ((prev_w > 0) | prev_w.isNull()), ts)).alias("zero_open_ns"),
        F.max_by(w, F.when(tcp, pos)).alias("last_window"),
        F.max(F.when(tcp, ts)).alias("last_tcp_ns"),
        F.max_by("conn_state", F.when(tcp, pos)).alias("last_state"),
        F.min_by(gap, F.when(tcp & gap.isNotNull(), pos)).alias("first_gap"),
        F.min(ttl).alias("ttl_min"),
        F.avg(ttl).alias("ttl_avg"),
        F.stddev_pop(ttl).alias("ttl_stddev"),
        # Payload sizes are 16-bit lengths, so the set is bounded.
        F.size(F.collect_set("payload_size")).alias("payload_sizes"),
        F.max("payload_size").alias("payload_max"),
        count_where(F.col("error_flags") != 0).alias("error_count"),
        count_where(dns & (F.col("dst_port") == 53)).alias("dns_queries"),
        count_where(dns & (F.col("src_port") == 53)).alias("dns_responses"),
        count_where(
            (F.col("l7_protocol") == S.L7_DNS) & (F.col("dns_flags").bitwiseAND(F.lit(rcode_mask)) != 0)
        ).alias("dns_errors"),
        *[count_where(F.col("l7_protocol") == i).alias(f"l7_{i}") for i in (S.L7_HTTP, S.L7_HTTPS, S.L7_DNS)],
    )
    if "crowded" in tracked.columns:
        stats = stats.join(_crowded_stats(tracked), GROUP, "left")
    return stats.filter(F.col("packet_count") > 0)


def _with_order_stats(stats: DataFrame) -> DataFrame:
    """Add ``gap_p50, gap_p95, gap_p99`` and ``run`` from the gathered lists and the counts of crowded windows."""
    run, gaps = longest_run(F.col("runs")), {q: F.get("gaps", rank_index(F.size("gaps"), QUANTILES[q])) for q in QUANTILES}
    if "_c_run" in stats.columns:
        run = F.greatest(run, F.coalesce("_c_run", F.lit(0).cast("long")))
        gaps = {q: F.coalesce(F.col(f"_c_{q}"), value) for q, value in gaps.items()}
    return stats.withColumns({**{f"gap_{q}": value for q, value in gaps.items()}, "run": run})


def _most_frequent_l7() -> Column:
    counts = [(i, F.col(f"l7_{i}")) for i in (S.L7_HTTP, S.L7_HTTPS, S.L7_DNS)]
    top = F.greatest(*[n for _, n in counts])
    out = F.when(top == 0, F.lit(S.L7_UNKNOWN))
    for i, n in counts:
        out = out.when(n == top, F.lit(i))
    return out


def flow_features(
    packets: DataFrame,
    size_s: float = 5.0,
    rate_base: str = "window",
    syn: DataFrame | tuple[DataFrame, bool] | None = None,
    max_rows: int | None = MAX_ROWS,
    rcode_mask: int = 3,
) -> DataFrame:
    """One row per flow and window with its network features.

    Takes annotated packets, or already tracked ones.  Rates divide by the window length,
    or by the observed span with ``rate_base='observed'``.  ``syn`` is the table of
    :func:`flowloom.operators.flood.syn_cumulative`; with it ``syn_count`` is the source's
    running total, else the flow's own count, which ``syn_count_flow`` always holds.
    """
    tracked = packets if "retransmission" in packets.columns else track_connections(packets, size_s, max_rows)
    base = features_of(_with_order_stats(window_stats(tracked, rcode_mask)), size_s, rate_base)
    return with_syn(base, syn).drop("_handshake")


def features_of(stats: DataFrame, size_s: float = 5.0, rate_base: str = "window", keep: Sequence[str] = ()) -> DataFrame:
    """The features that follow from the raw numbers of a flow window alone; those of SYN packets are still missing.

    ``stats`` are the columns of :func:`window_stats` with ``gap_p50, gap_p95, gap_p99`` and ``run`` for the lists, on a
    stream or a table.  ``_handshake`` is left for :func:`with_syn`.  Columns named in ``keep`` stay as they are.
    """
    span = (F.col("end_ns") - F.col("start_ns")) / NS
    seconds = F.lit(float(size_s))
    if rate_base == "observed":
        seconds = F.when(span == 0, F.lit(0.001)).otherwise(span)
    elif rate_base != "window":
        raise ValueError("rate_base is 'window' or 'observed'")
    n, size = F.col("packet_count"), F.col("byte_count")
    mean_ms, std_ms = F.coalesce("gap_mean", F.lit(0.0)) / 1e6, F.coalesce("gap_std", F.lit(0.0)) / 1e6
    p50, p95, p99 = (F.when(F.col("n_gaps") >= 2, F.col(f"gap_{q}") / 1e6).otherwise(F.lit(0.0)) for q in QUANTILES)
    zero_ns = F.coalesce("zero_ns", F.lit(0)) - F.when(
        F.col("last_window") == 0, F.col("last_tcp_ns") - F.col("zero_open_ns")
    ).otherwise(F.lit(0))
    closed = F.col("fin_count") + F.col("rst_count")
    is_tcp = F.col("tcp_count") > 0
    return stats.select(
        *GROUP,
        flow_id().alias("flow_id"),
        _most_frequent_l7().alias("l7_protocol"),
        "start_ns", "end_ns", "n_all", "tcp_count", "packet_count", "byte_count",
        clamp(n / seconds, 0, MAX_PPS).alias("packets_per_second"),
        clamp(size / seconds, 0, MAX_BPS).alias("bytes_per_second"),
        clamp(size / n, MIN_AVG_SIZE, MAX_AVG_SIZE).alias("avg_packet_size"),
        mean_ms.alias("inter_arrival_mean_ms"),
        std_ms.alias("inter_arrival_std_ms"),
        F.when(mean_ms > 0, std_ms / mean_ms).otherwise(F.lit(0.0)).alias("inter_arrival_jitter"),
        p50.alias("latency_p50"), p95.alias("latency_p95"), p99.alias("latency_p99"),
        F.when(p50 > 0, p99 / p50).otherwise(F.lit(0.0)).alias("tail_latency_ratio"),
        "retransmission_count",
        ratio(F.col("retransmission_count"), F.col("tcp_count")).alias("retransmission_rate"),
        F.col("run").alias("consecutive_retrans"),
        "out_of_order_count",
        F.col("rst_count").alias("tcp_resets"),
        "zero_window_count",
        (zero_ns / NS).alias("zero_window_duration"),
        "syn_ack_count", "fin_count", "rst_count", "psh_count",
        F.lit(0).cast("long").alias("duplicate_acks"),
        F.coalesce("ttl_min", F.lit(0)).alias("ttl_min"),
        F.coalesce("ttl_avg", F.lit(0.0)).alias("ttl_avg"),
        F.coalesce("ttl_stddev", F.lit(0.0)).alias("ttl_stddev"),
        F.when(F.col("payload_max") > 0, F.least(F.lit(1.0), F.col("payload_sizes") / F.col("n_all")))
        .otherwise(F.lit(0.0)).alias("payload_entropy"),
        "dns_queries", "dns_responses",
        (F.col("dns_errors") + F.greatest(F.lit(0), F.col("dns_queries") - F.col("dns_responses")))
        .alias("dns_failures"),
        F.when(is_tcp, state_name("last_state")).otherwise(F.lit("ESTABLISHED")).alias("connection_state"),
        seconds.alias("connection_duration"),
        (F.coalesce("first_gap", F.lit(0)) / NS).alias("_handshake"),
        (F.col("error_count") / n).alias("error_rate"),
        "half_open_connections",
        F.col("half_open_connections").alias("syn_count_flow"),
        F.coalesce(F.col("tcp_window_min").cast("long"), F.lit(0).cast("long")).alias("tcp_window_min"),
        F.coalesce("tcp_window_avg", F.lit(0.0)).alias("tcp_window_avg"),
        "tcp_window_drops",
        (closed / seconds).alias("connection_churn"),
        ratio(F.col("rst_count"), closed).alias("abnormal_termination_ratio"),
        *keep,
    )


def with_syn(base: DataFrame, syn: DataFrame | tuple[DataFrame, bool] | None) -> DataFrame:
    """Add the SYN features, from the source's total where it is known: from ``syn``, or from a column ``_syn``."""
    own = F.col("syn_count_flow")
    if "_syn" in base.columns:
        joined, count = base, F.coalesce(F.col("_syn"), own)
    elif syn is None:
        joined, count = base, own
    else:
        table, small = syn if isinstance(syn, tuple) else small_side(syn)
        totals = table.select(*S.SOURCE, "window_id", F.col("syn_at_close").alias("_syn")).filter(F.col("_syn") > 0)
        joined = lookup_join(base, (totals, small), [*S.SOURCE, "window_id"], spread=["dst_ip", "dst_port", "src_port"])
        count = F.coalesce(F.col("_syn"), own)
    count = F.when(F.col("tcp_count") > 0, count).otherwise(F.lit(0)).cast("long")
    answered = F.col("syn_ack_count")
    out = joined.withColumn("syn_count", count).drop("_syn")
    return out.withColumns(
        {
            "syn_to_synack_ratio": ratio(F.col("syn_count"), answered, 0.0)
            + F.when(answered == 0, F.col("syn_count").cast("double")).otherwise(F.lit(0.0)),
            "connection_rate": F.col("syn_count") / F.col("connection_duration"),
            "handshake_latency": F.when(F.col("syn_count") > 0, F.col("_handshake")).otherwise(F.lit(0.0)),
        }
    )
