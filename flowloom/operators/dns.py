"""Questions and their first answers: DNS latency and TCP handshake round trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.ordered import last_before, row_numbers, split_hot_groups
from flowloom.functions.scalar import CONVERSATION, endpoint_order, has_flag, idiv
from flowloom.operators.connections import MAX_ROWS
from flowloom.operators.flows import GROUP, rank_index

#: Latencies are ranked in slices of about a millisecond.
_LATENCY_SLICE = 1 << 20


def first_answers(
    packets: DataFrame, question: Column, answer: Column, size_s: float = 5.0, max_rows: int | None = MAX_ROWS
) -> DataFrame:
    """Each question with the time of the first strictly later answer of the other direction.

    One pass over both directions of a conversation, backwards in time, that remembers the
    last answer seen; no pairs are formed.  One answer may serve several questions.
    """
    slim = packets.select(*S.FLOW, *S.ORDER, question.alias("_q"), answer.alias("_a")).filter("_q or _a")
    both, block = split_hot_groups(slim.withColumns(endpoint_order()), CONVERSATION, size_s, max_rows)
    # Backwards in time; at equal times questions come first, so they miss that answer.
    back = both.withColumns(
        {"_block": -F.col(block), "_t": -F.col("ts_ns"), "_late": F.col("_a").cast("int"), "_i": -F.col("pkt_id")}
    )
    values = {f"_answer{d}": F.when(F.col("_a") & (F.col("dir") == d), F.col("ts_ns")) for d in (0, 1)}
    seen = last_before(back, CONVERSATION, "_block", ["_t", "_late", "_i"], values)
    answer_ns = F.when(F.col("dir") == 0, F.col("_answer1")).otherwise(F.col("_answer0"))
    return seen.filter("_q").select(*S.FLOW, "window_id", *S.ORDER, answer_ns.alias("answer_ns"))


def dns_match(
    packets: DataFrame, max_ms: float = 5000, size_s: float = 5.0, max_rows: int | None = MAX_ROWS
) -> DataFrame:
    """DNS queries with the latency of their answer, null where none came within ``max_ms``."""
    udp = F.col("protocol") == S.UDP
    asked = first_answers(packets, udp & (F.col("dst_port") == 53), udp & (F.col("src_port") == 53), size_s, max_rows)
    wait = F.col("answer_ns") - F.col("ts_ns")
    return asked.withColumn("latency_ns", F.when(wait < int(max_ms * 1e6), wait)).drop("answer_ns")


def dns_latency(matches: DataFrame) -> DataFrame:
    """Per flow and window: queries, unanswered queries, mean and 95th percentile latency.

    The percentile is the sorted value at index ``int(0.95 n)``.  Positions are counted
    over slices of latency, so a resolver's crowded window is spread over tasks.
    """
    totals = matches.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("dns_queries"),
        F.count("latency_ns").alias("_n"),
        F.avg("latency_ns").alias("_mean"),
    )
    answered = matches.filter(F.col("latency_ns").isNotNull()).withColumn("_slice", idiv("latency_ns", _LATENCY_SLICE))
    ranked = row_numbers(answered, GROUP, "_slice", ["latency_ns", "pkt_id"], "_rank", whole=True)
    p95 = ranked.filter(F.col("_rank") == rank_index(F.col("_rank_all"), 0.95) + 1).select(
        *GROUP, F.col("latency_ns").alias("_p95")
    )
    return totals.join(p95, GROUP, "left").select(
        *GROUP,
        "dns_queries",
        (F.col("dns_queries") - F.col("_n")).alias("dns_unanswered"),
        (F.coalesce("_mean", F.lit(0.0)) / 1e6).alias("dns_query_latency_ms"),
        (F.coalesce("_p95", F.lit(0)) / 1e6).alias("dns_query_latency_p95"),
    )


def rtt(packets: DataFrame, size_s: float = 5.0, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Per flow: mean and variance (ms) of the time from a SYN to the first SYN-ACK back."""
    syn, ack = has_flag(S.SYN), has_flag(S.ACK)
    tcp = F.col("protocol") == S.TCP
    asked = first_answers(packets, tcp & syn & ~ack, tcp & syn & ack, size_s, max_rows)
    ms = (F.col("answer_ns") - F.col("ts_ns")) / 1e6
    return asked.groupBy(*S.FLOW).agg(
        F.count(F.lit(1)).alias("syn_count"),
        F.count(ms).alias("rtt_samples"),
        F.coalesce(F.avg(ms), F.lit(0.0)).alias("rtt_estimate_ms"),
        F.coalesce(F.var_samp(ms), F.lit(0.0)).alias("rtt_variance"),
    )
