"""TCP connection tracking over directional flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.ordered import last_before, split_hot_groups
from flowloom.functions.scalar import has_flag
from flowloom.operators.packets import UINT32, valid_size

#: Rows of one flow and window beyond which the window is cut into time slices.
MAX_ROWS = 200_000


def retransmission(seq: Column, prev: Column, syn: Column) -> Column:
    """A sequence number below the preceding one, unless the packet is a SYN."""
    return F.coalesce((seq < prev) & ~syn, F.lit(False))


def out_of_order(seq: Column, prev: Column, syn: Column) -> Column:
    """A jump of more than 1500 ahead, compared as unsigned 32-bit numbers."""
    ahead = seq > F.pmod(prev + 1500, F.lit(UINT32))
    return ~retransmission(seq, prev, syn) & F.coalesce(ahead, F.lit(False))


def connection_state(known: Column, flags: Column | str = "tcp_flags") -> Column:
    """State id of a packet from its flags and from whether its flow was seen before."""
    fin_rst, ack, syn = has_flag(S.FIN | S.RST, flags), has_flag(S.ACK, flags), has_flag(S.SYN, flags)
    return (
        F.when(syn, F.lit(1))
        .when(~known, F.lit(2))
        .when(fin_rst, F.lit(3))
        .when(ack, F.lit(2))
        .otherwise(F.lit(0))
    )


def track_connections(packets: DataFrame, size_s: float = 5.0, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Compare each packet of annotated ``packets`` with the one before it in its flow.

    Adds ``window_id``, ``prev_seq``, ``retransmission``, ``out_of_order``, ``conn_state`` and
    the order-dependent error bits, and per window of ``size_s`` seconds, over packets of
    valid size only, ``gap_ns`` and ``prev_window``.  One shuffle of the packets by flow and
    window; what crosses a window is carried by one row per window.  ``max_rows=None`` skips
    the search for crowded windows; use it behind the flood gate, which bounds them.
    """
    cut, block = split_hot_groups(packets, S.FLOW, size_s, max_rows, tie="pkt_id")
    tcp = F.col("protocol") == S.TCP
    here = F.struct("window_id", "ts_ns", F.when(tcp, F.col("tcp_window")).alias("tcp_window"))
    out = last_before(
        cut,
        S.FLOW,
        block,
        S.ORDER,
        {"prev_seq": F.when(tcp, F.col("tcp_seq")), "_prev": F.when(valid_size(), here)},
    )
    syn, seq, prev = has_flag(S.SYN), F.col("tcp_seq"), F.col("prev_seq")
    same_window = valid_size() & (F.col("_prev.window_id") == F.col("window_id"))
    out = out.withColumns(
        {
            "retransmission": tcp & retransmission(seq, prev, syn),
            "out_of_order": tcp & out_of_order(seq, prev, syn),
            "conn_state": F.when(tcp, connection_state(prev.isNotNull())).otherwise(F.lit(0)),
            "gap_ns": F.when(same_window, F.col("ts_ns") - F.col("_prev.ts_ns")),
            "prev_window": F.when(same_window, F.col("_prev.tcp_window")),
        }
    ).drop("_prev")
    bit = lambda name, mask: F.when(F.col(name), F.lit(mask)).otherwise(F.lit(0))
    return out.withColumn(
        "error_flags",
        F.col("error_flags") + bit("out_of_order", S.ERR_OUT_OF_ORDER) + bit("retransmission", S.ERR_RETRANSMISSION),
    )
