"""Flooding sources: the rate gate, SYN totals and the rows written for blocked sources."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.ordered import FAN, running_total
from flowloom.functions.scalar import blocked_flow_id, has_flag, idiv, size_ns, window_id
from flowloom.functions.sized import lookup_join

THRESHOLD = 500
#: Rate windows per piece of a source's history that one task walks at a time.
PIECE = 64
#: Packets that a group of neighbouring pieces may hold at most, unless one piece may hold more.
GROUP_ROWS = 64_000
#: Neighbouring pieces that one task joins into one.
PIECES_JOINED = 256

_PIECE_SCHEMA = (
    "host string, src_ip string, piece bigint, head_ts array<bigint>, head_id array<bigint>, "
    "block_ts array<bigint>, block_id array<bigint>, exit_ts array<bigint>, exit_n array<bigint>"
)


def _piece_outcomes(threshold: int, win_ns: int, piece: int = PIECE):
    """Outcome of each piece in a stretch of a source for every packet that may open its first window.

    A rate window opens at a packet and lasts ``win_ns``; the next one opens at the first
    packet after it.  Where a piece starts inside a window left open by the piece before,
    the first own window opens at one of the packets of the first ``win_ns``.  For each of
    those the windows are followed to the end of the piece, for all pieces at once, one window a step.
    The result is the packet that gets the source blocked, or the window left open.
    """

    def outcomes(key, pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(["ts_ns", "pkt_id"], kind="stable")
        ts, ids = pdf["ts_ns"].to_numpy(np.int64), pdf["pkt_id"].to_numpy(np.int64)
        after = np.searchsorted(ts, ts + win_ns, side="right")
        pieces, begins = np.unique(ts // (piece * win_ns), return_index=True)
        ends = np.append(begins[1:], len(ts))
        heads = np.searchsorted(ts, (pieces * piece + 1) * win_ns, side="left")
        starts = np.concatenate([[0], np.cumsum(heads - begins + 1)])
        own = np.repeat(np.arange(len(pieces)), heads - begins + 1)
        at, end = np.arange(starts[-1]) - starts[own] + begins[own], ends[own]
        blocked = np.full(len(at), -1)
        live = np.flatnonzero(at < end)
        while len(live):
            cur = at[live]
            following = np.minimum(after[cur], end[live])
            over = following - cur > threshold
            blocked[live[over]] = cur[over] + threshold
            more = ~over & (following < end[live])
            live = live[more]
            at[live] = following[more]
        hit, inside = blocked >= 0, at < end
        safe_at, safe_hit = np.where(inside, at, 0), np.where(hit, blocked, 0)
        rows = {
            "block_ts": np.where(hit, ts[safe_hit], -1), "block_id": np.where(hit, ids[safe_hit], -1),
            "exit_ts": np.where(inside, ts[safe_at], -1), "exit_n": np.where(inside, end - at, 0),
        }
        cut = lambda values: [values[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        head = lambda values: [values[a:b] for a, b in zip(begins, heads, strict=True)]
        return pd.DataFrame({"host": key[0], "src_ip": key[1], "piece": pieces, "head_ts": head(ts), "head_id": head(ids), **{k: cut(v) for k, v in rows.items()}})

    return outcomes


def _after(one: dict, other: dict, threshold: int, win_ns: int) -> dict:
    """Outcomes of two neighbouring pieces taken as one, for every packet of the first one's head.

    A window left open by ``one`` takes in the packets of the head of ``other`` that it still covers; the next window opens
    behind them, or ``other`` is passed through with the window still open.
    """
    import numpy as np

    out = {"head_ts": one["head_ts"], "head_id": one["head_id"]}
    done = one["block_ts"] >= 0
    seen = np.where(done, 0, one["exit_n"])
    inside = np.where(seen > 0, np.searchsorted(other["head_ts"], one["exit_ts"] + win_ns, side="right"), 0)
    over = (seen > 0) & (seen + inside > threshold)
    at = np.where(over, threshold - seen, 0)
    left = np.minimum(inside, len(other["exit_n"]) - 1)
    open_still = (seen > 0) & (other["exit_n"][left] == 0) & (other["block_ts"][left] < 0)
    has_head = len(other["head_ts"]) > 0
    for name in ("ts", "id"):
        head = other[f"head_{name}"][np.minimum(at, len(other["head_ts"]) - 1)] if has_head else np.full(len(at), -1)
        out[f"block_{name}"] = np.where(done, one[f"block_{name}"], np.where(over, head, other[f"block_{name}"][left]))
    out["exit_ts"] = np.where(open_still, one["exit_ts"], other["exit_ts"][left])
    out["exit_n"] = np.where(open_still, seen + inside, other["exit_n"][left])
    return out


def _compose(threshold: int, win_ns: int, fan: int):
    """Reduce each run of pieces with one number divided by ``fan`` to one piece; pieces come in order."""
    names = ["head_ts", "head_id", "block_ts", "block_id", "exit_ts", "exit_n"]

    def reduce(batches: Iterator):
        import numpy as np
        import pandas as pd

        key, held = None, None
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                here, own = (row.host, row.src_ip, row.piece // fan), {n: np.asarray(getattr(row, n), dtype=np.int64) for n in names}
                if here == key:
                    held = _after(held, own, threshold, win_ns)
                    continue
                if key is not None:
                    out.append((*key, *[held[n] for n in names]))
                key, held = here, own
            yield pd.DataFrame(out, columns=["host", "src_ip", "piece", *names])
        if key is not None:
            yield pd.DataFrame([(*key, *[held[n] for n in names])], columns=["host", "src_ip", "piece", *names])

    return reduce


def flood_blocklist(
    packets: DataFrame, threshold: int = THRESHOLD, window_s: float = 1.0, piece: int = PIECE, fan: int = PIECES_JOINED
) -> DataFrame:
    """Sources that send more than ``threshold`` packets within one rate window.

    A source's first window opens at its first packet and each next one at the first packet
    later than ``window_s`` after the opening of the last.  One row per blocked source with
    the first dropped packet (``block_ts``, ``block_id``); ``packet_count`` is the count kept
    when it was blocked, which is the threshold.

    Exact and split by time.  Counts per aligned bucket of ``window_s`` decide which packets
    matter.  A window spans at most two neighbouring buckets, so sources without two of them
    above the threshold are left out.  A bucket of twice the threshold is shared by at most
    two windows, so it blocks for certain, and by its packet of that number at the latest:
    later buckets and later packets of a bucket are left out.  That bounds the packets of a
    source by ``2 * threshold`` per bucket however many it sent.  What is left is cut into
    pieces of ``piece`` buckets that are solved independently, as many in one call as keep to ``GROUP_ROWS``.  A piece is a function from the window
    left open before it to the blocking packet or the window it leaves open; such functions compose,
    so neighbours are joined ``fan`` at a time, level by level, and no task walks a source's history.
    """
    win_ns = size_ns(window_s)
    most = 2 * threshold
    stretch = piece * max(1, GROUP_ROWS // (most * piece))
    slim = packets.select(*S.SOURCE, *S.ORDER, idiv("ts_ns", win_ns).alias("bucket"))
    counts = slim.groupBy(*S.SOURCE, "bucket").agg(F.count(F.lit(1)).alias("n"))
    pairs = counts.select(
        *S.SOURCE, "bucket", "n", F.explode(F.array(F.col("bucket"), F.col("bucket") - 1)).alias("pair")
    )
    suspects = (
        pairs.groupBy(*S.SOURCE, "pair")
        .agg(F.sum("n").alias("both"), F.min(F.when(F.col("n") >= most, F.col("bucket"))).alias("sure"))
        .groupBy(*S.SOURCE)
        .agg(F.max("both").alias("both"), F.min("sure").alias("sure"))
        .filter(F.col("both") > threshold)
        .select(*S.SOURCE, F.coalesce("sure", F.lit(2**62)).alias("sure"))
    )
    rows = lookup_join(slim, suspects, S.SOURCE, spread=S.ORDER, how="inner").filter(F.col("bucket") <= F.col("sure"))
    in_bucket = Window.partitionBy(*S.SOURCE, "bucket").orderBy(*S.ORDER)
    kept = rows.withColumn("_rank", F.row_number().over(in_bucket)).filter(F.col("_rank") <= most)
    pieces = (
        kept.select(*S.SOURCE, *S.ORDER, idiv("bucket", stretch).alias("stretch"))
        .groupBy(*S.SOURCE, "stretch")
        .applyInPandas(_piece_outcomes(threshold, win_ns, piece), _PIECE_SCHEMA)
    )
    # Pieces of 64-bit times: so many levels leave one per source.
    left = 2**63 // (win_ns * piece) + 1
    while left > 1:
        group = (*S.SOURCE, idiv("piece", fan))
        pieces = pieces.repartition(*group).sortWithinPartitions(*S.SOURCE, "piece").mapInPandas(_compose(threshold, win_ns, fan), _PIECE_SCHEMA)
        left = -(-left // fan)
    # A source starts without an open window, so its first packet opens one.
    blocked = pieces.select(*S.SOURCE, F.col("block_ts")[0].alias("block_ts"), F.col("block_id")[0].alias("block_id")).filter("block_ts >= 0")
    return blocked.withColumn("packet_count", F.lit(threshold).cast("long"))


def flood_blocklist_aligned(packets: DataFrame, threshold: int = THRESHOLD, window_s: float = 1.0) -> DataFrame:
    """Aligned variant: blocked at packet ``threshold + 1`` of the first bucket that has it."""
    win_ns = size_ns(window_s)
    slim = packets.select(*S.SOURCE, *S.ORDER, idiv("ts_ns", win_ns).alias("bucket"))
    first = (
        slim.groupBy(*S.SOURCE, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > threshold)
        .groupBy(*S.SOURCE)
        .agg(F.min("bucket").alias("bucket"))
    )
    rows = lookup_join(slim, first, [*S.SOURCE, "bucket"], spread=S.ORDER, how="inner")
    rank = F.row_number().over(Window.partitionBy(*S.SOURCE, "bucket").orderBy(*S.ORDER))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == threshold + 1).select(
        *S.SOURCE,
        F.col("ts_ns").alias("block_ts"),
        F.col("pkt_id").alias("block_id"),
        F.lit(threshold).cast("long").alias("packet_count"),
    )


def mark_dropped(packets: DataFrame, blocklist: DataFrame | tuple[DataFrame, bool]) -> DataFrame:
    """Add ``dropped``: 1 from the blocking packet of a source on."""
    slim = _columns(blocklist, *S.SOURCE, "block_ts", "block_id")
    out = lookup_join(packets, slim, S.SOURCE, spread=S.ORDER)
    at = F.struct(F.col("ts_ns").alias("t"), F.col("pkt_id").alias("i"))
    block = F.struct(F.col("block_ts").alias("t"), F.col("block_id").alias("i"))
    dropped = F.when(F.col("block_ts").isNotNull() & (at >= block), F.lit(1)).otherwise(F.lit(0))
    return out.withColumn("dropped", dropped).drop("block_ts", "block_id")


def flood_gate(packets: DataFrame, threshold: int = THRESHOLD, window_s: float = 1.0) -> DataFrame:
    """All packets with a ``dropped`` flag, by :func:`flood_blocklist`."""
    return mark_dropped(packets, flood_blocklist(packets, threshold, window_s))


def flood_gate_aligned(packets: DataFrame, threshold: int = THRESHOLD, window_s: float = 1.0) -> DataFrame:
    """All packets with a ``dropped`` flag, by :func:`flood_blocklist_aligned`."""
    return mark_dropped(packets, flood_blocklist_aligned(packets, threshold, window_s))


def passed(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("dropped") == 0).drop("dropped")


def _share(window, own: int, n, following):
    return F.struct(
        window.alias("window_id"), F.lit(own).alias("own"), n.alias("n"), following.alias("next")
    )


def syn_cumulative(packets: DataFrame, size_s: float = 5.0) -> DataFrame:
    """SYN packets per source so far, for each window in which the source sent anything.

    ``syn_in_window`` counts the window, ``syn_total`` everything up to its end and
    ``syn_at_close`` everything up to one window later, which is when the window's row is
    written.  Feed packets that passed the flood gate.
    """
    syn = (F.col("protocol") == S.TCP) & has_flag(S.SYN) & ~has_flag(S.ACK)
    per_window = (
        packets.select(*S.SOURCE, window_id(size_s=size_s).alias("window_id"), syn.cast("long").alias("syn"))
        .groupBy(*S.SOURCE, "window_id")
        .agg(F.sum("syn").alias("n"))
    )
    zero = F.lit(0).cast("long")
    # Each window also tells the one before it what followed.
    shifted = per_window.select(
        *S.SOURCE,
        F.inline(
            F.array(
                _share(F.col("window_id"), 1, F.col("n"), zero),
                _share(F.col("window_id") - 1, 0, zero, F.col("n")),
            )
        ),
    )
    merged = (
        shifted.groupBy(*S.SOURCE, "window_id")
        .agg(F.max("own").alias("own"), F.sum("n").alias("syn_in_window"), F.sum("next").alias("_next"))
        .filter(F.col("own") == 1)
        .withColumn("_block", idiv("window_id", FAN))
    )
    out = running_total(merged, S.SOURCE, "_block", ["window_id"], {"syn_total": F.col("syn_in_window")})
    return out.select(
        *S.SOURCE, "window_id", "syn_in_window", "syn_total", (F.col("syn_total") + F.col("_next")).alias("syn_at_close")
    )


def flag_blocked(
    flows: DataFrame, blocklist: DataFrame | tuple[DataFrame, bool], size_s: float = 5.0
) -> DataFrame:
    """Add ``is_blocked_flow``: the source was blocked by the time the window closed."""
    slim = _columns(blocklist, *S.SOURCE, "block_ts")
    out = lookup_join(flows, slim, S.SOURCE, spread=["dst_ip", "dst_port", "src_port", "window_id"])
    close = (F.col("window_id") + 2) * F.lit(size_ns(size_s)).cast("long")
    blocked = F.when(F.col("block_ts") < close, F.lit(1)).otherwise(F.lit(0))
    return out.withColumn("is_blocked_flow", blocked).drop("block_ts")


def _columns(table: DataFrame | tuple[DataFrame, bool], *names: str):
    """Select from a lookup, keeping the result of an earlier size check."""
    return (table[0].select(*names), table[1]) if isinstance(table, tuple) else table.select(*names)


def blocked_rows(
    blocklist: DataFrame | tuple[DataFrame, bool],
    syn: DataFrame | None = None,
    host: DataFrame | None = None,
    size_s: float = 5.0,
    label_scheme: str = "code",
    repeat_every: float | None = None,
    end_ns: int | None = None,
    epoch_s: int = 0,
) -> DataFrame:
    """One feature row per blocked source.

    Counts come from the packets counted when it was blocked, 5000 where that is unknown; the
    rest are fixed stand-ins for traffic that was not looked at.  ``label_scheme='docs'`` labels
    it as SYN flood (4) instead of 2.  ``repeat_every`` seconds repeats the row until ``end_ns``
    like periodic reports do.
    """
    table = blocklist[0] if isinstance(blocklist, tuple) else blocklist
    size = size_ns(size_s)
    out = table.withColumn("_n", F.coalesce("packet_count", F.lit(5000)).cast("long"))
    if repeat_every:
        if end_ns is None:
            raise ValueError("repeat_every needs end_ns")
        step = size_ns(repeat_every)
        report = F.explode(F.sequence(idiv("block_ts", step) + 1, F.lit(end_ns // step + 1).cast("long")))
        at = F.least(F.col("_report") * F.lit(step).cast("long"), F.lit(end_ns).cast("long"))
        out = out.withColumn("_report", report).withColumn("window_id", idiv(at, size)).drop("_report")
    else:
        out = out.withColumn("window_id", idiv("block_ts", size))
    out = out.withColumn("_syn", F.col("_n"))
    if syn is not None:
        totals = syn.groupBy(*S.SOURCE).agg(F.max("syn_total").alias("_total")).filter(F.col("_total") > 0)
        out = out.join(totals, S.SOURCE, "left").withColumn("_syn", F.coalesce("_total", "_n")).drop("_total")
    if host is not None:
        out = out.join(host, ["host", "window_id"], "left")
    n = F.col("_n")
    # What a blocked source's row states for traffic nobody measured.
    stated = {
        "timestamp": (F.col("window_id") + 1) * F.lit(size).cast("long") / 1e9 + F.lit(epoch_s),
        "flow_id": blocked_flow_id(),
        "dst_ip": F.lit("0.0.0.0"),
        "src_port": F.lit(0),
        "dst_port": F.lit(0),
        "protocol": F.lit(S.TCP),
        "packet_count": n,
        "byte_count": n * 60,
        "packets_per_second": n.cast("double"),
        "bytes_per_second": (n * 60).cast("double"),
        "avg_packet_size": F.lit(60.0),
        "is_blocked_flow": F.lit(1),
        "syn_count": F.col("_syn"),
        "syn_ack_count": F.lit(0).cast("long"),
        "syn_to_synack_ratio": F.lit(9999.0),
        "half_open_connections": n,
        "connection_state": F.lit("NEW"),
        "error_rate": F.lit(0.0),
        "anomaly_label": F.lit(4 if label_scheme == "docs" else 2),
        "anomaly_severity": F.lit(3),
        "remediation_action": F.lit(1),
    }
    return out.withColumns(stated).drop("_n", "_syn", "block_ts", "block_id")

