"""The whole feature row of a flow window on a stream, as three chained processors with state.

``Gate`` (one state per source) lets packets through in event order and ends floods, ``FlowWindows`` (one per
conversation) buffers both directions and closes their windows, ``SourceTotals`` (one per source) holds closed windows until
the source's SYN packets of the window after are known.  Event-time timers do all closing, so results do not depend on how
rows are dealt to micro-batches, as long as none comes behind the watermark.  A key has a timer for what is due first; the
call for it does all that the watermark has passed, so a batch costs a key a few calls however much time it spans.

What a key holds is bounded: the gate keeps at most twice the threshold of packets per rate window, a packet beyond that is
dropped for certain; a conversation keeps the packets of its open windows, which the gate bounds; a source keeps the
windows that wait and one count per open window.  Sources that are not blocked leave the gate's state when their rate window has
passed; with ``idle_s`` conversations leave after that time without packets, without it their last sequence numbers stay.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowloom import schema as S
from flowloom.functions.scalar import CONVERSATION, NS, endpoint_order, size_ns
from flowloom.operators import flood, flows, packets
from flowloom.operators.host import join_host
from flowloom.operators.l7 import add_entries
from flowloom.operators.report import SHOWN
from flowloom.plans.pipeline import Settings, labelled, union_features
from flowloom.streaming.flows import started
from flowloom.streaming.keyed import END, SHIFT_MS, arrow_schema, as_pandas, done_by, due_ms, pack, stamp, state_store, timed, unpack, unpack_table

#: Packets that a gated conversation needs, in both directions.
_MEASURES = [
    "dir", "pkt_id", "ts_ns", "packet_size", "ip_ttl", "tcp_flags", "tcp_seq", "tcp_window", "payload_size", "error_flags", "l7_protocol", "dns_flags",
]
_SLIM = [*S.FLOW, *_MEASURES[1:]]
#: Values for what a packet leaves out; none of them is one that a packet can have and that counts.
_ABSENT = {"packet_size": -1, "ip_ttl": 0, "tcp_flags": 0, "tcp_seq": -1, "tcp_window": -1, "payload_size": -1, "dns_flags": 0}

#: Raw numbers of a closed flow window, as :func:`flowloom.operators.flows.features_of` takes them.
_STATS = S._struct(
    "n_all bigint, packet_count bigint, byte_count bigint, start_ns bigint, end_ns bigint, n_gaps bigint, gap_mean double, gap_std double, "
    "gap_p50 bigint, gap_p95 bigint, gap_p99 bigint, run bigint, tcp_count bigint, retransmission_count bigint, out_of_order_count bigint, "
    "rst_count bigint, fin_count bigint, psh_count bigint, syn_ack_count bigint, half_open_connections bigint, zero_window_count bigint, "
    "tcp_window_min int, tcp_window_avg double, tcp_window_drops bigint, zero_ns bigint, zero_open_ns bigint, last_window int, "
    "last_tcp_ns bigint, last_state int, first_gap bigint, ttl_min int, ttl_avg double, ttl_stddev double, payload_sizes bigint, "
    "payload_max bigint, error_count bigint, dns_queries bigint, dns_responses bigint, dns_errors bigint, l7_1 bigint, l7_2 bigint, l7_3 bigint"
).fields
_CLOSED = T.StructType(
    [
        *S._struct("host string, src_ip string, src_port int, dst_ip string, dst_port int, protocol int, window_id bigint, block_ts bigint, block_id bigint, syn_seen bigint").fields,
        *_STATS, *S._struct("dns_query_latency_ms double, dns_query_latency_p95 double").fields,
    ]
)
_WITH_TIME = T.StructType([*_CLOSED.fields, T.StructField("at", T.TimestampType())])
_OUT = T.StructType([*_CLOSED.fields, *S._struct("_syn bigint, is_blocked_flow int").fields, T.StructField("at", T.TimestampType())])
_STATUS = S._struct(
    "host string, elapsed_s double, feature_rows bigint, blocked_sources bigint, cpu_usage_percent double, memory_usage_percent double, blocked_ips string"
)


def _frame(rows: list[dict], schema: T.StructType):
    """Rows as pandas with the types of ``schema``; what a row leaves out is null."""
    import pandas as pd

    kinds = {T.LongType: "Int64", T.IntegerType: "Int32", T.DoubleType: "Float64", T.StringType: "object", T.TimestampType: "datetime64[ns]"}
    return pd.DataFrame({f.name: pd.Series([r.get(f.name) for r in rows], dtype=kinds[type(f.dataType)]) for f in schema.fields})


#: Rate windows that the gate's state holds as one value.
SPAN = 64
#: Rows that a processor gives out at once.
MOST_ROWS = 5000
#: Packets of a batch that the gate gathers before it puts them to those that wait.
MOST_HELD = 100_000


class Gate(StatefulProcessor):
    """Packets of a source with ``dropped``, and ``first`` for the one that got it blocked, in event order.

    Packets wait for the end of their bucket, a stretch of one rate window's length; only the first ``2 * threshold`` of a
    bucket do, because two rate windows share it at most, so the one of that number blocks at the latest.
    """

    def __init__(self, schema: T.StructType, threshold: int, win_ns: int) -> None:
        self.schema, self.threshold, self.win = arrow_schema(schema), threshold, win_ns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rate = handle.getValueState("rate", "reset bigint, n bigint, block_ts bigint, block_id bigint")
        self.waiting = handle.getMapState("waiting", "span bigint", "packets binary")

    def _marked(self, pdf, dropped, first=0, at=None):
        import pandas as pd

        ends = (pdf["ts_ns"].to_numpy(np.int64) // self.win + 1) * self.win
        shifted = pd.to_datetime(-(-ends // 1_000_000) + SHIFT_MS, unit="ms") if at is None else stamp(at)
        return pdf.assign(dropped=dropped, first=first, at=shifted)

    def _ordered(self, batches: list[pa.RecordBatch]) -> pa.Table:
        rows = pa.Table.from_batches(batches, self.schema).combine_chunks()
        ts, number = (rows[c].to_numpy() for c in S.ORDER)
        return rows.take(pa.array(np.lexsort((number, ts)))) if len(rows) > 1 else rows

    def _kept(self, batches: list[pa.RecordBatch]) -> Iterator:
        """Put packets to those that wait, a span at a time; yields those beyond what a bucket may hold."""
        rows = self._ordered(batches)
        spans = rows["ts_ns"].to_numpy() // (self.win * SPAN)
        distinct, begins = np.unique(spans, return_index=True)
        for span, begin, end in zip(distinct.tolist(), begins.tolist(), [*begins[1:].tolist(), len(rows)], strict=True):
            part, before = rows.slice(begin, end - begin), self.waiting.getValue((span,))
            if before:
                part = self._ordered([*unpack_table([before[0]], self.schema).to_batches(), *part.to_batches()])
            buckets = part["ts_ns"].to_numpy() // self.win
            over = np.arange(len(buckets)) - np.searchsorted(buckets, buckets) >= 2 * self.threshold
            if over.any():
                yield self._marked(as_pandas(part.filter(pa.array(over))), 1)
                part = part.filter(pa.array(~over))
            self.waiting.updateValue((span,), (pack(part, self.schema),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        held = self.rate.get() if self.rate.exists() else None
        blocked = held is not None and held[2] is not None
        soonest, batches = None, []
        for pdf in rows:
            pdf = pdf.loc[(pdf["pkt_id"] != END) & pdf["ts_ns"].notna(), self.schema.names]
            if not len(pdf):
                continue
            if blocked:
                yield self._marked(pdf, 1)
                continue
            bucket = int(pdf["ts_ns"].min()) // self.win
            soonest = bucket if soonest is None else min(soonest, bucket)
            batches.append(pa.RecordBatch.from_pandas(pdf, schema=self.schema, preserve_index=False))
            if sum(map(len, batches)) >= MOST_HELD:
                yield from self._kept(batches)
                batches = []
        if batches:
            yield from self._kept(batches)
        if soonest is not None:
            self.handle.registerTimer(due_ms((soonest + 1) * self.win))

    def _judged(self, parts: list[pa.Table], rate: tuple, at: int) -> tuple:
        """The rate after packets in order, and the packets with what becomes of them."""
        reset, n, block_ts, block_id = rate
        pdf = as_pandas(pa.concat_tables(parts))
        ts = pdf["ts_ns"].to_numpy(np.int64)
        place, drop_from, first = 0, len(ts) if block_ts is None else 0, -1
        while block_ts is None and place < len(ts):
            if reset is None or ts[place] - reset > self.win:
                reset, n = int(ts[place]), 0
            end = int(np.searchsorted(ts, reset + self.win, side="right"))
            if n + end - place > self.threshold:
                first = drop_from = place + self.threshold - n
                n, block_ts, block_id = self.threshold, int(ts[first]), int(pdf["pkt_id"].iloc[first])
                break
            n, place = n + end - place, end
        places = np.arange(len(ts))
        out = self._marked(pdf, (places >= drop_from).astype("int32"), (places == first).astype("int32"), at)
        return (reset, n, block_ts, block_id), out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = done_by(timerValues, expiredTimerInfo)
        rate = self.rate.get() if self.rate.exists() else (None, 0, None, None)
        # Buckets before this one are over.
        known = (now - SHIFT_MS) * 1_000_000 // self.win
        parts = []
        for span in sorted(k for (k,) in self.waiting.keys()):
            rows = unpack_table([self.waiting.getValue((span,))[0]], self.schema)
            ts = rows["ts_ns"].to_numpy()
            cut = int(np.searchsorted(ts, known * self.win))
            if cut:
                parts.append(rows.slice(0, cut))
            if cut < len(ts):
                if cut:
                    self.waiting.updateValue((span,), (pack(rows.slice(cut), self.schema),))
                self.handle.registerTimer(due_ms((int(ts[cut]) // self.win + 1) * self.win))
                break
            self.waiting.removeKey((span,))
            if sum(map(len, parts)) >= MOST_ROWS:
                rate, out = self._judged(parts, rate, now + 1)
                yield out
                parts = []
        if parts:
            rate, out = self._judged(parts, rate, now + 1)
            yield out
        reset, n, block_ts, block_id = rate
        # When the bucket in which the rate window ends is judged, a packet still to come opens a new one whatever is known.
        over = None if reset is None else due_ms((reset // self.win + 2) * self.win)
        if block_ts is None and over is not None and over <= now:
            self.rate.clear()
        elif reset is not None:
            self.rate.update((reset, n, block_ts, block_id))
            if block_ts is None:
                self.handle.registerTimer(over)

    def close(self) -> None:
        pass


def stream_gate(source: DataFrame, threshold: int = flood.THRESHOLD, window_s: float = 1.0, late_s: float = 5.0) -> DataFrame:
    """Packets of a stream with ``dropped`` as :func:`flowloom.operators.flood.flood_gate` marks them, ``first`` and ``at``.

    A packet comes out when the watermark, ``late_s`` behind the newest packet, has passed its rate window.
    """
    schema = T.StructType([f for f in source.schema.fields])
    out = T.StructType([*schema.fields, T.StructField("dropped", T.IntegerType()), T.StructField("first", T.IntegerType()), T.StructField("at", T.TimestampType())])
    return timed(source, late_s).groupBy(*S.SOURCE).transformWithStateInPandas(
        statefulProcessor=Gate(schema, threshold, size_ns(window_s)), outputStructType=out, outputMode="append", timeMode="EventTime", eventTimeColumnName="at",
    )


def _quantile(ordered: np.ndarray, q: float) -> int | None:
    return int(ordered[min(int(len(ordered) * q), len(ordered) - 1)]) if len(ordered) else None


def longest_run(times: np.ndarray) -> int:
    """Most events in a row with less than a second between neighbours."""
    if not len(times):
        return 0
    breaks = np.flatnonzero(np.diff(times) >= NS)
    return int(np.diff(np.concatenate([[-1], breaks, [len(times) - 1]])).max())


def window_numbers(p: dict[str, np.ndarray], tcp: bool, udp: bool, src_port: int, dst_port: int, last_seq: int | None, rcode_mask: int) -> tuple[dict, int | None]:
    """Raw numbers of one direction's packets of one window, in order, and the last sequence number after it."""
    ts, size, flags, seq, w = p["ts_ns"], p["packet_size"], p["tcp_flags"], p["tcp_seq"], p["tcp_window"]
    valid = (size > 0) & (size < 65_536)
    errors = p["error_flags"].copy()
    n = len(ts)
    late = ahead = np.zeros(n, dtype=bool)
    state = np.zeros(n, dtype=np.int64)
    syn, ack = flags & S.SYN != 0, flags & S.ACK != 0
    if tcp:
        known = np.concatenate([[-1 if last_seq is None else last_seq], seq])
        # The newest sequence number so far; packets without one are passed over.
        place = np.maximum.accumulate(np.where(known >= 0, np.arange(n + 1), 0))
        prev = known[place[:-1]]
        seen = prev >= 0
        late = seen & (seq < prev) & ~syn & (seq >= 0)
        ahead = seen & ~late & (seq > (prev + 1500) % packets.UINT32)
        errors += np.where(ahead, S.ERR_OUT_OF_ORDER, 0) + np.where(late, S.ERR_RETRANSMISSION, 0)
        state = np.select([syn, ~seen, flags & (S.FIN | S.RST) != 0, ack], [1, 2, 3, 2], 0)
        last_seq = int(known[place[-1]]) if known[place[-1]] >= 0 else None
    v = np.flatnonzero(valid)
    gaps, vw = np.diff(ts[v]), w[v]
    ranked = np.sort(gaps)
    ttl = p["ip_ttl"][p["ip_ttl"] > 0]
    payload = p["payload_size"][p["payload_size"] >= 0]
    out = {
        "n_all": n, "packet_count": len(v), "byte_count": int(size[v].sum()), "start_ns": int(ts[0]), "end_ns": int(ts[-1]), "n_gaps": len(gaps),
        "gap_mean": float(gaps.mean()) if len(gaps) else None, "gap_std": float(gaps.std(ddof=1)) if len(gaps) > 1 else None,
        **{f"gap_{name}": _quantile(ranked, q) for name, q in flows.QUANTILES.items()},
        "ttl_min": int(ttl.min()) if len(ttl) else None, "ttl_avg": float(ttl.mean()) if len(ttl) else None, "ttl_stddev": float(ttl.std()) if len(ttl) else None,
        "payload_sizes": len(np.unique(payload)), "payload_max": int(payload.max()) if len(payload) else None,
        "error_count": int((errors != 0).sum()), "dns_queries": n if udp and dst_port == 53 else 0, "dns_responses": n if udp and src_port == 53 else 0,
        "dns_errors": int(((p["l7_protocol"] == S.L7_DNS) & (p["dns_flags"] & rcode_mask != 0)).sum()),
        **{f"l7_{i}": int((p["l7_protocol"] == i).sum()) for i in (S.L7_HTTP, S.L7_HTTPS, S.L7_DNS)},
        "syn_seen": int((syn & ~ack).sum()) if tcp else 0,
    }
    zero = dict.fromkeys(["run", "tcp_count", "retransmission_count", "out_of_order_count", "rst_count", "fin_count", "psh_count", "syn_ack_count", "half_open_connections", "zero_window_count", "tcp_window_drops"], 0)
    if not tcp or not len(v):
        return out | zero, last_seq
    has = lambda mask: int((flags[v] & mask != 0).sum())
    open_w = vw[vw > 0]
    shut = vw == 0
    begins = shut & np.concatenate([[True], vw[:-1] != 0])
    return out | {
        "run": longest_run(ts[v][late[v]]), "tcp_count": len(v), "retransmission_count": int(late[v].sum()), "out_of_order_count": int(ahead[v].sum()),
        "rst_count": has(S.RST), "fin_count": has(S.FIN), "psh_count": has(S.PSH), "syn_ack_count": int((syn & ack)[v].sum()),
        "half_open_connections": int((syn & ~ack)[v].sum()), "zero_window_count": int(shut.sum()),
        "tcp_window_min": int(open_w.min()) if len(open_w) else None, "tcp_window_avg": float(open_w.mean()) if len(open_w) else None,
        "tcp_window_drops": int((vw[1:] < vw[:-1] * 0.5).sum()), "zero_ns": int(gaps[shut[:-1]].sum()) if shut[:-1].any() else None,
        "zero_open_ns": int(ts[v][begins].max()) if begins.any() else None, "last_window": int(vw[-1]), "last_tcp_ns": int(ts[v][-1]),
        "last_state": int(state[v][-1]), "first_gap": int(gaps[0]) if len(gaps) else None,
    }, last_seq


def closes(window: int, size: int, answer: int, rate: int) -> int:
    """When a window closes: one window after its end, not before all answers to it could come, in whole rate windows of the gate."""
    return due_ms(-(-max((window + 2) * size, (window + 1) * size + answer) // rate) * rate)


def dns_waits(asked: np.ndarray, answered: np.ndarray, most_ns: int) -> dict:
    """Mean and 95th percentile of the times from queries to the first strictly later response, in ms."""
    at = np.searchsorted(answered, asked, side="right")
    found = at < len(answered)
    waits = answered[at[found]] - asked[found]
    waits = np.sort(waits[waits < most_ns])
    mean, p95 = (float(waits.mean()), _quantile(waits, 0.95)) if len(waits) else (0.0, 0)
    return {"dns_query_latency_ms": mean / 1e6, "dns_query_latency_p95": p95 / 1e6}


class FlowWindows(StatefulProcessor):
    """Closed windows of both directions of a conversation; rows of blocking packets pass at once."""

    def __init__(self, schema: T.StructType, size_s: float, answer_s: float, rate_s: float, rcode_mask: int, idle_s: float | None) -> None:
        self.schema = arrow_schema(T.StructType([schema[c] for c in _MEASURES]))
        self.size, self.answer, self.rate, self.rcode_mask = size_ns(size_s), size_ns(answer_s), size_ns(rate_s), rcode_mask
        self.idle = size_ns(idle_s) if idle_s else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "packets binary")
        self.last = handle.getValueState("last", "seq0 bigint, seq1 bigint, newest_ns bigint")

    def due(self, window: int) -> int:
        return closes(window, self.size, self.answer, self.rate)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        newest = soonest = None
        for pdf in rows:
            first = pdf[pdf["first"] == 1]
            if len(first):
                yield _frame(
                    [{"host": key[0], "src_ip": r.src_ip, "block_ts": r.ts_ns, "block_id": r.pkt_id, "at": r.at} for r in first.itertuples()], _WITH_TIME
                )
            pdf = pdf[pdf["dropped"] == 0]
            if len(pdf):
                self.waiting.appendValue((pack(pdf[_MEASURES], self.schema),))
                low, high = int(pdf["ts_ns"].min()), int(pdf["ts_ns"].max())
                soonest, newest = (low, high) if newest is None else (min(soonest, low), max(newest, high))
        if newest is not None:
            self.handle.registerTimer(self.due(soonest // self.size))
        if newest is not None and self.idle:
            seqs = self.last.get() if self.last.exists() else (None, None, None)
            newest = max(newest, seqs[2] or newest)
            self.last.update((*seqs[:2], newest))
            self.handle.registerTimer(due_ms(newest + self.idle))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = done_by(timerValues, expiredTimerInfo)
        held = unpack([b for (b,) in self.waiting.get()], self.schema).sort_values(S.ORDER, kind="stable")
        columns = {c: held[c].to_numpy(np.int64) for c in _MEASURES}
        windows = columns["ts_ns"] // self.size
        seqs = list(self.last.get()) if self.last.exists() else [None, None, None]
        distinct, begins = np.unique(windows, return_index=True)
        ready = bisect_right(distinct.tolist(), now, key=self.due)
        ends = [*begins[1:].tolist(), len(held)]
        tcp, udp, out = key[5] == S.TCP, key[5] == S.UDP, []
        for window, begin, end in zip(distinct[:ready].tolist(), begins.tolist(), ends, strict=False):
            part = {c: v[begin:end] for c, v in columns.items()}
            for d in (0, 1):
                mine = part["dir"] == d
                if not mine.any():
                    continue
                (ip_s, port_s), (ip_d, port_d) = (key[1:3], key[3:5]) if d == 0 else (key[3:5], key[1:3])
                arrays = {c: v[mine] for c, v in part.items()}
                numbers, seqs[d] = window_numbers(arrays, tcp, udp, port_s, port_d, seqs[d], self.rcode_mask)
                if numbers["dns_queries"]:
                    near = slice(begin, int(np.searchsorted(windows, window + 1 + self.answer // self.size, side="right")))
                    answers = columns["ts_ns"][near][columns["dir"][near] != d] if port_d == 53 else np.zeros(0, dtype=np.int64)
                    numbers |= dns_waits(arrays["ts_ns"], answers, self.answer)
                out.append({"host": key[0], "src_ip": ip_s, "src_port": port_s, "dst_ip": ip_d, "dst_port": port_d, "protocol": key[5], "window_id": window, "at": stamp(now + 1), **numbers})
            if len(out) >= MOST_ROWS:
                yield _frame(out, _WITH_TIME)
                out = []
        if ready:
            left = held.iloc[ends[ready - 1] :]
            # Without packets left, nothing is held but what later packets are compared with.
            self.waiting.put([(pack(left, self.schema),)]) if len(left) else self.waiting.clear()
            self.last.update(tuple(seqs))
        if ready < len(distinct):
            self.handle.registerTimer(self.due(int(distinct[ready])))
        if self.idle and seqs[2] is not None and due_ms(seqs[2] + self.idle) <= now:
            self.last.clear()
        if out:
            yield _frame(out, _WITH_TIME)

    def close(self) -> None:
        pass


class SourceTotals(StatefulProcessor):
    """Closed windows with the source's SYN packets up to one window later, and whether it was blocked by then."""

    def __init__(self, size_s: float, answer_s: float, rate_s: float) -> None:
        self.size, self.answer, self.rate = size_ns(size_s), size_ns(answer_s), size_ns(rate_s)
        self.schema = arrow_schema(T.StructType([f for f in _CLOSED.fields if f.name not in S.SOURCE]))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.before = handle.getValueState("before", "n bigint")
        self.block = handle.getValueState("block", "block_ts bigint, block_id bigint, told boolean")

    def due(self, window: int) -> int:
        """When all windows up to the next one are closed; all packets up to the window's own close are judged then."""
        return closes(window + 1, self.size, max(self.answer, self.rate), self.rate)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        soonest = None
        for pdf in rows:
            for r in pdf[pdf["window_id"].isna()].itertuples():
                self.block.update((int(r.block_ts), int(r.block_id), False))
                self.handle.registerTimer(self.due(int(r.block_ts) // self.size))
            closed = pdf[pdf["window_id"].notna()]
            if len(closed):
                self.waiting.appendValue((pack(closed[self.schema.names], self.schema),))
                window = int(closed["window_id"].min())
                soonest = window if soonest is None else min(soonest, window)
        if soonest is not None:
            self.handle.registerTimer(self.due(soonest))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = done_by(timerValues, expiredTimerInfo)
        before = self.before.get()[0] if self.before.exists() else 0
        block_ts, block_id, told = self.block.get() if self.block.exists() else (None, None, True)
        held = unpack([b for (b,) in self.waiting.get()], self.schema)
        distinct, where = np.unique(held["window_id"].to_numpy(np.int64), return_inverse=True)
        ready = bisect_right(distinct.tolist(), now, key=self.due)
        counts = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(counts, where, held["syn_seen"].to_numpy(np.int64))
        if ready:
            so_far = before + np.cumsum(counts)
            totals = so_far[np.searchsorted(distinct, distinct[:ready] + 1, side="right") - 1]
            shown = (where < ready) & (held["packet_count"].to_numpy(np.int64) > 0)
            blocked = np.zeros(ready, dtype=np.int32) if block_ts is None else (block_ts < (distinct[:ready] + 2) * self.size).astype(np.int32)
            if shown.any():
                yield self._named(key, held[shown], totals[where[shown]], blocked[where[shown]], now + 1)
        if not told and self.due(block_ts // self.size) <= now:
            rows = _frame([{"block_ts": block_ts, "block_id": block_id}], _CLOSED).drop(columns=S.SOURCE)
            yield self._named(key, rows, np.array([before + counts.sum()]), np.ones(1, dtype=np.int32), now + 1)
            self.block.update((block_ts, block_id, True))
        if ready:
            # Counts that no waiting window asks for one by one become one number.
            self.before.update((int(before + counts[:ready].sum()),))
            left = held[where >= ready]
            self.waiting.put([(pack(left, self.schema),)]) if len(left) else self.waiting.clear()
        if ready < len(distinct):
            self.handle.registerTimer(self.due(int(distinct[ready])))

    def _named(self, key, pdf, total: np.ndarray, blocked: np.ndarray, at: int):
        import pandas as pd

        extra = {"host": key[0], "src_ip": key[1], "at": stamp(at), "_syn": pd.arrays.IntegerArray(total.astype(np.int64), total == 0), "is_blocked_flow": pd.array(blocked, dtype="Int32")}
        return pdf.assign(**extra)[_OUT.names]

    def close(self) -> None:
        pass


def let_through(source: DataFrame, settings: Settings = Settings(), late_s: float | None = None) -> DataFrame:
    """Annotated packets of a stream, with what the windows need of them, that the gate lets pass, and those that got a source blocked."""
    s = settings
    seen = packets.annotate_packets(packets.time_range(source, s.start_ns, s.duration_s))
    slim = seen.select(*[F.coalesce(c, F.lit(_ABSENT[c])).alias(c) if c in _ABSENT else F.col(c) for c in _SLIM])
    return packets.gate_protocols(stream_gate(slim, s.threshold, s.rate_window_s, late_s or s.size_s)).filter("dropped = 0 OR first = 1")


class StatusReport(StatefulProcessor):
    """One row per host and reporting interval, when all its windows are closed: counts so far and the interval's highest load.

    State per host: a count and two maxima per open interval, the totals, and the first few blocked addresses.
    """

    def __init__(self, interval_s: float, due) -> None:
        self.step, self.interval_s, self.due = size_ns(interval_s), float(interval_s), due

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "interval bigint", "n bigint, blocked bigint, cpu double, memory double")
        self.total = handle.getValueState("total", "n bigint, blocked bigint")
        self.first = handle.getListState("first", "block_ts bigint, src_ip string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        found, blocks = {}, []
        for pdf in rows:
            for interval, part in pdf.groupby((pdf["until"] - 1) // self.step + 1):
                n, blocked, cpu, memory = found.get(int(interval), (0, 0, 0.0, 0.0))
                told = part["block_ts"].notna()
                shown = part[~told]
                cpu, memory = (max([x, *shown[c]]) for x, c in ((cpu, "cpu_usage_percent"), (memory, "memory_usage_percent")))
                found[int(interval)] = (n + len(shown), blocked + int(told.sum()), float(cpu), float(memory))
            blocks += [(int(r.block_ts), r.src_ip) for r in pdf[pdf["block_ts"].notna()].itertuples()]
        for interval, (n, blocked, cpu, memory) in found.items():
            before = self.open.getValue((interval,)) or (0, 0, 0.0, 0.0)
            self.open.updateValue((interval,), (before[0] + n, before[1] + blocked, max(before[2], cpu), max(before[3], memory)))
        if found:
            self.handle.registerTimer(self.due(min(found) * self.step))
        if blocks:
            self.first.put(sorted([*((int(t), ip) for t, ip in self.first.get()), *blocks])[:SHOWN])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = done_by(timerValues, expiredTimerInfo)
        rows, blocked = self.total.get() if self.total.exists() else (0, 0)
        first, out = [(int(t), ip) for t, ip in self.first.get()], []
        for (interval,), (n, more, cpu, memory) in sorted(self.open.iterator()):
            if self.due(interval * self.step) > now:
                self.handle.registerTimer(self.due(interval * self.step))
                break
            rows, blocked = rows + n, blocked + more
            told = ", ".join(ip for t, ip in first if t // self.step + 1 <= interval)
            out.append(dict(zip(_STATUS.names, (key[0], interval * self.interval_s, rows, blocked, cpu, memory, told), strict=True)))
            self.open.removeKey((interval,))
        if out:
            self.total.update((rows, blocked))
            yield _frame(out, _STATUS)

    def close(self) -> None:
        pass


def stream_status(closed: DataFrame, settings: Settings = Settings(), hosts: DataFrame | None = None, interval_s: float = 30, answer_s: float = 5.0) -> DataFrame:
    """The rows of :func:`flowloom.operators.report.periodic_status` from a stream of closed windows, one interval at a time.

    ``hosts`` are host metrics per window; without them load is 0.
    """
    size, rate, answer = size_ns(settings.size_s), size_ns(settings.rate_window_s), size_ns(answer_s)
    load = ["cpu_usage_percent", "memory_usage_percent"]
    end = (F.col("window_id") + 1) * F.lit(size).cast("long")
    slim = closed.select("host", "window_id", "src_ip", "block_ts", F.coalesce(end, F.col("block_ts") + 1).alias("until"), "at")
    if hosts is not None:
        slim = slim.join(hosts.select("host", "window_id", *load), ["host", "window_id"], "left")
    slim = slim.withColumns({c: F.coalesce(c, F.lit(0.0)) if hosts is not None else F.lit(0.0) for c in load})

    def due(ns: int) -> int:
        return closes(ns // size + 1, size, max(answer, rate), rate)

    return slim.groupBy("host").transformWithStateInPandas(
        statefulProcessor=StatusReport(interval_s, due), outputStructType=_STATUS, outputMode="append", timeMode="EventTime"
    )


def closed_windows(source: DataFrame, settings: Settings = Settings(), late_s: float | None = None, idle_s: float | None = None, answer_s: float = 5.0) -> DataFrame:
    """Raw numbers of every flow window of a packet stream, and a row with ``block_ts`` per blocked source.

    A window comes out once the watermark, ``late_s`` (one window) behind the newest packet, is two windows past its end;
    its SYN totals, blocking and answers are those of one window after its end, as in a batch.
    """
    s = settings
    both = let_through(source, s, late_s).withColumns(endpoint_order())
    windows = FlowWindows(both.schema, s.size_s, answer_s, s.rate_window_s, s.rcode_mask, idle_s)
    options = {"outputMode": "append", "timeMode": "EventTime"}
    closed = both.groupBy(*CONVERSATION).transformWithStateInPandas(statefulProcessor=windows, outputStructType=_WITH_TIME, eventTimeColumnName="at", **options)
    totals = SourceTotals(s.size_s, answer_s, s.rate_window_s)
    return closed.groupBy(*S.SOURCE).transformWithStateInPandas(statefulProcessor=totals, outputStructType=_OUT, eventTimeColumnName="at", **options)


def feature_rows(
    closed: DataFrame, settings: Settings = Settings(), hosts: DataFrame | None = None, matched: DataFrame | None = None
) -> DataFrame:
    """The 94 columns, then ``host`` and ``window_id``, of closed windows: those a stream wrote, or one micro-batch of them.

    ``hosts`` are host metrics per window, ``matched`` application entries per window (:func:`flowloom.streaming.l7.window_matches`).
    """
    s = settings
    kept = ["_syn", "is_blocked_flow", "dns_query_latency_ms", "dns_query_latency_p95"]
    base = flows.features_of(closed.filter(F.col("window_id").isNotNull()), s.size_s, s.rate_base, kept)
    rows = packets.filter_ip(flows.with_syn(base, None).drop("_handshake"), s.filter_ip)
    if matched is not None:
        rows = add_entries(rows, matched)
    if hosts is not None:
        rows = join_host(rows, hosts)
    end_s = (F.col("window_id") + 1) * F.lit(size_ns(s.size_s)).cast("long") / 1e9 + F.lit(s.epoch_s)
    rows = labelled(rows.withColumn("timestamp", end_s.cast("long")), s.label)
    blocks = closed.filter(F.col("window_id").isNull())
    listed = blocks.select(*S.SOURCE, "block_ts", "block_id", F.lit(s.threshold).cast("long").alias("packet_count"))
    blocked = flood.blocked_rows(listed, blocks.select(*S.SOURCE, F.col("_syn").alias("syn_total")), hosts, s.size_s, s.label_scheme, epoch_s=s.epoch_s)
    return union_features(rows, blocked)


def features_sink(path: str, settings: Settings = Settings(), hosts: DataFrame | None = None):
    """A ``foreachBatch`` function that writes the feature rows of each micro-batch; a replayed one overwrites its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        feature_rows(batch, settings, hosts).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


@contextmanager
def closing(stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> Iterator[Callable[[], DataFrame]]:
    """:func:`flowloom.streaming.flows.started` with the state store the processors need."""
    with ExitStack() as open_while:
        with state_store(stream.sparkSession):
            written = open_while.enter_context(started(stream, path, checkpoint))
        yield written


def run_closed(stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything available with the state store the processors need; the written table."""
    with closing(stream, path, checkpoint) as written:
        return written()
