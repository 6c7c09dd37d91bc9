"""The application-flow cache on a stream: what each packet and each flow window is told by the entries of its flow.

One state per conversation serves both directions.  It holds the newest entry of either direction, the rows that still wait
for the watermark, and one answer per open flow window.  Entries are forgotten ``ttl_s`` after their time, windows when
their late look has been taken, all by event-time timers, so a quiet conversation leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowloom import schema as S
from flowloom.functions.scalar import CONVERSATION, endpoint_order, size_ns
from flowloom.operators.l7 import META, PAYLOAD, TTL_S
from flowloom.streaming.keyed import END, SHIFT_MS, arrow_schema, as_pandas, done_by, due_ms, pack, timed, unpack_table

ENTRY, PACKET, LATE = 0, 1, 2
#: Rows given out at once.
MOST_ROWS = 20_000
#: Columns that place a row in the line of time; the others are what an entry says.
_PLACE = ("dir", "ts_ns", "id", "kind")


class EntryCache(StatefulProcessor):
    """Rows in event order: entries replace the newest one of their direction, packets and late looks read it.

    All rows that are due are answered at once by their places in one line of time; what an entry says is taken along, not read.
    """

    def __init__(self, rows: T.StructType, out: T.StructType, size_s: float, ttl_s: float, step_s: float, kinds: Sequence[int] = (PACKET, LATE)) -> None:
        self.rows = T.StructType([f for f in rows.fields if f.name not in (*CONVERSATION, "at")])
        self.fields = [f for f in self.rows.fields if f.name not in _PLACE]
        self.names = [f.name for f in self.fields]
        self.schema, self.out, self.kinds = arrow_schema(self.rows), out, tuple(kinds)
        self.size, self.ttl, self.step = size_ns(size_s), size_ns(ttl_s), size_ns(step_s)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        entry = T.StructType([T.StructField("ts_ns", T.LongType()), *self.fields])
        self.newest = [handle.getValueState(f"newest{d}", entry) for d in (0, 1)]
        self.waiting = handle.getListState("waiting", "rows binary")
        hit = T.StructType([T.StructField("found", T.BooleanType()), *self.fields])
        self.windows = handle.getMapState("windows", "window_id bigint, dir int", hit)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        soonest = None
        for pdf in rows:
            pdf = pdf[(pdf["id"] != END) & pdf["ts_ns"].notna()]
            if not len(pdf):
                continue
            self.waiting.appendValue((pack(pdf[self.schema.names], self.schema),))
            oldest = int(pdf["ts_ns"].min())
            soonest = oldest if soonest is None else min(soonest, oldest)
        if soonest is not None:
            self.handle.registerTimer(self.after(soonest))
        return iter(())

    def after(self, ns: int) -> int:
        """The watermark at which the whole step that holds this time has come."""
        return due_ms((ns // self.step + 1) * self.step)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        # All rows before this time have come; a gate before gives them out in whole steps.
        known_to = (done_by(timerValues, expiredTimerInfo) - SHIFT_MS) * 1_000_000 // self.step * self.step
        ready = unpack_table([b for (b,) in self.waiting.get()], self.schema)
        due = ready["ts_ns"].to_numpy() < known_to
        left = ready.filter(pa.array(~due))
        if len(left):
            ready = ready.filter(pa.array(due)).combine_chunks()
        if len(ready):
            self.waiting.put([(pack(b, self.schema),) for b in left.to_batches(MOST_ROWS)]) if len(left) else self.waiting.clear()
        ts, kind, number, d = (ready[c].to_numpy().astype(np.int64) for c in ("ts_ns", "kind", "id", "dir"))
        # A window and direction as one number; those with a packet or an answer so far are open until their late look.
        window = (ts // self.size) * 2 + d
        stored = {int(w) * 2 + int(x): tuple(v) for (w, x), v in self.windows.iterator()}
        opened = np.union1d(window[kind == PACKET], np.array([*stored], dtype=np.int64))
        looks = opened[(opened // 2 + 2) * self.size < known_to]
        held = [s.get() if s.exists() else None for s in self.newest]
        # What entries say, of rows first, then of the newest ones known before, then of the answers known before.
        known = [*[h and h[1:] for h in held], *[v[1:] for v in stored.values()]]
        says = ready.select(self.names)
        before = pa.table({f.name: pa.array([k[i] if k else None for k in known], says.schema.field(f.name).type) for i, f in enumerate(self.fields)})
        says = pa.concat_tables([says, before.cast(says.schema)]).combine_chunks()
        n = len(ready)
        ts, kind, number = np.append(ts, (looks // 2 + 2) * self.size), np.append(kind, np.full(len(looks), LATE)), np.append(number, np.zeros(len(looks), np.int64))
        d, window = np.append(d, looks % 2), np.append(window, looks)
        order = np.lexsort((d, number, kind, ts))
        ts, kind, number, d, window = (v[order] for v in (ts, kind, number, d, window))
        seen, last = [], []
        for x in (0, 1):
            place = np.maximum.accumulate(np.where((kind == ENTRY) & (d == x), np.arange(len(ts)), -1))
            entry, since = np.where(place >= 0, order[place], n + x if held[x] else -1), np.where(place >= 0, ts[place], held[x][0] if held[x] else 0)
            seen.append(np.where((entry >= 0) & (ts - since < self.ttl), entry, -1))
            last.append((int(since[-1]), int(entry[-1])) if len(ts) and entry[-1] >= 0 else (held[x][0], n + x) if held[x] else None)
        own, other = np.where(d == 0, seen[0], seen[1]), np.where(d == 0, seen[1], seen[0])
        told = np.where(own >= 0, own, other)
        # The first packet of a window that is told something decides, one of an earlier call before all.
        answers = np.full(len(opened), -1)
        hits = np.flatnonzero((kind == PACKET) & (told >= 0))
        decided, first = np.unique(window[hits], return_index=True)
        answers[np.searchsorted(opened, decided)] = told[hits[first]]
        for at, (code, v) in enumerate(stored.items(), n + 2):
            if v[0]:
                answers[np.searchsorted(opened, code)] = at
        late = kind == LATE
        answered = answers[np.searchsorted(opened, window[late])]
        told[late] = np.where(answered >= 0, answered, told[late])
        self._keep_open(opened, answers, looks, stored, says)
        for x, state in enumerate(self.newest):
            if last[x] is None:
                continue
            since, entry = last[x]
            if since + self.ttl < known_to:
                state.clear()
            elif n:
                state.update((since, *self._said(says, entry)))
                self.handle.registerTimer(self.after(since + self.ttl))
        open_now = opened[(opened // 2 + 2) * self.size >= known_to]
        waits = [(int(open_now[0]) // 2 + 2) * self.size] if len(open_now) else []
        if len(left):
            waits.append(int(left["ts_ns"].to_numpy().min()))
        if waits:
            self.handle.registerTimer(self.after(min(waits)))
        shown = np.flatnonzero(np.isin(kind, self.kinds))
        for begin in range(0, len(shown), MOST_ROWS):
            at = shown[begin : begin + MOST_ROWS]
            yield self._frame(key, d[at], window[at] // 2, kind[at], number[at], ts[at], told[at], says)

    def _said(self, says: pa.Table, entry: int) -> tuple:
        return tuple(says[c][entry].as_py() for c in self.names)

    def _keep_open(self, opened: np.ndarray, answers: np.ndarray, looks: np.ndarray, stored: dict[int, tuple], says: pa.Table) -> None:
        """Only windows still open stay in the state."""
        gone = set(looks.tolist())
        for code in stored:
            if code in gone:
                self.windows.removeKey((code // 2, code % 2))
        for code, entry in zip(opened.tolist(), answers.tolist(), strict=True):
            answer = (True, *self._said(says, entry)) if entry >= 0 and code not in gone else (False, *[None] * len(self.names))
            if code not in gone and stored.get(code) != answer:
                self.windows.updateValue((code // 2, code % 2), answer)

    def _frame(self, key, d, window, kind, number, ts, told, says: pa.Table):
        import pandas as pd

        kinds = {T.LongType: "Int64", T.IntegerType: "Int32", T.BooleanType: "boolean", T.StringType: "object"}
        flow = list(zip((key[0], *key[1:5], key[5]), (key[0], *key[3:5], *key[1:3], key[5]), strict=True))
        ends = [pd.Series(both, dtype=kinds[type(f.dataType)]).take(d).reset_index(drop=True) for f, both in zip(self.out.fields, flow, strict=False)]
        numbers = pd.arrays.IntegerArray(number, kind == LATE)
        said = as_pandas(says.take(pa.array(told, mask=told < 0)))
        rest = [window, kind, numbers, ts, told >= 0, *[said[c] for c in self.names]]
        return pd.DataFrame(dict(zip(self.out.names, [*ends, *rest], strict=True))).astype({"kind": "int32"})

    def close(self) -> None:
        pass


def stream_matches(
    source: DataFrame, entries: DataFrame, size_s: float = 5.0, ttl_s: float = TTL_S, late_s: float = 5.0, step_s: float = 1.0, kinds: Sequence[int] = (PACKET, LATE)
) -> DataFrame:
    """What packets and flow windows are told: ``kind`` 1 per packet, 2 per flow window, with ``matched`` and the entry's fields.

    A packet gets the newest entry of its flow younger than ``ttl_s``, else of the reverse flow.  A window keeps what its first
    packet with an entry got; without one, one more look is taken a window after its end.  Both inputs may be streams or
    tables; a stream's rows count when the watermark, ``late_s`` behind the newest row of the slower input, has passed them.
    ``source`` may come out of :func:`flowloom.streaming.wide.stream_gate` with rate windows of ``step_s``.  Rows of ``kinds`` come out.
    """
    fields = [f for f in entries.schema.fields if f.name in (*PAYLOAD, *META)]
    ordered = [F.col("host"), *[c.alias(n) for n, c in endpoint_order().items()], F.col("protocol"), F.col("ts_ns")]
    # The fields travel as one text, a list of their values.
    said = F.to_json(F.array(*[F.col(f.name).cast("string") for f in fields])).alias("said")
    asked = (source if "at" in source.columns else timed(source, late_s)).select("at", *ordered, F.col("pkt_id").alias("id"), F.lit(PACKET).alias("kind"), F.lit(None).cast("string").alias("said"))
    given = timed(entries, late_s).select("at", *ordered, F.col("rec_id").alias("id"), F.lit(ENTRY).alias("kind"), said)
    line = asked.unionByName(given)
    flow = S._struct("host string, src_ip string, src_port int, dst_ip string, dst_port int, protocol int, window_id bigint, kind int, pkt_id bigint, ts_ns bigint").fields
    out = T.StructType([*flow, T.StructField("matched", T.BooleanType()), T.StructField("said", T.StringType())])
    cache = EntryCache(line.schema, out, size_s, ttl_s, step_s, kinds)
    told = line.groupBy(*CONVERSATION).transformWithStateInPandas(statefulProcessor=cache, outputStructType=out, outputMode="append", timeMode="EventTime")
    values = F.from_json("said", T.ArrayType(T.StringType())).alias("said")
    told = told.select(*out.names[:-1], values)
    return told.select(*out.names[:-1], *[F.get("said", F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def packet_matches(matches: DataFrame) -> DataFrame:
    """One row per packet."""
    return matches.filter(F.col("kind") == PACKET).drop("kind")


def window_matches(matches: DataFrame) -> DataFrame:
    """The entry of each flow window that has one, as :func:`flowloom.operators.l7.match_l7` gives it."""
    told = matches.filter((F.col("kind") == LATE) & F.col("matched"))
    return told.select(*S.FLOW, "window_id", F.struct(*PAYLOAD, *META).alias("l7"))

