"""What a batch that spans much time costs a key: a few timers, and one call that does everything due."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import types as T

from flowloom import schema as S
from flowloom.operators.l7 import META, PAYLOAD
from flowloom.streaming import l7, wide
from flowloom.streaming.keyed import due_ms


class Value:
    def __init__(self):
        self.row, self.rows = None, {}

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row if self.row is not None else ()

    def update(self, row):
        self.row = row

    put = update

    def appendValue(self, row):
        self.row = [*(self.row or []), row]

    def clear(self):
        self.row = None

    def getValue(self, key):
        return self.rows.get(key)

    def updateValue(self, key, row):
        self.rows[key] = row

    def removeKey(self, key):
        self.rows.pop(key, None)

    def keys(self):
        return list(self.rows)

    def iterator(self):
        return list(self.rows.items())


class Handle:
    def __init__(self):
        self.timers = []

    def registerTimer(self, ms):
        self.timers.append(ms)

    def getValueState(self, *_):
        return Value()

    getMapState = getListState = getValueState


class Times:
    def __init__(self, watermark, expiry):
        self.getCurrentWatermarkInMs, self.getExpiryTimeInMs = lambda: watermark, lambda: expiry


SECONDS = 1000
_FLOW = S._struct("pkt_id bigint, host string, ts_ns bigint, src_ip string, src_port int, dst_ip string, dst_port int, protocol int")
_ROWS = T.StructType([*S._struct("host string, src_ip string").fields, *S._struct(", ".join(f"{c} bigint" for c in wide._MEASURES)).fields])


def _packets():
    ids = np.arange(SECONDS)
    return pd.DataFrame({"pkt_id": ids, "host": "h", "ts_ns": ids * 10**9 + 5, "src_ip": "a", "src_port": 1, "dst_ip": "b", "dst_port": 2, "protocol": 6})


def _cases():
    flow = ("h", "a", 1, "b", 2, 6)
    rows = _packets()
    yield "gate", wide.Gate(_FLOW, 5, 10**9), ("h", "a"), rows, SECONDS
    measured = pd.DataFrame({c: 1 for c in wide._MEASURES}, index=rows.index).assign(ts_ns=rows["ts_ns"], pkt_id=rows["pkt_id"], dir=0, first=0, dropped=0, src_ip="a", host="h")
    yield "windows", wide.FlowWindows(_ROWS, 5.0, 5.0, 1.0, 3, None), flow, measured, SECONDS // 5
    fields = [T.StructField(n, T.StringType()) for n in (*PAYLOAD, *META)]
    line = T.StructType([*S._struct("dir int, ts_ns bigint, id bigint, kind int").fields, *fields])
    out = T.StructType([*S._struct("host string, src_ip string, src_port int, dst_ip string, dst_port int, protocol int, window_id bigint, kind int, pkt_id bigint, ts_ns bigint").fields, T.StructField("matched", T.BooleanType()), *fields])
    asked = pd.DataFrame({"dir": 0, "ts_ns": rows["ts_ns"], "id": rows["pkt_id"], "kind": l7.PACKET, **{f.name: None for f in fields}})
    yield "entries", l7.EntryCache(line, out, 5.0, 30.0, 1.0), flow, asked, SECONDS + SECONDS // 5
    closed = pd.DataFrame({f.name: pd.Series([None] * SECONDS, dtype=object) for f in wide._CLOSED.fields}).assign(window_id=np.arange(SECONDS), syn_seen=1, packet_count=1)
    yield "totals", wide.SourceTotals(5.0, 5.0, 1.0), ("h", "a"), closed, SECONDS
    told = pd.DataFrame({"until": (np.arange(SECONDS) + 1) * 5 * 10**9, "block_ts": None, "src_ip": "a", "cpu_usage_percent": 1.0, "memory_usage_percent": 1.0})
    yield "status", wide.StatusReport(30, lambda ns: due_ms(ns + 10**10)), ("h",), told, SECONDS * 5 // 30 + 1


@pytest.mark.parametrize("name,processor,key,rows,want", list(_cases()), ids=lambda v: v if isinstance(v, str) else "")
def test_one_call_serves_a_batch(name, processor, key, rows, want):
    handle = Handle()
    processor.init(handle)
    list(processor.handleInputRows(key, iter([rows.iloc[:600], rows.iloc[600:]]), None))
    assert len(handle.timers) == 1
    watermark = due_ms(10**15)
    out = list(processor.handleExpiredTimer(key, Times(watermark, handle.timers[0]), Times(watermark, handle.timers[0])))
    assert sum(len(pdf) for pdf in out) == want and len(handle.timers) <= 3
    if name == "totals":
        # Each window is told the packets up to one window later.
        assert pd.concat(out)["_syn"].tolist() == [min(i + 2, SECONDS) for i in range(SECONDS)]


def test_a_gate_judges_only_what_is_over():
    processor, handle = wide.Gate(_FLOW, 5, 10**9), Handle()
    processor.init(handle)
    rows = _packets()
    list(processor.handleInputRows(("h", "a"), iter([rows]), None))
    at = due_ms(100 * 10**9) + 1
    out = pd.concat(list(processor.handleExpiredTimer(("h", "a"), Times(at, handle.timers[0]), Times(at, handle.timers[0]))))
    assert out["pkt_id"].tolist() == list(range(100)) and due_ms(101 * 10**9) in handle.timers
