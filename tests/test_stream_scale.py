"""What large micro-batches cost: accesses to the state, files of a step, rows given out."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_stream_timers import _FLOW, Handle, Times, Value

from checks import query_stream
from flowloom import schema as S
from flowloom.streaming import l7, wide
from flowloom.streaming.keyed import END, due_ms

SECONDS = 2000


class Counted(Value):
    def __init__(self):
        super().__init__()
        self.calls = 0

    def getValue(self, key):
        self.calls += 1
        return super().getValue(key)


def test_gate_puts_a_batch_to_each_span_once():
    """Spark hands a key's rows over in many parts; each of them used to read and write every span it had packets of."""
    gate, handle = wide.Gate(_FLOW, 5, 10**9), Handle()
    gate.init(handle)
    gate.waiting = Counted()
    ids = np.random.default_rng(1).permutation(SECONDS)
    rows = pd.DataFrame({"pkt_id": ids, "host": "h", "ts_ns": ids * 10**9 + 5, "src_ip": "a", "src_port": 1, "dst_ip": "b", "dst_port": 2, "protocol": 6})
    assert not list(gate.handleInputRows(("h", "a"), iter([rows.iloc[i : i + 100] for i in range(0, SECONDS, 100)]), None))
    assert gate.waiting.calls == len(gate.waiting.rows) == SECONDS // wide.SPAN + 1
    at = due_ms(10**15)
    out = list(gate.handleExpiredTimer(("h", "a"), Times(at, handle.timers[0]), Times(at, handle.timers[0])))
    assert len(out) == 1 and out[0]["pkt_id"].tolist() == list(range(SECONDS)) and not out[0]["dropped"].any() and not gate.waiting.rows


@pytest.mark.parametrize("held", [7, 100_000])
def test_gate_keeps_its_bound_over_parts_and_batches(monkeypatch, held):
    """A bucket's packets come in several parts and batches: the first ones in order wait, the others are dropped at once."""
    monkeypatch.setattr(wide, "MOST_HELD", held)
    gate, handle = wide.Gate(_FLOW, 5, 10**9), Handle()
    gate.init(handle)
    rows = pd.DataFrame({"pkt_id": range(40), "host": "h", "ts_ns": 10**9, "src_ip": "a", "src_port": 1, "dst_ip": "b", "dst_port": 2, "protocol": 6})
    gone = []
    for begin in (20, 0):
        parts = [rows.iloc[i : i + 5] for i in range(begin, begin + 20, 5)]
        gone += [int(x) for pdf in gate.handleInputRows(("h", "a"), iter(parts), None) for x in pdf["pkt_id"]]
    assert sorted(gone) == list(range(10, 40))
    at = due_ms(10**12)
    out = pd.concat(list(gate.handleExpiredTimer(("h", "a"), Times(at, handle.timers[0]), Times(at, handle.timers[0]))))
    assert out["pkt_id"].tolist() == list(range(10)) and out["dropped"].tolist() == [0] * 5 + [1] * 5 and out["first"].tolist().index(1) == 5


def test_other_work_goes_on_while_windows_close(spark, tmp_path):
    spark.range(40).selectExpr("id AS pkt_id", "'h' AS host", "id * 1000000000 AS ts_ns", "'a' AS src_ip", "'b' AS dst_ip", "1 AS src_port", "2 AS dst_port", "6 AS protocol").write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    stream = query_stream.fed(spark, source, "pkt_id")
    with wide.closing(wide.stream_gate(stream, 5)) as gated:
        assert len(spark.streams.active) == 1
        assert gated().count() == 40
    with pytest.raises(KeyError), wide.closing(wide.stream_gate(stream, 5)):
        raise KeyError
    assert not spark.streams.active


def test_features_read_one_feed_of_packets(spark, monkeypatch):
    fed, numbers = query_stream.fed, []

    def counted(session, rows, number, **options):
        numbers.append(number)
        return fed(session, rows, number, **options)

    monkeypatch.setattr(query_stream, "fed", counted)
    assert query_stream.stream_flow_features(spark, "/root/testdata/sf0.001").count() > 0
    assert numbers == ["pkt_id", "rec_id"]


@pytest.mark.parametrize("file_rows", [100_000, 8])
def test_a_step_of_several_files_is_one_batch(spark, tmp_path, monkeypatch, file_rows):
    """Steps of 40, 3, 0, 1 and 40 rows: each has the same number of files, and is one micro-batch."""
    monkeypatch.setattr(query_stream, "scratch_path", lambda _: str(tmp_path / "fed"))
    ids = [*range(40), 50, 51, 52, 130, *range(160, 200)]
    rows = spark.createDataFrame([(i, "h", i * 10**9, "a", 1, "b", 2, 6) for i in ids], "pkt_id bigint, host string, ts_ns bigint, src_ip string, src_port int, dst_ip string, dst_port int, protocol int")
    stream = query_stream.fed(spark, rows, "pkt_id", file_rows=file_rows)
    files = 84 // (5 * file_rows) + 1
    assert len(list((tmp_path / "fed").glob("part-*"))) == 5 * files + 1 and files == (3 if file_rows == 8 else 1)
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [40, 3, 1, 40, 1]
    assert sorted(r.pkt_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [END, *ids]


KEY = ("h", "a", 1, "b", 2, 6)
_FIELDS = S._struct("said string, code int").fields
_LINE = T.StructType([*S._struct("dir int, ts_ns bigint, id bigint, kind int").fields, *_FIELDS])
_TOLD = T.StructType([*S._struct("host string, src_ip string, src_port int, dst_ip string, dst_port int, protocol int, window_id bigint, kind int, pkt_id bigint, ts_ns bigint").fields, T.StructField("matched", T.BooleanType()), *_FIELDS])


def _cache(**options):
    cache, handle = l7.EntryCache(_LINE, _TOLD, 5.0, 30.0, 1.0, **options), Handle()
    cache.init(handle)
    cache.newest = [Value(), Value()]
    return cache, handle


def _told(cache, handle, rows, watermark):
    if len(rows):
        list(cache.handleInputRows(KEY, iter([rows]), None))
    times = Times(watermark, watermark)
    return list(cache.handleExpiredTimer(KEY, times, times)) if handle.timers else []


def _one_by_one(rows):
    """What each packet and window is told, row by row in the order of time."""
    size, ttl, newest, windows, out = 5 * 10**9, 30 * 10**9, [None, None], {}, []
    windows = {(r.ts_ns // size, r.dir): None for r in rows.itertuples() if r.kind == l7.PACKET}
    looks = [((w + 2) * size, l7.LATE, 0, d, w, None) for w, d in windows]
    for ts, kind, number, d, window, said in sorted([(r.ts_ns, r.kind, r.id, r.dir, r.ts_ns // size, (r.said, r.code)) for r in rows.itertuples()] + looks, key=lambda r: r[:4]):
        if kind == l7.ENTRY:
            newest[d] = (ts, *said)
            continue
        seen = next((newest[x][1:] for x in (d, 1 - d) if newest[x] is not None and ts - newest[x][0] < ttl), None)
        windows[window, d] = windows[window, d] or seen
        told = windows[window, d] if kind == l7.LATE else seen
        out.append((KEY[1] if d == 0 else KEY[3], window, kind, number if kind == l7.PACKET else None, ts, told is not None, *(told or (None, None))))
    return out


@pytest.mark.parametrize("seed,kinds", [(1, None), (2, None), (3, [l7.LATE]), (4, [l7.PACKET])])
def test_entries_of_many_calls_as_one_by_one(seed, kinds):
    rng = random.Random(seed)
    rows = pd.DataFrame(
        [(rng.randrange(2), rng.randrange(600) * 500_000_000, i, int(rng.random() < 0.8), f"e{i}", i) for i in range(900)], columns=["dir", "ts_ns", "id", "kind", "said", "code"]
    ).astype({"dir": "int32", "kind": "int32", "code": "Int32"})
    rows.loc[rows["kind"] == l7.PACKET, ["said", "code"]] = None
    cache, handle = _cache(**({"kinds": kinds} if kinds else {}))
    frames = []
    for end in (7.3, 50, 50.5, 121, 300, 10_000):
        due = rows["ts_ns"] < end * 10**9
        frames += _told(cache, handle, rows[due], due_ms(int(end * 10**9)) + 1)
        assert all((w + 2) * 5 >= int(end) - 1 for w, _ in cache.windows.keys())
        rows_left = rows[~due]
        done, rows = (rows[due] if end == 7.3 else pd.concat([done, rows[due]])), rows_left
    got = pd.concat(frames)[["src_ip", "window_id", "kind", "pkt_id", "ts_ns", "matched", "said", "code"]].astype(object)
    got = [tuple(None if pd.isna(x) else x for x in r) for r in got.itertuples(index=False)]
    want = [r for r in _one_by_one(done) if not kinds or r[2] in kinds]
    key = lambda r: (r[4], r[2], r[3] or 0, r[0])
    assert sorted(got, key=key) == sorted(want, key=key) and len(want) > 50 and any(r[5] for r in want)
    assert not cache.windows.rows and not any(s.exists() for s in cache.newest) and not cache.waiting.exists()


def test_entries_answer_a_batch_in_few_frames():
    n = 60_000
    ids = np.arange(n)
    rows = pd.DataFrame({"dir": (ids % 2).astype("int32"), "ts_ns": ids * 10**7, "id": ids, "kind": np.where(ids % 3, l7.PACKET, l7.ENTRY).astype("int32"), "said": "e", "code": pd.array(ids, dtype="Int32")})
    cache, handle = _cache()
    frames = _told(cache, handle, rows, due_ms(10**13))
    assert sum(map(len, frames)) == 40_000 + 2 * 120 and len(frames) == 3


def test_fields_of_entries_come_back_as_they_were(spark, tmp_path):
    """An entry's fields travel as one text: signs, line ends, empty texts and nulls survive, and so do types."""
    flow = "'h' AS host, 'a' AS src_ip, 1 AS src_port, 'b' AS dst_ip, 2 AS dst_port, 6 AS protocol"
    entries = spark.range(1).selectExpr(*flow.split(", "), "CAST(1 AS BIGINT) AS rec_id", "CAST(1000000000 AS BIGINT) AS ts_ns")
    odd = ['a",\\[\n]\t\u00e9\u0001{}', "", None, "null"]
    whole = ("_code", "_ms", "_answers", "_key")
    names = [*l7.PAYLOAD, *l7.META]
    values = {n: F.lit(None if i == 0 else -i).cast("int") if n.endswith(whole) else F.lit(odd[i % 4]).cast("string") for i, n in enumerate(names)}
    entries = entries.withColumns(values)
    packets = spark.range(1).selectExpr(*flow.split(", "), "CAST(5 AS BIGINT) AS pkt_id", "CAST(2000000000 AS BIGINT) AS ts_ns")
    packets.write.parquet(str(tmp_path / "in"))
    told = l7.stream_matches(query_stream.fed(spark, spark.read.parquet(str(tmp_path / "in")), "pkt_id"), query_stream.fed(spark, entries, "rec_id"), kinds=[l7.PACKET])
    got = wide.run_closed(told, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert got.drop("kind").columns == l7.packet_matches(told).columns and got.schema[names[0]].dataType == entries.schema[names[0]].dataType
    assert got.select(*names).collect() == entries.select(*names).collect() and got.first().matched
