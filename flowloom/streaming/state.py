"""Sequence tracking with state per flow between micro-batches.

Packets of one flow are put in order inside each micro-batch, so results equal the batch operator when batches arrive in
time order; a packet that arrives in a later batch than a newer one is judged when it arrives.  A flow's share of one batch is
held in memory: limit batches with ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``.  :mod:`flowloom.streaming.wide` puts packets
in order across batches instead, and drops those behind the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowloom import schema as S


class LastSequence(StatefulProcessor):
    """Packets with the sequence number before them; the last one of a flow is kept, for ``ttl_ms`` after its last use."""

    def __init__(self, columns: list[str], ttl_ms: int | None) -> None:
        self.columns, self.ttl_ms = columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "seq bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        pdf = pd.concat(list(rows)).sort_values(S.ORDER, kind="stable")
        before = pdf["tcp_seq"].shift(1).astype("Int64")
        if self.last.exists():
            before.iloc[0] = self.last.get()[0]
        self.last.update((int(pdf["tcp_seq"].iloc[-1]),))
        yield pdf[self.columns].assign(prev_seq=before)

    def close(self) -> None:
        pass


def stream_prev_seq(packets: DataFrame, ttl_s: float | None = None) -> DataFrame:
    """TCP packets with ``prev_seq``, the sequence number before them in their flow; every packet comes out.

    State per flow: the last sequence number.  With ``ttl_s`` a flow that had no packet for so long, by the clock, leaves the
    state, so that ended flows do not pile up; no watermark is involved, and a late packet is judged like any other.
    Start the stream with :func:`flowloom.streaming.wide.run_closed` or under :func:`flowloom.streaming.keyed.state_store`; with
    ``ttl_s`` a stream that is to end needs the latter without idle batches.
    """
    tcp = packets.filter(packets["protocol"] == S.TCP)
    out = T.StructType([*packets.schema.fields, T.StructField("prev_seq", T.LongType())])
    tracker = LastSequence(packets.columns, int(ttl_s * 1000) if ttl_s else None)
    return tcp.groupBy(*S.FLOW).transformWithStateInPandas(
        statefulProcessor=tracker, outputStructType=out, outputMode="append", timeMode="ProcessingTime" if ttl_s else "None"
    )
