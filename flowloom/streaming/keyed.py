"""Help for processors that keep state per key: rows packed as Arrow, times of timers, the state store."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowloom.functions.scalar import size_ns
from flowloom.streaming.flows import event_time, whole_micros

#: Streams count time from one second after the epoch: rows at a watermark's first value, 0, would be late.
SHIFT_MS = 1000
#: Number of the row that only moves the watermark on.
END = -1
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def timed(rows: DataFrame, late_s: float) -> DataFrame:
    """Rows with the event time ``at`` and a watermark of ``late_s``."""
    shifted = event_time(rows, SHIFT_MS // 1000).withColumnRenamed("ts", "at")
    return shifted.withWatermark("at", whole_micros(late_s)) if rows.isStreaming else shifted


def due_ms(ns: int) -> int:
    """The watermark in milliseconds at which everything before ``ns`` has come."""
    return -(-ns // 1_000_000) + SHIFT_MS


def done_by(timerValues, expiredTimerInfo) -> int:
    """The time up to which a call for a timer may do everything: that of the batch's watermark, not only the timer's own.

    A key then needs one timer, for the first thing that is due, and one call per micro-batch serves all that is.
    """
    return max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)


def stamp(ms: int):
    import pandas as pd

    return pd.Timestamp(ms, unit="ms")


def pack(rows, schema: pa.Schema) -> bytes:
    """Rows, of pandas or Arrow, without a schema; :func:`unpack` is given it again.  The first eight bytes are the length before compression."""
    if isinstance(rows, pa.Table):
        rows = rows.combine_chunks().to_batches()[0]
    batch = rows if isinstance(rows, pa.RecordBatch) else pa.RecordBatch.from_pandas(rows, schema=schema, preserve_index=False)
    plain = batch.serialize()
    return plain.size.to_bytes(8, "little") + pa.compress(plain, codec="lz4", asbytes=True)


def unpack_table(blobs: Iterable[bytes], schema: pa.Schema) -> pa.Table:
    """The rows of all ``blobs``, each column in one piece."""
    plain = (pa.decompress(memoryview(b)[8:], int.from_bytes(b[:8], "little"), codec="lz4") for b in blobs)
    return pa.Table.from_batches([pa.ipc.read_record_batch(p, schema) for p in plain], schema).combine_chunks()


def as_pandas(table: pa.Table):
    """Rows as pandas, whole numbers with nulls."""
    import pandas as pd

    return table.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}.get)


def unpack(blobs: Iterable[bytes], schema: pa.Schema):
    return as_pandas(unpack_table(blobs, schema))


@contextmanager
def state_store(spark: SparkSession, idle_batches: bool = True) -> Iterator[None]:
    """The RocksDB state store, which processors with several states and timers need, while a stream is started and run.

    A stream whose state has a time to live by the clock always asks for one more batch without rows; one that is to end
    when its input does needs ``idle_batches`` off.
    """
    wanted = {_PROVIDER: _ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": str(idle_batches).lower()}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def end_marker(rows: DataFrame, after_s: float) -> DataFrame:
    """One row behind the newest one by ``after_s``, to be the last row of a stream of packets or records that ends.

    It carries the watermark past all windows; processors leave it out by its number.
    """
    last = {f.name: F.lit(None) for f in rows.schema.fields}
    last |= dict.fromkeys(["src_port", "dst_port", "protocol"], F.lit(0)) | dict.fromkeys(["host", "src_ip", "dst_ip"], F.lit("")) | dict.fromkeys(["pkt_id", "rec_id"], F.lit(END))
    newest = rows.agg((F.coalesce(F.max("ts_ns"), F.lit(0)) + size_ns(after_s)).alias("ts_ns"))
    return newest.select(*[(F.col("ts_ns") if f.name == "ts_ns" else last[f.name].cast(f.dataType)).alias(f.name) for f in rows.schema.fields])
