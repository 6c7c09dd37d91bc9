"""The packet operators on Structured Streaming."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.scalar import clamp, flow_id, has_flag, size_ns
from flowloom.functions.sized import checkpoint_root, keep
from flowloom.operators.flows import MAX_AVG_SIZE, MAX_BPS, MAX_PPS, MIN_AVG_SIZE, QUANTILES, count_where, rank_index
from flowloom.operators.packets import valid_size


def event_time(packets: DataFrame, epoch_s: int = 0) -> DataFrame:
    """Add the event time ``ts`` that windows and watermarks need, from ``epoch_s`` on."""
    micros = F.call_function("div", F.col("ts_ns"), F.lit(1000).cast("long")) + F.lit(epoch_s * 1_000_000)
    return packets.withColumn("ts", F.timestamp_micros(micros))


def whole_micros(seconds: float) -> str:
    """An interval for windows and watermarks; streams hold whole microseconds."""
    ns = size_ns(seconds)
    if ns % 1000 or ns <= 0:
        raise ValueError("streams need a length of whole microseconds")
    return f"{ns // 1000} microseconds"


def _gaps(times: Column) -> Column:
    """Differences of neighbours in a sorted array of nanosecond times."""
    later = F.slice(times, F.lit(2), F.greatest(F.size(times) - 1, F.lit(0)))
    return F.zip_with(later, F.slice(times, F.lit(1), F.size(later)), lambda b, a: b - a)


def _mean_std(values: Column) -> tuple[Column, Column]:
    n = F.size(values)
    zero = F.lit(0.0)
    mean = F.aggregate(values, zero, lambda a, x: a + x) / n
    square = F.aggregate(values, zero, lambda a, x: a + (x - mean) * (x - mean))
    return (
        F.when(n > 0, mean).otherwise(zero),
        F.when(n > 1, F.sqrt(square / (n - 1))).otherwise(zero),
    )


def core_numbers() -> list[Column]:
    """The numbers of a flow window behind :func:`core_rows`; all merge by sums, minima and joined lists."""
    valid = valid_size()
    tcp = valid & (F.col("protocol") == S.TCP)
    return [
        count_where(valid).alias("packet_count"),
        F.sum(F.when(valid, F.col("packet_size"))).alias("byte_count"),
        F.sort_array(F.collect_list(F.when(valid, F.col("ts_ns")))).alias("_times"),
        count_where(tcp & has_flag(S.SYN) & has_flag(S.ACK)).alias("syn_ack_count"),
        count_where(tcp & has_flag(S.SYN) & ~has_flag(S.ACK)).alias("half_open_connections"),
        count_where(tcp & has_flag(S.FIN)).alias("fin_count"),
        count_where(tcp & has_flag(S.RST)).alias("rst_count"),
        count_where(tcp & (F.col("tcp_window") == 0)).alias("zero_window_count"),
        F.min(F.when(F.col("ip_ttl") > 0, F.col("ip_ttl"))).alias("ttl_min"),
    ]


def core_rows(numbers: DataFrame, size_s: float = 5.0) -> DataFrame:
    """Core feature rows from :func:`core_numbers` per flow and ``window_id``."""
    n, size, seconds = F.col("packet_count"), F.col("byte_count"), float(size_s)
    shown = numbers.filter(n > 0).withColumn("_gaps", F.array_sort(_gaps(F.col("_times"))))
    mean, std = _mean_std(F.col("_gaps"))
    gap_count = F.size("_gaps")
    return shown.select(
        *S.FLOW, "window_id", flow_id().alias("flow_id"), "packet_count", "byte_count",
        clamp(n / seconds, 0, MAX_PPS).alias("packets_per_second"),
        clamp(size / seconds, 0, MAX_BPS).alias("bytes_per_second"),
        clamp(size / n, MIN_AVG_SIZE, MAX_AVG_SIZE).alias("avg_packet_size"),
        (mean / 1e6).alias("inter_arrival_mean_ms"), (std / 1e6).alias("inter_arrival_std_ms"),
        *[F.when(gap_count >= 2, F.get("_gaps", rank_index(gap_count, q)) / 1e6).otherwise(F.lit(0.0)).alias(f"latency_{p}")
          for p, q in QUANTILES.items()],
        "syn_ack_count", "half_open_connections", "fin_count", "rst_count", "zero_window_count",
        F.coalesce("ttl_min", F.lit(0)).alias("ttl_min"),
    )


def stream_flow_core(packets: DataFrame, size_s: float = 5.0) -> DataFrame:
    """Core features per flow and window, on a stream or a batch of packets.

    Streams cannot use row-ordered windows, so a window's packet times are gathered and
    sorted; feed streams that passed the flood gate, which bounds them.  With a watermark of
    one window, a window closes once a packet two windows later has been seen.  Packets of
    closed windows are dropped; :func:`late_packets` counts them and :func:`repair_late` puts them in,
    both from the whole input.  :mod:`flowloom.streaming.partials` keeps what is needed to merge them.
    """
    timed = event_time(packets)
    if packets.isStreaming:
        timed = timed.withWatermark("ts", whole_micros(size_s))
    span = F.window("ts", whole_micros(size_s))
    grouped = timed.groupBy(*S.FLOW, span.alias("_window")).agg(*core_numbers())
    start_us = F.unix_micros(F.col("_window.start"))
    window = F.call_function("div", start_us * 1000, F.lit(size_ns(size_s)).cast("long"))
    return core_rows(grouped.withColumn("window_id", window), size_s)


@contextmanager
def started(stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> Iterator[Callable[[], DataFrame]]:
    """Process everything available while the block goes on; a call of what is yielded waits for the written Parquet table.

    Folders not given are made in the session's checkpoint folder.
    """
    spark = stream.sparkSession
    if path is None or checkpoint is None:
        base = os.path.join(checkpoint_root(spark), f"stream-{uuid.uuid4().hex}")
        path, checkpoint = path or f"{base}/out", checkpoint or f"{base}/checkpoint"
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

    def written() -> DataFrame:
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(path)

    try:
        yield written
    finally:
        query.stop()


def run_available(stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything available, then stop; returns the written Parquet table."""
    with started(stream, path, checkpoint) as written:
        return written()


def flush_open_windows(emitted: DataFrame, packets: DataFrame, size_s: float = 5.0) -> DataFrame:
    """Add the windows a stopped stream still held open, computed from the same packets as a batch.

    A stream has closed every window that ends at least one window length before the newest
    packet.  Only packets of later windows are read again.
    """
    size = size_ns(size_s)
    newest = packets.agg(F.max("ts_ns")).first()[0]
    if newest is None:
        return emitted
    # The watermark is kept in milliseconds.
    first_open = (newest // 1_000_000 * 1_000_000 - size) // size
    tail = stream_flow_core(packets.filter(F.col("ts_ns") >= first_open * size), size_s)
    return emitted.filter(F.col("window_id") < first_open).unionByName(tail)


def late_packets(emitted: DataFrame, packets: DataFrame, size_s: float = 5.0) -> DataFrame:
    """Per flow and window of a stream's rows: ``late``, the valid packets that came after it had closed.

    ``packets`` is the whole input as a batch; windows the stream never closed are not late.
    """
    window = F.call_function("div", F.col("ts_ns"), F.lit(size_ns(size_s)).cast("long")).alias("window_id")
    seen = packets.filter(valid_size()).groupBy(*S.FLOW, window).agg(F.count(F.lit(1)).alias("_all"))
    newest = emitted.agg(F.max("window_id").alias("_newest"))
    closed = seen.join(F.broadcast(newest), F.col("window_id") <= F.col("_newest"))
    counted = closed.join(emitted.select(*S.FLOW, "window_id", F.col("packet_count").alias("_n")), [*S.FLOW, "window_id"], "left")
    late = F.col("_all") - F.coalesce("_n", F.lit(0))
    return counted.select(*S.FLOW, "window_id", late.alias("late")).filter("late > 0")


def repair_late(emitted: DataFrame, packets: DataFrame, size_s: float = 5.0) -> DataFrame:
    """A stream's rows with the windows that missed late packets computed anew from the whole input."""
    keys = [*S.FLOW, "window_id"]
    late = keep(late_packets(emitted, packets, size_s)).select(*keys)
    window = F.call_function("div", F.col("ts_ns"), F.lit(size_ns(size_s)).cast("long"))
    again = packets.withColumn("window_id", window).join(late, keys, "left_semi").drop("window_id")
    return emitted.join(late, keys, "left_anti").select(*emitted.columns).unionByName(stream_flow_core(again, size_s))


def status_sink(features_path: str, status_path: str):
    """A ``foreachBatch`` function that writes feature rows and one status row per batch.

    Each batch has folders of its own, ``batch_id=<n>``, which a replayed batch overwrites, so nothing is
    doubled after a restart.  Reading either path gives ``batch_id`` as a column.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        kept.write.mode("overwrite").parquet(f"{features_path}/batch_id={batch_id}")
        kept.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum("packet_count"), F.lit(0)).alias("packets"),
            F.max("window_id").alias("last_window"),
        ).write.mode("overwrite").parquet(f"{status_path}/batch_id={batch_id}")
        kept.unpersist()

    return write

