"""Registered streaming queries; each runs a stream over the whole event table to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from checks.query_flows import GROUP, annotated, packets, rounded
from checks.query_more import THRESHOLD, host_windows
from flowloom.functions.scalar import has_flag
from flowloom.functions.sized import keep, scratch_path
from flowloom.operators.connections import connection_state, out_of_order, retransmission
from flowloom.operators.flows import flow_features
from flowloom.operators.l7 import META, PAYLOAD, add_entries, l7_entries
from flowloom.plans.pipeline import Settings
from flowloom.sources.readers import read_packets
from flowloom.streaming import flows, l7, partials, state, wide
from flowloom.streaming.keyed import end_marker

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def entries_of(spark: SparkSession, sf: str) -> DataFrame:
    return l7_entries(fixtures.table(spark, sf, "l7_lines"))


def packet_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The derived packets as a stream over the event files."""
    spark.readStream.schema(EVENTS).parquet(f"{sf}/events*.parquet").createOrReplaceTempView("events")
    return spark.sql(fixtures.sql("packets", "spark"))


def stream_flow_core(spark, sf):
    closed = flows.run_available(flows.stream_flow_core(packet_stream(spark, sf)))
    return rounded(flows.flush_open_windows(closed, packets(spark, sf)), {"inter_arrival_std_ms": 4})


def stream_late_repaired(spark, sf):
    """Five steps, a micro-batch each; every ninth packet of the first half comes last, after its window closed."""
    source, path, kept, checkpoint = packets(spark, sf), scratch_path(spark), scratch_path(spark), scratch_path(spark)
    step = source.agg(F.max("pkt_id")).first()[0] // 4 + 1
    late = (F.col("pkt_id") % 9 == 0) & (F.col("pkt_id") < 2 * step)
    steps = [~late & (F.col("pkt_id") >= i * step) & (F.col("pkt_id") < (i + 1) * step) for i in range(4)]
    sink = partials.partials_sink(spark, kept)
    for part in (*steps, late):
        # As many files as there are tasks; each run of the stream takes what is new in one micro-batch.
        source.filter(part).write.mode("append").parquet(path)
        stream = read_packets(spark, path, stream=True).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
        stream.trigger(availableNow=True).start().awaitTermination()
    repaired = partials.repaired_rows(spark, kept).unionByName(partials.open_rows(spark, kept))
    return rounded(repaired, {"inter_arrival_std_ms": 4})


#: Rows of a step that one file holds, about.
FILE_ROWS = 100_000


def fed(spark: SparkSession, rows: DataFrame, number: str, n: int = 5, file_rows: int = FILE_ROWS) -> DataFrame:
    """A stream of ``n`` steps of rows in the order of ``number``, one per micro-batch, and of a last row that ends it.

    ``rows`` are read once per step, so they should be stored or cheap to derive.  Every step has the same number of files, by the number of all
    rows, so that as many tasks write it and a micro-batch is that many files.
    """
    path = scratch_path(spark)
    last, count = rows.agg(F.max(number), F.count(F.lit(1))).first()
    step, files = (last or 0) // n + 1, count // (n * file_rows) + 1
    for i in range(n):
        part = rows.filter((F.col(number) >= i * step) & (F.col(number) < (i + 1) * step))
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(path)
        if files > 1:
            # A task without rows writes no file.
            missing = (i + 1) * files - len(spark.read.schema(rows.schema).parquet(path).inputFiles())
            for _ in range(missing):
                rows.limit(0).coalesce(1).write.mode("append").parquet(path)
    end_marker(rows, 120).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def stream_flood_gate(spark, sf):
    gated = wide.run_closed(wide.stream_gate(fed(spark, packets(spark, sf), "pkt_id"), 12))
    return gated.select("pkt_id", "host", "src_ip", "dropped")


def l7_told(spark: SparkSession, source: DataFrame, entries: DataFrame, kind: int) -> DataFrame:
    """What a stream of ``source`` and of stored ``entries`` gives, rows of ``kind``."""
    return l7.stream_matches(source, fed(spark, entries, "rec_id"), kinds=[kind])


def stream_l7_asof(spark, sf):
    """One row per packet, with the entry it sees."""
    source, entries = packets(spark, sf), entries_of(spark, sf)
    told = wide.run_closed(l7.packet_matches(l7_told(spark, fed(spark, source, "pkt_id"), entries, l7.PACKET)))
    return told.select("pkt_id", "matched", *PAYLOAD, *META)


def stream_l7_windows(spark, sf):
    """One row per flow window, with the entry it is given."""
    source, entries = packets(spark, sf), entries_of(spark, sf)
    with wide.closing(l7.window_matches(l7_told(spark, fed(spark, source, "pkt_id"), entries, l7.LATE))) as matched:
        windows = keep(flow_features(annotated(spark, sf)).select(*GROUP))
        return add_entries(windows, matched())


def stream_flow_features(spark, sf):
    """The 94 columns from streams of packets and of application entries, five files each."""
    settings = Settings(threshold=THRESHOLD)
    source = fed(spark, packets(spark, sf), "pkt_id")
    # Windows close while the entries are prepared and matched.
    with wide.closing(wide.closed_windows(source, settings)) as closed:
        passed = wide.let_through(source, settings).filter("dropped = 0")
        matched = l7.window_matches(l7_told(spark, passed, entries_of(spark, sf), l7.LATE))
        with wide.closing(matched) as told:
            hosts = keep(host_windows(spark, sf))
            rows = wide.feature_rows(closed(), settings, hosts, told())
    return rounded(rows, {"zero_window_duration": 9, "handshake_latency": 9})


def stream_conn_track(spark, sf):
    tracked = wide.run_closed(state.stream_prev_seq(packet_stream(spark, sf)))
    seq, prev, syn = F.col("tcp_seq"), F.col("prev_seq"), has_flag(2)
    return tracked.select(
        "pkt_id",
        "prev_seq",
        retransmission(seq, prev, syn).alias("retransmission"),
        out_of_order(seq, prev, syn).alias("out_of_order"),
        connection_state(prev.isNotNull()).alias("conn_state"),
    )


def stream_status(spark, sf):
    """Status rows every 30 s of the stream of windows."""
    settings, hosts = Settings(threshold=THRESHOLD), keep(host_windows(spark, sf))
    closed = wide.closed_windows(fed(spark, packets(spark, sf), "pkt_id"), settings)
    return rounded(wide.run_closed(wide.stream_status(closed, settings, hosts)))


QUERIES = {
    "stream_flow_core": stream_flow_core,
    "stream_late_repaired": stream_late_repaired,
    "stream_flood_gate": stream_flood_gate,
    "stream_conn_track": stream_conn_track,
    "stream_l7_asof": stream_l7_asof,
    "stream_l7_windows": stream_l7_windows,
    "stream_flow_features": stream_flow_features,
    "stream_status": stream_status,
}
