"""Streams over several micro-batches against the batch operators."""

import uuid

import pytest
from pyspark.sql import functions as F

from checks.fixtures import table
from flowloom.operators import flood
from flowloom.sources import readers
from flowloom.streaming import flows, partials, state, wide
from flowloom.streaming.keyed import end_marker, state_store

@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small inputs: two tasks per stateful step instead of one per core."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def parts(spark, sf, path, n=4):
    """Packets as ``n`` files in time order, and a reader of one file per micro-batch."""
    source = table(spark, sf, "packets")
    for i in range(n):
        source.filter((F.col("pkt_id") >= i * 1000 // n) & (F.col("pkt_id") < (i + 1) * 1000 // n)).coalesce(1).write.mode(
            "append"
        ).parquet(path)
    return readers.read_packets(spark, path, stream=True, maxFilesPerTrigger=1), source


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_windows_over_batches(spark, sf, tmp_path):
    stream, source = parts(spark, sf, str(tmp_path / "in"))
    closed = flows.run_available(flows.stream_flow_core(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    whole = flows.stream_flow_core(source)
    assert closed.count() < whole.count()
    assert same(flows.flush_open_windows(closed, source), whole)


def test_gate_state_over_batches(spark, sf, tmp_path):
    stream, source = parts(spark, sf, str(tmp_path / "in"))
    end_marker(source, 60).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    gated = wide.run_closed(wide.stream_gate(stream, 10), str(tmp_path / "out"), str(tmp_path / "cp"))
    want = flood.flood_gate(source, 10).select("pkt_id", "dropped")
    assert same(gated.select("pkt_id", "dropped"), want) and want.filter("dropped = 1").count() > 0
    first = gated.filter("first = 1").select("host", "src_ip", F.col("ts_ns").alias("block_ts"), F.col("pkt_id").alias("block_id"))
    assert same(first, flood.flood_blocklist(source, 10).drop("packet_count"))


def test_status_rows(spark, sf, tmp_path):
    stream, source = parts(spark, sf, str(tmp_path / "in"))
    sink = flows.status_sink(str(tmp_path / "rows"), str(tmp_path / "status"))
    query = (
        flows.stream_flow_core(stream)
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    status = spark.read.parquet(str(tmp_path / "status"))
    assert status.agg(F.sum("rows")).first()[0] == spark.read.parquet(str(tmp_path / "rows")).count() > 0


def late_parts(spark, sf, path):
    """Packets in time order, but every ninth one of the first half in the last file."""
    source = table(spark, sf, "packets")
    late = (F.col("pkt_id") % 9 == 0) & (F.col("pkt_id") < 500)
    steps = [~late & (F.col("pkt_id") >= i * 250) & (F.col("pkt_id") < (i + 1) * 250) for i in range(4)]
    for part in (*steps, late):
        source.filter(part).coalesce(1).write.mode("append").parquet(path)
    return readers.read_packets(spark, path, stream=True, maxFilesPerTrigger=1), source


def test_late_packets_are_counted_and_repaired(spark, sf, tmp_path):
    stream, source = late_parts(spark, sf, str(tmp_path / "in"))
    closed = flows.run_available(flows.stream_flow_core(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    late = flows.late_packets(closed, source).agg(F.sum("late")).first()[0]
    assert late > 20
    assert same(flows.flush_open_windows(flows.repair_late(closed, source), source), flows.stream_flow_core(source))


def run_partials(spark, stream, path, checkpoint):
    query = stream.writeStream.foreachBatch(partials.partials_sink(spark, path)).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def test_partials_mend_late_windows_without_the_packets(spark, sf, tmp_path):
    path, checkpoint = str(tmp_path / "kept"), str(tmp_path / "cp")
    stream, source = late_parts(spark, sf, str(tmp_path / "in"))
    run_partials(spark, stream, path, checkpoint)
    whole = flows.stream_flow_core(source)
    mended = partials.repaired_rows(spark, path)
    assert same(mended.unionByName(partials.open_rows(spark, path)), whole)
    late = source.filter("pkt_id % 9 = 0 AND pkt_id < 500").filter(flows.valid_size()).count()
    assert partials.late_counts(spark, path).agg(F.sum("late")).first()[0] == late > 20
    assert not same(partials.closed_rows(spark, path), mended)
    # Restarted with nothing new, and with a replayed batch: nothing is doubled.
    run_partials(spark, stream, path, checkpoint)
    partials.partials_sink(spark, path)(spark.read.schema(source.schema).parquet(str(tmp_path / "in")).filter("pkt_id % 9 = 0 AND pkt_id < 500"), 4)
    assert same(partials.repaired_rows(spark, path).unionByName(partials.open_rows(spark, path)), whole)


def test_partials_of_late_only_windows_and_empty_batches(spark, sf, tmp_path):
    path, source = str(tmp_path / "kept"), table(spark, sf, "packets")
    write = partials.partials_sink(spark, path)
    newest = source.agg(F.max("ts_ns")).first()[0]
    write(source.limit(0), 0)
    assert partials.first_open(spark, path) is None and partials.open_rows(spark, path).isEmpty()
    write(source.filter(F.col("ts_ns") == newest), 1)
    write(source.filter(F.col("ts_ns") < newest), 2)
    rows = partials.repaired_rows(spark, path).unionByName(partials.open_rows(spark, path))
    assert same(rows, flows.stream_flow_core(source))
    assert partials.closed_rows(spark, path).isEmpty() and not partials.late_counts(spark, path).isEmpty()


def test_late_packets_keep_their_row_without_ttl(spark, sf, tmp_path):
    stream, source = late_parts(spark, sf, str(tmp_path / "in"))
    tracked = wide.run_closed(state.stream_prev_seq(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert tracked.count() == source.filter("protocol = 6").count()


def test_ended_flows_leave_the_state_and_no_packet_is_lost(spark, tmp_path):
    """Twenty batches of ten new flows each: with a short time to live few flows are held, without one all are."""
    held = {}
    for name, ttl in (("kept", None), ("short", 0.001)):
        path = str(tmp_path / f"in-{name}")
        for i in range(6):
            rows = spark.range(10).selectExpr("'h' AS host", f"concat('10.0.{i}.', id) AS src_ip", "1 AS src_port", "'b' AS dst_ip", "2 AS dst_port", "6 AS protocol", f"{i} * 100 + id AS pkt_id", f"({i} * 100 + id) * 1000 AS ts_ns", "id AS tcp_seq")
            rows.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
        with state_store(spark, idle_batches=not ttl):
            query = state.stream_prev_seq(stream, ttl).writeStream.format("parquet").option("path", str(tmp_path / f"out-{name}")).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
            query.awaitTermination()
        held[name] = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
        assert spark.read.parquet(str(tmp_path / f"out-{name}")).count() == 60
    assert held["kept"] == 60 and held["short"] < 60


def test_windows_below_a_millisecond(spark, sf):
    source = table(spark, sf, "packets").limit(50)
    assert flows.stream_flow_core(source, 0.0005).agg(F.sum("packet_count")).first()[0] > 0
    with pytest.raises(ValueError):
        flows.stream_flow_core(source, 0.0000005)


def test_replayed_status_batch_is_not_doubled(spark, sf, tmp_path):
    rows = flows.stream_flow_core(table(spark, sf, "packets"))
    sink = flows.status_sink(str(tmp_path / "rows"), str(tmp_path / "status"))
    for _ in range(2):
        sink(rows, 7)
    assert spark.read.parquet(str(tmp_path / "rows")).count() == rows.count()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "status")).select("batch_id", "rows").collect()] == [(7, rows.count())]


def test_late_query_writes_steps_by_all_tasks(spark, sf, tmp_path, monkeypatch):
    """A step of several input files is written by as many tasks, and still is one micro-batch."""
    from checks.query_stream import stream_late_repaired

    for share in spark.read.parquet(f"{sf}/events.parquet").randomSplit([1.0] * 4, 3):
        share.coalesce(1).write.mode("append").parquet(str(tmp_path / "sf" / "events.parquet"))
    monkeypatch.setattr("checks.query_stream.scratch_path", lambda _: str(tmp_path / "kept" / uuid.uuid4().hex))
    assert same(stream_late_repaired(spark, str(tmp_path / "sf")), stream_late_repaired(spark, sf))
    runs = [p.parent for p in (tmp_path / "kept").rglob("marks")]
    assert all(sorted(int(p.name[9:]) for p in (run / "partials").glob("batch_id=*")) == [0, 1, 2, 3, 4] for run in runs)
    written = [len(list(p.glob("part-*.parquet"))) for p in (tmp_path / "kept").iterdir()]
    assert len(runs) == 2 and max(written) > 5


def test_blocks_get_few_files_from_many_tasks(spark, sf, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    partials.partials_sink(spark, str(tmp_path))(table(spark, sf, "packets"), 0)
    blocks = list((tmp_path / "partials" / "batch_id=0" / "late=0").iterdir())
    assert blocks and all(len(list(b.glob("*.parquet"))) <= partials.FILES for b in blocks)
