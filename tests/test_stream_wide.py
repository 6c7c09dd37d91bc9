"""The wide row and the application-flow cache on streams whose rows come in any order within the watermark."""

import random

import pytest
from pyspark.sql import functions as F

from checks.fixtures import table
from flowloom import schema as S
from flowloom.operators import l7 as batch_l7
from flowloom.operators import packets
from flowloom.plans.pipeline import Settings, build_features
from flowloom.streaming import l7, wide
from flowloom.streaming.keyed import end_marker

L7_FIELDS = {n: "0" for n in ("http_status_code", "http_latency_ms", "grpc_status_code", "dns_response_code", "dns_num_answers", "kafka_api_key", "kafka_error_code")}

@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small inputs: two tasks per stateful step instead of one per core."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def shuffled(spark, rows, path, late_s, n=3):
    """Files in the order of time plus up to ``late_s``, so that each holds rows older than the newest of the one before."""
    span = rows.agg(F.max("ts_ns")).first()[0] // n + 1
    arrival = F.col("ts_ns") + F.pmod(F.xxhash64("pkt_id"), F.lit(int(late_s * 1e9)))
    for i in range(n + 1):
        rows.filter(F.floor(arrival / span) == i).coalesce(1).write.mode("append").parquet(path)
    end_marker(rows, 100).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def rounded(df):
    return df.select(*[F.round(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema.fields])


def test_wide_rows_of_disordered_packets(spark, sf, tmp_path):
    source = table(spark, sf, "packets")
    settings = Settings(threshold=10, label=3)
    stream = shuffled(spark, source, str(tmp_path / "in"), 4.0)
    closed = wide.run_closed(wide.closed_windows(stream, settings, idle_s=3600), str(tmp_path / "out"), str(tmp_path / "cp"))
    got, want = wide.feature_rows(closed, settings), build_features(source, None, None, settings)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert same(rounded(got), rounded(want)) and want.filter("is_blocked_flow = 1").count() > 0


def test_burst_at_one_instant(spark, tmp_path):
    """All packets of a source at one time: kept ones are bounded, the rest are dropped at once."""
    rows = spark.range(300).selectExpr("id AS pkt_id", "'h' AS host", "CAST(5000000000 AS BIGINT) AS ts_ns", "'a' AS src_ip", "'b' AS dst_ip", "1 AS src_port", "2 AS dst_port", "6 AS protocol")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    end_marker(rows, 60).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    gated = wide.run_closed(wide.stream_gate(stream, 20), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert gated.count() == 300 and gated.filter("dropped = 0").count() == 20
    assert [r.pkt_id for r in gated.filter("first = 1").collect()] == [20]


def test_sinks_write_each_batch_once(spark, sf, tmp_path):
    source, settings = table(spark, sf, "packets"), Settings(threshold=12)
    closed = wide.run_closed(wide.closed_windows(shuffled(spark, source, str(tmp_path / "in"), 1.0), settings), str(tmp_path / "out"), str(tmp_path / "cp"))
    sink = wide.features_sink(str(tmp_path / "rows"), settings)
    for _ in range(2):
        sink(closed, 4)
    assert spark.read.parquet(str(tmp_path / "rows")).count() == closed.count()


@pytest.mark.parametrize("late_s", [1.0, 20.0])
def test_entries_reach_packets_as_in_a_batch(spark, tmp_path, late_s):
    rng = random.Random(4)
    flow = lambda k, back: (f"10.0.0.{k}", 1, "10.0.1.1", 2) if not back else ("10.0.1.1", 2, f"10.0.0.{k}", 1)
    asked = [(i, "h", rng.randrange(200) * 500_000_000, *flow(rng.randrange(3), rng.random() < 0.5), 6) for i in range(250)]
    given = [(i, "h", rng.randrange(200) * 500_000_000, *flow(rng.randrange(3), rng.random() < 0.3), 6) for i in range(25)]
    # Equal times, times at window ends, and an entry exactly as old as its time to live.
    asked += [(900, "h", 300_000_000_000, *flow(5, False), 6), (901, "h", 330_000_000_000, *flow(5, False), 6), (902, "h", 400_000_000_000, *flow(6, False), 6)]
    given += [(900, "h", 300_000_000_000, *flow(5, True), 6), (901, "h", 410_000_000_000, *flow(6, False), 6)]
    layout = "host string, ts_ns bigint, src_ip string, src_port int, dst_ip string, dst_port int, protocol int"
    source = spark.createDataFrame(asked, f"pkt_id bigint, {layout}")
    entries = spark.createDataFrame(given, f"rec_id bigint, {layout}").withColumns(
        {n: F.lit(0) if n in L7_FIELDS else F.concat(F.lit("e"), F.col("rec_id").cast("string")) for n in (*batch_l7.PAYLOAD, *batch_l7.META)}
    )
    entries.write.parquet(str(tmp_path / "entries"))
    entries = spark.read.parquet(str(tmp_path / "entries"))
    left = shuffled(spark, source, str(tmp_path / "p"), late_s)
    right = shuffled(spark, entries.withColumnRenamed("rec_id", "pkt_id"), str(tmp_path / "l"), late_s).withColumnRenamed("pkt_id", "rec_id")
    told = wide.run_closed(l7.stream_matches(left, right, late_s=late_s), str(tmp_path / "out"), str(tmp_path / "cp"))
    want = batch_l7.match_l7(source, entries)
    got = l7.window_matches(told)
    assert same(got.select(*want.columns), want) and want.count() > 50
    each = l7.packet_matches(told)
    assert each.count() == source.count() and each.filter("pkt_id = 900").first().namespace == "e900"
    assert each.filter("pkt_id = 901").first().matched is False and each.filter("pkt_id = 902").first().matched is False
    assert got.filter("src_ip = '10.0.0.6'").first().l7.namespace == "e901"


def test_idle_conversations_leave_the_state(spark, tmp_path):
    from flowloom.streaming.keyed import state_store

    held = {}
    for name, idle in (("kept", None), ("short", 20.0)):
        path = str(tmp_path / f"in-{name}")
        for i in range(5):
            rows = spark.range(10).selectExpr(f"{i} * 100 + id AS pkt_id", "'h' AS host", f"CAST(({i} * 60 + 1) AS BIGINT) * 1000000000 AS ts_ns", f"concat('10.{i}.0.', id) AS src_ip", "'b' AS dst_ip", "1 AS src_port", "2 AS dst_port", "6 AS protocol", "id AS tcp_seq", "CAST(100 AS BIGINT) AS packet_size")
            rows = packets.conform(rows, S.PACKETS)
            rows.coalesce(1).write.mode("append").parquet(path)
        end_marker(rows, 200).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
        with state_store(spark):
            query = wide.closed_windows(stream, idle_s=idle).writeStream.format("parquet").option("path", str(tmp_path / f"out-{name}")).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
            query.awaitTermination()
        assert spark.read.parquet(str(tmp_path / f"out-{name}")).count() == 50
        held[name] = sum(op["numRowsTotal"] for op in query.recentProgress[-1]["stateOperators"])
    assert held["short"] < held["kept"]
