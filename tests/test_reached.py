"""Options and paths that the registered queries do not reach."""

import pytest
from pyspark.sql import functions as F

from checks.fixtures import table
from flowloom import schema as S
from flowloom.functions import sized
from flowloom.operators import extra, flood, host, mlprep

W = 5_000_000_000


def test_counters_that_went_backwards(spark):
    rows = [("h", w * W, "a", 2, periods, throttled, throttled * 1000) for w, periods, throttled in ((0, 10, 4), (1, 30, 14), (2, 5, 1))]
    samples = spark.createDataFrame(rows, S.CGROUP_SAMPLES)
    read = lambda **kw: [tuple(r)[2:] for r in host.cpu_throttling(samples, **kw).orderBy("window_id").collect()]
    assert read() == [(10, 4, 4.0, 0.4), (20, 10, 10.0, 0.5), (-25, -13, -13.0, 0.0)]
    assert read(on_reset="clip") == [(10, 4, 4.0, 0.4), (20, 10, 10.0, 0.5), (0, 0, 0.0, 0.0)]
    with pytest.raises(ValueError):
        read(on_reset="wrap")


def test_blocked_source_without_a_count(spark):
    blocked = spark.createDataFrame([("h", "10.0.0.1", 7 * W, 1, None), ("h", "10.0.0.2", 7 * W, 2, 40)], "host string, src_ip string, block_ts bigint, block_id bigint, packet_count bigint")
    rows = {r.src_ip: (r.packet_count, r.syn_count) for r in flood.blocked_rows(blocked).collect()}
    assert rows == {"10.0.0.1": (5000, 5000), "10.0.0.2": (40, 40)}


def test_completion_time_of_whole_flows(spark, sf):
    packets = table(spark, sf, "packets")
    features = packets.select(*S.FLOW).distinct().crossJoin(spark.range(2).withColumnRenamed("id", "window_id"))
    got = {tuple(r)[:-1]: r.flow_completion_time for r in extra.with_completion(features, packets).drop("window_id").collect()}
    want: dict = {}
    for r in packets.select(*S.FLOW, "ts_ns").collect():
        want.setdefault(tuple(r)[:-1], []).append(r.ts_ns)
    assert got == {k: (max(v) - min(v)) / 1e9 for k, v in want.items()}


def test_class_weights_on_rows(spark):
    features = spark.range(12).selectExpr("id AS flow_id", "CASE WHEN id < 9 THEN 0 WHEN id < 11 THEN 1 ELSE NULL END AS anomaly_label")
    rows = mlprep.with_class_weights(features.filter("anomaly_label IS NOT NULL")).collect()
    assert len(rows) == 11 and {(r.anomaly_label, r.weight) for r in rows} == {(0, 11 / 18), (1, 11 / 4)}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_broadcast(spark, how):
    """A lookup above the limit: one key holds most rows, some have no entry, some entries no rows."""
    big = spark.range(500).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id % 7 ELSE 100 END AS k")
    lookup = spark.createDataFrame([(k, k * 10) for k in (0, 1, 2, 3, 100, 200)], "k bigint, v bigint")
    small, salted = (sized.lookup_join(big, lookup, ["k"], ["id"], how, limit) for limit in (10, 2))
    assert "_salt" in salted._jdf.queryExecution().analyzed().toString() and sorted(map(tuple, small.collect())) == sorted(map(tuple, salted.collect()))
    assert small.filter(F.col("v").isNotNull()).count() > 300
