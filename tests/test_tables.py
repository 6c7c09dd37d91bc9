"""Readers, writers, layouts, rules, reports and the pipeline's edges."""

import hashlib
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.scalar import flow_id, idiv, ip_to_long, long_to_ip, window_id
from flowloom.operators import detect, mlprep, packets, report
from flowloom.plans import pipeline
from flowloom.sources import readers, sinks



def write_sample(path: Path, rows: int = 12) -> Path:
    """A 70-column file as older writers leave it: whole numbers as ``1.0``, a quoted list of processes."""
    lines = [",".join(S.LAYOUTS[70].names)]
    for i in range(rows):
        ends = ("10.0.0.1", 40000 + i, "10.0.1.2", 80, 6)
        n, size, syn, ack = 3 + i, 100 * (3 + i), 2 * i, i % 3
        own = {
            "timestamp": f"{1_700_000_000 + i}.0", "flow_id": hashlib.md5("{}:{}->{}:{}:{}".format(*ends).encode()).hexdigest()[:8],
            "src_ip": ends[0], "dst_ip": ends[2], "src_port": ends[1], "dst_port": ends[3], "protocol": ends[4], "packet_count": f"{n}.0",
            "byte_count": 2**53 + 1 + size, "packets_per_second": n / 0.1, "bytes_per_second": size / 0.1, "avg_packet_size": size / n,
            "syn_count": syn, "syn_ack_count": ack, "syn_to_synack_ratio": syn / ack if ack else syn, "connection_duration": 0.1,
            "verdict": "FORWARDED", "process_cpu_top3": '"a:1.0%, b:0.5%, c:0.1%"', "connection_state": "NEW",
        }
        text = {f.name for f in S.LAYOUTS[70].fields if f.dataType.simpleString() == "string"}
        lines.append(",".join(str(own.get(c, "" if c in text else 0)) for c in S.LAYOUTS[70].names))
    path.write_text("\n".join(lines) + "\n")
    return path


@pytest.fixture(scope="session")
def sample(tmp_path_factory):
    return write_sample(tmp_path_factory.mktemp("sample") / "features_70.csv")



def feature_rows(spark, rows):
    """Conformed feature rows from dictionaries; names left out get their defaults."""
    defaults = {f.name: "" if f.dataType.simpleString() == "string" else 0 for f in S.FEATURES.fields}
    doubles = {f.name for f in S.FEATURES.fields if f.dataType.simpleString() == "double"}
    full = [{**defaults, **r} for r in rows]
    return spark.createDataFrame(
        [tuple(float(r[n]) if n in doubles else r[n] for n in S.FEATURES.names) for r in full], S.FEATURES
    )


def test_layouts_have_94_70_and_55_columns():
    assert {n: len(s.names) for n, s in S.LAYOUTS.items()} == {94: 94, 70: 70, 55: 55}
    assert len(set(S.FEATURES.names)) == 94
    assert S.HOST_FEATURES[0] == "cpu_usage_percent" and S.HOST_FEATURES[-1] == "disk_saturated"
    assert len(S.HOST_FEATURES) == 23


def test_sample_file_identities(spark, sample):
    df = readers.read_features(spark, str(sample), layout=70)
    assert df.count() == 12 and df.columns == S.FEATURES.names
    close = lambda a, b: F.abs(a - b) < 1e-6
    n, size = F.col("packet_count"), F.col("byte_count") - F.lit(2**53 + 1)
    ratio = F.when(F.col("syn_ack_count") > 0, F.col("syn_count") / F.col("syn_ack_count")).otherwise(F.col("syn_count"))
    checks = [
        flow_id() == F.col("flow_id"), close(F.col("packets_per_second"), n / 0.1),
        close(F.col("bytes_per_second"), size / 0.1), close(F.col("avg_packet_size"), size / n),
        close(F.col("syn_to_synack_ratio"), ratio), F.col("connection_duration") == 0.1,
        F.col("verdict") == "FORWARDED", F.col("latency_p50") == 0, size == n * 100,
    ]
    for check in checks:
        assert df.filter(check).count() == 12
    top = df.filter(F.col("process_cpu_top3").contains(",")).select("process_cpu_top3").first()
    assert top[0].count("%") == 3


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_write_and_read_back(spark, tmp_path, fmt, sample):
    df = readers.read_features(spark, str(sample), layout=70)
    path = str(tmp_path / "out")
    assert sinks.write_features(df, path, fmt)
    back = readers.read_features(spark, path, fmt=fmt)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    assert not sinks.write_features(df.limit(0), str(tmp_path / "none"), fmt)
    assert not (tmp_path / "none").exists()


def test_partitioned_write_and_latest_run(spark, tmp_path, sample):
    df = readers.read_features(spark, str(sample), layout=70)
    sinks.write_features(df, str(tmp_path / "p"), partition_by=["anomaly_label"])
    assert (tmp_path / "p" / "anomaly_label=0").exists()
    import os

    for i, name in enumerate(["a.csv", "c.csv", "b.csv"]):
        shutil.copyfile(sample, tmp_path / name)
        os.utime(tmp_path / name, (1_000_000 + i, 1_000_000 + i))
    assert readers.latest_run(spark, str(tmp_path)).endswith("/b.csv")
    newest = readers.latest_run(spark, str(tmp_path), "parquet")
    assert newest.endswith("/p") and readers.read_features(spark, newest, fmt="parquet").count() == 12


def test_packet_reader_batch_and_stream(spark, tmp_path, sf):
    from checks.fixtures import table

    table(spark, sf, "packets").write.parquet(str(tmp_path / "pk"))
    batch = readers.read_packets(spark, str(tmp_path / "pk"))
    assert batch.count() == 1000 and batch.columns == S.PACKETS.names
    assert readers.read_packets(spark, str(tmp_path / "pk"), stream=True).isStreaming
    table(spark, sf, "l7_lines").write.text(str(tmp_path / "l7"))
    assert readers.read_l7_flows(spark, str(tmp_path / "l7")).count() > 50
    plan = batch.filter(F.col("src_ip") == "x").select("ts_ns")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(src_ip), EqualTo(src_ip,x)]" in plan and "ReadSchema: struct<ts_ns:bigint,src_ip:string>" in plan


def test_scalar_functions(spark):
    row = spark.createDataFrame([("10.0.0.255", "10.0.0.256", -7)], "a string, b string, n bigint").select(
        ip_to_long("a").alias("a"), ip_to_long("b").alias("b"), long_to_ip(ip_to_long("a")).alias("t"),
        idiv("n", 5).alias("d"), window_id(F.lit(250_000_000), 0.1).alias("w"), flow_id(*[F.lit(x) for x in ("x", 1, "y", 2, 6)]).alias("f"),
    ).first()
    assert (row.a, row.b, row.t, row.d, row.w) == (167772415, None, "10.0.0.255", -2, 2)
    assert row.f == hashlib.md5(b"x:1->y:2:6").hexdigest()[:8]


@pytest.mark.parametrize("label,name,feature,op,limit", detect.RULES)
def test_rules_at_their_limits(spark, label, name, feature, op, limit):
    step = 1 if dict((f.name, f.dataType.simpleString()) for f in S.FEATURES.fields)[feature] != "double" else 0.01
    values = [limit - step, limit, limit + step]
    got = detect.detect_faults(feature_rows(spark, [{"timestamp": i, feature: v} for i, v in enumerate(values)]))
    fired = [r[f"is_{name}"] for r in got.orderBy("timestamp").collect()]
    assert fired == {">": [False, False, True], ">=": [False, True, True], "=": [False, True, False]}[op]


def test_two_rules_and_reports(spark):
    rows = [
        {"flow_id": "a", "retransmission_rate": 0.5, "retransmission_count": 3, "tcp_resets": 99, "anomaly_label": 2},
        {"flow_id": "b", "syn_to_synack_ratio": 1, "http_status_code": 200},
    ]
    got = {r.flow_id: r for r in detect.detect_faults(feature_rows(spark, rows)).collect()}
    assert got["a"].fault_labels == [2, 9] and got["a"].rule_label == 2 and not got["a"].normal_profile
    assert got["b"].fault_labels == [] and got["b"].rule_label == 0 and got["b"].normal_profile
    summary = report.run_summary(feature_rows(spark, rows)).first()
    assert tuple(summary) == (2, 1, 0.5)
    balance = {r.anomaly_label: (r.rows, r.missing) for r in report.label_balance(feature_rows(spark, rows)).collect()}
    assert balance[2] == (1, 99) and balance[11] == (0, 100) and len(balance) == 12


def test_sequences_and_folds_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(mlprep, "SEQUENCE_BLOCK", 8)
    ends = ["'a' AS src_ip", "1 AS src_port", "'b' AS dst_ip", "2 AS dst_port", "6 AS protocol", "'f' AS flow_id"]
    rows = spark.range(50).selectExpr("'h' AS host", *ends, "id AS window_id", "id AS packet_count", "id % 3 AS anomaly_label")
    for length in (4, 8, 9, 30):
        got = {r.window_id: r.packet_count_seq for r in mlprep.sequences(rows, ["packet_count"], length).collect()}
        assert got == {i: list(range(max(0, i - length + 1), i + 1)) for i in range(50)}
    two = rows.unionByName(rows.withColumns({"host": F.lit("g"), "packet_count": F.col("packet_count") + 1000}))
    for r in mlprep.sequences(two, ["packet_count"], 3).collect():
        assert {x >= 1000 for x in r.packet_count_seq} == {r.host == "g"}
    sizes = mlprep.stratified_folds(rows, 5).groupBy("anomaly_label", "fold").count().collect()
    assert {r["count"] for r in sizes} <= {3, 4} and len(sizes) == 15
    model = mlprep.fit_baseline(rows, ["packet_count"], trees=2)
    assert model.transform(rows).select("prediction").count() == 50


def test_running_totals_over_many_blocks(spark, monkeypatch):
    from flowloom.functions import ordered

    monkeypatch.setattr(ordered, "FAN", 3)
    rows = spark.range(40).selectExpr("'k' AS k", "id AS o", "id div 2 AS b", "id AS v")
    total = ordered.running_total(rows, ["k"], "b", ["o"], {"t": F.col("v")}, whole=True).collect()
    assert {r.o: (r.t, r.t_all) for r in total} == {i: (i * (i + 1) // 2, 780) for i in range(40)}
    seldom = {"p": F.when(F.col("o") % 11 == 0, F.col("o"))}
    before = ordered.last_before(rows, ["k"], "b", ["o"], seldom).collect()
    assert {r.o: r.p for r in before} == {i: (i - 1) // 11 * 11 if i else None for i in range(40)}


def test_pipeline_without_l7_and_host(spark, sf):
    from checks.fixtures import table

    source = table(spark, sf, "packets")
    rows = pipeline.build_features(source, settings=pipeline.Settings(threshold=10, label=3, filter_ip="10.0.0.2"))
    assert rows.columns == [*S.FEATURES.names, *pipeline.KEYS]
    got = rows.collect()
    assert {r.anomaly_label for r in got} == {3, 2}
    assert all("10.0.0.2" in (r.src_ip, r.dst_ip) for r in got if not r.dst_ip == "0.0.0.0")
    empty = pipeline.build_features(source.limit(0))
    assert empty.columns == [*S.FEATURES.names, *pipeline.KEYS] and empty.isEmpty()
    with pytest.raises(ValueError):
        pipeline.labelled(rows, 12)
    assert pipeline.Settings().max_rows is None and pipeline.Settings(threshold=10**6).max_rows


def test_time_range(spark):
    rows = spark.range(5).selectExpr("id * 1000000000 AS ts_ns")
    assert packets.time_range(rows, 10**9, 2).count() == 2 and packets.time_range(rows, None, 0).count() == 5
    late = rows.selectExpr("ts_ns + 1000000000000 AS ts_ns")
    assert packets.time_range(late).count() == 5 and packets.time_range(late, None, 2).count() == 2
    assert packets.time_range(rows.limit(0), None, 2).count() == 0


def test_remembered_against_brute_force(spark):
    """Two lines of one key over many blocks, pauses at, below and above the limit, rows without time or key."""
    import random

    from flowloom.functions.ordered import remembered, split_hot_groups

    draw, ttl, at, rows = random.Random(5), 3 * 10**9, 0, []
    for i in range(500):
        at += draw.choice([0, 1, 10**9, 10**9, 2 * 10**9, ttl, ttl + 1])
        rows.append((draw.choice("ab"), at, i, draw.randrange(2), draw.choice([None, None, None, f"v{i}"])))
    rows += [("a", None, 900, 0, "lost"), ("a", None, 901, 0, None), (None, 5, 902, 0, "x"), (None, 6, 903, 0, None)]
    source = spark.createDataFrame(rows, "k string, ts_ns long, id long, dir int, v string")
    want = {902: ("x", None), 903: ("x", None), 900: (None, None), 901: (None, None)}
    for k in "ab":
        state = {0: (None, None), 1: (None, None)}
        for _, t, i, d, v in (r for r in rows[:500] if r[0] == k):
            seen, kept = state[d]
            state[d] = (t, v or (kept if seen is not None and t - seen <= ttl else None))
            want[i] = tuple(kept if seen is not None and t - seen <= ttl else None for seen, kept in (state[0], state[1]))
    lines = [(F.col("dir") == d, {f"v{d}": F.col("v")}) for d in (0, 1)]
    for max_rows in (None, 5):
        cut, block = split_hot_groups(source, ["k"], 40.0, max_rows)
        got = remembered(cut, ["k"], block, ["ts_ns", "id"], ttl, lines).collect()
        assert block == ("slice_id" if max_rows else "window_id") and {r.id: (r.v0, r.v1) for r in got} == want


def test_newest_run_is_written_by_all_tasks(spark, tmp_path, monkeypatch):
    from checks import query_more

    monkeypatch.setattr(query_more, "features", lambda spark, sf: spark.range(400).selectExpr("id AS packet_count"))
    monkeypatch.setattr(query_more, "scratch_path", lambda _: str(tmp_path / "runs"))
    assert tuple(query_more.newest_run(spark, "").first()) == (400, 79_800)
    assert len(list((tmp_path / "runs" / "b" / "anomaly_label=0").glob("*.parquet"))) > 3
