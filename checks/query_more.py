"""Registered queries of DNS, layer-7, host, fault, report and training-set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import table
from checks.oracle_more import CORR, SCALED
from checks.query_flows import annotated, packets, rounded
from flowloom import schema as S
from flowloom.functions.sized import keep, scratch_path, small_side
from flowloom.operators import detect, dns, extra, flood, host, l7, mlprep, report
from flowloom.operators import packets as pk
from flowloom.operators.flows import GROUP, flow_features
from flowloom.plans import pipeline
from flowloom.sources import readers, sinks

THRESHOLD = 12
_DIGITS = {"zero_window_duration": 9, "handshake_latency": 9}


def records(spark: SparkSession, sf: str) -> DataFrame:
    return l7.parse_l7(table(spark, sf, "l7_lines"))


def host_windows(spark: SparkSession, sf: str) -> DataFrame:
    names = ["host_samples", "process_samples", "cgroup_samples", "device_samples", "system_events"]
    return rounded(host.host_features(*[table(spark, sf, n) for n in names]))


def flow_features_94(spark: SparkSession, sf: str) -> DataFrame:
    """The whole pipeline, computed anew."""
    settings = pipeline.Settings(threshold=THRESHOLD)
    return rounded(
        pipeline.build_features(packets(spark, sf), records(spark, sf), host_windows(spark, sf), settings), _DIGITS
    )


_STORED: dict[tuple[str, str], DataFrame] = {}


def features(spark: SparkSession, sf: str) -> DataFrame:
    """The stored feature table that reports and training operators read, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        _STORED[key] = keep(flow_features_94(spark, sf))
    return _STORED[key]


def ruled(spark: SparkSession, sf: str) -> DataFrame:
    return detect.detect_faults(features(spark, sf))


def dns_latency(spark, sf):
    return rounded(dns.dns_latency(dns.dns_match(annotated(spark, sf))))


def _extra(*names: str, **digits: int):
    def run(spark, sf):
        return rounded(extra.extra_packet_stats(annotated(spark, sf)).select(*GROUP, *names), digits)

    return run


def nat_alias(spark, sf):
    return l7.nat_expand(l7.nat_carry(keep(records(spark, sf)))).select(*S.FLOW, "ts_ns", "rec_id", "has_l7")


def nat_carry(spark, sf):
    return l7.nat_carry(keep(records(spark, sf))).select("rec_id", "src_ip", "dst_ip", "src_xlated", "dst_xlated")


def l7_asof(spark, sf):
    source = annotated(spark, sf)
    entries = l7.l7_entries(table(spark, sf, "l7_lines"))
    return l7.enrich_l7(flow_features(source).select(*GROUP), source, entries)


def fault_rules(spark, sf):
    flags = [f"is_{name}" for label, name in detect.FAULTS.items() if label]
    out = ruled(spark, sf).withColumn("fault_labels", F.concat_ws(",", F.col("fault_labels").cast("array<string>")))
    return out.select("timestamp", "flow_id", "src_ip", *flags, "fault_labels", "rule_label", "normal_profile")


def flood_summary(spark, sf):
    source = packets(spark, sf)
    blocklist = small_side(flood.flood_blocklist(source, THRESHOLD))
    let_through = pk.gate_protocols(flood.passed(flood.mark_dropped(source, blocklist)))
    return report.flood_summary(flood.syn_cumulative(let_through), blocklist[0])


def label_balance(spark, sf):
    return report.label_balance(ruled(spark, sf).withColumn("anomaly_label", F.col("rule_label")))


def periodic_status(spark, sf):
    flow_rows = features(spark, sf).filter("dst_ip <> '0.0.0.0'")
    return rounded(report.periodic_status(flow_rows, flood.flood_blocklist(packets(spark, sf), THRESHOLD)))


def _read_back(name: str, read):
    """A derived table written as files and read by its own reader."""

    def run(spark, sf):
        path = scratch_path(spark)
        table(spark, sf, name).repartition(3).write.parquet(path)
        return read(spark, path)

    return run


def feature_information(spark, sf):
    return rounded(mlprep.feature_information(ruled(spark, sf), CORR, "rule_label"))


def forest_importances(spark, sf):
    return mlprep.forest_importances(ruled(spark, sf), CORR, "rule_label")


def baseline_folds(spark, sf):
    folds = mlprep.stratified_folds(ruled(spark, sf), 3, "rule_label")
    return mlprep.baseline_by_fold(keep(folds.select("fold", "rule_label", *CORR)), CORR, "rule_label", 3)


def _scaled(method: str):
    def run(spark, sf):
        source = features(spark, sf).select("timestamp", "flow_id", "src_ip", *SCALED)
        return rounded(mlprep.scale(source, SCALED, method))

    return run


def kfold(spark, sf):
    folds = mlprep.stratified_folds(ruled(spark, sf), 5, "rule_label")
    return folds.select("host", "window_id", "flow_id", "timestamp", "rule_label", "fold")


def sequences(spark, sf):
    seqs = mlprep.sequences(features(spark, sf), ["packet_count", "retransmission_count"], 5, carry=["flow_id"])
    text = lambda c: F.concat_ws(",", F.col(c).cast("array<string>")).alias(c)
    return seqs.select("host", "flow_id", "window_id", text("packet_count_seq"), text("retransmission_count_seq"))


def _sink(fmt: str):
    """Feature rows written to files and read back."""

    def run(spark, sf):
        path = scratch_path(spark)
        sinks.write_features(features(spark, sf), path, fmt)
        return readers.read_features(spark, path, fmt=fmt)

    return run


def newest_run(spark, sf):
    """Two runs in one folder, the second written in parts: the newest one is read whole."""
    path = scratch_path(spark)
    rows = features(spark, sf)
    sinks.write_features(rows.limit(1), f"{path}/a", "parquet")
    parts = rows.repartition(max(3, spark.sparkContext.defaultParallelism))
    sinks.write_features(parts, f"{path}/b", "parquet", ["anomaly_label"])
    found = readers.read_features(spark, readers.latest_run(spark, path, "parquet"), fmt="parquet")
    return found.agg(F.count("*").alias("rows"), F.sum("packet_count").alias("packets"))


def dedup_interfaces(spark, sf):
    """Every fifth packet is seen again by the next interface 0.4 ms later, and again after 5 ms."""
    source = packets(spark, sf)
    again = source.filter("pkt_id % 5 = 0").withColumns({"ifindex": F.col("ifindex") + 1, "ts_ns": F.col("ts_ns") + 400_000})
    later = again.withColumn("ts_ns", F.col("ts_ns") + 5_000_000)
    return pk.dedup_interfaces(source.unionByName(again).unionByName(later)).select("pkt_id", "ts_ns", "ifindex")


def bounded_run(spark, sf):
    return pk.time_range(packets(spark, sf), duration_s=60).select("pkt_id", "ts_ns")


def merge_runs(spark, sf):
    rows = features(spark, sf)
    return (
        pipeline.merge_runs({"first": rows, "second": rows})
        .groupBy("run_id", "anomaly_label")
        .agg(F.count("*").alias("rows"), F.sum("packet_count").alias("packets"))
    )


QUERIES = {
    "dns_match": lambda spark, sf: dns.dns_match(annotated(spark, sf)),
    "dns_latency": dns_latency,
    "rtt": lambda spark, sf: rounded(dns.rtt(annotated(spark, sf)), {"rtt_estimate_ms": 5, "rtt_variance": 3}),
    "bidirectional": lambda spark, sf: extra.directional_features(annotated(spark, sf)),
    "packet_size_stats": _extra(
        "ack_count", "urg_count", "ece_count", "cwr_count", "min_packet_size", "max_packet_size", "packet_size_variance",
        "flow_duration", packet_size_variance=4, flow_duration=9,
    ),
    "jitter_variance": _extra("latency_mean_ms", "latency_std_ms", "jitter_variance", jitter_variance=3),
    "goodput": _extra("goodput_mbps", "overhead_ratio"),
    "flow_completion": lambda spark, sf: rounded(extra.flow_completion(packets(spark, sf))),
    "dup_acks": lambda spark, sf: extra.dup_acks(annotated(spark, sf)),
    "host_window": host_windows,
    "host_top3": lambda spark, sf: host.top_processes(table(spark, sf, "process_samples")),
    "backlog_growth": lambda spark, sf: detect.backlog_growth(host_windows(spark, sf)),
    "l7_parse": records,
    "l7_parse_native": lambda spark, sf: l7.parse_l7(table(spark, sf, "l7_native_lines")),
    "l7_untimed": lambda spark, sf: l7.untimed(l7.parse_l7(table(spark, sf, "l7_native_lines"))),
    "nat_carry": nat_carry,
    "nat_alias": nat_alias,
    "l7_merge": lambda spark, sf: l7.l7_entries(table(spark, sf, "l7_lines")),
    "l7_asof": l7_asof,
    "flow_features": flow_features_94,
    "fault_rules": fault_rules,
    "label_confusion": lambda spark, sf: detect.label_confusion(ruled(spark, sf)),
    "run_summary": lambda spark, sf: report.run_summary(features(spark, sf)),
    "retransmission_rows": lambda spark, sf: report.retransmission_rows(features(spark, sf)),
    "preview": lambda spark, sf: pk.preview(features(spark, sf)),
    "flood_summary": flood_summary,
    "label_balance": label_balance,
    "scale_features": _scaled("standard"),
    "scale_minmax": _scaled("minmax"),
    "class_weights": lambda spark, sf: rounded(mlprep.class_weights(ruled(spark, sf), "rule_label")),
    "kfold": kfold,
    "sequences": sequences,
    "feature_corr": lambda spark, sf: rounded(mlprep.feature_corr(ruled(spark, sf), CORR, "rule_label")),
    "feature_information": feature_information,
    "forest_importances": forest_importances,
    "baseline_folds": baseline_folds,
    "periodic_status": periodic_status,
    "read_system_events": _read_back("system_events", readers.read_system_events),
    "read_host_samples": _read_back("host_samples", readers.read_host_samples),
    "read_process_samples": _read_back("process_samples", readers.read_process_samples),
    "read_cgroup_samples": _read_back("cgroup_samples", readers.read_cgroup_samples),
    "read_device_samples": _read_back("device_samples", readers.read_device_samples),
    "merge_runs": merge_runs,
    "sink_csv": _sink("csv"),
    "sink_parquet": _sink("parquet"),
    "newest_run": newest_run,
    "dedup_interfaces": dedup_interfaces,
    "bounded_run": bounded_run,
}
