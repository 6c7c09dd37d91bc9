"""Host metrics per window from raw counter samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.ordered import FAN, last_before, running_total
from flowloom.functions.scalar import idiv, ratio, window_id
from flowloom.functions.sized import lookup_join

KEY = ["host", "window_id"]
RAW_DISK = ["disk_read_count", "disk_write_count", "disk_read_time_ms", "disk_write_time_ms"]
MB = 1024 * 1024


def _latest(df: DataFrame, size_s: float) -> DataFrame:
    """Rows of the last sampling instant of each host and window."""
    at = df.withColumn("window_id", window_id(size_s=size_s))
    last = at.groupBy(*KEY).agg(F.max("ts_ns").alias("ts_ns"))
    return at.join(last, [*KEY, "ts_ns"], "left_semi")


def top_processes(processes: DataFrame, size_s: float = 5.0, n: int = 3) -> DataFrame:
    """Text naming the ``n`` busiest processes per host and window, and the zombie count.

    Ties go to the smaller name, then pid.  Idle processes are left out of the text.
    """
    last = _latest(processes, size_s)
    zombies = last.groupBy(*KEY).agg(F.count(F.when(F.col("status") == "zombie", 1)).alias("process_exits"))
    order = Window.partitionBy(*KEY).orderBy(F.desc("cpu_percent"), "name", "pid")
    top = last.withColumn("_rank", F.row_number().over(order)).filter((F.col("_rank") <= n) & (F.col("cpu_percent") > 0))
    label = F.format_string("%s(%.1f%%)", F.col("name"), F.bround("cpu_percent", 1))
    named = F.transform(F.array_sort(F.collect_list(F.struct("_rank", label.alias("label")))), lambda x: x["label"])
    text = top.groupBy(*KEY).agg(F.array_join(named, ",").alias("process_cpu_top3"))
    return zombies.join(text, KEY, "left").withColumn("process_cpu_top3", F.coalesce("process_cpu_top3", F.lit("idle")))


def cgroup_totals(cgroups: DataFrame, size_s: float = 5.0) -> DataFrame:
    """Scheduler counters summed over control groups, at the last instant of each window."""
    usec = F.when(F.col("version") == 1, F.col("throttled") / 1000).otherwise(F.col("throttled").cast("double"))
    return (
        _latest(cgroups, size_s)
        .groupBy(*KEY)
        .agg(F.sum("nr_periods").alias("_periods"), F.sum("nr_throttled").alias("_throttled"), F.sum(usec).alias("_usec"))
    )


def cpu_throttling(cgroups: DataFrame, size_s: float = 5.0, on_reset: str = "raw") -> DataFrame:
    """Change of the scheduler counters since the host's previous window.

    The first window counts from zero.  A counter that went backwards gives a negative change,
    or zero with ``on_reset='clip'``.
    """
    if on_reset not in ("raw", "clip"):
        raise ValueError("on_reset is 'raw' or 'clip'")
    totals = cgroup_totals(cgroups, size_s).withColumn("_block", idiv("window_id", FAN))
    held = {"_before": F.struct("_periods", "_throttled", "_usec")}
    seen = last_before(totals, ["host"], "_block", ["window_id"], held)

    def change(name: str) -> Column:
        delta = F.col(name) - F.coalesce(F.col(f"_before.{name}"), F.lit(0))
        return F.greatest(delta, F.lit(0)) if on_reset == "clip" else delta

    periods, throttled = change("_periods"), change("_throttled")
    return seen.select(
        *KEY,
        periods.cast("long").alias("cpu_nr_periods"),
        throttled.cast("long").alias("cpu_nr_throttled"),
        (change("_usec") / 1000).alias("cpu_throttled_time_ms"),
        F.when(periods > 0, ratio(throttled, periods)).otherwise(F.lit(0.0)).alias("cpu_throttle_ratio"),
    )


def queue_depth(devices: DataFrame, size_s: float = 5.0) -> DataFrame:
    """Requests in flight over all block devices but loop devices."""
    real = devices.filter(~F.col("device").startswith("loop"))
    depth = F.sum(F.col("inflight_read") + F.col("inflight_write")).cast("long")
    return _latest(real, size_s).groupBy(*KEY).agg(depth.alias("disk_queue_depth"))


def oom_kills(events: DataFrame, windows: DataFrame, size_s: float = 5.0) -> DataFrame:
    """Out-of-memory kills of a host so far, for each of ``windows`` (host, window_id)."""
    kills = (
        events.filter((F.col("event_type") == 2) & (F.col("oom_score") > 0))
        .groupBy("host", window_id(size_s=size_s).alias("window_id"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_asked", F.lit(0))
    )
    asked = windows.select(*KEY, F.lit(0).cast("long").alias("_n"), F.lit(1).alias("_asked"))
    both = kills.unionByName(asked).groupBy(*KEY).agg(F.sum("_n").alias("_n"), F.max("_asked").alias("_asked"))
    blocked = both.withColumn("_block", idiv("window_id", FAN))
    total = running_total(blocked, ["host"], "_block", ["window_id"], {"oom_kill_count": F.col("_n")})
    return total.filter(F.col("_asked") == 1).select(*KEY, "oom_kill_count")


def host_features(
    samples: DataFrame,
    processes: DataFrame | None = None,
    cgroups: DataFrame | None = None,
    devices: DataFrame | None = None,
    events: DataFrame | None = None,
    size_s: float = 5.0,
    on_reset: str = "raw",
) -> DataFrame:
    """One row per host and window with the 23 host features.

    Gauges and cumulative counters are those of the window's last sample.  Sources that are
    not given count as idle.
    """
    names = [n for n in S.HOST_SAMPLES.names if n not in ("host", "ts_ns")]
    last = (
        samples.withColumn("window_id", window_id(size_s=size_s))
        .groupBy(*KEY)
        .agg(F.max_by(F.struct(*names), "ts_ns").alias("_s"))
        .select(*KEY, "_s.*")
    )
    out = last
    if processes is not None:
        out = out.join(top_processes(processes, size_s), KEY, "left")
    if cgroups is not None:
        out = out.join(cpu_throttling(cgroups, size_s, on_reset), KEY, "left")
    if devices is not None:
        out = out.join(queue_depth(devices, size_s), KEY, "left")
    if events is not None:
        out = out.join(oom_kills(events, last.select(*KEY), size_s), KEY, "left")
    have = set(out.columns)
    given = lambda name, default: F.coalesce(F.col(name), default) if name in have else default
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    spent = (F.col("disk_read_time_ms") + F.col("disk_write_time_ms")) * 1000
    out = out.withColumns(
        {
            "cpu_usage_percent": F.col("cpu_percent"),
            "process_cpu_top3": given("process_cpu_top3", F.lit("idle")),
            "cpu_nr_periods": given("cpu_nr_periods", zero),
            "cpu_nr_throttled": given("cpu_nr_throttled", zero),
            "cpu_throttled_time_ms": given("cpu_throttled_time_ms", none),
            "cpu_throttle_ratio": given("cpu_throttle_ratio", none),
            "memory_usage_percent": F.col("mem_percent"),
            "memory_available_mb": F.col("mem_available_bytes") / MB,
            "swap_usage_percent": F.col("swap_percent"),
            "oom_kill_count": given("oom_kill_count", zero),
            "disk_read_mb": F.col("disk_read_bytes") / MB,
            "disk_write_mb": F.col("disk_write_bytes") / MB,
            "disk_avg_latency_us": ratio(spent, F.col("disk_read_count") + F.col("disk_write_count")),
            "disk_queue_depth": given("disk_queue_depth", zero),
            "tcp_listen_overflows": F.coalesce("listen_overflows", zero),
            "tcp_listen_drops": F.coalesce("listen_drops", zero),
            "process_exits": given("process_exits", zero),
        }
    )
    return out.withColumns({name: over.cast("int") for name, over in host_flags().items()}).select(
        *KEY, *S.HOST_FEATURES, *RAW_DISK
    )


def host_flags() -> dict[str, Column]:
    """Saturation flags and the limits they stand for."""
    # 10 ms, 80 %, 10 %, 90 %, 10 %, 10 requests.
    return {
        "high_io_latency": F.col("disk_avg_latency_us") > 10_000,
        "cpu_contention": F.col("cpu_usage_percent") > 80,
        "cpu_throttled": F.col("cpu_throttle_ratio") > 0.1,
        "memory_critical": F.col("memory_usage_percent") > 90,
        "swap_active": F.col("swap_usage_percent") > 10,
        "disk_saturated": F.col("disk_queue_depth") > 10,
    }


def join_host(flows: DataFrame, host: DataFrame | tuple[DataFrame, bool]) -> DataFrame:
    """Attach the host's metrics of the window to every flow of it."""
    return lookup_join(flows, host, KEY, spread=["src_ip", "src_port", "dst_ip", "dst_port"])
