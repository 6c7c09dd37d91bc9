"""Flow windows of a stream as mergeable partials, so that a late packet costs one merge.

Each micro-batch leaves one partial per flow and window in a table.  A window's row is the merge of its partials: once
when the window closes, and again only if a partial came later.  Partials of closed windows are a partition of their
own, so finding late packets reads these alone, and mending reads the partials of their windows, never the packets.

Below the sink's folder lie ``partials`` (by batch, lateness and block of windows), ``rows`` (closed windows by batch)
and ``marks`` (the newest time by batch).  A replayed batch overwrites its folders and looks at earlier batches only, so
a restart doubles nothing.  A partial holds the sorted times of its packets; feed streams that passed the flood gate,
which bounds them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.functions.scalar import idiv, size_ns, window_id
from flowloom.streaming.flows import core_numbers, core_rows

KEYS = [*S.FLOW, "window_id"]
SUMS = ["packet_count", "byte_count", "syn_ack_count", "half_open_connections", "fin_count", "rst_count", "zero_window_count"]
#: Windows per partition of the table of partials.
BLOCK = 64
#: Files a batch adds to one block at most, however many tasks it has.
FILES = 4


def partials_of(packets: DataFrame, size_s: float = 5.0) -> DataFrame:
    """One partial per flow and window of a batch; ``last_ns`` is the newest time of any packet in it."""
    numbers = [*core_numbers(), F.max("ts_ns").alias("last_ns")]
    return packets.withColumn("window_id", window_id("ts_ns", size_s)).groupBy(*KEYS).agg(*numbers)


def merged(partials: DataFrame) -> DataFrame:
    """One partial per flow and window from any number of them."""
    return partials.groupBy(*KEYS).agg(
        *[F.sum(name).alias(name) for name in SUMS],
        F.sort_array(F.flatten(F.collect_list("_times"))).alias("_times"),
        F.min("ttl_min").alias("ttl_min"),
    )


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The stored partials, with ``batch_id``, ``late`` (0 or 1) and ``block``."""
    empty = spark.createDataFrame([], S.PACKETS)
    fields = partials_of(empty).selectExpr("*", "0L AS batch_id", "0 AS late", "0L AS block").schema
    return spark.read.schema(fields).parquet(f"{path}/partials")


def first_open(spark: SparkSession, path: str, batch_id: int | None = None, size_s: float = 5.0, late_s: float | None = None) -> int | None:
    """The first window still open before ``batch_id``, or after all batches; None while nothing came."""
    marks = spark.read.schema("newest bigint, batch_id bigint").parquet(f"{path}/marks")
    seen = marks if batch_id is None else marks.filter(F.col("batch_id") < batch_id)
    newest = seen.agg(F.max("newest")).first()[0]
    return None if newest is None else (newest - size_ns(size_s if late_s is None else late_s)) // size_ns(size_s)


def partials_sink(spark: SparkSession, path: str, size_s: float = 5.0, late_s: float | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores the partials of a batch and the rows of the windows it closes.

    A window closes once a packet ``late_s`` seconds (one window, if None) past its end was seen.
    """
    spark.range(1).selectExpr("CAST(NULL AS bigint) AS newest").write.mode("overwrite").parquet(f"{path}/marks/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = first_open(session, path, batch_id, size_s, late_s)
        late = F.lit(0) if before is None else (F.col("window_id") < before).cast("int")
        placed = partials_of(batch, size_s).withColumns({"late": late, "block": idiv("window_id", BLOCK)})
        placed = placed.repartition("late", "block", F.pmod(F.xxhash64(*S.FLOW), F.lit(FILES)))
        placed.write.mode("overwrite").partitionBy("late", "block").parquet(f"{path}/partials/batch_id={batch_id}")
        stored = read_partials(session, path).filter(F.col("batch_id") <= batch_id)
        newest = stored.filter(F.col("batch_id") == batch_id).agg(F.max("last_ns").alias("newest"))
        newest.write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")
        after = first_open(session, path, batch_id + 1, size_s, late_s)
        closing = between(stored, before, after) if after is not None else stored.limit(0)
        core_rows(merged(closing), size_s).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    return write


def between(partials: DataFrame, first: int | None, end: int | None) -> DataFrame:
    """The partials of windows from ``first`` up to, not including, ``end``; other blocks are not read."""
    window, block = F.col("window_id"), F.col("block")
    if first is not None:
        partials = partials.filter((window >= first) & (block >= first // BLOCK))
    return partials if end is None else partials.filter((window < end) & (block <= end // BLOCK))


def closed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of closed windows as they were when they closed."""
    fields = core_rows(merged(partials_of(spark.createDataFrame([], S.PACKETS)))).schema
    return spark.read.schema(fields).parquet(f"{path}/rows").select(*fields.names)


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per flow and window: ``late``, the valid packets that came after it had closed.  Reads late partials only."""
    late = read_partials(spark, path).filter("late = 1").groupBy(*KEYS).agg(F.sum("packet_count").alias("late"))
    return late.filter("late > 0")


def repaired_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of closed windows, with the late packets merged into theirs; windows only late packets fell in are added."""
    stored = read_partials(spark, path)
    late = stored.filter("late = 1").select(*KEYS, "block").distinct()
    again = merged(stored.join(late, [*KEYS, "block"], "left_semi"))
    return closed_rows(spark, path).join(late.select(*KEYS), KEYS, "left_anti").unionByName(core_rows(again))


def open_rows(spark: SparkSession, path: str, size_s: float = 5.0, late_s: float | None = None) -> DataFrame:
    """The rows of the windows a stopped stream still held open."""
    return core_rows(merged(between(read_partials(spark, path), first_open(spark, path, None, size_s, late_s), None)), size_s)
