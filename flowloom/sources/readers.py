"""Readers with fixed schemas; none of them infers types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom import schema as S
from flowloom.operators.l7 import parse_l7
from flowloom.operators.packets import conform


def _table(spark: SparkSession, path: str, schema: T.StructType, stream: bool, **options) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).schema(schema)
    return reader.options(**options).parquet(path)


def read_packets(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    return _table(spark, path, S.PACKETS, stream, **options)


def read_system_events(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    return _table(spark, path, S.SYSTEM_EVENTS, stream, **options)


def read_host_samples(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    return _table(spark, path, S.HOST_SAMPLES, stream, **options)


def read_process_samples(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    return _table(spark, path, S.PROCESS_SAMPLES, stream, **options)


def read_cgroup_samples(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    return _table(spark, path, S.CGROUP_SAMPLES, stream, **options)


def read_device_samples(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    return _table(spark, path, S.DEVICE_SAMPLES, stream, **options)


def read_l7_flows(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """Application flow records from JSON lines; lines that are no record are left out."""
    reader = spark.readStream if stream else spark.read
    return parse_l7(reader.options(**options).text(path))


def read_features(spark: SparkSession, path: str, layout: int = 94, fmt: str = "csv") -> DataFrame:
    """Feature rows of a 94-, 70- or 55-column file as the current 94 columns.

    Some writers print whole numbers as ``0.0``; those columns are read as decimals, which hold every
    64-bit value, and cast.
    """
    fields = S.LAYOUTS[layout]
    if fmt == "parquet":
        return conform(spark.read.parquet(path))
    whole = (T.LongType, T.IntegerType)
    lenient = T.StructType(
        [T.StructField(f.name, T.DecimalType(38, 6) if isinstance(f.dataType, whole) else f.dataType) for f in fields]
    )
    return conform(spark.read.schema(lenient).csv(path, header=True, enforceSchema=False))


def latest_run(spark: SparkSession, path: str, fmt: str = "csv") -> str | None:
    """Path of the newest run under ``path``, or None where there is none.

    A run is one file, or the folder of a run that was written in parts, with all its partitions.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}")
    files = reader.format("binaryFile").load(path).select("path", "modificationTime")
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()
    found = newest["path"]
    if found is None or not found.rpartition("/")[2].startswith("part-"):
        return found
    folder = found.rpartition("/")[0]
    while "=" in folder.rpartition("/")[2]:
        folder = folder.rpartition("/")[0]
    return folder
