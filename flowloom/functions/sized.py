"""Results stored once in shared storage, and joins that leave the choice of strategy to measured file sizes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a side may have to be broadcast.
BROADCAST_ROWS = 100_000
#: Copies of the small side when it is too large to broadcast.
SALTS = 16


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="flowloom-")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stored intermediate tables.

    The session names it in ``spark.checkpoint.dir`` (or by ``setCheckpointDir``).  A folder of
    this machine is used only for a local master, where all tasks see it; on a cluster a missing
    setting is an error, because executors would write to their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


def scratch_path(spark: SparkSession) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/flowloom/{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, store it as Parquet in the shared folder and read it from there.

    Cuts the lineage, survives lost executors, keeps columns and statistics, and gives later
    joins a measured size.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_bucketed(df: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Compute ``df`` once and store it in buckets of ``keys``, sorted by them and ``order``, in the shared folder.

    Windows, groups and joins over these keys, or more columns, read it without a shuffle.  Rows of one key share a
    bucket, so ``keys`` must be fine enough that no single one is large.  ``buckets`` is the session's number of shuffle partitions.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"flowloom_{uuid.uuid4().hex}"
    rows = df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys, *order)
    rows.option("path", scratch_path(spark)).format("parquet").saveAsTable(name)
    return spark.table(name)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Store a lookup once and tell whether it is small enough to broadcast."""
    kept = keep(df)
    return kept, kept.limit(limit + 1).count() <= limit


def lookup_join(
    big: DataFrame, lookup: DataFrame | tuple[DataFrame, bool], keys: Sequence[str], spread: Sequence[str], how: str = "left",
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a lookup with one row per key to a table where some keys are crowded.

    The lookup is stored and counted.  Up to ``limit`` rows it is broadcast and the big side
    is not moved.  Beyond that the big side is salted by ``spread`` and each lookup row is
    repeated once per salt, so one crowded key is shared by ``SALTS`` tasks.
    A pair from :func:`small_side` is taken as it is.
    """
    kept, small = lookup if isinstance(lookup, tuple) else small_side(lookup, limit)
    if small:
        return big.join(F.broadcast(kept), list(keys), how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    copies = kept.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
