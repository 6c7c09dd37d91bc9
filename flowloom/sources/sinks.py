"""Writers of feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flowloom.operators.packets import conform


def write_features(
    features: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> bool:
    """Write conformed feature rows; tells whether there was anything to write.

    ``csv`` gives header lines, ``parquet`` snappy files, both as a directory of parts.  Rows are counted
    while they are written; the output of an empty table is removed again.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError("fmt is 'csv' or 'parquet'")
    seen = Observation()
    writer = conform(features).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("emptyValue", "").csv(path)
    else:
        writer.option("compression", "snappy").parquet(path)
    if seen.get["rows"]:
        return True
    if mode in ("errorifexists", "error", "overwrite"):
        spark = features.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return False
