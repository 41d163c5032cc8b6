"""S6/S7/S8 — table sinks, build-once caching and model persistence."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> str:
    """Write parquet (optionally partitioned) or CSV with a header."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def load_or_build(
    spark: SparkSession,
    path: str,
    builder: Callable[[], DataFrame],
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """Read ``path`` if it exists (Hadoop FS test), else build, write and re-read it."""
    if not _fs_exists(spark, path):
        write_table(builder(), path, partition_by=partition_by)
    return spark.read.parquet(path)
