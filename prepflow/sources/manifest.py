"""What a stage wrote: one row per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_manifest(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, MD5 and size of every file below ``folder``.

    Each file is hashed inside the task that reads it. The binary source refuses
    files over 2 GB: write with ``max_rows_per_file``, or use ``row_fingerprint``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    return files.select(
        "path",
        F.md5("content").alias("md5"),
        F.col("length").alias("bytes"),
        size_text(F.col("length")).alias("size"),
    )


def size_text(length):
    return F.concat(F.format_string("%.2f", length / F.lit(1024.0 * 1024.0)), F.lit(" MB"))


def row_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and a checksum of the content that ignores row order and files."""
    return df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("h"), F.lit(0)).alias("checksum")
    )
