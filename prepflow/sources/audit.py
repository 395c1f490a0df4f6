"""Run audit: one appended record per finished stage."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("error", T.StringType()),
        T.StructField("updated", T.TimestampType()),
    ]
)


def append_audit(
    spark: SparkSession,
    path: str,
    run: str,
    stage: str,
    status: str,
    params: dict | None = None,
    metrics: dict | None = None,
    error: str | None = None,
) -> None:
    record = (
        run,
        stage,
        status,
        {str(k): str(v) for k, v in (params or {}).items()},
        {str(k): float(v) for k, v in (metrics or {}).items()},
        error,
        datetime.now(timezone.utc),
    )
    spark.createDataFrame([record], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)
