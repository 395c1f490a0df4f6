"""Intermediate results written to the folder all executors share."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

_MADE: dict[str, set[str]] = {}

#: With it Spark deletes the shuffle files of a query when it has ended; nothing reads those of a written table again.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder in the warehouse, which all machines share too, where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return named.rstrip("/")


def clear_scratch(spark: SparkSession) -> int:
    """Deletes what this application has put into the scratch folder; frames made from it can't be read any more."""
    made = _MADE.pop(spark.sparkContext.applicationId, set())
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in made:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(made)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


@contextlib.contextmanager
def _without_shuffle_files(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst the true size,
    so that joins against it are broadcast exactly when it is small enough.
    """
    return settle_at(df, label)[0]


def settle_at(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """As ``settle``, in folders by the values of ``by``; also gives the path, for ``discard``."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _without_shuffle_files(spark):
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes scratch tables, or folders in them, whose frames are no longer used, before the application ends."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    made = _MADE.get(spark.sparkContext.applicationId, set())
    for path in paths:
        if not any(path == m or path.startswith(m + "/") for m in made):
            raise ValueError(f"{path} is no scratch table of this application")
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
        made.discard(path)
