"""Catalog and JDBC tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def first_column(df: DataFrame) -> DataFrame:
    """Only the first column, e.g. the stored list of dropped features."""
    return df.select(df.columns[0])


def column_names_in(df: DataFrame, limit: int = 100_000) -> list[str]:
    """The first column as Python strings. Meant for lists of column names."""
    rows = first_column(df).take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"more than {limit} names: this table is not a list of columns")
    return [r[0] for r in rows]


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace table ``name`` by the rows of ``df``, which may read the old table.

    The new rows are written under a name of their own first. The old table keeps its
    rows under another name until the new one bears ``name``, and comes back if that
    fails. Between the two renames readers find no table.
    """
    spark = df.sparkSession
    staging, old = f"{name}__new_{uuid.uuid4().hex[:8]}", f"{name}__old_{uuid.uuid4().hex[:8]}"
    writer = df.write.format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(staging)
    there = spark.catalog.tableExists(name)
    if there:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    except Exception:
        if there:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    if there:
        spark.sql(f"DROP TABLE {old}")
    return spark.table(name)


def publish(df: DataFrame, root: str, keep: int = 2) -> str:
    """Makes the rows of ``df`` the current version of the table in folder ``root``; ``df`` may read the one before.

    A version is written whole into a folder of its own. Then one empty file, named by its number and folder, makes it
    current: a reader finds the version before or this one, never a part and never nothing, on any store that Spark
    writes to. A write that fails leaves the table as it was. Of two writers at once both versions are whole, and the
    greater name is current. The last ``keep`` versions besides stay for readers that have begun; older ones are deleted,
    so a reader fails if more than ``keep`` versions are published while it reads.
    """
    if keep < 1:
        raise ValueError("readers that have begun need the version before")
    spark = df.sparkSession
    path, fs = _at(spark, root)
    marks = _marks(spark, root)
    number = int(marks[-1].split("-")[0]) + 1 if marks else 1
    name = f"{number:012d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/versions/{name}")
    fs.create(path("current", name), False).close()
    for old in marks[: max(0, len(marks) - keep)]:
        fs.delete(path("current", old), False)
        fs.delete(path("versions", old), True)
    return name


def read_published(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The current version of a published table, or one of those still kept; the frame goes on reading that version."""
    marks = _marks(spark, root)
    if not marks or version is not None and version not in marks:
        raise ValueError(f"{root} has no published version {version or ''}".rstrip())
    return spark.read.parquet(f"{root}/versions/{version or marks[-1]}")


def published_versions(spark: SparkSession, root: str) -> list[str]:
    """The names of the versions kept, oldest first."""
    return _marks(spark, root)


def _at(spark: SparkSession, root: str):
    """A maker of paths below ``root``, and its file system."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = make(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return lambda *parts: make("/".join((root, *parts))), fs


def _marks(spark: SparkSession, root: str) -> list[str]:
    path, fs = _at(spark, root)
    folder = path("current")
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def append_rows(df: DataFrame, name: str) -> DataFrame:
    df.write.mode("append").saveAsTable(name)
    return df.sparkSession.table(name)


def empty_table(
    spark: SparkSession, name: str, columns: list[str], path: str | None = None, dtype: T.DataType | None = None
) -> DataFrame:
    """An empty table with one column per name, text unless ``dtype`` says otherwise."""
    schema = T.StructType([T.StructField(c, dtype or T.StringType()) for c in columns])
    return replace_table(spark.createDataFrame([], schema), name, path)


def write_jdbc(df: DataFrame, url: str, name: str, properties: dict[str, str], connections: int = 16) -> None:
    """Replace a database table; ``connections`` tasks write at once."""
    df.repartition(connections).write.option("truncate", True).mode("overwrite").jdbc(url, name, properties=properties)


def read_jdbc(
    spark: SparkSession, url: str, name: str, key: str, low: int, high: int, partitions: int, properties: dict[str, str]
) -> DataFrame:
    """Read a database table in ranges of a numeric key, one task per range."""
    return spark.read.jdbc(
        url, name, column=key, lowerBound=low, upperBound=high, numPartitions=partitions, properties=properties
    )
