"""Positions of rows in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepflow.sources.scratch import settle

ONE_TASK_ROWS = 1_000_000


def number_rows(df: DataFrame, order: list[Column], name: str = "position", one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Add the 1-based position of each row in the order, which must have no ties.

    ``df`` is written out first, because it is usually a costly aggregate. Up to
    ``one_task_rows`` rows are numbered by a plain window. More are placed in
    ordered ranges, numbered inside each range in parallel, and shifted by the
    sizes of the ranges before.
    """
    rows = settle(df, "numbered")
    if rows.count() <= one_task_rows:
        return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    placed = settle(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        placed.join(F.broadcast(shifts), "_range")
        .withColumn(name, inside + F.col("_shift"))
        .drop("_range", "_shift")
    )
