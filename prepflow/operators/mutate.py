"""Inserts, updates and deletes as new versions of a frame.

Nothing is changed in place: each function returns the rows of the next version,
to be published with ``sources.tables.replace_table`` (or, for inserts alone,
``append_rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_rows(df: DataFrame, rows: DataFrame | list[tuple]) -> DataFrame:
    """``df`` followed by the rows of another frame, or by literal ones, in the column order of ``df``."""
    if not isinstance(rows, DataFrame):
        rows = df.sparkSession.createDataFrame(rows, df.schema)
    return df.unionAll(rows)


def update_where(df: DataFrame, condition: Column, changes: dict[str, object]) -> DataFrame:
    kinds = dict(df.dtypes)
    new = {
        c: F.when(condition, v if isinstance(v, Column) else F.lit(v).cast(kinds[c])).otherwise(F.col(c))
        for c, v in changes.items()
    }
    return df.withColumns(new)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true, including those where it is null."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def cascade_delete(parent: DataFrame, child: DataFrame, parent_key: str, link: str, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Delete parent rows and the child rows that point to them; both survivors."""
    gone = parent.where(condition).select(F.col(parent_key).alias(link)).distinct()
    return delete_where(parent, condition), child.join(gone, link, "left_anti")
