"""Aggregates, column profiles, distinct values and unions.

Every grouped result is reduced on the map side before the shuffle, so a key
that holds a large share of the rows costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepflow.functions.scalars import missing_as_null
from prepflow.operators.ranking import number_rows


def global_stats(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.avg(c).alias("avg"),
        F.max(c).alias("max"),
        F.min(c).alias("min"),
        F.sum(c).alias("sum"),
        F.count(c).alias("count"),
    )


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


VALUE = ["whole", "number", "text"]


def cells(df: DataFrame, columns: list[str]) -> Column:
    """An array with one entry per column: its number in ``columns`` and its value in
    the slot of its kind. Numbers keep their own type, which is cheaper than text
    and keeps their order; missing values leave all three slots null. A decimal fills all
    slots (whole part, where it is a bigint; the rest; its text), so that it sorts as a number and stays exact.
    """
    kinds = dict(df.dtypes)
    entries = []
    for i, c in enumerate(columns):
        kind, value = kinds[c], missing_as_null(c, kinds[c])
        slot = "whole" if kind in ("tinyint", "smallint", "int", "bigint") else "number" if kind in ("float", "double") else "text"
        entry = [F.lit(i).alias("column")]
        parts = _decimal_slots(value, kind) if kind.startswith("decimal") else {slot: value}
        for name, dtype in zip(VALUE, ("bigint", "double", "string")):
            entry.append(parts.get(name, F.lit(None)).cast(dtype).alias(name))
        entries.append(F.struct(*entry))
    return F.array(*entries)


def _decimal_slots(value: Column, kind: str) -> dict[str, Column]:
    precision, scale = (int(x) for x in kind[len("decimal(") : -1].split(","))
    if precision - scale > 18:
        return {"number": value, "text": value}
    return {"whole": F.floor(value), "number": value - F.floor(value), "text": value}


def known() -> Column:
    """True for cells that hold a value."""
    return F.col("whole").isNotNull() | F.col("number").isNotNull() | F.col("text").isNotNull()


def column_name(columns: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("column") + 1).alias("column_name")


def value_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column and value, all columns in one scan and one shuffle of values."""
    return df.select(F.inline(cells(df, columns))).groupBy("column", *VALUE).agg(F.count(F.lit(1)).alias("n"))


def distinct_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct non-null values and rows per column.

    Counts values in the long form: one aggregate with a distinct count per column
    multiplies the rows in the same way and then shuffles them in one wide format.
    """
    names = columns if columns is not None else df.columns
    counts = value_profile(df, names).groupBy("column").agg(
        F.count_if(known()).alias("distinct_count"), F.sum("n").alias("rows")
    )
    return counts.select(column_name(names), "distinct_count", "rows")


def approx_distinct_profile(df: DataFrame, rsd: float = 0.01) -> DataFrame:
    """Estimated distinct counts: one scan, no shuffle of values."""
    kinds = dict(df.dtypes)
    wide = df.agg(*[F.approx_count_distinct(missing_as_null(c, kinds[c]), rsd).alias(c) for c in df.columns])
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_count")) for c in df.columns]))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def mode_per_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent non-null value of each column, all columns in one pass.

    Equal counts go to the smallest value: by number for numeric columns, by
    text otherwise. A column without values is absent from the result.
    """
    counted = value_profile(df, columns).where(known())
    best = F.min(F.struct((-F.col("n")).alias("less"), *VALUE)).alias("best")
    mode = F.coalesce(*[F.col(f"best.{v}").cast("string") for v in ("text", "whole", "number")]).alias("mode")
    return counted.groupBy("column").agg(best).select(column_name(columns), mode, (-F.col("best.less")).alias("count"))


def minmax_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Smallest and largest value per numeric column, as double, in one scan."""
    facts = [f(c).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"min_{c}").alias("min_value"), F.col(f"max_{c}").alias("max_value"))
        for c in columns
    ]
    return df.agg(*facts).select(F.inline(F.array(*rows)))


def distinct_sorted(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    order = F.col(column).desc() if descending else F.col(column).asc()
    return df.select(column).distinct().orderBy(order)


def rank_values(df: DataFrame, column: str, descending: bool = False, name: str = "rank") -> DataFrame:
    """Each distinct non-null value with its 1-based position in the order."""
    order = F.col(column).desc() if descending else F.col(column).asc()
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return number_rows(values, [order], name)


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the first in the given order.

    A grouped minimum, so each task keeps one row per key. A window would bring
    all rows of a key into one task. ``order`` should end in a unique column;
    the remaining columns break ties, so the result never depends on arrival.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    lead = [c for c in order if c != key]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*lead, *rest)).alias("_first"))
        .select(*[F.col(c) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])
    )


def top_groups(df: DataFrame, column: str, k: int) -> DataFrame:
    counts = value_counts(df, column)
    return counts.orderBy(F.col("count").desc(), F.col(column).asc()).limit(k)


def target_size(df: DataFrame, column: str) -> DataFrame:
    """Size of the smallest and of the largest class."""
    return value_counts(df.where(F.col(column).isNotNull()), column).agg(
        F.min("count").alias("smallest"), F.max("count").alias("largest")
    )


def preview(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)
