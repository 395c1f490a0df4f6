"""Dropping uninformative columns and filling missing values."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepflow.functions.scalars import missing_as_null, named
from prepflow.operators.aggregate import distinct_profile, mode_per_column
from prepflow.operators.columns import TypeSplit, split_by_type
from prepflow.operators.quantiles import exact_quantiles


def cardinality_decisions(df: DataFrame, lower: float, upper_fraction: float, whole_upper: bool = False) -> DataFrame:
    """Which columns to drop: at most ``lower`` distinct values, or at least
    ``upper_fraction`` of the row count. ``whole_upper`` cuts that product to an integer.
    """
    bound = F.lit(upper_fraction) * F.col("rows")
    if whole_upper:
        bound = F.floor(bound)
    drop = (F.col("distinct_count") <= F.lit(lower)) | (F.col("distinct_count") >= bound)
    return distinct_profile(df).select("column_name", "distinct_count", drop.alias("dropped"))


def undecided_columns(
    df: DataFrame, lower: float, upper_fraction: float, whole_upper: bool = False, rsd: float = 0.02
) -> tuple[list[str], list[str]]:
    """Columns that sketches prove far enough above the upper bound to be dropped, and those too near a bound to tell.

    All columns are sketched in one scan, whose partial results are a few kilobytes a column and task. A true count is
    taken to lie within six standard errors of its estimate, and two values more: beyond that a decision is safe.
    Columns of few values are always near; counting them exactly is cheap, as their values combine before the shuffle.
    """
    kinds = dict(df.dtypes)
    sketches = [F.approx_count_distinct(_hashable(c, kinds[c]), rsd) for c in df.columns]
    rows, *estimates = df.agg(F.count(F.lit(1)), *sketches).first()
    upper = upper_fraction * rows
    upper = math.floor(upper) if whole_upper else upper
    gone, near = [], []
    for c, estimate in zip(df.columns, estimates, strict=True):
        low, high = estimate * (1 - 6 * rsd) - 2, estimate * (1 + 6 * rsd) + 2
        if low >= upper and low > 0:
            gone.append(c)
        elif low <= lower or high >= upper:
            near.append(c)
    return gone, near


def _hashable(name: str, dtype: str):
    value = missing_as_null(name, dtype)
    return value.cast("string") if dtype.startswith(("map", "array", "struct", "interval", "variant")) else value


def drop_by_cardinality(df: DataFrame, lower: float, upper_fraction: float) -> tuple[DataFrame, list[str]]:
    """``df`` without constant and near-unique columns, and the names dropped. The decisions are those of exact
    counts, but only columns near a bound are counted exactly. A table without rows keeps its columns."""
    return _drop_by_bounds(df, lower, upper_fraction, False, [])


def drop_by_cardinality_percent(
    df: DataFrame, lower_percent: float, upper_percent: float, dates: list[str]
) -> tuple[DataFrame, list[str]]:
    """The same with both bounds in percent, cut to integers, plus listed date columns.

    The lower bound is ``int(lower_percent / 100)`` distinct values, so below
    100 it only drops columns that hold nothing but nulls.
    """
    return _drop_by_bounds(df, int(lower_percent / 100), upper_percent / 100, True, dates)


def _drop_by_bounds(df: DataFrame, lower: float, upper_fraction: float, whole_upper: bool, also: list[str]) -> tuple[DataFrame, list[str]]:
    far, near = undecided_columns(df, lower, upper_fraction, whole_upper)
    gone = {*far, *also}
    if near:
        decided = cardinality_decisions(df.select(*[named(c) for c in near]), lower, upper_fraction, whole_upper)
        gone |= {r[0] for r in decided.where("dropped").select("column_name").collect()}
    dropped = [c for c in df.columns if c in gone]
    return df.select(*[named(c) for c in df.columns if c not in gone]), dropped


@dataclass
class FittedImputer:
    """The value that replaces missing cells, per column, with its Spark type."""

    values: dict[str, object] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)

    def merge(self, other: FittedImputer) -> FittedImputer:
        return FittedImputer(self.values | other.values, self.types | other.types)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, self.types[c], None if v is None else str(v)) for c, v in self.values.items()]
        return spark.createDataFrame(rows, "column_name string, type string, value string")

    def save(self, spark: SparkSession, path: str) -> str:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedImputer:
        rows = spark.read.parquet(path).collect()
        return FittedImputer({r.column_name: r.value for r in rows}, {r.column_name: r.type for r in rows})


def fit_imputer(df: DataFrame, columns: list[str], strategy: str, constant: object = None) -> FittedImputer:
    """Replacement values by ``mean``, ``median``, ``mode`` or ``constant``.

    The mean of an integer column is cut to an integer, the median is the lower
    middle value, a tied mode is the smallest value. Numeric columns without any
    value are refused; text columns without one keep their nulls.
    """
    kinds = dict(df.dtypes)
    if strategy == "constant":
        found = {c: constant for c in columns}
    elif strategy == "mean":
        row = df.agg(*[F.avg(missing_as_null(c, kinds[c])).alias(f"m{i}") for i, c in enumerate(columns)]).first()
        found = dict(zip(columns, row, strict=True))
    elif strategy == "median":
        found = {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}
    elif strategy == "mode":
        found = dict.fromkeys(columns) | {r.column_name: r["mode"] for r in mode_per_column(df, columns).collect()}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    empty = [c for c, v in found.items() if v is None and kinds[c] != "string"]
    if empty:
        raise ValueError(f"no value to impute from in {empty}")
    return FittedImputer(found, {c: kinds[c] for c in columns})


def fit_imputer_both(df: DataFrame, strategy: str, constant: object = None, leave_out: tuple[str, ...] = ()) -> FittedImputer:
    """One imputer for numbers and text. Text has no mean or median and takes its mode."""
    split: TypeSplit = split_by_type(df, leave_out)
    numbers = fit_imputer(df, split.continuous, strategy, constant) if split.continuous else FittedImputer()
    for_text = "mode" if strategy in ("mean", "median") else strategy
    texts = fit_imputer(df, split.categorical, for_text, constant) if split.categorical else FittedImputer()
    return numbers.merge(texts)


def apply_imputer(df: DataFrame, fitted: FittedImputer) -> DataFrame:
    kinds = dict(df.dtypes)
    filled = {c: F.coalesce(missing_as_null(c, kinds[c]), _as_type(v, kinds[c])) for c, v in fitted.values.items() if c in kinds}
    return df.withColumns(filled) if filled else df


def _as_type(value, dtype: str):
    if value is not None and dtype in ("tinyint", "smallint", "int", "bigint"):
        return F.lit(str(value)).cast("decimal(38,10)").cast(dtype)
    return F.lit(value).cast(dtype)
