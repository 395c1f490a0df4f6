"""Interquartile bounds, flags and removal."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepflow.functions.scalars import missing_as_null

from prepflow.operators.quantiles import approx_quantiles, exact_quantiles


@dataclass(frozen=True)
class Bounds:
    q1: float
    q3: float
    low: float
    high: float


def iqr_bounds(
    df: DataFrame, columns: list[str], q1: float = 0.25, q3: float = 0.75, k: float = 1.5, exact: bool = True
) -> dict[str, Bounds]:
    """Quantile bounds per column; columns without values are left out. Decimals have doubles as bounds."""
    quantiles = exact_quantiles if exact else approx_quantiles
    bounds = {}
    for c, found in quantiles(df, columns, [q1, q3]).items():
        if found and found[0] is not None:
            lo, hi = (float(v) if isinstance(v, Decimal) else v for v in found)
            spread = (hi - lo) * k
            bounds[c] = Bounds(lo, hi, lo - spread, hi + spread)
    return bounds


def bounds_frame(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    rows = [(c, float(b.q1), float(b.q3), float(b.low), float(b.high)) for c, b in bounds.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, q1 double, q3 double, low double, high double")


def flag_outliers(df: DataFrame, bounds: dict[str, Bounds]) -> DataFrame:
    """Add ``<column>_outlier``: the value where it is out of bounds, else null."""
    kinds = dict(df.dtypes)
    flags = {}
    for c, b in bounds.items():
        value = missing_as_null(c, kinds[c])
        flags[f"{c}_outlier"] = F.when(~value.between(F.lit(b.low), F.lit(b.high)), value)
    return df.withColumns(flags)


def cut_upper_outliers(df: DataFrame, column: str, bounds: Bounds) -> DataFrame:
    """Rows below the whole part of the smallest value above the upper bound.

    Without such a value ``df`` comes back unchanged. NaN is a missing value, never an outlier.
    """
    c = missing_as_null(column, dict(df.dtypes)[column])
    smallest = df.where(c > F.lit(bounds.high)).agg(F.min(c)).first()[0]
    return df if smallest is None else df.where(c < F.floor(F.lit(float(smallest))))


def remove_outliers(df: DataFrame, column: str, bounds: Bounds, keep_null: bool = False) -> DataFrame:
    """Rows inside the bounds. Once there is any outlier, null rows go as well unless kept."""
    c = missing_as_null(column, dict(df.dtypes)[column])
    inside = c.between(F.lit(bounds.low), F.lit(bounds.high))
    if keep_null:
        return df.where(inside | c.isNull())
    return df.where(inside) if df.where(~inside).take(1) else df


def outlier_stage(
    df: DataFrame, column: str, enabled: bool, task: str, q1: float = 0.25, q3: float = 0.75
) -> DataFrame:
    """The cut as a stage: only for regression, only when switched on."""
    if not enabled or task.lower() != "regression":
        return df
    bounds = iqr_bounds(df, [column], q1, q3)
    return cut_upper_outliers(df, column, bounds[column]) if column in bounds else df
