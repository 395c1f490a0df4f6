"""Standardising numeric columns from one aggregate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepflow.functions.scalars import missing_as_null


@dataclass(frozen=True)
class FittedScaler:
    means: dict[str, float]
    deviations: dict[str, float]
    center: bool

    def save(self, spark: SparkSession, path: str) -> str:
        rows = [(c, self.means[c], d, self.center) for c, d in self.deviations.items()]
        frame = spark.createDataFrame(rows, "column_name string, mean double, deviation double, center boolean")
        frame.coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedScaler:
        rows = spark.read.parquet(path).collect()
        return FittedScaler({r.column_name: r["mean"] for r in rows}, {r.column_name: r.deviation for r in rows}, rows[0].center)


def fit_scaler(df: DataFrame, columns: list[str], center: bool, ddof: int) -> FittedScaler:
    """Mean and deviation per column, NaN left out; ``ddof`` 1 is the sample, 0 the population form."""
    kinds = dict(df.dtypes)
    spread = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(*[f(missing_as_null(c, kinds[c])).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("dev", spread))]).first()
    return FittedScaler({c: row[f"mean_{c}"] for c in columns}, {c: row[f"dev_{c}"] for c in columns}, center)


def apply_scaler(df: DataFrame, fitted: FittedScaler) -> DataFrame:
    """Scaled columns in place, NaN as null. A constant column becomes 0 in both forms."""
    out, kinds = {}, dict(df.dtypes)
    for c, dev in fitted.deviations.items():
        value = missing_as_null(c, kinds[c]).cast("double")
        if fitted.center:
            out[c] = (value - F.lit(fitted.means[c])) / F.lit(dev or 1.0)
        else:
            out[c] = value / F.lit(dev) if dev else F.when(value.isNotNull(), F.lit(0.0))
    return df.withColumns(out)
