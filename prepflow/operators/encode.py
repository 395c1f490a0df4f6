"""Categories to numbers and to indicator columns."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepflow.operators.aggregate import value_counts
from prepflow.operators.joins import lookup_join
from prepflow.operators.ranking import number_rows
from prepflow.operators.reshape import all_values


def fit_index(df: DataFrame, column: str) -> DataFrame:
    """Code per value: most frequent first, ties in text order. Columns: value, ``code``."""
    counts = value_counts(df.where(F.col(column).isNotNull()), column)
    ranked = number_rows(counts, [F.col("count").desc(), F.col(column).asc()], "code")
    return ranked.select(column, (F.col("code") - 1).alias("code"))


def fit_labels(df: DataFrame, column: str) -> DataFrame:
    """Code per value in sorted order. Columns: value, ``code``."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return number_rows(values, [F.col(column).asc()], "code").select(column, (F.col("code") - 1).alias("code"))


def apply_codes(df: DataFrame, codes: DataFrame, column: str, out: str, invalid: str = "error") -> DataFrame:
    """Add the code of ``column``. Unknown and null values raise (``error``), lose
    their row (``skip``), or take the next free code (``keep``).
    """
    coded = lookup_join(df, codes.select(column, F.col("code").alias(out)), column)
    coded = coded.select(*df.columns, out)
    if invalid == "skip":
        return coded.where(F.col(out).isNotNull())
    if invalid == "keep":
        return coded.withColumn(out, F.coalesce(F.col(out), F.lit(codes.count())))
    message = F.concat(F.lit(f"{column} has a value without a code: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    return coded.withColumn(out, F.coalesce(F.col(out), F.raise_error(message).cast("bigint")))


def fit_onehot(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """Sorted categories per column; they name the indicator columns."""
    return {c: [v for (v,) in all_values(df, c)] for c in columns}


def save_onehot(spark: SparkSession, categories: dict[str, list], path: str) -> str:
    """Store the categories of text columns."""
    frame = spark.createDataFrame(list(categories.items()), "column_name string, categories array<string>")
    frame.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_onehot(spark: SparkSession, path: str) -> dict[str, list]:
    return {r.column_name: r.categories for r in spark.read.parquet(path).collect()}


def apply_onehot(df: DataFrame, categories: dict[str, list], unknown: str = "ignore") -> DataFrame:
    """Replace each column by one 0/1 column per category, named ``column_category``.

    An unknown value gives all zeros (``ignore``) or fails the query (``error``).
    """
    out = []
    for c in df.columns:
        if c not in categories:
            out.append(F.col(c))
            continue
        value = F.col(c)
        if unknown == "error":
            known = F.coalesce(value.isin(categories[c]), F.lit(False))
            value = F.when(known, value).otherwise(F.raise_error(F.lit(f"unknown category in {c}")))
        out += [F.when(value == F.lit(v), 1.0).otherwise(0.0).alias(f"{c}_{v}") for v in categories[c]]
    return df.select(*out)


def feature_stages(texts: list[str], numbers: list[str], invalid: str = "error", features: str = "features") -> Pipeline:
    """Index, one-hot encode and assemble into one vector column, as an MLlib pipeline."""
    stages = []
    if texts:
        indexed = [f"{c}_index" for c in texts]
        encoded = [f"{c}_encoded" for c in texts]
        stages.append(StringIndexer(inputCols=texts, outputCols=indexed, handleInvalid=invalid))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep" if invalid == "keep" else "error"))
        inputs = [*encoded, *numbers]
    else:
        inputs = list(numbers)
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features, handleInvalid=invalid))
    return Pipeline(stages=stages)
