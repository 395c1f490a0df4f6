"""The learning algorithms by name, as MLlib estimators."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from prepflow.operators.columns import split_by_type
from prepflow.operators.encode import feature_stages

SEED = 12345
PIECE_ROWS = 500_000  # of a training table in one task; a forest of 20 trees keeps some 180 bytes for each

ESTIMATORS = {
    "RFC": RandomForestClassifier,
    "DTC": DecisionTreeClassifier,
    "GBTR": GBTRegressor,
    "RFR": RandomForestRegressor,
    "GBTC": GBTClassifier,
}
REGRESSORS = {"GBTR", "RFR"}


def estimator(algorithm: str, label: str, features: str, params: dict | None = None, classes: int = 2):
    """Estimator for an algorithm name; boosted classifiers go one against the rest above two classes."""
    if algorithm not in ESTIMATORS:
        raise ValueError(f"unknown algorithm {algorithm!r}: choose from {sorted(ESTIMATORS)}")
    made = ESTIMATORS[algorithm](labelCol=label, featuresCol=features, seed=SEED, **(params or {}))
    if algorithm == "GBTC" and classes > 2:
        weight = {"weightCol": params["weightCol"]} if params and "weightCol" in params else {}
        # equal rows counted once are few enough to be kept for all classes at a time
        return OneVsRest(classifier=made, labelCol=label, featuresCol=features, parallelism=classes if weight else 1, **weight)
    return made


# equal rows may be counted only where the fit draws no rows, counts none and measures squared or logistic loss
PER_ROW = {"weightCol", "subsamplingRate", "minInstancesPerNode", "lossType", "validationIndicatorCol"}


def count_equal(df: DataFrame, label: str, leave_out: tuple[str, ...], algorithm: str, params: dict | None = None, weight: str = "_weight") -> DataFrame:
    """Rows for boosting: equal features and label once, with their number as ``weight``, where there are at most half as many of these.

    Boosting passes over the rows for each level of each tree, and its statistics are sums over
    rows, so equal rows may be added up before. Under squared loss only the number and the mean label of
    rows with equal features matter. ``df`` is given back as it is where that doesn't hold or doesn't pay.
    Those for a classifier come in a piece for each core, more where these would be over ``PIECE_ROWS``: each of several hundred passes starts a task a piece.
    """
    if algorithm not in ("GBTR", "GBTC") or PER_ROW & set(params or {}):
        return df
    split = split_by_type(df, (label, *leave_out))
    same = [*split.categorical, *split.continuous, *([label] if algorithm == "GBTC" else [])]
    known = F.count_if(F.col(f"`{label}`").isNull()).alias("unlabelled")
    sizes = df.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.struct(*[F.col(f"`{c}`") for c in same])).alias("kinds"), known).first()
    if sizes["unlabelled"] or 2 * sizes["kinds"] > sizes["n"]:
        return df
    number = F.count(F.lit(1)).cast("double").alias(weight)
    if algorithm == "GBTC":
        same = [F.col(f"`{c}`") for c in same]
        pieces = max(df.sparkSession.sparkContext.defaultParallelism, -(-sizes["kinds"] // PIECE_ROWS))
        return df.groupBy(*same).agg(number).repartition(pieces, *same)
    return df.groupBy(*[F.col(f"`{c}`") for c in same]).agg(F.avg(F.col(f"`{label}`").cast("double")).alias(label), number)


def spread(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows over all cores, in pieces of a bounded number of rows; untouched where the source arrives so.

    Training passes over the rows many times and keeps them, so one or two large input splits
    would leave the other cores idle each time, and a piece for each core would grow with the table. The
    rows of each split are counted, as many splits of a file may be empty. Meant for frames read from
    files, where footers give the counts.
    """
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.agg(F.count(F.lit(1)).alias("pieces"), F.max("n").alias("most"), F.sum("n").alias("n")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if sizes["pieces"] >= cores and sizes["most"] <= 2 * PIECE_ROWS:
        return df
    return df.repartition(max(cores, -(-(sizes["n"] or 0) // PIECE_ROWS)), *key)


def fit_features(df: DataFrame, leave_out: tuple[str, ...], invalid: str = "keep") -> PipelineModel:
    """Index, one-hot, assemble and scale every text and number column not left out."""
    split = split_by_type(df, leave_out)
    stages = feature_stages(split.categorical, split.continuous, invalid).getStages()
    scaler = StandardScaler(inputCol="features", outputCol="Scaled_features", withMean=False, withStd=True)
    return Pipeline(stages=[*stages, scaler]).fit(df)


def fit_model(prepared: DataFrame, label: str, algorithm: str, params: dict | None = None, classes: int = 2):
    """Fit on rows that already have ``Scaled_features``; the columns needed are kept in memory or on disk."""
    weight = [params["weightCol"]] if params and "weightCol" in params else []
    needed = prepared.select("Scaled_features", label, *weight).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator(algorithm, label, "Scaled_features", params, classes).fit(needed)
    finally:
        needed.unpersist()


def fit_multioutput(prepared: DataFrame, labels: list[str], algorithm: str = "RFC", params: dict | None = None) -> dict:
    """One model per label column, all on the same stored feature vectors."""
    needed = prepared.select("Scaled_features", *labels).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {c: estimator(algorithm, c, "Scaled_features", params, 3).fit(needed) for c in labels}
    finally:
        needed.unpersist()


def predict_multioutput(prepared: DataFrame, models: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``<label>_predicted`` per model."""
    out = prepared.select("Scaled_features", *keep)
    for label, model in models.items():
        out = model.transform(out).withColumnRenamed("prediction", f"{label}_predicted").drop("rawPrediction", "probability")
    return out.drop("Scaled_features")
