"""Train, test and score flows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from prepflow.functions.scalars import max_abs_percent
from prepflow.operators.clean import FittedImputer, apply_imputer
from prepflow.operators.columns import cast_prefix, drop_columns
from prepflow.operators.metrics import evaluate
from prepflow.operators.models import REGRESSORS, count_equal, fit_features, fit_model
from prepflow.operators.sampling import train_flag
from prepflow.sources.models import load_model, save_model


@dataclass
class Flow:
    """Fitted encoding and scaling, fitted model, and how the rows were split."""

    features: PipelineModel
    model: object
    algorithm: str
    label: str
    key: list[str]
    fraction: float
    classes: list[str] | None = None

    @property
    def regression(self) -> bool:
        return self.algorithm in REGRESSORS


def row_key(key: list[str]):
    """Text that identifies a row, for the key-based split."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in key])


def split_rows(df: DataFrame, key: list[str], fraction: float) -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn("_key", row_key(key)).withColumn("_train", train_flag("_key", fraction)).drop("_key")
    return marked.where("_train").drop("_train"), marked.where(~F.col("_train")).drop("_train")


def train(
    df: DataFrame, label: str, key: list[str], algorithm: str, params: dict | None = None, fraction: float = 0.8
) -> Flow:
    """Fit everything on the training split only, which is kept in memory or on
    executor disks meanwhile. ``models.spread`` helps when ``df`` has few partitions.

    A text label is indexed by frequency; ``classes`` holds its values in index order.
    """
    fit_on = split_rows(df, key, fraction)[0].drop(*key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        classes = None
        if dict(df.dtypes)[label] == "string":
            classes = StringIndexer(inputCol=label, outputCol="_i").fit(fit_on).labels
        flow = Flow(fit_features(fit_on, (label, *key)), None, algorithm, label, key, fraction, classes)
        classes_in = _class_count(fit_on, flow)
        counted = count_equal(fit_on, label, tuple(key), algorithm, params)
        grouped = counted is not fit_on
        if grouped:
            params = {**(params or {}), "weightCol": "_weight"}
        prepared = _prepare(counted, flow, ["_weight"] if grouped else [])
        flow.model = fit_model(prepared, "_label", algorithm, params, classes_in)
    finally:
        fit_on.unpersist()
    return flow


def _class_count(df: DataFrame, flow: Flow) -> int:
    if flow.regression:
        return 0
    return len(flow.classes) if flow.classes is not None else df.select(flow.label).distinct().count()


def _prepare(df: DataFrame, flow: Flow, keep: list[str] | None = None) -> DataFrame:
    """Feature vectors, the label as a number, and the key columns (or those of ``keep``)."""
    label = F.col(flow.label)
    if flow.classes is not None:
        codes = F.create_map(*[F.lit(x) for i, v in enumerate(flow.classes) for x in (v, float(i))])
        label = codes[label]
    out = flow.features.transform(df.withColumn("_label", label.cast("double")))
    return out.select(*(flow.key if keep is None else keep), "_label", "Scaled_features")


def predict(df: DataFrame, flow: Flow) -> DataFrame:
    """Key, actual (``_label``) and ``prediction`` (and ``probability`` where the model has one)."""
    out = flow.model.transform(_prepare(df, flow))
    return out.drop("Scaled_features", "rawPrediction")


def test(df: DataFrame, flow: Flow, metric: str) -> tuple[DataFrame, float]:
    """Predictions for the held-out rows with the stored features and model, and their score."""
    _, held_out = split_rows(df, flow.key, flow.fraction)
    out = predict(held_out, flow)
    return out, evaluate(out, "_label", "prediction", metric)


def score(
    df: DataFrame,
    features: PipelineModel,
    model,
    key: list[str],
    imputer: FittedImputer | None = None,
    dropped: tuple[str, ...] = (),
    number_prefix: str | None = None,
    regression: bool = False,
    names: tuple[str, str] = ("LOAN_CLASS", "LOAN_RATING"),
    amount: str = "PRINCIPAL_AMOUNT",
) -> DataFrame:
    """Predictions for new rows, one per input row, with the key carried along.

    ``number_prefix`` casts text columns of that prefix to integers first, for
    entities whose history is still empty. ``dropped`` are the columns the
    cleaning stage removed.
    """
    if number_prefix is not None:
        df = cast_prefix(df, number_prefix)
    if imputer is not None:
        df = apply_imputer(df, imputer)
    df = drop_columns(df, [c for c in dropped if c not in key])
    out = model.transform(features.transform(df))
    if regression:
        return out.select(*key, F.col("prediction").alias(amount))
    rating = [max_abs_percent(F.col("probability")).alias(names[1])] if "probability" in out.columns else []
    return out.select(*key, F.col("prediction").alias(names[0]), *rating)


def save_flow(flow: Flow, path: str) -> str:
    save_model(flow.features, f"{path}/features")
    save_model(flow.model, f"{path}/model")
    return path


def load_parts(path: str, model_kind) -> tuple[PipelineModel, object]:
    return load_model(f"{path}/features"), load_model(f"{path}/model", model_kind)
