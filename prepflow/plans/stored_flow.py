"""A training flow that is stored as a whole and used again: filling, codes, scaling and model in one pipeline, and a record.

The record holds what a pipeline doesn't say: label, classes, key, split and algorithm. So a later
application tests on the very rows that the first one held out, with what was fitted on the others.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepflow.functions.scalars import max_abs_percent
from prepflow.operators.encode import fit_index
from prepflow.operators.metrics import evaluate
from prepflow.operators.models import REGRESSORS, estimator
from prepflow.operators.sampling import train_flag
from prepflow.operators.stages import FillMissing, VectorStages, quoted
from prepflow.plans.modelling import row_key
from prepflow.sources.scratch import settle


@dataclass
class Record:
    label: str
    key: list[str]
    algorithm: str
    strategy: str
    fraction: float = 0.8
    seed: int = 12345
    invalid: str = "keep"
    text_label: bool = False
    n_classes: int = 0


@dataclass
class StoredFlow:
    pipeline: PipelineModel
    record: Record
    classes: DataFrame | None  # value, code: of a text label

    @property
    def features(self) -> PipelineModel:
        return PipelineModel(stages=self.pipeline.stages[:-1])

    def save(self, path: str) -> str:
        """Overwrites what lies at ``path``; the record comes last, so a flow without one isn't whole."""
        spark = SparkSession.active()
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        if self.classes is not None:
            self.classes.write.mode("overwrite").parquet(f"{path}/classes")
        spark.createDataFrame([(json.dumps(asdict(self.record)),)], "record string").coalesce(1).write.mode("overwrite").parquet(f"{path}/record")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> StoredFlow:
        record = Record(**json.loads(spark.read.parquet(f"{path}/record").first()["record"]))
        classes = spark.read.parquet(f"{path}/classes") if record.text_label else None
        return StoredFlow(PipelineModel.load(f"{path}/pipeline"), record, classes)


def split(df: DataFrame, record: Record) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows by a hash of the key, whatever the partitions."""
    marked = df.withColumn("_row", row_key(record.key)).withColumn("_train", train_flag("_row", record.fraction, record.seed)).drop("_row")
    return marked.where("_train").drop("_train"), marked.where(~F.col("_train")).drop("_train")


def labelled(df: DataFrame, record: Record, classes: DataFrame | None) -> DataFrame:
    """Rows with ``_label`` as a number. Rows whose label is null, or no class of the training split, are left out of both splits."""
    if classes is None:
        return df.withColumn("_label", quoted(record.label).cast("double")).where("_label IS NOT NULL AND NOT isnan(_label)")
    codes = classes.select(F.col("value").alias("_class"), F.col("code").cast("double").alias("_label"))
    return df.join(codes, quoted(record.label) == F.col("_class")).drop("_class")


def train(
    df: DataFrame, label: str, key: list[str], algorithm: str, params: dict | None = None,
    strategy: str = "median", fraction: float = 0.8, seed: int = 12345, invalid: str = "keep",
) -> StoredFlow:
    """Fits every stage on the training split only. ``invalid`` says what later rows with unknown categories become."""
    record = Record(label, list(key), algorithm, strategy, fraction, seed, invalid, dict(df.dtypes)[label] == "string")
    fit_on = settle(split(df, record)[0], "training")
    classes = None
    if record.text_label:
        classes = settle(fit_index(fit_on.select(quoted(label).alias("value")), "value"), "classes")
    rows = settle(labelled(fit_on, record, classes), "labelled")
    if algorithm not in REGRESSORS:
        record.n_classes = classes.count() if classes is not None else int(rows.agg(F.max("_label")).first()[0] or 0) + 1
    out = [label, "_label", *key]
    stages = [FillMissing(strategy=strategy, leaveOut=out), VectorStages(leaveOut=out, invalid=invalid), StandardScaler(inputCol="features", outputCol="Scaled_features", withMean=False, withStd=True)]
    fitted = Pipeline(stages=stages).fit(rows)
    prepared = settle(fitted.transform(rows).select("Scaled_features", "_label"), "prepared")
    model = estimator(algorithm, "_label", "Scaled_features", params, record.n_classes).fit(prepared)
    parts = [p for s in fitted.stages for p in (s.stages if isinstance(s, PipelineModel) else [s])]
    return StoredFlow(PipelineModel(stages=[*parts, model]), record, classes)


def predict(df: DataFrame, flow: StoredFlow, keep: tuple[str, ...] = ()) -> DataFrame:
    """Key, ``keep``, prediction (and probability where the model has one) of every row; a label isn't needed."""
    out = flow.pipeline.transform(df)
    more = ["probability"] if "probability" in out.columns else []
    return out.select(*[quoted(c) for c in (*flow.record.key, *keep)], "prediction", *more)


def test(df: DataFrame, flow: StoredFlow, metric: str) -> tuple[DataFrame, float]:
    """Predictions for the held-out rows of the record's split, and their score."""
    held_out = split(df, flow.record)[1]
    out = predict(labelled(held_out, flow.record, flow.classes), flow, ("_label",))
    return out, evaluate(out, "_label", "prediction", metric)


def score(df: DataFrame, flow: StoredFlow, names: tuple[str, str] = ("LOAN_CLASS", "LOAN_RATING"), amount: str = "PRINCIPAL_AMOUNT") -> DataFrame:
    """New rows with their class (as the label was written) and its probability in percent, or with their amount."""
    out = predict(df, flow)
    if flow.record.algorithm in REGRESSORS:
        return out.withColumnRenamed("prediction", amount)
    rating = [max_abs_percent(F.col("probability")).alias(names[1])] if "probability" in out.columns else []
    if flow.classes is None:
        return out.select(*[quoted(c) for c in flow.record.key], F.col("prediction").alias(names[0]), *rating)
    named = out.join(flow.classes.select(F.col("code").cast("double").alias("prediction"), F.col("value").alias(names[0])), "prediction", "left")
    return named.select(*[quoted(c) for c in flow.record.key], names[0], *rating)
