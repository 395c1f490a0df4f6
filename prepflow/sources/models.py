"""Fitted transformers and models on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable


def save_model(model: MLWritable, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str, kind=PipelineModel):
    return kind.load(path)
