"""Model quality from (actual, predicted) columns, by aggregation."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepflow.operators.reshape import all_values
from prepflow.sources.scratch import settle


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per (actual, predicted) pair that occurs."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count")
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row per class, one column per class named ``p_<class>``, zeros filled.

    The classes are all values that occur as actual or as predicted. The counts are
    written out once, since predictions are costly and the counts are used three times.
    """
    counts = settle(confusion_counts(df, actual, predicted), "confusion")
    both = counts.select(F.explode(F.array("actual", "predicted")).alias("actual"))
    classes = [v for (v,) in all_values(both, "actual")]
    wide = counts.groupBy("actual").pivot("predicted", classes).agg(F.sum("count"))
    wide = wide.toDF("actual", *[f"p_{c}" for c in classes])
    return both.distinct().join(wide, "actual", "left").na.fill(0, [f"p_{c}" for c in classes])


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """accuracy, f1, weightedPrecision, weightedRecall and hammingLoss in one row.

    One scan gives the confusion counts; the rest works on those few rows.
    """
    counts = confusion_counts(df, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("class"), F.col("count").alias("real"), F.lit(0).cast("bigint").alias("said"), hit.alias("hit")),
                F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("real"), F.col("count").alias("said"), F.lit(0).cast("bigint").alias("hit")),
            )
        )
    )
    per_class = sides.groupBy("class").agg(F.sum("real").alias("real"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    precision = F.when(F.col("said") > 0, F.col("hit") / F.col("said")).otherwise(0.0)
    recall = F.when(F.col("real") > 0, F.col("hit") / F.col("real")).otherwise(0.0)
    f1 = F.when(F.col("hit") > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    n = F.sum("real")
    return per_class.agg(
        (F.sum("hit") / n).alias("accuracy"),
        (F.sum(f1 * F.col("real")) / n).alias("f1"),
        (F.sum(precision * F.col("real")) / n).alias("weightedPrecision"),
        (F.sum(recall * F.col("real")) / n).alias("weightedRecall"),
        (1 - F.sum("hit") / n).alias("hammingLoss"),
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """rmse, mse, mae, r2 (null for a constant actual) and var (explained variance) in one row and one scan."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    mse = F.avg((y - p) * (y - p))
    bias = F.avg(p) - F.avg(y)
    return df.agg(
        F.sqrt(mse).alias("rmse"),
        mse.alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"),
        (F.var_pop(p) + bias * bias).alias("var"),
    )


def evaluate(df: DataFrame, actual: str, predicted: str, metric: str, **options) -> float:
    """One metric by name.

    Names that neither of the two tables above has (weightedFMeasure, the true and false
    positive rates, the forms by label, logLoss) go to MLlib's evaluator, with its options
    such as ``metricLabel`` or ``beta``. An unknown name is an error there.
    """
    if metric in ("rmse", "mse", "mae", "r2", "var"):
        return regression_metrics(df, actual, predicted).select(metric).first()[0]
    if metric in ("accuracy", "f1", "weightedPrecision", "weightedRecall", "hammingLoss"):
        return classification_metrics(df, actual, predicted).select(metric).first()[0]
    return MulticlassClassificationEvaluator(labelCol=actual, predictionCol=predicted, metricName=metric, **options).evaluate(df)


def accuracy_per_output(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """One row: share of equal values per output, for named (actual, predicted) pairs."""
    return df.agg(
        *[F.avg(F.when(F.col(a) == F.col(p), 1.0).otherwise(0.0)).alias(n) for n, (a, p) in pairs.items()]
    )


def output_report(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """output, actual, predicted, count, accuracy: the whole matrix of each output, zeros filled.

    ``pairs`` names the (actual, predicted) columns of each output; they have one type.
    The rows are read once, and what follows works on their counts. A null is a class of
    its own, and equals a predicted null.
    """
    sides = [F.struct(F.lit(n).alias("output"), F.col(a).alias("actual"), F.col(p).alias("predicted")) for n, (a, p) in pairs.items()]
    counts = df.select(F.inline(F.array(*sides))).groupBy("output", "actual", "predicted").agg(F.count(F.lit(1)).alias("count"))
    counts = settle(counts, "outputs").alias("c")
    right = F.when(F.expr("actual <=> predicted"), F.col("count")).otherwise(0)
    quality = counts.groupBy("output").agg((F.sum(right) / F.sum("count")).alias("accuracy"))
    classes = counts.select("output", F.explode(F.array("actual", "predicted")).alias("class")).distinct()
    grid = classes.withColumnRenamed("class", "actual").join(classes.withColumnRenamed("class", "predicted"), "output").alias("g")
    same = "g.output = c.output AND g.actual <=> c.actual AND g.predicted <=> c.predicted"
    full = grid.join(counts, F.expr(same), "left").select("g.*", F.coalesce("count", F.lit(0)).alias("count"))
    return full.join(quality, "output").select("output", "actual", "predicted", "count", "accuracy")


def prediction_pairs(df: DataFrame, key: list[str], actual: str, predicted: str) -> DataFrame:
    return df.select(*key, actual, predicted)
