"""Ranking features by their relation to a class label."""

from __future__ import annotations

from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepflow.functions.tails import log_chi_square_tail, log_f_tail
from prepflow.operators.aggregate import VALUE, cells, column_name, known
from prepflow.sources.scratch import settle


def chi_square_stats(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Chi-square statistic and degrees of freedom of each feature against the label.

    Uses n * (sum of o^2 / (row total * column total) - 1), which needs the
    observed cells only, so the full value by class grid is never built.
    """
    labelled = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.explode(cells(df, features)).alias("cell"))
    observed = labelled.select("label", "cell.*").where(known())
    table = settle(observed.groupBy("column", *VALUE, "label").agg(F.count(F.lit(1)).alias("o")), "contingency")
    classes = settle(table.groupBy("column", "label").agg(F.sum("o").alias("class_total")), "class-totals")
    per_value = (
        table.join(classes, ["column", "label"])
        .groupBy("column", *VALUE)
        .agg(F.sum(F.col("o") * F.col("o") / F.col("class_total")).alias("s"), F.sum("o").alias("total"))
    )
    per_feature = per_value.groupBy("column").agg(
        F.sum(F.col("s") / F.col("total")).alias("s"), F.sum("total").alias("n"), F.count(F.lit(1)).alias("n_values")
    )
    sizes = classes.groupBy("column").agg(F.count(F.lit(1)).alias("n_classes"))
    return per_feature.join(sizes, "column").select(
        column_name(features),
        (F.col("n") * (F.col("s") - 1)).alias("statistic"),
        ((F.col("n_values") - 1) * (F.col("n_classes") - 1)).alias("df"),
    )


def anova_f(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """One-way F statistic of each feature across the label's classes, from one scan.

    Infinite where the classes part perfectly, 0 for a constant or single-class feature.
    """
    return _anova(df, features, label).select("column_name", "f_value")


def _anova(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """The F statistic of each feature with the classes and the rows that it has values for."""
    stats = [f(c).alias(f"{n}_{c}") for c in features for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))]
    per_class = df.where(F.col(label).isNotNull()).groupBy(label).agg(*stats)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}_{c}").cast("double").alias(n) for n in ("n", "m", "v")])
            for c in features
        ]
    )
    by_class = per_class.select(F.inline(rows)).where(F.col("n") > 0)
    all_classes = Window.partitionBy("column_name")
    mean = F.sum(F.col("n") * F.col("m")).over(all_classes) / F.sum("n").over(all_classes)
    sums = (
        by_class.withColumn("mean", mean)
        .groupBy("column_name")
        .agg(
            F.sum(F.col("n") * (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean"))).alias("between"),
            F.sum(F.col("n") * F.col("v")).alias("within"),
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("k"),
        )
    )
    ratio = F.try_divide(
        F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("total") - F.col("k"))
    )
    f = F.when((F.col("within") == 0) & (F.col("between") > 0), F.lit(float("inf"))).otherwise(F.coalesce(ratio, F.lit(0.0)))
    return sums.select("column_name", f.alias("f_value"), "k", "total")


def top_by_anova(df: DataFrame, features: list[str], label: str, n: int) -> list[str]:
    """The ``n`` features least likely to be unrelated to the label, by ``anova_p``."""
    return [name for name, _ in anova_p(df, features, label)[:n]]


def anova_p(df: DataFrame, features: list[str], label: str) -> list[tuple[str, float]]:
    """Features with the logarithm of their F statistic's p-value, smallest first; then by F and name.

    Each feature counts its own classes and rows, so null counts may differ. Features without
    any value come last with 0, as do constant ones. One row a feature comes to the driver.
    """
    rows = {r.column_name: r for r in _anova(df, features, label).collect()}
    ranked = []
    for c in features:
        r = rows.get(c)
        ranked.append((log_f_tail(r.f_value, r.k - 1, r.total - r.k), -r.f_value, c) if r else (0.0, 0.0, c))
    return [(c, p) for p, _, c in sorted(ranked)]


def chi_square_p(df: DataFrame, features: list[str], label: str) -> list[tuple[str, float]]:
    """Features with the logarithm of their chi-square p-value, smallest first; then by statistic and name.

    The features may have any number of values, of any type. One row a feature comes to the driver.
    """
    rows = {r.column_name: r for r in chi_square_stats(df, features, label).collect()}
    ranked = []
    for c in features:
        r = rows.get(c)
        ranked.append((log_chi_square_tail(r.statistic, r.df), -r.statistic, c) if r else (0.0, 0.0, c))
    return [(c, p) for p, _, c in sorted(ranked)]


def top_by_chi_square(df: DataFrame, features: list[str], label: str, n: int) -> list[str]:
    return [name for name, _ in chi_square_p(df, features, label)[:n]]


def select_top(df: DataFrame, features: list[str], label: str, n: int, kind: str) -> tuple[DataFrame, list[str]]:
    """Add ``selectedFeatures`` with MLlib's selector; also the chosen names, in the
    order of their values in that vector.

    ``kind``: ``chisquare`` for categorical features, ``univariate`` for
    continuous ones. ``label`` must be numeric.
    """
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(df)
    selector = UnivariateFeatureSelector(
        featuresCol="features", outputCol="selectedFeatures", labelCol=label, selectionMode="numTopFeatures"
    )
    selector.setFeatureType("categorical" if kind == "chisquare" else "continuous")
    selector.setLabelType("categorical").setSelectionThreshold(n)
    model = selector.fit(assembled)
    return model.transform(assembled), [features[i] for i in sorted(model.selectedFeatures)]


def bin_equal_width(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """Replace continuous columns by bin numbers, to make them fit for chi-square."""
    row = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = {}
    for c in columns:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        width = ((hi - lo) / bins if hi is not None else 0.0) or 1.0
        out[c] = F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return df.withColumns(out)
