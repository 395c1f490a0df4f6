"""Trees grown level by level from histograms: forests for several outputs at once, and boosting over several classes.

Rows are binned once and stay where they are. For each level, tasks add statistics up by
(tree, node, feature, bin) and Spark sums them; the best split of a node and feature is found where its
histogram lies, and only the winners, one row a node, reach the driver. The size of what moves
depends on the nodes, features, bins and classes, not on the rows.

A forest's split gains are summed over the outputs, so one tree predicts all of them. A boosting
round grows one tree a class on the softmax gradients, with second-order leaf weights.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepflow.sources.scratch import discard, settle_at

BINNED = "rid long, bins binary, labels array<int>"
POISSON = np.cumsum([0.36787944, 0.36787944, 0.18393972, 0.06131324, 0.01532831, 0.00306566])  # of mean 1


@dataclass
class Tree:
    """Nodes as in a heap: the children of i are 2i + 1 (bin up to the cut) and 2i + 2. feature -1: a leaf."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    stats: dict[int, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        self.feature, self.cut = np.full(2 ** (self.depth + 1), -1), np.zeros(2 ** (self.depth + 1), np.int64)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        at, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(self.depth):
            f = self.feature[at]
            at = np.where(f >= 0, 2 * at + 1 + (bins[row, np.maximum(f, 0)] > self.cut[at]), at)
        return at


# ---- bins ------------------------------------------------------------------------------


def fit_bins(df: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 2 ascending thresholds for each feature, at quantiles accurate to a 10,000th."""
    probs = F.array(*[F.lit(i / (bins - 1)) for i in range(1, bins - 1)])
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), probs, F.lit(10_000)).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [], np.float64)) for i in range(len(features))]


def binned(df: DataFrame, features: list[str], thresholds: list[np.ndarray], labels: list[str], key: list[str]) -> DataFrame:
    """rid, bins (a byte for each feature) and labels. Bin 0 holds nulls and NaN, bin i + 1 the values up to threshold i."""
    rid = F.xxhash64(*[F.col(f"`{c}`") for c in key])
    columns = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    coded = F.array(*[F.col(f"`{c}`").cast("int") for c in labels]).cast("array<int>")

    def run(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, len(features)), np.uint8)
            for i, t in enumerate(thresholds):
                x = batch.column(f"f{i}").to_numpy(zero_copy_only=False).astype(np.float64)
                out[:, i] = np.where(np.isnan(x), 0, 1 + np.searchsorted(t, x))
            cells = pa.array([r.tobytes() for r in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("rid"), cells, batch.column("labels")], names=["rid", "bins", "labels"])

    return df.select(rid.alias("rid"), coded.alias("labels"), *columns).mapInArrow(run, BINNED)


def bins_of(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, features)


def labels_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("labels").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


# ---- growth ----------------------------------------------------------------------------


def histograms(rows: DataFrame, trees: list[Tree], level: int, features: int, bins: int, statistics: Callable, width: int) -> DataFrame:
    """tree, node, feature, place (bin times ``width`` plus statistic) and x, summed over all rows.

    ``statistics(batch)`` gives for each tree the rows' statistics, (rows, ``width``).
    """
    first = 2**level - 1

    def run(batches):
        total = np.zeros((len(trees), first + 1, features, bins * width))
        for batch in batches:
            b = bins_of(batch, features)
            for t, s in enumerate(statistics(batch)):
                node = trees[t].nodes(b) - first
                here = np.flatnonzero(node >= 0)
                for f in range(features):
                    place = (node[here] * bins + b[here, f]) * width
                    for i in range(width):
                        sums = np.bincount(place + i, s[here, i], (first + 1) * bins * width)
                        total[t, :, f] += sums.reshape(first + 1, -1)
        at = np.nonzero(total)
        values = [pa.array(a.astype(np.int32)) for a in at]
        yield pa.RecordBatch.from_arrays([values[0], pa.array(at[1].astype(np.int32) + first), *values[2:], pa.array(total[at])], names=["tree", "node", "feature", "place", "x"])

    found = rows.mapInArrow(run, "tree int, node int, feature int, place int, x double")
    return found.groupBy("tree", "node", "feature", "place").agg(F.sum("x").alias("x"))


def best_splits(sums: DataFrame, bins: int, width: int, gain: Callable, allowed: Callable) -> list:
    """One row for each (tree, node): the split with the highest gain (ties: lower feature, then lower cut) and both sides' statistics."""

    def run(key, pdf):
        import pandas as pd

        tree, node, feature = (int(k) for k in key)
        h = np.zeros(bins * width)
        h[pdf["place"]] = pdf["x"]
        left = np.cumsum(h.reshape(bins, width), axis=0)
        whole = left[-1]
        gains = np.array([gain(x, whole - x, whole) for x in left[:-1]]) if allowed(tree, node, feature) else np.zeros(0)
        cut = int(gains.argmax()) if len(gains) else -1
        best = float(gains[cut]) if cut >= 0 else float("-inf")
        return pd.DataFrame({"tree": [tree], "node": [node], "feature": [feature], "gain": [best], "cut": [cut], "left": [left[cut].tolist()], "whole": [whole.tolist()]})

    schema = "tree int, node int, feature int, gain double, cut int, left array<double>, whole array<double>"
    each = sums.groupBy("tree", "node", "feature").applyInPandas(run, schema)
    best = F.max(F.struct("gain", (-F.col("feature")).alias("f"), "cut", "left", "whole")).alias("best")
    return each.groupBy("tree", "node").agg(best).collect()  # at most trees x nodes rows


def grow(rows: DataFrame, n: int, depth: int, features: int, bins: int, statistics: Callable, width: int, gain: Callable, allowed: Callable, least_gain: float = 1e-9) -> list[Tree]:
    """``n`` trees, all grown together, so each level is one pass over the rows."""
    trees = [Tree(depth) for _ in range(n)]
    for level in range(depth):
        split = False
        for r in best_splits(histograms(rows, trees, level, features, bins, statistics, width), bins, width, gain, allowed):
            tree, node, b = trees[r["tree"]], r["node"], r["best"]
            whole, left = np.array(b["whole"]), np.array(b["left"])
            tree.stats[node] = whole
            if b["gain"] > least_gain:
                tree.feature[node], tree.cut[node] = -b["f"], b["cut"]
                tree.stats[2 * node + 1], tree.stats[2 * node + 2] = left, whole - left
                split = True
        if not split:
            break
    return trees


# ---- forests for several outputs ---------------------------------------------------------


@dataclass
class JointForest:
    features: list[str]
    thresholds: list[np.ndarray]
    labels: list[str]
    classes: list[int]
    trees: list[Tree]

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<label>_predicted``: the class with the highest mean share in the leaves (ties: the lowest)."""
        edges = np.cumsum([0, *self.classes])
        tables = []
        for t in self.trees:
            table = np.zeros((len(t.feature), edges[-1]))
            for node, s in t.stats.items():
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    table[node, a:b] = s[a:b] / max(s[a:b].sum(), 1e-300)
            tables.append(table)
        trees = self.trees

        def vote(bins: np.ndarray) -> np.ndarray:
            share = sum(table[t.nodes(bins)] for t, table in zip(trees, tables, strict=True))
            return np.stack([share[:, a:b].argmax(axis=1) for a, b in zip(edges[:-1], edges[1:], strict=True)], axis=1)

        return with_predictions(df, self.features, self.thresholds, vote, [f"{c}_predicted" for c in self.labels])


def with_predictions(df: DataFrame, features: list[str], thresholds: list[np.ndarray], vote: Callable, names: list[str]) -> DataFrame:
    """``df`` with the columns of ``vote(bins)``; only the features go through Python."""

    @F.pandas_udf("array<int>")
    def classes(x):
        import pandas as pd

        bins = np.zeros((len(x), len(features)), np.uint8)
        values = np.array(x.tolist(), np.float64).reshape(len(x), len(features))
        for i, t in enumerate(thresholds):
            bins[:, i] = np.where(np.isnan(values[:, i]), 0, 1 + np.searchsorted(t, values[:, i]))
        return pd.Series(list(vote(bins).astype(np.int32)))

    whole = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in features])
    out = df.withColumn("_classes", classes(whole))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("_classes")[i].alias(n) for i, n in enumerate(names)])


def fit_joint_forest(
    df: DataFrame, features: list[str], labels: list[str], key: list[str], n_trees: int = 20, depth: int = 5, bins: int = 32,
    feature_share: float = 1.0, bagging: bool = True, seed: int = 12345, thresholds: list[np.ndarray] | None = None,
) -> JointForest:
    """One tree a draw for all ``labels`` (classes 0, 1, ... as integers, any number), split by the summed fall of Gini impurity.

    Rows with a null label or a negative one are left out. ``key`` names a row, so its weight in each tree (Poisson, as
    in a bootstrap) doesn't depend on partitions. At each node a hash picks ``feature_share`` of the features, one at least.
    """
    if bins > 256:
        raise ValueError("a bin is a byte: at most 256 bins")
    good = df
    for c in labels:
        good = good.where(F.col(f"`{c}`").cast("int") >= 0)
    thresholds = fit_bins(good, features, bins) if thresholds is None else thresholds
    rows, path = settle_at(binned(good, features, thresholds, labels, key), "binned")
    top = rows.agg(*[F.max(F.col("labels")[i]).alias(f"c{i}") for i in range(len(labels))]).first()
    classes = [(m if m is not None else 0) + 1 for m in top]
    edges, width = np.cumsum([0, *classes]), sum(classes)

    def statistics(batch):
        y = labels_of(batch)
        one = np.zeros((len(y), width))
        for o in range(y.shape[1]):
            one[np.arange(len(y)), edges[o] + y[:, o]] = 1
        rid = batch.column("rid").to_numpy()
        for t in range(n_trees):
            yield one * draws(rid, seed, t)[:, None] if bagging else one

    def purity(s: np.ndarray) -> float:
        return sum(float((s[a:b] ** 2).sum() / max(s[a:b].sum(), 1e-300)) for a, b in zip(edges[:-1], edges[1:], strict=True))

    def gain(left, right, whole):
        return purity(left) + purity(right) - purity(whole) if left.sum() > 0 and right.sum() > 0 else float("-inf")

    picked = max(1, round(feature_share * len(features)))

    def allowed(tree, node, feature):
        order = np.random.default_rng([seed, tree, node]).permutation(len(features))
        return picked == len(features) or feature in order[:picked]

    trees = grow(rows, n_trees, depth, len(features), bins, statistics, width, gain, allowed)
    discard(df.sparkSession, path)
    return JointForest(features, thresholds, labels, classes, trees)


def draws(rid: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is in a tree's sample: Poisson of mean 1, by a hash of the row."""
    x = rid.view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xBF58476D1CE4E5B9) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = (x ^ (x >> np.uint64(31))).astype(np.float64) / 2.0**64
    return np.searchsorted(POISSON, u, "right").astype(np.float64)


# ---- boosting over several classes -------------------------------------------------------


@dataclass
class Boosted:
    features: list[str]
    thresholds: list[np.ndarray]
    label: str
    classes: int
    start: np.ndarray
    rounds: list[list[tuple[Tree, np.ndarray]]]
    log_loss: list[float]  # of the training rows: at the start and after each round

    def scores(self, bins: np.ndarray) -> np.ndarray:
        out = np.tile(self.start, (len(bins), 1))
        for trees in self.rounds:
            for k, (tree, weight) in enumerate(trees):
                out[:, k] += weight[tree.nodes(bins)]
        return out

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<label>_predicted``, the class with the highest score (ties: the lowest)."""
        return with_predictions(df, self.features, self.thresholds, lambda b: self.scores(b).argmax(axis=1)[:, None], [f"{self.label}_predicted"])


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_boosted(
    df: DataFrame, features: list[str], label: str, key: list[str], rounds: int = 10, depth: int = 4, bins: int = 32,
    rate: float = 0.3, ridge: float = 1.0, thresholds: list[np.ndarray] | None = None,
) -> Boosted:
    """Softmax boosting: each round grows one tree a class on gradients p - y and curvatures p (1 - p); a leaf weighs -G / (H + ridge).

    The classes are 0, 1, ... as integers, any number; rows with a null or negative label are left out. Scores
    start at the classes' log shares. Rows of equal bins and label have equal scores and statistics all along, so
    they are one row with their number, and its scores are written along with it once a round.
    """
    if bins > 256:
        raise ValueError("a bin is a byte: at most 256 bins")
    good = df.where(F.col(f"`{label}`").cast("int") >= 0)
    thresholds = fit_bins(good, features, bins) if thresholds is None else thresholds
    spark, n = df.sparkSession, len(features)
    same = binned(good, features, thresholds, [label], key).groupBy("bins", "labels").agg(F.count("*").alias("n"))
    rows, path = settle_at(same, "binned")
    counts = {r["c"]: r["n"] for r in rows.groupBy(F.col("labels")[0].alias("c")).agg(F.sum("n").alias("n")).collect()}
    k = max(counts, default=0) + 1
    share = np.array([counts.get(c, 0) + 1.0 for c in range(k)])
    model = Boosted(features, thresholds, label, k, np.log(share / share.sum()), [], [])
    start = model.start.tolist()
    rows = rows.withColumn("scores", F.array(*[F.lit(x) for x in start]).cast("array<double>"))

    def scores_of(batch):
        return batch.column("scores").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, k)

    def statistics(batch):
        p, y, times = softmax(scores_of(batch)), labels_of(batch)[:, 0], batch.column("n").to_numpy()
        for c in range(k):
            yield np.stack([p[:, c] - (y == c), p[:, c] * (1 - p[:, c])], axis=1) * times[:, None]

    def part(s):
        return float(s[0] ** 2 / (s[1] + ridge))

    def gain(left, right, whole):
        return part(left) + part(right) - part(whole) if left[1] > 1e-12 and right[1] > 1e-12 else float("-inf")

    def advance(trees):
        def run(batches):
            for batch in batches:
                b, s = bins_of(batch, n), scores_of(batch).copy()
                for c, (tree, weight) in enumerate(trees):
                    s[:, c] += weight[tree.nodes(b)]
                scores = pa.ListArray.from_arrays(pa.array(np.arange(0, s.size + 1, k, dtype=np.int32)), pa.array(s.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("labels"), batch.column("n"), scores], names=["bins", "labels", "n", "scores"])

        return run

    right = F.element_at("scores", F.col("labels")[0] + 1)
    top = F.array_max("scores")
    loss = F.sum((F.log(F.aggregate("scores", F.lit(0.0), lambda a, x: a + F.exp(x - top))) + top - right) * F.col("n")) / F.sum("n")
    for _ in range(rounds):
        model.log_loss.append(rows.agg(loss).first()[0])
        grown = grow(rows, k, depth, n, bins, statistics, 2, gain, lambda *_: True)
        trees = []
        for tree in grown:
            weight = np.zeros(len(tree.feature))
            for node, s in tree.stats.items():
                weight[node] = -rate * s[0] / (s[1] + ridge)
            trees.append((tree, weight))
        model.rounds.append(trees)
        old = path
        rows, path = settle_at(rows.mapInArrow(advance(trees), "bins binary, labels array<int>, n long, scores array<double>"), "scores")
        discard(spark, old)
    model.log_loss.append(rows.agg(loss).first()[0])
    discard(spark, path)
    return model
