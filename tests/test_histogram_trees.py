import numpy as np
import pytest
from pyspark.sql import functions as F

from prepflow.operators import histogram_trees as ht


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    df = spark.range(600).select("id", (i * 37 % 10).cast("double").alias("x"), F.when(i % 9 > 0, (i * 11 % 7).cast("double")).alias("z"))
    return df.withColumns({
        "a": F.when(F.col("x") > 6, 2).when(F.col("z") > 3, 1).otherwise(0),
        "b": (F.coalesce("z", F.lit(0)) > 2).cast("int"),
    }).withColumn("c", (F.col("a") + 3 * F.col("b") + i % 2).cast("int"))


CUTS = [np.arange(10.0), np.arange(7.0)]


def plain_bins(rows):
    data = rows.select("x", "z", "a", "b").collect()
    x = np.array([[0 if v is None else 1 + int(np.searchsorted(t, v)) for v, t in zip(r[:2], CUTS)] for r in data])
    return x, np.array([r[2:] for r in data])


def gini_sum(y):
    return sum(sum((y[:, o] == c).sum() ** 2 for c in set(y[:, o])) / len(y) for o in range(y.shape[1]))


def plain_tree(x, y, depth):
    """A tree by trying every feature and cut; a leaf holds the most frequent class of each output."""
    best = None
    for f in range(x.shape[1]):
        for cut in range(15):
            left = x[:, f] <= cut
            if 0 < left.sum() < len(x):
                g = gini_sum(y[left]) + gini_sum(y[~left]) - gini_sum(y)
                if best is None or g > best[0] + 1e-9:
                    best = (g, f, cut)
    if not depth or best is None or best[0] <= 1e-9:
        return {(): [int(np.bincount(y[:, o]).argmax()) for o in range(y.shape[1])]}
    _, f, cut = best
    return {"f": f, "cut": cut, "l": plain_tree(x[x[:, f] <= cut], y[x[:, f] <= cut], depth - 1), "r": plain_tree(x[x[:, f] > cut], y[x[:, f] > cut], depth - 1)}


def walk(tree, x):
    while "f" in tree:
        tree = tree["l"] if x[tree["f"]] <= tree["cut"] else tree["r"]
    return tree[()]


def test_joint_tree_equals_a_plain_one(rows):
    model = ht.fit_joint_forest(rows, ["x", "z"], ["a", "b"], ["id"], n_trees=1, depth=3, bins=16, bagging=False, thresholds=CUTS)
    x, y = plain_bins(rows)
    plain = plain_tree(x, y, 3)
    got = model.predict(rows).select("a_predicted", "b_predicted").collect()
    assert [tuple(r) for r in got] == [tuple(walk(plain, v)) for v in x]


def test_joint_forest_beats_the_majority_for_any_class_count(rows):
    model = ht.fit_joint_forest(rows, ["x", "z"], ["a", "b", "c"], ["id"], n_trees=5, depth=4)
    assert model.classes == [3, 2, 7]
    again = ht.fit_joint_forest(rows.repartition(7), ["x", "z"], ["a", "b", "c"], ["id"], n_trees=5, depth=4)
    out = model.predict(rows)
    for label in "abc":
        hit = out.agg(F.avg((F.col(label) == F.col(f"{label}_predicted")).cast("double"))).first()[0]
        most = rows.groupBy(label).count().agg(F.max("count")).first()[0] / 600
        assert hit > most + 0.1
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, again.predict(rows).collect()), key=str)


def plain_boosting(x, y, rounds, depth, rate, ridge):
    k = y.max() + 1
    share = np.bincount(y, minlength=k) + 1.0
    s = np.tile(np.log(share / share.sum()), (len(y), 1))

    def fit(rows, g, h, level):
        def part(m):
            return g[m].sum() ** 2 / (h[m].sum() + ridge)

        best = None
        for f in range(x.shape[1]):
            for cut in range(15):
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if len(left) and len(right):
                    gain = part(left) + part(right) - part(rows)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, left, right)
        if level == depth or best is None or best[0] <= 1e-9:
            return [(rows, -rate * g[rows].sum() / (h[rows].sum() + ridge))]
        return fit(best[1], g, h, level + 1) + fit(best[2], g, h, level + 1)

    for _ in range(rounds):
        p, step = ht.softmax(s), np.zeros_like(s)
        for c in range(k):
            for m, w in fit(np.arange(len(y)), p[:, c] - (y == c), p[:, c] * (1 - p[:, c]), 0):
                step[m, c] = w
        s += step
    return s


def test_boosting_equals_a_plain_one_and_the_loss_falls(rows):
    model = ht.fit_boosted(rows, ["x", "z"], "a", ["id"], rounds=3, depth=2, bins=16, thresholds=CUTS)
    x, y = plain_bins(rows)
    plain = plain_boosting(x, y[:, 0], 3, 2, 0.3, 1.0)
    assert np.allclose(model.scores(x.astype(np.uint8)), plain, atol=1e-6)
    assert all(b < a for a, b in zip(model.log_loss, model.log_loss[1:]))
    p = ht.softmax(plain)
    assert abs(model.log_loss[-1] + np.log(p[np.arange(len(y)), y[:, 0]]).mean()) < 1e-6
    got = [r[0] for r in model.predict(rows).select("a_predicted").collect()]
    assert got == plain.argmax(axis=1).tolist()


def test_null_labels_and_empty_tables(spark, rows):
    some = rows.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    model = ht.fit_boosted(some, ["x", "z"], "a", ["id"], rounds=1, depth=2)
    assert model.predict(some).count() == 600
    none = rows.where("id < 0")
    assert ht.fit_joint_forest(none, ["x"], ["a"], ["id"], n_trees=2).predict(rows).where("a_predicted = 0").count() == 600


def test_boosting_moves_equal_rows_once(rows, monkeypatch):
    written = []
    settle_at = ht.settle_at
    monkeypatch.setattr(ht, "settle_at", lambda df, label: written.append(settle_at(df, label)[0].count()) or settle_at(df, label))
    many = rows.crossJoin(rows.sparkSession.range(5).withColumnRenamed("id", "copy"))
    model = ht.fit_boosted(many, ["x", "z"], "a", ["id", "copy"], rounds=2, depth=2, thresholds=CUTS)
    kinds = rows.select("x", "z", "a").distinct().count()
    assert written == [kinds] * 3
    x, y = plain_bins(many)
    assert np.allclose(model.scores(x.astype(np.uint8)), plain_boosting(x, y[:, 0], 2, 2, 0.3, 1.0), atol=1e-6)
