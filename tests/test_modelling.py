import numpy as np
import pytest
from conftest import bag
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from __spark_entry__ import QUERIES, SMOKE_DIR
from prepflow.catalog.preparation import LINE_KEY
from prepflow.operators import clean, knn, metrics, models
from prepflow.plans import modelling as flows
from prepflow.sources import files


@pytest.fixture(scope="module")
def rows(spark):
    """The label follows the features closely, the amount linearly with noise."""
    base = spark.range(1500).select(
        "id",
        (F.col("id") * 37 % 100).cast("double").alias("x"),
        F.concat(F.lit("g"), (F.col("id") % 4).cast("string")).alias("g"),
    )
    label = F.when(F.col("x") > 66, "high").when(F.col("g") == "g1", "one").otherwise("low")
    return base.withColumns({"y": label, "amount": F.col("x") * 3 + F.col("id") % 4 * 50}).cache()


@pytest.mark.parametrize("algorithm", ["RFC", "DTC", "GBTC"])
def test_classifiers_beat_the_majority(rows, algorithm):
    params = {"GBTC": {"maxIter": 3}, "RFC": {"numTrees": 10}}.get(algorithm)
    flow = flows.train(rows.drop("amount"), "y", ["id"], algorithm, params)
    out, accuracy = flows.test(rows.drop("amount"), flow, "accuracy")
    majority = rows.groupBy("y").count().agg(F.max("count")).first()[0] / rows.count()
    assert accuracy > majority + 0.2
    assert out.count() == flows.split_rows(rows, ["id"], 0.8)[1].count()


@pytest.mark.parametrize("algorithm", ["RFR", "GBTR"])
def test_regressors_beat_the_mean(rows, algorithm):
    flow = flows.train(rows.drop("y"), "amount", ["id"], algorithm, {"maxIter": 5} if algorithm == "GBTR" else {"numTrees": 10})
    assert flows.test(rows.drop("y"), flow, "r2")[1] > 0.7


def test_unknown_algorithm(rows):
    with pytest.raises(ValueError):
        models.estimator("SVM", "y", "features")


def test_training_again_gives_the_same_model(rows):
    df = rows.drop("amount")
    a, b = (bag(flows.predict(df, flows.train(df, "y", ["id"], "DTC")), "id", "prediction") for _ in range(2))
    assert a == b


def test_scoring_returns_each_key_once_and_survives_gaps(spark, rows, tmp_path):
    df = rows.drop("amount")
    flow = flows.train(df, "y", ["id"], "DTC")
    features, model = flows.load_parts(flows.save_flow(flow, str(tmp_path / "flow")), DecisionTreeClassificationModel)
    new = rows.drop("amount", "y").withColumn("x", F.when(F.col("id") % 5 > 0, F.col("x"))).withColumn("extra", F.lit("q"))
    imputer = clean.fit_imputer_both(rows.select("x", "g"), "median")
    out = flows.score(new.repartition(7), features, model, ["id"], imputer, ("extra", "not_there"))
    assert out.columns == ["id", "LOAN_CLASS", "LOAN_RATING"]
    assert [r[0] for r in bag(out, "id")] == list(range(1500))
    known = out.where("id % 5 > 0")
    direct = flows.predict(df, flow).where("id % 5 > 0")
    assert bag(known, "id", "LOAN_CLASS") == bag(direct, "id", "prediction")
    assert out.where("LOAN_RATING not between 0 and 100").count() == 0


def test_amount_scoring(rows):
    flow = flows.train(rows.drop("y"), "amount", ["id"], "RFR", {"numTrees": 5})
    out = flows.score(rows, flow.features, flow.model, ["id"], regression=True, number_prefix="M")
    assert out.columns == ["id", "PRINCIPAL_AMOUNT"] and out.count() == 1500


def test_multioutput(rows):
    df = rows.select("id", "x", (F.col("x") > 50).cast("double").alias("a"), (F.col("x") > 20).cast("double").alias("b"))
    features = models.fit_features(df, ("id", "a", "b"))
    fitted = models.fit_multioutput(features.transform(df), ["a", "b"], params={"numTrees": 5})
    out = models.predict_multioutput(features.transform(df), fitted, ["id", "a", "b"])
    got = metrics.accuracy_per_output(out, {"a": ("a", "a_predicted"), "b": ("b", "b_predicted")}).first()
    assert got.a > 0.95 and got.b > 0.95


# ---- metrics -----------------------------------------------------------------


@pytest.fixture(scope="module")
def judged(spark):
    return spark.range(1000).select((F.col("id") % 3).cast("double").alias("y"), (F.col("id") * 7 % 10 % 4).cast("double").alias("p")).cache()


@pytest.mark.parametrize("name", ["accuracy", "f1", "weightedPrecision", "weightedRecall", "hammingLoss"])
def test_classification_metrics_equal_mllib(judged, name):
    theirs = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(judged)
    assert metrics.evaluate(judged, "y", "p", name) == pytest.approx(theirs)


@pytest.mark.parametrize("name, options", [("weightedFMeasure", {"beta": 2.0}), ("weightedFalsePositiveRate", {}), ("recallByLabel", {"metricLabel": 1.0})])
def test_further_metrics_by_name(judged, name, options):
    theirs = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=name, **options).evaluate(judged)
    assert metrics.evaluate(judged, "y", "p", name, **options) == pytest.approx(theirs)


def test_output_report_is_a_full_matrix(spark):
    df = spark.createDataFrame([(1, 1, 0, 0), (1, 2, 0, None), (1, 1, None, None)], "a int, p int, b int, q int")
    out = metrics.output_report(df, {"x": ("a", "p"), "y": ("b", "q")})
    got = {tuple(r)[:4] for r in out.collect()}
    assert got == {("x", 1, 1, 2), ("x", 1, 2, 1), ("x", 2, 1, 0), ("x", 2, 2, 0), ("y", 0, 0, 1), ("y", 0, None, 1), ("y", None, 0, 0), ("y", None, None, 1)}
    assert {(r.output, round(r.accuracy, 3)) for r in out.collect()} == {("x", 0.667), ("y", 0.667)}
    assert metrics.output_report(df.limit(0), {"x": ("a", "p")}).count() == 0


@pytest.mark.parametrize("name", ["rmse", "mse", "mae", "r2", "var"])
def test_regression_metrics_equal_mllib(judged, name):
    theirs = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(judged)
    assert metrics.evaluate(judged, "y", "p", name) == pytest.approx(theirs)


def test_confusion_matrix_is_square_over_all_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "a")], "y string, p string")
    out = metrics.confusion_matrix(df, "y", "p")
    assert out.columns == ["actual", "p_a", "p_b", "p_c"]
    assert bag(out) == [("a", 1, 0, 1), ("b", 1, 0, 0), ("c", 0, 0, 0)]


# ---- nearest neighbours ------------------------------------------------------


def brute(train, asked, k, skip_self):
    found = []
    for q, v in asked:
        d = sorted((round(float(np.sqrt(((np.array(v) - np.array(t)) ** 2).sum())), 9), i) for i, t, _ in train if not (skip_self and i == q))
        found += [(q, i, rank + 1) for rank, (_, i) in enumerate(d[:k])]
    return sorted(found)


def vectors(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(5, dims)) * spread
    return [(int(i), (centre[i % 5] + rng.normal(size=dims)).tolist(), int(i % 5)) for i in range(n)]


@pytest.mark.parametrize("spread, blocks", [(0.0, 20_000), (20.0, 20_000), (5.0, 30)])
@pytest.mark.parametrize("skip_self", [False, True])
def test_neighbours_equal_brute_force(spark, monkeypatch, spread, blocks, skip_self):
    """Clustered and unclustered, also with blocks so small that cells and queries are cut up."""
    monkeypatch.setattr(knn, "BLOCK_ROWS", blocks)
    rows = vectors(300, 6, 3, spread)
    train = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    asked = train if skip_self else spark.createDataFrame([(i + 1000, v) for i, v, _ in vectors(80, 6, 4, spread)], "id bigint, v array<double>")
    near = knn.nearest_neighbours(train, asked, "id", "v", "y", 4, skip_self)
    queries = [(r.id, r.v) for r in asked.collect()]
    assert bag(near, "q", "id", "rank") == brute(rows, queries, 4, skip_self)


def test_neighbours_of_one_heavy_point(spark, monkeypatch):
    """Copies of one vector make up most of the data: one cell, cut into blocks."""
    monkeypatch.setattr(knn, "BLOCK_ROWS", 25)
    rows = [(i, [1.0, 1.0], 0) for i in range(150)] + [(150 + i, [float(i), 0.0], 1) for i in range(50)]
    train = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    near = knn.nearest_neighbours(train, train, "id", "v", "y", 3, skip_self=True)
    assert bag(near, "q", "id", "rank") == brute(rows, [(i, v) for i, v, _ in rows], 3, True)


@pytest.mark.parametrize("offset", [1e6, 1e7])
def test_neighbours_far_from_the_origin(spark, offset):
    rows = [(i, [x + offset for x in v], y) for i, v, y in vectors(300, 6, 3, 0.0)]
    train = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    near = knn.nearest_neighbours(train, train, "id", "v", "y", 5, skip_self=True)
    assert bag(near, "q", "id", "rank") == brute(rows, [(i, v) for i, v, _ in rows], 5, True)


def test_null_vectors_have_no_neighbours(spark):
    train = spark.createDataFrame([(1, [0.0], 7), (2, None, 8), (3, [5.0], 9)], "id bigint, v array<double>, y int")
    near = knn.nearest_neighbours(train, train, "id", "v", "y", 2)
    assert bag(near, "q", "id") == [(1, 1), (1, 3), (3, 1), (3, 3)]


def test_fewer_training_rows_than_neighbours(spark):
    train = spark.createDataFrame([(1, [0.0], 7), (2, [1.0], 8)], "id bigint, v array<double>, y int")
    asked = spark.createDataFrame([(9, [0.1])], "id bigint, v array<double>")
    assert bag(knn.knn_classify(train, asked, "id", "v", "y", 5)) == [(9, 7)]
    assert knn.knn_classify(train.limit(0), asked, "id", "v", "y", 5).count() == 0


def test_feature_rows_are_spread_only_when_needed(spark):
    one = spark.range(100).coalesce(1)
    assert models.spread(one, ["id"]).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 50)
    assert models.spread(many, ["id"]) is many


@pytest.mark.parametrize("algorithm, label", [("GBTC", "y"), ("GBTR", "amount")])
def test_boosting_passes_over_equal_rows_once(rows, monkeypatch, algorithm, label):
    df = rows.select("id", "x", "g", label)
    params = {"maxIter": 3, "maxBins": 128}
    fitted_on = []
    plain = models.fit_model
    monkeypatch.setattr(flows, "fit_model", lambda prepared, *a: fitted_on.append(prepared.count()) or plain(prepared, *a))
    counted = flows.predict(df, flows.train(df, label, ["id"], algorithm, params))
    one_by_one = flows.predict(df, flows.train(df, label, ["id"], algorithm, {**params, "minInstancesPerNode": 1}))
    assert fitted_on[0] <= 100 < fitted_on[1]
    a, b = (np.array(bag(out, "id", "prediction")) for out in (counted, one_by_one))
    assert np.allclose(a, b, atol=1e-6)


def test_rows_that_differ_or_lack_a_label_are_not_counted(rows):
    single = rows.withColumn("x", F.col("id") * 1.5)
    assert models.count_equal(single, "amount", ("id", "y"), "GBTR", None) is single
    gaps = rows.withColumn("amount", F.when(F.col("id") > 3, F.col("amount")))
    assert models.count_equal(gaps, "amount", ("id", "y"), "GBTR", None) is gaps
    assert models.count_equal(rows, "amount", ("id", "y"), "RFR", None) is rows
    assert models.count_equal(rows, "amount", ("id", "y"), "GBTR", None).agg(F.sum("_weight")).first()[0] == 1500


def test_pieces_of_a_training_table_have_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "PIECE_ROWS", 100, raising=False)
    df = models.spread(spark.range(1000).coalesce(1), ["id"])
    assert df.rdd.getNumPartitions() == 10 and df.count() == 1000
    assert models.spread(spark.range(0), ["id"]).count() == 0


def test_a_query_travels_once_to_a_group_of_cells(spark, monkeypatch):
    """Without clusters nearly every query visits every cell: many more cells than groups."""
    rows = vectors(900, 12, 5, 0.0)
    train = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    sent = []
    settle = knn.settle
    monkeypatch.setattr(knn, "settle", lambda df, label: sent.append((label, settle(df, label))) or sent[-1][1])
    near = knn.nearest_neighbours(train, train, "id", "v", "y", 3, skip_self=True)
    visits = dict(sent)["knn-visits"]
    travels = visits.select(F.size([c for c in visits.columns if c in ("groups", "cells")][0]).alias("n")).agg(F.max("n")).first()[0]
    assert travels <= 3 * spark.sparkContext.defaultParallelism
    assert bag(near, "q", "id", "rank") == brute(rows, [(i, v) for i, v, _ in rows], 3, True)


@pytest.mark.parametrize("name", ["score_regression", "rf_classify", "test_single_output", "score_classification"])
def test_a_query_trains_on_pieces_of_bounded_size(spark, monkeypatch, name):
    """A task of the forest reads one piece in each pass: its size mustn't follow the table."""
    monkeypatch.setattr(models, "PIECE_ROWS", 200, raising=False)
    pieces = []
    plain = models.fit_model

    def fit(prepared, *args):
        pieces.extend(r["count"] for r in prepared.groupBy(F.spark_partition_id()).count().collect())
        return plain(prepared, *args)

    monkeypatch.setattr(flows, "fit_model", fit)
    QUERIES[name](spark, SMOKE_DIR).first()
    assert max(pieces) <= 2 * models.PIECE_ROWS
    assert sum(pieces) == flows.split_rows(files.read_parquet(spark, SMOKE_DIR, "lineitem"), LINE_KEY, 0.8)[0].count()


def test_equal_rows_come_in_a_piece_for_each_core(spark, monkeypatch):
    """Not in as many as a shuffle happens to have: boosting starts a task a piece some hundred times."""
    rows = spark.range(2000).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 3).alias("c"))
    counted = models.count_equal(rows, "c", (), "GBTC")
    assert counted.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(models, "PIECE_ROWS", 3)
    more = models.count_equal(rows, "c", (), "GBTC")
    assert more.rdd.getNumPartitions() >= 6 and more.agg(F.sum("_weight")).first()[0] == 2000
    made = models.estimator("GBTC", "c", "Scaled_features", {"weightCol": "_weight"}, 3)
    assert made.getParallelism() == 3 and models.estimator("GBTC", "c", "Scaled_features", None, 3).getParallelism() == 1
