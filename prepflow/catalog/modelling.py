"""Queries that fit models, predict, and measure predictions.

Tree models have no SQL equivalent. Where a query's point is something SQL can
state (which rows are scored, whether a reloaded model agrees), the reference
SQL states that; elsewhere there is none and the tests cover the operator.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import functions as F

from prepflow.catalog.preparation import LINE_KEY, _wide_hash_sql
from prepflow.catalog.registry import query
from prepflow.catalog.relational import lineitem, round_sql, rounded
from prepflow.operators import clean, histogram_trees, knn, metrics, models, stages
from prepflow.plans import modelling as flows
from prepflow.plans import stored_flow
from prepflow.sources import files
from prepflow.sources.scratch import scratch_path

FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linestatus"]
FOREST = {"numTrees": 20, "maxDepth": 5, "maxBins": 32}
_KEYS = ", ".join(LINE_KEY)


def _line_rows(spark, folder):
    rows = lineitem(spark, folder).select(*LINE_KEY, *FEATURES, "l_returnflag", "l_extendedprice")
    return models.spread(rows, LINE_KEY)


def _predictions(spark, folder, label, algorithm, params=None):
    df = _line_rows(spark, folder)
    flow = flows.train(df, label, LINE_KEY, algorithm, params)
    return df, flow, flows.predict(df, flow)


def _shown(predictions):
    return predictions.select(*LINE_KEY, F.col("_label").alias("actual"), "prediction")


@query("rf_classify")
def rf_classify(spark, folder):
    return _shown(_predictions(spark, folder, "l_returnflag", "RFC", FOREST)[2])


@query("dt_classify")
def dt_classify(spark, folder):
    return _shown(_predictions(spark, folder, "l_returnflag", "DTC")[2])


@query("gbt_regress")
def gbt_regress(spark, folder):
    return _shown(_predictions(spark, folder, "l_extendedprice", "GBTR")[2])


@query("rf_regress")
def rf_regress(spark, folder):
    return _shown(_predictions(spark, folder, "l_extendedprice", "RFR", FOREST)[2])


@query("gbt_classify")
def gbt_classify(spark, folder):
    return _shown(_predictions(spark, folder, "l_returnflag", "GBTC")[2])


def _outputs(spark, folder):
    """Several label columns for the same features."""
    return lineitem(spark, folder).select(
        *LINE_KEY,
        "l_quantity",
        "l_discount",
        "l_tax",
        (F.ascii("l_returnflag") % 3).cast("double").alias("y_flag"),
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("y_status"),
        F.when(F.col("l_extendedprice") > 50_000, 1.0).otherwise(0.0).alias("y_price"),
    )


_Y = ["y_flag", "y_status", "y_price"]


def _multi(spark, folder):
    df = models.spread(_outputs(spark, folder), LINE_KEY)
    fit_on, held_out = flows.split_rows(df, LINE_KEY, 0.8)
    features = models.fit_features(fit_on, (*LINE_KEY, *_Y))
    fitted = models.fit_multioutput(features.transform(fit_on), _Y, params={"numTrees": 20, "maxDepth": 5})
    return df, held_out, features, fitted


@query("rf_multioutput")
def rf_multioutput(spark, folder):
    df, _, features, fitted = _multi(spark, folder)
    return models.predict_multioutput(features.transform(df), fitted, [*LINE_KEY, *_Y])


_KNN_SQL = (
    "with d as (select a.vec_id, b.vec_id as other, b.label, "
    "round(sqrt(list_sum(list_transform(list_zip(a.embedding::double[], b.embedding::double[]), lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 9) as dist "
    "from embeddings a join embeddings b on a.vec_id <> b.vec_id), "
    "r as (select *, row_number() over (partition by vec_id order by dist, other) as rk from d), "
    "v as (select vec_id, label, count(*) as n from r where rk <= 5 group by 1, 2) "
    "select vec_id, label as predicted from (select *, row_number() over (partition by vec_id order by n desc, label) as p from v) where p = 1"
)


@query("knn_classify", _KNN_SQL)
def knn_classify(spark, folder):
    """Every vector is labelled by its five nearest other vectors."""
    vectors = files.read_parquet(spark, folder, "embeddings")
    return knn.knn_classify(vectors, vectors, "vec_id", "embedding", "label", 5, skip_self=True)


# ---- metrics on a rule's predictions -----------------------------------------

_RULE = "(select l_returnflag as actual, case when l_quantity > 35 then 'A' when l_quantity > 15 then 'N' else 'R' end as predicted from lineitem)"


def _ruled(spark, folder):
    quantity = F.col("l_quantity")
    predicted = F.when(quantity > 35, "A").when(quantity > 15, "N").otherwise("R")
    return lineitem(spark, folder).select(F.col("l_returnflag").alias("actual"), predicted.alias("predicted"))


@query(
    "metric_classification",
    f"with c as (select k, (select count(*) from {_RULE} where actual = k)::double as r, (select count(*) from {_RULE} where predicted = k)::double as s, "
    f"(select count(*) from {_RULE} where actual = k and predicted = k)::double as h from (select distinct l_returnflag as k from lineitem)) select "
    + ", ".join(
        f'{round_sql(value, 6)} as "{name}"'
        for name, value in {
            "accuracy": "sum(h) / sum(r)",
            "f1": "sum(r * 2 * h / (r + s)) / sum(r)",
            "weightedPrecision": "sum(r * h / s) / sum(r)",
            "weightedRecall": "sum(h) / sum(r)",
            "hammingLoss": "(1 - sum(h) / sum(r))",
        }.items()
    )
    + " from c",
)
def metric_classification(spark, folder):
    return rounded(metrics.classification_metrics(_ruled(spark, folder), "actual", "predicted"), [], 6)


_LINEAR = "(select l_extendedprice as y, 2000 + 2000 * l_quantity as p from lineitem)"


@query(
    "metric_regression",
    f"with m as (select avg(y) as ym from {_LINEAR}) select "
    + ", ".join(
        f'{round_sql(value, 2)} as "{name}"'
        for name, value in {
            "rmse": "sqrt(avg((y - p) * (y - p)))",
            "mse": "avg((y - p) * (y - p))",
            "mae": "avg(abs(y - p))",
            "var": "avg((p - ym) * (p - ym))",
        }.items()
    )
    + f", {round_sql('(1 - sum((y - p) * (y - p)) / sum((y - ym) * (y - ym)))', 6)} as r2 from {_LINEAR}, m",
)
def metric_regression(spark, folder):
    df = lineitem(spark, folder).select(F.col("l_extendedprice").alias("y"), (2000 + 2000 * F.col("l_quantity")).alias("p"))
    out = metrics.regression_metrics(df, "y", "p")
    return rounded(rounded(out, ["r2"], 2), ["rmse", "mse", "mae", "var"], 6)


_STATUS_HIT = "avg(((l_linestatus = 'O') = (l_quantity > 25))::int)"


@query(
    "accuracy_per_output",
    f"select {round_sql('avg((ascii(l_returnflag) % 3 = (l_linenumber % 3))::int)', 6)} as flag, "
    f"{round_sql(_STATUS_HIT, 6)} as status from lineitem",
)
def accuracy_per_output(spark, folder):
    df = lineitem(spark, folder).select(
        (F.ascii("l_returnflag") % 3).alias("a1"),
        (F.col("l_linenumber") % 3).alias("p1"),
        (F.col("l_linestatus") == "O").cast("int").alias("a2"),
        (F.col("l_quantity") > 25).cast("int").alias("p2"),
    )
    return rounded(metrics.accuracy_per_output(df, {"flag": ("a1", "p1"), "status": ("a2", "p2")}), [], 6)


@query(
    "confusion_matrix",
    "select k as actual, "
    + ", ".join(f"(select count(*) from {_RULE} where actual = k and predicted = '{p}') as \"p_{p}\"" for p in "ANR")
    + " from (select distinct l_returnflag as k from lineitem)",
)
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_ruled(spark, folder), "actual", "predicted")


@query("prediction_pairs")
def prediction_pairs(spark, folder):
    """Actual and predicted label of the held-out rows."""
    df, flow, _ = _predictions(spark, folder, "l_returnflag", "DTC")
    _, held_out = flows.split_rows(df, LINE_KEY, flow.fraction)
    out = flows.predict(held_out, flow)
    return metrics.prediction_pairs(out, LINE_KEY, "_label", "prediction").withColumnRenamed("_label", "actual")


# ---- flows -------------------------------------------------------------------


@query("model_roundtrip", f"select {_KEYS}, true as same from lineitem")
def model_roundtrip(spark, folder):
    """A saved and reloaded flow predicts what the fitted one predicts, row by row."""
    df, flow, _ = _predictions(spark, folder, "l_returnflag", "DTC")
    features, model = flows.load_parts(flows.save_flow(flow, scratch_path(spark, "flow")), DecisionTreeClassificationModel)
    fresh = flow.model.transform(flow.features.transform(df)).select(*df.columns, F.col("prediction").alias("fresh"))
    both = model.transform(features.transform(fresh))
    return both.select(*LINE_KEY, (F.col("prediction") == F.col("fresh")).alias("same"))


@query("score_with_key", f"select {_KEYS}, true as scored from lineitem")
def score_with_key(spark, folder):
    """Every input row is scored once, and the score stays with its key."""
    df, flow, _ = _predictions(spark, folder, "l_returnflag", "DTC")
    out = flows.score(df, flow.features, flow.model, LINE_KEY)
    return out.select(*LINE_KEY, F.col("LOAN_CLASS").isNotNull().alias("scored"))


def _with_gaps(df):
    return df.withColumns(
        {
            "l_quantity": F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")),
            "l_linestatus": F.when(F.col("l_orderkey") % 5 != 0, F.col("l_linestatus")),
            "source": F.lit("web"),
        }
    )


def _scored(spark, folder, label, algorithm, params):
    """Impute, drop the constant column, train, then score all rows with the stored parts."""
    rows = lineitem(spark, folder).select(*LINE_KEY, *FEATURES, "l_returnflag", "l_extendedprice")
    imputer = clean.fit_imputer_both(_with_gaps(rows), "median", leave_out=(label, *LINE_KEY))
    df = _with_gaps(models.spread(rows, LINE_KEY))
    dropped = ("source", label)
    flow = flows.train(clean.apply_imputer(df, imputer).drop("source"), label, LINE_KEY, algorithm, params)
    return flows.score(
        df, flow.features, flow.model, LINE_KEY, imputer, dropped, number_prefix="M", regression=flow.regression
    )


@query("score_classification")
def score_classification(spark, folder):
    return _scored(spark, folder, "l_returnflag", "RFC", FOREST)


@query("score_regression")
def score_regression(spark, folder):
    return _scored(spark, folder, "l_extendedprice", "RFR", FOREST)


_ROW_TEXT = "concat_ws('|', " + ", ".join(f"{c}::varchar" for c in LINE_KEY) + ")"
_ROW_WIDE = _wide_hash_sql(f"12345::varchar || chr(45) || {_ROW_TEXT}")


@query(
    "stored_flow_test",
    f"with c as (select l_returnflag, row_number() over (order by count(*) desc, l_returnflag) - 1 as code from lineitem where {_ROW_WIDE} < {int(0.8 * (1 << 60))} group by 1) "
    f"select {_KEYS}, code::double as actual, true as same from lineitem join c using (l_returnflag) where {_ROW_WIDE} >= {int(0.8 * (1 << 60))}",
)
def stored_flow_test(spark, folder):
    """Train and store, then load and test: the same held-out rows, classes and predictions as the flow in memory."""
    df = _with_gaps(lineitem(spark, folder).select(*LINE_KEY, *FEATURES, "l_returnflag")).drop("source")
    fitted = stored_flow.train(df, "l_returnflag", LINE_KEY, "DTC")
    loaded = stored_flow.StoredFlow.load(spark, fitted.save(scratch_path(spark, "flow")))
    fresh = stored_flow.test(df, fitted, "accuracy")[0].select(*LINE_KEY, F.col("prediction").alias("fresh"))
    out = stored_flow.test(df, loaded, "accuracy")[0].join(fresh, LINE_KEY)
    return out.select(*LINE_KEY, F.col("_label").alias("actual"), (F.col("prediction") == F.col("fresh")).alias("same"))


@query("stored_flow_score", f"select {_KEYS}, true as known, true as rated from lineitem")
def stored_flow_score(spark, folder):
    """Rows without their label, scored by a stored flow that fills and codes them itself: each key once, with a class of the label."""
    df = _with_gaps(lineitem(spark, folder).select(*LINE_KEY, *FEATURES, "l_returnflag")).drop("source")
    path = stored_flow.train(df, "l_returnflag", LINE_KEY, "DTC", strategy="mode").save(scratch_path(spark, "flow"))
    out = stored_flow.score(df.drop("l_returnflag"), stored_flow.StoredFlow.load(spark, path))
    return out.select(*LINE_KEY, F.col("LOAN_CLASS").isin("A", "N", "R").alias("known"), F.col("LOAN_RATING").between(0, 100).alias("rated"))


_CODED = "row_number() over (order by count(*) desc, {c}) - 1 as code, {c} from lineitem group by {c}"


@query(
    "category_vector",
    f"with m as (select {_CODED.format(c='l_returnflag')}), i as (select {_CODED.format(c='l_linestatus')}), "
    "n as (select (select count(*) from m) as m, (select count(*) from i) as i) "
    f"select {_KEYS}, m.code::int as flag_at, (n.m + i.code)::int as status_at, l_quantity::double as quantity, (n.m + n.i + 1)::int as size "
    "from lineitem join m using (l_returnflag) join i using (l_linestatus), n",
)
def category_vector(spark, folder):
    """Indicators and a number as one sparse vector, from code tables that rows are joined to."""
    df = lineitem(spark, folder).select(*LINE_KEY, "l_returnflag", "l_linestatus", F.col("l_quantity").cast("double").alias("l_quantity"))
    out = stages.VectorStages(leaveOut=list(LINE_KEY)).fit(df).transform(df)
    # the stored form of a sparse vector: its size, positions and values
    parts = F.from_json(F.to_json(F.struct("features")), "features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>")["features"]
    return out.select(*LINE_KEY, parts["indices"][0].alias("flag_at"), parts["indices"][1].alias("status_at"), parts["values"][2].alias("quantity"), parts["size"].alias("size"))


@query("score_multioutput")
def score_multioutput(spark, folder):
    df, _, features, fitted = _multi(spark, folder)
    return models.predict_multioutput(features.transform(df), fitted, LINE_KEY)


@query("train_single_output")
def train_single_output(spark, folder):
    """Quality on the training split, one row per metric."""
    df = _line_rows(spark, folder)
    flow = flows.train(df, "l_returnflag", LINE_KEY, "RFC", FOREST)
    fit_on, _ = flows.split_rows(df, LINE_KEY, flow.fraction)
    return metrics.classification_metrics(flows.predict(fit_on, flow), "_label", "prediction")


@query("test_single_output")
def test_single_output(spark, folder):
    """Quality on the held-out split with the stored features and model."""
    df, flow, _ = _predictions(spark, folder, "l_extendedprice", "RFR", FOREST)
    _, held_out = flows.split_rows(df, LINE_KEY, flow.fraction)
    return metrics.regression_metrics(flows.predict(held_out, flow), "_label", "prediction")


@query("test_multioutput")
def test_multioutput(spark, folder):
    """Accuracy and the full confusion matrix of each output on the held-out split."""
    _, held_out, features, fitted = _multi(spark, folder)
    out = models.predict_multioutput(features.transform(held_out), fitted, [*LINE_KEY, *_Y])
    return metrics.output_report(out, {y: (y, f"{y}_predicted") for y in _Y})


# ---- trees from histograms -----------------------------------------------------

_BAND = "floor((l_quantity + 100 * l_discount) / 10)::int"
_MUCH = "(l_quantity * (1 - l_discount) > 20)::int"
_SPLIT = int(0.8 * (1 << 60))


def _bands(spark, folder):
    df = lineitem(spark, folder).select(*LINE_KEY, "l_quantity", "l_discount", "l_tax")
    band = F.floor((F.col("l_quantity") + 100 * F.col("l_discount")) / 10).cast("int")
    return df.withColumns({"band": band, "much": (F.col("l_quantity") * (1 - F.col("l_discount")) > 20).cast("int")})


@query(
    "joint_forest",
    f"with h as (select {_BAND} as band, {_MUCH} as much from lineitem where {_ROW_WIDE} >= {_SPLIT}), "
    "b as (select count(*) as n from h group by band), d as (select count(*) as n from h group by much) "
    "select 'band' as output, sum(n)::bigint as held_out, max(n) as majority, true as beaten from b "
    "union all select 'much', sum(n)::bigint, max(n), true from d",
)
def joint_forest(spark, folder):
    """One forest for two outputs, against always guessing the most frequent class of the held-out rows."""
    fit_on, held_out = flows.split_rows(_bands(spark, folder), LINE_KEY, 0.8)
    model = histogram_trees.fit_joint_forest(fit_on, ["l_quantity", "l_discount", "l_tax"], ["band", "much"], LINE_KEY, n_trees=10)
    out = model.predict(held_out)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("output"), F.col(c).alias("y"), F.col(f"{c}_predicted").alias("p")) for c in model.labels]))
    classes = out.select(cells.alias("c")).groupBy("c.output", "c.y").agg(F.count("*").alias("n"), F.count_if(F.col("c.y") == F.col("c.p")).alias("hits"))
    best = classes.groupBy("output").agg(F.sum("n").alias("held_out"), F.max("n").alias("majority"), F.sum("hits").alias("hits"))
    return best.select("output", "held_out", "majority", (F.col("hits") > F.col("majority")).alias("beaten"))


@query(
    "softmax_boosting",
    f"select r::int as round, (select count(*) from lineitem where {_ROW_WIDE} < {_SPLIT}) as trained, true as falls from range(1, 6) t(r)",
)
def softmax_boosting(spark, folder):
    """The training log loss of all classes together falls in every round."""
    fit_on, _ = flows.split_rows(_bands(spark, folder), LINE_KEY, 0.8)
    model = histogram_trees.fit_boosted(fit_on, ["l_quantity", "l_discount", "l_tax"], "band", LINE_KEY, rounds=5, depth=3)
    steps = [(i + 1, b < a) for i, (a, b) in enumerate(zip(model.log_loss[:-1], model.log_loss[1:], strict=True))]
    return spark.createDataFrame(steps, "round int, falls boolean").join(fit_on.agg(F.count("*").alias("trained"))).select("round", "trained", "falls")
