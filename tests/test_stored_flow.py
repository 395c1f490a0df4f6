import pytest
from conftest import bag
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from prepflow.operators.stages import CategoryCodes, CategoryCodesModel, FillMissing, SparseFeatures
from prepflow.plans import stored_flow as flows


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(1200).select(
        "id",
        F.when(F.col("id") % 11 > 0, (F.col("id") * 37 % 100).cast("double")).alias("x"),
        F.when(F.col("id") % 13 > 0, F.concat(F.lit("g"), (F.col("id") % 4).cast("string"))).alias("g"),
    )
    label = F.when(F.col("id") % 50 == 0, None).when(F.col("x") > 66, "high").when(F.col("g") == "g1", "one").otherwise("low")
    return base.withColumns({"y": label, "amount": F.col("x") * 3 + F.col("id") % 4 * 50})


@pytest.mark.parametrize("algorithm", ["RFC", "DTC"])
def test_round_trip_gives_the_same_split_classes_and_score(spark, rows, tmp_path, algorithm):
    df = rows.drop("amount")
    params = {"RFC": {"numTrees": 3}}.get(algorithm)
    flow = flows.train(df, "y", ["id"], algorithm, params)
    again = flows.StoredFlow.load(spark, flow.save(str(tmp_path / "flow")))
    assert again.record == flow.record and bag(again.classes) == bag(flow.classes)
    (a, first), (b, second) = flows.test(df, flow, "accuracy"), flows.test(df.repartition(5), again, "accuracy")
    assert first == second > 0.7
    assert bag(a, "id", "_label", "prediction") == bag(b, "id", "_label", "prediction")
    trained, held_out = flows.split(df, flow.record)
    assert trained.count() + held_out.count() == 1200
    assert a.count() == held_out.where("y IS NOT NULL").count()
    scored = flows.score(df.drop("y"), again)
    assert scored.count() == 1200 and {r[0] for r in scored.select("LOAN_CLASS").distinct().collect()} <= {"high", "one", "low"}


def test_replacements_come_from_the_training_split(rows):
    df = rows.drop("amount")
    flow = flows.train(df, "y", ["id"], "DTC")
    record = flow.record
    fit_on = flows.labelled(flows.split(df, record)[0], record, flow.classes)
    x = fit_on.where("x IS NOT NULL").approxQuantile("x", [0.5], 0.0)[0]
    learnt = flow.pipeline.stages[0].getOrDefault("replacements")
    assert float(learnt["x"][1]) == x and learnt["g"][0] == "string"


def test_a_changed_held_out_split_changes_nothing_fitted(rows):
    df = rows.drop("amount")
    flow = flows.train(df, "y", ["id"], "DTC")
    fit_on, held_out = flows.split(df, flow.record)
    other = fit_on.unionByName(held_out.withColumn("x", F.lit(1e9)).withColumn("g", F.lit("new")))
    again = flows.train(other, "y", ["id"], "DTC")
    assert bag(flows.predict(df, flow), "id", "prediction") == bag(flows.predict(df, again), "id", "prediction")


def test_amounts(spark, rows, tmp_path):
    df = rows.drop("y").where("x IS NOT NULL")
    flow = flows.train(df, "amount", ["id"], "RFR", {"numTrees": 5})
    again = flows.StoredFlow.load(spark, flow.save(str(tmp_path / "flow")))
    assert flows.test(df, again, "r2")[1] > 0.6
    assert flows.score(df, again).columns == ["id", "PRINCIPAL_AMOUNT"]


def codes_of(df, fitted):
    return [tuple(r) for r in fitted.transform(df).orderBy("id").select("id", "c_code").collect()]


def test_codes_by_frequency_with_error_skip_and_keep(spark, tmp_path):
    known = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "c"), (5, None)], "id long, c string")
    new = spark.createDataFrame([(1, "c"), (2, "z"), (3, None), (4, "b")], "id long, c string")
    keep = CategoryCodes(columns=["c"], invalid="keep").fit(known)
    keep.save(str(tmp_path / "codes"))
    for model in (keep, CategoryCodesModel.load(str(tmp_path / "codes"))):
        assert codes_of(new, model) == [(1, 2.0), (2, 3.0), (3, 3.0), (4, 0.0)] and model.width("c") == 4
    assert codes_of(new, CategoryCodes(columns=["c"], invalid="skip").fit(known)) == [(1, 2.0), (4, 0.0)]
    with pytest.raises(Exception, match="without a code"):
        codes_of(new, CategoryCodes(columns=["c"]).fit(known))
    with pytest.raises(ValueError):
        CategoryCodes(columns=["c"], invalid="drop")


def test_one_null_number_spoils_nothing(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", None), (3, "a", 0.0)], "id long, c string, `n.x` double")
    filled = FillMissing(strategy="mean", leaveOut=["id"]).fit(df.withColumnRenamed("n.x", "n")).transform(df.withColumnRenamed("n.x", "n"))
    coded = CategoryCodes(columns=["c"]).fit(filled).transform(filled)
    out = SparseFeatures(widths={"c": 2}, numbers=["n"]).transform(coded).orderBy("id").select("features").collect()
    assert [r[0].toArray().tolist() for r in out] == [[1.0, 0.0, 2.0], [0.0, 1.0, 1.0], [1.0, 0.0, 0.0]]
    bare = CategoryCodes(columns=["c"]).fit(df).transform(df)
    with pytest.raises(Exception, match="has a null"):
        SparseFeatures(widths={"c": 2}, numbers=["n.x"]).transform(bare).select("features").collect()


def test_many_categories_never_reach_the_driver(spark, monkeypatch):
    """No row of a code table is collected: only counts are."""
    from pyspark.sql.classic.dataframe import DataFrame

    df = spark.range(200_000).select("id", F.concat(F.lit("v"), F.col("id")).alias("c"))
    sizes, collect = [], DataFrame.collect

    def watched(self):
        found = collect(self)
        sizes.append(len(found))
        return found

    monkeypatch.setattr(DataFrame, "collect", watched)
    model = CategoryCodes(columns=["c"]).fit(df)
    assert model.width("c") == 200_000 and max(sizes, default=0) <= 1
    out = SparseFeatures(widths={"c": 200_000}, numbers=[]).transform(model.transform(df))
    assert out.where("id = 7").first()["features"].size == 200_000


def test_pipeline_of_own_stages_is_read_as_one(spark, rows, tmp_path):
    flow = flows.train(rows.drop("amount"), "y", ["id"], "DTC", strategy="mode")
    flow.pipeline.write().overwrite().save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    assert [type(s).__name__ for s in loaded.stages] == [type(s).__name__ for s in flow.pipeline.stages]
