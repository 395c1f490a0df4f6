"""NaN, null, constant and awkward text in the operators for tables."""

import math
from decimal import Decimal

from conftest import bag
from pyspark.sql import functions as F

from prepflow.operators import aggregate, metrics, mutate, outliers, sampling, scale, select
from prepflow.sources import files, tables
from prepflow.sources.scratch import clear_scratch, scratch_path, settle


def test_nan_is_no_outlier(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v")).union(spark.createDataFrame([(math.nan,)], "v double"))
    bounds = outliers.iqr_bounds(df, ["v"])
    assert outliers.cut_upper_outliers(df, "v", bounds["v"]).count() == 101
    assert outliers.flag_outliers(df, bounds).where("v_outlier is not null").count() == 0


def test_nan_is_left_out_of_scaling(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (math.nan,), (None,)], "v double")
    fitted = scale.fit_scaler(df, ["v"], center=True, ddof=0)
    assert fitted.means == {"v": 2.0} and fitted.deviations == {"v": 1.0}
    assert bag(scale.apply_scaler(df, fitted)) == [(None,), (None,), (-1.0,), (1.0,)]


def test_anova_with_constant_and_separating_features(spark):
    rows = [("a", 1.0, 5.0, 1.0), ("a", 1.0, 5.0, 2.0), ("b", 2.0, 5.0, 1.5), ("b", 2.0, 5.0, 4.0)]
    df = spark.createDataFrame(rows, "y string, parts double, constant double, mixed double")
    found = dict(bag(select.anova_f(df, ["parts", "constant", "mixed"], "y")))
    assert found["parts"] == math.inf and found["constant"] == 0.0 and 0 < found["mixed"] < math.inf
    assert select.top_by_anova(df, ["parts", "constant", "mixed"], "y", 2) == ["parts", "mixed"]


def test_metrics_on_constant_and_text_labels(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert metrics.regression_metrics(df, "y", "p").first()["r2"] is None
    text = spark.createDataFrame([("a", "a"), ("b", "a"), (None, "a")], "y string, p string")
    assert metrics.accuracy_per_output(text, {"out": ("y", "p")}).first()[0] == 1 / 3


def test_confusion_matrix_keeps_a_null_class(spark):
    df = spark.createDataFrame([(0, 0), (None, 0), (1, 1)], "y int, p int")
    assert bag(metrics.confusion_matrix(df, "y", "p").select("actual")) == [(None,), (0,), (1,)]


def test_split_fraction_is_exact(spark):
    df = spark.range(100_000)
    train, test = sampling.split_hash(df, "id", 0.999)
    assert 40 < test.count() < 200 and train.count() + test.count() == 100_000


def test_csv_keeps_text(spark):
    rows = [(1, "line one\nline two"), (2, ""), (3, " pad "), (4, None), (5, 'quo"te, comma'), (6, "back\\slash"), (7, "a\r\nb"), (8, "\\N"), (9, "\\\\N"), (10, "x\\N"), (11, "N")]
    df = spark.createDataFrame(rows, "id long, text string")
    path = files.write_csv(df, scratch_path(spark, "csv"))
    assert bag(files.read_csv(spark, path, df.schema)) == sorted(rows)


def test_csv_of_dotted_names_without_newlines(spark):
    df = spark.createDataFrame([("\\N", 1), (None, 2)], "`a.b` string, `c d` int")
    path = files.write_csv(df, scratch_path(spark, "csv"))
    assert bag(files.read_csv(spark, path, df.schema, multi_line=False)) == [(None, 2), ("\\N", 1)]


def test_decimals_are_profiled_as_numbers(spark):
    values = ["9.00", "10.00", "-2.50", "9.00", "10.00", None, "-2.50"]
    df = spark.createDataFrame([(None if v is None else Decimal(v), None if v is None else Decimal(v)) for v in values], "a decimal(9,2), `b.c` decimal(38,2)")
    assert bag(aggregate.mode_per_column(df, df.columns)) == [("a", "-2.50", 2), ("b.c", "-2.50", 2)]
    above = df.where("a > 0")
    assert bag(aggregate.mode_per_column(above, df.columns)) == [("a", "9.00", 2), ("b.c", "9.00", 2)]
    assert bag(aggregate.distinct_profile(df), "column_name", "distinct_count", "rows") == [("a", 3, 7), ("b.c", 3, 7)]


def test_replace_table_reads_the_old_one_and_drops_it(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("numbers_to_replace")
    out = tables.replace_table(spark.table("numbers_to_replace").where("id > 0"), "numbers_to_replace")
    assert bag(out) == [(1,), (2,)]
    assert [t.name for t in spark.catalog.listTables() if "numbers_to_replace" in t.name] == ["numbers_to_replace"]
    spark.sql("DROP TABLE numbers_to_replace")


def test_insert_rows_of_another_frame(spark, people):
    more = people.where("id = 1").withColumn("id", F.lit(9).cast("bigint"))
    assert mutate.insert_rows(people, more).count() == 5


def test_scratch_is_cleared(spark, tmp_path):
    session = spark.newSession()
    settle(session.range(3).toDF("x"), "gone")
    assert clear_scratch(session) >= 1 and clear_scratch(session) == 0
