import math
import random
from decimal import Decimal

import pytest
from conftest import bag
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prepflow.operators import clean, encode, outliers, quantiles, reshape, sampling, scale, select
from prepflow.plans.transpose import monthly_transpose, multi_output_transpose


def disc(values, p):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    return values[max(math.ceil(p * len(values)), 1) - 1] if values else None


# ---- quantiles ---------------------------------------------------------------

POINTS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


def spread_values(kind, n=4000):
    rng = random.Random(5)
    if kind == "uniform":
        return [rng.uniform(-1e6, 1e6) for _ in range(n)]
    if kind == "ties":  # one value holds most rows, right where quantiles fall
        return [1.0 if rng.random() < 0.6 else rng.choice([0.0, 2.0, rng.random()]) for _ in range(n)]
    if kind == "skewed":
        return [math.exp(rng.gauss(0, 4)) for _ in range(n)]
    return [float("nan") if i % 3 else None if i % 2 else float(i) for i in range(n)]


@pytest.mark.parametrize("kind", ["uniform", "ties", "skewed", "gaps"])
@pytest.mark.parametrize("bits", [16, 5])
def test_quantiles_are_exact(spark, kind, bits):
    """Also with small digits, which forces many scans."""
    values = spread_values(kind)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    got = quantiles.exact_quantiles(df, ["x"], POINTS, bits)
    assert got["x"] == [disc(values, p) for p in POINTS]


def test_quantiles_of_integers_beyond_double_precision(spark):
    values = [2**60 + 3 * i for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    assert quantiles.exact_quantiles(df, ["x"], [0.1, 0.5])["x"] == [values[49], values[249]]
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(df, ["x"], [0.5], digit_bits=17)


def test_quantiles_of_integers_and_of_nothing(spark):
    df = spark.createDataFrame([(i * i, None) for i in range(100)], "a int, b double")
    got = quantiles.exact_quantiles(df, ["a", "b"], [0.5])
    assert got == {"a": [49 * 49], "b": [None]}


def test_quantiles_of_doubles_of_every_size(spark, monkeypatch):
    """Both zeros, infinities, the smallest doubles, and neighbours of every power of two; four scans at most."""
    values = [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308]
    for e in range(-1074, 1024):
        values += [2.0**e, math.nextafter(2.0**e, math.inf), -math.nextafter(2.0**e, 0.0)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    scans, count = [], quantiles._count_digits
    monkeypatch.setattr(quantiles, "_count_digits", lambda data, pending: scans.append(1) or count(data, pending))
    points = [0.0, 0.001, 0.2, 0.33, 0.4, 0.5, 0.501, 0.66, 0.9, 0.9995, 1.0]
    assert quantiles.exact_quantiles(df, ["x"], points)["x"] == [disc(values, p) for p in points]
    assert len(scans) <= 4


def test_words_of_doubles_keep_every_bit(spark):
    values = [2.0**e for e in range(-1074, 1024)] + [math.nextafter(2.0**e, 0.0) for e in range(-1073, 1024)] + [-1 / 3, math.pi]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    words = sorted(r.words for r in quantiles.words_of_values(df, ["x"]).collect())
    assert [quantiles.value_of(w, "double") for w in words] == sorted(values)


@pytest.mark.parametrize("kind", ["decimal(12,2)", "decimal(18,18)", "decimal(38,0)", "decimal(38,10)", "decimal(38,38)", "decimal(25,20)"])
def test_quantiles_of_decimals(spark, kind):
    precision, scale = quantiles._decimal(kind)
    rng = random.Random(3)
    values = [Decimal(rng.randrange(-(10 ** rng.randint(1, precision)) + 1, 10**precision)).scaleb(-scale, quantiles.WIDE) for _ in range(300)]
    values += [Decimal(0), Decimal(10**precision - 1).scaleb(-scale, quantiles.WIDE), Decimal(1 - 10**precision).scaleb(-scale, quantiles.WIDE)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"x {kind}")
    assert quantiles.exact_quantiles(df, ["x"], POINTS)["x"] == [sorted(values)[max(math.ceil(p * len(values)), 1) - 1] for p in POINTS]


def test_quantiles_and_imputers_of_dotted_names(spark):
    df = spark.createDataFrame([(1.0, Decimal("2.50")), (3.0, Decimal("9.00")), (None, None), (5.0, Decimal("10.00"))], "`a.b` double, `c``d` decimal(9,2)")
    assert quantiles.exact_quantiles(df, df.columns, [0.5]) == {"a.b": [3.0], "c`d": [Decimal("9.00")]}
    full = clean.apply_imputer(df, clean.fit_imputer(df, df.columns, "median"))
    assert full.where(F.col("`a.b`").isNull()).count() == 0
    bounds = outliers.iqr_bounds(df, df.columns)
    assert outliers.flag_outliers(df, bounds).count() == 4


# ---- reshape -----------------------------------------------------------------


def test_periods_beyond_the_data_are_padded(spark):
    df = spark.createDataFrame([(1, "2021-01", 4.0), (1, "2021-01", 6.0), (2, "2021-02", 7.0)], "k int, m string, v double")
    out = reshape.pivot_periods(df, "k", "m", ["v"], 3, name="{period}")
    assert out.columns == ["k", "M1", "M2", "M3"]
    assert bag(out) == [(1, 0.0, 5.0, 0.0), (2, 7.0, 0.0, 0.0)]


def test_keep_recent_relabels(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, m string")
    assert bag(reshape.keep_recent(df, "m", 2)) == [(2, "M2"), (3, "M1")]
    assert reshape.keep_recent(df.limit(0), "m", 2).count() == 0


def test_gaps_of_a_measure_a_key_never_has_stay_null(spark):
    df = spark.createDataFrame([(1, "p", 1.0, None), (1, "q", None, None), (2, "p", 2.0, 5.0)], "k int, c string, x double, y double")
    out = reshape.pivot_mean(df, ["k"], "c", ["p", "q"], ["x", "y"], lambda v, m: f"{v}_{m}", 0.0, gaps_of_absent=True)
    assert bag(out, "k", "p_x", "q_x", "p_y", "q_y") == [(1, 1.0, 0.0, None, None), (2, 2.0, 0.0, 5.0, 0.0)]


def test_two_key_pivot_names(spark):
    df = spark.createDataFrame([(1, "M1", "a", 3.0), (1, "M2", "b", 5.0)], "k int, m string, t string, v double")
    assert reshape.pivot_two_keys(df, ["k"], "m", "t", ["v"]).first().asDict() == {"k": 1, "M1-a-v": 3.0, "M2-b-v": 5.0}


def test_monthly_transpose_keeps_the_larger_side(spark):
    running = spark.createDataFrame([(1, "2021-01", 10.0), (2, "2021-02", 20.0)], "k int, m string, v double")
    loans = spark.createDataFrame([("1", "2021-01", 1.0), ("5", "2021-03", 2.0), ("6", "2021-03", 3.0)], "k string, m string, w double")
    out = monthly_transpose(running, loans, "k", "m", "v", ["w"], 3, 2)
    assert set(out.merged.columns) == {"k", "M1", "M2", "M3", "M1-w", "M2-w"}
    assert bag(out.merged, "k", "M1", "M2", "M1-w") == [(1, 0.0, 10.0, 0.0), (5, None, None, 2.0), (6, None, None, 3.0)]
    assert bag(out.month_labels) == [("M1",), ("M2",)]


def test_monthly_transpose_with_two_pivot_keys(spark):
    running = spark.createDataFrame([(1, "2021-01", 10.0)], "k int, m string, v double")
    loans = spark.createDataFrame([(1, "2021-01", "x", 1.0), (2, "2021-02", "y", 2.0), (2, "2020-12", "y", 9.0)], "k int, m string, t string, w double")
    out = monthly_transpose(running, loans, "k", "m", "v", ["w"], 1, 2, second_key="t")
    assert bag(out.merged, "k", "M1", "M1-y-w", "M2-x-w") == [(1, 10.0, 0.0, 1.0), (2, None, 2.0, 0.0)]


def test_two_key_pivot_of_any_type(spark):
    df = spark.createDataFrame([(1, True, 1e-5, 3.0), (1, False, 1e-5, 5.0), (2, True, None, 9.0)], "k int, m boolean, t double, v double")
    out = reshape.pivot_two_keys(df, ["k"], "m", "t", ["v"])
    assert bag(out, "k", "`false-1e-05-v`", "`true-1e-05-v`") == [(1, 5.0, 3.0)]
    texts = spark.createDataFrame([(1, "a-b", "c", 3.0), (1, "a", "b-c", 5.0)], "k int, m string, t string, v double")
    out = reshape.pivot_two_keys(texts, ["k"], "m", "t", ["v"]).first().asDict()
    assert out == {"k": 1, "'a'-'b-c'-v": 5.0, "'a-b'-'c'-v": 3.0}
    assert reshape.pivot_two_keys(texts.limit(0), ["k"], "m", "t", ["v"]).collect() == []


def test_monthly_transpose_with_two_keys_on_both_tables(spark):
    running = spark.createDataFrame([(1, "2021-01", True, 10.0), (3, "2021-01", False, 4.0)], "k int, m string, s boolean, v double")
    loans = spark.createDataFrame([(1, "2021-01", "x", 1.0)], "k int, m string, t string, w double")
    out = monthly_transpose(running, loans, "k", "m", "v", ["w"], 2, 2, second_key="t", running_second_key="s")
    assert set(out.merged.columns) == {"k", "M1-true-v", "M1-false-v", "M2-true-v", "M2-false-v", "M1-x-w", "M2-x-w"}
    assert bag(out.merged, "k", "M1-true-v", "M2-true-v", "M1-x-w", "M2-x-w") == [(1, 10.0, 0.0, 1.0, 0.0), (3, 0.0, 0.0, None, None)]


def test_multi_output_transpose(spark):
    inputs = spark.createDataFrame(
        [(1, 1, "x", "p1", 2.0, "red", None), (1, 2, "y", "p2", 4.0, None, "s"), (2, 1, "z", "p1", 6.0, "blue", "t"), (3, 1, "w", "p1", 1.0, "red", "t")],
        "k int, t int, attr string, p string, v double, c1 string, c2 string",
    )
    outputs = spark.createDataFrame([(1, "b", 3.0), (1, "a", 1.0), (1, "a", 2.0), (2, "b", 300.0)], "k int, p string, y double")
    out = multi_output_transpose(inputs, outputs, "k", ["t"], ["attr"], "p", ["v", "c1", "c2"], ["c1", "c2"], "none", "p", "y", 2)
    assert bag(out.labels, "k", "OFN1", "OFN2") == [(1, 1, 3), (2, 0, None)]
    assert out.features.columns == ["k", "attr", "p1_v", "p1_c1", "p1_c2", "p2_v", "p2_c1", "p2_c2"]
    first = out.features.where("k = 1").first().asDict()
    assert first == {"k": 1, "attr": "x", "p1_v": 2.0, "p1_c1": 2.0, "p1_c2": 0.0, "p2_v": 4.0, "p2_c1": 1.0, "p2_c2": 1.0}
    assert bag(out.codes["c1"]) == [("blue", 0), ("none", 1), ("red", 2)]


def test_multi_output_transpose_keeps_and_pads_periods(spark):
    inputs = spark.createDataFrame([(1, 1, "x", f"B{i}", float(i), "c") for i in range(12)], "k int, t int, attr string, p string, v double, c string")
    outputs = inputs.select("k", "p", F.col("v").alias("y"))
    arguments = ("k", ["t"], ["attr"], "p", ["v"], ["c"], "none", "p", "y")
    out = multi_output_transpose(inputs, outputs, *arguments)
    assert out.labels.columns == ["k", *[f"OFN{i + 1}" for i in range(12)]] and bag(out.labels) == [(1, *range(12))]
    assert out.outputs == {f"OFN{i + 1}": f"B{i}" for i in range(12)} and out.features.columns[2:] == [f"B{i}_v" for i in range(12)]
    few = multi_output_transpose(inputs, outputs.where("p IN ('B1', 'B10')"), *arguments, n_outputs=4)
    assert bag(few.labels) == [(1, 1, 10, 0, 0)] and few.outputs["OFN3"] is None
    gap = multi_output_transpose(inputs, outputs.where("p IN ('B1', 'B10')"), *arguments, n_outputs=2, known=("B0", "B1"))
    assert bag(gap.labels) == [(1, 0, 1, 10)]


# ---- cleaning ----------------------------------------------------------------


def test_cardinality_drop(spark):
    df = spark.range(100).select("id", F.lit("x").alias("same"), (F.col("id") % 5).alias("five"), F.lit(None).cast("int").alias("empty"))
    kept, dropped = clean.drop_by_cardinality(df, 1, 0.9)
    assert kept.columns == ["five"] and dropped == ["id", "same", "empty"]
    kept, dropped = clean.drop_by_cardinality_percent(df, 50, 90, ["five"])
    assert kept.columns == ["same"] and dropped == ["id", "five", "empty"]


def test_imputer_rules(spark, tmp_path):
    df = spark.createDataFrame(
        [(4, 1.0, "b"), (5, float("nan"), None), (None, 2.0, "a"), (4, None, "b"), (5, 9.0, "a")], "i int, d double, s string"
    )
    mean = clean.fit_imputer(df, ["i", "d"], "mean")
    assert bag(clean.apply_imputer(df, mean), "i")[0] == (4,)  # 4.5 cut to an integer
    assert bag(clean.apply_imputer(df, mean), "d")[-2:] == [(4.0,), (9.0,)]
    assert clean.fit_imputer(df, ["i", "d"], "median").values == {"i": 4, "d": 2.0}
    assert clean.fit_imputer(df, ["i", "s"], "mode").values == {"i": "4", "s": "a"}
    both = clean.fit_imputer_both(df, "median")
    filled = clean.apply_imputer(df, clean.FittedImputer.load(spark, both.save(spark, str(tmp_path / "imp"))))
    assert filled.schema == df.schema or filled.dtypes == df.dtypes
    assert bag(filled) == [(4, 1.0, "b"), (4, 2.0, "a"), (4, 2.0, "b"), (5, 2.0, "a"), (5, 9.0, "a")]
    assert bag(clean.apply_imputer(df, clean.fit_imputer_both(df.select("s"), "constant", "?")), "s")[0] == ("?",)


def test_numeric_column_without_values_is_refused_but_text_is_left(spark):
    df = spark.createDataFrame([(None, None)], "x double, s string")
    for strategy in ("mean", "median", "mode"):
        with pytest.raises(ValueError):
            clean.fit_imputer(df, ["x"], strategy)
    assert clean.apply_imputer(df, clean.fit_imputer(df, ["s"], "mode")).first().s is None


# ---- outliers ----------------------------------------------------------------


def test_outlier_rules(spark):
    values = [10.0, 11.0, 12.0, 13.0, 14.0, 15.0, -90.0, 200.7, 300.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    bounds = outliers.iqr_bounds(df, ["x"])["x"]
    assert (bounds.q1, bounds.q3, bounds.low, bounds.high) == (11.0, 15.0, 5.0, 21.0)
    flagged = outliers.flag_outliers(df, {"x": bounds})
    assert sorted(r[1] for r in flagged.collect() if r[1] is not None) == [-90.0, 200.7, 300.0]
    assert sorted(r.x for r in outliers.cut_upper_outliers(df, "x", bounds).collect()) == [-90.0, 10.0, 11.0, 12.0, 13.0, 14.0, 15.0]
    assert outliers.remove_outliers(df, "x", bounds).count() == 6
    assert outliers.remove_outliers(df, "x", bounds, keep_null=True).count() == 7
    calm = df.where("x between 10 and 15 or x is null")
    assert outliers.remove_outliers(calm, "x", bounds).count() == 7  # nothing to remove, nulls stay
    assert outliers.cut_upper_outliers(calm, "x", bounds).count() == 7
    assert outliers.outlier_stage(df, "x", True, "Classification").count() == 10
    assert outliers.outlier_stage(df, "x", False, "Regression").count() == 10


# ---- encoding, scaling, selection --------------------------------------------


def test_index_and_invalid_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "s string")
    codes = encode.fit_index(df, "s")
    assert bag(codes) == [("a", 0), ("b", 1), ("c", 2)]
    new = spark.createDataFrame([("c",), ("zz",), (None,)], "s string")
    assert bag(encode.apply_codes(new, codes, "s", "i", "skip")) == [("c", 2)]
    assert bag(encode.apply_codes(new, codes, "s", "i", "keep"), "i") == [(2,), (3,), (3,)]
    with pytest.raises(Exception, match="without a code"):
        encode.apply_codes(new, codes, "s", "i").collect()


def test_index_equals_mllib(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.range(500).select(F.concat(F.lit("v"), (F.col("id") * F.col("id") % 23).cast("string")).alias("s"))
    ours = encode.apply_codes(df, encode.fit_index(df, "s"), "s", "i")
    theirs = StringIndexer(inputCol="s", outputCol="i").fit(df).transform(df)
    assert set(bag(ours.select("s", F.col("i").cast("double")))) == set(bag(theirs))


def test_onehot_unknowns(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    fitted = encode.load_onehot(spark, encode.save_onehot(spark, encode.fit_onehot(df, ["s"]), str(tmp_path / "onehot")))
    assert fitted == {"s": ["a", "b"]}
    new = spark.createDataFrame([("a",), ("q",)], "s string")
    assert bag(encode.apply_onehot(new, fitted)) == [(0.0, 0.0), (1.0, 0.0)]
    with pytest.raises(Exception, match="unknown category"):
        encode.apply_onehot(new, fitted, "error").collect()


def test_scalers(spark, tmp_path):
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, k double")
    z = scale.apply_scaler(df, scale.fit_scaler(df, ["x", "k"], center=True, ddof=0))
    mean, dev = 7 / 3, math.sqrt(sum((v - 7 / 3) ** 2 for v in (1, 2, 4)) / 3)
    assert [round(r.x, 9) for r in z.collect()] == [round((v - mean) / dev, 9) for v in (1, 2, 4)]
    assert {r.k for r in z.collect()} == {0.0}
    fitted = scale.fit_scaler(df, ["x", "k"], center=True, ddof=0)
    assert scale.FittedScaler.load(spark, fitted.save(spark, str(tmp_path / "scaler"))) == fitted
    ours = scale.apply_scaler(df, scale.fit_scaler(df, ["x", "k"], center=False, ddof=1))
    vectors = VectorAssembler(inputCols=["x", "k"], outputCol="v").transform(df)
    theirs = StandardScaler(inputCol="v", outputCol="o").fit(vectors).transform(vectors)
    assert [[round(c, 9) for c in r] for r in ours.collect()] == [[round(c, 9) for c in r.o] for r in theirs.collect()]


def test_chi_square_equals_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    df = spark.range(600).select((F.col("id") % 4).cast("double").alias("a"), (F.col("id") * 7 % 5).cast("double").alias("b"), (F.floor(F.col("id") / 100) % 3).cast("double").alias("y"))
    ours = {r.column_name: (round(r.statistic, 6), r.df) for r in select.chi_square_stats(df, ["a", "b"], "y").collect()}
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    theirs = {r.featureIndex: (round(r.statistic, 6), r.degreesOfFreedom) for r in ChiSquareTest.test(vectors, "v", "y", True).collect()}
    assert ours == {"a": theirs[0], "b": theirs[1]}


def test_selection_finds_the_related_features(spark):
    df = spark.range(900).select(
        (F.col("id") % 3).cast("double").alias("y"),
        (F.col("id") % 3 + F.rand(1)).alias("good"),
        F.rand(2).alias("noise"),
        (F.col("id") % 3 * 2 + F.rand(3)).alias("better"),
    )
    assert select.top_by_anova(df, ["good", "noise", "better"], "y", 2) == ["better", "good"]
    out, names = select.select_top(df, ["good", "noise", "better"], "y", 2, "univariate")
    assert names == ["good", "better"]
    assert all(tuple(r.selectedFeatures) == (r.good, r.better) for r in out.collect())
    binned = select.bin_equal_width(df, ["good", "noise", "better"], 10)
    assert set(select.select_top(binned, ["good", "noise", "better"], "y", 2, "chisquare")[1]) == {"better", "good"}


# ---- sampling and splits -----------------------------------------------------


def classes(spark, n=3000):
    """One class holds two thirds of the rows, the smallest a handful."""
    label = F.when(F.col("id") % 3 < 2, "big").when(F.col("id") % 97 == 0, "tiny").otherwise("mid")
    return spark.range(n).select("id", label.alias("y"))


@pytest.mark.parametrize("mode", ["down", "up"])
def test_resampling_is_exact_and_stable(spark, monkeypatch, mode):
    df = classes(spark)
    sizes = {r.y: r["count"] for r in df.groupBy("y").count().collect()}
    want = min(sizes.values()) if mode == "down" else max(sizes.values())
    plain = bag(sampling.resample(df, "y", "id", mode))
    assert {r.y: r["count"] for r in sampling.resample(df, "y", "id", mode).groupBy("y").count().collect()} == dict.fromkeys(sizes, want)
    monkeypatch.setattr(sampling, "ROWS_PER_CELL", 50)
    monkeypatch.setattr(sampling, "DRAWS_PER_COPY", 3)
    for few in (10_000, 0):  # never and always look the rows up by their keys
        monkeypatch.setattr(sampling, "FEW_DRAWS", few)
        assert bag(sampling.resample(df.repartition(7), "y", "id", mode)) == plain
    truth = dict(df.collect())
    assert all(truth[r[0]] == r[1] for r in plain)


def test_positions_are_complete_per_class(spark, monkeypatch):
    monkeypatch.setattr(sampling, "ROWS_PER_CELL", 10)
    out = sampling.number_in_class(classes(spark), "y", "id", 1, 3000)
    got = out.groupBy("y").agg(F.min("position"), F.max("position") + 1 - F.count("*"), F.count_distinct("position") - F.count("*"))
    assert {tuple(r)[1:] for r in got.collect()} == {(0, 0, 0)}


def test_resampling_without_labels_gives_nothing(spark):
    df = spark.createDataFrame([(1, None)], "id bigint, y string")
    assert sampling.resample(df, "y", "id", "up").where("draw is not null").count() == 0


@pytest.mark.parametrize("share", [0.2, 0.0, 1.0, 0.0001])
def test_exact_split(spark, share):
    df = spark.range(5000)
    out = sampling.split_exact(df, "id", share)
    chosen = bag(out.where("in_test"), "id")
    assert len(chosen) == math.ceil(round(5000 * share, 6)) and out.count() == 5000
    assert bag(sampling.split_exact(df.repartition(7), "id", share).where("in_test"), "id") == chosen


def test_hash_split_is_disjoint_and_complete(spark):
    train, test = sampling.split_hash(spark.range(1000), "id")
    assert sorted(r.id for r in train.union(test).collect()) == list(range(1000))
    assert bag(sampling.split_hash(spark.range(1000).repartition(7), "id")[1]) == bag(test)
    a, b = sampling.split_random(spark.range(1000))
    assert a.count() + b.count() == 1000


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=60), p=st.sampled_from([0.1, 0.25, 0.5, 0.9]))
def test_any_quantile(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [p])["x"] == [disc(values, p)]


def test_sketches_decide_columns_far_from_the_bounds(spark):
    """The decisions are those of exact counts, and only columns near a bound are counted."""
    df = spark.range(20_000).selectExpr(
        "id", "id % 5000 AS quarter", "id % 17900 AS below", "id % 18100 AS above", "1 AS one", "cast(NULL AS double) AS empty",
        "id % 2 AS two", "CASE WHEN id % 3 = 0 THEN double('NaN') ELSE id % 7 END AS nan", "id % 9000 AS `dotted.name`", "array(id) AS list",
    )
    gone, near = clean.undecided_columns(df, 1, 0.9)
    assert set(near) == {"below", "above", "one", "empty", "two", "id", "list"} - set(gone) and not {"quarter", "dotted.name"} & {*gone, *near}
    kept, dropped = clean.drop_by_cardinality(df, 1, 0.9)
    exact = {r.column_name for r in clean.cardinality_decisions(df, 1, 0.9).where("dropped").collect()}
    assert set(dropped) == exact == {"id", "above", "one", "empty", "list"}
    assert kept.columns == ["quarter", "below", "two", "nan", "dotted.name"]
    gone, near = clean.undecided_columns(df.select("id", "quarter", "list"), 1, 0.5)
    assert gone == ["id", "list"] and near == []


@pytest.mark.parametrize(("lower", "upper", "whole"), [(1, 0.9, False), (0, 0.8, True), (30, 0.5, True), (0, 0.0, False), (400, 2.0, False)])
def test_sketched_decisions_equal_exact_ones(spark, lower, upper, whole):
    df = spark.range(700).selectExpr("id", *[f"id % {n} AS m{n}" for n in (1, 2, 29, 31, 340, 349, 351, 400, 560, 629, 631)], "cast(NULL AS int) AS empty")
    exact = {r.column_name for r in clean.cardinality_decisions(df, lower, upper, whole).where("dropped").collect()}
    assert set(clean._drop_by_bounds(df, lower, upper, whole, [])[1]) == exact


def test_a_table_without_rows_keeps_its_columns(spark):
    kept, dropped = clean.drop_by_cardinality(spark.range(0).selectExpr("id", "id AS x"), 1, 0.9)
    assert kept.columns == ["id", "x"] and dropped == []
