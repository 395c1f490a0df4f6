"""Tail probabilities against sums and integrals, and the order of features against MLlib."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest

from prepflow.functions.tails import log_chi_square_tail, log_f_tail
from prepflow.operators import select


@pytest.mark.parametrize("degrees", [2, 4, 10, 60])
def test_chi_square_tail_equals_its_finite_sum(degrees):
    for x in (0.01, 1.0, degrees - 0.5, degrees + 3.0, 5.0 * degrees, 500.0):
        terms = [i * math.log(x / 2) - math.lgamma(i + 1) for i in range(degrees // 2)]
        top = max(terms)
        expected = -x / 2 + top + math.log(sum(math.exp(t - top) for t in terms))
        assert log_chi_square_tail(x, degrees) == pytest.approx(expected, rel=1e-9, abs=1e-13)


@pytest.mark.parametrize("d1, d2", [(1, 1), (2, 7), (5, 3), (9, 40), (2, 100_000)])
def test_f_tail_equals_the_integral(d1, d2):
    for f in (0.05, 0.7, 1.0, 2.5, 9.0):
        if d1 == 2:
            expected = -d2 / 2 * math.log1p(2 * f / d2)
        else:  # the beta integral, with ends made flat by x = sin(u) ** 2
            a, b = d2 / 2, d1 / 2
            u = (np.arange(200_000) + 0.5) / 200_000 * math.asin(math.sqrt(d2 / (d2 + d1 * f)))
            area = np.sum(2 * np.sin(u) ** (2 * a - 1) * np.cos(u) ** (2 * b - 1)) * (u[1] - u[0])
            expected = math.log(area) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
        assert log_f_tail(f, d1, d2) == pytest.approx(expected, rel=1e-6, abs=1e-7)


def test_tails_beyond_doubles_and_without_meaning():
    assert log_f_tail(1e6, 3, 1e6) < log_f_tail(9e5, 3, 1e6) < -800 and log_chi_square_tail(1e5, 3) < -4e4
    assert log_f_tail(math.inf, 1, 5) == log_chi_square_tail(math.inf, 2) == -math.inf
    assert log_f_tail(0.0, 1, 5) == log_f_tail(2.0, 0, 5) == log_f_tail(2.0, 1, 0) == log_chi_square_tail(0.0, 4) == log_chi_square_tail(3.0, 0) == 0.0


def test_p_values_agree_with_mllib_and_order_features_of_unequal_nulls(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(400):
        y = rng.randrange(3)
        rows.append((y, y + rng.gauss(0, 2), rng.gauss(0, 1), 0.3 * y + rng.gauss(0, 1), float(rng.randrange(4) + (y == 2))))
    df = spark.createDataFrame(rows, "y int, strong double, none double, weak double, cat double")
    names = ["strong", "none", "weak"]
    ranked = [c for c, _ in select.anova_p(df, names, "y")]
    for n in (1, 2):
        assert sorted(select.select_top(df, names, "y", n, "univariate")[1]) == sorted(ranked[:n])
    chi = ChiSquareTest.test(VectorAssembler(inputCols=["cat"], outputCol="f").transform(df), "f", "y").first()
    assert math.exp(select.chi_square_p(df, ["cat"], "y")[0][1]) == pytest.approx(chi.pValues[0], rel=1e-6, abs=1e-14)
    # the same relation on a tenth of the rows has a like F but a larger p
    less = df.selectExpr("*", "case when rand(1) < 0.1 then strong end as few", "cast(null as double) as empty", "1.0D as constant")
    order = [c for c, _ in select.anova_p(less, ["few", "empty", "constant", "strong"], "y")]
    assert order == ["strong", "few", "constant", "empty"] and select.top_by_anova(less, ["few", "strong"], "y", 1) == ["strong"]


def test_chi_square_of_more_than_ten_thousand_values(spark):
    df = spark.range(24_000).selectExpr("id % 2 as y", "id as key", "concat('v', id % 12000) as tied", "id % 3 as other")
    ranked = select.chi_square_p(df, ["other", "key", "tied"], "y")
    assert ranked[0][0] == "tied" and select.top_by_chi_square(df, ["other", "tied"], "y", 1) == ["tied"]
