import math

import pytest
from pyspark.sql import functions as F

from txnmill.functions import tails

# Plain Python versions, by the same formulas on one number.

def chi_square_tail_value(x: float, dof: int) -> float:
    """P(X >= x) for a chi-square variable with a whole number of degrees of freedom."""
    if x is None or math.isnan(x) or dof < 1:
        return math.nan
    if math.isinf(x):
        return 0.0
    if x <= 0:
        return 1.0
    half = x / 2
    if dof % 2:
        total, step = math.erfc(math.sqrt(half)), 0.5
    else:
        total, step = 0.0, 0.0
    while step < dof / 2:
        total += math.exp(step * math.log(half) - half - math.lgamma(step + 1))
        step += 1
    return min(total, 1.0)


def normal_two_sided_value(z: float) -> float:
    return math.nan if z is None else math.erfc(abs(z) / math.sqrt(2))


def _beta_fraction(a: float, b: float, x: float) -> float:
    # Continued fraction of the incomplete beta function, by the modified Lentz recurrence.
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + numerator * d
            c = 1 + numerator / c
            d = 1 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return value


def student_two_sided_value(t: float, dof: float) -> float:
    """P(|T| >= |t|) as a regularised incomplete beta function."""
    if t is None or dof is None or math.isnan(t) or math.isnan(dof):
        return math.nan
    x, a, b = dof / (dof + t * t), dof / 2, 0.5
    if t == 0 or x == 0:
        return 1.0 if t == 0 else 0.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(t * t / (dof + t * t))
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, t * t / (dof + t * t)) / b



# Table values of the chi-square, normal and Student distributions.
@pytest.mark.parametrize("x,dof,p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (11.344867, 3, 0.01), (0.0, 4, 1.0)])
def test_chi_square(x, dof, p):
    assert chi_square_tail_value(x, dof) == pytest.approx(p, abs=1e-6)


def test_chi_square_limits():
    assert chi_square_tail_value(math.inf, 3) == 0.0
    assert math.isnan(chi_square_tail_value(1.0, 0))
    assert chi_square_tail_value(5000.0, 7) == pytest.approx(0.0, abs=1e-300)


@pytest.mark.parametrize("z,p", [(1.959964, 0.05), (-2.575829, 0.01), (0.0, 1.0)])
def test_normal(z, p):
    assert normal_two_sided_value(z) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("t,dof,p", [(12.706205, 1, 0.05), (2.228139, 10, 0.05), (2.750, 30, 0.01), (0.0, 5, 1.0), (1.959964, 1e7, 0.05), (-2.228139, 10, 0.05)])
def test_student(t, dof, p):
    assert student_two_sided_value(t, dof) == pytest.approx(p, abs=2e-5)


def test_kolmogorov(spark):
    # L = 1.3581 is the 5% point of the Kolmogorov distribution; n = m = 200 makes sqrt(nm/(n+m)) = 10.
    df = spark.createDataFrame([(0.13581, 200, 200), (0.0, 200, 200), (0.9, 200, 200), (0.016276, 20000, 20000)], "d double, n long, m long")
    p = [r[0] for r in df.select(tails.kolmogorov_tail("d", "n", "m")).collect()]
    assert p[0] == pytest.approx(0.05, abs=1e-4)
    assert p[1] == 1.0 and p[2] < 1e-30
    assert p[3] == pytest.approx(0.01, abs=1e-4)


def test_tails_on_columns(spark):
    df = spark.createDataFrame([(3.841459, 1)], "x double, dof int")
    row = df.select(tails.chi_square_tail("x", "dof").alias("c"), tails.normal_two_sided(F.sqrt("x")).alias("z"), tails.student_two_sided(F.lit(12.706205), F.lit(1.0)).alias("t")).first()
    assert [round(v, 4) for v in row] == [0.05, 0.05, 0.05]


def close(found, want):
    assert found == pytest.approx(want, rel=1e-9, abs=1e-13)


def test_expressions_equal_the_plain_versions(spark):
    chi = [(x, k) for k in (1, 2, 3, 4, 7, 8, 51, 400, 1201) for x in (1e-6, 0.3, 1.0, 3.9, 5.0, 40.0, 380.0, 1300.0, 5000.0)]
    out = spark.createDataFrame(chi, "x double, dof int").select("x", "dof", tails.chi_square_tail("x", "dof").alias("p")).collect()
    for row in out:
        close(row["p"], chi_square_tail_value(row["x"], row["dof"]))
    normal = [(z,) for z in (0.0, 1e-9, 0.4, -1.1, 2.0, 2.8284271, 2.8285, 4.0, -7.5, 30.0)]
    for row in spark.createDataFrame(normal, "z double").select("z", tails.normal_two_sided("z").alias("p")).collect():
        close(row["p"], normal_two_sided_value(row["z"]))
    student = [(t, n) for n in (0.7, 1.0, 2.5, 10.0, 33.3, 400.0, 5000.0, 19_999.0) for t in (1e-5, 0.2, 1.0, -1.9, 2.6, 9.0, 60.0)]
    for row in spark.createDataFrame(student, "t double, n double").select("t", "n", tails.student_two_sided("t", "n").alias("p")).collect():
        close(row["p"], student_two_sided_value(row["t"], row["n"]))


def test_many_degrees_of_freedom_meet_the_normal_tail(spark):
    rows = [(t, n) for n in (20_001.0, 1e6, 1e12) for t in (0.1, 1.0, 1.959964, 4.0, 8.0)]
    for row in spark.createDataFrame(rows, "t double, n double").select("t", "n", tails.student_two_sided("t", "n").alias("p")).collect():
        want = student_two_sided_value(row["t"], row["n"]) if row["n"] < 1e5 else normal_two_sided_value(row["t"])
        assert row["p"] == pytest.approx(want, rel=1e-7 if row["n"] < 1e5 else 2e-3)


def test_missing_arguments_and_no_python(spark):
    df = spark.createDataFrame([(None, 3), (math.nan, 3), (math.inf, 3), (1.0, 0)], "x double, dof int")
    out = df.select(tails.chi_square_tail("x", "dof").alias("c"), tails.normal_two_sided("x").alias("z"), tails.student_two_sided("x", F.lit(4.0)).alias("t"))
    assert [r["c"] for r in out.collect()] == [None, None, 0.0, None]
    assert [r["t"] for r in out.collect()][:3] == [None, None, 0.0]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
