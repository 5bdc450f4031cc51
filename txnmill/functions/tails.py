"""Tail probabilities of test statistics, as column expressions.

Series and continued fractions run inside ``aggregate``, so no Python worker takes part. They are meant for result
tables with one row per tested column. Arguments are columns or column names; a null or NaN argument gives null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Above so many degrees of freedom the Student tail is taken by the normal one, with Hill's correction.
LARGE = 20_000.0


def _double(value) -> Column:
    number = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(F.isnan(number), None).otherwise(number)


def _fold(n, start: Column, step, finish=None) -> Column:
    """``step`` over 1 to ``n``."""
    return F.aggregate(F.sequence(F.lit(1), n if isinstance(n, Column) else F.lit(n)), start, step, *([finish] if finish else []))


def kolmogorov_tail(distance, n_ref, n_cur, terms: int = 100) -> Column:
    """Asymptotic two-sample p-value: 2 * sum (-1)^(j-1) exp(-2 j^2 L^2), L = D sqrt(nm / (n+m))."""
    n, m = F.col(n_ref).cast("double"), F.col(n_cur).cast("double")
    lam2 = F.pow(F.col(distance), 2) * n * m / (n + m)
    term = lambda j: F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * lam2)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda acc, j: acc + term(j))
    # Below L = 0.2 the alternating series has not converged; the probability there is 1.
    # An undefined distance has no probability (``greatest`` would skip the null).
    return F.when(lam2.isNull(), F.lit(None)).when(lam2 < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0)))


def erfc(x: Column) -> Column:
    """Complementary error function of ``x`` >= 0, to about 1e-15: a series with terms of one sign below 2, from there a
    continued fraction."""
    square = x * x
    state = F.struct(x.alias("term"), x.alias("total"))

    def longer(s: Column, n: Column) -> Column:
        term = s["term"] * 2.0 * square / (2.0 * n + 1.0)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    series = 1.0 - 2.0 / math.sqrt(math.pi) * F.exp(-square) * _fold(60, state, longer, lambda s: s["total"])
    fraction = _fold(120, F.lit(1.0), lambda k, n: 1.0 + (121.0 - n) / (2.0 * square) / k)
    return F.when(x < 2.0, series).otherwise(F.exp(-square) / (x * math.sqrt(math.pi)) / fraction)


def normal_two_sided(z) -> Column:
    """P(|Z| >= |z|) of a standard normal variable."""
    return erfc(F.abs(_double(z)) / math.sqrt(2.0))


def chi_square_tail(x, dof) -> Column:
    """P(X >= x) of a chi-square variable with a whole number of degrees of freedom; null below one.

    A finite sum: of Poisson terms for even degrees, of half-step terms and an error function for odd ones. Terms are
    carried as logarithms, so none is lost where the first is too small for a double.
    """
    value, n = _double(x), F.col(dof) if isinstance(dof, str) else dof
    half, odd = value / 2.0, n % 2 == 1
    # Steps 1, 2, ... stand for the powers s = 0, 1, ... or 1/2, 3/2, ... of the half.
    log_first = F.when(odd, -half + 0.5 * F.ln(half) - math.lgamma(1.5)).otherwise(-half)
    state = F.struct(log_first.alias("log"), F.lit(0.0).alias("total"))
    shift = F.when(odd, 0.5).otherwise(0.0)

    def add(s: Column, i: Column) -> Column:
        return F.struct((s["log"] + F.ln(half) - F.ln(i + shift)).alias("log"), (s["total"] + F.exp(s["log"])).alias("total"))

    steps = F.floor(n / 2).cast("int")
    total = F.when(steps < 1, F.lit(0.0)).otherwise(_fold(F.greatest(steps, F.lit(1)), state, add, lambda s: s["total"]))
    tail = total + F.when(odd, erfc(F.sqrt(half))).otherwise(0.0)
    return F.when(value.isNull() | (n < 1), None).when(value <= 0, 1.0).when(value == math.inf, 0.0).otherwise(F.least(tail, F.lit(1.0)))


def _log_half_step(a: Column) -> Column:
    """log(gamma(a + 1/2) / gamma(a)): 200 steps up, then the asymptotic series."""
    up = _fold(200, F.lit(0.0), lambda s, i: s + F.ln((a + i - 1.0) / (a + i - 0.5)))
    z = a + 200.0
    return up + 0.5 * F.ln(z) + F.log1p(-1.0 / (8.0 * z) + 1.0 / (128.0 * z * z) + 5.0 / (1024.0 * z * z * z))


def _beta_fraction(a: Column, b: Column, x: Column, terms: int = 600) -> Column:
    """Continued fraction of the incomplete beta function, by the modified Lentz recurrence."""
    tiny = 1e-300
    guard = lambda v: F.when(F.abs(v) > tiny, v).otherwise(tiny)
    d = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    state = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("value"))

    def half(s: Column, numerator: Column) -> Column:
        lower = 1.0 / guard(1.0 + numerator * s["d"])
        upper = guard(1.0 + numerator / s["c"])
        return F.struct(upper.alias("c"), lower.alias("d"), (s["value"] * lower * upper).alias("value"))

    def step(s: Column, i: Column) -> Column:
        # Odd steps take the second kind of numerator of m - 1, even ones the first kind of m.
        m = F.floor(i / 2).cast("double")
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        return half(s, F.when(i % 2 == 0, even).otherwise(odd))

    return _fold(F.lit(terms), state, lambda s, i: step(s, i + 1), lambda s: s["value"])


def student_two_sided(t, dof) -> Column:
    """P(|T| >= |t|) of Student's distribution with any positive degrees of freedom: a regularised incomplete beta
    function; for very many degrees the normal tail of a corrected value."""
    value, n = _double(t), _double(dof)
    square = value * value
    x, a = n / (n + square), n / 2.0
    front = F.exp(_log_half_step(a) - 0.5 * math.log(math.pi) + a * F.ln(x) + 0.5 * F.ln(square / (n + square)))
    direct = front * _beta_fraction(a, F.lit(0.5), x) / a
    turned = 1.0 - front * _beta_fraction(F.lit(0.5), a, square / (n + square)) / 0.5
    by_beta = F.when(x < (a + 1.0) / (a + 2.5), direct).otherwise(turned)
    wide, y = 48.0 * (n - 0.5) * (n - 0.5), (n - 0.5) * F.log1p(square / n)
    corrected = (((((-0.4 * y - 3.3) * y - 24.0) * y - 85.5) / (0.8 * y * y + 100.0 + wide) + y + 3.0) / wide + 1.0) * F.sqrt(y)
    return F.when(value.isNull() | n.isNull(), None).when(square == 0, 1.0).when(square == math.inf, 0.0).when(n > LARGE, normal_two_sided(corrected)).otherwise(by_beta)
