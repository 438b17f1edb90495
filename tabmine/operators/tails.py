"""Tail probabilities of Student's t and chi-square as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 3000
TINY = 1e-300
#: Degrees of freedom from which t is taken to a normal variate.
MANY = 10 ** 6


def ln_gamma(z: Column) -> Column:
    """ln of the gamma function for z > 0: Stirling's series at z + 12, brought down by the recurrence."""
    x = z + 12
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5) - 1 / (1680 * x ** 7)
    down = z
    for i in range(1, 12):
        down = down * (z + i)
    return series - F.log(down)


def _safe(c: Column) -> Column:
    return F.when(F.abs(c) < TINY, F.lit(TINY)).otherwise(c)


def _fraction(terms, first: Column, steps: int) -> Column:
    """A continued fraction first + a1/(b1 + a2/(b2 + ...)), from the front; terms(i) gives (a, b)."""
    f0 = _safe(first)
    start = F.struct(f0.alias("f"), f0.alias("c"), F.lit(0.0).alias("d"), F.lit(False).alias("done"))

    def step(s, i):
        a, b = terms(i.cast("double"))
        d = 1 / _safe(b + a * s["d"])
        c = _safe(b + a / s["c"])
        return F.when(s["done"], s).otherwise(F.struct((s["f"] * c * d).alias("f"), c.alias("c"), d.alias("d"),
                                                       (F.abs(c * d - 1) < 1e-15).alias("done")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["f"])


def upper_gamma(a: Column, x: Column, steps: int = STEPS) -> Column:
    """The regularised upper incomplete gamma function Q(a, x), a > 0; 1 for x <= 0.

    A power series below a + 1, a continued fraction above. ``steps`` terms are enough up to a = 10 ** 5.
    """
    a, x = a.cast("double"), x.cast("double")
    front = F.exp(a * F.log(x) - x - ln_gamma(a))

    def term(s, n):
        t = s["t"] * x / (a + n)
        return F.when(s["t"] < s["sum"] * 1e-17, s).otherwise(F.struct(t.alias("t"), (s["sum"] + t).alias("sum")))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct((1 / a).alias("t"), (1 / a).alias("sum")), term, lambda s: s["sum"])
    above = front / _fraction(lambda i: (-i * (i - a), x + 2 * i + 1 - a), x + 1 - a, steps)
    return F.when(x <= 0, F.lit(1.0)).when(x < a + 1, F.greatest(1 - front * series, F.lit(0.0))).otherwise(above)


def beta_tail(a: Column, b: Column, x: Column, steps: int = STEPS) -> Column:
    """The regularised incomplete beta function I_x(a, b) for 0 < x < 1."""
    def half(a, b, x):
        front = F.exp(ln_gamma(a + b) - ln_gamma(a) - ln_gamma(b) + a * F.log(x) + b * F.log1p(-x)) / a

        def terms(i):  # two of the fraction's coefficients alternate
            m = F.floor(i / 2)
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            return F.when(i % 2 == 0, even).otherwise(odd), F.lit(1.0)
        return front / _fraction(terms, F.lit(1.0), steps)
    return F.when(x < (a + 1) / (a + b + 2), half(a, b, x)).otherwise(1 - half(b, a, 1 - x))


def chi2_tail(x: Column, dof: Column) -> Column:
    """P(chi-square with ``dof`` degrees of freedom > x); null without degrees of freedom or for a null x."""
    return F.when(dof > 0, upper_gamma(dof / 2, x / 2))


def t_tail(t: Column, dof: Column) -> Column:
    """Two-sided tail of Student's t; null without degrees of freedom or for a null t, 0 for an infinite t."""
    t, dof = t.cast("double"), dof.cast("double")
    few = beta_tail(dof / 2, F.lit(0.5), dof / (dof + t * t))
    z = (8 * dof + 1) / (8 * dof + 3)
    many = upper_gamma(F.lit(0.5), z * z * dof * F.log1p(t * t / dof) / 2)
    return F.when(dof > 0, F.when(F.abs(t) == math.inf, 0.0).when(t == 0, 1.0).when(dof < MANY, few).otherwise(many))
