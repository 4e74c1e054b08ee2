"""Tail probabilities of the t and the chi-square distribution as column expressions.

Spark SQL has no incomplete beta or gamma function. Their continued fractions and series run
here inside ``aggregate`` over a sequence of steps, so any number of tested groups stays in the
JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-300
# Steps by which an argument is raised before its asymptotic series is used.
RAISED = 20
STEPS = 200
# Beyond these degrees of freedom t is turned into a normal deviate.
MANY = 1000.0


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _apart(x: Column) -> Column:
    return F.when(x == 0, TINY).otherwise(x)


def _raised(a: Column, term: Callable[[Column], Column]) -> Column:
    """Sum of ``term`` of a, a + 1, ... below a + RAISED."""
    steps = F.sequence(F.lit(0), F.lit(RAISED - 1))
    return F.aggregate(steps, F.lit(0.0), lambda s, k: s + term(a + k))


def _series(x: Column, coefficients: list[float]) -> Column:
    """c0 / x + c1 / x**3 + c2 / x**5 + ..."""
    total = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        total = total / (x * x) + c
    return total / x


def log_gamma(a: Column) -> Column:
    """Logarithm of the gamma function of a positive number, by Stirling's series at a + RAISED."""

    def stirling(x: Column) -> Column:
        return (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + _series(x, [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188])

    return _once(a + RAISED, stirling) - _raised(a, F.log)


def log_half_step(a: Column) -> Column:
    """log(gamma(a + 1/2) / gamma(a)) without the difference of two large numbers."""

    def far(x: Column) -> Column:
        return 0.5 * F.log(x) + _series(x, [-1 / 8, 1 / 192, -1 / 640, 17 / 14336, -31 / 18432])

    return _once(a + RAISED, far) + _raised(a, lambda x: F.log(x / (x + 0.5)))


def _fraction(start: Column, steps: Column, numerator: Callable, denominator: Callable) -> Column:
    """start + n1 / (d1 + n2 / (d2 + ...)), by the modified Lentz method."""
    number = "double"
    first = F.struct(_apart(start).cast(number).alias("value"), _apart(start).cast(number).alias("c"), F.lit(0.0).alias("d"))

    def step(s: Column, k: Column) -> Column:
        def joined(p: Column) -> Column:
            d = 1.0 / _apart(p["down"] + p["up"] * s["d"])
            c = _apart(p["down"] + p["up"] / s["c"])
            return _once(
                F.struct(c.alias("c"), d.alias("d")),
                lambda n: F.struct((s["value"] * n["c"] * n["d"]).alias("value"), n["c"].alias("c"), n["d"].alias("d")),
            )

        return _once(F.struct(numerator(k).alias("up"), denominator(k).alias("down")), joined)

    return F.aggregate(steps, first, step, lambda s: s["value"])


def _steps(size: Column, factor: int) -> Column:
    """1, 2, ...: more for large parameters, which converge with their square root."""
    return F.sequence(F.lit(1), (F.lit(STEPS) + factor * F.sqrt(size)).cast("int"))


def upper_gamma(s: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function: a series below s + 1, a fraction above."""

    def body(p: Column) -> Column:
        s, x = p["s"], p["x"]
        front = F.exp(s * F.log(x) - x - log_gamma(s))
        begin = F.struct((1.0 / s).alias("total"), (1.0 / s).alias("term"))
        steps = _steps(F.greatest(s, x), 10)

        def add(a: Column, k: Column) -> Column:
            return _once(a["term"] * x / (s + k), lambda t: F.struct((a["total"] + t).alias("total"), t.alias("term")))

        below = 1.0 - front * F.aggregate(steps, begin, add, lambda a: a["total"])
        above = front / _fraction(x + 1 - s, _steps(s, 10), lambda k: -k * (k - s), lambda k: x + 2 * k + 1 - s)
        return F.when(x <= 0, 1.0).when(x < s + 1, below).otherwise(above)

    return _once(F.struct(s.cast("double").alias("s"), x.cast("double").alias("x")), body)


def _t_tail(p: Column) -> Column:
    t, dof = p["t"], p["dof"]

    def fraction(a: Column, b: Column, x: Column) -> Column:
        def numerator(k: Column) -> Column:
            m = F.floor(k / 2).cast("double")
            odd = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            even = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            return F.when(k % 2 == 0, odd).otherwise(even)

        return _fraction(F.lit(1.0), _steps(F.greatest(a, b), 5), numerator, lambda k: F.lit(1.0))

    def few(q: Column) -> Column:
        half, far, near = q["half"], q["far"], q["near"]
        front = F.exp(log_half_step(half) - 0.5 * math.log(math.pi) + half * F.log(far) + 0.5 * F.log(near))
        tail = front / (half * fraction(half, F.lit(0.5), far))
        body = 1.0 - front / (0.5 * fraction(F.lit(0.5), half, near))
        return F.when(far < (half + 1) / (half + 2.5), tail).otherwise(body)

    # Hill's expansion of the normal deviate that has the same tail.
    def many(w: Column) -> Column:
        z, b = w["z"], w["b"]
        second = z * (z * z * (z * z * (4 * z * z + 33) + 240) + 855) / (10 * b * (b + 0.8 * F.pow(z, 4) + 100))
        deviate = z + (z * z * z + 3 * z) / b - second
        return upper_gamma(F.lit(0.5), deviate * deviate / 2)

    shares = F.struct((dof / 2).alias("half"), (dof / (dof + t * t)).alias("far"), (t * t / (dof + t * t)).alias("near"))
    deviate = F.struct(F.sqrt((dof - 0.5) * F.log1p(t * t / dof)).alias("z"), (48 * (dof - 0.5) * (dof - 0.5)).alias("b"))
    return F.when(t == 0, 1.0).when(dof > MANY, _once(deviate, many)).otherwise(_once(shares, few))


def _column(x: str | Column) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def t_pvalue(statistic: str | Column, dof: str | Column) -> Column:
    """Two-sided p-value of a t statistic; NULL for a NULL or without degrees of freedom."""
    given = F.struct(_column(statistic).alias("t"), _column(dof).alias("dof"))
    return F.when(_column(statistic).isNotNull() & (_column(dof) > 0), _once(given, _t_tail))


def chi2_pvalue(statistic: str | Column, dof: str | Column) -> Column:
    """Upper tail of a chi-square statistic; NULL for a NULL or without degrees of freedom."""
    return F.when(
        _column(statistic).isNotNull() & (_column(dof) > 0), upper_gamma(_column(dof) / 2, _column(statistic) / 2)
    )
