import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slackline.functions import special
from slackline.operators import stats

# Plain Python of the same tails, one number at a time.
TINY = 1e-300
TOLERANCE = 1e-15
STEPS = 200000


def fraction_of(terms) -> float:
    """Value of a continued fraction b0 + a1/(b1 + a2/(b2 + ...)) (modified Lentz)."""
    _, b0 = next(terms)
    value = b0 or TINY
    c, d = value, 0.0
    for a, b in terms:
        d = 1.0 / ((b + a * d) or TINY)
        c = (b + a / c) or TINY
        value *= c * d
        if abs(c * d - 1.0) < TOLERANCE:
            break
    return value


def plain_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - plain_beta(b, a, 1.0 - x)

    def terms():
        yield 0.0, 1.0
        for i in range(STEPS):
            m = i // 2
            if i % 2:
                m += 1
                yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
            else:
                yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0

    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    return math.exp(log_front) / (a * fraction_of(terms()))


def plain_gamma(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    log_front = s * math.log(x) - x - math.lgamma(s)
    if x < s + 1:
        total = term = 1.0 / s
        for k in range(1, STEPS):
            term *= x / (s + k)
            total += term
            if term < total * TOLERANCE:
                break
        return 1.0 - math.exp(log_front) * total

    def terms():
        yield 0.0, x + 1 - s
        for k in range(1, STEPS):
            yield -k * (k - s), x + 2 * k + 1 - s

    return math.exp(log_front) / fraction_of(terms())


def plain_t(t: float, dof: float) -> float:
    """Two-sided p-value of a t statistic.

    From the smaller end where t is small: ``1 - dof / (dof + t * t)`` would lose its digits.
    """
    near = t * t / (dof + t * t)
    if near < 0.5:
        return 1.0 - plain_beta(0.5, dof / 2, near)
    return plain_beta(dof / 2, 0.5, dof / (dof + t * t))


def plain_chi2(chi2: float, dof: float) -> float:
    """Upper tail of a chi-square statistic."""
    return plain_gamma(dof / 2, chi2 / 2)


@pytest.mark.parametrize(
    "t, dof, p",
    [
        (0.0, 5, 1.0),
        (1.0, 1, 0.5),
        (2.0, 10, 0.07338803477074),
        (12.706204736, 1, 0.05),
        (2.228138852, 10, 0.05),
        (-2.228138852, 10, 0.05),
        (1.959963985, 1e7, 0.05),
    ],
)
def test_t_tail(spark, t, dof, p):
    assert tails(spark, special.t_pvalue, [(t, dof)]) == [pytest.approx(p, rel=1e-6)]


@pytest.mark.parametrize(
    "chi2, dof, p",
    [
        (0.0, 1, 1.0),
        (3.841458821, 1, 0.05),
        (6.634896601, 1, 0.01),
        (5.991464547, 2, 0.05),
        (18.307038053, 10, 0.05),
        (2.0, 2, math.exp(-1)),
        (200.0, 3, 4.2161e-43),
    ],
)
def test_chi2_tail(spark, chi2, dof, p):
    found = tails(spark, special.chi2_pvalue, [(chi2, dof)])[0]
    assert found == pytest.approx(p, rel=1e-4)
    if dof == 1:
        assert found == pytest.approx(math.erfc(math.sqrt(chi2 / 2)), rel=1e-10)


def tails(spark, pvalue, pairs):
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pairs)], "i int, a double, b double")
    return [r["p"] for r in df.select("i", pvalue("a", "b").alias("p")).orderBy("i").collect()]


def test_tails_match_plain_python(spark):
    dofs = [0.3, 1, 1.7, 2, 3, 5, 10, 37.2, 100, 999, 1001, 5000, 1e5]
    pairs = [(t, d) for d in dofs for t in (-30.0, -2.5, 1e-9, 0.01, 0.3, 1.0, 1.96, 4.0, 12.0)]
    found = tails(spark, special.t_pvalue, pairs)
    assert found == pytest.approx([plain_t(*x) for x in pairs], rel=1e-9, abs=1e-12)
    pairs = [(d * f, d) for d in [1, 2, 3, 7, 20, 101, 1000, 20000] for f in (1e-9, 0.01, 0.5, 0.99, 1.0, 1.02, 1.2, 3.0)]
    found = tails(spark, special.chi2_pvalue, pairs)
    assert found == pytest.approx([plain_chi2(*x) for x in pairs], rel=1e-9, abs=1e-12)


def test_gamma_functions(spark):
    numbers = [1e-3, 0.5, 1.0, 2.5, 19.0, 300.0, 1e6]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    rows = df.select("x", special.log_gamma(F.col("x")).alias("g"), special.log_half_step(F.col("x")).alias("h")).collect()
    for r in rows:
        assert r["g"] == pytest.approx(math.lgamma(r["x"]), rel=1e-13, abs=1e-13)
        assert r["h"] == pytest.approx(math.lgamma(r["x"] + 0.5) - math.lgamma(r["x"]), rel=1e-9, abs=1e-11)


def test_unknown_statistics_have_no_pvalue(spark):
    df = spark.createDataFrame([(None, 3.0), (1.0, None), (1.0, 0.0)], "a double, b double")
    for pvalue in (special.t_pvalue, special.chi2_pvalue):
        assert [r[0] for r in df.select(pvalue("a", "b")).collect()] == [None] * 3


def arms(spark, first, second):
    rows = [("a", v) for v in first] + [("b", v) for v in second]
    return spark.createDataFrame(rows, "arm string, x double")


def test_welch(spark):
    first, second = [27.5, 21.0, 19.0, 23.6, 17.0, 17.9], [27.1, 22.0, 20.8, 23.4, 23.4, 23.5, 25.8]
    r = stats.welch(arms(spark, [*first, None], second), "arm", "x", "a", "b").first()
    va, vb = np.var(first, ddof=1) / 6, np.var(second, ddof=1) / 7
    t = (np.mean(first) - np.mean(second)) / math.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va**2 / 5 + vb**2 / 6)
    assert (r["n1"], r["n2"]) == (6, 7)
    assert (r["t"], r["dof"]) == (pytest.approx(t), pytest.approx(dof))
    # Density of the t distribution summed over the tail.
    grid = np.linspace(abs(t), 400, 4_000_001)
    density = math.gamma((dof + 1) / 2) / math.gamma(dof / 2) / math.sqrt(dof * math.pi) * (1 + grid**2 / dof) ** (-(dof + 1) / 2)
    assert r["p"] == pytest.approx(2 * np.trapezoid(density, grid), rel=1e-4)


def test_welch_without_variance_or_with_one_value(spark):
    r = stats.welch(arms(spark, [1.0, 1.0], [2.0, 2.0]), "arm", "x", "a", "b").first()
    assert (r["t"], r["p"]) == (None, None)
    r = stats.welch(arms(spark, [1.0], [2.0, 3.0]), "arm", "x", "a", "b").first()
    assert (r["t"], r["dof"], r["p"]) == (None, None, None)


def table(spark, counts, columns):
    rows = [(i, j) for i, row in enumerate(counts) for j, n in enumerate(row) for _ in range(n)]
    df = spark.createDataFrame(rows, "r int, c int")
    cells = stats.count_cells("r", "c", list(range(len(counts))), list(range(columns)))
    return stats.chi_square(df, cells).first()


def test_chi_square_two_by_two(spark):
    r = table(spark, [[10, 20], [30, 15]], 2)
    n, det = 75, 10 * 15 - 20 * 30
    margins = 30 * 45 * 40 * 35
    assert r["n"] == n and r["dof"] == 1
    assert r["chi2"] == pytest.approx(n * det**2 / margins)
    assert r["chi2_yates"] == pytest.approx(n * (abs(det) - n / 2) ** 2 / margins)
    assert r["phi"] == r["cramers_v"] == pytest.approx(math.sqrt(r["chi2"] / n))
    assert sum(r["expected"]) == pytest.approx(n)
    assert r["p"] == pytest.approx(math.erfc(math.sqrt(r["chi2"] / 2)))


def test_chi_square_two_by_three_has_no_correction(spark):
    r = table(spark, [[5, 10, 15], [10, 10, 0]], 3)
    assert r["dof"] == 2
    assert r["chi2_yates"] == r["chi2"]
    assert r["p"] == pytest.approx(math.exp(-r["chi2"] / 2))


def test_empty_margin_gives_no_statistic(spark):
    r = table(spark, [[5, 0], [3, 0]], 2)
    assert (r["chi2"], r["p"]) == (None, None)


def test_moments_are_population_moments(spark):
    numbers = np.array([1.0, 2.0, 2.0, 9.0])
    r = stats.moments(spark.createDataFrame([(float(v),) for v in numbers], "x double"), "x").first()
    z = numbers - numbers.mean()
    assert r["skewness"] == pytest.approx((z**3).mean() / (z**2).mean() ** 1.5)
    assert r["kurtosis"] == pytest.approx((z**4).mean() / (z**2).mean() ** 2 - 3)
    assert r["std"] == pytest.approx(numbers.std(ddof=1))


def test_normal_curve(spark):
    df = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    out = sorted(stats.normal_curve(df, "x", points=5, margin=0.1).collect())
    assert [r["x"] for r in out] == pytest.approx([-1.0, 2.0, 5.0, 8.0, 11.0])
    std = math.sqrt(50)
    assert out[2]["density"] == pytest.approx(1 / (std * math.sqrt(2 * math.pi)))


def test_arm_moments(spark):
    r = stats.arm_moments(arms(spark, [1.0, 3.0, None], [2.0]), "arm", "x").orderBy("arm").collect()
    assert (r[0]["n"], r[0]["mean"], r[0]["variance"]) == (2, 2.0, 2.0)
    assert r[1]["variance"] is None


def test_t_tail_keeps_its_digits_at_large_degrees_of_freedom(spark):
    for dof in (1e4, 1e8, 1e10, 1e12):
        near, far = tails(spark, special.t_pvalue, [(0.01, dof), (1.959963985, dof)])
        assert near == pytest.approx(0.9920213, abs=2e-6)
        assert far == pytest.approx(0.05, abs=2e-4 if dof < 1e6 else 2e-5)


def test_tests_per_group(spark):
    """Every group has the row it has alone, and no Python runs."""
    rng = np.random.default_rng(2)
    rows = [(g, "a" if rng.random() < 0.5 else "b", float(rng.normal(g, 1 + g))) for g in range(6) for _ in range(30)]
    df = spark.createDataFrame([*rows, (None, "a", 1.0)], "g int, arm string, x double")
    found = stats.welch(df, "arm", "x", "a", "b", by=("g",))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    for r in found.collect():
        alone = stats.welch(df.where(F.col("g").eqNullSafe(r["g"])), "arm", "x", "a", "b").first()
        for name in ("n1", "n2", "t", "dof", "p"):
            assert r[name] == pytest.approx(alone[name]), name
    cells = stats.count_cells("arm", "high", ["a", "b"], [True, False])
    marked = df.withColumn("high", F.col("x") > F.col("g"))
    found = stats.chi_square(marked, cells, by=("g",))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    for r in found.where("g IS NOT NULL").collect():
        alone = stats.chi_square(marked.where(F.col("g") == r["g"]), cells).first()
        for name in ("n", "chi2", "chi2_yates", "cramers_v", "p", "p_yates"):
            assert r[name] == pytest.approx(alone[name]), name
