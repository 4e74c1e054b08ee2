"""The same queries as SQL text for DuckDB, one string per query."""

from __future__ import annotations

from slackline.fixed_values import (
    AGE_LABELS,
    CATEGORIES,
    CROSSWALK,
    EXPERIENCE_LABELS,
    FORECAST,
    FUNNEL_STEPS,
    SEED,
    SENTIMENTS,
)

DEC = "DECIMAL(28,2)"
SPACE = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"


def _in(values) -> str:
    return ", ".join(str(v) for v in values)


def _panel(extra: str = "", group: str = "") -> str:
    return f"""
SELECT n.n_name AS region, p.p_size AS acc_id, CAST(year(l.l_shipdate) AS INT) AS year{extra},
  CAST(SUM(CASE WHEN l.l_linestatus = 'F' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS budget,
  CAST(SUM(CASE WHEN l.l_returnflag <> 'R' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS realized
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY n.n_name, p.p_size, year(l.l_shipdate){group}"""


MARKED = """
SELECT *, CASE WHEN year % 2 = 0 AND mark % 29 = 0 THEN 'undecodable text'
  WHEN mark % 17 = 0 THEN 'more cells than the header' WHEN mark % 19 = 0 THEN 'fewer cells than the header' END AS reason
FROM (SELECT *, acc_id * 31 + year + CAST(regexp_extract(region, '\\d+') AS INT) AS mark FROM panel)"""

STANDARD = "CASE l.l_linestatus WHEN 'F' THEN 'HRM2' ELSE 'HRM1' END"
PANEL = _panel()
PANEL_STD = _panel(f", {STANDARD} AS standard", ", l.l_linestatus")

PANEL_FULL = """
SELECT *, COALESCE(LEAD(budget) OVER (PARTITION BY region, acc_id ORDER BY year), 0) AS budget_next,
  CASE WHEN budget = 0 THEN 0 ELSE budget - realized END AS slack
FROM panel"""

ENGINEERED = """
SELECT * FROM (
  SELECT * REPLACE (CAST(year - (SELECT MIN(year) FROM {source}) AS INT) AS year),
    LAG(realized, 1) OVER (PARTITION BY region, acc_id ORDER BY year) AS realized_lag1,
    LAG(realized, 2) OVER (PARTITION BY region, acc_id ORDER BY year) AS realized_lag2
  FROM {source})
WHERE NOT (realized = 0 AND budget = 0) AND NOT (budget = 0 AND acc_id IN (10, 14, 20, 29))
  AND acc_id IN ({accounts})"""

SURVEY = """
SELECT c.c_custkey AS pid, CASE WHEN c.c_custkey % 2 = 0 THEN 'AI' ELSE 'NonAI' END AS arm,
  a.o_totalprice AS initial,
  CASE WHEN b.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN b.o_totalprice END AS resub,
  CASE WHEN c.c_custkey % 7 = 0 THEN NULL WHEN c.c_custkey % 5 = 0 THEN 'wrong' ELSE 'ok' END AS manip_check
FROM customer c
LEFT JOIN numbered a ON a.o_custkey = c.c_custkey AND a.rn = 1
LEFT JOIN numbered b ON b.o_custkey = c.c_custkey AND b.rn = 2"""

NUMBERED = """
SELECT o_custkey, o_totalprice, o_orderpriority,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
FROM orders"""

ANSWERED = """
SELECT pid, arm, initial, resub AS again, COALESCE(resub, initial) AS final
FROM survey WHERE manip_check = 'ok'"""

REDUCED = f"""
SELECT pid, arm, initial, final, final - {FORECAST} AS slack, initial - final AS reduction,
  0 - abs(initial - final) AS negative, (initial - final) / NULLIF(initial, 0) AS relative_reduction
FROM answered
WHERE final - {FORECAST} >= 0 AND initial - final >= 0"""

PEOPLE = """
SELECT c.c_custkey AS pid,
  CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'Male' WHEN 'BUILDING' THEN 'Female'
    WHEN 'AUTOMOBILE' THEN 'Non-binary' WHEN 'HOUSEHOLD' THEN 'Prefer not to say' END AS sex,
  CAST(18 + c.c_custkey % 60 AS INT) AS age, n.n_name AS nationality,
  CAST(c.c_custkey % 130 AS DOUBLE) / 10 AS experience
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey"""

LINES = f"""
SELECT doc_id, CAST(line_no AS INT) AS line_no, text FROM (
  SELECT doc_id, i - 1 AS line_no,
    regexp_replace(parts[i], '^{SPACE}+|{SPACE}+$', '', 'g') AS text
  FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\n|\\r') AS parts FROM documents),
    LATERAL (SELECT unnest(generate_series(1, len(parts))) AS i))
WHERE length(text) > 0"""

WORDS = {
    "THE": (["positive"], 0.5, 0.25),
    "OF": (["negative"], -0.5, 0.5),
    "WAS": (["uncertainty"], -0.25, 0.75),
    "TO": (["litigious"], 0.125, 0.0),
    "WITH": (["strong_modal"], 1.0, 1.0),
    "FOR": (["weak_modal", "uncertainty"], 0.75, 0.5),
    "AND": (["constraining"], -1.0, 0.125),
}
LEXICON = "SELECT * FROM (VALUES " + ", ".join(
    f"('{w}', CAST({p} AS DOUBLE), CAST({s} AS DOUBLE), "
    + ", ".join(str(int(x in flags)) for x in SENTIMENTS) + ")"
    for w, (flags, p, s) in WORDS.items()
) + f") t(word, polarity, subjectivity, {', '.join(SENTIMENTS)})"

XWALK = "SELECT * FROM (VALUES " + ", ".join(
    f"('{old}', '{new}', CAST(1 AS DOUBLE) / {len(targets)})"
    for old, targets in CROSSWALK.items() for new in targets
) + ") t(old_acc, new_acc, ratio)"

CATEGORY = "SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', {acc})" for name, accounts in CATEGORIES.items() for acc in accounts
) + ") t(category, acc_id)"

LEGACY = """
SELECT region, CASE WHEN acc_id BETWEEN 34 AND 37 THEN '34 - 37' WHEN acc_id IN (41, 43) THEN '41 / 43'
  WHEN acc_id BETWEEN 44 AND 47 THEN '44 - 47' WHEN acc_id = 38 THEN '32'
  ELSE CAST(acc_id AS VARCHAR) END AS acc_id, year, budget, realized
FROM panel"""

VIEWS = {
    "panel": PANEL,
    "panel_std": PANEL_STD,
    "panel_full": PANEL_FULL,
    "aufwand": ENGINEERED.format(source="panel", accounts=_in(CATEGORIES["Aufwand"])),
    "aufwand_full": ENGINEERED.format(source="panel_full", accounts=_in(CATEGORIES["Aufwand"])),
    "alle_full": ENGINEERED.format(source="panel_full", accounts=_in(CATEGORIES["Alle"])),
    "ertrag": ENGINEERED.format(source="panel", accounts=_in(CATEGORIES["Ertrag"])),
    "tested": "SELECT * FROM aufwand WHERE year > (SELECT MAX(year) FROM aufwand) - 1",
    "forecasts": """
SELECT region, acc_id, 'budget' AS forecast, realized AS y, budget AS f FROM tested
UNION ALL SELECT region, acc_id, 'lag1', realized, realized_lag1 FROM tested""",
    "diffs": "SELECT *, (budget - realized) / NULLIF(realized, 0) * 100 AS pct_diff FROM ertrag",
    "clipped": """
SELECT * FROM diffs WHERE pct_diff BETWEEN (SELECT quantile_cont(pct_diff, 0.01) FROM diffs)
  AND (SELECT quantile_cont(pct_diff, 0.99) FROM diffs)""",
    "legacy": LEGACY,
    "xwalk": XWALK,
    "category": CATEGORY,
    "numbered": NUMBERED,
    "survey": SURVEY,
    "answered": ANSWERED,
    "reduced": REDUCED,
    "people": PEOPLE,
    "participants": "SELECT * FROM people WHERE pid IN (SELECT pid FROM answered)",
    "lexicon": LEXICON,
    "lines": LINES,
}
NEEDS = {
    "panel_full": ["panel"], "aufwand": ["panel"], "aufwand_full": ["panel_full"],
    "alle_full": ["panel_full"], "ertrag": ["panel"], "tested": ["aufwand"],
    "forecasts": ["tested"], "diffs": ["ertrag"], "clipped": ["diffs"], "legacy": ["panel"],
    "survey": ["numbered"], "answered": ["survey"], "reduced": ["answered"],
    "participants": ["people", "answered"],
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, []):
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def sql(select: str, *views: str, **extra: str) -> str:
    """``select`` with the named views, and what they need, as a WITH list."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in _closure(list(views))]
    parts += [f"{name} AS ({body})" for name, body in extra.items()]
    return f"WITH {', '.join(parts)}\n{select}" if parts else select


EPS = "CAST(2.220446049250313e-16 AS DOUBLE)"


def _errors(y: str, f: str) -> str:
    e = f"abs({y} - {f})"
    columns = [
        f"COUNT({e}) AS n",
        f"round(AVG({e}), 6) AS mae",
        f"round(AVG({e} * {e}), -2) AS mse",
        f"round(sqrt(AVG({e} * {e})), 6) AS rmse",
    ]
    share = f"AVG({e} / greatest(abs({y}), {EPS}))"
    columns.append(f"CASE WHEN {share} > 1e9 THEN round({share}, -10) ELSE round({share}, 6) END AS mape")
    columns.append(f"round(AVG(CASE WHEN {y} <> 0 THEN {e} / abs({y}) END), 6) AS mape_nonzero")
    return ", ".join(columns)


def _describe(name: str, x: str, digits: int, all_rounded: bool = False, by: str = "", mean_digits: int | None = None) -> str:
    low, high = f"CAST(MIN({x}) AS DOUBLE)", f"CAST(MAX({x}) AS DOUBLE)"
    if all_rounded:
        low, high = f"round({low}, {digits})", f"round({high}, {digits})"
    quartiles = ", ".join(
        f"round(quantile_cont({x}, {p}), {digits}) AS {q}"
        for p, q in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    )
    return (
        f"SELECT {by + ', ' if by else ''}'{name}' AS series, COUNT({x}) AS count, round(AVG({x}), {mean_digits or digits}) AS mean, "
        f"round(stddev_samp({x}), {digits}) AS std, {low} AS min, {quartiles}, {high} AS max"
    )


def _labels(labels: list[str]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{x}')" for i, x in enumerate(labels)
    ) + ") t(position, label)"


def _shares(source: str, group: str, labels: list[str]) -> str:
    return f"""
SELECT CAST(d.position AS INT) AS position, d.label, COALESCE(c.n, 0) AS n,
  round(COALESCE(COALESCE(c.n, 0) * 100.0::DOUBLE / NULLIF((SELECT COUNT({group}) FROM {source}), 0), 0), 6) AS pct
FROM ({_labels(labels)}) d
LEFT JOIN (SELECT {group} AS label, COUNT(*) AS n FROM {source} GROUP BY 1) c USING (label)"""


# Two-sided t tail and chi-square tail with one degree of freedom by Simpson's rule.
STEPS = 20000


def _simpson(upper: str, density: str) -> str:
    return f"""(SELECT SUM(w * {density}) * {upper} / {3 * STEPS} FROM (
      SELECT {upper} * i / {STEPS} AS z, CASE WHEN i = 0 OR i = {STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
      FROM (SELECT CAST(unnest(generate_series(0, {STEPS})) AS DOUBLE) AS i)))"""


def _welch(source: str, value: str, arms: tuple[str, str] = ("AI", "NonAI"), by: str = "") -> str:
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    x = f"CAST({value} AS DOUBLE)"
    sides = ", ".join(
        f"COUNT({x}) FILTER (arm = '{arm}') AS n{i}, AVG({x}) FILTER (arm = '{arm}') AS m{i}, "
        f"var_samp({x}) FILTER (arm = '{arm}') AS v{i}"
        for i, arm in enumerate(arms, 1)
    )
    t_density = "exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi()) * pow(1 + z * z / dof, -(dof + 1) / 2)"
    return f"""
SELECT {key}n1, round(m1, 4) AS mean1, round(v1, 4) AS var1, n2, round(m2, 4) AS mean2, round(v2, 4) AS var2,
  round(t, 4) AS t, round(dof, 4) AS dof, round(1 - 2 * {_simpson('abs(t)', t_density)}, 4) AS p
FROM (
  SELECT *, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t,
    pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS dof
  FROM (SELECT {key}{sides} FROM {source}{group}))"""


def _chi(a: str, b: str, c: str, d: str, source: str, by: str = "") -> str:
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    e = {
        "0": "CAST(a + b AS DOUBLE) * (a + c) / n", "1": "CAST(a + b AS DOUBLE) * (b + d) / n",
        "2": "CAST(c + d AS DOUBLE) * (a + c) / n", "3": "CAST(c + d AS DOUBLE) * (b + d) / n",
    }
    cells = dict(zip("0123", "abcd"))
    plain = " + ".join(f"pow({cells[i]} - e{i}, 2) / e{i}" for i in e)
    yates = " + ".join(
        f"pow(abs({cells[i]} - e{i}) - least(abs({cells[i]} - e{i}), 0.5::DOUBLE), 2) / e{i}" for i in e
    )
    density = "exp(-z * z / 2) / sqrt(2 * pi())"
    return f"""
SELECT {key}n, CAST(1 AS INT) AS dof, round(chi2, 6) AS chi2, round(yates, 6) AS chi2_yates,
  round(sqrt(chi2 / n), 6) AS cramers_v, round(sqrt(chi2 / n), 6) AS phi,
  round(1 - 2 * {_simpson('sqrt(chi2)', density)}, 6) AS p,
  round(1 - 2 * {_simpson('sqrt(yates)', density)}, 6) AS p_yates,
  round(e0, 4) AS expected_0, round(e1, 4) AS expected_1, round(e2, 4) AS expected_2, round(e3, 4) AS expected_3
FROM (SELECT *, {plain} AS chi2, {yates} AS yates FROM (
  SELECT *, {', '.join(f'{x} AS e{i}' for i, x in e.items())} FROM (
    SELECT *, a + b + c + d AS n FROM (
      SELECT {key}CAST({a} AS BIGINT) AS a, CAST({b} AS BIGINT) AS b, CAST({c} AS BIGINT) AS c, CAST({d} AS BIGINT) AS d
      FROM {source}{group}))))"""


def _histogram(source: str, x: str, bins: int, digits: int, density: bool) -> str:
    extra = (
        f", round(COALESCE(n, 0) / ((SELECT COUNT({x}) FROM {source}) * ((hi - lo) / {bins})), 12) AS density"
        if density else ""
    )
    return f"""
SELECT CAST(b.bin AS BIGINT) AS bin, round(lo + b.bin * ((hi - lo) / {bins}), {digits}) AS low,
  round(lo + (b.bin + 1) * ((hi - lo) / {bins}), {digits}) AS high, COALESCE(n, 0) AS n{extra}
FROM (SELECT unnest(generate_series(0, {bins - 1})) AS bin) b
CROSS JOIN (SELECT MIN({x}) AS lo, MAX({x}) AS hi FROM {source})
LEFT JOIN (
  SELECT least(floor({bins} * ({x} - lo) / (hi - lo)), {bins - 1}) AS bin, COUNT(*) AS n
  FROM {source}, (SELECT MIN({x}) AS lo, MAX({x}) AS hi FROM {source}) WHERE {x} IS NOT NULL GROUP BY 1
) h ON h.bin = b.bin"""


def _sums(columns: list[str]) -> str:
    return ", ".join(f"CAST(SUM(CAST({c} AS {DEC})) AS DOUBLE) AS {c}" for c in columns)


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

CELLS = """
SELECT region, year, CASE WHEN mark % 13 = 0 THEN 'A' || acc_id ELSE CAST(acc_id AS VARCHAR) END AS acc_id,
  CASE WHEN mark % 7 = 0 THEN '' ELSE b END AS budget, CASE WHEN mark % 11 = 0 THEN 'n/a' ELSE r END AS realized,
  CASE WHEN mark % 5 = 0 THEN NULL ELSE b END AS budget_next
FROM (SELECT *, acc_id * 31 + year AS mark, CAST(CAST(budget AS DECIMAL(18,2)) AS VARCHAR) AS b,
  CAST(CAST(realized AS DECIMAL(18,2)) AS VARCHAR) AS r FROM panel)"""


def _number(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{NUMBER}') THEN TRY_CAST({c} AS DOUBLE) END"


# The sheets of the Spark fixture hold these rows; the header tricks leave no trace here.
SHEETS = """
SELECT standard, 'N' || chr(65 + CAST(regexp_extract(region, '\\d+') AS INT)) AS region, year + 20 AS year,
  CASE WHEN standard = 'HRM2' AND year + 20 >= 2019 AND acc_id % 9 <> 0 THEN 'HRM2_ER' || acc_id END AS ref_id,
  CASE WHEN standard = 'HRM2' THEN CAST(acc_id AS VARCHAR) WHEN acc_id BETWEEN 34 AND 37 THEN '34 - 37'
    WHEN acc_id IN (41, 43) THEN '41 / 43' ELSE CAST(acc_id AS VARCHAR) END AS old_id,
  'Konto, ' || acc_id AS name, budget AS b, realized AS r
FROM panel_std
WHERE NOT (standard = 'HRM2' AND year + 20 >= 2019 AND acc_id % 9 = 0)"""

MAPPED = """
SELECT standard, region, year, ref_id, COALESCE(new_acc, old_id) AS acc_id, name,
  b * COALESCE(ratio, 1) AS budget, r * COALESCE(ratio, 1) AS realized
FROM sheets LEFT JOIN xwalk ON standard = 'HRM1' AND old_id = old_acc"""

RATE = """
SELECT d.arm, COALESCE(n, 0) AS n, COALESCE(k, 0) AS resubmissions,
  round_even(COALESCE(k * 100.0::DOUBLE / NULLIF(n, 0), 0), 2) AS rate_pct,
  round_even(change / NULLIF(k, 0), 2) AS mean_change
FROM (VALUES ('AI'), ('NonAI')) d(arm) LEFT JOIN (
  SELECT arm, COUNT(*) AS n, COUNT(*) FILTER (initial IS NOT NULL AND again IS NOT NULL) AS k,
    CAST(SUM(CAST(again - initial AS DECIMAL(28,2))) AS DOUBLE) AS change
  FROM answered GROUP BY arm) USING (arm)"""

ATTACHED = "SELECT a.*, p.age, p.sex, p.experience FROM answered a LEFT JOIN people p USING (pid)"
SEX = "CASE WHEN sex IN ('Prefer not to say', 'Non-binary', 'Other') THEN 'Other' ELSE sex END"
AGE = "CASE " + " ".join(
    f"WHEN age >= {low} AND age < {high} THEN '{name}'"
    for low, high, name in zip((0, 24, 35, 51, 66), (24, 35, 51, 66, 100000), AGE_LABELS)
) + " END"
EXPERIENCE = (
    f"CASE WHEN experience < 1 THEN '{EXPERIENCE_LABELS[0]}' WHEN experience BETWEEN 1 AND 5 THEN '{EXPERIENCE_LABELS[1]}' "
    f"WHEN experience BETWEEN 6 AND 10 THEN '{EXPERIENCE_LABELS[2]}' ELSE '{EXPERIENCE_LABELS[3]}' END"
)

# Tokens are split first, then matched; a line keeps its row without any match.
TOKENS = f"""
SELECT doc_id, line_no, substr(text, 1, 50) AS label,
  unnest(regexp_split_to_array(upper(text), '{SPACE}+')) AS word
FROM lines"""
SENTIMENT_SUMS = ", ".join(f"CAST(SUM(COALESCE(x.{s}, 0)) AS BIGINT) AS {s}" for s in SENTIMENTS)

HITS = "COUNT(*) FILTER (arm = '{0}' AND initial IS NOT NULL AND again IS NOT NULL)"
MISSES = "COUNT(*) FILTER (arm = '{0}' AND NOT (initial IS NOT NULL AND again IS NOT NULL))"
SIZE = "COUNT(*) FILTER (arm = '{0}')"


def _moments(x: str) -> str:
    return f"""COUNT({x}) AS n, round(AVG({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std,
  round((SUM(pow({x} - mu, 3)) / COUNT({x})) / pow(SUM(pow({x} - mu, 2)) / COUNT({x}), 1.5), 4) AS skewness,
  round((SUM(pow({x} - mu, 4)) / COUNT({x})) / pow(SUM(pow({x} - mu, 2)) / COUNT({x}), 2) - 3, 4) AS kurtosis"""


def _scaled(k: int) -> str:
    c = f"realized_lag{k}"
    train = "SELECT * FROM aufwand WHERE year <= (SELECT MAX(year) FROM aufwand) - 1"
    return (
        f"round(({c} - (SELECT AVG({c}) FROM ({train}))) / (SELECT stddev_pop({c}) FROM ({train})), 6)"
        f" AS {c}_scaled"
    )


FUNNEL = f"""
SELECT CAST(step_no AS INT) AS step_no, step, participants,
  round(COALESCE((participants - before) * 100.0::DOUBLE / NULLIF(before, 0), 0), 6) AS pct_change
FROM (SELECT *, lag(participants) OVER (ORDER BY step_no) AS before FROM (
  SELECT 1 AS step_no, '{FUNNEL_STEPS[0]}' AS step, COUNT(*) FILTER (pid % 11 <> 0) AS participants FROM survey
  UNION ALL SELECT 2, '{FUNNEL_STEPS[1]}', COUNT(initial) FROM survey
  UNION ALL SELECT 3, '{FUNNEL_STEPS[2]}', COUNT(manip_check) FROM survey
  UNION ALL SELECT 4, '{FUNNEL_STEPS[3]}', COUNT(*) FILTER (manip_check = 'ok') FROM survey))"""

ORACLES = {
    "panel_build": PANEL,
    "final_panel": sql(
        "SELECT year, region, acc_id, realized, budget, budget_next, slack FROM panel_full", "panel_full"
    ),
    "lag_features": sql(
        """SELECT region, acc_id, CAST(year - (SELECT MIN(year) FROM panel) AS INT) AS year, budget, realized,
  LAG(realized, 1) OVER (PARTITION BY region, acc_id ORDER BY year) AS realized_lag1,
  LAG(realized, 2) OVER (PARTITION BY region, acc_id ORDER BY year) AS realized_lag2 FROM panel""",
        "panel",
    ),
    "lag_features_by_year": sql(
        """SELECT p.*, a.realized AS realized_lag1, b.realized AS realized_lag2 FROM panel p
LEFT JOIN panel a ON a.region = p.region AND a.acc_id = p.acc_id AND a.year = p.year - 1
LEFT JOIN panel b ON b.region = p.region AND b.acc_id = p.acc_id AND b.year = p.year - 2""",
        "panel",
    ),
    "lag_entries": """SELECT *, LAG(realized, 1) OVER w AS realized_lag1, LAG(realized, 2) OVER w AS realized_lag2 FROM (
  SELECT n.n_name AS region, p.p_size AS acc_id, CAST(year(l.l_shipdate) AS INT) AS year, l.l_orderkey, l.l_linenumber,
    CAST(CASE WHEN l.l_returnflag <> 'R' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) ELSE 0 END AS DOUBLE) AS realized
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN part p ON p.p_partkey = l.l_partkey)
WINDOW w AS (PARTITION BY region, acc_id ORDER BY year, l_orderkey, l_linenumber, realized)""",
    "zero_row_drop": sql(
        """SELECT * FROM panel WHERE NOT (realized = 0 AND budget = 0)
  AND NOT (budget = 0 AND acc_id IN (10, 14, 20, 29))""",
        "panel",
    ),
    "category_accounts": sql(
        "SELECT category, region, acc_id, year, budget, realized FROM panel JOIN category USING (acc_id)",
        "panel", "category",
    ),
    "engineered_frame": sql("SELECT * FROM aufwand_full", "aufwand_full"),
    "temporal_holdout": sql(
        """SELECT region, acc_id, year, realized_lag1, realized_lag2,
  CASE WHEN year > (SELECT MAX(year) FROM alle_full) - 1 THEN 'test' ELSE 'train' END AS split FROM alle_full""",
        "alle_full",
    ),
    "budget_eval": sql(f"SELECT forecast, {_errors('y', 'f')} FROM forecasts GROUP BY forecast", "forecasts"),
    "budget_eval_rounded": sql(
        f"""SELECT n, mae, mse, round_even(sqrt(mse), 2) AS rmse, mape, mape_nonzero FROM (
  SELECT COUNT(e) AS n, round_even(AVG(e), 2) AS mae, round_even(AVG(e * e), 2) AS mse,
    round_even(AVG(e / greatest(abs(realized), {EPS})), 2) AS mape,
    round_even(AVG(CASE WHEN realized <> 0 THEN e / abs(realized) END), 2) AS mape_nonzero
  FROM (SELECT *, abs(realized - budget) AS e FROM tested))""",
        "tested",
    ),
    "eval_by_slice": sql(
        f"""SELECT forecast, region, acc_id, {_errors('y', 'f')} FROM forecasts
GROUP BY GROUPING SETS ((forecast), (forecast, acc_id), (forecast, region), (forecast, region, acc_id))""",
        "forecasts",
    ),
    "eval_by_region_own_year": sql(
        f"""SELECT region, {_errors('realized', 'budget')} FROM aufwand a
WHERE year = (SELECT MAX(year) FROM aufwand b WHERE b.region = a.region) GROUP BY region""",
        "aufwand",
    ),
    "metrics_table": sql(
        f"""SELECT forecast, metric, value FROM (
  SELECT forecast, CAST(n AS DOUBLE) AS n, mae, mse, rmse, mape, mape_nonzero
  FROM (SELECT forecast, {_errors('y', 'f')} FROM forecasts GROUP BY forecast))
UNPIVOT (value FOR metric IN (n, mae, mse, rmse, mape, mape_nonzero))""",
        "forecasts",
    ),
    "crosswalk_split": sql(
        """SELECT region, COALESCE(new_acc, acc_id) AS acc_id, year, budget * COALESCE(ratio, 1) AS budget,
  realized * COALESCE(ratio, 1) AS realized FROM legacy LEFT JOIN xwalk ON acc_id = old_acc""",
        "legacy", "xwalk",
    ),
    "crosswalk_sums": sql(
        """SELECT region, COALESCE(new_acc, acc_id) AS acc_id, year,
  CAST(SUM(CAST(budget * COALESCE(ratio, 1) AS DECIMAL(28,6))) AS DOUBLE) AS budget,
  CAST(SUM(CAST(realized * COALESCE(ratio, 1) AS DECIMAL(28,6))) AS DOUBLE) AS realized
FROM legacy LEFT JOIN xwalk ON acc_id = old_acc GROUP BY region, COALESCE(new_acc, acc_id), year""",
        "legacy", "xwalk",
    ),
    "populated_standards": sql(
        """SELECT year, region, standard,
  COALESCE(SUM(CAST(CASE WHEN acc_id < 10 THEN realized END AS DECIMAL(28,2))) <> 0, false)
  OR COALESCE(SUM(CAST(CASE WHEN acc_id < 10 THEN budget END AS DECIMAL(28,2))) <> 0, false)
  OR COALESCE(SUM(CAST(CASE WHEN acc_id >= 10 THEN realized END AS DECIMAL(28,2))) <> 0, false)
  OR COALESCE(SUM(CAST(CASE WHEN acc_id >= 10 THEN budget END AS DECIMAL(28,2))) <> 0, false) AS populated
FROM panel_std GROUP BY year, region, standard""",
        "panel_std",
    ),
    "standard_preference": sql(
        """SELECT region, acc_id, year, standard, budget, realized FROM started JOIN (
  SELECT year, region, CASE WHEN bool_or(standard = 'HRM2' AND filled) OR NOT bool_or(standard = 'HRM1')
    THEN 'HRM2' ELSE 'HRM1' END AS standard
  FROM (SELECT year, region, standard, SUM(realized) <> 0 OR SUM(budget) <> 0 AS filled
    FROM started GROUP BY year, region, standard) GROUP BY year, region) USING (year, region, standard)""",
        "panel_std",
        started="SELECT region, CAST(acc_id AS VARCHAR) AS acc_id, year, standard, budget, realized FROM panel_std",
    ),
    "numeric_clean_slack": sql(
        """SELECT region, year, acc_id, COALESCE(b, 0) AS budget, COALESCE(r, 0) AS realized, COALESCE(x, 0) AS budget_next,
  COALESCE(CASE WHEN b = 0 THEN 0 ELSE b - r END, 0) AS slack, CAST(length(acc_id) AS INT) AS level
FROM numbers""",
        "panel",
        cells=CELLS,
        numbers=f"""SELECT region, year, acc_id, {_number('budget')} AS b, {_number('realized')} AS r,
  {_number('budget_next')} AS x FROM cells WHERE regexp_matches(acc_id, '^[0-9]+$') AND acc_id <> '0'""",
    ),
    "welch_by_region": sql(
        _welch("standards", "thousands", ("HRM2", "HRM1"), "region"),
        "panel_std",
        standards="SELECT region, standard AS arm, realized / 1000 AS thousands FROM panel_std",
    ),
    "chi_square_by_supplier": "SELECT l_suppkey, n, dof, chi2, chi2_yates, cramers_v, p, p_yates FROM ("
    + _chi(
        *[
            f"COUNT(*) FILTER (l_returnflag {r} 'R' AND l_quantity {q} 25)" for r in ("<>", "=") for q in ("<=", ">")
        ],
        "lineitem",
        by="l_suppkey",
    )
    + ")",
    "sheet_header_map": sql(
        """SELECT standard, region, year, ref_id, acc_id, name, round(budget, 6) AS budget, round(realized, 6) AS realized,
  round(realized, 6) AS budget_next, round(CASE WHEN budget = 0 THEN 0 ELSE budget - realized END, 6) AS slack,
  CAST(length(acc_id) AS INT) AS level
FROM mapped WHERE regexp_matches(acc_id, '^[0-9]+$')""",
        "panel_std", "xwalk",
        sheets=SHEETS,
        mapped=MAPPED,
    ),
    "sheets_from_files": sql(
        """SELECT standard, region, year, ref_id, acc_id, name, round(budget, 6) AS budget, round(realized, 6) AS realized,
  round(realized, 6) AS budget_next, round(CASE WHEN budget = 0 THEN 0 ELSE budget - realized END, 6) AS slack,
  CAST(length(acc_id) AS INT) AS level
FROM mapped WHERE regexp_matches(acc_id, '^[0-9]+$')""",
        "panel_std", "xwalk",
        sheets=SHEETS,
        mapped=MAPPED,
    ),
    "csv_rows_from_files": sql(
        """SELECT CAST(acc_id AS VARCHAR) AS acc_id, CASE WHEN year % 2 = 0 THEN CASE mark % 3
    WHEN 0 THEN 'Konto, ' || acc_id WHEN 1 THEN 'a "b"' || chr(10) || acc_id ELSE '5 inch ' || acc_id || '"' END END AS name,
  CAST(year AS VARCHAR) AS year, region, budget, realized, CAST(NULL AS DOUBLE) AS budget_next
FROM marked WHERE reason IS NULL""",
        "panel",
        marked=MARKED,
    ),
    "csv_rejects_from_files": sql(
        """SELECT year, reason, COUNT(*) AS n FROM (SELECT year, reason FROM marked WHERE reason IS NOT NULL
  UNION ALL SELECT DISTINCT year, 'unclosed quote' FROM panel) GROUP BY year, reason""",
        "panel",
        marked=MARKED,
    ),
    "union_by_name": sql(
        """SELECT CASE WHEN year >= 1999 THEN 'HRM2_' || acc_id ELSE 'HRM1' END AS ref_id, 'Missing Name' AS name,
  year, region, acc_id, realized, budget, budget_next, slack FROM panel_full""",
        "panel_full",
    ),
    "slack_by_region_year": sql(
        f"""SELECT year, region, {_sums(['slack'])} FROM (
  SELECT year, region, CASE WHEN budget = 0 THEN 0 ELSE budget - realized END AS slack FROM panel)
GROUP BY year, region""",
        "panel",
    ),
    "sums_by_key": sql(
        f"SELECT year, region, acc_id, {_sums(['realized', 'budget'])} FROM panel_std GROUP BY year, region, acc_id",
        "panel_std",
    ),
    "personnel_by_year": sql(
        f"SELECT year, {_sums(['realized', 'budget'])} FROM panel WHERE acc_id = 30 GROUP BY year", "panel"
    ),
    "personnel_by_region_year": sql(
        f"SELECT region, year, {_sums(['realized', 'budget'])} FROM panel WHERE acc_id = 30 GROUP BY region, year",
        "panel",
    ),
    "pct_diff_clip": sql("SELECT * FROM clipped", "clipped"),
    "pct_diff_means": sql(
        """SELECT region, year, COUNT(pct_diff) AS n, round(AVG(pct_diff), 6) AS mean FROM clipped
GROUP BY GROUPING SETS ((year), (region, year))""",
        "clipped",
    ),
    "pct_diff_top10": sql(
        "SELECT * FROM clipped ORDER BY pct_diff DESC NULLS LAST, region, acc_id, year LIMIT 10", "clipped"
    ),
    "panel_tail": sql("SELECT * FROM panel ORDER BY year DESC, region DESC, acc_id DESC LIMIT 5", "panel"),
    "describe_amounts": sql(
        " UNION ALL ".join(
            _describe(n, n, 4) + " FROM slacked" for n in ("budget", "realized", "slack")
        ),
        "panel",
        slacked="SELECT *, CASE WHEN budget = 0 THEN 0 ELSE budget - realized END AS slack FROM panel",
    ),
    "describe_by_region_year": sql(
        " UNION ALL ".join(
            _describe(n, n, 4, by="region, year", mean_digits=8) + " FROM slacked GROUP BY region, year" for n in ("budget", "realized", "slack")
        ),
        "panel",
        slacked="SELECT *, CASE WHEN budget = 0 THEN 0 ELSE budget - realized END AS slack FROM panel",
    ),
    "describe_lines_by_flag": " UNION ALL ".join(
        _describe(n, n, 4, by="l_returnflag") + " FROM lineitem GROUP BY l_returnflag" for n in ("l_extendedprice", "l_quantity")
    ),
    "describe_line_amounts": " UNION ALL ".join(
        _describe(n, n, 4) + " FROM lineitem" for n in ("l_extendedprice", "l_quantity", "l_discount")
    ),
    "duplicate_rows": """SELECT user_id, event_type, CAST(ts AS DATE) AS day, COUNT(*) - 1 AS copies FROM events
GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""",
    "duplicate_rows_expanded": """SELECT user_id, event_type, day FROM (
  SELECT user_id, event_type, CAST(ts AS DATE) AS day,
    row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) AS rn FROM events) WHERE rn > 1""",
    "seeded_sample": sql(
        f"""SELECT * FROM panel ORDER BY md5('{SEED}' || '|' || region || '|' || acc_id || '|' || year),
  region, acc_id, year LIMIT 10""",
        "panel",
    ),
    "distinct_regions": sql("SELECT DISTINCT region FROM panel", "panel"),
    "survey_funnel": sql(FUNNEL, "survey"),
    "final_answer": sql("SELECT * FROM answered", "answered"),
    "any_answer": sql(
        """SELECT CAST(pid AS VARCHAR) AS PROLIFIC_PID, CAST(CAST(initial AS DECIMAL(18,2)) AS VARCHAR) AS Scenario1_Answer_1,
  CASE WHEN arm = 'AI' THEN CAST(CAST(resub AS DECIMAL(18,2)) AS VARCHAR) END AS AI_Resubmission13_1,
  CASE WHEN arm <> 'AI' THEN CAST(CAST(resub AS DECIMAL(18,2)) AS VARCHAR) END AS NoAI_Resubmission13_1
FROM survey WHERE initial IS NOT NULL OR resub IS NOT NULL""",
        "survey",
    ),
    "arm_counts": sql(
        """SELECT CAST(position AS INT) AS position, d.arm, COUNT(pid) AS n
FROM (VALUES (0, 'AI'), (1, 'NonAI')) d(position, arm) LEFT JOIN answered USING (arm) GROUP BY position, d.arm""",
        "answered",
    ),
    "arm_distribution": sql(
        """SELECT arm, stage, COUNT(x) AS count, round(AVG(x), 4) AS mean, round(stddev_samp(x), 4) AS std,
  round(median(x), 4) AS median, MIN(x) AS min, MAX(x) AS max
FROM (SELECT arm, 'initial' AS stage, initial AS x FROM answered UNION ALL SELECT arm, 'final', final FROM answered)
GROUP BY arm, stage""",
        "answered",
    ),
    "resubmission_rate": sql(RATE, "answered"),
    "reduction_pivot": sql(
        f"""SELECT 'Scenario1_Answer_1' AS scenario, MAX(mean_change) FILTER (arm = 'AI') AS "AI",
  MAX(mean_change) FILTER (arm = 'NonAI') AS "NonAI" FROM ({RATE})""",
        "answered",
    ),
    "slack_reduction": sql("SELECT pid, arm, slack, reduction, negative FROM reduced", "reduced"),
    "relative_slack_reduction": sql(
        "SELECT pid, arm, reduction, relative_reduction FROM reduced WHERE relative_reduction >= 0", "reduced"
    ),
    "demographic_shares": sql(_shares("participants", SEX, ["Male", "Female", "Other"]), "participants"),
    "nationality_shares": sql(
        """SELECT nationality, COUNT(*) AS n,
  round(COUNT(*) / CAST((SELECT COUNT(nationality) FROM participants) AS DOUBLE), 6) AS share
FROM participants WHERE nationality IS NOT NULL GROUP BY nationality""",
        "participants",
    ),
    "age_groups": sql(_shares("participants", AGE, AGE_LABELS), "participants"),
    "experience_groups": sql(_shares("participants", EXPERIENCE, EXPERIENCE_LABELS), "participants"),
    "duration_stats": " UNION ALL ".join(
        _describe(n, x, 6, all_rounded=True) + " FROM events"
        for n, x in (("seconds", "value"), ("minutes", "(value / 60)"))
    ),
    "sex_contingency": sql(
        """SELECT CAST(position AS INT) AS position, d.sex, COUNT(*) FILTER (arm = 'AI') AS "AI",
  COUNT(*) FILTER (arm = 'NonAI') AS "NonAI"
FROM (VALUES (0, 'Male'), (1, 'Female')) d(position, sex) LEFT JOIN attached USING (sex) GROUP BY position, d.sex""",
        "answered", "people", attached=ATTACHED,
    ),
    "arm_moments": sql(
        """SELECT arm, COUNT(reduction) AS n, round(AVG(reduction), 2) AS mean,
  round(var_samp(reduction), 2) AS variance, round(stddev_samp(reduction), 2) AS std FROM reduced GROUP BY arm""",
        "reduced",
    ),
    "welch_reduction": sql(_welch("reduced", "reduction"), "reduced"),
    "welch_relative": sql(_welch("(SELECT * FROM reduced WHERE relative_reduction >= 0)", "relative_reduction"), "reduced"),
    "welch_age": sql(_welch("attached", "age"), "answered", "people", attached=ATTACHED),
    "welch_experience": sql(_welch("attached", "experience"), "answered", "people", attached=ATTACHED),
    "chi_square_resubmission": sql(
        _chi(MISSES.format("AI"), HITS.format("AI"), MISSES.format("NonAI"), HITS.format("NonAI"), "answered"),
        "answered",
    ),
    "chi_square_resubmission_by_size": sql(
        _chi(SIZE.format("AI"), HITS.format("AI"), SIZE.format("NonAI"), HITS.format("NonAI"), "answered"),
        "answered",
    ),
    "chi_square_sex": sql(
        _chi(*[f"COUNT(*) FILTER (sex = '{s}' AND arm = '{a}')" for s in ("Male", "Female") for a in ("AI", "NonAI")],
             "attached"),
        "answered", "people", attached=ATTACHED,
    ),
    "moments_reduction": sql(
        f"SELECT arm, {_moments('negative')} FROM (SELECT *, AVG(negative) OVER (PARTITION BY arm) AS mu FROM reduced) GROUP BY arm",
        "reduced",
    ),
    "normal_curve": sql(
        """SELECT point, round(x, 4) AS x, round(exp(-pow((x - mean) / std, 2) / 2) / (std * sqrt(2 * pi())), 12) AS density
FROM (SELECT CAST(i AS BIGINT) AS point, lo - (hi - lo) * 0.05::DOUBLE + i * ((hi - lo) * 1.1::DOUBLE) / 99 AS x, mean, std
  FROM (SELECT unnest(generate_series(0, 99)) AS i), (
    SELECT MIN(negative) AS lo, MAX(negative) AS hi, AVG(negative) AS mean, stddev_samp(negative) AS std
    FROM reduced WHERE arm = 'AI'))""",
        "reduced",
    ),
    "histogram_10": sql(_histogram("participants", "experience", 10, 6, False), "participants"),
    "histogram_density_30": sql(
        _histogram("ai", "negative", 30, 4, True), "reduced", ai="SELECT negative FROM reduced WHERE arm = 'AI'"
    ),
    "lexicon_counts": sql(
        f"""SELECT t.doc_id, t.line_no, t.label, {SENTIMENT_SUMS}
FROM tokens t LEFT JOIN lexicon x ON x.word = t.word GROUP BY t.doc_id, t.line_no, t.label""",
        "lexicon", "lines", tokens=TOKENS,
    ),
    "lexicon_totals": sql(
        "SELECT " + ", ".join(f"CAST(SUM(COALESCE(x.{s}, 0)) AS BIGINT) AS {s}" for s in SENTIMENTS[:3])
        + " FROM tokens t LEFT JOIN lexicon x ON x.word = t.word",
        "lexicon", "lines", tokens=TOKENS,
    ),
    "answer_lexicon_counts": sql(
        f"""SELECT t.conv_id, t.turn, {SENTIMENT_SUMS}
FROM tokens t LEFT JOIN lexicon x ON x.word = t.word GROUP BY t.conv_id, t.turn""",
        "lexicon",
        tokens=f"""SELECT conv_id, turn, unnest(regexp_split_to_array(upper(
  regexp_replace(text, '^{SPACE}+|{SPACE}+$', '', 'g')), '{SPACE}+')) AS word
FROM conversations""",
    ),
    "polarity_scores": sql(
        """SELECT doc_id, line_no, label, round(p, 9) AS polarity, round(s, 9) AS subjectivity, round(abs(p), 9) AS intensity
FROM (SELECT t.doc_id, t.line_no, t.label, COALESCE(AVG(x.polarity), 0) AS p, COALESCE(AVG(x.subjectivity), 0) AS s
  FROM tokens t LEFT JOIN lexicon x ON x.word = t.word GROUP BY t.doc_id, t.line_no, t.label)""",
        "lexicon", "lines", tokens=TOKENS,
    ),
    "polarity_means": sql(
        """SELECT round(AVG(p), 9) AS polarity, round(AVG(s), 9) AS subjectivity
FROM (SELECT COALESCE(AVG(x.polarity), 0) AS p, COALESCE(AVG(x.subjectivity), 0) AS s
  FROM tokens t LEFT JOIN lexicon x ON x.word = t.word GROUP BY t.doc_id, t.line_no)""",
        "lexicon", "lines", tokens=TOKENS,
    ),
    "word_frequency_top": f"""SELECT word, COUNT(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(upper(regexp_replace(text, '^{SPACE}+|{SPACE}+$', '', 'g')), '{SPACE}+')) AS word
  FROM documents WHERE text IS NOT NULL)
WHERE length(word) > 0 GROUP BY word ORDER BY n DESC, word LIMIT 50""",
    "scaled_features": sql(f"SELECT region, acc_id, year, {_scaled(1)}, {_scaled(2)} FROM aufwand", "aufwand"),
    "model_split": sql(
        """SELECT region, acc_id, year, CASE WHEN year = newest THEN 'test' WHEN year = newest - 1 THEN 'validation'
    ELSE 'train' END AS part FROM aufwand, (SELECT MAX(year) AS newest FROM aufwand)""",
        "aufwand",
    ),
    "onehot_vectors": sql(
        """SELECT region, acc_id, year,
    CAST((SELECT COUNT(DISTINCT region) FROM alle_full) AS INT) AS region_hot_size,
    CAST((SELECT COUNT(DISTINCT acc_id) FROM alle_full) AS INT) AS acc_hot_size,
    CAST(dense_rank() OVER (ORDER BY region) AS INT) AS region_hot_place,
    CAST(dense_rank() OVER (ORDER BY acc_id) AS INT) AS acc_hot_place,
    1.0::DOUBLE AS region_hot_sum, 1.0::DOUBLE AS acc_hot_sum FROM alle_full""",
        "alle_full",
    ),
    "mean_of_forecasts": sql(
        f"""SELECT forecast, {_errors('y', 'f')} FROM (
    SELECT 'prediction' AS forecast, realized AS y, (realized_lag1 + realized_lag2) / 2 AS f FROM known
    UNION ALL SELECT 'budget', realized, budget FROM known) GROUP BY forecast""",
        "tested",
        known="SELECT * FROM tested WHERE realized_lag1 IS NOT NULL AND realized_lag2 IS NOT NULL",
    ),
    "best_of_trials": sql(
        """SELECT CASE WHEN trial % 2 = 0 THEN trial / 100 END AS learning_rate, trees FROM (
    SELECT CAST(regexp_extract(region, '\\d+') AS INT) AS trial, CAST(COUNT(*) AS INT) AS trees,
      round(log10(AVG(abs(realized - realized_lag1) * abs(realized - realized_lag1))), 1) AS mse
    FROM tested WHERE realized_lag1 IS NOT NULL GROUP BY region) ORDER BY mse, trial LIMIT 1""",
        "tested",
    ),
    "early_stopping_picks": sql(
        """SELECT region, best, stop, mse FROM stops JOIN kept USING (region) JOIN rounds USING (region)
    WHERE rounds.round = best""",
        "tested",
        rounds="""SELECT region, CAST(row_number() OVER (PARTITION BY region ORDER BY acc_id, year) AS INT) AS round,
    abs(realized - realized_lag1) AS mse FROM tested WHERE realized_lag1 IS NOT NULL""",
        judged="""SELECT *, coalesce(mse < min(mse) OVER (PARTITION BY region ORDER BY round
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS better FROM rounds""",
        latest="""SELECT *, max(CASE WHEN better THEN round END) OVER (PARTITION BY region ORDER BY round) AS last
    FROM judged""",
        stops="""SELECT region, coalesce(min(CASE WHEN NOT better AND round - last >= 3 THEN round END), max(round)) AS stop
    FROM latest GROUP BY region""",
        kept="SELECT region, last AS best FROM latest JOIN stops USING (region) WHERE round = stop",
    ),
    "lag_ties": sql(
        """SELECT *, LAG(realized, 1) OVER w AS realized_lag1, LAG(realized, 2) OVER w AS realized_lag2
    FROM panel_std WINDOW w AS (PARTITION BY region, acc_id ORDER BY year, standard)""",
        "panel_std",
    ),
    "onehot_features": sql(
        """SELECT region, acc_id, year,
  CAST(dense_rank() OVER (ORDER BY region) - 1 AS INT) AS region_index,
  CAST(dense_rank() OVER (ORDER BY acc_id) - 1 AS INT) AS acc_index FROM alle""",
        "panel",
        alle=ENGINEERED.format(source="panel", accounts=_in(CATEGORIES["Alle"])),
    ),
}
