"""Every operator as a query on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slackline.fixed_values import (
    AGE_LABELS,
    ARM_AI,
    ARM_NO_AI,
    EXPERIENCE_LABELS,
    PERSONNEL_ACCOUNT,
    SENTIMENTS,
)
from slackline.functions.numbers import to_number
from slackline.operators import boosting, explore, features, ledger, metrics, models, stats, text
from slackline.operators import survey as sv
from slackline.plans import fixtures as fx
from slackline.schema import category_dim
from slackline.session import stored
from slackline.sources import csvs, sheets

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

ARMS = ["AI", "NonAI"]
CODES = {ARM_AI: "AI", ARM_NO_AI: "NonAI"}
DIGITS = 6


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_errors(df: DataFrame) -> DataFrame:
    """Errors to the digits that do not depend on the order of summation."""
    digits = {"mae": 6, "mse": -2, "rmse": 6, "mape": 6, "mape_nonzero": 6}
    table = df.withColumns({c: F.round(c, d) for c, d in digits.items() if c in df.columns})
    if "mape" not in table.columns:
        return table
    # A zero actual makes the relative error astronomically large.
    return table.withColumn("mape", F.when(F.col("mape") > 1e9, F.round("mape", -10)).otherwise(F.col("mape")))


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """The panel, stored: it is far smaller than its source and read several times."""
    return stored(fx.panel(spark, sf))


def full_panel(df: DataFrame) -> DataFrame:
    """With slack and the next year's budget, zero where there is none."""
    series = Window.partitionBy("region", "acc_id").orderBy("year")
    following = F.coalesce(F.lead("budget").over(series), F.lit(0.0))
    return ledger.with_slack(df.withColumn("budget_next", following))


# --- panel ------------------------------------------------------------------------------


@query
def panel_build(spark, sf):
    return fx.panel(spark, sf)


@query
def final_panel(spark, sf):
    named = full_panel(panel(spark, sf)).withColumns(
        {"ref_id": F.lit(None).cast("string"), "name": F.lit(None).cast("string")}
    )
    return ledger.finalize(named)


@query
def lag_features(spark, sf):
    return features.add_lags(features.rebase_year(panel(spark, sf)))


@query
def lag_features_by_year(spark, sf):
    return features.add_lags(panel(spark, sf), by="year")


@query
def lag_entries(spark, sf):
    """Lags over single entries, whose series are as long as the table makes them."""
    entries = fx.ledger_lines(spark, sf, "l_orderkey", "l_linenumber").select(
        "region", "acc_id", "year", "l_orderkey", "l_linenumber",
        (F.col("realized_cents") / 100).alias("realized"),
    )
    ties = ("l_orderkey", "l_linenumber", "realized")
    return features.add_lags_in_chunks(stored(entries), tie_break=ties)


@query
def zero_row_drop(spark, sf):
    return features.drop_zero_rows(panel(spark, sf))


@query
def category_accounts(spark, sf):
    accounts = category_dim(spark)
    return panel(spark, sf).join(F.broadcast(accounts), "acc_id").select(
        "category", "region", "acc_id", "year", "budget", "realized"
    )


@query
def engineered_frame(spark, sf):
    return features.engineer(full_panel(panel(spark, sf)), "Aufwand")


@query
def temporal_holdout(spark, sf):
    frame = features.engineer(full_panel(panel(spark, sf)), "Alle")
    return features.feature_columns(features.mark_holdout(frame))


def tested_rows(spark, sf, category="Aufwand") -> DataFrame:
    frame = features.engineer(panel(spark, sf), category)
    return features.holdout(frame)[1].withColumnRenamed("realized_lag1", "lag1")


@query
def budget_eval(spark, sf):
    scores = metrics.compare(tested_rows(spark, sf), "realized", ["budget", "lag1"])
    return rounded_errors(scores)


@query
def budget_eval_rounded(spark, sf):
    rows = tested_rows(spark, sf)
    return metrics.evaluate(rows, "realized", "budget", rounded=True)


@query
def eval_by_slice(spark, sf):
    scores = metrics.compare_slices(tested_rows(spark, sf), "realized", ["budget", "lag1"])
    return rounded_errors(scores)


@query
def eval_by_region_own_year(spark, sf):
    """Each region scored on its own newest year."""
    frame = features.engineer(panel(spark, sf), "Aufwand")
    newest = frame.groupBy("region").agg(F.max("year").alias("year"))
    rows = frame.join(newest, ["region", "year"], "left_semi")
    scores = metrics.evaluate(rows, "realized", "budget", by=("region",))
    return rounded_errors(scores)


@query
def metrics_table(spark, sf):
    scores = metrics.compare(tested_rows(spark, sf), "realized", ["budget", "lag1"])
    return metrics.metrics_long(rounded_errors(scores), ["forecast"])


# --- ledger -----------------------------------------------------------------------------


@query
def crosswalk_split(spark, sf):
    return ledger.apply_crosswalk(fx.panel_legacy(spark, sf))


@query
def crosswalk_sums(spark, sf):
    return ledger.apply_crosswalk(fx.panel_legacy(spark, sf), aggregate=True)


@query
def populated_standards(spark, sf):
    rows = fx.panel_by_standard(spark, sf).withColumn("acc_id", F.col("acc_id").cast("string"))
    return ledger.populated(rows, ["year", "region", "standard"])


@query
def standard_preference(spark, sf):
    rows = stored(fx.panel_by_standard(spark, sf)).withColumn(
        "acc_id", F.col("acc_id").cast("string")
    )
    return ledger.prefer_standard(rows)


@query
def numeric_clean_slack(spark, sf):
    kept = ledger.keep_numeric_accounts(fx.raw_cells(spark, sf), drop_zero=True)
    cleaned = ledger.with_slack(ledger.numbers_or_null(kept))
    return ledger.with_level(ledger.zeros_for_null(cleaned))


def mapped_sheets(lines: DataFrame) -> DataFrame:
    lines = stored(lines)
    rows = ledger.clean_rows(sheets.sheet_rows(lines, sheets.located_sheets(lines)))
    return rounded(
        rows.select(
            "standard", "region", "year", "ref_id", "acc_id", "name",
            "budget", "realized", "budget_next", "slack", "level",
        ),
        "budget", "realized", "budget_next", "slack",
    )


@query
def sheet_header_map(spark, sf):
    return mapped_sheets(fx.sheet_lines(spark, sf))


@query
def sheets_from_files(spark, sf):
    """The same sheets, written as files and read back."""
    files = sheets.read_sheets(spark, fx.sheet_files(spark, sf), "*.txt", name=r"/sheet=([^/]+)/")
    return mapped_sheets(files)


@query
def csv_rows_from_files(spark, sf):
    """The good rows of written CSV files of two layouts, some rows malformed."""
    panel_rows, _ = csvs.read_union_by_name(spark, fx.panel_files(spark, sf), "*.txt")
    return panel_rows.select("acc_id", "name", "year", "region", "budget", "realized", "budget_next")


@query
def csv_rejects_from_files(spark, sf):
    """The malformed rows of the same files, counted by year of the path and reason."""
    _, rejects = csvs.read_union_by_name(spark, fx.panel_files(spark, sf), "*.txt")
    year = F.regexp_extract("path", r"year=(\d+)", 1).cast("int").alias("year")
    return rejects.groupBy(year, "reason").agg(F.count("*").alias("n"))


@query
def union_by_name(spark, sf):
    rows = full_panel(panel(spark, sf)).withColumn("name", F.lit(None).cast("string"))
    newer = rows.where("year >= 1999").withColumn(
        "ref_id", F.concat(F.lit("HRM2_"), F.col("acc_id").cast("string"))
    )
    older = rows.where("year < 1999").select(*reversed(rows.columns))
    merged = ledger.fill_defaults(ledger.union_by_name([newer, older]))
    return merged.select("ref_id", "name", "year", "region", "acc_id", "realized", "budget",
                         "budget_next", "slack")


# --- exploration ------------------------------------------------------------------------


@query
def slack_by_region_year(spark, sf):
    return explore.sum_by(ledger.with_slack(fx.panel(spark, sf)), ["year", "region"], ["slack"])


@query
def sums_by_key(spark, sf):
    return explore.sum_by(fx.panel_by_standard(spark, sf), ["year", "region", "acc_id"],
                          ["realized", "budget"])


@query
def personnel_by_year(spark, sf):
    rows = fx.panel(spark, sf).where(F.col("acc_id") == PERSONNEL_ACCOUNT)
    return explore.sum_by(rows, ["year"], ["realized", "budget"])


@query
def personnel_by_region_year(spark, sf):
    rows = fx.panel(spark, sf).where(F.col("acc_id") == PERSONNEL_ACCOUNT)
    return explore.sum_by(rows, ["region", "year"], ["realized", "budget"])


def clipped(spark, sf) -> DataFrame:
    frame = features.engineer(panel(spark, sf), "Ertrag")
    return explore.clip_quantiles(explore.pct_difference(frame), "pct_diff")


@query
def pct_diff_clip(spark, sf):
    return clipped(spark, sf)


@query
def pct_diff_means(spark, sf):
    return rounded(explore.mean_by_year_and_region(clipped(spark, sf), "pct_diff"), "mean")


@query
def pct_diff_top10(spark, sf):
    return explore.top_k(clipped(spark, sf), "pct_diff", 10, ["region", "acc_id", "year"])


@query
def panel_tail(spark, sf):
    return explore.tail(panel(spark, sf), 5, ["year", "region", "acc_id"])


@query
def describe_amounts(spark, sf):
    table = explore.describe(ledger.with_slack(panel(spark, sf)), ["budget", "realized", "slack"])
    return rounded(table, "mean", "std", "q25", "q50", "q75", digits=4)


@query
def describe_by_region_year(spark, sf):
    """Moments and quartiles of the panel's amounts for each region and year."""
    rows = ledger.with_slack(panel(spark, sf))
    table = explore.describe(rows, ["budget", "realized", "slack"], by=("region", "year"))
    # Means of cents over few rows would often lie halfway between two shorter numbers.
    return rounded(rounded(table, "mean", digits=8), "std", "q25", "q50", "q75", digits=4)


@query
def describe_lines_by_flag(spark, sf):
    """Moments and quartiles of raw line amounts for each of a few large groups."""
    lines = fx.table(spark, sf, "lineitem")
    table = explore.describe(lines, ["l_extendedprice", "l_quantity"], by=("l_returnflag",))
    return rounded(table, "mean", "std", "q25", "q50", "q75", digits=4)


@query
def describe_line_amounts(spark, sf):
    lines = fx.table(spark, sf, "lineitem")
    table = explore.describe(lines, ["l_extendedprice", "l_quantity", "l_discount"])
    return rounded(table, "mean", "std", "q25", "q50", "q75", digits=4)


@query
def duplicate_rows(spark, sf):
    events = fx.table(spark, sf, "events")
    return explore.duplicates(
        events.select("user_id", "event_type", F.to_date("ts").alias("day"))
    )


@query
def duplicate_rows_expanded(spark, sf):
    events = fx.table(spark, sf, "events")
    return explore.duplicates(
        events.select("user_id", "event_type", F.to_date("ts").alias("day")), expand=True
    )


@query
def seeded_sample(spark, sf):
    return explore.seeded_sample(panel(spark, sf), ["region", "acc_id", "year"], 10)


@query
def distinct_regions(spark, sf):
    return explore.distinct_values(fx.panel(spark, sf), ["region"])


# --- survey -----------------------------------------------------------------------------


def answered(spark, sf) -> DataFrame:
    """Completed and checked answers as numbers, with the arm's name."""
    raw = sv.completed(fx.survey_answers(spark, sf)).where(sv.passed_check("FL_23_DO", "Manip_Check"))
    answers = {
        "initial": "Scenario1_Answer_1", "ai": "AI_Resubmission13_1", "no_ai": "NoAI_Resubmission13_1"
    }
    numbers = raw.select(
        F.col("PROLIFIC_PID").cast("long").alias("pid"),
        F.when(F.col("FL_23_DO") == ARM_AI, CODES[ARM_AI]).otherwise(CODES[ARM_NO_AI]).alias("arm"),
        *[to_number(c).alias(n) for n, c in answers.items()],
    )
    return numbers.select(
        "pid",
        "arm",
        "initial",
        F.coalesce("ai", "no_ai").alias("again"),
        sv.final_answer(["ai", "no_ai"], "initial").alias("final"),
    )


def reduced(spark, sf, relative=False) -> DataFrame:
    """Slack reduction of the completed answers that passed the check."""
    rows = answered(spark, sf).drop("again")
    return sv.slack_reduction(rows, "initial", "final", relative=relative)


@query
def survey_funnel(spark, sf):
    return rounded(sv.funnel(fx.survey_answers(spark, sf)), "pct_change")


@query
def final_answer(spark, sf):
    return answered(spark, sf)


@query
def any_answer(spark, sf):
    columns = ["Scenario1_Answer_1", "AI_Resubmission13_1", "NoAI_Resubmission13_1"]
    return sv.with_any_text(fx.survey_answers(spark, sf), columns).select("PROLIFIC_PID", *columns)


@query
def arm_counts(spark, sf):
    return sv.arm_counts(answered(spark, sf), "arm", ARMS)


@query
def arm_distribution(spark, sf):
    rows = stored(answered(spark, sf).select("arm", "initial", "final"))
    table = sv.arm_distribution(rows, "arm", ARMS, {"initial": "initial", "final": "final"})
    return rounded(table, "mean", "std", "median", digits=4)


@query
def resubmission_rate(spark, sf):
    return sv.resubmissions(answered(spark, sf), "arm", ARMS, "initial", "again")


@query
def reduction_pivot(spark, sf):
    table = sv.resubmissions(answered(spark, sf), "arm", ARMS, "initial", "again")
    return sv.reduction_pivot(table, "arm", ARMS, "Scenario1_Answer_1")


@query
def slack_reduction(spark, sf):
    return reduced(spark, sf).select("pid", "arm", "slack", "reduction", "negative")


@query
def relative_slack_reduction(spark, sf):
    return reduced(spark, sf, relative=True).select("pid", "arm", "reduction", "relative_reduction")


def people(spark, sf) -> DataFrame:
    return sv.participants_only(fx.demographics(spark, sf), answered(spark, sf))


@query
def demographic_shares(spark, sf):
    return rounded(sv.sex_shares(people(spark, sf)), "pct")


@query
def nationality_shares(spark, sf):
    return rounded(explore.value_shares(people(spark, sf), "nationality"), "share")


@query
def age_groups(spark, sf):
    table = sv.shares_on_labels(people(spark, sf), sv.age_group(), AGE_LABELS)
    return rounded(table, "pct")


@query
def experience_groups(spark, sf):
    table = sv.shares_on_labels(people(spark, sf), sv.experience_class(), EXPERIENCE_LABELS)
    return rounded(table, "pct")


@query
def duration_stats(spark, sf):
    events = fx.table(spark, sf, "events")
    table = explore.describe_series(
        events, {"seconds": F.col("value"), "minutes": F.col("value") / 60}
    )
    return rounded(table, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def sex_contingency(spark, sf):
    rows = sv.attach_demographics(answered(spark, sf), fx.demographics(spark, sf), ["age", "sex"])
    return sv.contingency(rows, "sex", "arm", ["Male", "Female"], ARMS)


@query
def arm_moments(spark, sf):
    return rounded(stats.arm_moments(reduced(spark, sf), "arm", "reduction"),
                   "mean", "variance", "std", digits=2)


def tested(df: DataFrame) -> DataFrame:
    names = ["mean1", "var1", "mean2", "var2", "t", "dof", "p"]
    return rounded(df, *names, digits=4)


@query
def welch_reduction(spark, sf):
    return tested(stats.welch(reduced(spark, sf), "arm", "reduction", *ARMS))


@query
def welch_relative(spark, sf):
    rows = reduced(spark, sf, relative=True)
    return tested(stats.welch(rows, "arm", "relative_reduction", *ARMS))


@query
def welch_age(spark, sf):
    rows = sv.attach_demographics(answered(spark, sf), fx.demographics(spark, sf), ["age"])
    return tested(stats.welch(rows, "arm", "age", *ARMS))


@query
def welch_experience(spark, sf):
    rows = sv.attach_demographics(answered(spark, sf), fx.demographics(spark, sf), ["experience"])
    return tested(stats.welch(rows, "arm", "experience", *ARMS))


@query
def welch_by_region(spark, sf):
    """In each region, whether realized amounts differ between the accounting standards."""
    rows = fx.panel_by_standard(spark, sf).withColumn("thousands", F.col("realized") / 1000)
    return tested(stats.welch(rows, "standard", "thousands", "HRM2", "HRM1", by=("region",)))


def association(df: DataFrame) -> DataFrame:
    table = rounded(df, "chi2", "chi2_yates", "cramers_v", "phi", "p", "p_yates")
    cells = [F.round(F.get("expected", F.lit(i)), 4).alias(f"expected_{i}") for i in range(4)]
    return table.select("n", "dof", "chi2", "chi2_yates", "cramers_v", "phi", "p", "p_yates", *cells)


@query
def chi_square_resubmission(spark, sf):
    again = F.col("again").isNotNull() & F.col("initial").isNotNull()
    cells = [
        [F.count_if((F.col("arm") == a) & hit) for hit in (~again, again)] for a in ARMS
    ]
    return association(stats.chi_square(answered(spark, sf), cells))


@query
def chi_square_resubmission_by_size(spark, sf):
    """The published table: arm size next to resubmissions."""
    again = F.col("again").isNotNull() & F.col("initial").isNotNull()
    cells = [
        [F.count_if(F.col("arm") == a), F.count_if((F.col("arm") == a) & again)] for a in ARMS
    ]
    return association(stats.chi_square(answered(spark, sf), cells))


@query
def chi_square_sex(spark, sf):
    rows = sv.attach_demographics(answered(spark, sf), fx.demographics(spark, sf), ["sex"])
    cells = stats.count_cells("sex", "arm", ["Male", "Female"], ARMS)
    return association(stats.chi_square(rows, cells))


@query
def chi_square_by_supplier(spark, sf):
    """For each supplier, whether large lines are returned more often: a test per group."""
    returned, large = F.col("l_returnflag") == "R", F.col("l_quantity") > 25
    cells = [[F.count_if(r & hit) for hit in (~large, large)] for r in (~returned, returned)]
    table = stats.chi_square(fx.table(spark, sf, "lineitem"), cells, by=("l_suppkey",))
    kept = rounded(table, "chi2", "chi2_yates", "cramers_v", "p", "p_yates")
    return kept.select("l_suppkey", "n", "dof", "chi2", "chi2_yates", "cramers_v", "p", "p_yates")


@query
def moments_reduction(spark, sf):
    return rounded(stats.moments(reduced(spark, sf), "negative", by=("arm",)),
                   "mean", "std", "skewness", "kurtosis", digits=4)


@query
def normal_curve(spark, sf):
    rows = stored(reduced(spark, sf).where(F.col("arm") == "AI").select("negative"))
    curve = stats.normal_curve(rows, "negative")
    return rounded(rounded(curve, "x", digits=4), "density", digits=12)


@query
def histogram_10(spark, sf):
    years = stored(people(spark, sf).select("experience"))
    return rounded(explore.histogram(years, "experience", 10), "low", "high")


@query
def histogram_density_30(spark, sf):
    rows = stored(reduced(spark, sf).where(F.col("arm") == "AI").select("negative"))
    table = explore.histogram(rows, "negative", 30, density=True)
    return rounded(rounded(table, "low", "high", digits=4), "density", digits=12)


# --- text -------------------------------------------------------------------------------


@query
def lexicon_counts(spark, sf):
    return text.lexicon_counts(
        fx.text_lines(spark, sf), ["doc_id", "line_no"], "text", fx.word_flags(spark)
    )


@query
def lexicon_totals(spark, sf):
    return text.lexicon_totals(lexicon_counts(spark, sf), SENTIMENTS[:3])


@query
def answer_lexicon_counts(spark, sf):
    answers = fx.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return text.lexicon_counts(answers, ["conv_id", "turn"], "text", fx.word_flags(spark)).drop("label")


@query
def polarity_scores(spark, sf):
    scores = text.polarity(
        fx.text_lines(spark, sf), ["doc_id", "line_no"], "text", fx.word_polarity(spark)
    )
    return rounded(scores, "polarity", "subjectivity", "intensity", digits=9)


@query
def polarity_means(spark, sf):
    scores = text.polarity(
        fx.text_lines(spark, sf), ["doc_id", "line_no"], "text", fx.word_polarity(spark)
    )
    return rounded(text.polarity_means(scores), "polarity", "subjectivity", digits=9)


@query
def word_frequency_top(spark, sf):
    return text.word_frequency(fx.documents(spark, sf), "text", 50)


# --- models -----------------------------------------------------------------------------


@query
def scaled_features(spark, sf):
    frame = stored(features.mark_holdout(features.engineer(panel(spark, sf), "Aufwand")))
    scaled = models.scale_lags(frame, frame.where("split = 'train'"))
    return rounded(
        scaled.select("region", "acc_id", "year", "realized_lag1_scaled", "realized_lag2_scaled"),
        "realized_lag1_scaled", "realized_lag2_scaled",
    )


@query
def onehot_features(spark, sf):
    frame = models.model_frame(features.engineer(panel(spark, sf), "Alle"))
    indexed = models.level_indexer().fit(frame).transform(frame)
    return indexed.select(
        "region", "acc_id", "year",
        F.col("region_index").cast("int").alias("region_index"),
        F.col("acc_index").cast("int").alias("acc_index"),
    )


# The queries fit the largest model of the search space and stop it early, after fewer rounds
# without a lower error than jobs.train waits for. Nothing else differs.
FORECAST_PARAMS = {"trees": 1000, "max_depth": 4, "learning_rate": 0.3}
PATIENCE = 3
# How many parameter sets the query draws.
SEARCH_TRIALS = 9


@query
def model_split(spark, sf):
    """Which rows train, validate and test a model."""
    frame = stored(features.engineer(panel(spark, sf), "Aufwand"))
    parts = zip(("train", "validation", "test"), models.validation_split(frame), strict=True)
    named = [rows.select("region", "acc_id", "year", F.lit(name).alias("part")) for name, rows in parts]
    return ledger.union_by_name(named)


@query
def onehot_vectors(spark, sf):
    """The set positions of the one-hot vectors of region and account."""
    frame = models.model_frame(features.engineer(panel(spark, sf), "Alle"))
    indexed = models.level_indexer().fit(frame).transform(frame)
    hot = models.one_hot().fit(indexed).transform(indexed)
    dense = {c: vector_to_array(F.col(c)) for c in ("region_hot", "acc_hot")}
    place = lambda v: F.array_position(v, F.lit(1.0)).cast("int")
    return hot.select(
        "region", "acc_id", "year",
        *[F.size(v).alias(f"{c}_size") for c, v in dense.items()],
        *[place(v).alias(f"{c}_place") for c, v in dense.items()],
        *[F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias(f"{c}_sum") for c, v in dense.items()],
    )


@query
def mean_of_forecasts(spark, sf):
    """Errors of the mean of two given forecasts next to the official budget."""
    rows = tested_rows(spark, sf).where("lag1 IS NOT NULL AND realized_lag2 IS NOT NULL")
    given = [rows.withColumn("prediction", F.col(c)) for c in ("lag1", "realized_lag2")]
    mean = metrics.ensemble_mean(given)
    both = mean.join(rows.select("region", "acc_id", "year", "realized", "budget"), ["region", "acc_id", "year"])
    return rounded_errors(metrics.compare(both, "realized", ["prediction", "budget"]))


@query
def best_of_trials(spark, sf):
    """The best of a table of trials: per region a trial, its error that of last year's value.

    Errors are rounded until some are equal, and every other trial lacks a parameter.
    """
    rows = tested_rows(spark, sf).where("lag1 IS NOT NULL")
    number = F.regexp_extract("region", r"\d+", 0).cast("int")
    trials = metrics.evaluate(rows, "realized", "lag1", by=("region",)).select(
        number.alias("trial"), F.when(number % 2 == 0, number / 100).alias("learning_rate"),
        F.col("n").cast("int").alias("rounds"), F.round(F.log10("mse"), 1).alias("mse"),
    )
    best = models.best_trial(trials)
    return spark.createDataFrame([(best.get("learning_rate"), best["trees"])], "learning_rate double, trees int")


@query
def early_stopping_picks(spark, sf):
    """Where early stopping ends a sequence of errors: per region those of last year's value."""
    rows = tested_rows(spark, sf).where("lag1 IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("region").orderBy("acc_id", "year"))
    rounds = rows.select("region", place.alias("round"), F.abs(F.col("realized") - F.col("lag1")).alias("mse"))
    return boosting.early_stops(rounds, PATIENCE, "region")


@query
def early_stopped_rounds(spark, sf):
    """The validation error after every round that is fitted, and the round that is kept."""
    train, validation, _ = split_panel(spark, sf)
    grown = models.fit_early_stopped(train, validation, "xgboost", FORECAST_PARAMS, patience=PATIENCE)
    rows = [(i + 1, error, i + 1 == grown.best) for i, error in enumerate(grown.errors)]
    return spark.createDataFrame(rows, "round int, mse double, kept boolean")


@query
def lag_ties(spark, sf):
    """Lags of rows that share region, account and year: the order of ties is fixed."""
    rows = fx.panel_by_standard(spark, sf)
    return features.add_lags(rows, tie_break=("standard",))


def split_panel(spark, sf, category="Aufwand"):
    frame = stored(features.engineer(panel(spark, sf), category))
    return models.validation_split(frame)


def stopped_forecast(train, validation, kind):
    """The model of the rounds that early stopping picks, fitted to all years before the newest."""
    rounds = models.fit_early_stopped(train, validation, kind, FORECAST_PARAMS, patience=PATIENCE).best
    return models.fit_boosted(train.unionByName(validation), kind, FORECAST_PARAMS | {"trees": rounds})


@query
def gbt_forecast(spark, sf):
    train, validation, test = split_panel(spark, sf)
    scored = models.score(stopped_forecast(train, validation, "xgboost"), test)
    return metrics.compare(scored, "realized", ["prediction", "budget"])


@query
def random_search(spark, sf):
    train, validation, _ = split_panel(spark, sf)
    drawn = models.draw_trials("xgboost", SEARCH_TRIALS)
    return models.search(train, validation, "xgboost", drawn, parallelism=8, patience=PATIENCE, first=2)


@query
def ensemble_mean(spark, sf):
    train, validation, test = split_panel(spark, sf)
    fitted = [stopped_forecast(train, validation, kind) for kind in ("xgboost", "hgb")]
    return metrics.compare(models.score_ensemble(fitted, test), "realized", ["prediction", "budget"])


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return budget_eval(spark, sf)

