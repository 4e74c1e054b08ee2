"""The jobs end to end: sheets to panel, training, evaluation, ensemble, text scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slackline.fixed_values import N_TRIALS, SEED
from slackline.operators import features, ledger, metrics, models, text
from slackline.session import stored
from slackline.sources import csvs, sheets
from slackline.sources.text import read_lines


def build_panels(
    spark: SparkSession, sheet_dir: str, out_dir: str, mode: str = "prefer", separator: str = ","
) -> None:
    """Sheet exports to the one- and the two-digit panel and a table of rejected sheets.

    Writes ``single_digit``, ``double_digit`` and ``rejects`` below ``out_dir``.
    """
    lines = stored(sheets.read_sheets(spark, sheet_dir, separator=separator))
    located = stored(sheets.located_sheets(lines, separator))
    rows = stored(ledger.clean_rows(sheets.sheet_rows(lines, located, separator)))
    chosen = ledger.prefer_standard(rows, mode)
    for level, name in ((1, "single_digit"), (2, "double_digit")):
        panel = ledger.finalize(ledger.sum_collisions(chosen.where(F.col("level") == level)))
        csvs.write_panel(panel, f"{out_dir}/{name}")
    sheets.rejected(located).write.mode("overwrite").parquet(f"{out_dir}/rejects")


def merge_panels(spark: SparkSession, directory: str, pattern: str, out: str) -> DataFrame:
    """Yearly CSV panels of one name pattern to one final panel; returns the rejects."""
    merged, rejects = csvs.read_union_by_name(spark, directory, pattern)
    csvs.write_panel(ledger.finalize(merged), out)
    return rejects


def _frame(spark: SparkSession, panel_path: str, category: str | None) -> DataFrame:
    return stored(features.engineer(csvs.read_panel(spark, panel_path), category))


def train(
    spark: SparkSession,
    panel_path: str,
    kind: str,
    model_path: str,
    trials_path: str,
    category: str | None = "Alle",
    n_trials: int = N_TRIALS,
    seed: int = SEED,
    parallelism: int = 4,
    on_test_year: bool = False,
) -> dict:
    """Search, refit and save one model; returns the chosen parameters.

    Trials are judged on the year before the newest. ``on_test_year`` judges them on the
    newest year and trains on all years before, as the published figures did.
    """
    frame = _frame(spark, panel_path, category)
    if on_test_year:
        known, judged = features.holdout(frame)
    else:
        known, judged, _ = models.validation_split(frame)
    table = models.search(
        known, judged, kind, models.draw_trials(kind, n_trials, seed), seed=seed,
        parallelism=parallelism,
    )
    csvs.write_trials(table, trials_path)
    best = models.best_trial(csvs.read_trials(spark, trials_path))
    rows = known if on_test_year else known.unionByName(judged)
    models.save_model(models.fit_boosted(rows, kind, best, seed), model_path)
    return best


def evaluate_model(
    spark: SparkSession,
    panel_path: str,
    model_path: str,
    kind: str,
    out_dir: str,
    category: str | None = "Alle",
    acc_id: int | None = None,
    region: str | None = None,
    cutoff: str = "global",
    rounded: bool = False,
) -> DataFrame:
    """Score the newest year, store predictions and errors, return the errors."""
    frame = _frame(spark, panel_path, category)
    _, test = features.holdout(frame, acc_id=acc_id, region=region, cutoff=cutoff)
    scored = stored(models.score(models.load_model(model_path), test))
    errors = stored(metrics.compare(scored, "realized", ["prediction", "budget"], rounded=rounded))
    csvs.write_predictions(scored, f"{out_dir}/predictions", kind, category, acc_id, region)
    csvs.write_metrics(
        metrics.metrics_long(errors, ["forecast"]), f"{out_dir}/metrics", kind, category, acc_id, region
    )
    return errors


def evaluate_all_slices(
    spark: SparkSession, panel_path: str, model_path: str, category: str | None = "Alle",
    out_dir: str | None = None, kind: str = "model",
) -> DataFrame:
    """Errors for all rows, every account, every region and every pair from one scoring.

    With ``out_dir`` they are also written, as (forecast, region, acc_id, metric, value).
    """
    frame = _frame(spark, panel_path, category)
    _, test = features.holdout(frame)
    scored = models.score(models.load_model(model_path), test)
    errors = metrics.compare_slices(scored, "realized", ["prediction", "budget"])
    if out_dir is None:
        return errors
    errors = stored(errors)
    table = metrics.metrics_long(errors, ["forecast", "region", "acc_id"])
    csvs.write_metrics(table, f"{out_dir}/slice_metrics", kind, category)
    return errors


def evaluate_ensemble(
    spark: SparkSession, panel_path: str, model_paths: list[str], category: str | None = "Alle",
    out_dir: str | None = None,
) -> DataFrame:
    """Errors of the mean of several models next to the official budget.

    With ``out_dir`` predictions and errors are also written, as for a single model.
    """
    frame = _frame(spark, panel_path, category)
    _, test = features.holdout(frame)
    scored = models.score_ensemble([models.load_model(p) for p in model_paths], test)
    both = scored.select("region", "acc_id", "year", "prediction", "realized", "budget")
    if out_dir is None:
        return metrics.compare(both, "realized", ["prediction", "budget"])
    both = stored(both)
    errors = stored(metrics.compare(both, "realized", ["prediction", "budget"]))
    csvs.write_predictions(both, f"{out_dir}/predictions", "ensemble", category)
    csvs.write_metrics(metrics.metrics_long(errors, ["forecast"]), f"{out_dir}/metrics", "ensemble", category)
    return errors


def score_answers(
    spark: SparkSession, path: str, header: str, lexicon: DataFrame, out: str, polar: bool = False
) -> None:
    """Lexicon counts, or polarity, of every line of a text file, written as CSV."""
    lines = read_lines(spark, path, header).withColumn("line", F.monotonically_increasing_id())
    score = text.polarity if polar else text.lexicon_counts
    scored = score(lines, ["path", "line"], "text", lexicon)
    in_order = scored.orderBy("path", "line").drop("path", "line")
    csvs.write_result(in_order.withColumnRenamed("label", "Text"), out)
