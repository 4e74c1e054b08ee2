import json
import math

import pytest
from pyspark.sql import functions as F

from slackline.fixed_values import SEARCH_SPACES
from slackline.operators import boosting, features, metrics, models
from slackline.plans import jobs
from slackline.session import stored
from slackline.sources import csvs
from tests.conftest import values

PARAMS = {"trees": 5, "max_depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def panel(spark):
    # Eight years of twelve series that grow at their own pace.
    rows = [
        (r, a, 2010 + y, 100.0 * i * a + 5.0 * y * a, 100.0 * i * a + 5.0 * y * a + 3.0)
        for i, r in enumerate(["AG", "BE", "ZH"], 1)
        for a in (30, 31, 40, 41)
        for y in range(8)
    ]
    df = spark.createDataFrame(rows, "region string, acc_id int, year int, realized double, budget double")
    return stored(df)


@pytest.fixture(scope="module")
def frame(panel):
    return stored(features.engineer(panel, "Alle"))


def test_split_by_year(frame):
    train, validation, test = models.validation_split(frame)
    assert {r[0] for r in validation.select("year").collect()} == {6}
    assert {r[0] for r in test.select("year").collect()} == {7}
    assert train.count() + validation.count() + test.count() == frame.count()


@pytest.mark.parametrize("kind", models.KINDS)
def test_fit_is_deterministic_and_beats_the_mean(frame, kind):
    train, _, test = models.validation_split(frame)
    one = models.score(models.fit_gbt(train, kind, PARAMS), train)
    two = models.score(models.fit_gbt(train, kind, PARAMS), train)
    assert values(one, "region", "acc_id", "year", "prediction") == values(
        two, "region", "acc_id", "year", "prediction"
    )
    error = metrics.evaluate(one, "realized", "prediction").first()["mse"]
    assert error < train.agg(F.var_pop("realized")).first()[0]
    scored = models.score(models.fit_gbt(train, kind, PARAMS), test)
    assert all(math.isfinite(r["prediction"]) for r in scored.collect())


def test_round_errors_are_the_errors_of_shorter_fits(frame):
    train, validation, _ = models.validation_split(frame)
    long = models.fit_gbt(train, "xgboost", PARAMS)
    errors = models.round_errors(long, validation)
    assert len(errors) == PARAMS["trees"]
    short = models.score(models.fit_gbt(train, "xgboost", PARAMS | {"trees": 2}), validation)
    assert metrics.evaluate(short, "realized", "prediction").first()["mse"] == pytest.approx(errors[1])


def test_early_stops_wait_for_their_patience(spark):
    errors = {1: [5.0, 4.0, 4.5, 4.2, 3.0, 3.5], 2: [1.0], 3: [2.0, 2.0, 2.0, 1.0]}
    rows = [(t, i + 1, e) for t, es in errors.items() for i, e in enumerate(es)]
    df = spark.createDataFrame(rows, "trial int, round int, mse double")
    assert values(boosting.early_stops(df, 3)) == [(1, 5, 6, 3.0), (2, 1, 1, 1.0), (3, 4, 4, 1.0)]
    assert values(boosting.early_stops(df, 2)) == [(1, 2, 4, 4.0), (2, 1, 1, 1.0), (3, 1, 3, 2.0)]
    assert boosting.early_stops(df.limit(0), 2).collect() == []


def validation_error(model, df):
    return metrics.evaluate(models.score(model, df), "realized", "prediction").first()["mse"]


def test_early_stopping_fits_no_round_beyond_its_patience(spark, frame):
    train, validation, _ = models.validation_split(frame)
    params = {"trees": 400, "max_depth": 3, "learning_rate": 0.9}
    grown = models.fit_early_stopped(train, validation, "xgboost", params, patience=3)
    assert grown.rounds == grown.best + 3 < 400
    assert len(grown.errors) == grown.rounds
    assert grown.error == min(grown.errors) == grown.errors[grown.best - 1]
    # The model that is kept has the error that was recorded, for every number of rounds.
    assert grown.model().stages[-1].getNumTrees == grown.best + 1
    for rounds in (1, grown.best, grown.rounds):
        assert validation_error(grown.model(rounds), validation) == pytest.approx(grown.errors[rounds - 1])
    table = spark.createDataFrame([(1, i + 1, e) for i, e in enumerate(grown.errors)], "trial int, round int, mse double")
    assert values(boosting.early_stops(table, 3)) == [(1, grown.best, grown.rounds, grown.error)]
    patient = models.fit_early_stopped(train, validation, "xgboost", params | {"trees": 5}, patience=100)
    assert patient.rounds == 5 and patient.errors == pytest.approx(grown.errors[:5])


def test_growing_on_is_growing_at_once(frame, monkeypatch):
    train, validation, _ = models.validation_split(frame)
    params = {"trees": 7, "max_depth": 3, "learning_rate": 0.4, "subsample": 0.8}
    once = models.fit_early_stopped(train, validation, "hgb", params)
    monkeypatch.setattr(boosting, "BLOCK", 2)
    prepared, rows, bins = models._growing(train, validation, "hgb")
    steps = boosting.Boosted(prepared, rows, params, bins)
    for until in (1, 4, 5, 7):
        assert steps.grow(until).rounds == until
    assert steps.grow().ended
    assert steps.errors == pytest.approx(once.errors)
    assert boosting.Boosted(prepared, rows, params, bins).grow().errors == pytest.approx(once.errors)


def test_stopped_model_is_saved_and_loaded(frame, tmp_path):
    train, validation, _ = models.validation_split(frame)
    grown = models.fit_early_stopped(train, validation, "hgb", PARAMS, patience=2)
    models.save_model(grown.model(), str(tmp_path / "model"))
    assert validation_error(models.load_model(str(tmp_path / "model")), validation) == pytest.approx(grown.error)


def test_no_validation_rows_grow_all_rounds(frame):
    train, validation, _ = models.validation_split(frame)
    assert models.fit_boosted(train, "xgboost", PARAMS).stages[-1].getNumTrees == 6
    empty = models.fit_early_stopped(train, validation.limit(0), "xgboost", PARAMS, patience=1)
    assert empty.rounds == empty.best == 5 and empty.errors == []
    with pytest.raises(ValueError, match="patience"):
        models.fit_early_stopped(train, validation, "xgboost", PARAMS, patience=0)


def test_halving_goes_on_with_the_best_sets(frame):
    train, validation, _ = models.validation_split(frame)
    drawn = models.draw_trials("hgb", 7, seed=4)
    trials = [t | {"learning_rate": 0.6 + i / 20, "min_leaf": 1 + i} for i, t in enumerate(drawn)]
    run = lambda: models.search(train, validation, "hgb", trials, parallelism=4, patience=2, first=1, factor=2)
    rows = sorted(run().collect(), key=lambda r: r["trial"])
    for given, row in zip(trials, rows, strict=True):
        assert {k: row[k] for k in given} == pytest.approx(given)
    # 7 sets start, then 4, 2 and 1; each rung has twice the rounds, the last one runs to its end.
    assert sorted(r["rung"] for r in rows) == [0, 0, 0, 1, 1, 2, 3]
    assert all(r["fitted"] <= 2 ** r["rung"] for r in rows if r["rung"] < 3)
    last = next(r for r in rows if r["rung"] == 3)
    assert last["fitted"] == min(last["rounds"] + 2, last["trees"])
    assert values(run()) == [tuple(r) for r in rows]


def test_unknown_level(frame):
    train = frame.where("region <> 'ZH'")
    strict = models.fit_gbt(train, "hgb", PARAMS)
    with pytest.raises(Exception, match="Unseen label"):
        models.score(strict, frame).collect()
    lenient = models.fit_gbt(train, "xgboost", PARAMS)
    assert models.score(lenient, frame).count() == frame.count()
    with pytest.raises(ValueError, match="unknown model kind"):
        models.feature_stages("forest")


def test_levels_sort_like_the_accounts(spark):
    rows = spark.createDataFrame([("B", 9), ("A", 10), ("A", 100)], "region string, acc_id int")
    rows = rows.withColumns({c: F.lit(None).cast("double") for c in models.LAGS})
    prepared = models.model_frame(rows)
    out = models.level_indexer().fit(prepared).transform(prepared)
    assert values(out, "acc_id", "acc_index", "region_index") == [(9, 0.0, 1.0), (10, 1.0, 0.0), (100, 2.0, 0.0)]
    hot = models.one_hot().fit(out).transform(out)
    assert [list(r["acc_hot"].toArray()) for r in hot.orderBy("acc_id").collect()] == [
        [1, 0, 0], [0, 1, 0], [0, 0, 1],
    ]


def test_scaling_uses_the_train_population(spark):
    rows = spark.createDataFrame(
        [(1.0, 5.0, True), (3.0, 5.0, True), (None, 5.0, True), (9.0, 6.0, False)],
        "realized_lag1 double, realized_lag2 double, train boolean",
    )
    out = models.scale_lags(rows, rows.where("train"))
    assert values(out, "realized_lag1_scaled", "realized_lag2_scaled") == [
        (None, 0.0), (-1.0, 0.0), (1.0, 0.0), (7.0, 1.0),
    ]


def test_trials_stay_in_their_space_and_repeat():
    for kind, space in SEARCH_SPACES.items():
        trials = models.draw_trials(kind, 50, seed=3)
        assert trials == models.draw_trials(kind, 50, seed=3)
        assert trials != models.draw_trials(kind, 50, seed=4)
        for name, how, low, high in space:
            given = [t[name] for t in trials if name in t]
            assert given and all(low <= x <= high for x in given)
            assert how != "int" or all(isinstance(x, int) for x in given)
            if (kind, name) == ("catboost", "subsample"):
                assert {t["bootstrap"] for t in trials if name in t} == {"Bernoulli"}
                assert len(given) < len(trials)
            else:
                assert len(given) == len(trials)


def test_search_picks_the_smallest_error(frame):
    train, validation, _ = models.validation_split(frame)
    trials = [
        {"learning_rate": 0.01, "trees": 1, "max_depth": 1, "min_leaf": 40},
        {"learning_rate": 0.5, "trees": 6, "max_depth": 4, "min_leaf": 1},
    ]
    table = models.search(train, validation, "hgb", trials, parallelism=2)
    assert table.count() == 2
    assert models.best_trial(table)["max_depth"] == 4
    assert sorted(r["trial"] for r in table.collect()) == [0, 1]


def test_train_evaluate_and_ensemble_jobs(spark, panel, tmp_path, monkeypatch):
    source, out = str(tmp_path / "panel"), str(tmp_path / "out")
    csvs.write_panel(panel, source)
    small = [PARAMS | {"colsample": 1.0, "subsample": 1.0, "min_leaf": 1}]
    monkeypatch.setattr(models, "draw_trials", lambda kind, n, seed: small)
    paths = []
    for kind in ("xgboost", "hgb"):
        paths.append(str(tmp_path / kind))
        best = jobs.train(spark, source, kind, paths[-1], str(tmp_path / f"trials_{kind}"))
        assert best["max_depth"] == 3
    errors = jobs.evaluate_model(spark, source, paths[0], "xgboost", out)
    by_name = {r["forecast"]: r for r in errors.collect()}
    assert by_name["budget"]["mae"] == pytest.approx(3.0)
    assert by_name["prediction"]["n"] == 12
    saved = spark.read.parquet(f"{out}/metrics").where("forecast = 'budget' AND metric = 'mae'")
    assert saved.first()["value"] == pytest.approx(3.0)
    jobs.evaluate_model(spark, source, paths[0], "xgboost", out, acc_id=30, region="AG")
    assert spark.read.parquet(f"{out}/predictions").count() == 13
    assert jobs.evaluate_ensemble(spark, source, paths).count() == 2
    slices = jobs.evaluate_all_slices(spark, source, paths[0])
    assert slices.where("forecast = 'budget'").count() == 1 + 4 + 3 + 12


def test_text_job(spark, tmp_path):
    from slackline.plans.fixtures import word_flags, word_polarity

    path = tmp_path / "answers.txt"
    path.write_text("Explainer\nThe of the\n\nnothing\n")
    jobs.score_answers(spark, str(path), "Explainer", word_flags(spark), str(tmp_path / "counts"))
    counts = csvs.read_lexicon_result(spark, str(tmp_path / "counts"))
    assert values(counts, "Text", "positive", "negative") == [("The of the", 2, 1), ("nothing", 0, 0)]
    jobs.score_answers(spark, str(path), "Explainer", word_polarity(spark), str(tmp_path / "polar"), polar=True)
    assert csvs.read_polarity_result(spark, str(tmp_path / "polar")).count() == 2


def test_more_accounts_than_spark_has_bins_by_default(spark):
    rows = [(f"R{a % 3}", a, y, float(a + y), None, None) for a in range(320) for y in (1, 2)]
    df = spark.createDataFrame(
        rows, "region string, acc_id int, year int, realized double, realized_lag1 double, realized_lag2 double"
    )
    model = models.fit_gbt(df, "xgboost", {"trees": 1, "max_depth": 2})
    assert models.score(model, df).count() == 640


def test_long_account_numbers_stay_apart(spark):
    numbers = ["12345678901", "12345678902", "1" * 25 + "1", "1" * 25 + "2"]
    rows = spark.createDataFrame([("A", n, None, None) for n in numbers], "region string, acc_id string, realized_lag1 double, realized_lag2 double")
    assert models.model_frame(rows).select("acc_level").distinct().count() == 4


def test_the_refitted_model_is_the_one_that_was_judged(frame):
    train, validation, _ = models.validation_split(frame)
    trials = [{"learning_rate": 0.9, "trees": 12, "max_depth": 4, "min_leaf": 1}]
    table = models.search(train, validation, "hgb", trials, patience=1)
    row = table.first()
    best = models.best_trial(table)
    assert best["trees"] == row["rounds"]
    assert row["fitted"] <= row["rounds"] + 1
    assert validation_error(models.fit_boosted(train, "hgb", best), validation) == pytest.approx(row["mse"])


def test_best_trial_of_ties_and_missing_parameters(spark):
    schema = "trial int, learning_rate double, subsample double, rung int, fitted int, rounds int, mse double"
    rows = [(2, 0.2, 0.5, 1, 9, 7, 1.0), (1, 0.1, None, 0, 4, 3, 1.0), (0, 0.3, 0.9, 0, 4, 4, 2.0)]
    assert models.best_trial(spark.createDataFrame(rows, schema)) == {"learning_rate": 0.1, "trees": 3}


def test_no_trials_raise(frame):
    train, validation, _ = models.validation_split(frame)
    with pytest.raises(ValueError, match="no trials"):
        models.best_trial(models.search(train, validation, "hgb", []))


def test_parameter_files(spark, tmp_path):
    path = str(tmp_path / "params")
    models.write_params(spark, {"trees": 250.0, "learning_rate": 0.05, "max_depth": 4}, path)
    assert models.read_params(spark, path) == {"trees": 250, "learning_rate": 0.05, "max_depth": 4}
    (tmp_path / "other.json").write_text('{\n "n_estimators": 300,\n "colsample_bytree": 0.5, "alpha": 1}\n')
    assert models.read_params(spark, str(tmp_path / "other.json")) == {"trees": 300, "colsample": 0.5, "alpha": 1}
    (tmp_path / "list.json").write_text("[1]")
    with pytest.raises(ValueError, match="one JSON object"):
        models.read_params(spark, str(tmp_path / "list.json"))
    (tmp_path / "empty.json").write_text("")
    with pytest.raises(ValueError, match="found none"):
        models.read_params(spark, str(tmp_path / "empty.json"))


FOREIGN = {
    "xgboost": {"learning_rate": 0.2, "colsample_bytree": 0.7, "max_depth": 3, "alpha": 0.1, "lambda": 2.0, "subsample": 0.9, "n_estimators": 6},
    "catboost": {
        "learning_rate": 0.1, "colsample_bylevel": 0.19, "depth": 2, "boosting_type": "Plain", "l2_leaf_reg": 3.5,
        "iterations": 5, "bootstrap_type": "MVS",
    },
    "hgb": {"learning_rate": 0.09, "max_iter": 7, "max_depth": 4, "min_samples_leaf": 2, "l2_regularization": 0.0},
}


def test_a_folder_of_parameter_files_is_imported_and_refitted(spark, frame, tmp_path):
    categories = ["Alle", "Aufwand", "Ertrag", "Finanz_Ertrag", "Ausserordentlicher_Aufwand", "Ausserordentlicher_Ertrag", "Investitionsausgaben", "Investitionseinnahmen"]
    for kind, params in FOREIGN.items():
        for category in categories:
            (tmp_path / f"hyperparams_{kind}_{category}.json").write_text(json.dumps(params))
    (tmp_path / "notes.txt").write_text("not a parameter file")
    found = models.read_param_files(spark, str(tmp_path))
    assert len(found) == 24
    assert set(found) == {(k, c.replace("_", " ")) for k in FOREIGN for c in categories}
    trees = {"xgboost": 6, "catboost": 5, "hgb": 7}
    train, _, test = models.validation_split(frame)
    for kind in FOREIGN:
        params = found[(kind, "Finanz Ertrag")]
        assert params["trees"] == trees[kind]
        model = models.fit_boosted(train, kind, params)
        assert model.stages[-1].getNumTrees == trees[kind] + 1
        assert all(math.isfinite(r["prediction"]) for r in models.score(model, test).collect())


def test_ensemble_scores_rows_without_a_match(spark, frame):
    train, _, test = models.validation_split(frame)
    fitted = [models.fit_gbt(train, kind, PARAMS) for kind in ("xgboost", "hgb")]
    test = stored(test)
    twice = test.union(test)
    both = models.score_ensemble(fitted, twice)
    assert both.count() == 2 * test.count()
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    by_key = metrics.ensemble_mean([models.score(m, test) for m in fitted])
    keys = ("region", "acc_id", "year", "prediction")
    got, want = values(both.distinct(), *keys), values(by_key, *keys)
    assert [r[:-1] for r in got] == [r[:-1] for r in want]
    assert [r[-1] for r in got] == pytest.approx([r[-1] for r in want])


def test_a_key_predicted_twice_raises(spark):
    once = spark.createDataFrame([("A", 1, 1, 2.0)], "region string, acc_id int, year int, prediction double")
    twice = once.union(once)
    assert metrics.ensemble_mean([once, once]).first()["prediction"] == 2.0
    with pytest.raises(Exception, match="several predictions for one key"):
        metrics.ensemble_mean([once, twice]).collect()


def test_ensemble_and_slice_jobs_write_their_errors(spark, panel, tmp_path):
    source, out = str(tmp_path / "panel"), str(tmp_path / "out")
    csvs.write_panel(panel, source)
    frame = stored(features.engineer(csvs.read_panel(spark, source), "Alle"))
    train, test = features.holdout(frame)
    paths = []
    for kind in ("xgboost", "hgb"):
        paths.append(str(tmp_path / kind))
        models.save_model(models.fit_gbt(train, kind, PARAMS), paths[-1])
    errors = jobs.evaluate_ensemble(spark, source, paths, out_dir=out)
    assert {r["forecast"] for r in errors.collect()} == {"prediction", "budget"}
    assert spark.read.parquet(f"{out}/predictions").count() == test.count()
    assert spark.read.parquet(f"{out}/metrics").where("model = 'ensemble'").count() == 12
    slices = jobs.evaluate_all_slices(spark, source, paths[0], out_dir=out, kind="xgboost")
    assert spark.read.parquet(f"{out}/slice_metrics").count() == 6 * slices.count()
