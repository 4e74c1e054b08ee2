"""Boosted-tree forecasts of the realized amount, with a random search."""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slackline.fixed_values import EARLY_STOPPING_ROUNDS, PARAMETER_NAMES, SEARCH_SPACES, SEED
from slackline.operators.boosting import Boosted
from slackline.operators.features import newest_year
from slackline.session import stored

LAGS = ["realized_lag1", "realized_lag2"]
# Digits of the longest account number there can be.
LEVEL_WIDTH = 19
# Trees need a bin per level; fewer levels than this keep Spark's finer bins for the amounts.
LEAST_BINS = 256
KINDS = ("xgboost", "catboost", "hgb")
# Rounds of the first rung of a search, and what a rung's rounds and survivors differ by.
FIRST_RUNG = 8
RUNG_FACTOR = 3
BOOTSTRAPS = ("Bayesian", "MVS", "Bernoulli")


def model_frame(df: DataFrame) -> DataFrame:
    """Columns the models read: levels as text that sorts like the account, lags without NULL.

    Trees in Spark reject missing values, so a missing lag is 0 plus a 0/1 column.
    """
    filled = {f"{c}_filled": F.coalesce(c, F.lit(0.0)) for c in LAGS}
    missing = {f"{c}_missing": F.col(c).isNull().cast("double") for c in LAGS}
    number = F.col("acc_id").cast("string")
    # Padded, never cut: a level longer than any number stays whole.
    level = F.when(F.length(number) < LEVEL_WIDTH, F.lpad(number, LEVEL_WIDTH, "0")).otherwise(number)
    return df.withColumns({"acc_level": level} | filled | missing)


def scale_lags(df: DataFrame, train: DataFrame) -> DataFrame:
    """Lags minus the train mean over the train population std; NULL stays NULL."""
    parts = [F.avg(c).alias(f"{c}_mean") for c in LAGS]
    parts += [F.stddev_pop(c).alias(f"{c}_std") for c in LAGS]
    fit = train.agg(F.struct(*parts)).scalar()
    # A constant column is only centred.
    spread = {c: F.when(fit[f"{c}_std"] == 0, 1.0).otherwise(fit[f"{c}_std"]) for c in LAGS}
    return df.withColumns(
        {f"{c}_scaled": (F.col(c) - fit[f"{c}_mean"]) / spread[c] for c in LAGS}
    )


def level_indexer(unknown: str = "error") -> StringIndexer:
    """Region and account as positions in their sorted levels."""
    return StringIndexer(
        inputCols=["region", "acc_level"],
        outputCols=["region_index", "acc_index"],
        stringOrderType="alphabetAsc",
        handleInvalid=unknown,
    )


def one_hot() -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=["region_index", "acc_index"],
        outputCols=["region_hot", "acc_hot"],
        dropLast=False,
        handleInvalid="error",
    )


def feature_stages(kind: str) -> list:
    """Indexed levels and the year for two kinds, one-hot levels without year for ``hgb``."""
    if kind not in KINDS:
        raise ValueError(f"unknown model kind: {kind}")
    lags = [f"{c}_filled" for c in LAGS] + [f"{c}_missing" for c in LAGS]
    if kind == "hgb":
        return [
            level_indexer(),
            one_hot(),
            VectorAssembler(inputCols=["region_hot", "acc_hot", *lags], outputCol="features"),
        ]
    return [
        level_indexer("keep"),
        VectorAssembler(inputCols=["year", "region_index", "acc_index", *lags], outputCol="features"),
    ]


def regressor(params: dict, seed: int = SEED, max_bins: int = LEAST_BINS) -> GBTRegressor:
    """Boosted trees on squared error; parameters without a Spark counterpart are ignored."""
    model = GBTRegressor(
        featuresCol="features",
        labelCol="realized",
        predictionCol="prediction",
        lossType="squared",
        seed=seed,
        maxBins=max_bins,
        stepSize=float(params.get("learning_rate", 0.1)),
        maxIter=int(params.get("trees", 100)),
        maxDepth=int(params.get("max_depth", 5)),
        subsamplingRate=float(params.get("subsample", 1.0)),
        minInstancesPerNode=int(params.get("min_leaf", 1)),
    )
    if "colsample" in params:
        model.setFeatureSubsetStrategy(str(float(params["colsample"])))
    return model


def fit_gbt(train: DataFrame, kind: str, params: dict, seed: int = SEED) -> PipelineModel:
    """Fit the features and the trees of one parameter set."""
    prepared = fit_features(train, kind)
    return fit_trees(prepared, prepared.transform(model_frame(train)), params, seed)


def fit_features(train: DataFrame, kind: str) -> PipelineModel:
    """The indexers and the assembled vector, which all parameter sets share."""
    return Pipeline(stages=feature_stages(kind)).fit(model_frame(train))


def fit_trees(prepared: PipelineModel, vectors: DataFrame, params: dict, seed: int = SEED) -> PipelineModel:
    """The trees of one parameter set on assembled vectors; a bin for every level."""
    levels = max(len(labels) for labels in prepared.stages[0].labelsArray) + 1
    model = regressor(params, seed, max(LEAST_BINS, levels)).fit(vectors.select("features", "realized"))
    return PipelineModel([*prepared.stages, model])


def round_errors(model: PipelineModel, df: DataFrame) -> list[float]:
    """Mean squared error on ``df`` after each boosting round, from one pass."""
    features = PipelineModel(model.stages[:-1]).transform(model_frame(df))
    return model.stages[-1].evaluateEachIteration(features, "squared")


def _growing(
    train: DataFrame, validation: DataFrame | None, kind: str
) -> tuple[PipelineModel, DataFrame, int]:
    """(prepared features, stored rows of both frames with ``judged``, bins): shared by all fits."""
    prepared = fit_features(train, kind)
    levels = max(len(labels) for labels in prepared.stages[0].labelsArray) + 1

    def vectors(df: DataFrame, judged: bool) -> DataFrame:
        return prepared.transform(model_frame(df)).select("features", "realized", F.lit(judged).alias("judged"))

    rows = vectors(train, False)
    if validation is not None:
        rows = rows.union(vectors(validation, True))
    return prepared, stored(rows), max(LEAST_BINS, levels)


def fit_boosted(train: DataFrame, kind: str, params: dict, seed: int = SEED) -> PipelineModel:
    """All rounds of one parameter set, as ``search`` and ``fit_early_stopped`` grow them."""
    prepared, rows, bins = _growing(train, None, kind)
    return Boosted(prepared, rows, params, bins, seed).grow().model()


def fit_early_stopped(
    train: DataFrame,
    validation: DataFrame,
    kind: str,
    params: dict,
    seed: int = SEED,
    patience: int = EARLY_STOPPING_ROUNDS,
) -> Boosted:
    """Grow until ``patience`` rounds did not lower the error on ``validation``.

    No round beyond is fitted. ``.model()`` of the result has the rounds up to the best one,
    ``.errors`` the error after each round.
    """
    prepared, rows, bins = _growing(train, validation, kind)
    return Boosted(prepared, rows, params, bins, seed, patience).grow()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with a ``prediction`` column."""
    return model.transform(model_frame(df)).select(*df.columns, "prediction")


def score_ensemble(models: list[PipelineModel], df: DataFrame) -> DataFrame:
    """``df`` with the mean of all models' predictions as ``prediction``.

    The models are applied to each row one after another: nothing is matched by key, so rows
    that share one do no harm, and nothing is shuffled. NULL if a model gives none.
    """
    rows = df
    for i, model in enumerate(models):
        rows = score(model, rows).withColumnRenamed("prediction", f"_p{i}")
    total = reduce(lambda a, b: a + b, [F.col(f"_p{i}") for i in range(len(models))])
    return rows.select(*df.columns, (total / len(models)).alias("prediction"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def validation_split(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validation, test): the newest year is test, the one before validation."""
    newest = newest_year(df)
    return (
        df.where(F.col("year") < newest - 1),
        df.where(F.col("year") == newest - 1),
        df.where(F.col("year") == newest),
    )


def draw_trials(kind: str, n: int, seed: int = SEED) -> list[dict]:
    """n parameter sets from the search space, the same for the same seed."""
    source = random.Random(seed)
    trials = []
    for _ in range(n):
        params = {}
        for name, how, low, high in SEARCH_SPACES[kind]:
            if name == "subsample" and kind == "catboost":
                # Only one of the bootstrap kinds draws a share of the rows.
                params["bootstrap"] = source.choice(BOOTSTRAPS)
                if params["bootstrap"] != BOOTSTRAPS[-1]:
                    continue
            if how == "int":
                params[name] = source.randint(low, high)
            elif how == "log":
                params[name] = math.exp(source.uniform(math.log(low), math.log(high)))
            else:
                params[name] = source.uniform(low, high)
        trials.append(params)
    return trials


def search(
    train: DataFrame,
    validation: DataFrame,
    kind: str,
    trials: list[dict],
    seed: int = SEED,
    parallelism: int = 4,
    patience: int = EARLY_STOPPING_ROUNDS,
    first: int = FIRST_RUNG,
    factor: int = RUNG_FACTOR,
) -> DataFrame:
    """(trial, parameters..., rung, fitted, rounds, mse) of every trial: successive halving.

    All parameter sets grow to ``first`` rounds. Those in the best 1 / ``factor`` go on from their
    stored predictions to ``factor`` times as many, and so on; the last one grows to its own
    number of trees or until ``patience`` rounds brought nothing. ``rung`` is the last one a set
    took part in, ``fitted`` the rounds it grew, ``mse`` the smallest validation error of them and
    ``rounds`` the round that had it. Ties keep the earlier trial. Parameters are used as drawn; one
    that a trial does not have is NULL. Sets grow side by side as Spark jobs and the driver only
    keeps their trees and a few numbers.
    """
    names = [p[0] for p in SEARCH_SPACES[kind]]
    numbers = ", ".join(f"{p} double" for p in names)
    schema = f"trial int, {numbers}, rung int, fitted int, rounds int, mse double"
    if not trials:
        return train.sparkSession.createDataFrame([], schema)
    prepared, rows, bins = _growing(train, validation, kind)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        grown = list(pool.map(lambda p: Boosted(prepared, rows, p, bins, seed, patience), trials))
        rung, going, reached = 0, list(range(len(trials))), [0] * len(trials)
        while going:
            until = first * factor**rung if len(going) > 1 else None
            list(pool.map(lambda i: grown[i].grow(until), going))
            for i in going:
                reached[i] = rung
            if len(going) == 1:
                break
            going = sorted(going, key=lambda i: (grown[i].error, i))[: -(-len(going) // factor)]
            rung += 1
    table = [
        (i, *[None if p.get(n) is None else float(p[n]) for n in names], reached[i], g.rounds, g.best, g.error)
        for i, (p, g) in enumerate(zip(trials, grown, strict=True))
    ]
    return train.sparkSession.createDataFrame(table, schema)


def best_trial(trials: DataFrame) -> dict:
    """Parameters of the trial with the smallest error; the earlier trial wins a tie.

    ``trees`` is the round that had that error, so that the refitted model is the one that
    was judged. Parameters the trial did not have are left out.
    """
    row = trials.agg(
        F.min_by(F.struct(*trials.columns), F.struct("mse", "trial")).alias("best")
    ).first()["best"]
    if row is None:
        raise ValueError("no trials")
    given = row.asDict()
    own = ("trial", "rung", "fitted", "rounds", "mse")
    params = {k: v for k, v in given.items() if k not in own and v is not None}
    return params | {"trees": given.get("rounds", given.get("trees"))}


def write_params(spark: SparkSession, params: dict, path: str) -> None:
    """One parameter set as a JSON object, whole numbers without a fraction.

    Written as one line by Spark, so ``path`` may be on any store the cluster knows.
    """
    plain = {k: int(v) if isinstance(v, float) and v.is_integer() else v for k, v in params.items()}
    line = spark.createDataFrame([(json.dumps(plain, sort_keys=True),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(path)


def _named(text: str) -> dict:
    given = json.loads(text)
    if not isinstance(given, dict):
        raise ValueError("a parameter file holds one JSON object")
    return {PARAMETER_NAMES.get(k, k): v for k, v in given.items()}


def read_params(spark: SparkSession, path: str) -> dict:
    """A JSON parameter file, of any layout, or a folder that ``write_params`` wrote.

    The names of other libraries become the names used here.
    """
    found = spark.read.text(path, wholetext=True).where("trim(value) <> ''").take(2)
    if len(found) != 1:
        raise ValueError(f"expected one parameter set in {path}, found {'several' if found else 'none'}")
    return _named(found[0]["value"])


def read_param_files(spark: SparkSession, directory: str, pattern: str = "hyperparams_*.json") -> dict[tuple[str, str], dict]:
    """{(kind, category): parameters} of all files named ``hyperparams_<kind>_<category>.json``.

    The files are a few hundred bytes each, one per model that was ever tuned.
    """
    rows = spark.read.text(directory, wholetext=True, pathGlobFilter=pattern).select(
        F.regexp_extract("_metadata.file_name", r"^hyperparams_([^_]+)_(.+)\.json$", 1).alias("kind"),
        F.regexp_replace(F.regexp_extract("_metadata.file_name", r"^hyperparams_([^_]+)_(.+)\.json$", 2), "_", " ").alias("category"),
        "value",
    )
    return {(r["kind"], r["category"]): _named(r["value"]) for r in rows.orderBy("kind", "category").collect()}


def tune_and_fit(
    train: DataFrame, validation: DataFrame, kind: str, trials: list[dict], **kwargs
) -> tuple[PipelineModel, DataFrame]:
    """Search, then fit the best parameters on all train and validation rows."""
    table = search(train, validation, kind, trials, **kwargs)
    model = fit_boosted(train.unionByName(validation), kind, best_trial(table), kwargs.get("seed", SEED))
    return model, table
