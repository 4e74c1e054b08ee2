"""Boosted trees grown round by round, so that a fit can stop early and be taken up again."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slackline.fixed_values import EARLY_STOPPING_ROUNDS, SEED
from slackline.session import forget, stored

# Rounds whose predictions are computed anew from the last stored ones.
BLOCK = 8


def tree(params: dict, seed: int, max_bins: int, label: str) -> RandomForestRegressor:
    """One regression tree on ``label``, on a share of rows and features if ``params`` say so."""
    return RandomForestRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol="_tree",
        numTrees=1,
        bootstrap=False,
        seed=seed,
        maxBins=max_bins,
        maxDepth=int(params.get("max_depth", 5)),
        minInstancesPerNode=int(params.get("min_leaf", 1)),
        subsamplingRate=float(params.get("subsample", 1.0)),
        featureSubsetStrategy=str(float(params["colsample"])) if "colsample" in params else "all",
    )


class Boosted:
    """A growing model: its trees, its validation errors, and every row's current prediction.

    The first tree is a single leaf, the mean. Every round fits a tree to what is still missing
    and adds its prediction times the learning rate. Predictions are stored after each block of
    rounds and the validation errors of the block come from the same pass; only the trees and a
    number per round are on the driver. Rounds depend on the rows, the parameters and the seed,
    not on the blocks, so growing on is the same as growing at once.
    """

    def __init__(
        self,
        prepared: PipelineModel,
        rows: DataFrame,
        params: dict,
        max_bins: int,
        seed: int = SEED,
        patience: int = EARLY_STOPPING_ROUNDS,
    ):
        """``rows`` (features, realized, judged): judged rows validate, the others train."""
        if patience < 1:
            raise ValueError("patience must be at least one round")
        self.prepared, self.params, self.seed = prepared, params, seed
        self.max_bins, self.patience = max_bins, patience
        self.rate = float(params.get("learning_rate", 0.1))
        self.most = int(params.get("trees", 100))
        self.errors: list[float] = []
        base = tree({"max_depth": 0}, seed, max_bins, "realized").fit(rows.where("NOT judged"))
        self.trees = [base.trees[0]]
        self.rows = base.transform(rows).withColumn("guess", F.col("_tree")).drop("_tree")
        self.validates = not rows.where("judged").isEmpty()

    @property
    def rounds(self) -> int:
        """Rounds fitted so far, without the mean."""
        return len(self.trees) - 1

    @property
    def best(self) -> int:
        """The round, from 1, with the smallest error so far; the last one without validation rows."""
        return self.errors.index(min(self.errors)) + 1 if self.errors else self.rounds

    @property
    def error(self) -> float:
        return min(self.errors) if self.errors else float("nan")

    @property
    def ended(self) -> bool:
        return self.rounds >= self.most or (self.validates and self.rounds - self.best >= self.patience)

    def grow(self, until: int | None = None) -> Boosted:
        """Grow to ``until`` rounds, or to the end: all rounds of the parameters or the patience.

        A block never reaches beyond the patience, so a fit has at most ``best + patience`` rounds.
        """
        until = self.most if until is None else min(until, self.most)
        while self.rounds < until and not self.ended:
            block = min(BLOCK, until - self.rounds)
            if self.validates and self.errors:
                block = min(block, self.best + self.patience - self.rounds)
            elif self.validates:
                block = min(block, self.patience + 1)
            self._block(block)
        return self

    def _block(self, rounds: int) -> None:
        now = self.rows
        missed = {}
        for _ in range(rounds):
            rest = now.where("NOT judged").select("features", (F.col("realized") - F.col("guess")).alias("rest"))
            fitted = tree(self.params, self.seed + len(self.trees), self.max_bins, "rest").fit(rest)
            self.trees.append(fitted.trees[0])
            now = fitted.transform(now).withColumn("guess", F.col("guess") + F.lit(self.rate) * F.col("_tree")).drop("_tree")
            missed[f"_miss{len(missed)}"] = F.pow(F.col("realized") - F.col("guess"), 2)
            now = now.withColumn(list(missed)[-1], list(missed.values())[-1])
        done = stored(now)
        if self.validates:
            self.errors += list(done.where("judged").agg(*[F.avg(c) for c in missed]).first())
        forget(self.rows)
        self.rows = done.drop(*missed)
        self.rows._stored_at = done._stored_at

    def model(self, rounds: int | None = None) -> PipelineModel:
        """The features and the trees of the first ``rounds`` rounds, by default up to the best one.

        The trees are put into one boosted model through its public constructor, so it is saved
        and loaded like any other.
        """
        count = 1 + (self.best if rounds is None else rounds)
        spark = self.rows.sparkSession
        gateway, ml = spark.sparkContext._gateway, spark.sparkContext._jvm.org.apache.spark.ml.regression
        trees = gateway.new_array(ml.DecisionTreeRegressionModel, count)
        weights = gateway.new_array(gateway.jvm.double, count)
        for i, one in enumerate(self.trees[:count]):
            trees[i], weights[i] = one._java_obj, 1.0 if i == 0 else self.rate
        whole = GBTRegressionModel(ml.GBTRegressionModel(f"boosted_{uuid.uuid4().hex[:12]}", trees, weights))
        whole.setFeaturesCol("features").setPredictionCol("prediction")
        return PipelineModel([*self.prepared.stages, whole])


def early_stops(rounds: DataFrame, patience: int = EARLY_STOPPING_ROUNDS, by: str = "trial") -> DataFrame:
    """(by, best, stop, mse) of ``rounds`` (by, round, mse): where early stopping ends each fit.

    ``best`` is the last round better than all before it when ``patience`` rounds without a
    better one have passed, at round ``stop``, or else at the last round there is.
    """
    in_order = Window.partitionBy(by).orderBy("round")
    before = F.min("mse").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    better: Column = before.isNull() | (F.col("mse") < before)
    marked = rounds.withColumn("_better", better)
    last = F.last(F.when(F.col("_better"), F.struct("round", "mse")), ignorenulls=True)
    marked = marked.withColumn("_best", last.over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    waited = ~F.col("_better") & (F.col("round") - F.col("_best.round") >= patience)
    end = F.coalesce(F.min(F.when(waited, F.struct("round", "_best"))), F.max(F.struct("round", "_best")))
    return (
        marked.groupBy(by).agg(end.alias("_end"))
        .select(by, F.col("_end._best.round").alias("best"), F.col("_end.round").alias("stop"), F.col("_end._best.mse").alias("mse"))
    )
