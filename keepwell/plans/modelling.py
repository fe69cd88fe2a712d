"""Churn models: splits, candidates, cross-validation, tuning and holdout reports."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.exprs import ratio, rounded
from keepwell.operators import boosting, forest, logistic
from keepwell.operators.boosting import BoostedTrees, BoostSettings, Learner
from keepwell.operators.neighbours import synthetic_minority
from keepwell.operators.sampling import stratified_folds, stratified_split
from keepwell.plans.metrics import binary_metrics, frozen_threshold, threshold_sweep
from keepwell.session import materialize, ship_package
from keepwell.settings import (
    CV_FOLDS,
    FEATURES,
    INCENTIVE_COST,
    SAVED_MARGIN,
    SEED,
    TARGET,
    TUNE_FOLDS,
)

ROW_ID = "row_id"
#: numbers the disjoint parts of the rows, from which a model learns some
PART = "part"

# fixed values: the tuning grid (16 combinations)
GRID = {
    "max_depth": [3, 4],
    "learning_rate": [0.03, 0.05],
    "trees": [100, 150],
    "subsample": [0.8, 1.0],
}


# -- splits ------------------------------------------------------------------

def with_row_id(panel: DataFrame) -> DataFrame:
    """A key per (customer, snapshot); rows of one customer stay apart."""
    return panel.withColumn(ROW_ID, F.xxhash64("customer_unique_id", "snapshot_date"))


def split(panel: DataFrame, seed: int = SEED) -> dict[str, DataFrame]:
    """train, val and test by the panel's role; without roles a stratified 70/15/15 split.

    The split orders rows by a key of (customer, snapshot), so it repeats although customers recur.
    """
    if "split_role" not in panel.columns or panel.filter("split_role = 'train'").isEmpty():
        panel = stratified_split(
            with_row_id(panel.drop("split_role")),
            TARGET,
            ROW_ID,
            {"train": 0.70, "val": 0.15, "test": 0.15},
            seed,
        ).drop(ROW_ID)
    return {role: panel.filter(F.col("split_role") == role) for role in ("train", "val", "test")}


# -- class weights -----------------------------------------------------------

Parts = tuple[int, ...]


class LabelCounts:
    """Rows of each label in each part, from one small aggregate."""

    def __init__(self, rows: DataFrame):
        cells = rows.groupBy(PART, TARGET).count().collect()
        self.cells = {(r[PART], int(r[TARGET])): r["count"] for r in cells}
        self.parts = sorted({p for p, _ in self.cells})

    def of(self, parts: Sequence[int]) -> tuple[int, int]:
        """(negatives, positives) of some parts."""
        return tuple(sum(self.cells.get((p, label), 0) for p in parts) for label in (0, 1))


def balanced_weights(counts: tuple[int, int]) -> tuple[float, float]:
    """n / (classes * n_class), as 'balanced' class weights."""
    return tuple(sum(counts) / (2.0 * max(n, 1)) for n in counts)


def positive_weight(counts: tuple[int, int]) -> float:
    """Positives weigh negatives / positives, negatives weigh 1."""
    return counts[0] / max(counts[1], 1)


# -- candidates --------------------------------------------------------------

class Model(Protocol):
    """What a fit returns: adds the margin, if it has one, and the probability of churn to rows."""

    def transform(self, rows: DataFrame) -> DataFrame: ...


#: rows with their parts, and the parts each model learns from -> a model for each
Fit = Callable[[DataFrame, Sequence[Parts]], Sequence[Model]]


def fit_logistic(rows: DataFrame, sets: Sequence[Parts], balanced: bool = True) -> list[logistic.Logistic]:
    counts = LabelCounts(rows)
    weights = [balanced_weights(counts.of(parts)) if balanced else (1.0, 1.0) for parts in sets]
    return logistic.fit(rows, FEATURES, TARGET, PART, sets, weights)


def fit_oversampled(rows: DataFrame, sets: Sequence[Parts], seed: int = SEED) -> list[logistic.Logistic]:
    """The minority is raised by synthetic rows made from the rows a model learns from alone."""
    def oversampled(job: tuple[int, Parts]) -> DataFrame:
        i, parts = job
        some = synthetic_minority(rows.filter(F.col(PART).isin(*parts)), FEATURES, TARGET, ROW_ID, seed=seed)
        return some.select(*FEATURES, TARGET, F.lit(i).alias(PART))

    with ThreadPool(min(8, len(sets))) as pool:  # the sets need nothing of each other
        made = pool.map(oversampled, list(enumerate(sets)), chunksize=1)
    together = materialize(reduce(DataFrame.unionByName, made))
    return logistic.fit(together, FEATURES, TARGET, PART, [(i,) for i in range(len(sets))], [(1.0, 1.0)] * len(sets))


def fit_forest(
    rows: DataFrame, sets: Sequence[Parts], settings: forest.ForestSettings = forest.ForestSettings(), seed: int = SEED
) -> list[forest.Forest]:
    return forest.fit(rows, FEATURES, TARGET, PART, ROW_ID, sets, settings, seed)


def fit_boosted(
    rows: DataFrame, sets: Sequence[Parts], settings: BoostSettings = BoostSettings(), seed: int = SEED
) -> list[BoostedTrees]:
    """Gradient-boosted trees with positives weighted by the class ratio."""
    counts = LabelCounts(rows)
    learners = [Learner(settings, parts, positive_weight(counts.of(parts))) for parts in sets]
    return boosting.fit(rows, FEATURES, TARGET, PART, ROW_ID, learners, seed)


CANDIDATES: dict[str, Fit] = {
    "Logistic Regression (Balanced)": fit_logistic,
    "Logistic Regression + SMOTE": fit_oversampled,
    "Random Forest (Balanced)": fit_forest,
    "Boosted Trees (Cost-Weighted)": fit_boosted,
}


def score_rows(model: Model, rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """label, p (probability of churn) and the kept columns."""
    return model.transform(rows).select(*keep, F.col(TARGET).alias("label"), F.col("probability").alias("p"))


# -- cross-validation --------------------------------------------------------

def in_folds(train: DataFrame, folds: int, seed: int) -> DataFrame:
    """The rows with their fold as ``part``, written once."""
    folded = stratified_folds(with_row_id(train), TARGET, ROW_ID, folds, seed)
    return materialize(folded.withColumnRenamed("fold", PART))


def without(folds: int) -> list[Parts]:
    """For each fold, all the others."""
    return [tuple(f for f in range(folds) if f != held) for held in range(folds)]


def cross_validate(train: DataFrame, candidates: Mapping[str, Fit], folds: int, seed: int = SEED) -> DataFrame:
    """Metrics per candidate and fold.

    Anything a candidate does to its training rows (weights, synthetic rows,
    scaling) sees the training folds only. A candidate fits all folds in the same passes, and all
    held-out predictions are measured together in one grouped job.
    """
    folded = in_folds(train, folds, seed)
    scored = []
    for name, fit in candidates.items():
        for held, model in enumerate(fit(folded, without(folds))):
            rows = score_rows(model, folded.filter(F.col(PART) == held))
            scored.append(rows.select(F.lit(name).alias("model"), F.lit(held).alias("fold"), "label", "p"))
    together = materialize(reduce(DataFrame.unionByName, scored))
    return binary_metrics(together, "label", "p", by=["model", "fold"])


def compare_models(
    train: DataFrame, candidates: Mapping[str, Fit] = CANDIDATES, folds: int = CV_FOLDS, seed: int = SEED
) -> DataFrame:
    """Mean and deviation of the fold metrics per candidate."""
    per_fold = cross_validate(train, candidates, folds, seed)

    def mean(c: str, name: str) -> Column:
        return rounded(F.avg(c), 4).alias(f"cv_{name}_mean")

    def spread(c: str, name: str) -> Column:
        return rounded(F.stddev_pop(c), 4).alias(f"cv_{name}_std")

    return per_fold.groupBy("model").agg(
        mean("roc_auc", "roc_auc"),
        spread("roc_auc", "roc_auc"),
        mean("pr_auc", "pr_auc"),
        spread("pr_auc", "pr_auc"),
        mean("f1_score", "f1"),
        mean("recall", "recall"),
        mean("precision", "precision"),
    ).orderBy("model")


def holdout_comparison(
    train: DataFrame,
    test: DataFrame,
    candidates: Mapping[str, Fit] = CANDIDATES,
    cost_fp: float = INCENTIVE_COST,
    cost_fn: float = SAVED_MARGIN,
) -> DataFrame:
    """Each candidate fitted on train and measured on test: fit seconds, metrics, cost at 0.50."""
    train = materialize(with_row_id(train).withColumn(PART, F.lit(0)))
    scored = []
    for name, fit in candidates.items():
        start = time.monotonic()
        (model,) = fit(train, [(0,)])
        seconds = round(time.monotonic() - start, 2)
        scored.append(
            score_rows(model, test).select(
                F.lit(name).alias("model"), F.lit(seconds).alias("fit_time_sec"), "label", "p"
            )
        )
    together = materialize(reduce(DataFrame.unionByName, scored))
    measured = binary_metrics(together, "label", "p", by=["model", "fit_time_sec"])
    digits = ["roc_auc", "pr_auc", "f1_score", "precision", "recall", "brier_score"]
    return measured.select(
        "model",
        "fit_time_sec",
        *[rounded(c, 4).alias(c) for c in digits],
        (F.col("false_positives") * cost_fp + F.col("false_negatives") * cost_fn).alias("business_cost_050"),
        "true_positives",
        "false_positives",
        "true_negatives",
        "false_negatives",
    ).orderBy("model")


# -- champion ----------------------------------------------------------------

def grid_settings(grid: Mapping[str, Sequence] = GRID) -> list[BoostSettings]:
    return [BoostSettings(**dict(zip(grid, values))) for values in itertools.product(*grid.values())]


@dataclass
class Grid:
    """The settings of a search, and the longest fit that holds each: boosting adds trees one by one."""

    settings: list[BoostSettings]

    @property
    def longest(self) -> list[BoostSettings]:
        found: dict[BoostSettings, BoostSettings] = {}
        for s in self.settings:
            key = replace(s, trees=0)
            found[key] = max(found.get(key, s), s, key=lambda x: x.trees)
        return list(found.values())

    def holder(self, s: BoostSettings) -> int:
        return next(i for i, x in enumerate(self.longest) if replace(x, trees=0) == replace(s, trees=0))


def held_out_scores(folded: DataFrame, grid: Grid, models: Sequence[Sequence[BoostedTrees]]) -> DataFrame:
    """model (number of the settings), fold, label, p: every row scored by its fold's models in one pass."""
    spark = folded.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast([list(m) for m in models])  # trees x 2^depth nodes a model
    places = [(grid.holder(s), s.trees) for s in grid.settings]

    @F.pandas_udf("array<double>")
    def scores(fold: pd.Series, *columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy("float64") for c in columns])
        out = np.empty((len(x), len(places)))
        for held in fold.unique():
            rows = np.flatnonzero(fold.to_numpy() == held)
            for holder in range(len(shared.value)):
                wanted = [(i, n) for i, (h, n) in enumerate(places) if h == holder]
                found = shared.value[holder][held].margins_after(x[rows], [n for _, n in wanted])
                for (i, _), margin in zip(wanted, found):
                    out[rows, i] = 1.0 / (1.0 + np.exp(-margin))
        return pd.Series(list(out))

    scored = folded.select(
        F.col(PART).alias("fold"), F.col(TARGET).alias("label"), scores(PART, *[F.col(f).cast("double") for f in FEATURES]).alias("_p")
    )
    return scored.select(F.posexplode("_p").alias("model", "p"), "fold", "label").select("model", "fold", "label", "p")


@dataclass
class Champion:
    """The fitted model and everything reported about it."""

    settings: BoostSettings
    model: BoostedTrees
    metrics: DataFrame
    thresholds: DataFrame
    frozen: DataFrame
    scored_test: DataFrame


def measure_champion(
    settings: BoostSettings, first: BoostedTrees, model: BoostedTrees, val: DataFrame, test: DataFrame
) -> Champion:
    """``first`` (fitted on train) measured on validation, ``model`` (train and validation) once on test.

    The working threshold is chosen from the validation scores of the first
    fit and frozen; the sweep on the test rows is a report only.
    """
    val_scored = score_rows(first, val).select(F.lit("val").alias("split_role"), "label", "p")
    test_scored = materialize(score_rows(model, test, ["customer_unique_id"]))
    both = materialize(
        val_scored.unionByName(
            test_scored.select(F.lit("test").alias("split_role"), "label", "p")
        )
    )
    return Champion(
        settings=settings,
        model=model,
        metrics=binary_metrics(both, "label", "p", by=["split_role"]),
        thresholds=threshold_sweep(both.filter("split_role = 'test'"), "label", "p"),
        frozen=frozen_threshold(both, "label", "p"),
        scored_test=test_scored,
    )


def train_champion(
    panel: DataFrame,
    settings: Sequence[BoostSettings] | None = None,
    folds: int = TUNE_FOLDS,
    seed: int = SEED,
) -> tuple[Champion, DataFrame]:
    """Grid search on train, refit, measurement; also returns the grid results.

    The passes over the rows grow everything at once: for each longest settings a model of every fold, one of
    train and one of train and validation. The search picks among the last two what it needs.
    """
    spark = panel.sparkSession
    grid = Grid(list(settings or grid_settings()))
    parts = split(panel, seed)
    folded = in_folds(parts["train"], folds, seed)
    val = with_row_id(parts["val"]).withColumn(PART, F.lit(folds))
    columns = [ROW_ID, PART, TARGET, *FEATURES]
    rows = materialize(folded.select(columns).unionByName(val.select(columns)))
    counts = LabelCounts(rows)
    every = tuple(range(folds))
    sets = [*without(folds), every, (*every, folds)]
    learners = [Learner(s, p, positive_weight(counts.of(p))) for s in grid.longest for p in sets]
    fitted = boosting.fit(rows, FEATURES, TARGET, PART, ROW_ID, learners, seed)
    models = [fitted[i : i + len(sets)] for i in range(0, len(fitted), len(sets))]

    measured = binary_metrics(
        materialize(held_out_scores(folded, grid, [m[:folds] for m in models])), "label", "p", by=["model", "fold"]
    )
    # one row per combination
    means = measured.groupBy("model").agg(F.avg("roc_auc").alias("mean_roc_auc")).collect()
    scores = {r["model"]: r["mean_roc_auc"] for r in means}
    # the first on ties
    best = max(range(len(grid.settings)), key=lambda i: (scores[i], -i))
    chosen = grid.settings[best]
    first, final = (m.first(chosen.trees) for m in models[grid.holder(chosen)][folds:])
    champion = measure_champion(chosen, first, final, parts["val"], parts["test"])
    table = spark.createDataFrame(
        [
            (s.max_depth, s.learning_rate, s.trees, s.subsample, float(scores[i]), i == best)
            for i, s in enumerate(grid.settings)
        ],
        "max_depth int, learning_rate double, trees int, subsample double, mean_roc_auc double, is_best boolean",
    )
    return champion, table


def split_report(splits: Mapping[str, DataFrame]) -> DataFrame:
    """split_role, observations, churn percentage."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("observations"), F.sum(F.col(TARGET).cast("bigint")).alias("churned"))
        .select(F.lit(role).alias("split_role"), "observations", "churned",
                rounded(ratio("churned", "observations") * 100.0, 2).alias("churn_rate_pct"))
        for role, df in splits.items()
    ]
    return reduce(DataFrame.unionByName, parts)
