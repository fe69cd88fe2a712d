"""Classification metrics, curves and cost-based thresholds over scored rows.

A scored frame has a 0/1 label and a probability.  ``by`` names a fixed, short
list of groups (models, folds, splits), so many models are measured in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from keepwell.functions.exprs import grid_position, linspace, ratio, rounded
from keepwell.operators.ordering import running_totals
from keepwell.session import materialize
from keepwell.settings import (
    INCENTIVE_COST,
    ROI_INCENTIVE_COST,
    ROI_SAVED_MARGIN,
    ROI_SUCCESS_RATE,
    ROI_THRESHOLD,
    SAVED_MARGIN,
    SUCCESS_RATE,
)


def _score_counts(scored: DataFrame, label: str, prob: str, by: list[str]) -> DataFrame:
    """Positives and negatives per distinct score."""
    return scored.groupBy(*by, F.col(prob).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("neg"),
    )


def _curve(scored: DataFrame, label: str, prob: str, by: list[str]) -> DataFrame:
    """Distinct scores, highest first, with true and false positives at that threshold."""
    return running_totals(
        _score_counts(scored, label, prob, by), [F.col("score").desc()], ["pos", "neg"], by
    )


def _zero_if_undefined(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _confusion(label: str, predicted: Column) -> dict[str, Column]:
    y = F.col(label) == 1
    return {
        "true_negatives": F.count_if(~y & ~predicted),
        "false_positives": F.count_if(~y & predicted),
        "false_negatives": F.count_if(y & ~predicted),
        "true_positives": F.count_if(y & predicted),
    }


def _rates() -> dict[str, Column]:
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": _zero_if_undefined(ratio(tp, tp + fp)),
        "recall": _zero_if_undefined(ratio(tp, tp + fn)),
        "f1_score": _zero_if_undefined(ratio(2 * tp, 2 * tp + fp + fn)),
        "specificity": _zero_if_undefined(ratio(tn, tn + fp)),
    }


METRICS = [
    "accuracy",
    "precision",
    "recall",
    "f1_score",
    "roc_auc",
    "pr_auc",
    "brier_score",
    "true_negatives",
    "false_positives",
    "false_negatives",
    "true_positives",
    "specificity",
]


def binary_metrics(
    scored: DataFrame,
    label: str,
    prob: str,
    predicted: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """All metrics of a scored frame; prediction is ``prob >= 0.5`` unless given.

    ROC-AUC is the exact share of (positive, negative) pairs in the right
    order, ties counting half; PR-AUC is average precision (step sum).
    """
    by = list(by)
    predicted = F.col(prob) >= 0.5 if predicted is None else predicted
    error = F.col(prob) - F.col(label)
    # exact decimal sum, so the result does not depend on row order
    squared = F.sum((error * error).cast("decimal(18,12)"))
    counts = scored.groupBy(*by).agg(
        *[c.alias(n) for n, c in _confusion(label, predicted).items()],
        ratio(squared, F.count(F.lit(1))).alias("brier_score"),
    )
    curve = _curve(scored, label, prob, by)
    # twice the pairs in order (ties half), in decimals: exact and free of overflow
    pairs = F.col("neg").cast("decimal(18,0)") * (2 * F.col("pos_upto") - F.col("pos")).cast("decimal(19,0)")
    all_pairs = F.max("pos_total").cast("double") * F.max("neg_total").cast("double") * 2.0
    precision = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    areas = curve.groupBy(*by).agg(
        ratio(F.sum(pairs), all_pairs).alias("roc_auc"),
        ratio(F.sum(F.col("pos") * precision), F.max("pos_total")).alias("pr_auc"),
    )
    together = counts.join(areas, by) if by else counts.withColumns(
        {c: areas.select(c).scalar() for c in ("roc_auc", "pr_auc")}
    )
    return together.withColumns(_rates()).select(*by, *METRICS)


def roc_points(scored: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """threshold, fpr, tpr for every distinct score (the origin is implied)."""
    return _curve(scored, label, prob, list(by)).select(
        *by,
        F.col("score").alias("threshold"),
        ratio("neg_upto", "neg_total").alias("fpr"),
        ratio("pos_upto", "pos_total").alias("tpr"),
    )


def pr_points(scored: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """threshold, precision, recall for every distinct score."""
    return _curve(scored, label, prob, list(by)).select(
        *by,
        F.col("score").alias("threshold"),
        ratio("pos_upto", F.col("pos_upto") + F.col("neg_upto")).alias("precision"),
        ratio("pos_upto", "pos_total").alias("recall"),
    )


def confusion_table(scored: DataFrame, label: str, prob: str, threshold: float = 0.5) -> DataFrame:
    """actual, predicted, n: all four cells, also when empty."""
    cells = scored.agg(
        *[c.alias(n) for n, c in _confusion(label, F.col(prob) >= threshold).items()]
    )
    return cells.selectExpr(
        "stack(4, 0, 0, true_negatives, 0, 1, false_positives, "
        "1, 0, false_negatives, 1, 1, true_positives) AS (actual, predicted, n)"
    )


def threshold_grid(start: float = 0.10, stop: float = 0.95, steps: int = 50) -> list[float]:
    return linspace(start, stop, steps)


def _above_thresholds(scored: DataFrame, prob: str, grid: Sequence[float], **sums: Column) -> DataFrame:
    """One row per threshold with the sums over rows whose score reaches it.

    Each row is put into one cell of the grid, so rows are not multiplied by
    the number of thresholds; the rest is a window over the cells.
    """
    spark = scored.sparkSession
    cells = scored.groupBy(grid_position(prob, grid).alias("cell")).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    empty = spark.range(len(grid) + 1).select(
        F.col("id").cast("int").alias("cell"), *[F.lit(0).cast("bigint").alias(n) for n in sums]
    )
    all_cells = cells.unionByName(empty).groupBy("cell").agg(*[F.sum(n).alias(n) for n in sums])
    whole = W.partitionBy(F.lit(0))
    reached = whole.orderBy(F.desc("cell")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        all_cells.select(
            "cell",
            *[F.sum(n).over(reached).alias(n) for n in sums],
            *[F.sum(n).over(whole).alias(f"all_{n}") for n in sums],
        )
        .filter(F.col("cell") > 0)
        .withColumn("exact_threshold", F.element_at(F.array(*[F.lit(g) for g in grid]), F.col("cell")))
    )


def threshold_sweep(
    scored: DataFrame,
    label: str,
    prob: str,
    cost_fp: float = INCENTIVE_COST,
    cost_fn: float = SAVED_MARGIN,
    success_rate: float = SUCCESS_RATE,
    grid: Sequence[float] | None = None,
) -> DataFrame:
    """Quality and campaign economics at each threshold, ascending."""
    grid = list(grid or threshold_grid())
    y = F.col(label).cast("bigint")
    reached = _above_thresholds(scored, prob, grid, pos=y, neg=1 - y)
    targeted = F.col("true_positives") + F.col("false_positives")
    saved = F.floor(targeted * F.lit(success_rate)).cast("bigint")
    return (
        reached.select(
            F.col("exact_threshold"),
            F.col("pos").alias("true_positives"),
            F.col("neg").alias("false_positives"),
            (F.col("all_neg") - F.col("neg")).alias("true_negatives"),
            (F.col("all_pos") - F.col("pos")).alias("false_negatives"),
        )
        .withColumns(_rates())
        .select(
            rounded("exact_threshold", 3).alias("threshold"),
            *[rounded(c, 4).alias(c) for c in ("precision", "recall", "f1_score")],
            "true_positives",
            "false_positives",
            "true_negatives",
            "false_negatives",
            rounded(F.col("false_positives") * cost_fp + F.col("false_negatives") * cost_fn, 2).alias(
                "total_business_cost"
            ),
            targeted.alias("targeted_customers"),
            rounded(targeted * cost_fp, 2).alias("campaign_cost"),
            saved.alias("expected_saved_customers"),
            rounded(saved * cost_fn - targeted * cost_fp, 2).alias("net_saved_value"),
        )
        .orderBy("threshold")
    )


def cheapest_threshold(sweep: DataFrame) -> DataFrame:
    """The sweep row with the least cost, the lowest threshold on ties."""
    return sweep.orderBy("total_business_cost", "threshold").limit(1)


def frozen_threshold(
    scored: DataFrame,
    label: str,
    prob: str,
    role: str = "split_role",
    cost_fp: float = INCENTIVE_COST,
    cost_fn: float = SAVED_MARGIN,
) -> DataFrame:
    """Threshold chosen on validation only, then applied once to the test rows.

    Two rows (the frozen threshold and 0.50), plus what targeting everyone
    would cost and the saving against 0.50.
    """
    validation = scored.filter(F.col(role) == "val")
    chosen = cheapest_threshold(threshold_sweep(validation, label, prob, cost_fp, cost_fn))
    best = materialize(chosen.select("threshold", "total_business_cost"))
    test = scored.filter(F.col(role) == "test")
    frozen = best.select("threshold").scalar()

    def at(name: str, threshold: Column) -> DataFrame:
        marked = test.withColumn("_threshold", threshold)
        cells = _confusion(label, F.col(prob) >= F.col("_threshold"))
        return (
            marked.agg(
                F.first("_threshold").alias("threshold"),
                *[c.alias(n) for n, c in cells.items()],
            )
            .withColumns(_rates())
            .select(
                F.lit(name).alias("choice"),
                "threshold",
                *[rounded(c, 4).alias(c) for c in ("precision", "recall", "f1_score")],
                "true_positives",
                "false_positives",
                "true_negatives",
                "false_negatives",
                (F.col("false_positives") * cost_fp + F.col("false_negatives") * cost_fn).alias(
                    "total_business_cost"
                ),
                ((F.col("false_positives") + F.col("true_negatives")) * cost_fp).alias("target_all_cost"),
            )
        )

    both = at("frozen", frozen).unionByName(at("default", F.lit(0.5)))
    default_cost = F.max(F.when(F.col("choice") == "default", F.col("total_business_cost"))).over(
        W.partitionBy(F.lit(0))
    )
    return both.withColumn("validation_cost", best.select("total_business_cost").scalar()).withColumn(
        "cost_reduction_pct",
        rounded(
            (default_cost - F.col("total_business_cost")) / F.greatest(default_cost, F.lit(1.0)) * 100.0, 2
        ),
    )


# -- campaign what-if --------------------------------------------------------

def campaign_roi(
    risk: DataFrame,
    prob: str = "churn_probability",
    threshold: float = ROI_THRESHOLD,
    cost: float = ROI_INCENTIVE_COST,
    margin: float = ROI_SAVED_MARGIN,
    success_rate: float = ROI_SUCCESS_RATE,
) -> DataFrame:
    """Cost, saved customers and return of a campaign at one threshold."""
    targeted = F.col("targeted_customers")
    return (
        risk.agg(F.count_if(F.col(prob) >= threshold).alias("targeted_customers"))
        .withColumn("campaign_cost", (targeted * cost).cast("double"))
        .withColumn("saved_customers", F.floor(targeted * F.lit(success_rate)).cast("bigint"))
        .withColumn("gross_saved_margin", (F.col("saved_customers") * margin).cast("double"))
        .withColumn("net_roi", F.col("gross_saved_margin") - F.col("campaign_cost"))
        .withColumn(
            "roi_pct",
            rounded(F.col("net_roi") / F.greatest(F.col("campaign_cost"), F.lit(1.0)) * 100.0, 2),
        )
    )


def roi_curve(
    risk: DataFrame,
    prob: str = "churn_probability",
    grid: Sequence[float] | None = None,
    cost: float = ROI_INCENTIVE_COST,
    margin: float = ROI_SAVED_MARGIN,
    success_rate: float = ROI_SUCCESS_RATE,
) -> DataFrame:
    """threshold, targeted_customers, net_profit for 20 thresholds."""
    grid = list(grid or linspace(0.15, 0.85, 20))
    reached = _above_thresholds(risk, prob, grid, targeted=F.lit(1).cast("bigint"))
    saved = F.floor(F.col("targeted") * F.lit(success_rate))
    return reached.select(
        rounded("exact_threshold", 6).alias("threshold"),
        F.col("targeted").alias("targeted_customers"),
        (saved * margin - F.col("targeted") * cost).cast("double").alias("net_profit"),
    ).orderBy("threshold")
