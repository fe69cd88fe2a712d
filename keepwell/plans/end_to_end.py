"""The whole sequence, from the raw export to the risk table, and the lookback audit.

Each step writes its result and the next one reads it, so a run can be picked
up after any step and no step computes an earlier one again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.functions.exprs import rounded
from keepwell.operators import cleaning, quality
from keepwell.plans import attribution, cohorts, modelling, panel, revenue, rfm, scoring, segmentation
from keepwell.session import materialize
from keepwell.settings import FEATURES, LOOKBACKS, RFM_CUTOFF, SEED, SNAPSHOTS, TARGET, Snapshot
from keepwell.sources import readers, writers
from keepwell.sources.schemas import MINIMUM_ROWS

Tables = Mapping[str, DataFrame]


def ingest(
    spark: SparkSession, raw_folder: str, out: str, minimums: Mapping[str, int] = MINIMUM_ROWS
) -> dict[str, DataFrame]:
    """Clean the raw export, write it, and fail if it breaks a rule."""
    writers.write_tables(cleaning.clean_all(readers.load_raw(spark, raw_folder)), f"{out}/tables")
    tables = readers.load_tables(spark, f"{out}/tables")
    quality.require_valid(quality.run_suite(tables, minimums))
    return tables


def reports(t: Tables) -> dict[str, DataFrame]:
    """The five standard reports by file name."""
    orders, items, customers = t["fact_orders"], t["fact_order_items"], t["dim_customers"]
    return {
        "monthly_revenue_trends": revenue.monthly_revenue(orders, customers, items),
        "category_performance": revenue.category_performance(items, t["dim_products"], orders),
        "top_vip_customers": revenue.top_customers(customers, orders, items),
        "customer_spend_quartiles": revenue.spend_quartiles(
            revenue.customer_spend(customers, orders, items)
        ),
        "cohort_retention": cohorts.cohort_retention(orders, customers),
    }


def analyse(
    spark: SparkSession,
    t: Tables,
    out: str,
    snapshots: Sequence[Snapshot] = SNAPSHOTS,
    cutoff: str = RFM_CUTOFF,
    settings: Sequence[modelling.BoostSettings] | None = None,
    clusters: int = 4,
    restarts: int = 10,
    seed: int = SEED,
) -> DataFrame:
    """Reports, RFM, segments, panel, model, explanations; returns the written risk table."""

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    writers.write_reports(reports(t), f"{out}/reports")

    values = stored(
        rfm.rfm(t["fact_orders"], t["fact_order_items"], t["dim_customers"], cutoff), "customer_rfm"
    )
    customers, profile, clustering = segmentation.segment_customers(values, clusters, restarts, seed)
    customers = stored(customers, "customer_segments")
    writers.write_reports({"cluster_profiles": profile}, f"{out}/reports")
    writers.save_model(clustering, f"{out}/models/segments")

    built = panel.churn_panel(t, snapshots)
    writers.write_panel(built, out)
    history = spark.read.schema(built.schema).parquet(f"{out}/churn_panel")
    writers.write_json(panel.target_document(history, snapshots), f"{out}/reports/target_quality_report")

    champion, grid = modelling.train_champion(history, settings, seed=seed)
    writers.save_model(champion.model, f"{out}/models/champion")
    writers.write_json(champion.metrics, f"{out}/reports/champion_model_metrics")
    writers.write_reports(
        {
            "grid_search": grid,
            "threshold_optimization_results": champion.thresholds,
            "frozen_threshold": champion.frozen,
        },
        f"{out}/reports",
    )

    current = spark.read.schema(built.schema).parquet(f"{out}/churn_features")
    writers.write_holdout(current, FEATURES, TARGET, f"{out}/holdout_test_set")
    writers.write_reports(
        {"feature_importance": attribution.global_tree_importance(current, champion.model, seed=seed)},
        f"{out}/reports",
    )
    scored = champion.model.transform(current)
    return stored(scoring.risk_table(scored, "probability", customers), "customer_risk_scoring")


def audit_lookbacks(
    t: Tables,
    snapshots: Sequence[Snapshot] = SNAPSHOTS,
    lookbacks: Sequence[int | None] = LOOKBACKS,
    settings: Sequence[modelling.BoostSettings] | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per lookback: tuned model on the holdout, frozen threshold and costs.

    All panels come from one pass over the facts; each lookback is then
    tuned, refitted and measured by the same protocol.
    """
    panels = materialize(panel.lookback_panels(t, snapshots, lookbacks))
    rows = []
    for lookback in lookbacks:
        one = panels.filter(F.col("lookback_days").eqNullSafe(F.lit(lookback).cast("int")))
        champion, _ = modelling.train_champion(one.drop("lookback_days"), settings, seed=seed)
        measured = champion.metrics.filter("split_role = 'test'").select(
            *[rounded(c, 4).alias(c) for c in ("roc_auc", "pr_auc", "f1_score", "brier_score")],
            F.lit(1).alias("_one"),
        )
        frozen = champion.frozen.filter("choice = 'frozen'").select(
            "threshold",
            "validation_cost",
            F.col("total_business_cost").alias("holdout_cost"),
            "target_all_cost",
            "cost_reduction_pct",
            F.lit(1).alias("_one"),
        )
        label = "all" if lookback is None else str(lookback)
        rows.append(measured.join(frozen, "_one").drop("_one").withColumn("lookback", F.lit(label)))
    return reduce(DataFrame.unionByName, rows)
