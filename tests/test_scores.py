import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.plans import metrics, playbook, scoring

Y = [1, 1, 0, 0, 1, 0, 0, 1]
P = [0.9, 0.8, 0.1, 0.2, 0.7, 0.3, 0.4, 0.65]


def frame(spark, y, p, **extra):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


def test_metrics_on_known_predictions(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.1), (0, 0, 0.2), (1, 1, 0.8), (0, 1, 0.6)], "y int, yhat int, p double"
    )
    got = metrics.binary_metrics(df, "y", "p", F.col("yhat") == 1).first()
    assert set(metrics.METRICS) == set(got.asDict())
    assert got["roc_auc"] == pytest.approx(8 / 9)
    assert got["pr_auc"] == pytest.approx((1 + 1 + 3 / 4) / 3)
    assert (got["true_positives"], got["false_positives"], got["true_negatives"], got["false_negatives"]) == (2, 1, 2, 1)
    assert got["f1_score"] == pytest.approx(2 / 3)
    assert got["brier_score"] == pytest.approx(np.mean([(a - b) ** 2 for a, b in [(1, 0.9), (1, 0.4), (0, 0.1), (0, 0.2), (1, 0.8), (0, 0.6)]]))


def test_auc_with_many_ties_equals_pair_count(spark):
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 2, 300), rng.integers(0, 7, 300) / 7
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    got = metrics.binary_metrics(frame(spark, y, p), "y", "p").first()
    assert got["roc_auc"] == pytest.approx(wins / (len(pos) * len(neg)))


def test_one_class_only(spark):
    got = metrics.binary_metrics(frame(spark, [1, 1], [0.2, 0.3]), "y", "p").first()
    assert got["roc_auc"] is None and got["precision"] == 0.0 and got["specificity"] == 0.0


def test_threshold_sweep_equals_brute_force(spark):
    sweep = metrics.threshold_sweep(frame(spark, Y, P), "y", "p", cost_fp=10.0, cost_fn=120.0).toPandas()
    assert len(sweep) == 50
    for th, row in zip(np.linspace(0.10, 0.95, 50), sweep.itertuples()):
        pred = np.array(P) >= th
        fp = int((pred & (np.array(Y) == 0)).sum())
        fn = int((~pred & (np.array(Y) == 1)).sum())
        assert (row.false_positives, row.false_negatives) == (fp, fn)
        assert row.total_business_cost == fp * 10 + fn * 120
        assert row.expected_saved_customers == int(pred.sum() * 0.2)
        assert row.threshold == pytest.approx(round(th, 3), abs=1e-9)
    best = metrics.cheapest_threshold(metrics.threshold_sweep(frame(spark, Y, P), "y", "p")).first()
    assert best["total_business_cost"] == sweep["total_business_cost"].min()
    assert best["threshold"] == sweep.loc[sweep["total_business_cost"].idxmin(), "threshold"]


def test_frozen_threshold_never_looks_at_test_labels(spark):
    rows = [("val", y, p) for y, p in zip(Y, P)] + [("test", y, p) for y, p in zip(Y, P)]
    flipped = [("val", y, p) for y, p in zip(Y, P)] + [("test", 1 - y, p) for y, p in zip(Y, P)]
    pick = lambda data: metrics.frozen_threshold(
        spark.createDataFrame(data, "split_role string, y int, p double"), "y", "p"
    ).filter("choice = 'frozen'").first()["threshold"]
    assert pick(rows) == pick(flipped)


def test_campaign_zero_customers(spark):
    risk = spark.createDataFrame([(0.1,)], "churn_probability double")
    got = metrics.campaign_roi(risk).first()
    assert (got["targeted_customers"], got["net_roi"], got["roi_pct"]) == (0, 0.0, 0.0)
    assert metrics.roi_curve(risk).count() == 20


def _recommend(spark, **values):
    base = dict(segment="x", risk_tier="LOW", churn_probability=0.1, lifetime_value=1.0, recency=3.0, factor="f")
    base.update(values)
    schema = "segment string, risk_tier string, churn_probability double, lifetime_value double, recency double, factor string"
    df = spark.createDataFrame([tuple(base.values())], schema)
    return playbook.recommend(df, factor="factor").first()


def test_vip_and_casual_customers(spark):
    vip = _recommend(spark, segment="Champions & VIPs", risk_tier="HIGH", churn_probability=0.88, lifetime_value=2450.0, recency=45.0, factor="Reduced frequency")
    assert "VIP" in vip["action_title"] or "Concierge" in vip["action_title"]
    assert vip["operational_urgency"].startswith("URGENT")
    assert "($2,450.00)" in vip["strategy"] and "(88.0%)" in vip["strategy"] and "(Reduced frequency)" in vip["strategy"]
    casual = _recommend(spark, segment="Hibernating & Low-Value", risk_tier="HIGH", churn_probability=0.75, lifetime_value=60.0, recency=150.0)
    assert "Digital" in casual["action_title"] and "$" in casual["recommended_budget"]
    assert not casual["is_high_value"]


@pytest.mark.parametrize(
    "segment,spend,tier,high,title",
    [
        ("Potential Loyalists", 1.0, "MEDIUM", True, "Proactive VIP"),
        ("x", 300.0, "LOW", True, "Brand Loyalty"),
        ("At-Risk High-Value", 0.0, "HIGH", True, "VIP Priority"),
        ("At Risk High-Value", 0.0, "MEDIUM", False, "Cross-Category"),
        ("x", 1.0, "LOW", False, "Standard Nurture"),
        ("x", 1.0, "odd", False, "Standard Nurture"),
        ("vip", 1.0, "odd", True, "Standard Nurture"),
        (None, None, "HIGH", False, "Automated Digital"),
    ],
)
def test_plays(spark, segment, spend, tier, high, title):
    got = _recommend(spark, segment=segment, lifetime_value=spend, risk_tier=tier)
    assert got["is_high_value"] == high and got["action_title"].startswith(title)


def test_tier_uses_the_rounded_probability_in_the_table_and_the_raw_one_per_customer(spark):
    rows = spark.createDataFrame([("a", 0.69996, 10.0, 1.0, 1, 10.0)], "customer_unique_id string, p double, monetary_total double, recency_days double, order_frequency int, avg_order_value double")
    assert scoring.risk_table(rows, "p").first()["risk_tier"] == "HIGH"
    sheet = scoring.customer_report(rows, probability="p").first()
    assert sheet["risk_tier"] == "MEDIUM" and sheet["churn_probability"] == 0.7
    assert sheet["segment"] == "Standard" and sheet["lead_factor"] == "High inactivity"
    assert scoring.customer_report(rows, customer="zz", probability="p").count() == 0


def test_kpis_of_nothing(spark):
    monthly = spark.createDataFrame([], "net_revenue double, total_orders long")
    risk = spark.createDataFrame([], "churn_probability double, risk_tier string, frequency long")
    got = scoring.exec_kpis(monthly, risk).first().asDict()
    assert all(v == 0 for v in got.values())


def test_audience_filters_are_optional(spark):
    risk = spark.createDataFrame([("HIGH", "a", 5.0), ("LOW", "b", 50.0)], "risk_tier string, segment string, lifetime_value double")
    assert scoring.audience(risk).count() == 2
    assert scoring.audience(risk, ["All"]).count() == 2
    assert scoring.audience(risk, ["HIGH"], min_spend=6.0).count() == 0
    assert scoring.audience(risk, segment="b").first()["risk_tier"] == "LOW"


def test_stored_scores_are_pruned_and_joined_in_place(spark, tmp_path):
    """One customer's sheet reads one bucket; scores and segments of equal buckets join without an exchange."""
    from keepwell.sources import writers

    spark.sql(f"CREATE DATABASE IF NOT EXISTS scores_test LOCATION '{tmp_path}/s'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        scored = spark.range(500).select(
            F.col("id").alias("customer_unique_id"), (F.col("id") / 500).alias("probability_raw"), F.lit(10.0).alias("monetary_total"),
            F.lit(3.0).alias("recency_days"), F.lit(2).alias("order_frequency"),
        )
        segments = scored.select("customer_unique_id", F.lit("Champions").alias("cluster_segment"), F.lit("Loyal").alias("rfm_segment"))
        stored = writers.write_bucketed(scored, "scores_test.scores", buckets=8)
        named = writers.write_bucketed(segments, "scores_test.segments", buckets=8)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        both = stored.join(named, "customer_unique_id")
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert both.count() == 500
        sheet = scoring.customer_report(both, 77)
        plan = sheet._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 8" in plan and "Exchange" not in plan
        (row,) = sheet.collect()
        assert (row.customer_id, row.churn_probability, row.segment) == (77, 0.154, "Champions")
        assert stored.filter("customer_unique_id = 77").inputFiles() and len(stored.inputFiles()) <= 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE IF EXISTS scores_test CASCADE")
