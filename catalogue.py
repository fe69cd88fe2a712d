"""Every registered query: name -> (spark, folder of test tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.functions.exprs import rounded
from keepwell.functions.rules import RFM_SHORT_RULES
from keepwell.operators import cleaning, neighbours, quality, sampling
from keepwell.plans import attribution, cohorts, modelling, panel, revenue, rfm, scoring, segmentation
from keepwell.plans import metrics as metric
from keepwell.plans import playbook as plays
from keepwell.session import materialize
from keepwell.settings import FEATURES, LEGACY_INACTIVE_STATUSES, Snapshot
from keepwell.sources import readers, writers
from keepwell.sources.schemas import REFERENCES
from keepwell.sources.star import role_tables, source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# dates that suit the test tables (orders run from 1995 to 2001)
SNAPSHOTS = (
    Snapshot("S1", "1998-01-01", "train"),
    Snapshot("S2", "1999-01-01", "train"),
    Snapshot("S3", "2000-01-01", "val"),
    Snapshot("S4", "2001-01-01", "test"),
)
CUTOFF = "2001-01-01"

# fixed values: a linear score to explain
COEFFICIENTS = {
    "recency_days": 0.004,
    "order_frequency": -0.21,
    "monetary_total": -0.000002,
    "avg_review_score": -0.35,
    "last_60d_orders": -0.4,
    "spending_trend_velocity": -0.15,
    "avg_delivery_delay_days": 0.03,
}


def query(run):
    """Register under the function's name; the function gets the role tables."""

    def call(spark: SparkSession, folder: str) -> DataFrame:
        return run(role_tables(spark, folder))

    QUERIES[run.__name__] = call
    return run


def raw_query(run):
    """Register a query that reads the given tables as they are."""
    QUERIES[run.__name__] = run
    return run


# -- reports -----------------------------------------------------------------

@query
def monthly_revenue(t):
    return revenue.monthly_revenue(t["fact_orders"], t["dim_customers"], t["fact_order_items"])


@query
def monthly_revenue_net(t):
    return revenue.monthly_revenue_net(t["fact_orders"], t["fact_order_items"])


@query
def eda_monthly(t):
    return revenue.eda_monthly(t["fact_orders"], t["fact_order_items"])


@query
def category_performance(t):
    return revenue.category_performance(t["fact_order_items"], t["dim_products"], t["fact_orders"])


@query
def category_discount(t):
    return revenue.category_discount(t["fact_order_items"], t["dim_products"], t["fact_orders"])


@query
def eda_categories(t):
    return revenue.eda_categories(t["fact_order_items"], t["dim_products"])


@query
def top_customers(t):
    return revenue.top_customers(t["dim_customers"], t["fact_orders"], t["fact_order_items"])


@query
def top_customers_net(t):
    return revenue.top_customers_net(t["dim_customers"], t["fact_orders"], t["fact_order_items"])


def _spend(t):
    return revenue.customer_spend(t["dim_customers"], t["fact_orders"], t["fact_order_items"])


@query
def spend_quartiles(t):
    return revenue.spend_quartiles(_spend(t))


@query
def spend_quartiles_net(t):
    spend = revenue.customer_spend(
        t["dim_customers"],
        t["fact_orders"],
        t["fact_order_items"],
        revenue.net_revenue(),
        "customer_id",
        LEGACY_INACTIVE_STATUSES,
    )
    return revenue.spend_quartiles(spend, "customer_id")


@query
def pareto_share(t):
    return revenue.pareto_share(_spend(t))


@query
def purchase_gaps(t):
    return revenue.purchase_gaps(t["fact_orders"])


@raw_query
def event_gaps(spark, folder):
    events = source(spark, folder, "events").select(
        "user_id", F.col("ts").alias("order_purchase_timestamp"), F.lit("done").alias("order_status")
    )
    return revenue.purchase_gaps(events, customer="user_id")


@query
def cohort_retention(t):
    return cohorts.cohort_retention(t["fact_orders"], t["dim_customers"])


@query
def cohort_retention_legacy(t):
    return cohorts.cohort_retention(
        t["fact_orders"], customer="customer_id", excluded=LEGACY_INACTIVE_STATUSES
    )


@query
def cohort_matrix(t):
    return cohorts.cohort_matrix(cohorts.cohort_retention(t["fact_orders"], t["dim_customers"]))


# -- RFM ---------------------------------------------------------------------

def rfm_frame(t, **options):
    return rfm.rfm(t["fact_orders"], t["fact_order_items"], t["dim_customers"], CUTOFF, **options)


QUERIES["rfm"] = lambda spark, folder: rfm_frame(role_tables(spark, folder))


@query
def rfm_short_rules(t):
    return rfm_frame(t, rules=RFM_SHORT_RULES)


@query
def rfm_ntile(t):
    return rfm.rfm_ntile(t["fact_orders"], t["fact_order_items"], t["dim_customers"], CUTOFF)


@query
def rfm_describe(t):
    return rfm.describe(
        rfm.rfm_values(t["fact_orders"], t["fact_order_items"], t["dim_customers"], CUTOFF)
    )


# -- cleaning ----------------------------------------------------------------

@query
def clean_lookup(t):
    return cleaning.clean_lookup(t["dim_category_translation"])


@raw_query
def clean_products(spark, folder):
    lookup = cleaning.clean_lookup(role_tables(spark, folder)["dim_category_translation"])
    raw = source(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_type")).alias("product_category_name"),
        F.col("p_size").alias("product_name_lenght"),
    )
    return cleaning.clean_products(raw, lookup)


@query
def clean_geo(t):
    return cleaning.clean_geolocation(t["geolocation"])


@raw_query
def clean_locations(spark, folder):
    nation = source(spark, folder, "nation")
    buyers = source(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    sellers = source(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    blank, place = F.lit("  "), F.lower("n_name")
    both = buyers.select(
        F.lit("customer").alias("kind"),
        F.col("c_custkey").alias("id"),
        F.concat(blank, F.lower("c_mktsegment"), F.lit("-d'oeste ")).alias("city"),
        F.concat(blank, place, F.lit(" ")).alias("state"),
    ).unionByName(
        sellers.select(
            F.lit("seller").alias("kind"),
            F.col("s_suppkey").alias("id"),
            F.concat(blank, place, F.lit(" do sul")).alias("city"),
            F.concat(place, F.lit(" ")).alias("state"),
        )
    )
    return cleaning.clean_locations(both, "city", "state")


@raw_query
def clean_orders(spark, folder):
    key = F.col("o_orderkey")
    raw = source(spark, folder, "orders").select(
        key.alias("order_id"),
        F.when(key % 97 == 0, "unknown")
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("order_purchase_timestamp"),
        F.when(key % 89 == 0, "2001-13-45")
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("order_approved_at"),
    )
    return cleaning.clean_orders(raw)


@raw_query
def clean_reviews(spark, folder):
    doc = F.col("doc_id")
    raw = source(spark, folder, "documents").select(
        doc.alias("review_id"),
        (1 + doc % 5).cast("string").alias("review_score"),
        F.col("lang").alias("review_comment_title"),
        F.when(doc % 3 != 0, F.col("text")).alias("review_comment_message"),
        F.lit(None).cast("string").alias("review_creation_date"),
        F.lit(None).cast("string").alias("review_answer_timestamp"),
    )
    return cleaning.clean_reviews(raw).drop("review_creation_date", "review_answer_timestamp")


@query
def clean_payments(t):
    as_text = t["fact_order_payments"].withColumns(
        {c: F.col(c).cast("string") for c in ("payment_sequential", "payment_installments", "payment_value")}
    )
    return cleaning.clean_payments(as_text)


@query
def remediate_items(t):
    return cleaning.remediate_items(t["fact_order_items"], t["fact_orders"], t["dim_products"])


@query
def remediate_orders(t):
    shipped = t["fact_order_items"].groupBy("order_id").agg(
        F.min("shipping_limit_date").alias("order_delivered_customer_date")
    )
    # every eleventh order names a customer that does not exist
    customer = F.when(F.col("order_id") % 11 == 0, -F.col("order_id")).otherwise(F.col("customer_id"))
    orders = (
        t["fact_orders"]
        .select("order_id", customer.alias("customer_id"), "order_purchase_timestamp")
        .join(shipped, "order_id")
    )
    return cleaning.remediate_orders(orders, t["dim_customers"])


# -- data quality ------------------------------------------------------------

def _checked(t):
    return {n: df for n, df in t.items() if n != "geolocation"}


@query
def dq_row_counts(t):
    return quality.check_row_counts(_checked(t))


@query
def dq_primary_keys(t):
    return quality.check_primary_keys(_checked(t))


# more references to check, some of which do not hold; the last child key is often NULL
EXTRA_REFERENCES = [
    ("events", "user_id", "dim_customers", "customer_id"),
    ("dim_customers", "customer_id", "fact_orders", "customer_id"),
    ("dim_products", "product_id", "fact_order_items", "product_id"),
    ("embeddings", "vec_id", "documents", "doc_id"),
    ("fact_orders", "order_delivered_customer_date", "fact_orders", "order_purchase_timestamp"),
]


def _referenced(spark, folder):
    given = {n: source(spark, folder, n) for n in ("events", "embeddings", "documents")}
    return {**_checked(role_tables(spark, folder)), **given}


@raw_query
def dq_orphans(spark, folder):
    return quality.orphans(_referenced(spark, folder), [*REFERENCES, *EXTRA_REFERENCES])


@raw_query
def dq_orphans_sql(spark, folder):
    return quality.orphans(
        _referenced(spark, folder), [*REFERENCES, *EXTRA_REFERENCES], null_is_orphan=True
    )


@query
def load_report(t):
    return writers.load_report(_checked(t))


@query
def dq_money(t):
    return quality.check_money(t["fact_order_items"], t["fact_order_payments"])


@query
def dq_time(t):
    # unavailable orders have no purchase time here
    bought = F.when(F.col("order_status") != "unavailable", F.col("order_purchase_timestamp"))
    shipped = t["fact_order_items"].select("order_id", "shipping_limit_date").join(
        t["fact_orders"].select("order_id", bought.alias("order_purchase_timestamp")), "order_id", "left"
    )
    return quality.check_time(shipped, end="shipping_limit_date")


@query
def dq_suite(t):
    return quality.run_suite(_checked(t))


@query
def dq_nulls(t):
    return quality.null_counts(t["fact_orders"])


@query
def dq_items(t):
    return quality.audit_items(t["fact_order_items"])


# -- panels ------------------------------------------------------------------

def panel_frame(t, lookback=None):
    return panel.churn_panel(t, SNAPSHOTS, lookback)


@query
def churn_panel(t):
    return panel_frame(t)


@query
def churn_panel_180(t):
    return panel_frame(t, 180)


@query
def churn_panel_365(t):
    return panel_frame(t, 365)


@query
def panel_extras(t):
    return panel.panel_extras(t, SNAPSHOTS)


@query
def lookback_compare(t):
    return panel.lookback_summary(panel.lookback_panels(t, SNAPSHOTS))


@query
def target_report(t):
    return panel.target_report(panel_frame(t))


@query
def snapshot_frequency(t):
    return panel.snapshot_frequency(panel_frame(t))


@query
def leakage_audit(t):
    return panel.leakage_audit(panel.lookback_panels(t, SNAPSHOTS, (180, 365, None), instants=True))


@query
def feature_stats(t):
    return panel.feature_stats(panel_frame(t))


@query
def feature_nulls(t):
    return quality.null_counts(panel_frame(t), FEATURES)


@query
def delay_churn(t):
    return panel.delay_churn(panel_frame(t))


@query
def dormancy(t):
    return panel.dormancy(t["fact_orders"], t["dim_customers"], panel_frame(t))


@query
def split_sizes(t):
    return panel_frame(t).groupBy("split_role").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_churned").cast("bigint")).alias("churned")
    )


@raw_query
def panel_sql(spark, folder):
    return readers.run_sql(
        spark,
        "SELECT order_status, count(*) AS orders FROM fact_orders "
        "WHERE order_purchase_timestamp < CAST(:cutoff AS TIMESTAMP_NTZ) GROUP BY order_status",
        {"fact_orders": role_tables(spark, folder)["fact_orders"]},
        {"cutoff": CUTOFF},
    )


# -- metrics and thresholds on a fixed score ---------------------------------

def scored_panel(t):
    """The panel with a closed-form score in place of a model's probability."""
    mixed = F.col("order_frequency") * 37 + F.col("total_quantity") * 11 + F.floor("monetary_total")
    return panel_frame(t).withColumn("p", (mixed % 1000).cast("double") / 1000.0)


@query
def metrics(t):
    measured = metric.binary_metrics(
        materialize(scored_panel(t).select("split_role", "is_churned", "p")), "is_churned", "p", by=["split_role"]
    )
    shares = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "pr_auc", "brier_score", "specificity"]
    return measured.withColumns({c: rounded(c, 8) for c in shares})


@query
def roc_points(t):
    return metric.roc_points(scored_panel(t), "is_churned", "p", by=["split_role"])


@query
def pr_points(t):
    return metric.pr_points(scored_panel(t), "is_churned", "p", by=["split_role"])


@query
def confusion_table(t):
    return metric.confusion_table(scored_panel(t), "is_churned", "p")


@query
def threshold_sweep(t):
    return metric.threshold_sweep(scored_panel(t), "is_churned", "p")


@query
def frozen_threshold(t):
    scored = materialize(scored_panel(t).select("split_role", "is_churned", "p"))
    return metric.frozen_threshold(scored, "is_churned", "p")


# -- segments and the risk table ---------------------------------------------

def clustered_rfm(t):
    """RFM with a fixed cluster per customer in place of K-means."""
    return rfm_frame(t).withColumn("cluster_id", F.col("customer_unique_id") % 4)


def named_segments(t):
    clustered = materialize(clustered_rfm(t))
    return segmentation.name_clusters(clustered, segmentation.cluster_profile(clustered))


def risk_frame(t):
    current = scored_panel(t).filter(F.col("split_role") == "test")
    return scoring.risk_table(current, "p", named_segments(t))


@query
def risk_table(t):
    return risk_frame(t)


@query
def crm_audience(t):
    return scoring.audience(risk_frame(t), ["HIGH", "MEDIUM"], "Champions & High-Value VIPs", 1000.0)


@query
def campaign_roi(t):
    return metric.campaign_roi(risk_frame(t))


@query
def roi_curve(t):
    return metric.roi_curve(risk_frame(t))


@query
def exec_kpis(t):
    monthly = revenue.monthly_revenue(t["fact_orders"], t["dim_customers"], t["fact_order_items"])
    return scoring.exec_kpis(monthly, risk_frame(t))


@query
def tier_distribution(t):
    return scoring.distribution(risk_frame(t), "risk_tier")


@query
def segment_distribution(t):
    return scoring.distribution(named_segments(t), "rfm_segment")


@query
def segment_cards(t):
    return scoring.segment_cards(named_segments(t))


@query
def cluster_profile(t):
    return segmentation.cluster_profile(materialize(clustered_rfm(t)))


@query
def segment_sample(t):
    chosen = sampling.seeded_sample(named_segments(t), "customer_unique_id", 2000, 42)
    return chosen.select("customer_unique_id", "recency", "frequency", "monetary", "cluster_segment")


@query
def silhouette(t):
    return segmentation.silhouettes(clustered_rfm(t), segmentation.RFM_COLUMNS, ["cluster_id"])


@query
def silhouette_euclidean(t):
    return segmentation.euclidean_silhouettes(clustered_rfm(t), segmentation.RFM_COLUMNS, ["cluster_id"])


# -- splits, folds, neighbours -----------------------------------------------

def train_rows(t):
    return modelling.with_row_id(panel_frame(t).filter(F.col("split_role") == "train"))


@query
def fold_balance(t):
    folded = sampling.stratified_folds(train_rows(t), "is_churned", "row_id", 5, 42)
    return folded.groupBy("fold", "is_churned").agg(F.count(F.lit(1)).alias("n"))


@query
def fallback_split(t):
    current = materialize(panel_frame(t).filter(F.col("split_role") == "test")).drop("split_role")
    parts = modelling.split(current)
    counted = [
        df.groupBy("split_role", "is_churned").agg(F.count(F.lit(1)).alias("n")) for df in parts.values()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def minority_neighbours(t):
    few = panel_frame(t).filter((F.col("split_role") == "test") & (F.col("is_churned") == 0))
    found = neighbours.nearest(few, FEATURES, "customer_unique_id", 5, 42)
    return found.select(
        F.col("row_id").alias("customer_unique_id"), F.posexplode("near").alias("place", "near")
    ).select(
        "customer_unique_id",
        (F.col("place") + 1).cast("bigint").alias("place"),
        rounded("near.distances", 6).alias("distance"),
    )


@query
def smote_balance(t):
    rows = neighbours.synthetic_minority(materialize(train_rows(t)), FEATURES, "is_churned", "row_id")
    return rows.groupBy("is_churned").agg(F.count(F.lit(1)).alias("rows"))


# -- explanations and recommendations ----------------------------------------

def tested_rows(t):
    return materialize(panel_frame(t).filter(F.col("split_role") == "test"))


@query
def linear_attribution(t):
    rows = tested_rows(t)
    impacts = attribution.linear_impacts(COEFFICIENTS, attribution.feature_means(rows, list(COEFFICIENTS)))
    factors = attribution.top_factors(impacts, {f: F.col(f) for f in COEFFICIENTS}, 5)
    return (
        rows.select("customer_unique_id", F.posexplode(factors).alias("place", "f"))
        .select(
            "customer_unique_id",
            (F.col("place") + 1).cast("bigint").alias("place"),
            "f.feature",
            rounded("f.value", 6).alias("value"),
            rounded("f.shap_impact", 6).alias("shap_impact"),
            "f.direction",
        )
    )


@query
def global_importance(t):
    return attribution.global_linear_importance(tested_rows(t), COEFFICIENTS)


@query
def playbook(t):
    """Spend is scaled down for two thirds of the customers, so every play occurs."""
    risk = risk_frame(t)
    spend = F.when(F.col("customer_unique_id") % 3 == 0, F.col("lifetime_value")).otherwise(
        F.col("lifetime_value") / 10000
    )
    mixed = risk.withColumn("lifetime_value", rounded(spend, 2))
    return plays.recommend(mixed, factor="rfm_segment")


# -- fitted models -----------------------------------------------------------

_FITTED: dict[tuple, object] = {}


def _once(name: str, spark, folder: str, make):
    """Several queries report on the same fitted model; fit it once per session and folder."""
    key = (name, spark.sparkContext.applicationId, folder)
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def champion(spark, folder):
    def make():
        return modelling.train_champion(materialize(panel_frame(role_tables(spark, folder))))

    return _once("champion", spark, folder, make)[0]


@raw_query
def tuned_model(spark, folder):
    """The whole grid of 16 settings, 3 folds each; the champion queries use the best."""
    champion(spark, folder)
    return _once("champion", spark, folder, None)[1]


def segmented(spark, folder):
    def make():
        customers, profile, model = segmentation.segment_customers(rfm_frame(role_tables(spark, folder)))
        return customers, profile, model

    return _once("segments", spark, folder, make)


def current_rows(spark, folder):
    return _once("current", spark, folder, lambda: tested_rows(role_tables(spark, folder)))


@raw_query
def segments(spark, folder):
    return segmented(spark, folder)[0]


@raw_query
def segment_profiles(spark, folder):
    return segmented(spark, folder)[1]


@query
def cluster_eval(t):
    return segmentation.evaluate_k(rfm_frame(t))


@raw_query
def champion_holdout(spark, folder):
    return champion(spark, folder).metrics


@raw_query
def champion_thresholds(spark, folder):
    return champion(spark, folder).thresholds


@raw_query
def champion_frozen_threshold(spark, folder):
    return champion(spark, folder).frozen


@raw_query
def batch_scores(spark, folder):
    scored = champion(spark, folder).model.transform(current_rows(spark, folder))
    return scoring.risk_table(scored, "probability", segmented(spark, folder)[0])


@raw_query
def tree_attribution(spark, folder):
    return attribution.tree_attribution(current_rows(spark, folder), champion(spark, folder).model).select(
        "customer_unique_id", F.posexplode("important_factors").alias("place", "f")
    ).select("customer_unique_id", "place", "f.*")


@raw_query
def tree_importance(spark, folder):
    return attribution.global_tree_importance(current_rows(spark, folder), champion(spark, folder).model)


@raw_query
def customer_reports(spark, folder):
    model = champion(spark, folder).model
    scored = model.transform(current_rows(spark, folder), probability="probability_raw")
    explained = attribution.tree_attribution(
        scored, model, top_n=4, keep=["probability_raw", "monetary_total", "recency_days", "order_frequency"]
    ).join(
        segmented(spark, folder)[0].select("customer_unique_id", "cluster_segment", "rfm_segment"),
        "customer_unique_id",
        "left",
    )
    return scoring.customer_report(explained, factors="important_factors")


@query
def model_compare(t):
    return modelling.compare_models(materialize(panel_frame(t).filter(F.col("split_role") == "train")))


@query
def holdout_comparison(t):
    """Four candidates fitted on train and measured on test; the fit time is left out, as it never repeats."""
    parts = modelling.split(materialize(panel_frame(t)))
    return modelling.holdout_comparison(parts["train"], parts["test"]).drop("fit_time_sec")
