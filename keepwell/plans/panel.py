"""Point-in-time customer features and churn labels for many snapshots at once.

The orders any window can see come first; items, payments and reviews are cut to these
orders and summed to one row per order.  An order is then repeated for the windows it falls
into, and one aggregation on (customer, window) yields all features and the label.  Items,
payments and reviews are each scanned once, whatever the number of snapshots and lookbacks; the orders'
dates decide, without a further scan of the facts, which rows are needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from keepwell.functions.exprs import (
    MICROS_PER_DAY,
    as_column,
    at_least,
    days_between,
    instant,
    micros_between,
    not_excluded,
    plus_days,
    ratio,
    rounded,
)
from keepwell.operators.activity import second_order_within
from keepwell.operators.selection import moments_and_quantiles
from keepwell.settings import (
    FEATURE_DEFAULTS,
    FEATURES,
    INACTIVE_STATUSES,
    LOOKBACKS,
    SNAPSHOTS,
    TARGET,
    Snapshot,
)

_MASK_BITS = 62
_PAYMENT_SUMS = {"credit_card": "card_sum", "boleto": "boleto_sum", "voucher": "voucher_sum"}


@dataclass(frozen=True)
class _Window:
    """One observation window: [start, snapshot), and the label window [snapshot, end]."""

    snapshot: Snapshot
    snapshot_no: int
    lookback: int | None

    def _shift(self, days: int) -> Column:
        return instant(str(datetime.fromisoformat(self.snapshot.date) + timedelta(days=days)))

    @property
    def at(self) -> Column:
        return instant(self.snapshot.date)

    def observes(self, ts: Column) -> Column:
        before = ts < self.at
        return before if self.lookback is None else before & (ts >= self._shift(-self.lookback))

    def labels(self, ts: Column) -> Column:
        return ts.between(self.at, self._shift(self.snapshot.horizon_days))


def _windows(snapshots: Sequence[Snapshot], lookbacks: Sequence[int | None]) -> list[_Window]:
    return [_Window(s, i, lb) for lb in lookbacks for i, s in enumerate(snapshots)]


def _in_reach(ts: Column, windows: Sequence[_Window], labels: bool) -> Column:
    """Plain bounds that hold for every row any window needs; these reach the file scan."""
    ends = [datetime.fromisoformat(w.snapshot.date) for w in windows]
    if labels:
        last = max(e + timedelta(days=w.snapshot.horizon_days) for e, w in zip(ends, windows))
        reach = ts <= instant(str(last))
    else:
        reach = ts < instant(str(max(ends)))
    if all(w.lookback is not None for w in windows):
        first = min(e - timedelta(days=w.lookback) for e, w in zip(ends, windows))
        reach = reach & (ts >= instant(str(first)))
    return reach


def _per_window(windows: Sequence[_Window], value) -> Column:
    """value(window) picked by the row's ``window_no``."""
    return F.element_at(F.array(*[value(w) for w in windows]), F.col("window_no") + 1)


def _order_grain(
    tables: Mapping[str, DataFrame], snapshots: Sequence[Snapshot], windows: Sequence[_Window]
) -> tuple[DataFrame, list[str]]:
    """One row per order with its customer and the sums of its items, payments and reviews,
    and the names of its category masks.

    ``copies`` says how often the order row was loaded: sums count each copy, as a join to the
    order rows would, and the order itself counts once.
    """
    bought = F.col("order_purchase_timestamp")
    orders = (
        tables["fact_orders"]
        .filter(_in_reach(bought, windows, labels=True))
        .select(
            "order_id",
            "customer_id",
            "order_status",
            F.col("order_purchase_timestamp").alias("ts"),
            F.col("order_delivered_customer_date").alias("delivered"),
            F.col("order_estimated_delivery_date").alias("estimated"),
        )
        # everything up to the customers is keyed on the order, so this is the only shuffle of orders until then
        .repartition("order_id")
        .groupBy("order_id", "customer_id", "order_status", "ts", "delivered", "estimated")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    # facts matter only where a window observes the order
    observed = (
        tables["fact_orders"].filter(_in_reach(bought, windows, labels=False)).select("order_id").repartition("order_id")
    )

    def facts(name: str) -> DataFrame:
        return tables[name].join(observed, "order_id", "left_semi")

    slots, n_masks = _category_slots(tables["dim_products"])
    masks = [f"mask_{i}" for i in range(n_masks)]
    items = (
        facts("fact_order_items")
        .select("order_id", "order_item_id", "product_id", "price", "freight_value")
        .join(slots, "product_id", "left")
        .groupBy("order_id")
        .agg(
            F.sum("price").alias("price_sum"),
            F.count("order_item_id").alias("item_count"),
            F.sum("freight_value").alias("freight_sum"),
            F.count("freight_value").alias("freight_count"),
            *[F.bit_or(F.when(F.col("mask_no") == i, F.col("bit"))).alias(m) for i, m in enumerate(masks)],
        )
    )
    payments = facts("fact_order_payments").groupBy("order_id").agg(
        F.sum("payment_value").alias("paid_sum"),
        *[
            F.sum(F.when(F.col("payment_type") == kind, F.col("payment_value"))).alias(name)
            for kind, name in _PAYMENT_SUMS.items()
        ],
        F.sum("payment_installments").cast("bigint").alias("installment_sum"),
        F.count("payment_installments").alias("installment_count"),
    )
    # a review counts only at snapshots after its creation: one sum per snapshot
    seen = [F.col("review_creation_date") < instant(s.date) for s in snapshots]
    reviews = facts("fact_order_reviews").groupBy("order_id").agg(
        *[F.sum(F.when(c, F.col("review_score"))).alias(f"review_sum_{i}") for i, c in enumerate(seen)],
        *[F.count(F.when(c, F.col("review_score"))).alias(f"review_count_{i}") for i, c in enumerate(seen)],
        *[F.max(F.when(c, F.col("review_creation_date"))).alias(f"review_last_{i}") for i, c in enumerate(seen)],
    )
    customers = tables["dim_customers"].select("customer_id", "customer_unique_id")
    grain = (
        orders.join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .join(reviews, "order_id", "left")
        .join(customers, "customer_id")
    )
    return grain, masks


def _category_slots(products: DataFrame) -> tuple[DataFrame, int]:
    """product_id with the mask and the bit of its category, and the number of masks.

    Categories are a short list next to the products; each gets a bit, so that the distinct categories
    of any set of orders are a bitwise or.
    """
    named = products.select("product_id", F.col("product_category_name_english").alias("category"))
    names = named.filter(F.col("category").isNotNull()).select("category").distinct()
    # a list of names, not of products: one task numbers it
    numbered = names.select("category", (F.row_number().over(W.orderBy("category")) - 1).alias("slot"))
    slots = named.join(numbered, "category").select(
        "product_id",
        F.floor(F.col("slot") / _MASK_BITS).alias("mask_no"),
        F.expr(f"shiftleft(1L, cast(slot % {_MASK_BITS} as int))").alias("bit"),
    )
    return slots, max(1, -(-names.count() // _MASK_BITS))


def lookback_panels(
    tables: Mapping[str, DataFrame],
    snapshots: Sequence[Snapshot] = SNAPSHOTS,
    lookbacks: Sequence[int | None] = LOOKBACKS,
    extras: bool = False,
    instants: bool = False,
) -> DataFrame:
    """Panels for several lookbacks in one pass; adds ``lookback_days`` (NULL = all time).

    With ``instants`` each row also has the latest purchase, delivery and review that went into its sums and
    the number of deliveries left out because they lie after the snapshot.
    """
    windows = _windows(snapshots, lookbacks)
    ts = F.col("ts")
    sold = not_excluded("order_status", INACTIVE_STATUSES)
    # an order either is observed by a window or lies in its label period
    seen_by = F.explode(
        F.array(
            *[
                F.when(w.observes(ts) | (w.labels(ts) & sold), F.lit(k))
                for k, w in enumerate(windows)
            ]
        )
    )
    grain, masks = _order_grain(tables, snapshots, windows)
    rows = (
        grain.select("*", seen_by.alias("window_no"))
        .filter(F.col("window_no").isNotNull())
        .withColumn("at", _per_window(windows, lambda w: w.at))
        .withColumn("observed", ts < F.col("at"))
    )
    snapshot_no = _per_window(windows, lambda w: F.lit(w.snapshot_no)) + 1
    n = len(snapshots)
    review_sum = F.element_at(F.array(*[F.col(f"review_sum_{i}") for i in range(n)]), snapshot_no)
    review_count = F.element_at(F.array(*[F.col(f"review_count_{i}") for i in range(n)]), snapshot_no)
    seen = F.col("observed")
    days_ago = micros_between("ts", "at")

    def within(days: int) -> Column:
        return seen & (days_ago <= days * MICROS_PER_DAY)

    # a delivery on or after the snapshot is not known yet
    delay = F.when(seen & (F.col("delivered") < F.col("at")), micros_between("estimated", "delivered"))

    def total(c: str | Column, condition: Column = seen) -> Column:
        return F.sum(F.when(condition, as_column(c) * F.col("copies")))

    extra_sums = _extra_aggregates(seen, total, delay) if extras else {}
    if instants:
        review_last = F.element_at(F.array(*[F.col(f"review_last_{i}") for i in range(n)]), snapshot_no)
        extra_sums |= {
            "last_purchase": F.max(F.when(seen, ts)),
            "last_delivery": F.max(F.when(delay.isNotNull(), F.col("delivered"))),
            "last_review": F.max(F.when(seen, review_last)),
            "hidden_deliveries": total(F.lit(1), seen & (F.col("delivered") >= F.col("at"))),
        }
    sums = rows.groupBy("customer_unique_id", "window_no").agg(
        F.min(F.when(seen, ts)).alias("first_ts"),
        F.max(F.when(seen, ts)).alias("last_ts"),
        F.count_if(seen).alias("order_frequency"),
        total("price_sum").alias("price_sum"),
        total("item_count").alias("total_quantity"),
        total("freight_sum").alias("freight_sum"),
        total("freight_count").alias("freight_count"),
        total("paid_sum").alias("paid_sum"),
        total("card_sum").alias("card_sum"),
        total("installment_sum").alias("installment_sum"),
        total("installment_count").alias("installment_count"),
        total(review_sum).alias("review_sum"),
        total(review_count).alias("review_count"),
        F.count_if(seen & (F.col("order_status") == "canceled")).alias("cancelled_orders_cnt"),
        F.count_if(within(30)).alias("last_30d_orders"),
        F.count_if(within(60)).alias("last_60d_orders"),
        total("price_sum", within(60)).alias("recent_sum"),
        total(delay).alias("delay_sum"),
        total(delay.isNotNull().cast("int")).alias("delay_count"),
        *[F.bit_or(F.when(seen, F.col(m))).alias(m) for m in masks],
        F.max((~seen).cast("int")).alias("returned"),
        *[c.alias(name) for name, c in extra_sums.items()],
    )
    joined = (
        sums.filter(F.col("order_frequency") > 0)
        .withColumn("category_diversity", _distinct_bits(masks))
        .withColumn("at", _per_window(windows, lambda w: w.at))
        .withColumn("recency_days", days_between("last_ts", "at"))
        .withColumn("customer_tenure_days", days_between("first_ts", "at"))
        .withColumn("monetary_total", F.col("price_sum").cast("double"))
    )
    freight = F.col("freight_sum").cast("double")
    usual = F.col("monetary_total") / at_least("customer_tenure_days", 60.0) * 60.0
    features = {
        "avg_order_value": F.col("monetary_total") / at_least("order_frequency", 1.0),
        "avg_freight_value": ratio("freight_sum", "freight_count"),
        "freight_ratio": freight / at_least(F.col("price_sum") + F.col("freight_sum"), 0.01),
        "avg_review_score": ratio("review_sum", "review_count"),
        "credit_card_share": F.col("card_sum").cast("double") / at_least("paid_sum", 0.01),
        "avg_installments": ratio("installment_sum", "installment_count"),
        "spending_trend_velocity": F.col("recent_sum").cast("double") / at_least(usual, 1.0),
        "avg_delivery_delay_days": ratio("delay_sum", "delay_count") / F.lit(float(MICROS_PER_DAY)),
    }
    labelled = joined.withColumns(features).fillna(FEATURE_DEFAULTS)
    out = labelled.select(
        "customer_unique_id",
        *FEATURES,
        (1 - F.col("returned")).alias(TARGET),
        _per_window(windows, lambda w: F.lit(w.snapshot.date)).alias("snapshot_date"),
        _per_window(windows, lambda w: F.lit(w.snapshot.role)).alias("split_role"),
        _per_window(windows, lambda w: F.lit(w.lookback).cast("int")).alias("lookback_days"),
        *(_extra_features() if extras else []),
        *(INSTANTS if instants else []),
    )
    return out


INSTANTS = ["last_purchase", "last_delivery", "last_review", "hidden_deliveries"]


def _distinct_bits(masks: Sequence[str]) -> Column:
    """How many bits are set in all masks; NULL where there is none, as without any named category."""
    counts = [F.bit_count(F.coalesce(F.col(m), F.lit(0).cast("bigint"))) for m in masks]
    number = reduce(Column.__add__, counts)
    return F.when(number > 0, number.cast("bigint"))


def churn_panel(
    tables: Mapping[str, DataFrame],
    snapshots: Sequence[Snapshot] = SNAPSHOTS,
    lookback_days: int | None = None,
) -> DataFrame:
    """customer_unique_id, the 17 features, is_churned, snapshot_date, split_role."""
    return lookback_panels(tables, snapshots, [lookback_days]).drop("lookback_days")


# -- documented extras -------------------------------------------------------

def _extra_aggregates(seen: Column, total, delay: Column) -> dict[str, Column]:
    return {
        "max_order_sum": F.max(F.when(seen, F.col("price_sum"))),
        "boleto_sum": total("boleto_sum"),
        "voucher_sum": total("voucher_sum"),
        "late_delivery_count": F.count_if(delay > 0),
    }


def _extra_features() -> list[Column]:
    return [
        F.coalesce(F.col("max_order_sum").cast("double"), F.lit(0.0)).alias("max_order_value"),
        ratio("total_quantity", "order_frequency").alias("items_per_order"),
        F.coalesce(ratio("price_sum", "total_quantity"), F.lit(0.0)).alias("avg_item_price"),
        F.coalesce(F.col("boleto_sum").cast("double") / at_least("paid_sum", 0.01), F.lit(0.0)).alias(
            "pct_boleto"
        ),
        F.coalesce(F.col("voucher_sum").cast("double") / at_least("paid_sum", 0.01), F.lit(0.0)).alias(
            "pct_voucher"
        ),
        F.col("late_delivery_count"),
        days_between("first_ts", "last_ts").alias("customer_lifetime_days"),
    ]


def panel_extras(
    tables: Mapping[str, DataFrame], snapshots: Sequence[Snapshot] = SNAPSHOTS
) -> DataFrame:
    """The additional customer measures per snapshot, by the same window rules."""
    names = [
        "max_order_value",
        "items_per_order",
        "avg_item_price",
        "pct_boleto",
        "pct_voucher",
        "late_delivery_count",
        "customer_lifetime_days",
    ]
    return lookback_panels(tables, snapshots, [None], extras=True).select(
        "customer_unique_id",
        F.col("snapshot_date").alias("snapshot_id"),
        *names,
    )


# -- reports on panels -------------------------------------------------------

def _label_counts(panel: DataFrame, by: list[str]) -> DataFrame:
    churned = F.sum(F.col(TARGET).cast("bigint"))
    rows = F.count(F.lit(1))
    grouped = panel.groupBy(*by).agg(rows.alias("observations"), churned.alias("churned"))
    rate = rounded(ratio("churned", "observations") * 100.0, 2)
    return grouped.select(
        *by,
        "observations",
        (F.col("observations") - F.col("churned")).alias("retained"),
        "churned",
        rate.alias("churn_rate_pct"),
        rounded(100.0 - ratio("churned", "observations") * 100.0, 2).alias("retention_rate_pct"),
    )


def target_report(panel: DataFrame) -> DataFrame:
    """Label counts per snapshot, per split and overall: scope, name, counts and rates.

    The panel is read once; the totals are built from its few (snapshot, split) counts.
    """
    cells = panel.groupBy("snapshot_date", "split_role").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(TARGET).cast("bigint")).alias("churn")
    )
    one_by_one = cells.groupingSets(
        [["snapshot_date"], ["split_role"], []], "snapshot_date", "split_role"
    ).agg(
        F.sum("rows").alias("observations"),
        F.sum("churn").alias("churned"),
        F.grouping("snapshot_date").alias("_no_snapshot"),
        F.grouping("split_role").alias("_no_split"),
    )
    share = ratio("churned", "observations") * 100.0
    scope = F.when(F.col("_no_snapshot") == 0, "snapshot").when(F.col("_no_split") == 0, "split")
    return one_by_one.select(
        scope.otherwise("overall").alias("scope"),
        F.coalesce("snapshot_date", "split_role", F.lit("all")).alias("name"),
        "observations",
        (F.col("observations") - F.col("churned")).alias("retained"),
        "churned",
        rounded(share, 2).alias("churn_rate_pct"),
        rounded(100.0 - share, 2).alias("retention_rate_pct"),
    )


def snapshot_frequency(panel: DataFrame) -> DataFrame:
    """How many customers appear in 1, 2, .. snapshots."""
    return (
        panel.groupBy("customer_unique_id")
        .agg(F.count("snapshot_date").alias("snapshots"))
        .groupBy("snapshots")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy("snapshots")
    )


def target_document(panel: DataFrame, snapshots: Sequence[Snapshot] = SNAPSHOTS) -> DataFrame:
    """The target-quality report as one nested row, ready for ``write_json``."""
    counts = ["observations", "retained", "churned", "churn_rate_pct", "retention_rate_pct"]

    def listed(df: DataFrame, name: str) -> Column:
        # a handful of rows: one per snapshot, split or frequency
        return df.agg(F.sort_array(F.collect_list(F.struct(name, *[c for c in df.columns if c != name])))).scalar()

    return (
        _label_counts(panel, [])
        .withColumn("num_snapshots", F.lit(len(snapshots)))
        .withColumn("unique_customers", panel.agg(F.count_distinct("customer_unique_id")).scalar())
        .withColumn("customer_snapshot_frequency", listed(snapshot_frequency(panel), "snapshots"))
        .withColumn("snapshots", listed(_label_counts(panel, ["snapshot_date", "split_role"]), "snapshot_date"))
        .withColumn("splits", listed(_label_counts(panel, ["split_role"]), "split_role"))
        .select("num_snapshots", "unique_customers", *counts, "customer_snapshot_frequency", "snapshots", "splits")
    )


def lookback_summary(panels: DataFrame) -> DataFrame:
    """Per lookback: panel size, customers, label counts per split, and loss against all time."""
    key = F.coalesce(F.col("lookback_days").cast("string"), F.lit("all")).alias("lookback")
    per_role = [
        c
        for role in ("train", "val", "test")
        for c in (
            F.count_if(F.col("split_role") == role).alias(f"{role}_obs"),
            F.count_if((F.col("split_role") == role) & (F.col(TARGET) == 0)).alias(f"{role}_retained"),
            rounded(
                ratio(
                    F.count_if((F.col("split_role") == role) & (F.col(TARGET) == 1)),
                    F.count_if(F.col("split_role") == role),
                )
                * 100.0,
                2,
            ).alias(f"{role}_churn_pct"),
        )
    ]
    sizes = panels.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_panel_obs"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        *per_role,
    )

    def of_all_time(c: str) -> Column:
        # one row per lookback
        return F.max(F.when(F.col("lookback") == "all", F.col(c))).over(W.partitionBy(F.lit(0)))

    return (
        sizes.withColumn("observations_lost", of_all_time("total_panel_obs") - F.col("total_panel_obs"))
        .withColumn("customers_dropped", of_all_time("unique_customers") - F.col("unique_customers"))
        .orderBy("lookback")
    )


def leakage_audit(panels: DataFrame) -> DataFrame:
    """Per window of panels with ``instants``: latest purchase used, whether anything used lies on or after the
    snapshot (a purchase, delivery or review, or a negative recency), deliveries hidden.

    It looks at what entered the rows' sums, not at a filter of its own, so a fault of the panel shows.
    """
    at = F.col("snapshot_date").cast("timestamp_ntz")
    late = [F.coalesce(F.col(c) >= at, F.lit(False)) for c in ("last_purchase", "last_delivery", "last_review")]
    future = reduce(Column.__or__, late, F.col("recency_days") < 0)
    return (
        panels.groupBy("snapshot_date", "lookback_days")
        .agg(
            F.max("last_purchase").alias("max_purchase_timestamp"),
            F.max(future.cast("int")).alias("future_purchase_detected"),
            F.sum(F.coalesce("hidden_deliveries", F.lit(0))).alias("clamped_future_deliveries"),
        )
        .select("snapshot_date", "lookback_days", "max_purchase_timestamp", "future_purchase_detected", "clamped_future_deliveries")
        .orderBy("lookback_days", "snapshot_date")
    )


def feature_stats(panel: DataFrame, features: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """feature, mean, std, median, min, max, zero_pct: exact, rounded as in the audit."""
    found = moments_and_quantiles(panel, features, {"median": 0.5}, "feature")
    return found.select(
        "feature",
        rounded("mean", 4).alias("mean"),
        rounded("std", 4).alias("std"),
        rounded("median", 4).alias("median"),
        rounded("low", 4).alias("min"),
        rounded("high", 4).alias("max"),
        rounded(ratio("zeros", "n") * 100.0, 2).alias("zero_pct"),
    )


# -- documented relations between behaviour and churn ------------------------

def delay_churn(panel: DataFrame, days: float = 3.0) -> DataFrame:
    """Churn share of customers whose mean delivery delay is above ``days``, and of the rest."""
    flag = (F.col("avg_delivery_delay_days") > days).cast("int").alias("late")
    return (
        panel.groupBy(flag)
        .agg(F.count(F.lit(1)).alias("observations"), F.sum(F.col(TARGET).cast("bigint")).alias("churned"))
        .withColumn("churn_rate_pct", rounded(ratio("churned", "observations") * 100.0, 2))
        .orderBy("late")
    )


def dormancy(
    orders: DataFrame, customers: DataFrame, panel: DataFrame, days: int = 60
) -> DataFrame:
    """Churn share of customers with and without a second order within ``days`` days of the first.

    Only what was known at the snapshot counts: rows whose ``days`` days were not over by then
    are left out, and so are orders on or after the snapshot.
    """
    dated = orders.select("customer_id", "order_purchase_timestamp").join(
        customers.select("customer_id", "customer_unique_id"), "customer_id"
    )
    second = second_order_within(dated, "customer_unique_id", "order_purchase_timestamp", days)
    at = F.col("snapshot_date").cast("timestamp_ntz")
    known = (F.col("has_second_order") == 1) & (F.col("same_day") | (F.col("next_ts") < at))
    return (
        panel.join(second, "customer_unique_id")
        .filter(plus_days("first_ts", days) <= at)
        .groupBy(F.coalesce(known, F.lit(False)).cast("int").alias("has_second_order"))
        .agg(F.count(F.lit(1)).alias("observations"), F.sum(F.col(TARGET).cast("bigint")).alias("churned"))
        .withColumn("churn_rate_pct", rounded(ratio("churned", "observations") * 100.0, 2))
        .orderBy("has_second_order")
    )
