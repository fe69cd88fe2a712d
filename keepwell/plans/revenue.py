"""Revenue, category, customer and purchase-gap reports.

Items are summed per order before they meet the orders, so an order or
customer with very many items is reduced before the join.  Orders are counted as
distinct ids on that reduced frame, so order rows that were loaded twice count once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from keepwell.functions.exprs import counts_as_sale, month_text, ratio, rounded
from keepwell.operators.activity import gaps
from keepwell.operators.ordering import ntile_ends, quantile_bins, share_rank
from keepwell.session import materialize
from keepwell.settings import INACTIVE_STATUSES, LEGACY_INACTIVE_STATUSES


def net_revenue() -> Column:
    """price x quantity - discount, exact in decimals."""
    return F.col("price") * F.col("quantity") - F.col("discount_amount")


def discount_rate() -> Column:
    """Discount as a share of list value; the small constant keeps free items defined."""
    listed = F.col("price").cast("double") * F.col("quantity") + F.lit(0.0001)
    return F.col("discount_amount").cast("double") / listed


def sales(orders: DataFrame, excluded: Sequence[str] = INACTIVE_STATUSES) -> DataFrame:
    return orders.filter(counts_as_sale("order_status", excluded))


def per_order(items: DataFrame, **sums: Column) -> DataFrame:
    """One row per order with item count and the requested sums."""
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("items"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
    )


def _growth(monthly: DataFrame, value: str) -> DataFrame:
    """Previous month and growth; the frame has one row per month, so one task is enough."""
    previous = F.lag(value).over(W.orderBy("order_month"))
    return monthly.withColumn("prev_month_revenue", previous).withColumn(
        "mom_growth_pct",
        rounded(ratio(F.col(value) - F.col("prev_month_revenue"), "prev_month_revenue") * 100.0, 2),
    )


def monthly_revenue(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    excluded: Sequence[str] = INACTIVE_STATUSES,
) -> DataFrame:
    """Orders, customers, item and total revenue per month with growth on the month before."""
    totals = per_order(
        items, item_sum=F.col("price"), gross_sum=F.col("price") + F.col("freight_value")
    )
    monthly = (
        sales(orders, excluded)
        .select("order_id", "customer_id", month_text("order_purchase_timestamp").alias("order_month"))
        .join(totals, "order_id")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("order_month")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_unique_id").alias("unique_customers"),
            rounded(F.sum("item_sum"), 2).alias("item_revenue"),
            rounded(F.sum("gross_sum"), 2).alias("net_revenue"),
        )
    )
    return _growth(monthly, "net_revenue").orderBy("order_month")


def monthly_revenue_net(
    orders: DataFrame, items: DataFrame, excluded: Sequence[str] = LEGACY_INACTIVE_STATUSES
) -> DataFrame:
    """The same on net revenue after discounts; counts order-scoped customer ids."""
    totals = per_order(items, net_sum=net_revenue())
    monthly = (
        sales(orders, excluded)
        .select("order_id", "customer_id", month_text("order_purchase_timestamp").alias("order_month"))
        .join(totals, "order_id")
        .groupBy("order_month")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
            rounded(F.sum("net_sum"), 2).alias("net_revenue"),
        )
    )
    return _growth(monthly, "net_revenue").orderBy("order_month")


def eda_monthly(
    orders: DataFrame, items: DataFrame, excluded: Sequence[str] = LEGACY_INACTIVE_STATUSES
) -> DataFrame:
    """month, revenue, orders."""
    return (
        sales(orders, excluded)
        .select("order_id", month_text("order_purchase_timestamp").alias("month"))
        .join(per_order(items, item_sum=F.col("price")), "order_id")
        .groupBy("month")
        .agg(rounded(F.sum("item_sum"), 2).alias("revenue"), F.count_distinct("order_id").alias("orders"))
        .orderBy("month")
    )


def _market(categories: DataFrame) -> DataFrame:
    """Share and rank over one row per category."""
    return categories.withColumn(
        "revenue_share_pct",
        rounded(ratio("category_revenue", F.sum("category_revenue").over(W.partitionBy(F.lit(0)))) * 100.0, 2),
    ).withColumn(
        "revenue_rank", F.dense_rank().over(W.orderBy(F.desc("category_revenue"))).cast("bigint")
    )


def _sold_by_category(
    items: DataFrame, products: DataFrame, orders: DataFrame, category: Column, **sums: Column
) -> DataFrame:
    """One row per (order, category) of the given orders, with the sums."""
    named = products.select("product_id", category.alias("category_name"))
    return (
        items.join(named, "product_id")
        .groupBy("order_id", "category_name")
        .agg(*[F.sum(c).alias(n) for n, c in sums.items()])
        .join(orders.select("order_id"), "order_id")
    )


def category_performance(
    items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    excluded: Sequence[str] = INACTIVE_STATUSES,
) -> DataFrame:
    """Revenue, units, mean price and freight, revenue share and rank per category."""
    one = F.lit(1)
    sold = _sold_by_category(
        items,
        products,
        sales(orders, excluded),
        F.coalesce("product_category_name_english", F.lit("unknown_category")),
        units=F.when(F.col("order_item_id").isNotNull(), one).otherwise(0),
        price_sum=F.col("price"),
        priced=F.when(F.col("price").isNotNull(), one).otherwise(0),
        freight_sum=F.col("freight_value"),
        freighted=F.when(F.col("freight_value").isNotNull(), one).otherwise(0),
    )
    categories = sold.groupBy("category_name").agg(
        F.count_distinct("order_id").alias("orders_count"),
        F.sum("units").alias("units_sold"),
        rounded(F.sum("price_sum"), 2).alias("category_revenue"),
        rounded(ratio(F.sum("price_sum"), F.sum("priced")), 2).alias("avg_item_price"),
        rounded(ratio(F.sum("freight_sum"), F.sum("freighted")), 2).alias("avg_freight"),
    )
    return _market(categories).orderBy(F.desc("category_revenue"), "category_name")


def category_discount(
    items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    excluded: Sequence[str] = LEGACY_INACTIVE_STATUSES,
    category: str = "product_category_name_english",
) -> DataFrame:
    """Net revenue, units and mean discount rate per category."""
    rate = discount_rate().cast("decimal(18,10)")
    sold = _sold_by_category(
        items,
        products,
        sales(orders, excluded),
        F.col(category),
        units=F.col("quantity"),
        net_sum=net_revenue(),
        rate_sum=rate,
        rated=F.when(rate.isNotNull(), 1).otherwise(0),
    )
    categories = sold.groupBy("category_name").agg(
        F.count_distinct("order_id").alias("orders_count"),
        F.sum("units").alias("units_sold"),
        rounded(F.sum("net_sum"), 2).alias("category_revenue"),
        rounded(ratio(F.sum("rate_sum"), F.sum("rated")) * 100.0, 2).alias("avg_discount_pct"),
    )
    return _market(categories).orderBy(F.desc("category_revenue"), "category_name")


def eda_categories(items: DataFrame, products: DataFrame) -> DataFrame:
    """Exploration view: all orders, price revenue, item rows and mean discount rate."""
    rate = discount_rate().cast("decimal(18,10)")
    return (
        items.join(products.select("product_id", "product_category_name_english"), "product_id")
        .groupBy("product_category_name_english")
        .agg(
            rounded(F.sum("price"), 2).alias("category_revenue"),
            F.count("order_item_id").alias("total_units"),
            rounded(ratio(F.sum(rate), F.count(rate)) * 100.0, 2).alias("avg_discount_pct"),
        )
        .orderBy(F.desc("category_revenue"))
    )


def _top(spend: DataFrame, total: str, ids: Sequence[str], limit: int) -> DataFrame:
    """Largest first; ranking only the kept rows is enough for a dense rank."""
    kept = spend.orderBy(F.desc(total), *ids).limit(limit)
    return kept.withColumn(
        "customer_rank", F.dense_rank().over(W.orderBy(F.desc(total))).cast("bigint")
    ).orderBy(F.desc(total), *ids)


def top_customers(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    limit: int = 25,
    excluded: Sequence[str] = INACTIVE_STATUSES,
) -> DataFrame:
    """Top spenders per person and place; equal spend goes to the smaller id."""
    place = ["customer_unique_id", "customer_state", "customer_city"]
    totals = per_order(
        items, spend=F.col("price"), priced=F.when(F.col("price").isNotNull(), 1).otherwise(0)
    )
    spend = (
        sales(orders, excluded)
        .select("order_id", "customer_id")
        .join(totals, "order_id")
        .join(customers.select("customer_id", *place), "customer_id")
        .groupBy(*place)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("items").alias("total_items"),
            rounded(F.sum("spend"), 2).alias("total_spend"),
            rounded(ratio(F.sum("spend"), F.sum("priced")), 2).alias("avg_item_spend"),
        )
    )
    return _top(spend, "total_spend", place, limit)


def top_customers_net(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    limit: int = 10,
    excluded: Sequence[str] = LEGACY_INACTIVE_STATUSES,
) -> DataFrame:
    """Top spenders on net revenue per order-scoped customer."""
    place = ["customer_id", "customer_city", "customer_state"]
    net = net_revenue()
    totals = per_order(items, spent=net, lines=F.when(net.isNotNull(), 1).otherwise(0))
    spend = (
        sales(orders, excluded)
        .select("order_id", "customer_id")
        .join(totals, "order_id")
        .join(customers.select(*place), "customer_id")
        .groupBy(*place)
        .agg(
            F.count_distinct("order_id").alias("lifetime_orders"),
            rounded(F.sum("spent"), 2).alias("total_spent"),
            rounded(ratio(F.sum("spent"), F.sum("lines")), 2).alias("avg_spend_per_order"),
        )
    )
    return _top(spend, "total_spent", place, limit)


def customer_spend(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    amount: Column | None = None,
    customer: str = "customer_unique_id",
    excluded: Sequence[str] = INACTIVE_STATUSES,
) -> DataFrame:
    """customer, total_spend (rounded), order_count."""
    totals = per_order(items, spend=F.col("price") if amount is None else amount)
    ids = [c for c in dict.fromkeys(["customer_id", customer])]
    return (
        sales(orders, excluded)
        .select("order_id", "customer_id")
        .join(totals, "order_id")
        .join(customers.select(*ids), "customer_id")
        .groupBy(customer)
        .agg(
            F.round(F.sum("spend"), 2).cast("decimal(28,2)").alias("total_spend"),
            F.count_distinct("order_id").alias("order_count"),
        )
    )


def spend_quartiles(spend: DataFrame, customer: str = "customer_unique_id") -> DataFrame:
    """Customers in four equal groups by spend, largest spenders first."""
    binned = quantile_bins(
        materialize(spend), {"spend_quartile": -F.col("total_spend")}, customer, 4, ntile_ends
    )
    return (
        binned.groupBy(F.col("spend_quartile").cast("bigint").alias("spend_quartile"))
        .agg(
            F.count(customer).alias("customer_count"),
            rounded(F.sum("total_spend"), 2).alias("group_total_spend"),
            rounded(ratio(F.sum("total_spend"), F.count("total_spend")), 2).alias("group_avg_spend"),
            rounded(ratio(F.sum("order_count"), F.count("order_count")), 2).alias("group_avg_orders"),
        )
        .orderBy("spend_quartile")
    )


def pareto_share(
    spend: DataFrame, share: float = 0.15, customer: str = "customer_unique_id"
) -> DataFrame:
    """What part of all revenue the top ``share`` of customers brings."""
    top = F.col("in_top")
    return share_rank(spend, F.col("total_spend"), customer, share).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(top).alias("top_customers"),
        F.sum("total_spend").cast("double").alias("total_revenue"),
        F.coalesce(F.sum(F.when(top, F.col("total_spend"))), F.lit(0)).cast("double").alias("top_revenue"),
        rounded(ratio(F.sum(F.when(top, F.col("total_spend"))), F.sum("total_spend")) * 100.0, 2).alias(
            "top_share_pct"
        ),
    )


def purchase_gaps(
    orders: DataFrame,
    limit: int = 15,
    excluded: Sequence[str] = LEGACY_INACTIVE_STATUSES,
    customer: str = "customer_id",
) -> DataFrame:
    """Days between consecutive orders for the customers with most repeat orders."""
    found = gaps(sales(orders, excluded), customer, "order_purchase_timestamp")
    return (
        found.select(
            customer,
            F.col("gap_count").alias("repeat_orders_count"),
            rounded(ratio("gap_sum", "gap_count"), 1).alias("avg_days_between_orders"),
            F.col("gap_min").cast("double").alias("min_days_between_orders"),
            F.col("gap_max").cast("double").alias("max_days_between_orders"),
        )
        .orderBy(F.desc("repeat_orders_count"), customer)
        .limit(limit)
    )
