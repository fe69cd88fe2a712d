"""From the raw export to the nine typed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from keepwell.functions.exprs import city_name, parse_instant, state_code, strict_number
from keepwell.sources.schemas import EXTRA_TRANSLATIONS, UNKNOWN_CATEGORY


MONEY = "decimal(18,2)"


def clean_lookup(
    lookup: DataFrame,
    extra: Sequence[tuple[str, str]] = EXTRA_TRANSLATIONS,
    key: str = "product_category_name",
    value: str = "product_category_name_english",
) -> DataFrame:
    """Append the extra pairs; a key that is already there keeps its own value."""
    spark = lookup.sparkSession
    added = spark.createDataFrame(list(extra), f"{key} string, {value} string")
    both = lookup.select(key, value, F.lit(0).alias("_order")).unionByName(
        added.select(key, value, F.lit(1).alias("_order"))
    )
    return (
        both.groupBy(key)
        .agg(F.min(F.struct("_order", value)).alias("_first"))
        .select(key, F.col(f"_first.{value}").alias(value))
        .orderBy(key)
    )


def clean_products(
    products: DataFrame, lookup: DataFrame, unknown: str = UNKNOWN_CATEGORY
) -> DataFrame:
    """Fill the category, add its English name, repair two misspelt column names."""
    filled = products.withColumn(
        "product_category_name", F.coalesce("product_category_name", F.lit(unknown))
    )
    pairs = lookup.select("product_category_name", "product_category_name_english")
    return (
        filled.join(pairs, "product_category_name", "left")
        .fillna(unknown, ["product_category_name_english"])
        .withColumnsRenamed(
            {
                "product_name_lenght": "product_name_length",
                "product_description_lenght": "product_description_length",
            }
        )
    )


def clean_geolocation(readings: DataFrame, prefix: str = "geolocation_zip_code_prefix") -> DataFrame:
    """One row per postal prefix: mean position, most frequent city and state.

    Equal frequencies go to the smallest name.  Readings are counted per
    (prefix, city, state) first, so a prefix with very many readings is
    reduced before it reaches one task.
    """
    known = readings.filter(F.col(prefix).isNotNull())
    lat, lng = F.col("geolocation_lat"), F.col("geolocation_lng")
    names = known.groupBy(prefix, "geolocation_city", "geolocation_state").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(lat).alias("lat_sum"),
        F.count(lat).alias("lat_n"),
        F.sum(lng).alias("lng_sum"),
        F.count(lng).alias("lng_n"),
    )
    means = names.groupBy(prefix).agg(
        F.try_divide(F.sum("lat_sum").cast("double"), F.sum("lat_n").cast("double")).alias("latitude"),
        F.try_divide(F.sum("lng_sum").cast("double"), F.sum("lng_n").cast("double")).alias("longitude"),
    )
    city = _most_frequent(names, prefix, "geolocation_city")
    state = _most_frequent(names, prefix, "geolocation_state")
    return (
        means.join(city, prefix, "left")
        .join(state, prefix, "left")
        .select(
            prefix,
            "latitude",
            "longitude",
            city_name("geolocation_city").alias("city"),
            state_code("geolocation_state").alias("state"),
        )
    )


def _most_frequent(names: DataFrame, prefix: str, column: str) -> DataFrame:
    return (
        names.filter(F.col(column).isNotNull())
        .groupBy(prefix, column)
        .agg(F.sum("n").alias("n"))
        .groupBy(prefix)
        .agg(F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias(column))
    )


def clean_locations(df: DataFrame, city: str, state: str) -> DataFrame:
    """Title-case city, upper-case state, both stripped (customers and sellers)."""
    return df.withColumns({city: city_name(city), state: state_code(state)})


def clean_orders(
    orders: DataFrame,
    instants: Sequence[str] = (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
) -> DataFrame:
    """Parse the instants; unreadable ones become NULL, none are made up."""
    return orders.withColumns({c: parse_instant(c) for c in instants if c in orders.columns})


def clean_order_items(items: DataFrame) -> DataFrame:
    return items.withColumns(
        {
            "shipping_limit_date": parse_instant("shipping_limit_date"),
            "price": strict_number("price", MONEY),
            "freight_value": strict_number("freight_value", MONEY),
        }
    )


def clean_payments(payments: DataFrame) -> DataFrame:
    """Counts are mandatory integers; amounts are money."""
    return payments.withColumns(
        {
            "payment_value": strict_number("payment_value", MONEY),
            "payment_installments": strict_number("payment_installments", "int", required=True),
            "payment_sequential": strict_number("payment_sequential", "int", required=True),
        }
    )


def clean_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.withColumns(
        {
            "review_creation_date": parse_instant("review_creation_date"),
            "review_answer_timestamp": parse_instant("review_answer_timestamp"),
            "review_score": strict_number("review_score", "int", required=True),
        }
    ).fillna("", ["review_comment_title", "review_comment_message"])


def clean_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All nine tables from the raw roles."""
    lookup = clean_lookup(raw["category_translation"])
    return {
        "dim_category_translation": lookup,
        "dim_products": clean_products(raw["products"], lookup),
        "dim_geolocation": clean_geolocation(raw["geolocation"]),
        "dim_customers": clean_locations(raw["customers"], "customer_city", "customer_state"),
        "dim_sellers": clean_locations(raw["sellers"], "seller_city", "seller_state"),
        "fact_orders": clean_orders(raw["orders"]),
        "fact_order_items": clean_order_items(raw["order_items"]),
        "fact_order_payments": clean_payments(raw["payments"]),
        "fact_order_reviews": clean_reviews(raw["reviews"]),
    }


# -- remediation -------------------------------------------------------------

def remediate_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per item key, positive price and quantity, known order and product.

    Of several copies the one with the smallest remaining columns is kept, so
    the choice is repeatable.  Outliers stay.
    """
    rest = [c for c in items.columns if c not in ("order_id", "order_item_id")]
    return (
        items.groupBy("order_id", "order_item_id")
        .agg(F.min(F.struct(*rest)).alias("_kept"))
        .select("order_id", "order_item_id", *[F.col(f"_kept.{c}").alias(c) for c in rest])
        .filter((F.col("price") > 0) & (F.col("quantity") > 0))
        .join(orders.select("order_id"), "order_id", "left_semi")
        .join(products.select("product_id"), "product_id", "left_semi")
        .select(*items.columns)
    )


def remediate_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Known customers only; a delivery before the purchase becomes unknown."""
    delivered = F.col("order_delivered_customer_date")
    return (
        orders.join(customers.select("customer_id"), "customer_id", "left_semi")
        .withColumn(
            "order_delivered_customer_date",
            F.when(delivered >= F.col("order_purchase_timestamp"), delivered),
        )
        .select(*orders.columns)
    )
