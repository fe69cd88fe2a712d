"""The nine tables: columns, keys, references and expected sizes."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()
_TS, _MONEY = T.TimestampNTZType(), T.DecimalType(18, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


# --- fixed values: the cleaned star schema ----------------------------------
TABLES: dict[str, T.StructType] = {
    "dim_category_translation": _table(
        product_category_name=_S,
        product_category_name_english=_S,
    ),
    "dim_products": _table(
        product_id=_S,
        product_category_name=_S,
        product_category_name_english=_S,
        product_name_length=_I,
        product_description_length=_I,
        product_photos_qty=_I,
        product_weight_g=_D,
        product_length_cm=_D,
        product_height_cm=_D,
        product_width_cm=_D,
    ),
    "dim_geolocation": _table(
        geolocation_zip_code_prefix=_I,
        latitude=_D,
        longitude=_D,
        city=_S,
        state=_S,
    ),
    "dim_customers": _table(
        customer_id=_S,
        customer_unique_id=_S,
        customer_zip_code_prefix=_I,
        customer_city=_S,
        customer_state=_S,
    ),
    "dim_sellers": _table(
        seller_id=_S,
        seller_zip_code_prefix=_I,
        seller_city=_S,
        seller_state=_S,
    ),
    "fact_orders": _table(
        order_id=_S,
        customer_id=_S,
        order_status=_S,
        order_purchase_timestamp=_TS,
        order_approved_at=_TS,
        order_delivered_carrier_date=_TS,
        order_delivered_customer_date=_TS,
        order_estimated_delivery_date=_TS,
    ),
    "fact_order_items": _table(
        order_id=_S,
        order_item_id=_I,
        product_id=_S,
        seller_id=_S,
        shipping_limit_date=_TS,
        price=_MONEY,
        freight_value=_MONEY,
    ),
    "fact_order_payments": _table(
        order_id=_S,
        payment_sequential=_I,
        payment_type=_S,
        payment_installments=_I,
        payment_value=_MONEY,
    ),
    "fact_order_reviews": _table(
        review_id=_S,
        order_id=_S,
        review_score=_I,
        review_comment_title=_S,
        review_comment_message=_S,
        review_creation_date=_TS,
        review_answer_timestamp=_TS,
    ),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "dim_category_translation": ["product_category_name"],
    "dim_products": ["product_id"],
    "dim_geolocation": ["geolocation_zip_code_prefix"],
    "dim_customers": ["customer_id"],
    "dim_sellers": ["seller_id"],
    "fact_orders": ["order_id"],
    "fact_order_items": ["order_id", "order_item_id"],
    "fact_order_payments": ["order_id", "payment_sequential"],
    "fact_order_reviews": ["review_id", "order_id"],
}

# child table, child column, parent table, parent column
REFERENCES: list[tuple[str, str, str, str]] = [
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
    ("fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    ("fact_order_payments", "order_id", "fact_orders", "order_id"),
    ("fact_order_reviews", "order_id", "fact_orders", "order_id"),
]

MINIMUM_ROWS: dict[str, int] = {
    "dim_category_translation": 70,
    "dim_products": 30000,
    "dim_geolocation": 15000,
    "dim_customers": 90000,
    "dim_sellers": 3000,
    "fact_orders": 90000,
    "fact_order_items": 100000,
    "fact_order_payments": 100000,
    "fact_order_reviews": 90000,
}

# Raw export.  Files are found by this part of their name, whatever prefix the
# exporter used; instants stay text until cleaning, so a bad one becomes NULL.
RAW_FILES: dict[str, str] = {
    "customers": "customers",
    "orders": "orders",
    "order_items": "order_items",
    "payments": "order_payments",
    "products": "products",
    "reviews": "order_reviews",
    "sellers": "sellers",
    "geolocation": "geolocation",
    "category_translation": "category_name_translation",
}

RAW_TABLES: dict[str, T.StructType] = {
    "customers": TABLES["dim_customers"],
    "orders": _table(
        order_id=_S,
        customer_id=_S,
        order_status=_S,
        order_purchase_timestamp=_S,
        order_approved_at=_S,
        order_delivered_carrier_date=_S,
        order_delivered_customer_date=_S,
        order_estimated_delivery_date=_S,
    ),
    "order_items": _table(
        order_id=_S,
        order_item_id=_I,
        product_id=_S,
        seller_id=_S,
        shipping_limit_date=_S,
        price=_MONEY,
        freight_value=_MONEY,
    ),
    "payments": TABLES["fact_order_payments"],
    "products": _table(
        product_id=_S,
        product_category_name=_S,
        product_name_lenght=_I,
        product_description_lenght=_I,
        product_photos_qty=_I,
        product_weight_g=_D,
        product_length_cm=_D,
        product_height_cm=_D,
        product_width_cm=_D,
    ),
    "reviews": _table(
        review_id=_S,
        order_id=_S,
        review_score=_I,
        review_comment_title=_S,
        review_comment_message=_S,
        review_creation_date=_S,
        review_answer_timestamp=_S,
    ),
    "sellers": TABLES["dim_sellers"],
    "geolocation": _table(
        geolocation_zip_code_prefix=_I,
        geolocation_lat=_D,
        geolocation_lng=_D,
        geolocation_city=_S,
        geolocation_state=_S,
    ),
    "category_translation": TABLES["dim_category_translation"],
}

# category names the translation file lacks
EXTRA_TRANSLATIONS = [
    ("pc_gamer", "pc_gamer"),
    (
        "portateis_cozinha_e_preparadores_de_alimentos",
        "small_appliances_kitchen_and_food_preparers",
    ),
    ("unknown_category", "unknown_category"),
]
UNKNOWN_CATEGORY = "unknown_category"

DIMENSIONS_FIRST = [
    "dim_category_translation",
    "dim_products",
    "dim_geolocation",
    "dim_customers",
    "dim_sellers",
    "fact_orders",
    "fact_order_items",
    "fact_order_payments",
    "fact_order_reviews",
]
# --- end of fixed values ----------------------------------------------------


def create_table_sql(name: str, provider: str = "parquet") -> str:
    """CREATE TABLE text for one of the nine tables; key columns are NOT NULL."""
    keys = PRIMARY_KEYS[name]
    columns = ",\n  ".join(
        f"{f.name} {f.dataType.simpleString()}{' NOT NULL' if f.name in keys else ''}"
        for f in TABLES[name]
    )
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {columns}\n) USING {provider}"
