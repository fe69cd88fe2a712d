"""The nine role tables derived from TPC-H-like tables, so every job can be checked.

Columns the source lacks are computed from ones it has (statuses from status
and priority, delivery and review dates from keys), always for all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.functions.exprs import plus_days
from keepwell.operators.cleaning import clean_geolocation


# fixed values: the source tables, declared so that opening a file needs no job
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{folder}/{name}.parquet")


def role_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    orders = source(spark, folder, "orders")
    lineitem = source(spark, folder, "lineitem")
    customer = source(spark, folder, "customer")
    supplier = source(spark, folder, "supplier")
    part = source(spark, folder, "part")
    nation = source(spark, folder, "nation")
    region = source(spark, folder, "region")

    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    status, priority, key = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey")
    first_digit = F.substring("o_orderpriority", 1, 1)
    price = F.col("l_extendedprice").cast("decimal(12,2)")

    translation = (
        part.select("p_type")
        .distinct()
        .filter(F.col("p_type") != "PROMO")
        .select(
            F.col("p_type").alias("product_category_name"),
            F.concat(F.lower("p_type"), F.lit("_goods")).alias("product_category_name_english"),
        )
    )
    # several order-scoped ids belong to one person, orders have one or two payments and reviews
    geolocation = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("geolocation_lat"),
        F.col("c_custkey").cast("decimal(12,2)").alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
    )

    def numbered(often) -> DataFrame:
        return orders.withColumn("n", F.explode(F.sequence(F.lit(1), F.when(often, 2).otherwise(1))))

    first = F.col("n") == 1
    return {
        "fact_orders": orders.select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(status == "F", "delivered")
            .when(status == "O", "shipped")
            .when(priority == "5-LOW", "canceled")
            .when(priority == "4-NOT SPECIFIED", "unavailable")
            .otherwise("processing")
            .alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.when(status == "F", plus_days("o_orderdate", ((key * 7) % 45).cast("int"))).alias(
                "order_delivered_customer_date"
            ),
            plus_days("o_orderdate", 25).alias("order_estimated_delivery_date"),
        ),
        "fact_order_items": lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
            (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)").alias("freight_value"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (price * F.col("l_discount").cast("decimal(4,2)"))
            .cast("decimal(18,4)")
            .alias("discount_amount"),
        ),
        "dim_customers": customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"),
            F.expr("c_custkey * 2 div 3").alias("customer_unique_id"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.col("r_name").alias("customer_state"),
        ),
        "dim_category_translation": translation,
        "dim_products": part.join(
            translation, F.col("p_type") == F.col("product_category_name"), "left"
        ).select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.coalesce("product_category_name_english", F.lit("unknown_category")).alias(
                "product_category_name_english"
            ),
            F.col("p_brand").alias("product_brand"),
        ),
        "fact_order_payments": numbered(key % 4 == 0).select(
            key.alias("order_id"),
            F.col("n").alias("payment_sequential"),
            F.when(first & first_digit.isin("1", "2", "3"), "credit_card")
            .when(first & (first_digit == "4"), "boleto")
            .otherwise("voucher")
            .alias("payment_type"),
            F.when(first, first_digit.cast("int")).otherwise(1).alias("payment_installments"),
            F.when(first, F.col("o_totalprice")).otherwise(F.lit(5.0) + key % 7).cast("decimal(18,2)").alias("payment_value"),
        ),
        # some reviews carry no score
        "fact_order_reviews": numbered(key % 5 == 0).select(
            (key * 2 + F.col("n")).alias("review_id"),
            key.alias("order_id"),
            F.when(key % 10 != 0, (1 + (key * F.col("n") * 3) % 5).cast("int")).alias("review_score"),
            plus_days("o_orderdate", ((key * 11 * F.col("n")) % 60).cast("int")).alias("review_creation_date"),
        ),
        "dim_sellers": supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.col("r_name").alias("seller_state"),
        ),
        "geolocation": geolocation,
        "dim_geolocation": clean_geolocation(geolocation),
    }
