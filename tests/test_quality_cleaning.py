import pytest

from keepwell.operators import cleaning, quality
from keepwell.sources import readers, writers
from keepwell.sources.schemas import PRIMARY_KEYS, RAW_FILES, RAW_TABLES, TABLES, create_table_sql


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_orphans_with_and_without_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    tables, refs = {"c": child, "p": parent}, [("c", "k", "p", "k")]
    assert quality.orphans(tables, refs).first()["orphan_count"] == 2
    assert quality.orphans(tables, refs, null_is_orphan=True).first()["orphan_count"] == 3


def test_duplicate_and_null_keys(spark):
    t = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (None, 2), (None, 2), (3, None)], "a int, b int")
    got = quality.check_primary_keys({"t": t}, {"t": ["a", "b"]}).first()
    assert (got["duplicate_rows"], got["null_rows"]) == (3, 3)
    empty = quality.check_primary_keys({"t": t.limit(0)}, {"t": ["a", "b"]}).first()
    assert (empty["duplicate_rows"], empty["null_rows"]) == (0, 0)


def test_suite_fails_on_errors_only(spark):
    ts = "timestamp'2018-01-01 00:00:00'"
    tables = {
        "dim_customers": spark.sql("SELECT 'c' AS customer_id"),
        "dim_products": spark.sql("SELECT 'p' AS product_id"),
        "dim_sellers": spark.sql("SELECT 's' AS seller_id"),
        "fact_orders": spark.sql(f"SELECT 'o' AS order_id, 'c' AS customer_id, {ts} AS order_purchase_timestamp, {ts} - interval 1 day AS order_delivered_customer_date"),
        "fact_order_items": spark.sql("SELECT 'o' AS order_id, 1 AS order_item_id, 'p' AS product_id, 's' AS seller_id, 1.0 AS price, 0.0 AS freight_value"),
        "fact_order_payments": spark.sql("SELECT 'o' AS order_id, 1 AS payment_sequential, 0.0 AS payment_value"),
    }
    fine = quality.run_suite(tables, minimums={"fact_orders": 1})
    found = {r["check_name"]: r["severity"] for r in fine.collect()}
    assert found["zero_payment"] == "warning" and found["end_before_start"] == "warning"
    quality.require_valid(fine)
    broken = quality.run_suite({**tables, "dim_sellers": tables["dim_sellers"].limit(0)}, minimums={"fact_orders": 5})
    with pytest.raises(ValueError, match="2 critical errors"):
        quality.require_valid(broken)


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(quality.null_counts(df), "column_name", "null_count") == [("a", 1), ("b", 2)]


def test_lookup_keeps_first(spark):
    lookup = spark.createDataFrame([("b", "bee"), ("a", "ay")], "product_category_name string, product_category_name_english string")
    got = cleaning.clean_lookup(lookup, [("a", "other"), ("c", "sea")])
    assert [tuple(r) for r in got.collect()] == [("a", "ay"), ("b", "bee"), ("c", "sea")]


def test_geolocation_mode_ties_nulls_and_means(spark):
    raw = spark.createDataFrame(
        [(1, 1.0, 10.0, " rio ", "rj"), (1, 3.0, None, "niteroi", "rj"), (1, 2.0, 30.0, "niteroi", "sp"),
         (1, 2.0, 20.0, " rio ", "sp"), (2, 5.0, 5.0, None, "mg"), (None, 9.0, 9.0, "x", "x")],
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
    )
    got = {r["geolocation_zip_code_prefix"]: r for r in cleaning.clean_geolocation(raw).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["latitude"], got[1]["longitude"]) == (2.0, 20.0)
    assert got[1]["city"] == "Rio" and got[1]["state"] == "RJ"  # ' rio ' sorts before 'niteroi'
    assert got[2]["city"] is None and got[2]["state"] == "MG"


def test_products_and_reviews(spark):
    products = spark.createDataFrame([("p1", None, 3), ("p2", "cama", 4), ("p3", "zz", 5)], "product_id string, product_category_name string, product_name_lenght int")
    lookup = spark.createDataFrame([("cama", "bed")], "product_category_name string, product_category_name_english string")
    got = rows(cleaning.clean_products(products, lookup), "product_id", "product_category_name", "product_category_name_english", "product_name_length")
    assert got == [("p1", "unknown_category", "unknown_category", 3), ("p2", "cama", "bed", 4), ("p3", "zz", "unknown_category", 5)]


def test_strict_casts_fail_on_null(spark):
    bad = spark.createDataFrame([("1.5", None, "1")], "payment_value string, payment_installments string, payment_sequential string")
    with pytest.raises(Exception, match="payment_installments is NULL"):
        cleaning.clean_payments(bad).collect()


def test_remediation(spark):
    items = spark.createDataFrame(
        [("o1", 1, "p", 5.0, 1), ("o1", 1, "p", 4.0, 1), ("o1", 2, "p", 0.0, 1), ("o2", 1, "p", 5.0, 0), ("oX", 1, "p", 5.0, 1), ("o2", 2, "pX", 5.0, 1), ("o2", 3, "p", 1e9, 1)],
        "order_id string, order_item_id int, product_id string, price double, quantity int",
    )
    orders = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    products = spark.createDataFrame([("p",)], "product_id string")
    got = rows(cleaning.remediate_items(items, orders, products), "order_id", "order_item_id", "price")
    assert got == [("o1", 1, 4.0), ("o2", 3, 1e9)]


def _raw_folder(tmp_path):
    lines = {
        "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc1,u1,01310, sao paulo ,sp\n",
        "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\no1,c1,delivered,2018-01-01 10:00:00,,bad,2018-01-05 00:00:00,2018-01-10 00:00:00\n",
        "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\no1,1,p1,s1,2018-01-03 00:00:00,10.50,2.25\n",
        "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,credit_card,2,12.75\n",
        "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\np1,,1,2,3,4,5,6,7\n",
        "reviews": 'review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\nr1,o1,5,,"two\nlines, ""quoted""",2018-01-06 00:00:00,2018-01-07 00:00:00\n',
        "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,123,campinas,sp\n",
        "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n1310,-23.5,-46.6,sao paulo,SP\n",
        "category_translation": "product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n",
    }
    for role, text in lines.items():
        (tmp_path / f"shop_{RAW_FILES[role]}_dataset.csv").write_text(text)
    return str(tmp_path)


def test_raw_export_to_clean_tables_and_back(spark, tmp_path):
    raw = readers.load_raw(spark, _raw_folder(tmp_path))
    assert set(raw) == set(RAW_TABLES)
    clean = cleaning.clean_all(raw)
    assert set(clean) == set(TABLES)
    order = clean["fact_orders"].first()
    assert order["order_delivered_carrier_date"] is None and order["order_approved_at"] is None
    assert str(order["order_purchase_timestamp"]) == "2018-01-01 10:00:00"
    assert clean["dim_customers"].first()["customer_city"] == "Sao Paulo"
    assert clean["fact_order_reviews"].first()["review_comment_message"] == 'two\nlines, "quoted"'
    assert clean["fact_order_reviews"].first()["review_comment_title"] == ""
    target = str(tmp_path / "clean")
    writers.write_tables(clean, target)
    again = readers.load_tables(spark, target)
    for name, schema in TABLES.items():
        assert set(again[name].columns) == set(schema.names)
        assert again[name].count() == clean[name].count(), name
    assert [f.dataType for f in again["fact_order_items"].schema] == [f.dataType for f in TABLES["fact_order_items"]]
    quality.require_valid(quality.run_suite(again, minimums={n: 1 for n in TABLES}))


def test_missing_raw_file_is_an_error(spark, tmp_path):
    folder = _raw_folder(tmp_path)
    (tmp_path / "shop_sellers_dataset.csv").unlink()
    with pytest.raises(FileNotFoundError, match="sellers"):
        readers.load_raw(spark, folder)


def test_two_files_for_one_role_are_an_error(spark, tmp_path):
    folder = _raw_folder(tmp_path)
    (tmp_path / "backup_sellers_dataset.csv").write_text((tmp_path / "shop_sellers_dataset.csv").read_text())
    with pytest.raises(ValueError, match="several raw files for sellers"):
        readers.load_raw(spark, folder)
    assert readers.load_raw(spark, folder, {"sellers": "shop_sellers_dataset.csv"})["sellers"].count() == 1


@pytest.mark.parametrize(
    "role, old, new",
    [
        ("payments", "12.75", "abc"),
        ("payments", "12.75", "12.755"),
        ("payments", "credit_card,2", "credit_card,2.5"),
        ("geolocation", "-23.5", "south"),
    ],
)
def test_bad_numbers_are_errors(spark, tmp_path, role, old, new):
    folder = _raw_folder(tmp_path)
    file = tmp_path / f"shop_{RAW_FILES[role]}_dataset.csv"
    assert old in file.read_text()
    file.write_text(file.read_text().replace(old, new))
    raw = readers.load_raw(spark, folder)
    with pytest.raises(Exception, match="is not a"):
        cleaning.clean_all(raw)[{"payments": "fact_order_payments", "geolocation": "dim_geolocation"}[role]].collect()


def test_reordered_columns_are_an_error(spark, tmp_path):
    folder = _raw_folder(tmp_path)
    (tmp_path / "shop_sellers_dataset.csv").write_text(
        "seller_zip_code_prefix,seller_id,seller_city,seller_state\n123,s1,campinas,sp\n"
    )
    with pytest.raises(Exception, match="(?i)header"):
        readers.load_raw(spark, folder)["sellers"].collect()


def test_reviews_are_read_in_parts(spark, tmp_path):
    reviews = readers.load_raw(spark, _raw_folder(tmp_path))["reviews"]
    assert "FileScan parquet" in reviews._jdf.queryExecution().toString()


def test_table_definitions():
    for name in TABLES:
        text = create_table_sql(name)
        assert name in text and text.count("NOT NULL") == len(PRIMARY_KEYS[name])
