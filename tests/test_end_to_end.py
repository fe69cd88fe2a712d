import json

from pyspark.sql import functions as F

from catalogue import CUTOFF, SNAPSHOTS
from keepwell.plans import end_to_end, modelling
from keepwell.sources import writers
from keepwell.sources.star import role_tables

FOLDER = "/root/testdata/sf0.001"
QUICK = [modelling.BoostSettings(2, 0.1, 3)]


def test_from_tables_to_risk_table(spark, tmp_path):
    t = role_tables(spark, FOLDER)
    out = str(tmp_path)
    risk = end_to_end.analyse(spark, t, out, SNAPSHOTS, CUTOFF, QUICK, restarts=2)
    assert risk.count() == spark.read.parquet(f"{out}/churn_features").count() > 0
    assert set(r["risk_tier"] for r in risk.collect()) <= {"HIGH", "MEDIUM", "LOW"}
    for name in end_to_end.reports(t):
        assert spark.read.csv(f"{out}/reports/{name}", header=True).count() > 0, name
    report = next((tmp_path / "reports" / "target_quality_report").glob("part-*.json"))
    assert json.loads(report.read_text())["num_snapshots"] == 4
    assert spark.read.csv(f"{out}/reports/feature_importance", header=True).count() == 17
    writers.write_audience(risk.filter(F.col("risk_tier") == "HIGH"), f"{out}/audience")


def test_lookback_audit(spark):
    got = end_to_end.audit_lookbacks(role_tables(spark, FOLDER), SNAPSHOTS, (365, None), QUICK).collect()
    assert {r["lookback"] for r in got} == {"365", "all"}
    assert all(r["holdout_cost"] >= 0 and 0 <= r["roc_auc"] <= 1 for r in got)


def test_warehouse_load(spark, tmp_path):
    t = {n: df for n, df in role_tables(spark, FOLDER).items() if n in ("dim_customers", "fact_orders")}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop_test LOCATION '{tmp_path}/shop'")
    try:
        written = writers.load_warehouse(t, "shop_test")
        assert written == ["shop_test.dim_customers", "shop_test.fact_orders"]
        writers.load_warehouse(t, "shop_test")  # replaces
        stored = {n: spark.table(f"shop_test.{n}") for n in t}
        report = {(r["check"], r["subject"]): r["n"] for r in writers.load_report(stored).collect()}
        assert report[("rows", "fact_orders")] == t["fact_orders"].count()
        assert report[("rows", "total")] == sum(df.count() for df in t.values())
        assert report[("orphans", "fact_orders.customer_id -> dim_customers.customer_id")] == 0
    finally:
        spark.sql("DROP DATABASE IF EXISTS shop_test CASCADE")


def test_declared_schema(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop_ddl LOCATION '{tmp_path}/ddl'")
    current = spark.catalog.currentDatabase()
    try:
        writers.create_schema(spark, "shop_ddl")
        assert len(spark.catalog.listTables("shop_ddl")) == 9
    finally:
        spark.catalog.setCurrentDatabase(current)
        spark.sql("DROP DATABASE IF EXISTS shop_ddl CASCADE")
