"""Writing cleaned tables, the warehouse, reports, panels and audiences."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.operators.quality import orphans, row_counts
from keepwell.sources.schemas import DIMENSIONS_FIRST, REFERENCES, create_table_sql


def write_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Each table to its own folder, replacing what was there."""
    for name, df in tables.items():
        options = {"header": "true"} if fmt == "csv" else {}
        df.write.mode("overwrite").format(fmt).options(**options).save(f"{folder}/{name}")


def create_schema(spark: SparkSession, database: str | None = None) -> None:
    """Declare the nine tables (types, NOT NULL keys) in the session catalog."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        spark.catalog.setCurrentDatabase(database)
    for name in DIMENSIONS_FIRST:
        spark.sql(create_table_sql(name))


def load_warehouse(tables: Mapping[str, DataFrame], database: str | None = None) -> list[str]:
    """Replace the catalog tables, dimensions before facts."""
    written = []
    for name in [n for n in DIMENSIONS_FIRST if n in tables]:
        target = f"{database}.{name}" if database else name
        tables[name].write.mode("overwrite").saveAsTable(target)
        written.append(target)
    return written


def load_jdbc(
    tables: Mapping[str, DataFrame],
    url: str,
    properties: Mapping[str, str],
    batch: int = 10_000,
    connections: int = 8,
) -> None:
    """Replace the tables in a relational database, in batches, dimensions before facts.

    Rows go from the tasks straight to the database; ``connections`` bounds
    how many tasks write at the same time.
    """
    for name in [n for n in DIMENSIONS_FIRST if n in tables]:
        (
            tables[name]
            .repartition(connections)  # the reading and cleaning before it keep their own parallelism
            .write.mode("overwrite")
            .option("batchsize", batch)
            .jdbc(url, name, properties=dict(properties))
        )


def write_reports(reports: Mapping[str, DataFrame], folder: str) -> None:
    """Small report frames as one headed CSV file each."""
    for name, df in reports.items():
        df.coalesce(1).write.mode("overwrite").csv(f"{folder}/{name}", header=True)


def write_json(report: DataFrame, path: str) -> None:
    """A (possibly nested) report frame as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_panel(panel: DataFrame, folder: str) -> None:
    """The panel by snapshot, and its test part as the current feature table.

    The test part is read back from what was written, not computed again.
    """
    panel.write.mode("overwrite").partitionBy("snapshot_date").parquet(f"{folder}/churn_panel")
    stored = panel.sparkSession.read.schema(panel.schema).parquet(f"{folder}/churn_panel")
    stored.filter(F.col("split_role") == "test").write.mode("overwrite").parquet(
        f"{folder}/churn_features"
    )


def write_holdout(test: DataFrame, features: list[str], target: str, path: str) -> None:
    """Holdout rows with both id columns the screens expect."""
    holdout(test, features, target).write.mode("overwrite").parquet(path)


def holdout(test: DataFrame, features: list[str], target: str) -> DataFrame:
    return test.select(
        *features, target, "customer_unique_id", F.col("customer_unique_id").alias("customer_id")
    )


def write_audience(audience: DataFrame, path: str) -> None:
    """A filtered risk table for the CRM; stays in as many files as it has partitions."""
    audience.write.mode("overwrite").csv(path, header=True)


def write_bucketed(df: DataFrame, table: str, key: str = "customer_unique_id", buckets: int = 64) -> DataFrame:
    """A catalog table in ``buckets`` hash buckets, sorted by ``key`` inside them, with bloom filters on it.

    One key's rows are read from one bucket, and there from the row groups whose filter knows the key; two tables of
    as many buckets join on it without an exchange. Rows are dealt out first, so a bucket is one file.
    """
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .mode("overwrite")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def save_model(model, path: str) -> None:
    """Any fitted Spark ML model or pipeline, or a model of this library, which is a Parquet table."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:
        model.save(path)


def load_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table and in total, and orphan count per reference, after a load.

    Here a NULL child key counts as an orphan, as in LEFT JOIN ... IS NULL.
    """
    counts = row_counts({n: tables[n] for n in DIMENSIONS_FIRST if n in tables}).select(
        F.lit("rows").alias("check"), F.col("table_name").alias("subject"), F.col("row_count").alias("n")
    )
    references = [r for r in REFERENCES if r[0] in tables and r[2] in tables]
    missing = orphans(tables, references, null_is_orphan=True).select(
        F.lit("orphans").alias("check"), F.col("reference").alias("subject"), F.col("orphan_count").alias("n")
    )
    total = counts.agg(F.sum("n").alias("n")).select(
        F.lit("rows").alias("check"), F.lit("total").alias("subject"), "n"
    )
    return counts.unionByName(total).unionByName(missing)
