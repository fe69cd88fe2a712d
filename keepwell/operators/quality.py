"""Data-quality checks.  Each returns a small frame; nothing is collected but the verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.sources.schemas import MINIMUM_ROWS, PRIMARY_KEYS, REFERENCES

Tables = Mapping[str, DataFrame]


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count_if(condition: Column) -> Column:
    return F.count_if(condition)


def row_counts(tables: Tables) -> DataFrame:
    """table_name, row_count."""
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def check_row_counts(tables: Tables, minimums: Mapping[str, int] = MINIMUM_ROWS) -> DataFrame:
    """table_name, row_count, minimum_rows, ok."""
    minimum = F.create_map(*[F.lit(x) for n, m in minimums.items() if n in tables for x in (n, m)])
    return (
        row_counts({n: tables[n] for n in minimums if n in tables})
        .withColumn("minimum_rows", F.element_at(minimum, F.col("table_name")).cast("bigint"))
        .withColumn("ok", (F.col("row_count") >= F.col("minimum_rows")).cast("int"))
    )


def check_primary_keys(
    tables: Tables, keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS
) -> DataFrame:
    """table_name, duplicate_rows (all but the first), null_rows (any key column NULL)."""
    checks = []
    for name, columns in keys.items():
        if name not in tables:
            continue
        any_null = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
        checks.append(
            tables[name]
            .groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("copies"))
            .agg(
                F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
                F.coalesce(F.sum(F.when(any_null, F.col("copies"))), F.lit(0)).alias("null_rows"),
            )
            .select(F.lit(name).alias("table_name"), "duplicate_rows", "null_rows")
        )
    return _stack(checks)


def orphans(
    tables: Tables,
    references: Sequence[tuple[str, str, str, str]] = REFERENCES,
    null_is_orphan: bool = False,
) -> DataFrame:
    """reference, orphan_count.

    Child keys are counted before the join, so a key shared by very many rows
    travels as one row.
    """
    checks = []
    for child, column, parent, parent_key in references:
        if child not in tables or parent not in tables:
            continue
        keys = tables[child].select(F.col(column).alias("_key"))
        if not null_is_orphan:
            keys = keys.filter(F.col("_key").isNotNull())
        known = tables[parent].select(F.col(parent_key).alias("_key"))
        checks.append(
            keys.groupBy("_key")
            .agg(F.count(F.lit(1)).alias("rows"))
            .join(known, "_key", "left_anti")
            .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_count"))
            .select(
                F.lit(f"{child}.{column} -> {parent}.{parent_key}").alias("reference"),
                "orphan_count",
            )
        )
    return _stack(checks)


def _long(df: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return df.selectExpr(f"stack({len(names)}, {pairs}) AS ({key}, {value})")


def check_money(items: DataFrame, payments: DataFrame) -> DataFrame:
    """check_name, row_count: negative prices, freights and payments, zero payments."""
    found_items = items.agg(
        _count_if(F.col("price") < 0).alias("negative_price"),
        _count_if(F.col("freight_value") < 0).alias("negative_freight"),
    )
    found_payments = payments.agg(
        _count_if(F.col("payment_value") < 0).alias("negative_payment"),
        _count_if(F.col("payment_value") == 0).alias("zero_payment"),
    )
    return _stack(
        [
            _long(found_items, ["negative_price", "negative_freight"], "check_name", "row_count"),
            _long(found_payments, ["negative_payment", "zero_payment"], "check_name", "row_count"),
        ]
    )


def check_time(
    rows: DataFrame,
    start: str = "order_purchase_timestamp",
    end: str = "order_delivered_customer_date",
) -> DataFrame:
    """check_name, row_count: missing purchase instants, ends before starts."""
    found = rows.agg(
        _count_if(F.col(start).isNull()).alias("missing_start"),
        _count_if(F.col(end) < F.col(start)).alias("end_before_start"),
    )
    return _long(found, ["missing_start", "end_before_start"], "check_name", "row_count")


def run_suite(
    tables: Tables,
    minimums: Mapping[str, int] = MINIMUM_ROWS,
    keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS,
    references: Sequence[tuple[str, str, str, str]] = REFERENCES,
) -> DataFrame:
    """All checks as one frame: check_name, subject, severity, row_count.

    ``severity`` is ok, warning or error; row_count is the number of offending
    rows (for row counts: how many rows are missing to the minimum).
    """
    counts = check_row_counts(tables, minimums).select(
        F.lit("row_count").alias("check_name"),
        F.col("table_name").alias("subject"),
        F.greatest(F.col("minimum_rows") - F.col("row_count"), F.lit(0)).alias("row_count"),
    )
    found_keys = check_primary_keys(tables, keys)
    duplicates = found_keys.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("duplicate_key").alias("check_name"),
                    F.col("table_name").alias("subject"),
                    F.col("duplicate_rows").alias("row_count"),
                ),
                F.struct(
                    F.lit("null_key").alias("check_name"),
                    F.col("table_name").alias("subject"),
                    F.col("null_rows").alias("row_count"),
                ),
            )
        ).alias("c")
    ).select("c.*")
    lost = orphans(tables, references).select(
        F.lit("orphan").alias("check_name"),
        F.col("reference").alias("subject"),
        F.col("orphan_count").alias("row_count"),
    )
    money = check_money(tables["fact_order_items"], tables["fact_order_payments"]).select(
        "check_name", F.lit("money").alias("subject"), "row_count"
    )
    time = check_time(tables["fact_orders"]).select(
        "check_name", F.lit("fact_orders").alias("subject"), "row_count"
    )
    only_warns = F.col("check_name").isin("zero_payment", "end_before_start")
    return _stack([counts, duplicates, lost, money, time]).withColumn(
        "severity",
        F.when(F.col("row_count") == 0, "ok").when(only_warns, "warning").otherwise("error"),
    )


def require_valid(suite: DataFrame) -> DataFrame:
    """Raise ValueError when the suite holds an error; a suite has a few dozen rows."""
    errors = [r for r in suite.collect() if r["severity"] == "error"]
    if errors:
        lines = "\n".join(f" - {r['check_name']} {r['subject']}: {r['row_count']:,}" for r in errors)
        raise ValueError(f"Data validation FAILED with {len(errors)} critical errors:\n{lines}")
    return suite


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column_name, null_count for every column, in one pass."""
    columns = list(columns or df.columns)
    return _long(
        df.agg(*[_count_if(F.col(c).isNull()).alias(c) for c in columns]),
        columns,
        "column_name",
        "null_count",
    )


def audit_items(items: DataFrame, key: Sequence[str] = ("order_id", "order_item_id")) -> DataFrame:
    """check_name, row_count: null cells, duplicate items, non-positive quantity and price."""
    nulls = null_counts(items).agg(F.sum("null_count").alias("row_count")).select(
        F.lit("null_cells").alias("check_name"), "row_count"
    )
    copies = check_primary_keys({"items": items}, {"items": list(key)}).select(
        F.lit("duplicate_items").alias("check_name"), F.col("duplicate_rows").alias("row_count")
    )
    signs = items.agg(
        _count_if(F.col("quantity") <= 0).alias("non_positive_quantity"),
        _count_if(F.col("price") <= 0).alias("non_positive_price"),
    )
    return _stack(
        [
            nulls,
            copies,
            _long(signs, ["non_positive_quantity", "non_positive_price"], "check_name", "row_count"),
        ]
    )
