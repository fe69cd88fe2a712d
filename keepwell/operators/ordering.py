"""Exact global ordering without a single-task window.

A window with no PARTITION BY sends every row to one task.  Here the rows are
range-partitioned on the full sort key (which ends in a unique id, so even a
value shared by a third of the rows is split), sorted inside each partition
and written once.  Each written row knows its block and its position in the
block; a table with one row per block supplies what comes before it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from keepwell.functions.exprs import as_column
from keepwell.session import materialize

_POSITION_BITS = (1 << 33) - 1


def _blocks(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Sort globally by (by, order) and store block number and position."""
    keys = [F.col(c) for c in by] + list(order)
    return materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            "*",
            F.spark_partition_id().alias("_block"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("_pos"),
        )
    )


def number_rows(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Adds ``row_no`` (1-based) and ``row_count`` per group, over a total order.

    ``by`` is meant for few groups (metrics, splits, labels).  The block table has
    one row for each block and group in it, and is broadcast: its size follows the
    number of partitions.  ``order`` must end in a unique column.
    """
    by = list(by)
    stored = _blocks(df, by, order)
    blocks = stored.groupBy("_block", *by).agg(
        F.count(F.lit(1)).alias("_here"), F.min("_pos").alias("_first")
    )
    whole = W.partitionBy(*(by or [F.lit(0)]))
    earlier = whole.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        "_block",
        *by,
        "_first",
        F.coalesce(F.sum("_here").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_here").over(whole).alias("row_count"),
    )
    return (
        stored.join(F.broadcast(blocks), ["_block", *by])
        .withColumn("row_no", F.col("_before") + F.col("_pos") - F.col("_first") + 1)
        .drop("_block", "_pos", "_first", "_before")
    )


def running_totals(
    df: DataFrame, order: Sequence[Column], sums: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Adds ``<c>_upto`` (inclusive running sum) and ``<c>_total`` for each c in sums.

    Same contract as :func:`number_rows`; only one block at a time is windowed.
    """
    by = list(by)
    stored = _blocks(df, by, order)
    blocks = stored.groupBy("_block", *by).agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    whole = W.partitionBy(*(by or [F.lit(0)]))
    earlier = whole.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        "_block",
        *by,
        *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}_before") for c in sums],
        *[F.sum(f"_{c}").over(whole).alias(f"{c}_total") for c in sums],
    )
    inside = (
        W.partitionBy("_block", *by).orderBy("_pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    joined = stored.join(F.broadcast(blocks), ["_block", *by])
    return joined.select(
        *df.columns,
        *[(F.col(f"_{c}_before") + F.sum(c).over(inside)).alias(f"{c}_upto") for c in sums],
        *[f"{c}_total" for c in sums],
    )


# -- quantile bins -----------------------------------------------------------

def ntile_ends(n: int, k: int) -> list[int]:
    """Last row number of bins 1..k-1 when n rows are dealt into k bins as NTILE does."""
    size, extra = divmod(n, k)
    return [size * b + min(b, extra) for b in range(1, k)]


def quantile_ends(n: int, k: int) -> list[int]:
    """The same when ranks 1..n are cut at their own k-quantiles.

    Edges lie at 1 + b(n-1)/k and bins are closed on the right.
    """
    return [(n - 1) * b // k + 1 for b in range(1, k)]


def quantile_bins(
    df: DataFrame,
    measures: Mapping[str, Column],
    id_col: str,
    k: int,
    ends: Callable[[int, int], list[int]] = ntile_ends,
) -> DataFrame:
    """Adds one bin column (1..k) per measure, bin 1 holding the smallest values.

    Ties are ordered by ``id_col``.  All measures are sorted in one narrow
    shuffle of (measure, value, id); only the k-1 bin edges of each come back,
    and every row is then placed by comparing itself with the edges.  ``df``
    is read several times, so pass a materialized frame.
    """
    last_rows = ends(df.count(), k)
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("measure"), col.cast("double").alias("value"), F.col(id_col)
                    )
                    for name, col in measures.items()
                ]
            )
        ).alias("m")
    ).select("m.*")
    numbered = number_rows(long, [F.col("value"), F.col(id_col)], by=["measure"])
    # at most k - 1 rows per measure
    edges = numbered.filter(F.col("row_no").isin(*set(last_rows))).collect()
    out = df
    for name, col in measures.items():
        value, bin_no = col.cast("double"), F.lit(1)
        for edge in edges:
            if edge["measure"] == name:
                beyond = (value > F.lit(edge["value"])) | (
                    (value == F.lit(edge["value"])) & (F.col(id_col) > F.lit(edge[id_col]))
                )
                steps = last_rows.count(edge["row_no"])
                bin_no = bin_no + F.when(beyond, steps).otherwise(0)
        out = out.withColumn(name, bin_no.cast("int"))
    return out


def share_rank(df: DataFrame, value: Column, id_col: str, share: float) -> DataFrame:
    """Adds ``in_top``: whether the row is among the first floor(share*n) by value descending."""
    numbered = number_rows(
        df.withColumn("_value", value), [F.col("_value").desc(), as_column(id_col)]
    )
    return numbered.withColumn(
        "in_top", F.col("row_no") <= F.floor(F.col("row_count") * F.lit(share))
    ).drop("_value", "row_no", "row_count")
