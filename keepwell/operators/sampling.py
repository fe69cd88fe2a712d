"""Repeatable samples, splits and folds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from keepwell.functions.exprs import shuffle_key
from keepwell.operators.ordering import number_rows


def seeded_sample(df: DataFrame, id_col: str, size: int, seed: int) -> DataFrame:
    """At most ``size`` rows, the same ones on every run."""
    key = shuffle_key(id_col, seed)
    return (
        df.withColumn("_key", key).orderBy("_key", id_col).limit(size).drop("_key")
    )


def stratified_split(
    df: DataFrame, label: str, id_col: str, shares: Mapping[str, float], seed: int
) -> DataFrame:
    """Adds ``split_role``: each label is dealt out in the given shares, in seeded order."""
    numbered = number_rows(
        df.withColumn("_key", shuffle_key(id_col, seed)), [F.col("_key"), F.col(id_col)], by=[label]
    )
    place = (F.col("row_no") - 1) / F.col("row_count")
    role, reached = None, 0.0
    names = list(shares)
    for name in names[:-1]:
        reached = round(reached + shares[name], 10)
        test = place < F.lit(reached)
        role = F.when(test, name) if role is None else role.when(test, name)
    role = F.lit(names[-1]) if role is None else role.otherwise(names[-1])
    return numbered.withColumn("split_role", role).drop("_key", "row_no", "row_count")


def stratified_folds(df: DataFrame, label: str, id_col: str, folds: int, seed: int) -> DataFrame:
    """Adds ``fold`` (0..folds-1): every label is spread evenly, in seeded order."""
    numbered = number_rows(
        df.withColumn("_key", shuffle_key(id_col, seed)), [F.col("_key"), F.col(id_col)], by=[label]
    )
    return numbered.withColumn("fold", ((F.col("row_no") - 1) % folds).cast("int")).drop(
        "_key", "row_no", "row_count"
    )
