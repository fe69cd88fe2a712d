"""Exact quantiles by counting: no value is sorted, and none but the wanted ones leaves its task.

A double becomes a whole number of 64 bits in the same order. A pass counts, for every column, group and prefix that
still holds a wanted rank, how many values have each next 16 bits; the rank's own 16 bits follow from sums over these
counts. After four passes the number is known, and with it the value. What travels are counts, at most 65,536 for each
wanted rank, group and pass, however many rows or distinct values there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from keepwell.session import ship_package, written

_STEP = 16
_TOP = np.uint64(1 << 63)


def ordered(x: np.ndarray) -> np.ndarray:
    """64-bit numbers in the order of the doubles; -0.0 is 0.0, NaN stands last."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.uint64)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def value_of(number: int) -> float:
    """The double behind an ordered number."""
    bits = number & ~(1 << 63) if number >> 63 else ~number & (1 << 64) - 1
    return float(np.array([bits], np.uint64).view(float)[0])


def _counted(rows: DataFrame, columns: int, wanted: Mapping[tuple[int, int], Sequence[int]] | None, step: int) -> DataFrame:
    """grp, place, parent, digit, n: values by their next 16 bits, where ``wanted`` has their prefix."""
    shift, down = np.uint64(64 - _STEP * (step + 1)), np.uint64(_STEP)
    prefixes = {k: np.array(sorted(set(v)), np.uint64) for k, v in wanted.items()} if wanted is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            out = []
            for place in range(columns):
                column = batch.column(1 + place)
                valid = np.array(column.is_valid())
                number = ordered(column.fill_null(0.0).to_numpy(zero_copy_only=False)) >> shift
                for g in np.unique(group[valid]) if len(group) else ():
                    mine = number[valid & (group == g)]
                    if prefixes is not None:
                        mine = mine[np.isin(mine >> down, prefixes.get((int(g), place), np.empty(0, np.uint64)))]
                    found, n = np.unique(mine, return_counts=True)
                    if len(found):
                        out.append((np.full(len(found), g), np.full(len(found), place), found, n))
            if out:
                group_, place_, found, n = (np.concatenate(x) for x in zip(*out))
                parent = (found >> down).astype(np.int64) if step else np.zeros(len(found), np.int64)
                digit = (found & np.uint64((1 << _STEP) - 1)).astype(np.int32)
                arrays = [pa.array(group_.astype(np.int32)), pa.array(place_.astype(np.int32)), pa.array(parent), pa.array(digit), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["grp", "place", "parent", "digit", "n"])

    counts = rows.mapInArrow(run, "grp int, place int, parent long, digit int, n long")
    return counts.groupBy("grp", "place", "parent", "digit").agg(F.sum("n").alias("n"))


def ranked_values(
    rows: DataFrame, columns: Sequence[str], probs: Sequence[float], group: Column | None = None
) -> dict[tuple[int, int], tuple[int, list[float]]]:
    """{(group, column's place): (values, quantiles)}: linearly interpolated; nulls are ignored.

    ``group`` numbers a short list of groups. ``rows`` is read four times.
    """
    ship_package(rows.sparkSession)
    spark = rows.sparkSession
    narrow = rows.select((group if group is not None else F.lit(0)).cast("int").alias("grp"), *[F.col(c).cast("double") for c in columns])
    # the ranks of each quantile are known once the first pass has counted the values
    wanted: dict[tuple[int, int], list[tuple[int, int, int]]] = {}  # (prefix, rank inside it, which)
    totals: dict[tuple[int, int], int] = {}
    for step in range(64 // _STEP):
        counts = _counted(narrow, len(columns), {k: [p for p, _, _ in v] for k, v in wanted.items()} if step else None, step)
        by = Window.partitionBy("grp", "place", "parent").orderBy("digit")
        running = counts.select(
            "*", F.sum("n").over(by).alias("upto"), F.sum("n").over(Window.partitionBy("grp", "place", "parent")).alias("total")
        )
        if step:
            ranks = [(g, p, prefix, rank, which) for (g, p), v in wanted.items() for prefix, rank, which in v]
            targets = spark.createDataFrame(ranks, "grp int, place int, parent long, rank long, which int")
            met = running.join(F.broadcast(targets), ["grp", "place", "parent"])  # two rows for each quantile
        else:
            places = [F.lit(float(q)) * (F.col("total") - 1) for q in probs]
            low = [F.floor(x).cast("long") + 1 for x in places]
            both = [r for x in low for r in (x, F.least(x + 1, F.col("total")))]
            met = running.select("*", F.posexplode(F.array(*both)).alias("which", "rank"))
        chosen = met.filter("upto >= rank AND upto - n < rank")
        wanted = {}
        for r in chosen.select("grp", "place", "parent", "digit", "which", (F.col("rank") - F.col("upto") + F.col("n")).alias("rest"), "total").collect():
            key = r["grp"], r["place"]
            prefix = r["parent"] << _STEP | r["digit"]
            wanted.setdefault(key, []).append((prefix, r["rest"], r["which"]))
            if not step:
                totals[key] = r["total"]
    out = {}
    for key, found in wanted.items():
        value = {which: value_of(number) for number, _, which in found}
        n, quantiles = totals[key], []
        for i, q in enumerate(probs):
            place = (n - 1) * float(q)
            low, high = value[2 * i], value[2 * i + 1]
            quantiles.append(low + (high - low) * (place - np.floor(place)))
        out[key] = (n, [float(x) for x in quantiles])
    return out


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles per group; NULL values are ignored, and groups without others left out.

    Groups are a short list, such as clusters.
    """
    by = list(by)
    kept = written(df.select(*by, F.col(value).cast("double").alias(value)))
    groups = kept.select(*by).distinct().collect() if by else [()]
    kinds = {c: df.schema[c].dataType for c in by}

    def is_in(g) -> Column:
        return reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v).cast(kinds[c])) for c, v in zip(by, g)], F.lit(True))

    number = F.coalesce(*[F.when(is_in(g), i) for i, g in enumerate(groups)]) if groups else F.lit(0)
    found = ranked_values(kept, [value], list(probs.values()), number)
    schema = StructType([*(df.schema[c] for c in by), *(StructField(p, DoubleType()) for p in probs)])
    return df.sparkSession.createDataFrame([(*groups[g], *q) for (g, _), (_, q) in found.items()], schema)


def moments_and_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], name: str = "measure"
) -> DataFrame:
    """One row per column: its name, n, mean, std, low, high, zeros and the quantiles; NULLs are ignored.

    The frame is written once. Moments come from one wide aggregate, quantiles from counts.
    """
    kept = written(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    wide = kept.agg(
        *[
            F.struct(
                F.lit(c).alias(name),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("low"),
                F.max(c).alias("high"),
                F.count_if(F.col(c) == 0).alias("zeros"),
            ).alias(c)
            for c in columns
        ]
    ).select(F.inline(F.array(*[F.col(c) for c in columns])))
    found = ranked_values(kept, columns, list(probs.values()))
    rows = [(columns[p], *q) for (_, p), (_, q) in found.items()]
    schema = ", ".join([f"{name} string", *(f"{p} double" for p in probs)])
    return wide.join(F.broadcast(df.sparkSession.createDataFrame(rows, schema)), name, "left")  # one row per column
