"""Exact nearest neighbours and synthetic minority rows.

Rows are clustered, and clusters are split at medians into blocks of like rows with a
bounding box each.  A task gets one pair of blocks, does the arithmetic in numpy and
returns only the k best per query.  Pairs that cannot hold a nearer neighbour are left out: once
every row has its k best within its own block, it goes only to blocks whose box is not farther
from the row itself than the last of these.  Which blocks may meet at all follows from joins: clusters near
enough to each other (about the root of the number of blocks), their blocks, then the single rows.
The number of blocks follows the number of rows; no pair of rows ever becomes a Spark row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from keepwell.functions.exprs import shuffle_key
from keepwell.operators.ordering import number_rows
from keepwell.session import materialize, ship_package

_BLOCK_ROWS = 1000
_CHUNK = 32
#: rows of a cluster that one task splits; a larger cluster is dealt into such parts first
_PART_ROWS = 500_000


def _top_k(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest candidates (by distance, then id) of each query, itself excluded."""
    left = np.array(queries["vector"].tolist(), dtype="float64")
    right = np.array(candidates["c_vector"].tolist(), dtype="float64")
    ids = candidates["c_row_id"].to_numpy()
    query_ids = queries["row_id"].to_numpy()
    keep = min(k, len(ids))
    near_ids, near_distances, near_vectors = [], [], []
    for start in range(0, len(left), _CHUNK):
        chunk = left[start : start + _CHUNK]
        distances = np.sqrt(((chunk[:, None, :] - right[None, :, :]) ** 2).sum(axis=2))
        distances[query_ids[start : start + _CHUNK, None] == ids[None, :]] = np.inf
        limits = np.partition(distances, keep - 1, axis=1)[:, keep - 1]
        for distance, limit in zip(distances, limits):
            # everything up to the k-th distance, so that equal distances are settled by id
            close = np.flatnonzero((distance <= limit) & np.isfinite(distance))
            best = close[np.lexsort((ids[close], distance[close]))][:k]
            near_ids.append(ids[best].tolist())
            near_distances.append(distance[best].tolist())
            near_vectors.append(right[best].tolist())
    return pd.DataFrame(
        {"row_id": query_ids, "ids": near_ids, "distances": near_distances, "vectors": near_vectors}
    )


_FOUND = "row_id long, ids array<long>, distances array<double>, vectors array<array<double>>"


def _search(queries: DataFrame, placed: DataFrame, k: int) -> DataFrame:
    """Best k per query (own, block, row_id, vector) among the rows of its ``block``."""

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"row_id": [], "ids": [], "distances": [], "vectors": []})
        return _top_k(q, c, k)

    # own column names keep the two sides of the cogroup apart
    pairs = queries.select("own", "block").distinct()
    candidates = placed.join(pairs, "block").select("own", "block", "row_id", "vector")
    parts = (
        queries.groupBy("own", "block")
        .cogroup(candidates.toDF("c_own", "c_block", "c_row_id", "c_vector").groupBy("c_own", "c_block"))
        .applyInPandas(search, _FOUND)
    )
    near = parts.select(
        "row_id", F.explode(F.arrays_zip("distances", "ids", "vectors")).alias("near")
    )
    return _keep_k(near, k)


def _keep_k(near: DataFrame, k: int) -> DataFrame:
    """The k first of each query's finds; the limit is applied before the shuffle too."""
    order = W.partitionBy("row_id").orderBy("near.distances", "near.ids")
    return (
        near.withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= k)
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list("near")).alias("near"))
    )


def _split(rows: pd.DataFrame) -> pd.DataFrame:
    """Cut at the median of the widest column until no block has more than ``_BLOCK_ROWS`` rows."""
    points = np.array(rows["vector"].tolist(), dtype="float64")
    block = np.empty(len(rows), dtype=object)
    name = f"{rows['cell'].iloc[0]}/{rows['part'].iloc[0]}"
    ids = rows["row_id"].to_numpy()
    open_parts = [("", np.arange(len(rows)))]
    while open_parts:
        path, at = open_parts.pop()
        if len(at) <= _BLOCK_ROWS:
            block[at] = f"{name}/{path}"
            continue
        widest = int(np.ptp(points[at], axis=0).argmax())
        order = at[np.lexsort((ids[at], points[at, widest]))]
        open_parts += [(path + "0", order[: len(order) // 2]), (path + "1", order[len(order) // 2 :])]
    return pd.DataFrame({"row_id": ids, "vector": rows["vector"], "block": block})


def _place(vectors: DataFrame, seed: int) -> DataFrame:
    """row_id, vector and the block of each row."""
    count = vectors.count()
    cells = ceil(sqrt(count / _BLOCK_ROWS))
    if cells > 1:
        model = KMeans(k=cells, seed=seed, maxIter=5, featuresCol="_v", predictionCol="cell").fit(
            vectors.withColumn("_v", array_to_vector("vector"))
        )
        celled = model.transform(vectors.withColumn("_v", array_to_vector("vector"))).drop("_v")
    else:
        celled = vectors.withColumn("cell", F.lit(0))
    sizes = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / _PART_ROWS).alias("parts"))
    parted = celled.join(F.broadcast(sizes), "cell").withColumn(
        "part", F.pmod(F.xxhash64(F.col("row_id"), F.lit(seed)), F.col("parts"))
    )
    split = parted.select("row_id", "vector", "cell", "part").groupBy("cell", "part")
    return split.applyInPandas(_split, "row_id long, vector array<double>, block string")


def _gap(low: str, high: str, mine_low: str, mine_high: str, dimensions: int) -> Column:
    """Squared distance of two boxes given as arrays; a row is a box without width."""
    sides = [
        F.greatest(F.lit(0.0), F.col(low)[i] - F.col(mine_high)[i], F.col(mine_low)[i] - F.col(high)[i]) for i in range(dimensions)
    ]
    return reduce(Column.__add__, [x * x for x in sides])


def _within(gap: Column, reach: Column) -> Column:
    # small slack so that rounding never drops a block
    return F.sqrt(gap) <= reach * (1 + 1e-9) + 1e-9


def _boxes(rows: DataFrame, by: str, dimensions: int) -> DataFrame:
    return rows.groupBy(by).agg(
        F.max("limit").alias("reach"),
        F.array(*[F.min(F.col("vector")[i]) for i in range(dimensions)]).alias("low"),
        F.array(*[F.max(F.col("vector")[i]) for i in range(dimensions)]).alias("high"),
    )


def near_cells(cells: list) -> list[tuple[str, str]]:
    """Pairs of clusters of which a row of the first may need the second."""
    low, high = (np.array([list(r[side]) for r in cells], dtype="float64") for side in ("low", "high"))
    out = []
    for r, mine_low, mine_high in zip(cells, low, high):
        gap = np.maximum(0.0, np.maximum(low - mine_high, mine_low - high))
        hit = np.sqrt((gap**2).sum(axis=1)) <= r["reach"] * (1 + 1e-9) + 1e-9
        out += [(r["cell"], cells[i]["cell"]) for i in np.flatnonzero(hit)]
    return out


def visits(placed: DataFrame, own: DataFrame, k: int, dimensions: int) -> DataFrame:
    """(own, block, row_id, vector): the other blocks that may hold one of the k nearest of a row."""
    # a row that has not found k yet must look everywhere
    limit = F.when(F.size("near") >= k, F.element_at("near", -1)["distances"]).otherwise(F.lit(float("inf")))
    rows = materialize(
        placed.join(own.select("row_id", limit.alias("limit")), "row_id", "left")
        .withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
        .withColumn("cell", F.substring_index("block", "/", 1))
    )
    boxes = materialize(_boxes(rows, "block", dimensions).withColumn("cell", F.substring_index("block", "/", 1)))
    # about the root of the number of blocks
    cells = near_cells(_boxes(rows, "cell", dimensions).collect())
    met = placed.sparkSession.createDataFrame(cells, "cell string, other string")
    mine = boxes.select("cell", F.col("block").alias("own"), "reach", F.col("low").alias("own_low"), F.col("high").alias("own_high"))
    yours = boxes.select(F.col("cell").alias("other"), "block", "low", "high")
    pairs = mine.join(met, "cell").join(yours, "other").filter(
        (F.col("own") != F.col("block")) & _within(_gap("low", "high", "own_low", "own_high", dimensions), F.col("reach"))
    )
    pairs = materialize(pairs.select("own", "block", "low", "high"))
    found = rows.select(F.col("block").alias("own"), "row_id", "vector", "limit").join(pairs, "own")
    return found.filter(_within(_gap("low", "high", "vector", "vector", dimensions), F.col("limit"))).select(
        "own", "block", "row_id", "vector"
    )


def nearest(rows: DataFrame, columns: Sequence[str], id_col: str, k: int, seed: int) -> DataFrame:
    """row_id (long), vector and ``near``: array of (distances, ids, vectors), nearest first."""
    ship_package(rows.sparkSession)
    vectors = materialize(
        rows.select(
            F.col(id_col).cast("long").alias("row_id"),
            F.array(*[F.col(c).cast("double") for c in columns]).alias("vector"),
        )
    )
    placed = materialize(_place(vectors, seed))
    inside = placed.select(F.col("block").alias("own"), "block", "row_id", "vector")
    own = materialize(_search(inside, placed, k))
    elsewhere = _search(materialize(visits(placed, own, k, len(columns))), placed, k)
    own = _keep_k(own.unionByName(elsewhere).select("row_id", F.explode("near").alias("near")), k)
    return own.join(vectors, "row_id")


def synthetic_minority(
    train: DataFrame,
    columns: Sequence[str],
    label: str,
    id_col: str,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """The training rows plus synthetic minority rows, until both labels are equally frequent.

    A synthetic row lies at a random place between a minority row and one of
    its k nearest minority neighbours.  The rows to start from are used
    equally often; everything random is a hash of (row, copy, seed), so a
    task that is run again makes the same rows.
    """
    rows = train.select(*columns, label, id_col)
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    if len(counts) < 2:
        raise ValueError(f"nothing to balance: the only values of {label} are {sorted(counts)}")
    minority, majority = sorted(counts, key=lambda c: (counts[c], c))
    few, missing = counts[minority], counts[majority] - counts[minority]
    if missing == 0:
        return rows.drop(id_col)
    if few <= k:
        raise ValueError(f"{few} rows of the minority do not have {k} neighbours each")
    found = nearest(rows.filter(F.col(label) == minority), columns, id_col, k, seed)
    each, extra = divmod(missing, few)
    numbered = number_rows(
        found.withColumn("_key", shuffle_key("row_id", seed)), [F.col("_key"), F.col("row_id")]
    )
    copies = F.lit(each) + (F.col("row_no") <= extra).cast("int")
    made = (
        numbered.filter(copies > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .withColumn("pick", _uniform("row_id", "copy", seed))
        .withColumn("along", _uniform("row_id", "copy", seed + 1))
        .withColumn(
            "other",
            F.element_at("near", (F.floor(F.col("pick") * F.size("near")) + 1).cast("int"))["vectors"],
        )
    )
    synthetic = made.select(
        *[
            (
                F.col("vector")[i] + F.col("along") * (F.col("other")[i] - F.col("vector")[i])
            ).alias(c)
            for i, c in enumerate(columns)
        ],
        F.lit(minority).alias(label),
    )
    original = rows.select(*[F.col(c).cast("double").alias(c) for c in columns], label)
    return original.unionByName(synthetic)


def _uniform(id_col: str, copy: str, seed: int):
    """Uniform in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(F.col(id_col), F.col(copy), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
