"""K-means customer segments on log-scaled, standardised RFM values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keepwell.functions.exprs import ratio, rounded
from keepwell.functions.rules import CLUSTER_RULES, first_match
from keepwell.operators import kmeans
from keepwell.operators.kmeans import Clusters
from keepwell.operators.sampling import seeded_sample
from keepwell.operators.selection import exact_quantiles
from keepwell.session import materialize, ship_package
from keepwell.settings import SEED

#: rows a Euclidean silhouette is taken over, as its work grows with their square
SILHOUETTE_ROWS = 15_000
RFM_COLUMNS = ("recency", "frequency", "monetary")
_SCALED = [f"scaled_{c}" for c in RFM_COLUMNS]


@dataclass(frozen=True)
class Segments:
    """log1p, then zero mean and unit population deviation, then the nearest of K-means' centres."""

    mean: tuple[float, ...]
    spread: tuple[float, ...]
    clusters: Clusters | None = None

    def scaled(self, rfm: DataFrame) -> DataFrame:
        terms = zip(RFM_COLUMNS, _SCALED, self.mean, self.spread)
        return rfm.withColumns({name: (F.log1p(F.col(c)) - m) / s for c, name, m, s in terms})

    def transform(self, rfm: DataFrame, cluster: str = "cluster_id") -> DataFrame:
        return self.scaled(rfm).withColumn(cluster, self.clusters.nearest())

    def save(self, path: str) -> None:
        self.clusters.save(f"{path}/clusters")
        scale = list(zip(RFM_COLUMNS, self.mean, self.spread))
        table = SparkSession.active().createDataFrame(scale, "feature string, mean double, spread double")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/scale")


def scaler(rfm: DataFrame) -> Segments:
    """Means and deviations of the logarithms; no clusters yet."""
    logs = [F.log1p(F.col(c)) for c in RFM_COLUMNS]
    stats = rfm.agg(*[F.avg(c) for c in logs], *[F.stddev_pop(c) for c in logs]).first()
    n = len(logs)
    return Segments(tuple(stats[:n]), tuple(s or 1.0 for s in stats[n:]))


def fit_segments(
    rfm: DataFrame, ks: Sequence[int] = (4,), restarts: int = 10, seed: int = SEED
) -> dict[int, Segments]:
    """For each number of clusters the best restart; all of them share their passes over the rows."""
    front = scaler(rfm)
    keyed = front.scaled(rfm).withColumn("_key", F.xxhash64("customer_unique_id"))
    found = kmeans.fit(keyed, _SCALED, "_key", ks, restarts, seed)
    return {k: replace(front, clusters=c) for k, c in found.items()}


def assign_clusters(rfm: DataFrame, model: Segments) -> DataFrame:
    return model.transform(rfm).drop(*_SCALED)


def cluster_profile(clustered: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Size, means, median spend, share and name per cluster, largest mean spend first."""
    money = [F.col(c).cast("decimal(28,2)") for c in RFM_COLUMNS]
    stats = clustered.groupBy(cluster).agg(
        F.count("customer_unique_id").alias("customer_count"),
        *[
            ratio(F.sum(m), F.count(m)).alias(f"avg_{c}")
            for c, m in zip(RFM_COLUMNS, money)
        ],
    )
    medians = exact_quantiles(clustered, [cluster], "monetary", {"median_monetary": 0.5})
    profile = materialize(stats.join(medians, cluster))
    # one row per cluster from here on
    total = profile.agg(F.sum("customer_count")).scalar()
    top = profile.agg(F.max_by(cluster, F.struct(F.col("avg_monetary"), -F.col(cluster)))).scalar()
    return (
        profile.withColumn("pct_customers", rounded(ratio("customer_count", total) * 100.0, 2))
        .withColumn("spend_rank", F.when(F.col(cluster) == top, 1).otherwise(2))
        .withColumn("median_of_means", profile.agg(F.median("avg_monetary")).scalar())
        .withColumn("segment_name", first_match(CLUSTER_RULES))
        .drop("spend_rank", "median_of_means")
        .orderBy(F.desc("avg_monetary"))
    )


def name_clusters(
    clustered: DataFrame, profile: DataFrame, cluster: str = "cluster_id"
) -> DataFrame:
    """Adds cluster_segment; the profile has one row per cluster."""
    names = profile.select(cluster, F.col("segment_name").alias("cluster_segment"))
    return clustered.join(F.broadcast(names), cluster, "left")


def segment_customers(
    rfm: DataFrame, k: int = 4, restarts: int = 10, seed: int = SEED
) -> tuple[DataFrame, DataFrame, Segments]:
    """(customers with cluster and name, cluster profile, model)."""
    rfm = materialize(rfm)
    model = fit_segments(rfm, [k], restarts, seed)[k]
    clustered = materialize(assign_clusters(rfm, model))
    profile = cluster_profile(clustered)
    return name_clusters(clustered, profile), profile, model


# -- how many clusters -------------------------------------------------------

def silhouettes(points: DataFrame, columns: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """label_column, silhouette: mean silhouette of each labelling over all rows.

    With squared Euclidean distance a row's mean distance to a cluster follows from the
    cluster's size, sum and sum of squares: |x|^2 + (sum of |y|^2 - 2 x.sum of y) / n.  One
    small aggregate per labelling and one pass over the rows give the exact value.
    """
    columns, labels = list(columns), list(labels)
    square = reduce(Column.__add__, [F.col(c) * F.col(c) for c in columns])
    rows = materialize(points.select(*[F.col(c).cast("double").alias(c) for c in columns], *labels))

    def one(label: str) -> DataFrame:
        # one row per cluster
        clusters = rows.groupBy(F.col(label).alias("own")).agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.array(*[F.sum(c) for c in columns]).alias("sums"),
            F.sum(square).alias("squares"),
        )
        listed = clusters.agg(F.collect_list(F.struct("own", "n", "sums", "squares")).alias("clusters"))
        both = rows.select(*columns, F.col(label).alias("label")).crossJoin(F.broadcast(listed))

        def apart(c: Column) -> Column:
            product = reduce(Column.__add__, [F.col(x) * c["sums"][i] for i, x in enumerate(columns)])
            return c["n"] * square + c["squares"] - 2.0 * product  # summed over the cluster's rows

        own = F.element_at(F.filter("clusters", lambda c: c["own"] == F.col("label")), 1)
        inner = F.greatest(apart(own), F.lit(0.0)) / F.greatest(own["n"] - 1, F.lit(1.0))
        outer = F.array_min(
            F.transform(
                F.filter("clusters", lambda c: c["own"] != F.col("label")),
                lambda c: F.greatest(apart(c), F.lit(0.0)) / c["n"],
            )
        )
        value = F.when((own["n"] > 1) & (F.greatest(inner, outer) > 0), (outer - inner) / F.greatest(inner, outer))
        return both.agg(rounded(F.avg(F.coalesce(value, F.lit(0.0))), 4).alias("silhouette")).select(
            F.lit(label).alias("label_column"), "silhouette"
        )

    return reduce(DataFrame.unionByName, [one(label) for label in labels])


#: rows of a block; two blocks meet in one task
_BLOCK_ROWS = 2_000


def euclidean_silhouettes(
    points: DataFrame,
    columns: Sequence[str],
    labels: Sequence[str],
    key: str = "customer_unique_id",
    sample: int | None = SILHOUETTE_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """label_column, silhouette: mean silhouette by Euclidean distance of each labelling, over ``sample`` seeded rows.

    Unlike squared distances these do not follow from sums, so every row meets every other. Blocks of rows meet in
    pairs; a task gives for each of its rows the distances to the other block summed by cluster, for all labellings from
    one matrix of distances. No pair of rows is ever a row. Work grows with the square of the sample; ``None`` takes all rows.
    """
    ship_package(points.sparkSession)
    columns, labels = list(columns), list(labels)
    chosen = points if sample is None else seeded_sample(points, key, sample, seed)
    rows = materialize(chosen.select(F.monotonically_increasing_id().alias("row"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)], *labels))
    # one row per cluster of each labelling
    sizes = {c: {r[0]: r[1] for r in rows.groupBy(c).count().orderBy(c).collect()} for c in labels}
    places = {c: list(sizes[c]) for c in labels}
    width = sum(map(len, places.values()))
    coded = [F.array_position(F.array(*[F.lit(v) for v in places[c]]), F.col(c)).cast("int") - 1 for c in labels]
    blocks = max(1, -(-sum(sizes[labels[0]].values()) // _BLOCK_ROWS))
    spread = rows.select(
        "row", F.array(*[f"x{i}" for i in range(len(columns))]).alias("x"), F.array(*coded).alias("codes"),
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("own"),
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = spread.select("row", "x", "codes", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    starts = np.cumsum([0, *map(len, places.values())])[:-1]

    def sums(table: pa.Table) -> pa.Table:
        own, a, b = (table.column(c).to_numpy() for c in ("own", "a", "b"))
        x = np.array(table.column("x").to_pylist())
        member = np.zeros((len(x), width))
        for i, codes in enumerate(np.array(table.column("codes").to_pylist()).T):
            member[np.arange(len(x)), starts[i] + codes] = 1.0
        first, second = np.flatnonzero(own == a[0]), np.flatnonzero(own == b[0])
        distance = np.sqrt(((x[first][:, None, :] - x[second][None, :, :]) ** 2).sum(2))
        parts = [(first, distance @ member[second])]
        if a[0] != b[0]:
            parts.append((second, distance.T @ member[first]))
        at, total = (np.concatenate(p) for p in zip(*parts))
        row = table.column("row").to_numpy()[at]
        return pa.table([pa.array(row), *(pa.array(total[:, i]) for i in range(width))], ["row", *(f"s{i}" for i in range(width))])

    schema = ", ".join(["row long", *(f"s{i} double" for i in range(width))])
    total = met.groupBy("a", "b").applyInArrow(sums, schema).groupBy("row").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)])
    both = total.join(rows, "row")
    values = []
    for c, start in zip(labels, starts):
        sums = [(F.col(c) == F.lit(label), F.col(f"s{start + i}"), n) for i, (label, n) in enumerate(sizes[c].items())]
        inner = F.coalesce(*[F.when(mine, total / max(n - 1, 1)) for mine, total, n in sums])
        outer = F.array_min(F.array(*[F.when(~mine, total / n) for mine, total, n in sums]))
        n_own = F.coalesce(*[F.when(mine, F.lit(n)) for mine, _, n in sums])
        largest = F.greatest(inner, outer)
        values.append(F.when((n_own > 1) & (largest > 0), (outer - inner) / largest).otherwise(0.0))
    means = both.agg(*[rounded(F.avg(v), 4).alias(c) for c, v in zip(labels, values)])
    return means.unpivot([], labels, "label_column", "silhouette")


def evaluate_k(
    rfm: DataFrame,
    ks: Sequence[int] = tuple(range(2, 9)),
    restarts: int = 10,
    seed: int = SEED,
    sample: int | None = SILHOUETTE_ROWS,
) -> DataFrame:
    """k, inertia (over all rows), Euclidean silhouette (over ``sample`` rows) for each number of clusters."""
    rfm = materialize(rfm)
    models = fit_segments(rfm, ks, restarts, seed)
    labelled = models[ks[0]].scaled(rfm).withColumns({f"k{k}": m.clusters.nearest() for k, m in models.items()})
    scores = euclidean_silhouettes(labelled, _SCALED, [f"k{k}" for k in ks], sample=sample, seed=seed)
    inertia = rfm.sparkSession.createDataFrame(
        [(k, f"k{k}", m.clusters.cost) for k, m in models.items()], "k int, label_column string, inertia double"
    )
    return inertia.join(scores, "label_column").select("k", "inertia", "silhouette").orderBy("k")
