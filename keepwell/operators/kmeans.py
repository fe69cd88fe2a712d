"""K-means for many numbers of clusters and restarts in the passes of one.

* Starting centres are drawn with chances in proportion to the squared distance from those before (k-means++). The
  draw is a race: a row's time is -ln(u) / distance^2 with u a hash of (row key, restart, step), and the first one wins, so one
  pass draws for all restarts, and a task that is run again draws the same. Fewer clusters of a
  restart start from the first of its centres.
* A pass gives, for each unfinished fit, the sums and sizes of its clusters and the cost: fixed numbers, whatever the rows.
  Passes follow the slowest fit's iterations, not the number of fits. Rows stay in the executors as arrays.
* A cluster without rows keeps its centre. Ties of distance go to the lower cluster.

Bounds that skip rows would need two numbers for each row and fit; in the few dimensions this is for, distances cost less.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keepwell.session import ship_package, written

MOST_ITERATIONS = 300
#: a fit is done when its centres move by less than this, squared and summed, as a share of the columns' mean variance
TOLERANCE = 1e-4
FEW_TASKS = 16


@dataclass(frozen=True)
class Clusters:
    columns: tuple[str, ...]
    centres: tuple[tuple[float, ...], ...]
    cost: float
    iterations: int

    def nearest(self) -> Column:
        """The number of the nearest centre, as plain columns."""
        apart = [
            sum(((F.col(c) - v) * (F.col(c) - v) for c, v in zip(self.columns, centre)), F.lit(0.0)) for centre in self.centres
        ]
        return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(apart)]))["i"]

    def save(self, path: str) -> None:
        rows = [(i, list(self.columns), list(c), self.cost) for i, c in enumerate(self.centres)]
        table = SparkSession.active().createDataFrame(rows, "cluster int, columns array<string>, centre array<double>, cost double")
        table.coalesce(1).write.mode("overwrite").parquet(path)


@dataclass
class _Block:
    key: np.ndarray
    x: np.ndarray


def _block(rows: Iterator, width: int) -> Iterator[_Block]:
    rows = list(rows)
    yield _Block(np.array([r[0] for r in rows], np.int64), np.array([r[1:] for r in rows], float).reshape(-1, width))


def _uniform(key: np.ndarray, restart: int, step: int) -> np.ndarray:
    """A number in (0, 1) for each row."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64((restart * 1_000_003 + step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)


def apart(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances [row, centre]."""
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)


@dataclass
class _Draw:
    """One more centre for each restart."""

    centres: dict[int, np.ndarray]
    step: int

    def run(self, blocks: Iterator[_Block]) -> Iterator[dict[int, tuple[float, tuple]]]:
        best: dict[int, tuple[float, tuple]] = {}
        for block in blocks:
            for restart, centres in self.centres.items():
                if not len(block.x):
                    continue
                weight = apart(block.x, centres).min(1) if len(centres) else np.ones(len(block.x))
                time = np.full(len(block.x), np.inf)
                some = weight > 0
                time[some] = -np.log(_uniform(block.key[some], restart, self.step)) / weight[some]
                i = int(time.argmin())
                if np.isfinite(time[i]):
                    found = (float(time[i]), tuple(block.x[i]))
                    best[restart] = min(best.get(restart, found), found)
        yield best


def _first(a: dict, b: dict) -> dict:
    return {r: min(v for v in (a.get(r), b.get(r)) if v is not None) for r in {*a, *b}}


@dataclass
class _Move:
    """Sums, sizes and cost of every unfinished fit."""

    centres: dict[int, np.ndarray]

    def run(self, blocks: Iterator[_Block]) -> Iterator[dict[int, np.ndarray]]:
        total = {f: np.zeros((len(c), c.shape[1] + 2)) for f, c in self.centres.items()}
        for block in blocks:
            for fit, centres in self.centres.items():
                if not len(block.x):
                    continue
                distance = apart(block.x, centres)
                own = distance.argmin(1)
                k = len(centres)
                for i in range(block.x.shape[1]):
                    total[fit][:, i] += np.bincount(own, block.x[:, i], minlength=k)
                total[fit][:, -2] += np.bincount(own, minlength=k)
                total[fit][:, -1] += np.bincount(own, distance[np.arange(len(own)), own], minlength=k)
        yield total


def _added(a: dict[int, np.ndarray], b: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    return {f: a[f] + b[f] for f in a}


def fit(
    rows: DataFrame, columns: Sequence[str], key: str, ks: Sequence[int], restarts: int, seed: int, task_rows: int = 500_000
) -> dict[int, Clusters]:
    """For each number of clusters the restart of least cost (the first on ties). ``key`` is a long."""
    spark = rows.sparkSession
    ship_package(spark)
    width, columns = len(columns), list(columns)
    table = written(rows.select(F.col(key).cast("long"), *[F.col(c).cast("double") for c in columns]))
    total, variance = table.agg(F.count(F.lit(1)), sum((F.var_pop(c) for c in columns), F.lit(0.0)) / width).first()
    if not total:
        raise ValueError("no rows to cluster")
    tasks = max(1, -(-total // task_rows), min(spark.sparkContext.defaultParallelism, -(-total // 5_000)))
    blocks = table.repartition(tasks).rdd.mapPartitions(lambda r: _block(r, width)).persist(StorageLevel.MEMORY_AND_DISK)
    depth = 1 if tasks <= FEW_TASKS else 2

    drawn = {seed + r: np.empty((0, width)) for r in range(restarts)}
    for step in range(max(ks)):
        found = blocks.mapPartitions(_Draw(drawn, step).run).treeReduce(_first, depth)
        # fewer different rows than clusters: the last centre again
        drawn = {r: np.vstack([c, found[r][1] if r in found else c[-1]]) for r, c in drawn.items()}

    jobs = [(k, r) for k in ks for r in drawn]
    centres = {i: drawn[r][:k] for i, (k, r) in enumerate(jobs)}
    cost, steps = dict.fromkeys(centres, np.inf), dict.fromkeys(centres, 0)
    moving = dict(centres)
    for iteration in range(MOST_ITERATIONS + 1):
        sums = blocks.mapPartitions(_Move(moving).run).treeReduce(_added, depth)
        for i in list(moving):
            size = sums[i][:, -2]
            cost[i], steps[i] = float(sums[i][:, -1].sum()), iteration
            moved = np.where(size[:, None] > 0, sums[i][:, :-2] / np.maximum(size, 1.0)[:, None], moving[i])
            shift = float(((moved - moving[i]) ** 2).sum())
            if shift <= TOLERANCE * (variance or 0.0) or iteration == MOST_ITERATIONS:
                del moving[i]  # the cost is that of the centres kept
            else:
                centres[i] = moving[i] = moved
        if not moving:
            break
    blocks.unpersist()
    best: dict[int, Clusters] = {}
    for i, (k, _) in enumerate(jobs):
        if k not in best or cost[i] < best[k].cost:
            best[k] = Clusters(tuple(columns), tuple(map(tuple, centres[i].tolist())), cost[i], steps[i])
    return best
