"""Random forests with weights of each tree's own bag, all trees of all fits grown level by level.

* A row's multiplicity in a tree's bag is a Poisson(1) draw, a hash of (row key, fit, tree): bags need no shuffle and
  come out the same when a task is run again.
* Class weights are n / (2 n_class) of the bag itself, counted in one pass for all trees.
* A pass over the binned rows counts bag rows by (tree, node, feature, bin, class) for the features each node may split on,
  which a hash draws. Counts are whole numbers, so they do not depend on how rows are dealt out. The best split of a node is
  chosen where its counts meet; only splits reach the driver. Jobs follow the depth; a level whose counts would take more
  than ``MOST_CELLS`` numbers is counted in several passes.
* Splits lower the weighted Gini impurity most; ties go to the first feature and lowest cut.

Missing and NaN features lie in the lowest bin and go left. Repeated keys share their draws.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import exp, factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.operators.boosting import NODES, Node, binned, cuts, leaves
from keepwell.session import ship_package, written

BINS = 32
#: counts a task holds at most, and (row, tree) pairs that a task of a small fit works on
MOST_CELLS = 1 << 23
TASK_PAIRS, TASK_ROWS = 400_000, 1_000_000
#: chances of at most 0, 1, .. copies of a row in a bag
_AT_MOST = np.cumsum([exp(-1.0) / factorial(i) for i in range(20)])


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 100
    max_depth: int = 8
    #: features a node may split on; the root of their number if not given
    tried: int | None = None


@dataclass(frozen=True)
class Forest:
    """Nodes as in ``boosting``; the value of a leaf is its share of class 1 by bag weights."""

    features: tuple[str, ...]
    nodes: tuple[Node, ...]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = 1 + max(n.tree for n in self.nodes), 1 + max(n.node for n in self.nodes)
        feature = np.full(shape, -1, np.int64)
        cut, value = np.zeros(shape), np.zeros(shape)
        for n in self.nodes:
            feature[n.tree, n.node], cut[n.tree, n.node], value[n.tree, n.node] = n.feature, n.cut, n.value
        return feature, cut, value

    def probability(self, x: np.ndarray) -> np.ndarray:
        feature, cut, value = self.arrays()
        return sum(value[t, leaves(x, feature[t], cut[t])] for t in range(len(feature))) / len(feature)

    def transform(self, rows: DataFrame, probability: str = "probability") -> DataFrame:
        ship_package(rows.sparkSession)
        shared = rows.sparkSession.sparkContext.broadcast(self)  # trees x 2^depth nodes

        @F.pandas_udf("double")
        def scored(*columns: pd.Series) -> pd.Series:
            return pd.Series(shared.value.probability(np.column_stack([c.to_numpy("float64") for c in columns])))

        return rows.withColumn(probability, scored(*[F.col(f).cast("double") for f in self.features]))

    def save(self, path: str) -> None:
        rows = [(n.tree, n.node, n.feature, n.cut, n.value, n.cover, list(self.features), 0.0) for n in self.nodes]
        SparkSession.active().createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(path)


def _hash(*values: np.ndarray | int) -> np.ndarray:
    """64 bits of several integers."""
    x = np.uint64(0x243F6A8885A308D3)
    with np.errstate(over="ignore"):
        for v in values:
            x = x ^ (np.asarray(v).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return x


def copies(key: np.ndarray, model: int, seed: int) -> np.ndarray:
    """How often each row stands in a tree's bag."""
    share = (_hash(key, model, seed) >> np.uint64(11)).astype(float) / float(1 << 53)
    number = np.zeros(len(share), np.int64)
    for chance in _AT_MOST:
        number += share >= chance
    return number


def tried(model: int, node: np.ndarray, features: int, number: int, seed: int) -> np.ndarray:
    """The features each node may split on, ascending: those of the lowest hashes."""
    order = np.argsort(_hash(node[:, None], np.arange(features)[None, :], model, seed + 1), axis=1, kind="stable")
    return np.sort(order[:, :number], axis=1)


@dataclass
class _Pass:
    """The trees as they stand, as full heaps; rows of closed nodes are left out."""

    sets: list[tuple[int, ...]]
    settings: ForestSettings
    seed: int
    features: int
    bins: int
    level: int
    models: list[int]
    feature: np.ndarray  # [model, node]
    cut: np.ndarray
    weights: np.ndarray | None = None  # [model, class]
    open: dict[int, np.ndarray] = field(default_factory=dict)  # nodes of this level, ascending

    @property
    def tried(self) -> int:
        return self.settings.tried or max(1, int(self.features**0.5))

    def rows(self, model: int, batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """bins [feature, row], label and copies of the rows in the model's bag."""
        key, part, label, bins = batch
        number = copies(key, model, self.seed)
        rows = np.flatnonzero((number > 0) & np.isin(part, self.sets[model // self.settings.trees]))
        return bins[:, rows], label[rows], number[rows]

    def bags(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of each class in each bag."""
        total = {m: np.zeros(2, np.int64) for m in self.models}
        for batch in map(self.opened, batches):
            for m in self.models:
                _, label, number = self.rows(m, batch)
                total[m] += np.bincount(label, number, minlength=2).astype(np.int64)
        yield _sums(total)

    def opened(self, batch: pa.RecordBatch):
        key, part, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        fixed = batch.column(3).cast(pa.binary(self.features))
        bins = np.frombuffer(fixed.buffers()[1] or b"", np.uint8, len(fixed) * self.features, fixed.offset * self.features)
        bins = bins.reshape(-1, self.features)
        return key, part, label, np.ascontiguousarray(bins.T)

    def place(self, model: int, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(bins.shape[1], np.int64)
        rows, flat = np.arange(bins.shape[1]), bins.ravel()
        start, cut = self.feature[model].astype(np.int64) * bins.shape[1], self.cut[model]
        for _ in range(self.level):
            at = 2 * at + 1 + (flat.take(start.take(at) + rows) > cut.take(at))
        return at

    def counts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per model: copies by (open node, tried feature, bin, class)."""
        cell = self.bins * 2
        width = self.tried * cell
        total = {m: np.zeros(len(self.open[m]) * width, np.int64) for m in self.models}
        may = {m: tried(m, self.open[m], self.features, self.tried, self.seed) for m in self.models}
        first = 2**self.level - 1
        for batch in map(self.opened, batches):
            for m in self.models:
                x, label, number = self.rows(m, batch)
                slot = np.full(2**self.level, -1, np.int64)
                slot[self.open[m] - first] = np.arange(len(self.open[m]))
                slot = slot[self.place(m, x) - first]
                rows = np.flatnonzero(slot >= 0)
                slot, copied = slot[rows], number[rows].astype(float)
                at = may[m].T.take(slot, axis=1) * x.shape[1] + rows  # [tried feature, row]
                at = 2 * x.ravel().take(at).astype(np.int64) + (slot * width + label[rows])
                at += np.arange(self.tried)[:, None] * cell
                found = np.bincount(at.ravel(), np.tile(copied, self.tried), minlength=len(total[m]))
                total[m] += found.astype(np.int64)
        yield _sums(total)

    def choose(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """model, node, feature, cut (-1 if the node stays a leaf), copies of each class in the node and left of the cut."""
        out = []
        for m, flat in _summed(batches).items():
            nodes = self.open[m]
            counts = flat.reshape(len(nodes), self.tried, self.bins, 2)
            may = tried(m, nodes, self.features, self.tried, self.seed)
            weighted = counts * self.weights[m]
            left = weighted.cumsum(2)[:, :, :-1]
            whole = weighted[:, 0].sum(1)
            right = whole[:, None, None, :] - left

            def impurity(c):  # times the weight: 2 a b / (a + b)
                total = c.sum(-1)
                return np.divide(2.0 * c[..., 0] * c[..., 1], total, out=np.zeros_like(total), where=total > 0)

            seen = counts.cumsum(2)[:, :, :-1].sum(-1)
            fits = (seen > 0) & (seen < counts[:, 0].sum((1, 2))[:, None, None])
            gain = np.where(fits, impurity(whole)[:, None, None] - impurity(left) - impurity(right), -1.0)
            best = gain.reshape(len(nodes), -1).argmax(1)
            which, at = np.divmod(best, self.bins - 1)
            split = gain.reshape(len(nodes), -1)[np.arange(len(nodes)), best] > 1e-9
            inside = counts[:, 0].sum(1)
            passed = counts.cumsum(2)[np.arange(len(nodes)), which, at]
            out += [
                (m, int(n), int(may[i, which[i]]) if split[i] else -1, int(at[i]), *map(int, inside[i]), *map(int, passed[i]))
                for i, n in enumerate(nodes)
            ]
        names = [part.split() for part in CHOICE.split(", ")]
        columns = list(zip(*out)) if out else [[]] * len(names)
        arrays = [pa.array(c, pa.int64() if kind == "long" else pa.int32()) for c, (_, kind) in zip(columns, names)]
        yield pa.RecordBatch.from_arrays(arrays, [name for name, _ in names])


CHOICE = "model int, node int, feature int, cut int, c0 long, c1 long, l0 long, l1 long"


def _sums(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    values = pa.array([v.astype(np.int64).tobytes() for v in total.values()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), values], ["model", "sums"])


def _summed(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for model, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = np.frombuffer(sums, np.int64)
            total[model] = total[model] + found if model in total else found
    return total


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if total := _summed(batches):
        yield _sums(total)


def bag_weights(counts: np.ndarray) -> np.ndarray:
    """n / (2 n_class) of each bag, [model, class]."""
    return counts.sum(1, keepdims=True) / (2.0 * np.maximum(counts, 1))


def fit(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    part: str,
    key: str,
    sets: Sequence[Sequence[int]],
    settings: ForestSettings = ForestSettings(),
    seed: int = 0,
    bins: int = BINS,
) -> list[Forest]:
    """A forest for each set of parts."""
    spark = rows.sparkSession
    ship_package(spark)
    edges = cuts(rows, features, bins)
    models = len(sets) * settings.trees
    total = rows.count()
    tasks = max(-(-total // TASK_ROWS), min(-(-total * models // TASK_PAIRS), 2 * spark.sparkContext.defaultParallelism), 1)
    narrow = binned(rows, features, label, part, key, edges)
    state = written(narrow.repartition(tasks))

    def met(found: DataFrame, models_now: int) -> DataFrame:
        return found if tasks == 1 else found.repartition(min(models_now, 2 * tasks), "model")

    def work(level: int, now: list[int]) -> _Pass:
        return _Pass([tuple(s) for s in sets], settings, seed, len(features), bins, level, now, feature, cut, weights, opened)

    width = 2 ** (settings.max_depth + 1) - 1
    feature, cut = np.zeros((models, width), np.int16), np.full((models, width), 255, np.int16)
    weights, opened = None, {m: np.array([0]) for m in range(models)}
    every = list(range(models))
    table = met(state.mapInArrow(work(0, every).bags, "model int, sums binary"), models).mapInArrow(_added, "model int, sums binary").toArrow()
    bags = np.zeros((models, 2), np.int64)
    for m, v in zip(table.column(0).to_pylist(), table.column(1).to_pylist()):
        bags[m] = np.frombuffer(v, np.int64)
    weights = bag_weights(bags)

    tried_now = settings.tried or max(1, int(len(features) ** 0.5))
    nodes: list[list[Node]] = [[] for _ in sets]

    def leaf(m: int, node: int, c0: int, c1: int) -> None:
        w0, w1 = c0 * weights[m, 0], c1 * weights[m, 1]
        value = w1 / (w0 + w1) if w0 + w1 else 0.0
        nodes[m // settings.trees].append(Node(m % settings.trees, node, -1, 0.0, float(value), float(c0 + c1)))

    for level in range(settings.max_depth):
        ahead: dict[int, list[int]] = {m: [] for m in every}
        now = [m for m in every if len(opened[m])]
        while now:
            # as many models as fit into a task's counts
            size, taken = 0, 0
            while taken < len(now) and (not taken or size + len(opened[now[taken]]) * tried_now * bins * 2 <= MOST_CELLS):
                size += len(opened[now[taken]]) * tried_now * bins * 2
                taken += 1
            some, now = now[:taken], now[taken:]
            job = work(level, some)
            found = met(state.mapInArrow(job.counts, "model int, sums binary"), len(some)).mapInArrow(job.choose, CHOICE)
            for m, node, f, at, c0, c1, l0, l1 in zip(*(c.to_pylist() for c in found.toArrow().columns)):
                if f < 0:
                    leaf(m, node, c0, c1)
                    continue
                feature[m, node], cut[m, node] = f, at
                nodes[m // settings.trees].append(
                    Node(m % settings.trees, node, f, float(edges[f][at]), 0.0, float(c0 + c1))
                )
                if level + 1 == settings.max_depth:  # the children's copies are known
                    leaf(m, 2 * node + 1, l0, l1)
                    leaf(m, 2 * node + 2, c0 - l0, c1 - l1)
                else:
                    ahead[m] += [2 * node + 1, 2 * node + 2]
        opened = {m: np.array(sorted(n), np.int64) for m, n in ahead.items()}
    return [Forest(tuple(features), tuple(sorted(n, key=lambda x: (x.tree, x.node)))) for n in nodes]
