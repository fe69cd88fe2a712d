"""Second-order boosted trees: many models grown side by side in the passes of one.

Rows are binned to bytes once. A pass over them sums gradients and Hessians by (model, node, feature,
bin), so the number of jobs follows depth x trees, however many settings and folds are fitted. Only
the smaller child of a split is summed; its sibling is the parent minus it. The tasks' histograms meet by model in
tasks, which keep them for the next level and choose the best splits; only splits reach the driver.

* The loss is the logistic one; positives of a model weigh ``weight``. A split gains
  GL^2/(HL+1) + GR^2/(HR+1) - G^2/(H+1), needs a Hessian of 1 on each side, and goes to the first feature and
  lowest cut on ties. A leaf is -G/(H+1) times the learning rate.
* Gradients and Hessians are rounded to multiples of 2^-20, so sums are exact up to 2^33 and do
  not depend on how the rows are dealt out; a task that is run again adds the same numbers.
* The rows of a tree's subsample follow from a hash of (row key, tree), so repeated keys share their fate.
* The binned rows stay in the executors as blocks of arrays, with the margins of all models; every
  ``STATE_EVERY`` trees new margins take their place, and a pass adds the trees since then. Hundreds of short passes over
  partitions' own state are what RDDs are for: a pass takes a quarter of the time that a planned query does. A lost block is made
  again from the written table of bins and at most ``REPLAY`` trees' steps.
* A block holds ``PIECE_ROWS`` rows of one part and the margins of the models that learn from it, so that a task works on one while the next
  comes. Features with few bins are counted together, as one feature with a bin for each combination, and gradients and Hessians are
  added as one number.
* All this is done by Python where one task holds all rows. Blocks of several tasks, their margins and histograms stay in the executors' JVM, where
  Boosting.java does the same: through Python's sockets, the margins of all models would come anew in each pass.

Missing and NaN features lie in the lowest bin and go left.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.serializers import NoOpSerializer
from pyspark.sql import DataFrame, SparkSession, functions as F

from keepwell.session import java_array, java_classes, ship_package, written

BINS = 64
#: L2 penalty of leaves, least Hessian of a child, least gain
PENALTY, LEAST_HESSIAN, LEAST_GAIN = 1.0, 1.0, 1e-6
STATE_EVERY = 2
#: after so many trees margins are made from the bins anew, so that lineage stays short
REPLAY = 32
#: (row, model) pairs that a task of a small fit works on, and rows that a task of a large one does
TASK_PAIRS, TASK_ROWS = 200_000, 500_000
#: rows of a block, and bins that features counted together have at most
PIECE_ROWS, JOINT_BINS = 1 << 15, 1 << 13
#: rows of a task for each of these bins: few rows would be lost among many bins
ROWS_A_BIN = 8
#: nodes of so many levels are compared side by side, those of deeper levels row by row
SIDE_BY_SIDE = 6
_UNIT = float(1 << 20)
#: numbers that tell the choice of a node
CHOICE = 9
#: low bits of a number that hold a sum of Hessians, and rows of weight 1 that a cell takes before its two sums could meet
HESSIAN_BITS, PACKED_ROWS = 31, 4095


@dataclass(frozen=True)
class BoostSettings:
    max_depth: int = 4
    learning_rate: float = 0.05
    trees: int = 100
    subsample: float = 1.0


@dataclass(frozen=True)
class Learner:
    """A model to fit: its settings, the parts of the rows it learns from, the weight of positives."""

    settings: BoostSettings
    parts: tuple[int, ...]
    weight: float


@dataclass(frozen=True)
class Node:
    """A row of a model's table of nodes; leaves have feature -1, their value is a margin."""

    tree: int
    node: int
    feature: int
    cut: float
    value: float
    cover: float


NODES = "tree int, node int, feature int, cut double, value double, cover double, features array<string>, base double"


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: nodes are numbered as a heap, the children of i are 2i + 1 (value <= cut) and 2i + 2."""

    features: tuple[str, ...]
    nodes: tuple[Node, ...]
    base: float = 0.0

    @property
    def trees(self) -> int:
        return 1 + max((n.tree for n in self.nodes), default=-1)

    def first(self, trees: int) -> BoostedTrees:
        """The model as it was after so many trees."""
        return BoostedTrees(self.features, tuple(n for n in self.nodes if n.tree < trees), self.base)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """feature, cut, value, cover as [tree, node]."""
        width = 1 + max((n.node for n in self.nodes), default=0)
        feature = np.full((self.trees, width), -1, np.int64)
        cut, value, cover = (np.zeros((self.trees, width)) for _ in range(3))
        for n in self.nodes:
            feature[n.tree, n.node], cut[n.tree, n.node] = n.feature, n.cut
            value[n.tree, n.node], cover[n.tree, n.node] = n.value, n.cover
        return feature, cut, value, cover

    def heaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """feature and cut as [tree, node] and the values of the lowest level, as if no branch ended above it."""
        feature, cut, value, _ = self.arrays()
        first = 2 ** (feature.shape[1].bit_length() - 1) - 1
        more = ((0, 0), (0, 2 * first + 1 - feature.shape[1]))
        feature, cut, value = np.pad(feature, more, constant_values=-1), np.pad(cut, more), np.pad(value, more)
        for node in range(first):
            leaf = feature[:, node] < 0
            for child in (2 * node + 1, 2 * node + 2):
                value[leaf, child] = value[leaf, node]
        return np.maximum(feature, 0), np.where(feature < 0, np.inf, cut), value[:, first:]

    def margins_after(self, x: np.ndarray, trees: Sequence[int]) -> list[np.ndarray]:
        """The margins of the rows of ``x`` after each of so many trees."""
        feature, cut, value = self.heaps()
        levels = value.shape[1].bit_length() - 1
        columns = np.ascontiguousarray(x.T)
        now, found = np.full(len(x), self.base), {0: np.full(len(x), self.base)}
        for t in range(min(max(trees), self.trees)):
            now += value[t].take(placed(columns, feature[t], cut[t], levels))
            if t + 1 in trees:
                found[t + 1] = now.copy()
        return [found.get(n, now) for n in trees]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The margin of each row of ``x``."""
        return self.margins_after(x, [self.trees])[0]

    def transform(self, rows: DataFrame, margin: str = "margin", probability: str = "probability") -> DataFrame:
        """``rows`` with the margin and the probability of class 1."""
        ship_package(rows.sparkSession)
        shared = rows.sparkSession.sparkContext.broadcast(self)  # a few thousand nodes

        @F.pandas_udf("double")
        def scored(*columns):
            import pandas as pd

            return pd.Series(shared.value.margins(np.column_stack([c.to_numpy("float64") for c in columns])))

        found = rows.withColumn(margin, scored(*[F.col(f).cast("double") for f in self.features]))
        return found.withColumn(probability, 1.0 / (1.0 + F.exp(-F.col(margin))))

    def table(self) -> DataFrame:
        rows = [(n.tree, n.node, n.feature, n.cut, n.value, n.cover, list(self.features), self.base) for n in self.nodes]
        return SparkSession.active().createDataFrame(rows, NODES)

    def save(self, path: str) -> None:
        self.table().coalesce(1).write.mode("overwrite").parquet(path)


def leaves(x: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The leaf of one tree that each row of ``x`` comes to; NaN goes left."""
    at = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while (inner := feature[at] >= 0).any():
        right = x[rows, np.maximum(feature[at], 0)] > cut[at]
        at = np.where(inner, 2 * at + 1 + right, at)
    return at


def placed(columns: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row (``columns`` is [feature, row]) after so many levels of a full heap, counted from the first of its level."""
    at = np.zeros(columns.shape[1], np.uint8)
    path: list[np.ndarray] = []
    for level in range(min(levels, SIDE_BY_SIDE)):
        first = 2**level - 1
        right = [(columns[feature[n]] > cut[n].item()).view(np.uint8) for n in range(first, 2 * first + 1)]
        for turn in reversed(path):  # the last turn decides between neighbours
            right = [a ^ (turn & (a ^ b)) for a, b in zip(right[::2], right[1::2])]
        path.append(right[0])
        at = at * np.uint8(2) + right[0]
    if levels <= SIDE_BY_SIDE:
        return at
    at, rows = at.astype(np.int64), np.arange(columns.shape[1])
    for level in range(SIDE_BY_SIDE, levels):
        node = at + 2**level - 1
        at = 2 * at + (columns[feature[node], rows] > cut[node])
    return at


def load(spark: SparkSession, path: str) -> BoostedTrees:
    rows = spark.read.parquet(path).orderBy("tree", "node").collect()
    nodes = tuple(Node(r["tree"], r["node"], r["feature"], r["cut"], r["value"], r["cover"]) for r in rows)
    return BoostedTrees(tuple(rows[0]["features"]), nodes, rows[0]["base"])


# -- binning -----------------------------------------------------------------

def cuts(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending cuts of each feature: quantiles at even steps, equal ones once."""
    steps = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    values = F.array(*[F.nanvl(F.col(f).cast("double"), F.lit(None)) for f in features])
    # one row a feature, so that the tasks' sketches of different features meet in different tasks
    found = rows.select(F.posexplode(values).alias("feature", "x")).groupBy("feature").agg(
        F.percentile_approx("x", steps, F.lit(100_000)).alias("cuts")
    ).collect()
    known = {r["feature"]: r["cuts"] for r in found}
    return [np.unique(np.array(known.get(i) or [], float)) for i in range(len(features))]


def binned(
    rows: DataFrame, features: Sequence[str], label: str, part: str, key: str, edges: Sequence[np.ndarray]
) -> DataFrame:
    """key, part, label and bins (one byte a feature) of every row."""
    ship_package(rows.sparkSession)
    names = list(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, len(names)), np.uint8)
            for i, edge in enumerate(edges):
                x = batch.column(3 + i).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                out[:, i] = np.searchsorted(edge, np.where(np.isnan(x), -np.inf, x), "left")
            bins = pa.array([r.tobytes() for r in out], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], bins], ["key", "part", "label", "bins"])

    narrow = rows.select(
        F.col(key).cast("long").alias("key"), F.col(part).cast("int").alias("part"), F.col(label).cast("int").alias("label"),
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(names)],
    )
    return narrow.mapInArrow(run, "key long, part int, label int, bins binary")


@dataclass
class Block:
    """Some rows of a part: ``bins`` is [feature, row], ``margins`` [model that learns from the part, row]."""

    key: np.ndarray
    part: int
    label: np.ndarray
    bins: np.ndarray
    margins: np.ndarray | None = None  # all zero


def gathered(rows: DataFrame, features: int, size: int = PIECE_ROWS) -> DataFrame:
    """part, key, label and bins ([feature, row]) of up to so many rows of a part, all as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, ...]]] = {}

        def packed(part: int, columns: list[np.ndarray]) -> pa.RecordBatch:
            key, label, bins = columns
            binary = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (key, label, bins.T)]
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *binary], ["part", "key", "label", "bins"])

        for batch in batches:
            key, part, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            bins = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, features)
            for p in np.unique(part).tolist():
                mine = np.flatnonzero(part == p)
                waiting.setdefault(p, []).append((key[mine], label[mine], bins[mine]))
                if sum(len(x[0]) for x in waiting[p]) >= size:
                    columns = [np.concatenate(x) for x in zip(*waiting.pop(p))]
                    whole = len(columns[0]) // size * size
                    for start in range(0, whole, size):
                        yield packed(p, [x[start : start + size] for x in columns])
                    if whole < len(columns[0]):
                        waiting[p] = [tuple(x[whole:] for x in columns)]
        for p, left in waiting.items():
            yield packed(p, [np.concatenate(x) for x in zip(*left)])

    return rows.mapInArrow(run, "part int, key binary, label binary, bins binary")


def _blocks(rows: Iterator) -> Iterator[Block]:
    for part, key, label, bins in rows:
        key = np.frombuffer(key, np.int64)
        yield Block(key, part, np.frombuffer(label, np.int32), np.frombuffer(bins, np.uint8).reshape(-1, len(key)))


def together(widths: Sequence[int], most: int = JOINT_BINS) -> list[list[int]]:
    """Features dealt out so that those of a group have at most so many combinations of bins, if more than one."""
    groups: list[list[int]] = []
    size: list[int] = []
    for f in sorted(range(len(widths)), key=lambda f: (-widths[f], f)):
        for i, taken in enumerate(size):
            if taken * widths[f] <= most:
                groups[i].append(f)
                size[i] *= widths[f]
                break
        else:
            groups.append([f])
            size.append(widths[f])
    return groups


# -- growing -----------------------------------------------------------------

def salt(tree: int, seed: int) -> int:
    """What a tree and the seed add to a row's key, as a signed number of 64 bits."""
    mixed = (tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03
    return (mixed + (1 << 63)) % (1 << 64) - (1 << 63)


def in_sample(key: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Whether each row is drawn for the tree: a hash of its key, the tree and the seed."""
    if share >= 1.0:
        return np.ones(len(key), bool)
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64(salt(tree, seed) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53) < share


def gradients(margin: np.ndarray, label: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted logistic loss, rounded to multiples of 2^-20."""
    g, h = _units(margin, label, np.where(label == 1, weight, 1.0))
    return g / _UNIT, h / _UNIT


def _units(margin: np.ndarray, label: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The derivatives in units of 2^-20, for rows of these weights."""
    p = np.negative(margin)
    np.exp(p, out=p)
    p += 1.0
    np.divide(1.0, p, out=p)
    g = p - label
    g *= weights
    g *= _UNIT
    h = weights * p
    h *= np.subtract(1.0, p, out=p)
    h *= _UNIT
    return np.rint(g, out=g).astype(np.int64), np.rint(h, out=h).astype(np.int64)


class Sums:
    """Sums of gradients and Hessians by cell, in units.

    Both are added as one number while no cell can hold so many rows that the Hessians reach the gradients' bits.
    """

    def __init__(self, cells: int, weight: float):
        self.both = np.zeros(cells, np.int64)
        self.total: np.ndarray | None = None
        self.rows, self.most = 0, int(PACKED_ROWS / max(weight, 1.0))

    def add(self, cell: np.ndarray, both: np.ndarray, rows: int) -> None:
        """Adds gradients (high bits) and Hessians (low bits) to their cells, none of which gets more than so many rows."""
        if rows > self.most:
            for out, units in zip(self.unpack(), _unpacked(both)):
                np.add.at(out, cell, units)
            return
        if self.rows + rows > self.most:
            self.unpack()
        self.rows += rows
        np.add.at(self.both, cell, both)

    def unpack(self) -> np.ndarray:
        """The sums as [2, cell]."""
        if self.total is None:
            self.total = np.stack(_unpacked(self.both))
        elif self.rows:
            for out, units in zip(self.total, _unpacked(self.both)):
                out += units
        if self.rows:
            self.both[:], self.rows = 0, 0
        return self.total


def _packed(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (g << HESSIAN_BITS) + h


def _unpacked(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return both >> HESSIAN_BITS, both & ((1 << HESSIAN_BITS) - 1)


class Grown:
    """The trees of all models while they grow, as full heaps: below a leaf everything goes left to its value.

    ``open`` lists the nodes of the level whose histograms are wanted: (model, node, slot).
    """

    def __init__(self, learners: Sequence[Learner]):
        self.learners = list(learners)
        depth = max(x.settings.max_depth for x in learners)
        self.width = 2 ** (depth + 1) - 1
        self.restart()

    def restart(self) -> None:
        shape = (len(self.learners), self.width)
        self.feature = np.zeros(shape, np.int64)
        self.cut = np.full(shape, 255, np.int64)  # all bins go left
        self.value = np.zeros(shape)
        self.cover = np.zeros(shape)
        self.inner = np.zeros(shape, bool)
        self.real = np.zeros(shape, bool)

    def place(self, model: int, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row (``bins`` is [feature, row]) after so many levels, counted from the first of its level."""
        return placed(bins, self.feature[model], self.cut[model], levels)

    def below(self, model: int, levels: int) -> np.ndarray:
        """The values of the nodes after so many levels."""
        return self.value[model, 2**levels - 1 : 2 ** (levels + 1) - 1]


@dataclass
class _Pass:
    """What a task needs to know: the finished trees since the stored margins and the one that grows."""

    learners: list[Learner]
    active: list[int]
    recent: list[Grown]
    growing: Grown
    level: int
    tree: int
    seed: int
    #: for each model, the slot of each node of this level or -1
    slots: dict[int, np.ndarray]
    #: bins of each feature, and bins that features counted together have at most
    widths: list[int]
    joint: int

    def learning(self, part: int) -> list[int]:
        """The models whose margins a block of the part holds."""
        return [m for m, x in enumerate(self.learners) if part in x.parts]

    def margins(self, model: int, bins: np.ndarray, stored: np.ndarray, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        out = stored[rows].copy() if isinstance(rows, slice) else _of(stored, rows)
        depth = self.learners[model].settings.max_depth
        for grown in self.recent:
            at = grown.place(model, bins, depth)
            out += _of(grown.below(model, depth), at[rows] if isinstance(rows, slice) else _of(at, rows))
        return out

    def histograms(self, blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        """For each model its summed gradients and Hessians as [2, slot, bins of all features in turn]."""
        groups = together(self.widths, self.joint)
        cells = [int(np.prod([self.widths[f] for f in g])) for g in groups]
        number = {m: self.slots[m].max(initial=-1) + 1 for m in self.active}
        total = {m: [Sums(number[m] * c, self.learners[m].weight) for c in cells] for m in self.active}
        for block in blocks:
            models = [(i, m) for i, m in enumerate(self.learning(block.part)) if m in total]
            bins, label, key, zero = block.bins, block.label, block.key, np.zeros(len(block.key))
            codes = []
            for group in groups:
                code = bins[group[0]].astype(np.intp)
                for f in group[1:]:
                    code *= self.widths[f]
                    code += bins[f]
                codes.append(code)
            most = [int(np.bincount(code).max()) for code in codes]
            positive = (label == 1).astype(np.intp)
            weights = {w: _of(np.array([1.0, w]), positive) for w in {self.learners[m].weight for _, m in models}}
            drawn = {s: in_sample(key, self.tree, s, self.seed) for s in {self.learners[m].settings.subsample for _, m in models}}
            drawn = {s: None if mask.all() else mask for s, mask in drawn.items()}
            some = {s: None if mask is None else np.flatnonzero(mask) for s, mask in drawn.items()}
            taken = {} if self.level else {s: codes if rows is None else [_of(c, rows) for c in codes] for s, rows in some.items()}
            for i, m in models:
                learner = self.learners[m]
                share = learner.settings.subsample
                stored = zero if block.margins is None else block.margins[i]
                slot = None
                if self.level:
                    at = self.growing.place(m, bins, self.level)
                    wanted = _of(self.slots[m] >= 0, at)
                    if drawn[share] is not None:
                        wanted &= drawn[share]
                    rows = np.flatnonzero(wanted)
                    if not len(rows):
                        continue
                    mine = [_of(c, rows) for c in codes]
                    if number[m] > 1:
                        slot = _of(self.slots[m], _of(at, rows))
                else:
                    rows = slice(None) if some[share] is None else some[share]
                    mine = taken[share]
                margin = self.margins(m, bins, stored, rows)
                whole = isinstance(rows, slice)
                w, y = weights[learner.weight], label
                both = _packed(*_units(margin, y if whole else _of(y, rows), w if whole else _of(w, rows)))
                for out, code, c, n in zip(total[m], mine, cells, most):
                    if slot is not None:
                        code += slot * c
                    out.add(code, both, n)
        for m in self.active:
            yield m, self.apart([x.unpack() for x in total[m]], groups, int(number[m])) / _UNIT

    def apart(self, sums: list[np.ndarray], groups: list[list[int]], slots: int) -> np.ndarray:
        """The sums of each feature's own bins."""
        found: dict[int, np.ndarray] = {}
        for group, joint in zip(groups, sums):
            joint = joint.reshape(2, slots, *[self.widths[f] for f in group])
            for i, f in enumerate(group):
                found[f] = joint.sum(tuple(2 + j for j in range(len(group)) if j != i))
        return np.concatenate([found[f] for f in range(len(self.widths))], axis=2)

    def stored(self, block: Block) -> Block:
        """The rows with their margins brought up to date."""
        models = self.learning(block.part)
        now = np.zeros((len(models), len(block.key))) if block.margins is None else block.margins.copy()
        for i, m in enumerate(models):
            if m in self.active:
                now[i] = self.margins(m, block.bins, now[i])
        return Block(block.key, block.part, block.label, block.bins, now)


def _of(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The values at places that are known to exist; checking each one would take longer than the rest."""
    return values.take(places, mode="clip")


def _stepped(block: Block, steps: Sequence[_Pass]) -> Block:
    for step in steps:
        block = step.stored(block)
    return block


def best_splits(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature, bin) of the best cut of each node's [node, feature, bin] sums; bins up to it go left."""
    left_g, left_h = np.cumsum(g, 2)[:, :, :-1], np.cumsum(h, 2)[:, :, :-1]
    all_g, all_h = (x[:, 0].sum(1)[:, None, None] for x in (g, h))
    right_g, right_h = all_g - left_g, all_h - left_h

    def score(a, b):
        return a * a / (b + PENALTY)

    gain = score(left_g, left_h) + score(right_g, right_h) - score(all_g, all_h)
    gain = np.where((left_h >= LEAST_HESSIAN) & (right_h >= LEAST_HESSIAN), gain, -np.inf).reshape(len(g), -1)
    best = gain.argmax(1)
    return gain[np.arange(len(g)), best], *np.divmod(best, g.shape[2] - 1)


@dataclass
class _Level:
    """The open nodes of all models, and which are summed next; the others are their parents minus these."""

    nodes: dict[int, list[int]]  # nodes that may be split
    summed: dict[int, list[int]]  # those among them that tasks sum

    def slots(self, level: int) -> dict[int, np.ndarray]:
        out = {}
        for m, nodes in self.summed.items():
            slot = np.full(2**level, -1, np.int64)
            slot[np.array(nodes, np.int64) - (2**level - 1)] = np.arange(len(nodes))
            out[m] = slot
        return out


def choices(histograms: np.ndarray, widths: Sequence[int], bins: int) -> np.ndarray:
    """Of each node's [2, node, bins of all features in turn]: gain, feature, cut, sums in the node, left and right of the cut."""
    nodes = histograms.shape[1]
    table = np.zeros((nodes, 2, len(widths), bins))
    for f, (end, width) in enumerate(zip(np.cumsum(widths), widths)):
        table[:, :, f, :width] = histograms[:, :, end - width : end].swapaxes(0, 1)
    gain, feature, cut = best_splits(table[:, 0], table[:, 1])
    chosen = table[np.arange(nodes), :, feature]  # [node, 2, bin]
    left = np.where(np.arange(bins) <= cut[:, None, None], chosen, 0.0).sum(2)
    return np.column_stack([gain, feature, cut, table[:, :, 0].sum(2), left, chosen.sum(2) - left])


def _split(level: _Level, choices: Mapping[int, np.ndarray], grown: Grown, depth_now: int, both: bool) -> _Level:
    """Split or close every open node; returns the next level, of which the smaller or ``both`` children are summed."""
    ahead = _Level({}, {})
    for m, nodes in level.nodes.items():
        if not nodes:
            continue
        settings = grown.learners[m].settings
        ahead.nodes[m], ahead.summed[m] = [], []
        for node, (gain, feature, cut, all_g, all_h, *sides) in zip(nodes, choices[m].tolist()):
            grown.real[m, node], grown.cover[m, node] = True, all_h
            if depth_now >= settings.max_depth or gain <= LEAST_GAIN:
                _close(grown, m, node, -all_g / (all_h + PENALTY) * settings.learning_rate)
                continue
            grown.inner[m, node], grown.feature[m, node], grown.cut[m, node] = True, int(feature), int(cut)
            left, right = 2 * node + 1, 2 * node + 2
            left_g, left_h, right_g, right_h = sides
            if depth_now + 1 == settings.max_depth:  # sums of the children are known, so no pass is needed
                for child, child_g, child_h in ((left, left_g, left_h), (right, right_g, right_h)):
                    grown.real[m, child], grown.cover[m, child] = True, child_h
                    _close(grown, m, child, -child_g / (child_h + PENALTY) * settings.learning_rate)
                continue
            ahead.nodes[m] += [left, right]
            ahead.summed[m] += [left, right] if both else [left if left_h <= right_h else right]
    return ahead


def _close(grown: Grown, model: int, node: int, value: float) -> None:
    """A leaf: its value stands at every node below it, as rows go on to the left."""
    grown.value[model, node] = value
    while 2 * node + 1 < grown.width:
        node = 2 * node + 1
        grown.value[model, node] = value


class _Passes:
    """The passes over the blocks, their margins, and the finished trees that these do not hold yet."""

    def __init__(self, base):
        self.base = self.state = base
        self.stale = None  # margins that are no longer needed once the next ones are made
        self.recent, self.since = [], []  # trees since the margins stored now, steps from the bins to these

    def made(self) -> None:
        """The first pass over the new margins has made them."""
        if self.stale is not None:
            self.stale.unpersist()
            self.stale = None

    def store(self, step, tree: int) -> None:
        self.since.append(step)
        anew = (tree + 1) % REPLAY == 0
        self.stale = None if self.state is self.base else self.state
        self.state = self.stepped(self.base if anew else self.state, list(self.since) if anew else [step])
        self.recent = []

    def close(self) -> None:
        self.state.unpersist()
        self.base.unpersist()


class _OneTask(_Passes):
    """Few rows: a task of Python sums both children of a split."""

    def __init__(self, table: DataFrame, learners: Sequence[Learner], widths: list[int], seed: int, rows: int, bins: int):
        super().__init__(table.coalesce(1).rdd.mapPartitions(_blocks).persist(StorageLevel.MEMORY_AND_DISK_DESER))
        self.learners, self.widths, self.seed, self.bins = list(learners), widths, seed, bins
        self.joint = min(JOINT_BINS, rows // ROWS_A_BIN)

    def _pass(self, models: list[int], grown: Grown, depth: int, tree: int, slots: dict[int, np.ndarray]) -> _Pass:
        return _Pass(self.learners, models, self.recent, grown, depth, tree, self.seed, slots, self.widths, self.joint)

    def choices(self, level: _Level, grown: Grown, depth: int, tree: int) -> Mapping[int, np.ndarray]:
        work = self._pass([m for m, nodes in level.summed.items() if nodes], grown, depth, tree, level.slots(depth))
        widths, bins = self.widths, self.bins
        found = self.state.mapPartitions(work.histograms).mapValues(lambda x: choices(x, widths, bins)).collectAsMap()
        self.made()
        return found

    def grown(self, grown: Grown, active: list[int], tree: int, last: bool) -> None:
        self.recent.append(grown)
        if len(self.recent) == STATE_EVERY and not last:
            self.store(self._pass(active, grown, 0, tree, {}), tree)

    def stepped(self, state, steps: list[_Pass]):
        return state.map(lambda block: _stepped(block, steps)).persist(StorageLevel.MEMORY_AND_DISK_DESER)


def _ints(values) -> bytes:
    return np.asarray(values, ">i4").tobytes()


def _doubles(values) -> bytes:
    return np.asarray(values, ">f8").tobytes()


class _ManyTasks(_Passes):
    """Many rows: their blocks, margins and histograms stay in the executors' JVM, see Boosting.java."""

    def __init__(self, table: DataFrame, learners: Sequence[Learner], widths: list[int], seed: int, choosing: int):
        self.spark, self.seed, self.models, self.choosing = table.sparkSession, seed, len(learners), choosing
        self.classes, self.constructors = java_classes(self.spark, __package__, "Boosting.java"), {}
        context = self.spark.sparkContext
        self.kept = context._getJavaStorageLevel(StorageLevel.MEMORY_AND_DISK_DESER)
        super().__init__(table._jdf.toJavaRDD().map(self._new("Open")).persist(self.kept))
        parts = 1 + max(p for x in learners for p in x.parts)
        settings = [x.settings for x in learners]
        self.learners = self._new(
            "Learners", self.models, len(widths), _ints([s.max_depth for s in settings]), bytes(p in x.parts for x in learners for p in range(parts)),
            _doubles([x.weight for x in learners]), _doubles([s.subsample for s in settings]),
        )
        self.offsets = _ints(np.cumsum([0, *widths]))
        self.nothing = context._jsc.parallelize(context._jvm.java.util.ArrayList(), choosing)
        self.before = self.nothing

    def _new(self, name: str, *arguments):
        if name not in self.constructors:
            (self.constructors[name],) = self.classes.loadClass(f"keepwell.Boosting${name}").getConstructors()
        return self.constructors[name].newInstance(java_array(self.spark, arguments))

    def _array(self, items):
        return java_array(self.spark, items)

    def _trees(self, grown: Grown):
        return self._new("Trees", grown.width, _ints(grown.feature.ravel()), _ints(grown.cut.ravel()), _doubles(grown.value.ravel()))

    def _listed(self, nodes: Mapping[int, Sequence[int]]) -> bytes:
        lists = [nodes.get(m, []) for m in range(self.models)]
        return _ints([*map(len, lists), *(n for x in lists for n in x)])

    def choices(self, level: _Level, grown: Grown, depth: int, tree: int) -> Mapping[int, np.ndarray]:
        slots = np.full((self.models, 2**depth), -1)
        for m, slot in level.slots(depth).items():
            slots[m] = slot
        work = self._new(
            "Histograms", self.learners, self._array(self.recent), self._trees(grown), depth, str(salt(tree, self.seed)), self.offsets,
            _ints(slots.ravel()),
        )
        choose = self._new(
            "Choose", self.models, self.offsets, self._listed(level.nodes), self._listed(level.summed), PENALTY, LEAST_HESSIAN
        )
        sums = self.state.mapPartitionsToPair(work).reduceByKey(self._new("Add"), self.choosing)
        # the histograms of the level before lie where the sums of their models go
        chosen = sums.zipPartitions(self.before if depth else self.nothing, choose).persist(self.kept)
        told = RDD(chosen.map(self._new("Told")), self.spark.sparkContext, NoOpSerializer()).collect()
        self._next(chosen)
        self.made()
        found = (np.frombuffer(x, ">f8").astype(float) for x in told)
        return {int(x[0]): x[1:].reshape(-1, CHOICE) for x in found}

    def _next(self, chosen) -> None:
        if self.before is not self.nothing:
            self.before.unpersist()
        self.before = chosen

    def grown(self, grown: Grown, active: list[int], tree: int, last: bool) -> None:
        self._next(self.nothing)
        self.recent.append(self._trees(grown))
        if len(self.recent) == STATE_EVERY and not last:
            learning = bytes(m in active for m in range(self.models))
            self.store([(trees, learning) for trees in self.recent], tree)

    def stepped(self, state, steps: list[list[tuple]]):
        trees, active = zip(*(x for step in steps for x in step))
        return state.map(self._new("Step", self.learners, self._array(trees), self._array(active))).persist(self.kept)


def fit(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    part: str,
    key: str,
    learners: Sequence[Learner],
    seed: int = 0,
    bins: int = BINS,
) -> list[BoostedTrees]:
    """The model of each learner. ``part`` numbers the disjoint parts of the rows that learners choose from."""
    spark = rows.sparkSession
    edges = cuts(rows, features, bins)
    total, at_once = rows.count(), spark.sparkContext.defaultParallelism
    tasks = max(-(-total // TASK_ROWS), min(-(-total * len(learners) // TASK_PAIRS), at_once), 1)
    if tasks > at_once:  # whole rounds
        tasks = -(-tasks // at_once) * at_once
    table = written(gathered(binned(rows, features, label, part, key, edges).repartition(tasks), len(features)))
    widths = [len(e) + 1 for e in edges]
    alone = tasks == 1  # a single task sums both children and needs no histograms of the level before
    passes = _OneTask(table, learners, widths, seed, total, bins) if alone else _ManyTasks(table, learners, widths, seed, min(tasks, len(learners)))
    most = max(x.settings.trees for x in learners)
    nodes: list[list[Node]] = [[] for _ in learners]
    for tree in range(most):
        active = [m for m, x in enumerate(learners) if tree < x.settings.trees]
        grown = Grown(learners)
        level, depth = _Level({m: [0] for m in active}, {m: [0] for m in active}), 0
        while any(level.nodes.values()):
            level = _split(level, passes.choices(level, grown, depth, tree), grown, depth, alone)
            depth += 1
        for m in active:
            for node in np.flatnonzero(grown.real[m]).tolist():
                inner = bool(grown.inner[m, node])
                feature = int(grown.feature[m, node]) if inner else -1
                cut = float(edges[feature][grown.cut[m, node]]) if inner else 0.0
                value = 0.0 if inner else float(grown.value[m, node])
                nodes[m].append(Node(tree, node, feature, cut, value, float(grown.cover[m, node])))
        passes.grown(grown, active, tree, tree + 1 == most)
    passes.close()
    return [BoostedTrees(tuple(features), tuple(n)) for n in nodes]
