"""Weighted logistic regression by Newton steps, for several sets of rows in the passes of one.

Features are standardised by the mean and deviation of the rows a model learns from; the penalty is half the
squared length of the coefficients, without the intercept, as against the sum of the weighted losses. A pass gives, for each model, the
loss, the gradient and one weighted cross-product of all features: fixed numbers, whatever the rows. A step that raises the
loss is halved. Passes follow Newton steps, about ten, not models.

Missing features are read as the mean. A feature without spread has coefficient 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keepwell.session import ship_package

MOST_STEPS = 50
#: greatest entry of the gradient, per row, at which a model is done
TOLERANCE = 1e-9
#: sums of tasks meet in so many tasks
MEET = 8


@dataclass(frozen=True)
class Logistic:
    """Coefficients per standardised feature, and what standardises them."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    spread: tuple[float, ...]
    coefficients: tuple[float, ...]
    intercept: float
    steps: int = 0

    def margin(self) -> Column:
        terms = [
            (F.coalesce(F.col(f).cast("double"), F.lit(m)) - m) * (w / s)
            for f, m, s, w in zip(self.features, self.mean, self.spread, self.coefficients)
            if s and w
        ]
        return reduce(Column.__add__, terms, F.lit(self.intercept))

    def transform(self, rows: DataFrame, margin: str = "margin", probability: str = "probability") -> DataFrame:
        """``rows`` with the margin and the probability of class 1; plain columns."""
        return rows.withColumn(margin, self.margin()).withColumn(probability, 1.0 / (1.0 + F.exp(-F.col(margin))))

    def unscaled(self) -> dict[str, float]:
        """Coefficients per unit of each feature."""
        return {f: w / s if s else 0.0 for f, w, s in zip(self.features, self.coefficients, self.spread)}

    def save(self, path: str) -> None:
        rows = [(f, m, s, w, self.intercept) for f, m, s, w in zip(self.features, self.mean, self.spread, self.coefficients)]
        table = SparkSession.active().createDataFrame(rows, "feature string, mean double, spread double, coefficient double, intercept double")
        table.coalesce(1).write.mode("overwrite").parquet(path)


def _moments(rows: DataFrame, features: Sequence[str], part: str, sets: Sequence[Sequence[int]]):
    """(mean, deviation, rows) of each set, as sums of its parts' sums."""
    x = [F.col(f).cast("double") for f in features]
    sums = [F.count(c) for c in x] + [F.sum(c) for c in x]
    found = {r[0]: np.array([v or 0.0 for v in r[1:]], float) for r in rows.groupBy(part).agg(F.count(F.lit(1)), *sums).collect()}
    k = len(features)
    zero = np.zeros(1 + 2 * k)
    total = [sum((found.get(p, zero) for p in parts), zero) for parts in sets]
    mean = [t[1 + k :] / np.maximum(t[1 : 1 + k], 1.0) for t in total]
    # squares about the middle of all rows, so that large means cost no digits
    all_rows = sum(found.values(), zero)
    middle = all_rows[1 + k :] / np.maximum(all_rows[1 : 1 + k], 1.0)
    squares = [F.sum((c - F.lit(float(m))) * (c - F.lit(float(m)))) for c, m in zip(x, middle)]
    about = {r[0]: np.array([v or 0.0 for v in r[1:]], float) for r in rows.groupBy(part).agg(*squares).collect()}
    spread = []
    for parts, t, m in zip(sets, total, mean):
        n = np.maximum(t[1 : 1 + k], 1.0)
        square = sum((about.get(p, np.zeros(k)) for p in parts), np.zeros(k)) / n - (m - middle) ** 2
        spread.append(np.where(square > 1e-12 * np.maximum(1.0, m * m), np.sqrt(np.maximum(square, 0.0)), 0.0))
    return mean, spread, [int(t[0]) for t in total]


@dataclass
class _Pass:
    """Loss, gradient and cross-product of each model at its coefficients (the intercept last)."""

    sets: list[tuple[int, ...]]
    weights: list[tuple[float, float]]
    mean: list[np.ndarray]
    scale: list[np.ndarray]  # one over the deviation, or 0
    beta: dict[int, np.ndarray]
    width: int = field(default=0)

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(self.mean[0]) + 1
        total = {m: np.zeros(1 + k + k * k) for m in self.beta}
        for batch in batches:
            part, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            raw = np.column_stack([batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(k - 1)])
            for m, beta in self.beta.items():
                rows = np.flatnonzero(np.isin(part, self.sets[m]))
                if not len(rows):
                    continue
                x = np.ones((len(rows), k))
                x[:, :-1] = (np.where(np.isnan(raw[rows]), self.mean[m], raw[rows]) - self.mean[m]) * self.scale[m]
                y = label[rows].astype(float)
                w = np.where(y == 1, self.weights[m][1], self.weights[m][0])
                margin = x @ beta
                p = 1.0 / (1.0 + np.exp(-margin))
                # log(1 + exp(margin)) - y * margin, without overflow
                total[m][0] += (w * (np.logaddexp(0.0, margin) - y * margin)).sum()
                total[m][1 : 1 + k] += x.T @ (w * (p - y))
                total[m][1 + k :] += (x.T @ (x * (w * p * (1.0 - p))[:, None])).ravel()
        yield _sums(total)


def _sums(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    values = pa.array([v.tobytes() for v in total.values()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), values], ["model", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for model, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[model] = total.get(model, 0.0) + np.frombuffer(sums)
    if total:
        yield _sums(total)


def fit(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    part: str,
    sets: Sequence[Sequence[int]],
    weights: Sequence[tuple[float, float]],
    penalty: float = 1.0,
    rows_a_task: int = 250_000,
) -> list[Logistic]:
    """A model for each set of parts; ``weights`` are those of negatives and positives."""
    ship_package(rows.sparkSession)
    mean, spread, counts = _moments(rows, features, part, sets)
    narrow = rows.select(F.col(part).cast("int"), F.col(label).cast("int"), *[F.col(f).cast("double") for f in features])
    tasks = max(1, -(-max(counts, default=1) // rows_a_task))
    if tasks < narrow.rdd.getNumPartitions():
        narrow = narrow.coalesce(tasks)
    k = len(features) + 1
    ridge = np.full(k, penalty)
    ridge[-1] = 0.0
    scale = [np.divide(1.0, s, out=np.zeros_like(s), where=s > 0) for s in spread]
    accepted = {m: (np.zeros(k), np.inf) for m in range(len(sets))}  # coefficients, loss
    step = {m: np.zeros(k) for m in accepted}
    trial = {m: np.zeros(k) for m in accepted}
    passes = 0
    while trial and passes < MOST_STEPS:
        work = _Pass([tuple(s) for s in sets], list(weights), mean, scale, trial)
        found = narrow.mapInArrow(work.run, "model int, sums binary")
        if tasks > 1:
            found = found.repartition(min(MEET, len(trial)), "model").mapInArrow(_added, "model int, sums binary")
        table = found.toArrow()
        # a single task per model is left; more than one where there was nothing to add up
        sums: dict[int, np.ndarray] = {}
        for m, v in zip(table.column(0).to_pylist(), table.column(1).to_pylist()):
            sums[m] = sums.get(m, 0.0) + np.frombuffer(v)
        passes += 1
        for m in list(trial):
            beta = trial[m]
            loss = sums[m][0] + 0.5 * (ridge * beta * beta).sum()
            gradient = sums[m][1 : 1 + k] + ridge * beta
            before, least = accepted[m]
            if loss > least + 1e-12 * abs(least):
                step[m] = step[m] / 2.0
                if np.abs(step[m]).max() < 1e-12:
                    del trial[m]
                else:
                    trial[m] = before + step[m]
                continue
            accepted[m] = (beta, loss)
            if np.abs(gradient).max() <= TOLERANCE * max(counts[m], 1):
                del trial[m]
                continue
            hessian = sums[m][1 + k :].reshape(k, k) + np.diag(ridge)
            # features without spread have an empty row and column
            step[m] = -np.linalg.lstsq(hessian, gradient, rcond=1e-12)[0] * np.r_[scale[m] > 0, True]
            trial[m] = beta + step[m]
    return [
        Logistic(
            tuple(features), tuple(map(float, mean[m])), tuple(map(float, spread[m])),
            tuple(map(float, accepted[m][0][:-1])), float(accepted[m][0][-1]), passes,
        )
        for m in range(len(sets))
    ]
