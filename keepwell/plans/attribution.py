"""Why a customer got their score: exact Shapley values of linear and tree models.

Tree models: a task walks each tree once, from the root, with all rows of a batch side by
side. Going down an edge extends the path by its feature: the share of training weight that goes this way
(feature unknown) and whether the row does (feature known). The path carries, for each number of known features, the
summed weight of the coalitions of that size. At a leaf each feature is unwound once, which gives its part of the leaf's
value; nodes share the work of their common path.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.exprs import rounded
from keepwell.operators.boosting import BoostedTrees
from keepwell.operators.logistic import Logistic
from keepwell.operators.sampling import seeded_sample
from keepwell.session import ship_package
from keepwell.settings import FEATURES, SEED

# --- fixed values -----------------------------------------------------------
HIGHER = "Pushes Risk HIGHER"
LOWER = "Lowers Risk"
# --- end of fixed values ----------------------------------------------------

IMPACT = "struct<feature:string,value:double,shap_impact:double,direction:string>"


def direction(impact: Column) -> Column:
    return F.when(impact > 0, HIGHER).otherwise(LOWER)


def top_factors(impacts: Mapping[str, Column], values: Mapping[str, Column], top_n: int) -> Column:
    """Array of the top_n (feature, value, shap_impact, direction) by absolute impact.

    Equal impacts keep the feature order.
    """
    entries = F.array(
        *[
            F.struct(
                (-F.abs(impact)).alias("_order"),
                F.lit(i).alias("_place"),
                F.lit(name).alias("feature"),
                values[name].cast("double").alias("value"),
                impact.alias("shap_impact"),
                direction(impact).alias("direction"),
            )
            for i, (name, impact) in enumerate(impacts.items())
        ]
    )
    return F.transform(
        F.slice(F.array_sort(entries), 1, top_n),
        lambda e: F.struct(
            e["feature"].alias("feature"),
            e["value"].alias("value"),
            e["shap_impact"].alias("shap_impact"),
            e["direction"].alias("direction"),
        ),
    )


# -- linear models -----------------------------------------------------------

def feature_means(rows: DataFrame, features: Sequence[str] = tuple(FEATURES)) -> dict[str, float]:
    """Mean of each feature (one row of numbers)."""
    row = rows.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features]).first()
    return {f: row[f] for f in features}


def linear_impacts(
    coefficients: Mapping[str, float], means: Mapping[str, float]
) -> dict[str, Column]:
    """Shapley values of a linear score: coefficient x (value - mean)."""
    return {
        f: F.lit(float(w)) * (F.col(f).cast("double") - F.lit(float(means[f])))
        for f, w in coefficients.items()
    }


def linear_coefficients(model: Logistic) -> dict[str, float]:
    """Coefficients of a logistic model, per unit of the unscaled feature."""
    return model.unscaled()


# -- tree models -------------------------------------------------------------

class _Path:
    """Features on the way down, and the weight of coalitions by size, for every pattern of turns that a row may share.

    ``share`` is one number a feature, ``follows`` one 0/1 value a pattern; ``weight[s]`` sums the coalitions of s known features.
    """

    def __init__(self, features: list[int], share: list[float], follows: list[np.ndarray], weight: list[np.ndarray]):
        self.features, self.share, self.follows, self.weight = features, share, follows, weight

    def doubled(self) -> _Path:
        """Each pattern twice: for one more turn that a row does not or does share."""
        return _Path(self.features, self.share, *([x.repeat(2) for x in xs] for xs in (self.follows, self.weight)))

    def extended(self, feature: int, share: float, follows: np.ndarray) -> _Path:
        n = len(self.weight)
        weight = [*self.weight, np.ones(len(follows)) if not n else np.zeros(len(follows))]
        for s in range(n - 1, -1, -1):
            weight[s + 1] = weight[s + 1] + follows * weight[s] * ((s + 1) / (n + 1))
            weight[s] = share * weight[s] * ((n - s) / (n + 1))
        return _Path([*self.features, feature], [*self.share, share], [*self.follows, follows], weight)

    def unwound(self, i: int) -> list[np.ndarray]:
        """The weights as they were had feature ``i`` never been met."""
        n, share, follows = len(self.weight) - 1, self.share[i], self.follows[i]
        known = follows > 0
        carried, out = self.weight[n], [None] * n
        for s in range(n - 1, -1, -1):
            with_it = carried * ((n + 1) / (s + 1))
            without = self.weight[s] * ((n + 1) / (share * (n - s))) if share else np.zeros(len(follows))
            out[s] = np.where(known, with_it, without)
            carried = np.where(known, self.weight[s] - with_it * share * ((n - s) / (n + 1)), carried)
        return out

    def without(self, i: int) -> _Path:
        keep = [j for j in range(len(self.features)) if j != i]
        return _Path([self.features[j] for j in keep], [self.share[j] for j in keep], [self.follows[j] for j in keep], self.unwound(i))


#: for each tree and leaf, the features on its path and what they add by pattern: 2^depth doubles each
Impacts = list[dict[int, list[tuple[int, np.ndarray]]]]


def leaf_impacts(model: BoostedTrees) -> Impacts:
    """What each leaf adds to the features on its path; it depends on a row only by which turns of the path the row takes too.

    Patterns of turns are numbered as binary numbers, the first turn highest.
    """
    feature, _, value, cover = model.arrays()
    found: Impacts = []
    for t in range(model.trees):
        leaves = {}

        def walk(node: int, path: _Path) -> None:
            f = int(feature[t, node])
            if f < 0:
                leaves[node] = [
                    (path.features[i], sum(path.unwound(i)) * (path.follows[i] - path.share[i]) * value[t, node])
                    for i in range(1, len(path.features))
                ]
                return
            path = path.doubled()
            taken = np.arange(len(path.weight[0])) % 2 == 1
            share, follows = 1.0, np.ones(len(taken))
            if f in path.features:  # both conditions on the feature become one
                i = path.features.index(f)
                share, follows = path.share[i], path.follows[i]
                path = path.without(i)
            for child in (2 * node + 1, 2 * node + 2):
                walk(child, path.extended(f, share * cover[t, child] / cover[t, node], follows * taken))

        walk(0, _Path([], [], [], []).extended(-1, 1.0, np.ones(1)))
        found.append(leaves)
    return found


def tree_shapley(x: np.ndarray, model: BoostedTrees, impacts: Impacts | None = None) -> np.ndarray:
    """Shapley values of the margin, [row, feature]; unknown features follow the training weight of the nodes."""
    feature, cut, _, _ = model.arrays()
    columns = np.ascontiguousarray(x.T)
    out = np.zeros((len(model.features), len(x)))
    for t, leaves in enumerate(leaf_impacts(model) if impacts is None else impacts):

        def walk(node: int, pattern: np.ndarray) -> None:
            if node in leaves:
                for f, impact in leaves[node]:
                    out[f] += impact.take(pattern)
                return
            right = columns[feature[t, node]] > cut[t, node]  # NaN goes left
            for child, goes in ((2 * node + 1, ~right), (2 * node + 2, right)):
                walk(child, 2 * pattern + goes)

        walk(0, np.zeros(len(x), np.int64))
    return np.ascontiguousarray(out.T)


def expected_margin(model: BoostedTrees) -> float:
    """Mean model margin: every leaf weighted by its share of the training weight."""
    feature, _, value, cover = model.arrays()
    # a leaf has a cover, numbers that name no node do not
    inside = np.where(feature < 0, cover, 0.0)
    return float(model.base + (value * inside).sum(1) @ (1.0 / cover[:, 0]))


def tree_impacts(
    rows: DataFrame, model: BoostedTrees, keep: Sequence[str] = ("customer_unique_id",)
) -> DataFrame:
    """keep columns and ``impacts``: one Shapley value per feature, of the model margin."""
    spark = rows.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # a few thousand nodes
    features, keep = list(model.features), list(keep)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_leaves = leaf_impacts(shared.value)
        for batch in batches:
            impacts = tree_shapley(batch[features].to_numpy("float64"), shared.value, of_leaves)
            yield batch[keep].assign(impacts=list(impacts))

    source = rows.select(*keep, *[F.col(f).cast("double").alias(f) for f in features if f not in keep])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    return source.mapInPandas(explain, f"{schema}, impacts array<double>")


def tree_attribution(
    rows: DataFrame, model: BoostedTrees, top_n: int = 5, keep: Sequence[str] = ()
) -> DataFrame:
    """customer_unique_id, kept columns and ``important_factors`` (the top_n impacts)."""
    features = model.features
    carried = ["customer_unique_id", *features, *[c for c in keep if c not in features]]
    explained = tree_impacts(rows, model, keep=carried)
    impacts = {f: F.col("impacts")[i] for i, f in enumerate(features)}
    values = {f: F.col(f) for f in features}
    return explained.select(
        "customer_unique_id", *keep, top_factors(impacts, values, top_n).alias("important_factors")
    )


# -- global importance -------------------------------------------------------

def importance_from_impacts(explained: DataFrame, features: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """feature, importance: mean absolute impact, largest first."""
    long = explained.select(F.posexplode("impacts").alias("_i", "impact"))
    names = F.array(*[F.lit(f) for f in features])
    return (
        long.groupBy(F.element_at(names, F.col("_i") + 1).alias("feature"))
        .agg(rounded(F.avg(F.abs("impact")), 5).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def _chosen(rows: DataFrame, sample: int | None, seed: int) -> DataFrame:
    return rows if sample is None else seeded_sample(rows, "customer_unique_id", sample, seed)


def global_tree_importance(
    rows: DataFrame, model: BoostedTrees, sample: int | None = None, seed: int = SEED
) -> DataFrame:
    """Over all rows; ``sample`` draws that many first."""
    return importance_from_impacts(tree_impacts(_chosen(rows, sample, seed), model), model.features)


def global_linear_importance(
    rows: DataFrame, coefficients: Mapping[str, float], sample: int | None = None, seed: int = SEED
) -> DataFrame:
    """The same for a linear score; means are taken over all rows."""
    impacts = linear_impacts(coefficients, feature_means(rows, list(coefficients)))
    explained = _chosen(rows, sample, seed).select(F.array(*impacts.values()).alias("impacts"))
    return importance_from_impacts(explained, list(coefficients))
