"""Neighbours, synthetic rows, models, attribution and clusters."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import boosting, kmeans, neighbours
from keepwell.operators.forest import ForestSettings
from keepwell.plans import attribution, modelling, segmentation
from keepwell.session import materialize
from keepwell.settings import FEATURES
from keepwell.sources import writers

FOLDER = "/root/testdata/sf0.001"
kmeans_move = kmeans._Move


@pytest.fixture(scope="module")
def rows(spark):
    from catalogue import panel_frame
    from keepwell.sources.star import role_tables

    return materialize(panel_frame(role_tables(spark, FOLDER)))


def brute_neighbours(points, k):
    out = {}
    for i, p in points.items():
        ranked = sorted((math.dist(p, q), j) for j, q in points.items() if j != i)
        out[i] = [d for d, _ in ranked[:k]]
    return out


def test_neighbours_across_cells_and_blocks(spark, monkeypatch):
    """Small blocks force clusters, split cells and searches in other cells; 60 rows are equal."""
    monkeypatch.setattr(neighbours, "_BLOCK_ROWS", 25)
    rng = np.random.default_rng(1)
    points = {i: [float(x) for x in rng.normal(size=3) * (1 + i % 4)] for i in range(240)}
    points.update({240 + i: [0.5, 0.5, 0.5] for i in range(60)})
    df = spark.createDataFrame([(i, *p) for i, p in points.items()], "id long, x double, y double, z double")
    got = {r["row_id"]: [n["distances"] for n in r["near"]] for r in neighbours.nearest(df, ["x", "y", "z"], "id", 5, 7).collect()}
    expected = brute_neighbours(points, 5)
    assert set(got) == set(points)
    for i in points:
        assert got[i] == pytest.approx(expected[i], abs=1e-12), i


def test_rows_visit_few_blocks(spark, monkeypatch):
    """Visits grow slower than the square, and a row leaves out blocks that another row of its block needs."""
    monkeypatch.setattr(neighbours, "_BLOCK_ROWS", 20)
    counted = []
    visits = neighbours.visits

    def watched(placed, own, *args):
        out = materialize(visits(placed, own, *args))
        sizes = {r[0]: r[1] for r in placed.groupBy("block").count().collect()}
        pairs = out.select("own", "block").distinct().collect()
        counted.append((out.count(), sum(sizes[r.own] for r in pairs)))
        return out

    monkeypatch.setattr(neighbours, "visits", watched)
    rng = np.random.default_rng(3)
    for n in (400, 800):
        data = [(i, float(rng.normal()), float(rng.normal() * 5)) for i in range(n)]
        df = spark.createDataFrame(data, "id long, x double, y double")
        assert neighbours.nearest(df, ["x", "y"], "id", 3, 1).count() == n
    rows, by_blocks = zip(*counted)
    assert 0 < rows[0] and rows[1] < 3.2 * rows[0]  # all rows and blocks would be four times as many
    assert rows[0] < 0.6 * by_blocks[0] and rows[1] < 0.6 * by_blocks[1]  # rows that travelled with their block's pairs


def test_too_few_minority_rows_are_an_error(spark):
    rows = spark.createDataFrame([(i, float(i), int(i < 3)) for i in range(20)], "id long, x double, y int")
    with pytest.raises(ValueError, match="3 rows of the minority"):
        neighbours.synthetic_minority(rows, ["x"], "y", "id", 5)
    with pytest.raises(ValueError, match="nothing to balance"):
        neighbours.synthetic_minority(rows.filter("y = 0"), ["x"], "y", "id", 5)


def test_fallback_split_repeats_for_recurring_customers(rows):
    every = rows.drop("split_role")
    parts = [modelling.split(every.repartition(n)) for n in (1, 7)]
    keys = ["customer_unique_id", "snapshot_date"]
    for role in ("train", "val", "test"):
        a, b = (sorted(map(tuple, p[role].select(*keys).collect())) for p in parts)
        assert a == b and a


def test_importance_covers_all_rows(rows):
    weights = {"recency_days": 1.0}
    current = rows.filter("split_role = 'test'")
    mean = current.agg(F.avg("recency_days")).first()[0]
    want = current.agg(F.avg(F.abs(F.col("recency_days") - mean))).first()[0]
    got = attribution.global_linear_importance(current, weights).first()["importance"]
    assert got == pytest.approx(want, abs=1e-4)


def test_synthetic_rows_balance_and_lie_between_neighbours(spark):
    data = [(i, float(i), 0.0, 1) for i in range(10)] + [(100 + i, 5.0, 5.0, 0) for i in range(37)]
    train = spark.createDataFrame(data, "id long, x double, z double, y int")
    make = lambda: neighbours.synthetic_minority(train, ["x", "z"], "y", "id", 3, 42)
    out = make().toPandas()
    assert out["y"].value_counts().to_dict() == {0: 37, 1: 37}
    made = out[out["y"] == 1]
    assert made["x"].between(0, 9).all() and (made["z"] == 0).all()
    again = make().toPandas()
    assert sorted(map(tuple, out.to_numpy())) == sorted(map(tuple, again.to_numpy()))


def test_split_report_and_fallback(rows):
    parts = modelling.split(rows)
    assert {r["split_role"] for r in modelling.split_report(parts).collect()} == {"train", "val", "test"}
    current = rows.filter("split_role = 'test'").drop("split_role")
    fallback = modelling.split(current)
    total = sum(df.count() for df in fallback.values())
    assert total == current.count()


def test_weights(spark):
    assert modelling.balanced_weights((3, 1)) == (4 / 6, 2.0)
    assert modelling.positive_weight((3, 1)) == 3.0 and modelling.positive_weight((3, 0)) == 3.0
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "part int, is_churned int")
    counts = modelling.LabelCounts(df)
    assert counts.of((0,)) == (1, 1) and counts.of((0, 1)) == (1, 2) and counts.parts == [0, 1]


def test_grid_has_sixteen_combinations():
    assert len(set(modelling.grid_settings())) == 16


@pytest.fixture(scope="module")
def trained(rows):
    settings = [modelling.BoostSettings(2, 0.1, 5), modelling.BoostSettings(3, 0.1, 8, 0.8)]
    return modelling.train_champion(rows, settings, folds=2)


def test_champion(trained, rows):
    champion, grid = trained
    assert grid.count() == 2 and grid.filter("is_best").count() == 1
    best = grid.orderBy(F.desc("mean_roc_auc")).first()
    assert (best["max_depth"], best["trees"]) == (champion.settings.max_depth, champion.settings.trees)
    roles = {r["split_role"]: r for r in champion.metrics.collect()}
    assert set(roles) == {"val", "test"} and all(0 <= r["roc_auc"] <= 1 for r in roles.values())
    assert champion.thresholds.count() == 50
    assert champion.scored_test.count() == rows.filter("split_role = 'test'").count()


def test_model_is_saved_and_scores_the_same(trained, rows, tmp_path):
    champion, _ = trained
    writers.save_model(champion.model, str(tmp_path / "model"))
    again = boosting.load(rows.sparkSession, str(tmp_path / "model"))
    before = modelling.score_rows(champion.model, rows, ["customer_unique_id", "snapshot_date"])
    after = modelling.score_rows(again, rows, ["customer_unique_id", "snapshot_date"])
    assert before.exceptAll(after).isEmpty()


def test_comparison_of_quick_candidates(rows):
    quick = {
        "logistic": modelling.CANDIDATES["Logistic Regression (Balanced)"],
        "oversampled": modelling.CANDIDATES["Logistic Regression + SMOTE"],
        "forest": lambda df, sets: modelling.fit_forest(df, sets, ForestSettings(5, 3)),
        "boosted": lambda df, sets: modelling.fit_boosted(df, sets, modelling.BoostSettings(2, 0.1, 3)),
    }
    parts = modelling.split(rows)
    got = modelling.compare_models(parts["train"], quick, folds=2).collect()
    assert {r["model"] for r in got} == set(quick)
    assert all(0.0 <= r["cv_roc_auc_mean"] <= 1.0 for r in got)
    table = modelling.holdout_comparison(parts["train"], parts["test"], {"logistic": quick["logistic"]}).first()
    n = parts["test"].count()
    assert table["true_positives"] + table["false_positives"] + table["true_negatives"] + table["false_negatives"] == n
    assert table["business_cost_050"] == table["false_positives"] * 10 + table["false_negatives"] * 120


def test_folds_of_a_search_equal_separate_fits(rows):
    """The grid's held-out scores are those of models fitted one by one."""
    train = modelling.in_folds(rows.filter("split_role = 'train'"), 2, 5)
    grid = modelling.Grid([modelling.BoostSettings(2, 0.1, 3), modelling.BoostSettings(2, 0.1, 5)])
    assert grid.longest == grid.settings[1:] and grid.holder(grid.settings[0]) == 0
    models = [modelling.fit_boosted(train, modelling.without(2), grid.settings[1], 5)]
    got = modelling.held_out_scores(train, grid, models)
    assert got.count() == 2 * train.count()
    for number, settings in enumerate(grid.settings):
        for fold in (0, 1):
            (alone,) = modelling.fit_boosted(train, [(1 - fold,)], settings, 5)
            want = modelling.score_rows(alone, train.filter(F.col("part") == fold))
            mine = got.filter((F.col("model") == number) & (F.col("fold") == fold)).select("label", "p")
            rounded = [sorted((r.label, round(r.p, 9)) for r in x.collect()) for x in (mine, want)]
            assert rounded[0] == rounded[1] and rounded[0]


def test_logistic_attribution_adds_up(spark, rows):
    train = rows.filter("split_role = 'train'").withColumn("part", F.lit(0))
    (model,) = modelling.fit_logistic(train, [(0,)])
    means = attribution.feature_means(train)
    impacts = attribution.linear_impacts(attribution.linear_coefficients(model), means)
    got = model.transform(train).select(sum(impacts.values()).alias("total"), "margin").toPandas()
    assert (got["margin"] - got["total"]).std() < 1e-6


# -- tree attribution against the definition ---------------------------------

def _conditional(model, x, known):
    """Expected margin when only some features are known."""
    feature, cut, value, cover = model.arrays()

    def below(t, node):
        f = feature[t, node]
        if f < 0:
            return value[t, node]
        left, right = 2 * node + 1, 2 * node + 2
        if f in known:
            return below(t, right if x[f] > cut[t, node] else left)
        return (cover[t, left] * below(t, left) + cover[t, right] * below(t, right)) / cover[t, node]

    return model.base + sum(below(t, 0) for t in range(model.trees))


def _shapley(model, x, features):
    n, out = len(features), {}
    for f in features:
        others = [g for g in features if g != f]
        value = 0.0
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for subset in itertools.combinations(others, size):
                value += weight * (_conditional(model, x, {*subset, f}) - _conditional(model, x, set(subset)))
        out[f] = value
    return out


def test_tree_attribution_is_the_shapley_value_and_adds_up(spark, trained, rows):
    model = trained[0].model
    sample = rows.filter("split_role = 'test'").limit(40)
    explained = attribution.tree_impacts(sample, model, keep=["customer_unique_id", *FEATURES]).toPandas()
    margins = model.transform(sample).select("customer_unique_id", "margin").toPandas().set_index("customer_unique_id")["margin"]
    base = attribution.expected_margin(model)
    assert base == pytest.approx(_conditional(model, [0.0] * 17, set()), abs=1e-9)
    for row in explained.itertuples():
        assert base + sum(row.impacts) == pytest.approx(margins[row.customer_unique_id], abs=1e-9)
    top = attribution.tree_attribution(sample, model, top_n=4).first()["important_factors"]
    sizes = [abs(f["shap_impact"]) for f in top]
    assert len(top) == 4 and sizes == sorted(sizes, reverse=True)
    assert all((f["shap_impact"] > 0) == (f["direction"] == attribution.HIGHER) for f in top)
    importance = attribution.global_tree_importance(rows.filter("split_role = 'test'"), model).collect()
    assert [r["feature"] for r in importance] and importance[0]["importance"] >= importance[-1]["importance"]


def test_shapley_values_by_definition():
    """Deep trees that meet a feature several times on one path."""
    rng = np.random.default_rng(8)
    nodes = []
    for tree in range(3):
        cover = {0: 64.0}
        for node in range(31):
            if node not in cover:
                continue
            if node >= 15 or (node > 2 and rng.random() < 0.2):
                nodes.append(boosting.Node(tree, node, -1, 0.0, float(rng.normal()), cover[node]))
                continue
            nodes.append(boosting.Node(tree, node, int(rng.integers(3)), float(rng.normal()), 0.0, cover[node]))
            share = rng.uniform(0.1, 0.9)
            cover[2 * node + 1], cover[2 * node + 2] = cover[node] * share, cover[node] * (1 - share)
    model = boosting.BoostedTrees(("a", "b", "c", "d"), tuple(nodes), 0.25)
    x = rng.normal(size=(12, 4))
    got = attribution.tree_shapley(x, model)
    for row, found in zip(x, got):
        want = _shapley(model, row, [0, 1, 2, 3])
        assert found == pytest.approx([want[f] for f in range(4)], abs=1e-9)
    assert got.sum(1) + attribution.expected_margin(model) == pytest.approx(model.margins(x))


def test_shapley_work_on_paths_does_not_grow_with_the_rows(monkeypatch):
    """A leaf's impacts are worked out for each pattern of turns, whatever the number of rows."""
    nodes = [(0, 0, 0.1, 9.0), (1, 1, 0.2, 6.0), (2, 0, 0.7, 3.0), (3, -1, 0.5, 2.0), (4, 1, 1.0, 4.0), (5, -1, -2.0, 1.0), (6, -1, 1.5, 2.0)]
    nodes += [(9, -1, 3.0, 3.0), (10, -1, -1.0, 1.0)]
    tree = [boosting.Node(0, n, f, v if f >= 0 else 0.0, 0.0 if f >= 0 else v, cover) for n, f, v, cover in nodes]
    model = boosting.BoostedTrees(("a", "b"), tuple(tree))
    sizes, extended = [], attribution._Path.extended
    monkeypatch.setattr(attribution._Path, "extended", lambda self, f, share, follows: sizes.append(len(follows)) or extended(self, f, share, follows))
    x = np.random.default_rng(3).normal(size=(500, 2))
    x[::9, 0], x[::7, 1] = np.nan, np.nan
    got = attribution.tree_shapley(x, model)
    assert max(sizes) == 8 and len(sizes) == len(tree)
    for i in range(0, 500, 21):
        want = _shapley(model, x[i], [0, 1])
        assert got[i] == pytest.approx([want[0], want[1]], abs=1e-9)


# -- clusters ----------------------------------------------------------------

def test_silhouette_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    points = [(i, float(rng.normal()), float(rng.normal()), int(i % 3 if i < 29 else 9)) for i in range(30)]
    df = spark.createDataFrame(points, "id long, x double, z double, c int")
    got = segmentation.silhouettes(df, ["x", "z"], ["c"]).first()["silhouette"]
    values = []
    for i, x, z, c in points:
        sums = {}
        for j, u, v, d in points:
            if j != i:
                sums.setdefault(d, []).append(math.dist((x, z), (u, v)) ** 2)
        if c not in sums:
            values.append(0.0)
            continue
        a = np.mean(sums[c])
        b = min(np.mean(v) for d, v in sums.items() if d != c)
        values.append((b - a) / max(a, b))
    assert got == pytest.approx(np.mean(values), abs=1e-4)


def test_euclidean_silhouette_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(segmentation, "_BLOCK_ROWS", 7)  # several blocks meet
    rng = np.random.default_rng(2)
    points = [(i, float(rng.normal()), float(rng.normal()), int(i % 3 if i < 29 else 9), "ab"[i % 2]) for i in range(30)]
    df = spark.createDataFrame(points, "customer_unique_id long, x double, z double, c int, e string")
    got = {r[0]: r[1] for r in segmentation.euclidean_silhouettes(df, ["x", "z"], ["c", "e"]).collect()}
    for name, at in (("c", 3), ("e", 4)):
        values = []
        for p in points:
            sums = {}
            for q in points:
                if q[0] != p[0]:
                    sums.setdefault(q[at], []).append(math.dist(p[1:3], q[1:3]))
            if p[at] not in sums:
                values.append(0.0)
                continue
            a, b = np.mean(sums[p[at]]), min(np.mean(v) for d, v in sums.items() if d != p[at])
            values.append((b - a) / max(a, b))
        assert got[name] == pytest.approx(np.mean(values), abs=1e-4)


def plain_kmeans(x, keys, k, restart):
    """One fit, row by row and step by step."""
    centres = []
    for step in range(k):
        weight = [min(((p - c) ** 2).sum() for c in centres) if centres else 1.0 for p in x]
        u = kmeans._uniform(keys, restart, step)
        centres.append(x[min((i for i in range(len(x)) if weight[i] > 0), key=lambda i: -math.log(u[i]) / weight[i])])
    centres = np.array(centres)
    while True:
        own = np.array([min(range(k), key=lambda j: ((p - centres[j]) ** 2).sum()) for p in x])
        cost = sum(((p - centres[j]) ** 2).sum() for p, j in zip(x, own))
        moved = np.array([x[own == j].mean(0) if (own == j).any() else centres[j] for j in range(k)])
        if ((moved - centres) ** 2).sum() <= kmeans.TOLERANCE * x.var(0).mean():
            return centres, cost
        centres = moved


def test_shared_kmeans_equals_separate_plain_runs(spark, monkeypatch):
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(m, 0.6, size=(40, 2)) for m in ((0, 0), (3, 1), (1, 4))])
    keys = np.arange(120) * 37 + 5
    df = spark.createDataFrame([(int(i), *map(float, p)) for i, p in zip(keys, x)], "id long, x double, z double")
    passes = []
    monkeypatch.setattr(kmeans, "_Move", lambda centres: (passes.append(len(centres)), kmeans_move(centres))[1])
    got = kmeans.fit(df.repartition(3), ["x", "z"], "id", [2, 3, 5], 3, 100)
    for k in (2, 3, 5):
        runs = [plain_kmeans(x, keys, k, 100 + r) for r in range(3)]
        centres, cost = min(runs, key=lambda r: r[1])
        assert got[k].cost == pytest.approx(cost) and np.allclose(sorted(got[k].centres), sorted(map(tuple, centres)))
    assert passes[0] == 9 and len(passes) < 60  # nine fits share each pass
    labels = df.withColumn("c", got[3].nearest()).collect()
    assert all(r.c == min(range(3), key=lambda j: (r.x - got[3].centres[j][0]) ** 2 + (r.z - got[3].centres[j][1]) ** 2) for r in labels)


def test_fewer_rows_than_clusters(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 5.0)], "id long, x double")
    assert kmeans.fit(df, ["x"], "id", [4], 1, 0)[4].cost == 0.0
    with pytest.raises(ValueError, match="no rows"):
        kmeans.fit(df.limit(0), ["x"], "id", [2], 1, 0)


def test_segments_of_separate_groups(spark):
    groups = [(5.0, 9, 5000.0), (300.0, 1, 900.0), (40.0, 3, 200.0), (400.0, 1, 20.0)]
    data = [(f"c{g}_{i}", r + i % 3, f, m + i % 5) for g, (r, f, m) in enumerate(groups) for i in range(20)]
    rfm = spark.createDataFrame(data, "customer_unique_id string, recency double, frequency int, monetary double")
    customers, profile, model = segmentation.segment_customers(rfm, 4, restarts=3)
    got = customers.withColumn("g", F.substring("customer_unique_id", 2, 1)).groupBy("g").agg(
        F.count_distinct("cluster_id").alias("n"), F.first("cluster_segment").alias("s")
    )
    names = {r["g"]: (r["n"], r["s"]) for r in got.collect()}
    assert names == {
        "0": (1, "Champions & High-Value VIPs"),
        "1": (1, "At-Risk High Spenders"),
        "2": (1, "Loyal & Consistent"),
        "3": (1, "Hibernating / One-Time Buyers"),
    }
    spends = [r["avg_monetary"] for r in profile.collect()]
    assert spends == sorted(spends, reverse=True)
    scores = {r["k"]: r for r in segmentation.evaluate_k(rfm, (2, 4), restarts=2).collect()}
    assert scores[4]["inertia"] < scores[2]["inertia"] and scores[4]["silhouette"] > scores[2]["silhouette"]
