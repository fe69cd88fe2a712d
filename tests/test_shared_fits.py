"""Boosting, forests and logistic regression fitted for several sets of rows at once, against plain loops."""

import pickle

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from keepwell.operators import boosting, forest, logistic

NAMES = ["x", "y", "z"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(160, 3))
    x[:, 1] = np.round(x[:, 1])  # ties
    x[5, 0] = np.nan
    label = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=160) > 0.4).astype(int)
    label[5] = 1
    return x, label, np.arange(160) % 3


@pytest.fixture(scope="module")
def rows(spark, data):
    x, label, part = data
    out = [(int(i) * 7919, *(None if np.isnan(v) else float(v) for v in x[i]), int(label[i]), int(part[i]), 0.5) for i in range(len(x))]
    return spark.createDataFrame(out, "id long, x double, y double, z double, churned int, part int, margins double")


LEARNERS = [
    boosting.Learner(boosting.BoostSettings(3, 0.3, 6, 0.7), (0, 1), 2.0),
    boosting.Learner(boosting.BoostSettings(2, 0.1, 4, 1.0), (0, 1, 2), 1.0),
]


def binned(x, edges):
    low = np.where(np.isnan(x), -np.inf, x)
    return np.column_stack([np.searchsorted(e, low[:, i], "left") for i, e in enumerate(edges)])


def plain_boosting(x, label, part, edges, learner, seed, bins):
    """One model, one row and one cut at a time."""
    b, keys = binned(x, edges), np.arange(len(x)) * 7919
    margin, nodes, s = np.zeros(len(x)), [], learner.settings
    for tree in range(s.trees):
        drawn = boosting.in_sample(keys, tree, s.subsample, seed)
        g, h = boosting.gradients(margin, label, learner.weight)
        learns = [i for i in range(len(x)) if part[i] in learner.parts and drawn[i]]

        def grow(node, depth, mine, everyone):
            sum_g, sum_h = sum(g[i] for i in mine), sum(h[i] for i in mine)
            best = (1e-6, None, None)
            if depth < s.max_depth:
                for f in range(x.shape[1]):
                    for c in range(bins - 1):
                        left = [i for i in mine if b[i, f] <= c]
                        lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                        rg, rh = sum_g - lg, sum_h - lh
                        if lh < 1.0 or rh < 1.0:
                            continue
                        gain = lg * lg / (lh + 1) + rg * rg / (rh + 1) - sum_g * sum_g / (sum_h + 1)
                        if gain > best[0]:
                            best = (gain, f, c)
            _, f, c = best
            if f is None:
                value = -sum_g / (sum_h + 1) * s.learning_rate
                nodes.append((tree, node, -1, 0.0, value, sum_h))
                for i in everyone:
                    margin[i] += value
                return
            nodes.append((tree, node, f, edges[f][c], 0.0, sum_h))
            for child, side in ((2 * node + 1, lambda i: b[i, f] <= c), (2 * node + 2, lambda i: b[i, f] > c)):
                grow(child, depth + 1, [i for i in mine if side(i)], [i for i in everyone if side(i)])

        grow(0, 0, learns, list(range(len(x))))
    return sorted(nodes)


def table(nodes):
    return [(n.tree, n.node, n.feature, n.cut, n.value, n.cover) for n in nodes]


def test_boosting_equals_a_plain_loop(rows, data):
    edges = boosting.cuts(rows, NAMES, 8)
    models = boosting.fit(rows, NAMES, "churned", "part", "id", LEARNERS, 3, 8)
    for model, learner in zip(models, LEARNERS):
        want = plain_boosting(*data, edges, learner, 3, 8)
        assert len(want) > 20 and [n[:3] for n in table(model.nodes)] == [n[:3] for n in want]
        assert np.allclose([n[3:] for n in table(model.nodes)], [n[3:] for n in want], rtol=1e-12, atol=1e-12)


def test_boosting_does_not_depend_on_the_parts(rows, monkeypatch):
    one = boosting.fit(rows, NAMES, "churned", "part", "id", LEARNERS, 3, 8)
    monkeypatch.setattr(boosting, "TASK_PAIRS", 40)  # several tasks, sums that meet, margins stored after each tree
    monkeypatch.setattr(boosting, "STATE_EVERY", 1)
    again = boosting.fit(rows.repartition(5, "z"), NAMES, "churned", "part", "id", LEARNERS, 3, 8)
    assert [m.nodes for m in one] == [m.nodes for m in again]


@pytest.mark.parametrize("weight", [0.61, 3.0, 400.0])  # the heaviest leaves no room for two sums in a number
def test_sums_of_crowded_cells_are_exact(weight):
    rng = np.random.default_rng(7)
    sums, want = boosting.Sums(5, weight), np.zeros((2, 5))
    for _ in range(3):
        label = (rng.random(6000) < 0.5).astype(np.int32)
        margin, cell = rng.normal(size=6000) * 9, np.minimum(rng.integers(0, 9, 6000), 4)
        g, h = boosting.gradients(margin, label, weight)
        for rows in np.array_split(np.arange(6000), 4):  # few and many rows in turn
            units = [np.rint(x[rows] * 2.0**20).astype(np.int64) for x in (g, h)]
            sums.add(cell[rows], boosting._packed(*units), int(np.bincount(cell[rows]).max()))
        want += [np.bincount(cell, x, minlength=5) for x in (g, h)]
    assert (sums.unpack() / 2.0**20).tolist() == want.tolist() == (sums.unpack() / 2.0**20).tolist()


def test_rows_are_gathered_by_part(spark):
    rows = [(i, i % 3, i % 2, bytes([i % 251, i % 7])) for i in range(1000)]
    spread = spark.createDataFrame(rows, "key long, part int, label int, bins binary").repartition(2, "part")
    blocks = boosting.gathered(spread, 2, 50).rdd.mapPartitions(boosting._blocks).collect()
    assert sorted(zip(*map(list, (
        np.concatenate([b.key for b in blocks]),
        np.concatenate([np.full(len(b.key), b.part) for b in blocks]),
        np.concatenate([b.label for b in blocks]),
        [r.tobytes() for b in blocks for r in np.ascontiguousarray(b.bins.T)],
    )))) == rows
    assert {len(b.key) for b in blocks} == {50, 33, 34} and len(blocks) == 21


def test_few_rows_reach_python_again(rows, monkeypatch):
    """Binned rows come from the table as blocks, one row for each, and not one by one."""
    seen, blocks = [], boosting.written

    def watched(df):
        out = blocks(df)
        seen.append(out.count())
        return out

    monkeypatch.setattr(boosting, "written", watched)
    boosting.fit(rows, NAMES, "churned", "part", "id", LEARNERS, 3, 8)
    assert seen == [3]  # one task, three parts


def test_only_splits_reach_the_driver(rows, monkeypatch):
    sent, collect = [], RDD.collect

    def counted(self):
        found = collect(self)
        sent.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(RDD, "collect", counted)
    boosting.fit(rows, NAMES, "churned", "part", "id", LEARNERS, 3, 64)
    assert sent and max(sent) < 3000  # the histograms of two roots have 2 x 2 x 3 x 64 doubles


def test_many_tasks_grow_the_same_trees_without_python(spark, monkeypatch):
    """Deep trees, heavy and light positives, crowded cells, pieces of blocks and margins made anew: as one task grows them."""
    spread = spark.range(0, 9000, 1, 3).selectExpr(
        "id * 7919 AS id", "int(id % 3) AS part", "CASE WHEN id % 50 > 0 THEN xxhash64(id, 1) % 1000 / 1000D END AS x",
        "double(xxhash64(id, 2) % 3) AS y", "IF(id % 7 = 0, double('NaN'), xxhash64(id, 3) % 40 / 40D) AS z",
        "int(xxhash64(id, 4) % 1000 / 1000D + IF(id % 50 > 0, xxhash64(id, 1) % 1000 / 1000D, 0) > 0.2) AS churned",
    )
    learners = [
        boosting.Learner(boosting.BoostSettings(8, 0.3, 5, 0.7), (0, 1), 3000.0),
        boosting.Learner(boosting.BoostSettings(3, 0.1, 3, 1.0), (0, 1, 2), 0.6),
        boosting.Learner(boosting.BoostSettings(1, 0.2, 4, 0.7), (2,), 1.7),
    ]
    one = boosting.fit(spread, NAMES, "churned", "part", "id", learners, 3, 32)
    monkeypatch.setattr(boosting, "TASK_PAIRS", 9000)
    monkeypatch.setattr(boosting, "REPLAY", 4)
    monkeypatch.setattr(boosting, "_blocks", None)  # rows need not come to Python
    monkeypatch.setattr(boosting._Pass, "histograms", None)
    again = boosting.fit(spread, NAMES, "churned", "part", "id", learners, 3, 32)
    assert [len(m.nodes) > 10 for m in one] == [True] * 3 and max(n.node for n in one[0].nodes) > 254
    for a, b in zip(one, again):
        assert [n[:4] for n in table(a.nodes)] == [n[:4] for n in table(b.nodes)]
        assert np.allclose([n[4:] for n in table(a.nodes)], [n[4:] for n in table(b.nodes)], rtol=1e-9, atol=1e-9)


def test_floats_fall_to_their_leaves():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    x[::7, 1] = np.nan
    for depth in (0, 1, 3, 8):  # the deepest rows go one by one
        nodes = []
        for tree in range(3):
            ends = {0}
            for node in range(2**depth - 1):
                if node in ends and (node == 0 or rng.random() < 0.7):
                    ends = ends - {node} | {2 * node + 1, 2 * node + 2}
                    nodes.append(boosting.Node(tree, node, int(rng.integers(3)), float(rng.normal()), 0.0, 1.0))
            nodes += [boosting.Node(tree, node, -1, 0.0, float(rng.normal()), 1.0) for node in ends]
        model = boosting.BoostedTrees(tuple(NAMES), tuple(nodes), 0.3)
        feature, cut, value, _ = model.arrays()
        want = np.full(300, 0.3)
        for tree in range(3):
            want += value[tree, boosting.leaves(x, feature[tree], cut[tree])]
        assert model.margins(x).tolist() == want.tolist() and model.heaps()[2].shape == (3, 2**depth)


def test_rows_fall_to_their_nodes():
    rng = np.random.default_rng(1)
    grown = boosting.Grown([boosting.Learner(boosting.BoostSettings(8, 0.1, 1), (0,), 1.0)])
    grown.feature[:], grown.cut[:] = rng.integers(0, 4, grown.feature.shape), rng.integers(0, 9, grown.cut.shape)
    grown.cut[0, 2] = 255
    bins = rng.integers(0, 10, (4, 500)).astype(np.uint8)
    for levels in range(9):
        want = np.zeros(500, int)
        for i in range(500):
            for _ in range(levels):
                want[i] = 2 * want[i] + 1 + (bins[grown.feature[0, want[i]], i] > grown.cut[0, want[i]])
        assert (grown.place(0, bins, levels) + 2**levels - 1 == want).all()


def test_features_are_counted_together():
    widths = [64, 20, 64, 64, 3, 1, 5, 64]
    groups = boosting.together(widths)
    assert sorted(f for g in groups for f in g) == list(range(8)) and len(groups) < 8
    assert all(len(g) == 1 or np.prod([widths[f] for f in g]) <= boosting.JOINT_BINS for g in groups)
    assert boosting.together([9000, 2, 2]) == [[0], [1, 2]]


def test_a_prefix_is_a_shorter_fit(rows):
    long, short = boosting.Learner(boosting.BoostSettings(2, 0.2, 6), (0, 1, 2), 1.0), boosting.Learner(boosting.BoostSettings(2, 0.2, 2), (0, 1, 2), 1.0)
    a, b = boosting.fit(rows, NAMES, "churned", "part", "id", [long, short], 3, 8)
    assert a.first(2) == b and a.trees == 6
    x = np.array([[0.1, -1.0, 2.0], [np.nan, 0.0, 0.0]])
    assert np.allclose(a.margins_after(x, [2, 6, 9]), [b.margins(x), a.margins(x), a.margins(x)])


def test_boosted_trees_score_and_are_stored(spark, rows, data, tmp_path):
    model = boosting.fit(rows, NAMES, "churned", "part", "id", LEARNERS[:1], 3, 8)[0]
    model.save(str(tmp_path / "m"))
    again = boosting.load(spark, str(tmp_path / "m"))
    assert again == model
    got = {r["id"]: (r["margin"], r["probability"]) for r in model.transform(rows).collect()}
    want = model.margins(data[0])
    for i, m in enumerate(want):
        assert got[i * 7919] == pytest.approx((m, 1 / (1 + np.exp(-m))))


def test_rows_of_one_label_make_leaves(rows):
    same = rows.withColumn("churned", F.lit(1))
    model = boosting.fit(same, NAMES, "churned", "part", "id", LEARNERS[1:], 3, 8)[0]
    assert model.trees == 4 and model.margins(np.zeros((1, 3)))[0] > 0


# -- forest ------------------------------------------------------------------

def test_bags_weigh_their_own_rows():
    keys = np.arange(4000) * 31
    drawn = [forest.copies(keys, m, 9) for m in (0, 1)]
    assert abs(drawn[0].mean() - 1) < 0.06 and abs((drawn[0] == 0).mean() - np.exp(-1)) < 0.03
    assert abs(np.corrcoef(drawn)[0, 1]) < 0.06
    assert forest.bag_weights(np.array([[30, 10]])).tolist() == [[40 / 60, 40 / 20]]


def plain_forest(x, label, part, edges, parts, model, settings, seed, bins):
    b = binned(x, edges)
    number = forest.copies(np.arange(len(x)) * 7919, model, seed)
    bag = [i for i in range(len(x)) if part[i] in parts for _ in range(number[i])]
    n = [sum(label[i] == c for i in bag) for c in (0, 1)]
    weight = [len(bag) / (2 * max(c, 1)) for c in n]
    nodes = []

    def impurity(rows):
        a, c = (sum(weight[k] for i in rows if label[i] == k) for k in (0, 1))
        return 2 * a * c / (a + c) if a + c else 0.0

    def grow(node, depth, rows):
        best = (1e-9, None, None)
        if depth < settings.max_depth:
            for f in forest.tried(model, np.array([node]), x.shape[1], settings.tried, seed)[0]:
                for c in range(bins - 1):
                    left, right = [i for i in rows if b[i, f] <= c], [i for i in rows if b[i, f] > c]
                    if left and right and (gain := impurity(rows) - impurity(left) - impurity(right)) > best[0] + 1e-9:
                        best = (gain, int(f), c)
        _, f, c = best
        if f is None:
            a, e = (sum(weight[k] for i in rows if label[i] == k) for k in (0, 1))
            nodes.append((model, node, -1, 0.0, e / (a + e) if a + e else 0.0, len(rows)))
            return
        nodes.append((model, node, f, edges[f][c], 0.0, len(rows)))
        grow(2 * node + 1, depth + 1, [i for i in rows if b[i, f] <= c])
        grow(2 * node + 2, depth + 1, [i for i in rows if b[i, f] > c])

    grow(0, 0, bag)
    return sorted(nodes)


def test_forest_equals_a_plain_loop(rows, data, monkeypatch):
    settings = forest.ForestSettings(3, 3, 2)
    edges = boosting.cuts(rows, NAMES, 8)
    sets = [(0, 1), (0, 1, 2)]
    grown = forest.fit(rows, NAMES, "churned", "part", "id", sets, settings, 9, 8)
    monkeypatch.setattr(forest, "TASK_PAIRS", 50)
    monkeypatch.setattr(forest, "MOST_CELLS", 100)  # a few trees a pass
    again = forest.fit(rows.repartition(4, "y"), NAMES, "churned", "part", "id", sets, settings, 9, 8)
    assert grown == again
    for i, (found, parts) in enumerate(zip(grown, sets)):
        want = [n for t in range(3) for n in plain_forest(*data, edges, parts, i * 3 + t, settings, 9, 8)]
        got = table(found.nodes)
        assert [(n[0] + i * 3, *n[1:3]) for n in got] == [n[:3] for n in want]
        assert np.allclose([n[3:] for n in got], [n[3:] for n in want])
    scored = {r["id"]: r["probability"] for r in grown[0].transform(rows).collect()}
    assert scored[7919] == pytest.approx(grown[0].probability(data[0][1:2])[0]) and len(scored) == 160


# -- logistic ----------------------------------------------------------------

def test_logistic_gradient_is_zero_in_sql(spark, rows, tmp_path):
    sets = [(0, 1), (0, 2), (1, 2), (0, 1, 2)]
    weights = [(0.8, 1.3)] * 4
    filled = rows.fillna(0.1, ["x"]).withColumn("same", F.lit(3.0))
    names = [*NAMES, "same"]
    models = logistic.fit(filled, names, "churned", "part", sets, weights, rows_a_task=20)
    assert models[0].steps < 10 and all(m.coefficients[3] == 0 for m in models)
    data = filled.toPandas()  # noqa: F841
    for model, parts in zip(models, sets):
        margin = " + ".join([f"({f} - {m}) / {s} * {w}" for f, m, s, w in zip(NAMES, model.mean, model.spread, model.coefficients)])
        for i, f in enumerate(NAMES):
            m, s, w = model.mean[i], model.spread[i], model.coefficients[i]
            stats = duckdb.sql(f"SELECT avg({f}), stddev_pop({f}) FROM data WHERE part IN {tuple(parts)}").fetchall()[0]
            assert stats == pytest.approx((m, s))
            slope = duckdb.sql(
                f"SELECT sum(CASE churned WHEN 1 THEN 1.3 ELSE 0.8 END * (1 / (1 + exp(-({margin} + {model.intercept}))) - churned)"
                f" * ({f} - {m}) / {s}) FROM data WHERE part IN {tuple(parts)}"
            ).fetchall()[0][0]
            assert slope + w == pytest.approx(0, abs=1e-6)
    scored = models[3].transform(filled).agg(F.avg("probability")).first()[0]
    assert 0.2 < scored < 0.8


def test_logistic_of_missing_values_and_one_label(rows):
    model = logistic.fit(rows, NAMES, "churned", "part", [(0, 1, 2)], [(1.0, 1.0)])[0]
    assert model.transform(rows).filter("probability IS NULL").count() == 0
    one = logistic.fit(rows.withColumn("churned", F.lit(0)), NAMES, "churned", "part", [(0,)], [(1.0, 1.0)])[0]
    assert one.intercept < -5


def test_bins_are_read_as_bytes():
    work = forest._Pass([(0,)], forest.ForestSettings(2), 1, 3, 8, 0, [0], np.zeros((1, 1), int), np.zeros((1, 1), int))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5, 6, 7]), pa.array([0, 0, 0], pa.int32()), pa.array([1, 0, 1], pa.int32()), pa.array([b"abc", b"def", b"ghi"])],
        ["key", "part", "label", "bins"],
    )
    *_, bins = work.opened(batch.slice(1))
    assert bins.dtype == np.uint8 and bins.T.tobytes() == b"defghi"  # eight times less to gather
    assert work.opened(batch.slice(3))[3].shape == (3, 0)
    assert forest.copies(np.arange(9), 0, 1).tolist() == np.searchsorted(
        forest._AT_MOST, (forest._hash(np.arange(9), 0, 1) >> np.uint64(11)).astype(float) / 2.0**53, "right"
    ).tolist()
