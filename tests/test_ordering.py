import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from keepwell.operators import ordering, selection
from keepwell.operators.sampling import seeded_sample, stratified_folds, stratified_split


def test_row_numbers_over_a_value_a_third_of_rows_share(spark):
    n = 3000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("v")).repartition(8)
    got = ordering.number_rows(df, [F.col("v"), F.col("id")]).toPandas().sort_values(["v", "id"])
    assert got["row_no"].tolist() == list(range(1, n + 1))
    assert set(got["row_count"]) == {n}


def test_row_numbers_per_group(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 101).alias("v"))
    got = ordering.number_rows(df, [F.col("v").desc(), F.col("id")], by=["g"]).toPandas()
    for _, part in got.groupby("g"):
        ordered = part.sort_values(["v", "id"], ascending=[False, True])
        assert ordered["row_no"].tolist() == list(range(1, len(part) + 1))
        assert set(part["row_count"]) == {len(part)}


def test_blocks_are_really_split(spark):
    previous = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select("id", F.lit(1).alias("v"))
        stored = ordering._blocks(df, [], [F.col("v"), F.col("id")])
        sizes = [r["count"] for r in stored.groupBy("_block").count().collect()]
        assert len(sizes) > 4 and max(sizes) < 2500
        numbered = ordering.number_rows(df, [F.col("v"), F.col("id")]).toPandas().sort_values("id")
        assert numbered["row_no"].tolist() == list(range(1, 5001))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", previous)


def test_running_totals(spark):
    df = spark.range(500).select("id", (F.col("id") % 2).alias("g"), (F.col("id") % 5).alias("x"))
    got = ordering.running_totals(df, [F.col("id").desc()], ["x"], by=["g"]).toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("id", ascending=False)
        assert part["x_upto"].tolist() == part["x"].cumsum().tolist()
        assert set(part["x_total"]) == {part["x"].sum()}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 11, 23, 100, 399])
def test_quintiles_match_pandas_and_ntile(spark, n):
    data = pd.DataFrame({"id": range(n), "v": [(i * 7) % 4 for i in range(n)]})
    df = spark.createDataFrame(data)
    ranked = data["v"].rank(method="first")
    if n > 1:
        expected = pd.qcut(ranked, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist() if n >= 5 else None
        got = ordering.quantile_bins(df, {"b": F.col("v")}, "id", 5, ordering.quantile_ends)
        got = got.toPandas().sort_values("id")["b"].tolist()
        if expected:
            assert got == expected
    df.createOrReplaceTempView("small")
    sql = spark.sql("SELECT id, ntile(5) OVER (ORDER BY v, id) AS b FROM small").toPandas().sort_values("id")
    ours = ordering.quantile_bins(df, {"b": F.col("v")}, "id", 5).toPandas().sort_values("id")
    assert ours["b"].tolist() == sql["b"].tolist()


def test_several_measures_at_once_with_string_ids(spark):
    data = pd.DataFrame({"id": [f"c{i:03d}" for i in range(50)], "a": [i % 3 for i in range(50)], "b": [-i * 1.5 for i in range(50)]})
    got = ordering.quantile_bins(spark.createDataFrame(data), {"qa": F.col("a"), "qb": F.col("b")}, "id", 4)
    got = got.toPandas().sort_values("id").reset_index(drop=True)
    for source, column in (("a", "qa"), ("b", "qb")):
        rank = data[source].rank(method="first").astype(int)
        size, extra = divmod(50, 4)
        ends = [size * k + min(k, extra) for k in range(1, 4)]
        assert got[column].tolist() == [1 + sum(r > e for e in ends) for r in rank]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    data = pd.DataFrame({"g": ["a"] * 7 + ["b"] * 10 + ["c"], "v": [*rng.normal(size=7), *rng.integers(0, 3, 10).astype(float), 4.0]})
    df = spark.createDataFrame(data).unionByName(spark.createDataFrame([("a", None)], "g string, v double"))
    got = selection.exact_quantiles(df, ["g"], "v", {"q1": 0.25, "m": 0.5, "q9": 0.9}).toPandas().set_index("g")
    for g, part in data.groupby("g"):
        for name, p in (("q1", 0.25), ("m", 0.5), ("q9", 0.9)):
            assert got.loc[g, name] == pytest.approx(np.quantile(part["v"], p))


def test_sample_is_repeatable_and_exact_in_size(spark):
    df = spark.range(1000)
    a = {r[0] for r in seeded_sample(df, "id", 100, 42).collect()}
    b = {r[0] for r in seeded_sample(df.repartition(13), "id", 100, 42).collect()}
    assert a == b and len(a) == 100
    assert {r[0] for r in seeded_sample(df, "id", 100, 43).collect()} != a
    assert seeded_sample(df, "id", 5000, 42).count() == 1000


def test_split_and_folds_are_stratified(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    parts = stratified_split(df, "y", "id", {"train": 0.7, "val": 0.15, "test": 0.15}, 42)
    got = {(r["split_role"], r["y"]): r["count"] for r in parts.groupBy("split_role", "y").count().collect()}
    assert got == {
        ("train", 1): 70, ("val", 1): 15, ("test", 1): 15,
        ("train", 0): 630, ("val", 0): 135, ("test", 0): 135,
    }
    folds = stratified_folds(df, "y", "id", 5, 42).groupBy("fold", "y").count().collect()
    assert {(r["fold"], r["y"]): r["count"] for r in folds} == {(f, y): 20 if y else 180 for f in range(5) for y in (0, 1)}


def test_a_value_that_most_rows_share_is_counted(spark):
    n = 40000
    df = spark.range(n).select(F.lit("g").alias("g"), F.when(F.col("id") % 20 != 0, 0.0).otherwise(F.col("id") * 1.0).alias("v"))
    row = selection.exact_quantiles(df, ["g"], "v", {"m": 0.5, "q": 0.97, "top": 1.0}).first()
    values = np.array([0.0 if i % 20 else float(i) for i in range(n)])
    assert [row["m"], row["q"], row["top"]] == pytest.approx([np.quantile(values, p) for p in (0.5, 0.97, 1.0)])


def test_numbers_keep_the_order_of_doubles():
    values = np.array([-np.inf, -1e308, -2.5, -1e-308, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, 7e22, np.inf, np.nan])
    numbers = selection.ordered(values)
    assert (np.diff(numbers.astype(object)) >= 0).all() and numbers[5] == numbers[6] and len(set(numbers.tolist())) == 12
    back = [selection.value_of(int(x)) for x in numbers]
    assert np.array_equal(back, values, equal_nan=True)


def test_quantiles_of_hard_values(spark):
    """Negative numbers, values that differ in their last bits, infinities, several groups and null keys."""
    rng = np.random.default_rng(9)
    values = np.concatenate([rng.normal(size=200) * 10.0 ** rng.integers(-300, 300, 200), 1.0 + np.arange(50) * 2.0**-52, [-0.0, 0.0, 7.0]])
    rows = [(None if i % 3 == 0 else i % 3, i % 2, float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g int, h int, v double").repartition(4)
    got = {(r.g, r.h): (r.a, r.b) for r in selection.exact_quantiles(df, ["g", "h"], "v", {"a": 0.37, "b": 1.0}).collect()}
    for key in {r[:2] for r in rows}:
        mine = np.sort([v for *k, v in rows if tuple(k) == key])
        place = 0.37 * (len(mine) - 1)
        low = int(place)
        assert got[key] == (mine[low] + (mine[low + 1] - mine[low]) * (place - low), mine[-1])
    assert selection.exact_quantiles(df.limit(0), ["g"], "v", {"a": 0.5}).collect() == []


def test_counts_travel_and_not_values(spark):
    df = spark.range(50_000).select(F.lit(0).alias("grp"), (F.col("id") / 7).alias("v"))
    first = selection._counted(df, 1, None, 0).count()
    assert first < 400  # of 50,000 values


def test_moments_and_quantiles_of_several_columns(spark):
    data = pd.DataFrame({"a": [1.0, 2.0, None, 4.0], "b": [0, 0, 0, 7], "c": [None] * 4})
    df = spark.createDataFrame(data.astype("float64"))
    df = df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in df.columns])
    got = {r["measure"]: r for r in selection.moments_and_quantiles(df, ["a", "b", "c"], {"m": 0.5}).collect()}
    assert (got["a"]["n"], got["a"]["low"], got["a"]["high"], got["a"]["m"]) == (3, 1.0, 4.0, 2.0)
    assert (got["b"]["zeros"], got["b"]["m"]) == (3, 0.0) and got["b"]["std"] == pytest.approx(3.5)
    assert got["c"]["n"] == 0 and got["c"]["m"] is None


def test_no_join_is_chosen_by_a_row_count(spark):
    import keepwell.session

    assert not hasattr(keepwell.session, "small_side")
