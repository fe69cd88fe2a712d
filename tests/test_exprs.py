import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.functions import exprs, rules


def values(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_title_case_and_strip(spark):
    df = spark.createDataFrame(
        [(1, "  sao joao d'oeste\t"), (2, "SANTA-RITA "), (3, "são paulo"), (4, None), (5, "")], "i int, s string"
    )
    got = dict(values(df.select("i", exprs.city_name("s").alias("c")), "i", "c"))
    assert got[1] == "Sao Joao D'Oeste"
    assert got[2].strip() == "Santa-Rita"
    assert got[3] == "São Paulo"
    assert got[4] is None
    assert got[5] == ""


def test_rounding_keeps_decimal_ties(spark):
    df = spark.createDataFrame([(0.145,), (1.005,), (-0.145,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(exprs.rounded("x", 2)).collect()]
    assert got == [0.15, 1.01, -0.15, 2.5, None]


def test_decimals_are_rounded_once(spark):
    df = spark.sql("SELECT CAST('0.1449999999999' AS DECIMAL(20,13)) AS x, CAST('12345678901234567890.125' AS DECIMAL(38,3)) AS y, 3 AS z")
    got = df.select(exprs.rounded("x", 2), exprs.rounded("y", 2), exprs.rounded("z", 2)).first()
    assert tuple(got) == (0.14, 12345678901234567890.13, 3.0)


def test_at_least_keeps_null_and_ratio_handles_zero(spark):
    df = spark.createDataFrame([(None, 0.0), (1.0, 2.0)], "a double, b double")
    got = df.select(exprs.at_least("a", 5.0), exprs.ratio("b", F.lit(0))).collect()
    assert [tuple(r) for r in got] == [(None, None), (5.0, None)]


def test_linspace_matches_numpy():
    for args in ((0.10, 0.95, 50), (0.15, 0.85, 20)):
        assert exprs.linspace(*args) == np.linspace(*args).tolist()


def test_grid_position_is_exact_on_and_around_the_grid(spark):
    grid = exprs.linspace(0.10, 0.95, 50)
    scores = [0.0, 1.0, 0.5, 0.0999999, 0.9500001, -3.0, 7.0]
    for g in grid:
        scores += [g, math.nextafter(g, 0), math.nextafter(g, 1)]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = values(df.select("s", exprs.grid_position("s", grid).alias("n")), "s", "n")
    for s, n in got:
        assert n == sum(g <= s for g in grid), s


def test_status_rules_differ_on_null(spark):
    df = spark.createDataFrame([("canceled",), ("delivered",), (None,)], "s string")
    out = ("canceled", "unavailable")
    assert df.filter(exprs.counts_as_sale("s", out)).count() == 1
    assert df.filter(exprs.not_excluded("s", out)).count() == 2


def test_risk_tiers(spark):
    df = spark.createDataFrame([(0.20,), (0.55,), (0.85,), (0.70,), (0.40,)], "p double")
    assert [r[0] for r in df.select(rules.risk_tier("p")).collect()] == ["LOW", "MEDIUM", "HIGH", "HIGH", "MEDIUM"]


@pytest.mark.parametrize("text,expected", [("2018-01-02 03:04:05", True), ("2018-13-01", False), ("", False), (None, False)])
def test_bad_instants_become_null(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(exprs.parse_instant("t").alias("t"))
    assert (df.first()["t"] is not None) == expected
    assert df.schema["t"].dataType.simpleString() == "timestamp_ntz"


def test_time_arithmetic_does_not_depend_on_the_session_zone(spark):
    """The zone has clock changes in October 1995 and February 1996."""
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'1995-10-10 00:00:00' AS a, TIMESTAMP_NTZ'1995-10-20 06:07:08.000009' AS b"
        " UNION ALL SELECT TIMESTAMP_NTZ'1996-03-01 00:00:00', TIMESTAMP_NTZ'1996-01-31 23:59:59.5'"
        " UNION ALL SELECT NULL, TIMESTAMP_NTZ'1996-01-31 00:00:00'"
    )
    chosen = df.select(
        exprs.micros_between("a", "b").alias("m"), exprs.month_text("b").alias("t"), exprs.hour_number("b").alias("h")
    )
    expected = [
        (10 * 86_400_000_000 + 22_028_000_009, "1995-10", 226158),
        (-(29 * 86_400_000_000 + 500_000) - 0, "1996-01", 228647),
        (None, "1996-01", 228624),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert values(chosen, "m", "t", "h") == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
