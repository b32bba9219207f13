"""Solution audits and grids on hand-made tables."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridlake.operators import solution as so


def table(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_objective_by_hand(spark):
    x = table(spark, [("corn", 1, 1, 2022, 10.0), ("corn", 1, 2, 2022, 5.0)],
              "feedstock string, source int, county int, year int, amount double")
    y = table(spark, [("t", 1, "b", 2022, 4.0)], "tech string, county int, basin string, year int, amount double")
    z = table(spark, [("b", 2022, 4.0)], "basin string, year int, amount double")
    terms = so.objective_terms(
        x, y, z,
        table(spark, [("corn", 1, 2022, 3.0)], "feedstock string, source int, year int, value double"),
        table(spark, [(1, 1, 7.0)], "source int, county int, value double"),
        table(spark, [], "county int, basin string, value double"),
        table(spark, [(2022, 2.0)], "year int, value double"),
        table(spark, [("b", 6.0)], "basin string, value double"),
    )
    got = {r.term: r.cost for r in terms.collect()}
    want = {
        "feedstock": 45.0,
        "feedstock_transport": 0.163 * (7 * 10 + 1000 * 5),
        "co2_transport": 1000 * 4 * 2.0,
        "injection": 24.0,
    }
    want["total"] = sum(want.values())
    assert got == pytest.approx(want)


@pytest.mark.parametrize("off,violated", [(1e-9, False), (1.0, True)])
def test_balance_tolerance(spark, off, violated):
    a = table(spark, [("k", 1.0), ("k", 2.0)], "key string, amount double")
    b = table(spark, [("k", 3.0 + off)], "key string, amount double")
    assert rows(so.balance(a, b, ["key"]), "violated") == [(violated,)]


def test_balance_keeps_keys_of_both_sides(spark):
    a = table(spark, [("l", 1.0)], "key string, amount double")
    b = table(spark, [("r", 2.0)], "key string, amount double")
    assert rows(so.balance(a, b, ["key"]), "key", "residual") == [("l", 1.0), ("r", -2.0)]


def test_capacity_defaults(spark):
    used = table(spark, [("a", 5.0), ("b", 1.0)], "key string, amount double")
    limit = table(spark, [("a", 5.0), ("c", 9.0)], "key string, capacity double")
    assert rows(so.capacity(used, limit, ["key"], 0.0), "key", "used", "capacity", "violated") == [
        ("a", 5.0, 5.0, False), ("b", 1.0, 0.0, True), ("c", 0.0, 9.0, False),
    ]
    assert rows(so.capacity(used, limit, ["key"]), "key", "violated") == [("a", False), ("b", False), ("c", False)]
    assert rows(so.capacity(used, 2.0, ["key"]), "key", "violated") == [("a", True), ("b", False)]


def test_densify(spark):
    axes = {
        "i": table(spark, [(i,) for i in range(7)], "i int"),
        "a": table(spark, [("x",), ("y",)], "a string"),
        "t": table(spark, [(2022,), (2040,), (2030,)], "t int"),
    }
    sparse = table(spark, [(3, "y", 2040, 2.5)], "i int, a string, t int, value double")
    dense = so.densify(axes, sparse, "value", 1000.0)
    got = rows(dense, "i", "a", "t", "value")
    assert len(got) == len(set(got)) == 42
    assert (3, "y", 2040, 2.5) in got
    assert sum(v for *_, v in got) == 41 * 1000 + 2.5


def test_densify_with_an_empty_axis(spark):
    axes = {"i": table(spark, [(1,)], "i int"), "a": table(spark, [], "a string")}
    sparse = table(spark, [], "i int, a string, value double")
    assert so.densify(axes, sparse, "value", 0.0).count() == 0


def test_region_subset_and_energy(spark):
    u = table(spark, [("t", 1, 2022, 4.0), ("t", 2, 2022, 6.0), ("t", 3, 2022, 1.0)],
              "tech string, county int, year int, amount double")
    mapping = table(spark, [(1, "q"), (2, "q")], "county int, region string")
    demand = table(spark, [("t", "q", 2022, 10.0)], "tech string, region string, year int, amount double")
    assert rows(so.energy_audit(u, demand, mapping), "left_total", "right_total", "violated") == [(10.0, 10.0, False)]


def test_plant_and_pipe_audits(spark):
    u = table(spark, [("t", 1, 2022, 4.0)], "tech string, county int, year int, amount double")
    y = table(spark, [("t", 1, "b", 2022, 8.0)], "tech string, county int, basin string, year int, amount double")
    z = table(spark, [("b", 2022, 7.0)], "basin string, year int, amount double")
    factor = table(spark, [("t", 2.0)], "tech string, value double")
    assert rows(so.transport_audit(y, u, factor), "violated") == [(False,)]
    assert rows(so.arrival_audit(y, z), "residual", "violated") == [(1.0, True)]
    assert rows(so.pipeline_audit(y), "capacity", "violated") == [(1_000_000.0, False)]


def test_dense_totals_equal_the_grid(spark):
    """All groupings, a full group, an empty one, cells outside the axes and stored nulls."""
    axes = {
        "a": spark.createDataFrame([(1,), (2,), (3,)], "a int"),
        "b": spark.createDataFrame([("x",), ("y",)], "b string"),
    }
    sparse = spark.createDataFrame(
        [(1, "x", 5.0), (1, "y", -2.0), (2, "y", None), (2, "x", 9.0), (7, "x", 50.0), (None, "x", 3.0)],
        "a int, b string, v double",
    )
    dense = so.densify(axes, sparse, "v", 1.5)
    for by in (None, "a", "b"):
        keys = [by] if by else []
        want = dense.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("cells"), F.sum("v").alias("total"), F.avg("v").alias("mean"),
            F.min("v").alias("low"), F.max("v").alias("high"),
        )
        got = so.dense_totals(axes, sparse, "v", 1.5, by=by)
        assert rows(got.drop("stored")) == rows(want)
    assert rows(so.dense_totals(axes, sparse, "v", 1.5), "stored") == [(3,)]


def test_dense_totals_of_empty_axes(spark):
    none = spark.createDataFrame([], "b string")
    axes = {"a": spark.createDataFrame([(1,)], "a int"), "b": none}
    sparse = spark.createDataFrame([(1, "x", 5.0)], "a int, b string, v double")
    assert rows(so.dense_totals(axes, sparse, "v", 1.0)) == [(0, 0, None, None, None, None)]
    assert rows(so.dense_totals(axes, sparse, "v", 1.0, by="a")) == [(1, 0, 0, None, None, None, None)]
    assert rows(so.dense_totals(axes, sparse, "v", 1.0, by="b")) == []
    stored_none = sparse.limit(0)
    full = {"a": axes["a"], "b": spark.createDataFrame([("x",), ("y",)], "b string")}
    assert rows(so.dense_totals(full, stored_none, "v", 1.0)) == [(2, 0, 2.0, 1.0, 1.0, 1.0)]
