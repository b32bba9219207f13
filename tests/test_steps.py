"""Steps of rows: all of them, from many tasks."""

import pytest
from pyspark.sql import functions as F

from gridlake.operators import series


@pytest.mark.parametrize(("steps", "first"), [(1, 0), (24, 1), (168, 0), (169, 0), (700, 5), (0, 0), (-3, 0)])
def test_every_row_has_every_step(spark, steps, first):
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "name string, `odd name` int")
    got = series.each_step(rows, steps, "step", first)
    assert got.columns == ["name", "odd name", "step"]
    wanted = [(n, k, s) for n, k in (("a", 1), ("a", 1), (None, 2)) for s in range(first, first + max(steps, 0))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)


def test_one_partition_is_spread(spark):
    units = spark.range(1).withColumn("name", F.lit("u")).coalesce(1)
    tasks = series.each_step(units, series.HOURS_PER_YEAR).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) >= 3 and max(r["count"] for r in tasks) < series.HOURS_PER_YEAR


def test_empty_table(spark):
    assert series.each_step(spark.range(0), 30).count() == 0


def test_stems_of_files_and_folders(spark, tmp_path):
    from gridlake.sources import tables

    (tmp_path / "Wind.csv").write_text("hour,a\n1,2\n2,3\n")
    spark.range(5).repartition(2).write.option("header", True).csv(str(tmp_path / "Load.v2.csv"))
    (tmp_path / "note.txt").write_text("x\n")
    assert {tuple(r) for r in tables.profile_stems(spark, str(tmp_path)).collect()} == {("Wind", 2), ("Load.v2", 5)}


def _below_exchanges(plan: str) -> list[str]:
    """Lines of a plan that lie below a shuffle which is itself above no broadcast."""
    found, depth = [], None
    for line in plan.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and at <= depth:
            depth = None
        if depth is not None:
            found.append(line)
        elif line.lstrip(" :+-").startswith("Exchange"):
            depth = at
    return found


def test_series_are_not_shuffled_for_their_profiles(spark):
    """Units are dealt out, then made into hours; no join or union sends the hours on."""
    units = spark.createDataFrame(
        [("c", "h1", 1, 1.0, 8.0, "Hydro", 3.0), ("c", "h2", 1, 1.0, 4.0, "Hydro", 3.0), ("c", "w", 2, 0.0, 10.0, "Wind", 3.0),
         ("c", "x", 2, 0.0, 10.0, "Wind", 3.0), ("d", "s", 3, 10.0, 20.0, "Coal", 3.0), ("d", "n", 3, None, 20.0, None, 3.0)],
        "case_name string, name string, bus_number int, pmin double, pmax double, fuel string, marginal_cost double",
    )
    hydro = spark.createDataFrame([(-1, 9.0), (0, 3.0), (5, None), (199, 0.5), (400, 2.0)], "hour_index int, Hydro double")
    known = units.filter("name = 'w'").select("name")
    dealt = series.each_step(known, 200, by=["name"])
    shares = spark.createDataFrame([(0, 0.25), (199, 0.5)], "hour_index int, share double")
    wind = dealt.join(F.broadcast(shares), "hour_index").select("hour_index", "name", "share")
    year = series.generator_year(units, wind=wind, hydro=hydro, hours=200)
    got = {}
    for r in year.collect():
        got.setdefault((r.generator_id, r.bus_id, r.generator_type), {})[str(r.time)] = r.active_power_mw
        assert r.reactive_power_mvar == r.active_power_mw * 0.3 and r.marginal_cost == 3.0
    first, sixth, last = "2024-01-01 00:00:00", "2024-01-01 05:00:00", "2024-01-09 07:00:00"
    assert got.pop(("h1", "1", "HYDRO")) == {first: 12.0, sixth: 0.0, last: 2.0}
    assert got.pop(("h2", "1", "HYDRO")) == {first: 6.0, sixth: 0.0, last: 1.0}
    assert got.pop(("w", "2", "WIND")) == {first: 2.5, last: 5.0}
    for key, level in ((("s", "3", "THERMAL"), 17.0), (("n", "3", "THERMAL"), 0.0)):
        steady = got.pop(key)
        assert len(steady) == 200 and set(steady.values()) == {level} and {first, sixth, last} <= set(steady)
    assert not got
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = series.generator_year(units, wind=wind, hydro=hydro, hours=200)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    below = _below_exchanges(plan)
    assert below and not [line for line in below if "explode(_steps" in line or "explode(sequence(" in line]
