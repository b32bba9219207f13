"""RTS folders: absent columns, file order, profiles, a whole load."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import convert, series
from gridlake.plans.load_case import load_rts_case, rts_components
from gridlake.sources.tables import profile_stems, read_csv_table, read_custom_loads, read_profiles, rows_with_marker

FILES = {
    "bus.csv": "Bus ID,Bus Name,BaseKV,Area,Zone\n101,Abel,138,1,11\n102,Adams,138,1,11\n201,Baker,230,2,21\n",
    "gen.csv": (
        "GEN UID,Bus ID,Fuel,PMin MW,PMax MW,Fuel Price $/MMBTU,HR_avg_0,Ramp Rate MW/Min\n"
        "101_CT,101,NG,10,110,4,10,3\n102_W,102,Wind,0,150,0,0,150\n102_X,102,Wind,0,80,0,0,80\n"
        "201_PV,201,Solar,0,20,0,0,20\n201_H1,201,Hydro,0,40,0,0,40\n101_H2,999,Hydro,0,60,0,0,60\n"
        "101_SC,101,Sync_Cond,0,0,0,0,0\n101_B,101,Biomass,0,30,2,9,1\n"
    ),
    "branch.csv": (
        "UID,From Bus,To Bus,R,X,B,Cont Rating,STE Rating,Tr Ratio,Tr Angle\n"
        "A1,101,102,0.01,0.1,0.02,175,200,0,0\nA2,102,201,0.01,0.1,0,400,600,1.015,0\nA3,102,777,0.01,0.1,0,400,600,1,5\n"
    ),
    "bus_map.csv": "Area,Bus ID\n1,102\n1,101\n2,201\n",
    "timeseries_data_files/Load/regional_Load.csv": "Area1,Area2,Area3\n100,50,1\n110,,1\n120,70,1\n",
    "timeseries_data_files/WIND/wind_total_2007.csv": "102_W,other\n0.5,1\n,1\n0.25,1\n",
    "timeseries_data_files/Hydro/Hydro_1.csv": "Hydro\n0.5\n1\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("rts")
    for name, text in FILES.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(root)


@pytest.fixture(scope="module")
def components(spark, folder):
    return rts_components(spark, folder)


def test_default_only_for_absent_columns(spark, folder, components):
    assert rows(components["buses"], "name", "type", "voltage_min", "voltage_max") == [
        ("Abel", 1, 0.95, 1.05), ("Adams", 1, 0.95, 1.05), ("Baker", 1, 0.95, 1.05),
    ]
    table = read_csv_table(spark, f"{folder}/bus.csv", schemas.BUS_CSV).withColumn(
        "Vmin", F.lit(None).cast("double")
    )
    assert {r.voltage_min for r in convert.rts_buses(table, "x").collect()} == {None}


def test_generators(components):
    got = rows(
        components["generators"].filter("name IN ('101_CT', '101_H2', '101_SC', '101_B')"),
        "name", "bus_name", "type", "qmin", "qmax", "ramp_up", "cost_linear", "marginal_cost", "startup_cost",
    )
    assert got == [
        ("101_B", "Abel", "THERMAL", -30.0, 30.0, 60.0, 18.0, 2.0, 0.0),
        ("101_CT", "Abel", "THERMAL", -110.0, 110.0, 180.0, 40.0, 4.0, 0.0),
        ("101_H2", "Bus999", "HYDRO", -60.0, 60.0, 3600.0, 0.0, 0.0, 0.0),
        ("101_SC", "Abel", "SYNC_COND", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_branches_and_loads(components):
    assert rows(components["branches"], "name", "to_bus_name", "ratio", "type") == [
        ("A1", "Adams", 1.0, "line"), ("A2", "Baker", 1.015, "transformer"), ("A3", "Bus777", 1.0, "line"),
    ]
    assert rows(components["loads"], "name", "buses") == [("Load_1", [101, 102]), ("Load_2", [201])]


def test_missing_folder_and_file(spark, folder, tmp_path):
    assert read_profiles(spark, f"{folder}/timeseries_data_files/PV", "pv_2007") is None
    assert profile_stems(spark, f"{folder}/none").count() == 0
    assert rows(profile_stems(spark, f"{folder}/timeseries_data_files/Load")) == [("regional_Load", 3)]


def test_profile_keeps_file_order(spark, folder):
    profile = read_profiles(spark, f"{folder}/timeseries_data_files/Load", "regional_Load")
    assert rows(profile, "hour_index", "Area1") == [(0, 100.0), (1, 110.0), (2, 120.0)]


def test_whole_load(spark, folder, tmp_path):
    lake = str(tmp_path / "lake")
    for _ in range(2):
        load_rts_case(spark, folder, lake)
    loads = spark.read.parquet(f"{lake}/load_measurements")
    # The first bus of area 1 in file order is 102; area 3 has no bus.
    assert rows(loads.filter("time = '2024-01-01 01:00:00'"), "load_id", "bus_id", "active_power_mw") == [
        ("Load_Area1", "102", 110.0), ("Load_Area2", "201", None),
    ]
    assert loads.count() == 6
    units = spark.read.parquet(f"{lake}/generator_measurements")
    counts = {r.generator_id: r["count"] for r in units.groupBy("generator_id").count().collect()}
    # Own column: 3 hours. No column: none. No solar file: constant. Hydro: 2 hours.
    assert counts == {
        "101_CT": 8760, "102_W": 3, "201_PV": 8760, "201_H1": 2, "101_H2": 2, "101_SC": 8760, "101_B": 8760,
    }
    level = {
        (r.generator_id, r.time.hour): r.active_power_mw
        for r in units.filter("time < '2024-01-01 03:00:00'").collect()
    }
    assert level["102_W", 0] == 75.0 and level["102_W", 1] == 0.0 and level["102_W", 2] == 37.5
    assert level["201_H1", 1] == 20.0 and level["101_H2", 0] == 15.0
    assert level["101_CT", 0] == pytest.approx(80.0)
    names = rows(spark.read.parquet(f"{lake}/contingencies"), "contingency_name")
    assert names == [("N-1_101_CT",), ("N-1_102_W",), ("N-1_A1",), ("N-1_A2",), ("N-1_A3",)]


def test_large_unit_limit_is_exclusive(spark):
    from gridlake.operators.scenarios import n1_contingencies

    units = spark.createDataFrame([(1, "a", 100.0), (1, "b", 100.1)], "topology_id int, name string, pmax double")
    branches = units.filter("false")
    assert rows(n1_contingencies(branches, units, 100.0), "contingency_name") == [("N-1_b",)]


def test_custom_loads_and_marker(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "reactive_power_mvar,timestamp,bus_id,active_power_mw\n1.5,2024-01-01 05:00:00,7,20\n"
    )
    got = read_custom_loads(spark, str(tmp_path / "c.csv"), "mine").head()
    assert (got.load_id, got.bus_id, got.active_power_mw, got.reactive_power_mvar) == ("Load_7", "7", 20.0, 1.5)
    assert (got.source, got.case_name, got.time.hour) == ("CUSTOM", "mine", 5)
    df = spark.createDataFrame([("2024 DE x",), ("2024 FR",)], "t string")
    assert rows_with_marker(df, "t").count() == 1


def test_noise_is_repeatable_and_centred(spark):
    units = spark.range(50).selectExpr(
        "'c' AS case_name", "concat('g', id) AS name", "id AS bus_number", "0.0 AS pmin", "100.0 AS pmax",
        "30.0 AS cost_linear", "'THERMAL' AS type",
    ).withColumns({"pmin": F.lit(0.0), "pmax": F.lit(100.0), "cost_linear": F.lit(30.0)})
    once = series.simulate_generators(units, 100)
    again = series.simulate_generators(units.repartition(7), 100)
    key = ["generator_id", "time", "active_power_mw"]
    assert once.select(key).exceptAll(again.select(key)).count() == 0
    quiet = series.simulate_generators(units, 100, noise=False).withColumnRenamed("active_power_mw", "p0")
    noise = once.join(quiet.select("generator_id", "time", "p0"), ["generator_id", "time"]).selectExpr(
        "avg(active_power_mw - p0) AS m", "stddev(active_power_mw - p0) AS s"
    ).head()
    assert abs(noise.m) < 0.15 and abs(noise.s - 2.0) < 0.1


def test_default_ramp_and_outage_text(spark):
    from gridlake.operators import convert, scenarios

    table = spark.sql(
        "SELECT 'G1' AS `GEN UID`, 1L AS `Bus ID`, 'Coal' AS Fuel, 10.0D AS `PMin MW`, 200.0D AS `PMax MW`"
    )
    buses = spark.sql(
        "SELECT 'C' AS case_name, 1L AS number, 'Zeta' AS name, 0 AS row_no"
        " UNION ALL SELECT 'C', 1L, 'Alpha', 1"
    )
    unit = convert.rts_generators(table, "C", buses, ["row_no"]).head()
    # Half the capacity, already per hour; the bus that comes first in the file.
    assert (unit.ramp_up, unit.bus_name) == (100.0, "Zeta")
    units = spark.sql("SELECT 1L AS topology_id, 'G1' AS name, 200.0D AS pmax")
    branches = spark.sql("SELECT 1L AS topology_id, 'L1' AS name")
    found = scenarios.n1_contingencies(branches, units, 100.0, with_capacity=True)
    texts = sorted(r.description for r in found.collect())
    assert texts == ["Single branch outage: L1", "Single generator outage: G1 (200.0 MW)"]
