"""Case texts: drop rules, defaults, cost curves, staging."""

import pytest
from conftest import rows

from gridlake.operators import convert, documents
from gridlake.plans.load_case import contingencies_of, load_matpower_cases, matpower_components
from gridlake.sources import case_text

LONG = """function mpc = small
mpc.version = '2';
mpc.baseMVA = 50.5;
%% bus data
mpc.bus = [
\t1\t3\t0\t0\t0\t0\t1\t1.06\t0\t230\t7\t1.08\t0.92;
\t2 2 21.7 12.7 0 0 1 1.045 -4.98 230 7 1.08 0.92; % with a remark
% a whole comment

\t3 1 x 0 0 0 1 1 0;
\t4 1 0 3.5; 0 0 1 1 0
\t5 1 0 3.5 0 0 1 1 0;;
\t6 1 0 0 0 0 1d 1 0;
];
mpc.gen = [
1 40 0 50 -40 1.06 100 1 332.4 10;
2 0 0 50 -40 1.06 100 0 100 0;
9 0 0 50 -40 1.06 100 1 60 0;
2 0 0 50 -40 1.06 100 1 60 0;
2 0 0 50 -40 1.06 100 1 60 0;
];
mpc.gencost = [
2 5 6 3 0.04 20 1;
2 5 6 2 25 2;
2 5 6 4 1 2 3 4;
1 5 6 2 0 0 100 2000;
];
mpc.branch = [
1 2 0.02 0.06 0.05 130 120 110 0 0 1 -30 30;
2 5 0.02 0.06 0.05 130 120 110 0.95 0 1;
5 8 0.02 0.06 0.05 130 120 110 1 5 0;
];
mpc.bus_name = {
\t'North';
\t'South';
};
"""
SHORT = "function mpc = empty\nmpc.bus = [\n1 1 0 0 0 0 2 1 0\n];\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("cases")
    (path / "small.m").write_text(LONG)
    (path / "short.m").write_text(SHORT)
    return str(path)


@pytest.fixture(scope="module")
def cases(spark, folder):
    return case_text.read_case_text(spark, folder)


@pytest.fixture(scope="module")
def components(cases):
    return matpower_components(cases)


def test_names_and_base(cases):
    assert rows(case_text.base_mva(cases)) == [("short", 100.0), ("small", 50.5)]
    assert rows(case_text.bus_names(cases)) == [("small", 0, "North"), ("small", 1, "South")]


def test_exponent_in_base_is_cut(spark):
    df = spark.createDataFrame([("a", "mpc.baseMVA = 1e2;")], "case_name string, content string")
    assert rows(case_text.base_mva(df)) == [("a", 1.0)]


def test_bad_rows_vanish_and_do_not_count(cases):
    bus = case_text.matrix_rows(cases, "bus").filter("case_name = 'small'")
    assert [(r.row_no, r["values"][0], len(r["values"])) for r in bus.orderBy("row_no").collect()] == [
        (0, 1.0, 13), (1, 2.0, 13), (2, 5.0, 9),
    ]
    assert rows(case_text.rejected_lines(cases, "bus")) == [
        ("small", "3 1 x 0 0 0 1 1 0"),
        ("small", "4 1 0 3.5; 0 0 1 1 0"),
        ("small", "6 1 0 0 0 0 1d 1 0"),
    ]
    assert case_text.matrix_rows(cases, "nothing").count() == 0


def test_buses(components):
    got = rows(
        components["buses"], "case_name", "number", "name", "base_voltage", "zone", "voltage_max", "voltage_min"
    )
    assert got == [
        ("short", 1, "Bus1", 138.0, "1", 1.1, 0.9),
        ("small", 1, "North", 230.0, "7", 1.08, 0.92),
        ("small", 2, "South", 230.0, "7", 1.08, 0.92),
        ("small", 5, "Bus5", 138.0, "1", 1.1, 0.9),
    ]


def test_generators_and_costs(components):
    got = rows(
        components["generators"], "name", "bus_name", "status", "pmax", "ramp_up",
        "cost_quadratic", "cost_linear", "cost_constant", "startup_cost", "shutdown_cost",
    )
    assert got == [
        ("Gen1", "North", 1, 332.4, 166.2, 0.04, 20.0, 1.0, 5.0, 6.0),
        ("Gen2", "South", 0, 100.0, 50.0, 0.0, 25.0, 2.0, 5.0, 6.0),
        ("Gen3", "Bus9", 1, 60.0, 30.0, None, 30.0, 0.0, 5.0, 6.0),
        ("Gen4", "South", 1, 60.0, 30.0, None, 30.0, 0.0, 5.0, 6.0),
        ("Gen5", "South", 1, 60.0, 30.0, None, 30.0, 0.0, 0.0, 0.0),
    ]


def test_branches(components):
    assert rows(components["branches"], "name", "to_bus_name", "ratio", "angle_min", "type") == [
        ("Line1", "South", 1.0, -30.0, "line"),
        ("Line2", "Bus5", 0.95, -360.0, "transformer"),
        ("Line3", "Bus8", 1.0, -360.0, "transformer"),
    ]


def test_two_load_counts(components):
    loads = rows(components["loads"], "name", "active_power", "reactive_power")
    assert loads == [("Load_Bus5", 0.0, 3.5), ("Load_South", 21.7, 12.7)]
    stats = convert.case_statistics(
        components["buses"], components["generators"], components["branches"]
    ).filter("case_name = 'small'").head()
    assert (stats.num_buses, stats.num_loads, stats.num_load_elements) == (3, 1, 2)
    assert (stats.num_generators, stats.num_branches, stats.total_load_mw) == (5, 3, 21.7)


def test_case_without_units_has_statistics(components):
    stats = convert.case_statistics(
        components["buses"], components["generators"], components["branches"]
    ).filter("case_name = 'short'").head()
    assert (stats.num_generators, stats.num_branches, stats.total_capacity_mw) == (0, 0, 0.0)


def test_load_is_repeatable_and_counts_hold(spark, folder, tmp_path):
    warehouse = str(tmp_path / "lake")
    for _ in range(2):
        load_matpower_cases(spark, folder, warehouse, hours=168)
    power = spark.read.parquet(f"{warehouse}/power_measurements")
    assert power.count() == 4 * 168
    assert power.select("date").distinct().count() == 7
    assert spark.read.parquet(f"{warehouse}/generator_measurements").count() == 5 * 168
    assert spark.read.parquet(f"{warehouse}/load_measurements").count() == 2 * 168
    assert spark.read.parquet(f"{warehouse}/contingencies").count() == 3 + 5
    topology = spark.read.parquet(f"{warehouse}/network_topology")
    assert rows(topology, "case_name", "num_buses", "num_generators", "num_loads", "num_parts") == [
        ("short", 1, 0, 0, 1), ("small", 3, 5, 2, 1),
    ]
    assert rows(documents.document_loads(topology), "name", "bus_name") == [
        ("Load_Bus5", "Bus5"), ("Load_South", "South"),
    ]


def test_single_outages(components):
    got = rows(
        contingencies_of(components, 100.0).selectExpr(
            "contingency_name", "coalesce(affected_branches, affected_generators)[0] AS element",
            "probability", "severity_level",
        )
    )
    assert got == [
        ("N-1_Gen1", "Gen1", 0.005, 3),
        ("N-1_Line1", "Line1", 0.01, 2),
        ("N-1_Line2", "Line2", 0.01, 2),
        ("N-1_Line3", "Line3", 0.01, 2),
    ]


def test_broken_off_load_is_completed(spark, folder, tmp_path):
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    load_matpower_cases(spark, folder, whole, hours=24)
    # Of the broken run only the bus series of one case and no topology exist.
    (
        spark.read.parquet(f"{whole}/power_measurements")
        .filter("case_name = 'small'")
        .write.partitionBy("date")
        .parquet(f"{broken}/power_measurements")
    )
    load_matpower_cases(spark, folder, broken, hours=24)
    for table in ("power_measurements", "generator_measurements", "load_measurements", "contingencies"):
        assert spark.read.parquet(f"{broken}/{table}").count() == spark.read.parquet(f"{whole}/{table}").count()
