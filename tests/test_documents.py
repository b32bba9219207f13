"""Documents: parts, defaults, key missing against null."""

import json

import pytest
from conftest import rows

from gridlake.operators import documents as d


def topology(spark, *docs):
    data = [
        (i, f"case{i}", len(x.get("buses", [])), len(x.get("generators", [])), len(x.get("branches", [])), json.dumps(x))
        for i, x in enumerate(docs)
    ]
    return spark.createDataFrame(
        data,
        "topology_id bigint, case_name string, num_buses bigint, num_generators bigint, num_branches bigint,"
        " system_data string",
    ).selectExpr("*", "0L AS num_loads")


BUS = {"number": 1, "name": "A", "base_voltage": 138.0}
UNIT = {"name": "G", "bus_number": 1, "pmin": 0.0, "pmax": 5.0}


def test_missing_key_fails_and_null_does_not(spark):
    no_key = {k: v for k, v in UNIT.items() if k != "pmax"}
    table = topology(
        spark,
        {"buses": [BUS], "generators": [UNIT], "branches": []},
        {"buses": [BUS], "generators": [UNIT, no_key], "branches": []},
        {"buses": [{**BUS, "base_voltage": None}], "generators": [], "branches": []},
        {"buses": [{"number": 1}], "generators": [], "branches": []},
    )
    got = rows(d.topology_checks(table), "case_name", "bus_field_missing", "generator_field_missing", "success")
    assert got == [
        ("case0", False, False, True),
        ("case1", False, True, False),
        ("case2", False, False, True),
        ("case3", True, False, False),
    ]


def test_count_mismatch(spark):
    table = topology(spark, {"buses": [BUS], "generators": [], "branches": []}).selectExpr(
        "* EXCEPT (num_buses)", "2L AS num_buses"
    )
    assert rows(d.topology_checks(table), "counts_match", "success") == [(False, False)]


def test_contingency_count_is_zero_without_any(spark):
    table = topology(spark, {"buses": [BUS], "generators": [], "branches": []})
    none = spark.createDataFrame([], "topology_id bigint")
    assert d.topology_checks(table, none).head().contingencies == 0


def test_defaults_of_absent_fields(spark):
    table = topology(
        spark,
        {
            "buses": [BUS],
            "generators": [{**UNIT, "bus_name": "A", "type": "THERMAL", "rating": 9.0, "cost_linear": 2.0}],
            "branches": [{"name": "L", "from_bus_name": "A", "to_bus_name": "A", "resistance": 0.1,
                          "reactance": 0.2, "shunt_susceptance": 0.5, "rating_a": 77.0}],
            "loads": [{"name": "D", "bus_name": "A", "active_power": 10.0, "reactive_power": 5.0}],
        },
    )
    bus = d.document_buses(table).head()
    assert (bus.angle, bus.voltage_magnitude, bus.voltage_min, bus.voltage_max) == (0.0, 1.0, 0.9, 1.1)
    assert (bus.area, bus.zone) == ("Area1", "Zone1")
    unit = d.document_generators(table).head()
    assert (unit.qmin, unit.qmax, unit.ramp_up, unit.cost_fixed) == (-9.0, 9.0, 5.0, 0.0)
    assert unit.available and unit.status
    branch = d.document_branches(table).head()
    assert (branch.shunt_from, branch.shunt_to, branch.rating) == (0.25, 0.25, 77.0)
    assert branch.angle_max == pytest.approx(1.5707963)
    load = d.document_loads(table).head()
    assert (load.max_active_power, load.max_reactive_power) == (12.0, 6.0)


def test_large_case_is_split_and_whole(spark):
    buses = spark.range(5000).selectExpr(
        "'big' AS case_name", "id AS number", "concat('b', id) AS name", "138.0D AS base_voltage"
    ).unionByName(spark.sql("SELECT 'tiny' AS case_name, 1L AS number, 'b' AS name, 10.0D AS base_voltage"))
    table = d.to_system_document({"buses": buses}, num_parts=5)
    parts = {r.case_name: r["count"] for r in table.groupBy("case_name").count().collect()}
    assert parts == {"big": 5, "tiny": 1}
    assert table.selectExpr("max(json_array_length(get_json_object(system_data, '$.buses')))").head()[0] < 1300
    back = d.document_buses(table).filter("case_name = 'big'")
    assert back.select("number").distinct().count() == back.count() == 5000
    assert d.topology_checks(table).filter("success").count() == 2
