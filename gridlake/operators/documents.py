"""Nested system documents: assembly, reading back with defaults, checks.

A document holds the component arrays of one case as JSON: one row per case, whatever
its size, as a case text is one row too. ``num_parts`` deals every case of a table into
the same number of rows, by the hash of a component's name, for cases beyond that format.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import schemas
from gridlake.functions.scalars import topology_id

# What a field that is absent from a document stands for.
DOCUMENT_PARTS = 1
DOCUMENT_DEFAULTS = {
    "angle": 0.0,
    "voltage_magnitude": 1.0,
    "voltage_min": 0.9,
    "voltage_max": 1.1,
    "area": "Area1",
    "zone": "Zone1",
    "angle_min": -math.pi / 2,
    "angle_max": math.pi / 2,
    "shunt_susceptance": 0.0,
}
LOAD_HEADROOM = 1.2

REQUIRED_BUS_FIELDS = ["number", "name", "base_voltage"]
REQUIRED_GENERATOR_FIELDS = ["name", "bus_number", "pmin", "pmax"]

SECTIONS = {
    "buses": schemas.BUS_ELEMENT,
    "generators": schemas.GENERATOR_ELEMENT,
    "branches": schemas.BRANCH_ELEMENT,
    "loads": schemas.LOAD_ELEMENT,
}
COUNTS = {
    "buses": "num_buses",
    "generators": "num_generators",
    "branches": "num_branches",
    "loads": "num_loads",
}


def element(df: DataFrame, schema: T.StructType):
    """Component row as an element; fields the table lacks are left out."""
    present = [f for f in schema.fields if f.name in df.columns]
    return F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in present])


def to_system_document(
    sections: dict[str, DataFrame],
    base_mva: DataFrame | None = None,
    source: str = "",
    num_parts: int = DOCUMENT_PARTS,
) -> DataFrame:
    """Topology rows with counts and a JSON document per case (and part).

    ``sections`` maps buses / generators / branches / loads to component tables
    with a ``case_name`` and a ``name``. All components go through one shuffle.
    """
    tagged = None
    for name, df in sections.items():
        row = df.select(
            "case_name",
            F.xxhash64(F.lit(name), F.col("name")).alias("_spread"),
            element(df, SECTIONS[name]).alias(name),
        )
        tagged = row if tagged is None else tagged.unionByName(row, allowMissingColumns=True)
    counts = [
        F.count(name).alias(COUNTS[name]) if name in sections else F.lit(0).cast("bigint").alias(COUNTS[name])
        for name in SECTIONS
    ]
    totals = tagged.groupBy("case_name").agg(*counts)
    arrays = [
        F.array_sort(F.collect_list(name)).alias(name) for name in sections
    ]
    parts = (
        tagged.withColumn("part_no", F.pmod("_spread", F.lit(num_parts)).cast("int"))
        .groupBy("case_name", "part_no")
        .agg(*arrays)
    )
    topology = parts.join(totals, "case_name")
    if base_mva is not None:
        topology = topology.join(base_mva.select("case_name", "base_mva"), "case_name", "left")
    else:
        topology = topology.withColumn("base_mva", F.lit(100.0))
    return topology.select(
        topology_id(F.col("case_name")).alias("topology_id"),
        "case_name",
        "part_no",
        F.lit(num_parts).alias("num_parts"),
        *COUNTS.values(),
        "base_mva",
        F.to_json(F.struct("base_mva", *sections)).alias("system_data"),
        F.lit(source).alias("source"),
    )


def explode_section(topology: DataFrame, section: str) -> DataFrame:
    """Elements of one document section as rows; only that section is parsed."""
    schema = T.StructType([T.StructField(section, T.ArrayType(SECTIONS[section]))])
    parsed = topology.select(
        "case_name", F.from_json("system_data", schema).alias("_doc")
    )
    # The outer form keeps Spark from parsing twice to filter empty arrays.
    elements = parsed.select("case_name", F.explode_outer(f"_doc.{section}").alias("_e"))
    return elements.filter(F.col("_e").isNotNull()).select("case_name", "_e.*")


def _default(name: str):
    return F.coalesce(F.col(name), F.lit(DOCUMENT_DEFAULTS[name])).alias(name)


def document_buses(topology: DataFrame) -> DataFrame:
    return explode_section(topology, "buses").select(
        "case_name",
        "number",
        "name",
        "base_voltage",
        *[_default(c) for c in ("angle", "voltage_magnitude", "voltage_min", "voltage_max")],
        *[_default(c) for c in ("area", "zone")],
    )


def document_branches(topology: DataFrame) -> DataFrame:
    """Branches with half of the shunt susceptance at each end."""
    half = F.coalesce(F.col("shunt_susceptance"), F.lit(0.0)) / 2
    return explode_section(topology, "branches").select(
        "case_name",
        "name",
        "from_bus_name",
        "to_bus_name",
        F.coalesce("available", F.lit(True)).alias("available"),
        "resistance",
        "reactance",
        half.alias("shunt_from"),
        half.alias("shunt_to"),
        F.coalesce("rating", "rating_a").alias("rating"),
        _default("angle_min"),
        _default("angle_max"),
    )


def document_generators(topology: DataFrame) -> DataFrame:
    rating = F.col("rating")
    return explode_section(topology, "generators").select(
        "case_name",
        "name",
        "bus_name",
        "type",
        F.coalesce("available", F.lit(True)).alias("available"),
        F.coalesce(F.col("status") != 0, F.lit(True)).alias("status"),
        "rating",
        "pmin",
        "pmax",
        F.coalesce("qmin", -rating).alias("qmin"),
        F.coalesce("qmax", rating).alias("qmax"),
        F.coalesce("ramp_up", "pmax").alias("ramp_up"),
        F.coalesce("ramp_down", "pmax").alias("ramp_down"),
        "cost_linear",
        F.coalesce("cost_fixed", "cost_constant", F.lit(0.0)).alias("cost_fixed"),
        F.coalesce("startup_cost", F.lit(0.0)).alias("startup_cost"),
        F.coalesce("shutdown_cost", F.lit(0.0)).alias("shutdown_cost"),
    )


def document_loads(topology: DataFrame) -> DataFrame:
    """Loads with maxima 20 % above the present values."""
    return explode_section(topology, "loads").select(
        "case_name",
        "name",
        "bus_name",
        F.coalesce("available", F.lit(True)).alias("available"),
        "active_power",
        "reactive_power",
        (F.col("active_power") * LOAD_HEADROOM).alias("max_active_power"),
        (F.col("reactive_power") * LOAD_HEADROOM).alias("max_reactive_power"),
    )


_SHALLOW = ", ".join(f"{section} array<variant>" for section in SECTIONS)


def shallow(topology: DataFrame) -> DataFrame:
    """Documents parsed once, elements left as variants."""
    return topology.withColumn("_doc", F.from_json("system_data", _SHALLOW))


def array_size(section: str):
    return F.coalesce(F.size(F.col(f"_doc.{section}")), F.lit(0)).cast("bigint")


def component_counts(topology: DataFrame) -> DataFrame:
    """Array sizes per case, summed over its parts."""
    return shallow(topology).groupBy("case_name").agg(
        *[F.sum(array_size(s)).alias(COUNTS[s]) for s in SECTIONS]
    )


def incomplete(section: str, fields: list[str]):
    """Whether some element lacks a required key; an explicit null is a key."""

    def lacks(element):
        return _any([F.variant_get(element, f"$.{f}", "variant").isNull() for f in fields])

    return F.coalesce(F.exists(F.col(f"_doc.{section}"), lacks), F.lit(False))


def _any(conditions):
    result = conditions[0]
    for c in conditions[1:]:
        result = result | c
    return result


def topology_checks(topology: DataFrame, contingencies: DataFrame | None = None) -> DataFrame:
    """Per case: declared against actual counts, required fields, contingencies."""
    checked = ["buses", "generators", "branches"]
    report = shallow(topology).groupBy("case_name", "topology_id").agg(
        *[F.sum(array_size(s)).alias(f"actual_{s}") for s in checked],
        *[F.max(COUNTS[s]).alias(f"declared_{s}") for s in checked],
        F.max(incomplete("buses", REQUIRED_BUS_FIELDS)).alias("bus_field_missing"),
        F.max(incomplete("generators", REQUIRED_GENERATOR_FIELDS)).alias(
            "generator_field_missing"
        ),
    )
    return with_verdict(report, checked, contingencies)


def with_verdict(report: DataFrame, checked: list[str], contingencies: DataFrame | None = None) -> DataFrame:
    """Whether declared and actual counts agree and no required field is missing."""
    counts_match = F.lit(True)
    for s in checked:
        counts_match = counts_match & (F.col(f"actual_{s}") == F.col(f"declared_{s}"))
    report = report.withColumn("counts_match", counts_match).withColumn(
        "success",
        F.col("counts_match") & ~F.col("bus_field_missing") & ~F.col("generator_field_missing"),
    )
    if contingencies is None:
        return report
    defined = contingencies.groupBy("topology_id").agg(
        F.count(F.lit(1)).alias("contingencies")
    )
    return report.join(defined, "topology_id", "left").na.fill(0, ["contingencies"])
