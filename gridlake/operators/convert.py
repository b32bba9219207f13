"""Case formats to canonical components (buses, generators, branches, loads).

``matpower_*`` functions take positional matrix rows ``(case_name, row_no,
values)``; ``rts_*`` functions take tables with named columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalars import unit_type
from gridlake.operators.joins import lookup_bus

# What a missing trailing matrix column or a missing table column
# stands for.
BASE_KV_DEFAULT = 138.0
ZONE_DEFAULT = 1
VOLTAGE_MAX_DEFAULT = 1.1
VOLTAGE_MIN_DEFAULT = 0.9
RTS_VOLTAGE_MIN_DEFAULT = 0.95
RTS_VOLTAGE_MAX_DEFAULT = 1.05
ANGLE_LIMIT_DEFAULT = 360.0
LINEAR_COST_DEFAULT = 30.0
HEAT_RATE_DEFAULT = 10.0
RAMP_SHARE = 0.5
MINUTES_PER_HOUR = 60

POLYNOMIAL = 2


def _at(i: int) -> Column:
    """Entry ``i`` of the matrix row, NULL where the row is shorter."""
    return F.get(F.col("values"), F.lit(i))


def _number(name: str, i: int, kind: str = "double", default: object = None) -> Column:
    value = _at(i)
    if default is not None:
        value = F.when(F.size("values") > i, value).otherwise(F.lit(float(default)))
    return value.cast(kind).alias(name)


def matpower_buses(rows: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Buses of matrix rows; names are matched by position."""
    buses = rows.select(
        "case_name",
        "row_no",
        _number("number", 0, "bigint"),
        _number("type", 1, "int"),
        _number("Pd", 2),
        _number("Qd", 3),
        _number("Gs", 4),
        _number("Bs", 5),
        _at(6).cast("int").cast("string").alias("area"),
        _number("voltage_magnitude", 7),
        _number("angle", 8),
        _number("base_voltage", 9, default=BASE_KV_DEFAULT),
        _number("zone", 10, "int", ZONE_DEFAULT).cast("string").alias("zone"),
        _number("voltage_max", 11, default=VOLTAGE_MAX_DEFAULT),
        _number("voltage_min", 12, default=VOLTAGE_MIN_DEFAULT),
    )
    fallback = F.concat(F.lit("Bus"), F.col("number").cast("string"))
    if names is None:
        return buses.withColumn("name", fallback)
    return (
        buses.join(names.withColumnRenamed("bus_name", "name"), ["case_name", "row_no"], "left")
        .withColumn("name", F.coalesce("name", fallback))
    )


def cost_curve(generators: DataFrame, costs: DataFrame) -> DataFrame:
    """Adds the cost columns from cost rows ``(case_name, row_no, values)``.

    A quadratic (3 coefficients) or linear (2) polynomial gives its
    coefficients; every other curve and a missing row give the default price.
    ``cost_quadratic`` is NULL where no polynomial was used.
    """
    count = _at(3).cast("int")
    polynomial = _at(0).cast("int") == POLYNOMIAL
    quadratic = polynomial & (count == 3)
    linear = polynomial & (count == 2)
    curves = costs.select(
        "case_name",
        "row_no",
        F.when(quadratic, _at(4)).when(linear, F.lit(0.0)).alias("cost_quadratic"),
        F.when(quadratic, _at(5)).when(linear, _at(4)).alias("_linear"),
        F.when(quadratic, _at(6)).when(linear, _at(5)).alias("_constant"),
        _at(1).alias("_startup"),
        _at(2).alias("_shutdown"),
    )
    return (
        generators.join(curves, ["case_name", "row_no"], "left")
        .withColumn("cost_linear", F.coalesce("_linear", F.lit(LINEAR_COST_DEFAULT)))
        .withColumn("cost_constant", F.coalesce("_constant", F.lit(0.0)))
        .withColumn("startup_cost", F.coalesce("_startup", F.lit(0.0)))
        .withColumn("shutdown_cost", F.coalesce("_shutdown", F.lit(0.0)))
        .drop("_linear", "_constant", "_startup", "_shutdown")
    )


def matpower_generators(
    rows: DataFrame, costs: DataFrame | None = None, buses: DataFrame | None = None
) -> DataFrame:
    """Generators of matrix rows, named by position; all count as thermal."""
    generators = rows.select(
        "case_name",
        "row_no",
        F.concat(F.lit("Gen"), (F.col("row_no") + 1).cast("string")).alias("name"),
        _number("bus_number", 0, "bigint"),
        F.lit("THERMAL").alias("type"),
        _number("Pg", 1),
        _number("Qg", 2),
        _number("qmax", 3),
        _number("qmin", 4),
        _number("Vg", 5),
        _number("mbase", 6),
        _number("status", 7, "int"),
        _number("pmax", 8),
        _number("pmin", 9),
        _number("rating", 8),
        (_at(8) * RAMP_SHARE).alias("ramp_up"),
        (_at(8) * RAMP_SHARE).alias("ramp_down"),
    )
    if costs is not None:
        generators = cost_curve(generators, costs)
    if buses is not None:
        generators = lookup_bus(generators, buses, "bus_number", "bus_name", order=["row_no"])
    return generators


def branch_class(ratio: Column, angle: Column | None = None) -> Column:
    """``transformer`` where the ratio is off 1 or (if given) the angle off 0."""
    off = ratio != 1.0
    if angle is not None:
        off = off | (angle != 0.0)
    return F.when(off, "transformer").otherwise("line")


def _unit_ratio(ratio: Column) -> Column:
    """A ratio of 0 stands for a plain line, that is 1."""
    return F.when(ratio == 0, F.lit(1.0)).otherwise(ratio)


def matpower_branches(rows: DataFrame, buses: DataFrame | None = None) -> DataFrame:
    """Branches of matrix rows, named by position."""
    branches = rows.select(
        "case_name",
        "row_no",
        F.concat(F.lit("Line"), (F.col("row_no") + 1).cast("string")).alias("name"),
        _number("from_bus", 0, "bigint"),
        _number("to_bus", 1, "bigint"),
        _number("resistance", 2),
        _number("reactance", 3),
        _number("shunt_susceptance", 4),
        _number("rating_a", 5),
        _number("rating_b", 6),
        _number("rating_c", 7),
        _unit_ratio(_at(8)).alias("ratio"),
        _number("angle", 9),
        _number("status", 10, "int"),
        _number("angle_min", 11, default=-ANGLE_LIMIT_DEFAULT),
        _number("angle_max", 12, default=ANGLE_LIMIT_DEFAULT),
    ).withColumn("type", branch_class(F.col("ratio"), F.col("angle")))
    return branches if buses is None else name_branch_ends(branches, buses, ["row_no"])


def name_branch_ends(
    branches: DataFrame, buses: DataFrame, order: Sequence[str] | None = None
) -> DataFrame:
    """Bus names of both ends."""
    for end in ("from_bus", "to_bus"):
        branches = lookup_bus(branches, buses, end, f"{end}_name", order=order)
    return branches


def matpower_loads(buses: DataFrame) -> DataFrame:
    """One load per bus with active or reactive demand."""
    return buses.filter((F.col("Pd") > 0) | (F.col("Qd") > 0)).select(
        "case_name",
        F.concat(F.lit("Load_"), "name").alias("name"),
        F.col("number").alias("bus_number"),
        F.col("name").alias("bus_name"),
        F.col("Pd").alias("active_power"),
        F.col("Qd").alias("reactive_power"),
    )


def _column_or(df: DataFrame, name: str, default: Column) -> Column:
    """The column, or the default where the table has no such column."""
    return F.col(f"`{name}`") if name in df.columns else default


def rts_buses(table: DataFrame, case_name: str) -> DataFrame:
    return table.select(
        F.lit(case_name).alias("case_name"),
        F.col("Bus ID").cast("bigint").alias("number"),
        F.col("Bus Name").cast("string").alias("name"),
        F.lit(1).alias("type"),
        F.col("BaseKV").cast("double").alias("base_voltage"),
        F.lit(1.0).alias("voltage_magnitude"),
        F.lit(0.0).alias("angle"),
        F.col("Area").cast("string").alias("area"),
        F.col("Zone").cast("string").alias("zone"),
        _column_or(table, "Vmin", F.lit(RTS_VOLTAGE_MIN_DEFAULT)).alias("voltage_min"),
        _column_or(table, "Vmax", F.lit(RTS_VOLTAGE_MAX_DEFAULT)).alias("voltage_max"),
    )


def rts_generators(
    table: DataFrame,
    case_name: str,
    buses: DataFrame | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Units with their type from the fuel and a cost from fuel price and heat rate.

    ``order`` names columns of ``buses`` that say which of several buses with one
    number comes first (the place in the file)."""
    pmax = F.col("`PMax MW`").cast("double")
    # The column is per minute, the default share of the range already per hour.
    ramp = (
        F.col("`Ramp Rate MW/Min`") * MINUTES_PER_HOUR
        if "Ramp Rate MW/Min" in table.columns
        else pmax * RAMP_SHARE
    )
    price = _column_or(table, "Fuel Price $/MMBTU", F.lit(0.0))
    heat_rate = _column_or(table, "HR_avg_0", F.lit(HEAT_RATE_DEFAULT))
    generators = table.select(
        F.lit(case_name).alias("case_name"),
        F.col("GEN UID").cast("string").alias("name"),
        F.col("Bus ID").cast("bigint").alias("bus_number"),
        unit_type(F.col("Fuel")).alias("type"),
        F.col("`PMin MW`").cast("double").alias("pmin"),
        pmax.alias("pmax"),
        _column_or(table, "QMin MVAR", -pmax).alias("qmin"),
        _column_or(table, "QMax MVAR", pmax).alias("qmax"),
        pmax.alias("rating"),
        ramp.alias("ramp_up"),
        ramp.alias("ramp_down"),
        _column_or(table, "Min Up Time Hr", F.lit(0.0)).alias("min_up_time"),
        _column_or(table, "Min Down Time Hr", F.lit(0.0)).alias("min_down_time"),
        _column_or(table, "Start Cost Cold $", F.lit(0.0)).alias("startup_cost"),
        (price * heat_rate).alias("cost_linear"),
        _column_or(table, "Fuel Price $/MMBTU", F.lit(LINEAR_COST_DEFAULT)).alias("marginal_cost"),
        _column_or(table, "Non Fuel O&M $/MWh", F.lit(0.0)).alias("cost_constant"),
        F.col("Fuel").alias("fuel"),
        _column_or(table, "Unit Group", F.lit("")).alias("unit_group"),
    )
    if buses is None:
        return generators
    return lookup_bus(generators, buses, "bus_number", "bus_name", order=order)


def rts_branches(
    table: DataFrame,
    case_name: str,
    buses: DataFrame | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    ratio = _column_or(table, "Tr Ratio", F.lit(1.0))
    branches = table.select(
        F.lit(case_name).alias("case_name"),
        F.col("UID").cast("string").alias("name"),
        F.col("From Bus").cast("bigint").alias("from_bus"),
        F.col("To Bus").cast("bigint").alias("to_bus"),
        F.col("R").cast("double").alias("resistance"),
        F.col("X").cast("double").alias("reactance"),
        _column_or(table, "B", F.lit(0.0)).alias("shunt_susceptance"),
        _column_or(table, "Cont Rating", F.lit(0.0)).alias("rating"),
        _column_or(table, "STE Rating", F.lit(0.0)).alias("rating_emergency"),
        _unit_ratio(ratio).alias("ratio"),
        _column_or(table, "Tr Angle", F.lit(0.0)).alias("angle"),
    ).withColumn("type", branch_class(F.col("ratio")))
    return branches if buses is None else name_branch_ends(branches, buses, order)


def rts_loads(bus_map: DataFrame, case_name: str) -> DataFrame:
    """One load per area with its sorted bus list; a case file bounds the list's length."""
    members = bus_map.select(
        F.col("Area").cast("string").alias("area"), F.col("Bus ID").cast("bigint").alias("bus")
    )
    return (
        members.groupBy("area")
        .agg(F.array_sort(F.collect_list("bus")).alias("buses"))
        .select(
            F.lit(case_name).alias("case_name"),
            F.concat(F.lit("Load_"), "area").alias("name"),
            "area",
            "buses",
        )
    )


def thermal_units(generators: DataFrame, type_column: str = "type") -> DataFrame:
    """The units that enter the system model."""
    return generators.filter(F.col(type_column) == "THERMAL")


def skipped_units(generators: DataFrame, type_column: str = "type") -> DataFrame:
    """Number of units per type that do not enter the system model."""
    return (
        generators.filter(~F.col(type_column).eqNullSafe("THERMAL"))
        .groupBy(type_column)
        .agg(F.count(F.lit(1)).alias("units"))
    )


def case_statistics(
    buses: DataFrame,
    generators: DataFrame,
    branches: DataFrame,
    keys: Sequence[str] = ("case_name",),
) -> DataFrame:
    """Component counts, capacity and demand per case.

    ``num_loads`` counts buses with active demand only; ``num_load_elements``
    also those with reactive demand only, as :func:`matpower_loads` does.
    """
    counted = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    by_bus = buses.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_buses"),
        F.count_if(F.col("Pd") > 0).alias("num_loads"),
        F.count_if((F.col("Pd") > 0) | (F.col("Qd") > 0)).alias("num_load_elements"),
        F.sum("Pd").alias("total_load_mw"),
    )
    by_unit = generators.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_generators"),
        F.sum("pmax").alias("total_capacity_mw"),
    )
    on = list(keys)
    return (
        by_bus.join(by_unit, on, "left")
        .join(counted(branches, "num_branches"), on, "left")
        .na.fill(0, ["num_generators", "num_branches"])
        .na.fill(0.0, ["total_capacity_mw"])
    )
