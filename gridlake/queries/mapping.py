"""Driver tables under grid column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.queries.registry import Tables


def power(t: Tables) -> DataFrame:
    """Events as power measurements; event_id is the arrival number."""
    return t.events.select(
        F.col("ts").alias("time"),
        F.col("user_id").alias("bus_id"),
        F.col("event_type").alias("case_name"),
        F.col("value").alias("voltage_magnitude"),
        (F.col("value") * 2).alias("active_power_mw"),
        (F.col("value") * 0.5).alias("reactive_power_mvar"),
        "event_id",
    )


POWER_SQL = """power AS (
    SELECT ts AS time, user_id AS bus_id, event_type AS case_name,
           value AS voltage_magnitude, value * 2 AS active_power_mw,
           value * 0.5 AS reactive_power_mvar, event_id
    FROM events)"""


def executions(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("execution_id"),
        F.col("o_orderdate").alias("execution_time"),
        F.col("o_custkey").alias("topology_id"),
        F.col("o_orderstatus").alias("convergence_status"),
        F.col("o_totalprice").alias("objective_value"),
    )


def topology(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("topology_id"), F.col("c_name").alias("case_name")
    )


def dispatch(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("execution_id"),
        F.col("l_linenumber").alias("time_step"),
        F.col("l_shipdate").alias("target_datetime"),
        F.col("l_suppkey").alias("generator_id"),
        F.col("l_partkey").alias("bus_id"),
        F.col("l_returnflag").alias("scenario_type"),
        F.col("l_quantity").alias("active_power_mw"),
        F.col("l_extendedprice").alias("generation_cost"),
    )


def bus_results(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("execution_id"),
        F.col("l_linenumber").alias("time_step"),
        F.col("l_shipdate").alias("target_datetime"),
        F.col("l_partkey").alias("bus_id"),
        F.col("l_returnflag").alias("scenario_type"),
        F.col("l_extendedprice").alias("lmp_total"),
    )


def units(t: Tables) -> DataFrame:
    """Parts as generators of one case per part type; the brand picks the fuel."""
    fuels = F.array(*[F.lit(f) for f in FUELS])
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    return t.part.select(
        F.col("p_type").alias("case_name"),
        F.col("p_partkey").alias("unit_key"),
        F.concat(F.lit("U"), F.col("p_partkey").cast("string")).alias("name"),
        F.col("p_partkey").alias("bus_number"),
        F.col("p_size").cast("double").alias("pmin"),
        F.col("p_retailprice").alias("pmax"),
        F.element_at(fuels, (brand % len(FUELS) + 1).cast("int")).alias("fuel"),
    )


# Fuels given to parts; "Biomass" is on purpose not a known fuel.
FUELS = [
    "Coal", "NG", "Nuclear", "Oil", "Hydro", "Wind", "Solar", "Sync_Cond", "Storage", "Biomass",
]

_FUEL_LIST = ", ".join(f"'{f}'" for f in FUELS)

UNITS_SQL = f"""units AS (
    SELECT p_type AS case_name, p_partkey AS unit_key,
           'U' || CAST(p_partkey AS VARCHAR) AS name, p_partkey AS bus_number,
           CAST(p_size AS DOUBLE) AS pmin, p_retailprice AS pmax,
           list_extract([{_FUEL_LIST}],
                CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) % {len(FUELS)} + 1) AS fuel
    FROM part)"""

UNIT_TYPE_SQL = """CASE fuel WHEN 'Nuclear' THEN 'NUCLEAR' WHEN 'Hydro' THEN 'HYDRO'
        WHEN 'Wind' THEN 'WIND' WHEN 'Solar' THEN 'SOLAR'
        WHEN 'Sync_Cond' THEN 'SYNC_COND' WHEN 'Storage' THEN 'STORAGE'
        ELSE 'THERMAL' END"""
