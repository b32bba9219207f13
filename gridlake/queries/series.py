"""Hourly series on parts, suppliers and hourly profiles of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalars import unit_type
from gridlake.operators import convert
from gridlake.operators import series as s
from gridlake.queries.mapping import UNIT_TYPE_SQL, UNITS_SQL, units
from gridlake.queries.registry import Tables, query, rounded

START = "2024-01-01 00:00:00"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

HOURLY_SQL = """hourly AS (
    SELECT CAST(date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) AS INTEGER) AS hour_index,
           round(sum(value), 2) AS total FROM events GROUP BY 1)"""

AT_SQL = "TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * hour_index"


def _hour_index():
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(
        F.lit(START).cast("timestamp")
    )
    return F.floor(seconds / 3600).cast("int").alias("hour_index")


def hourly(t: Tables) -> DataFrame:
    """Hourly profile; at two digits the sum no longer depends on its order."""
    return t.events.groupBy(_hour_index()).agg(F.round(F.sum("value"), 2).alias("Hydro"))


def wide(t: Tables) -> DataFrame:
    """Wide profile: hour and one column per event type."""
    columns = [
        F.sum(F.when(F.col("event_type") == e, F.col("value"))).alias(e) for e in EVENT_TYPES
    ]
    return t.events.groupBy(_hour_index()).agg(*columns)


@query("wide_to_long", """
SELECT hour_index, unit, share FROM (
  SELECT CAST(date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) AS INTEGER) AS hour_index,
         u.unit, round(sum(CASE WHEN event_type = u.unit THEN value END), 4) AS share
  FROM events, (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) u(unit)
  GROUP BY 1, 2) w""")
def wide_to_long(t):
    return rounded(s.wide_to_long(wide(t), ["hour_index"], EVENT_TYPES, "unit", "share"), "share")


@query("profile_scale", """
WITH units AS (SELECT event_type AS name, max(value) AS pmax FROM events
               WHERE event_type <> 'signup' GROUP BY 1),
w AS (SELECT CAST(date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) AS INTEGER) AS hour_index,
        name, pmax, sum(CASE WHEN event_type = name THEN value END) AS share
      FROM events, units GROUP BY 1, 2, 3)
SELECT hour_index, name, round(share * pmax, 4) AS active_power_mw FROM w WHERE hour_index < 8760""")
def profile_scale(t):
    known = (
        t.events.filter(F.col("event_type") != "signup")
        .groupBy(F.col("event_type").alias("name"))
        .agg(F.max("value").alias("pmax"))
    )
    scaled = s.scale_profile(wide(t), known, spread=4)
    return rounded(scaled, "active_power_mw").select("hour_index", "name", "active_power_mw")


@query("constant_series", f"""
WITH {UNITS_SQL}
SELECT name, count(*) AS hours, min({AT_SQL.replace('hour_index', 'h')}) AS first_hour,
       max({AT_SQL.replace('hour_index', 'h')}) AS last_hour,
       round(min(pmin + 0.7 * (pmax - pmin)), 6) AS lowest_mw,
       round(max(pmin + 0.7 * (pmax - pmin)), 6) AS highest_mw
FROM units, range(8760) r(h) GROUP BY 1""")
def constant_series(t):
    """A year per unit, reported by unit."""
    rows = s.with_time(s.constant_series(units(t)), START)
    year = rows.groupBy("name").agg(
        F.count(F.lit(1)).alias("hours"),
        F.min("time").alias("first_hour"),
        F.max("time").alias("last_hour"),
        F.min("active_power_mw").alias("lowest_mw"),
        F.max("active_power_mw").alias("highest_mw"),
    )
    return rounded(year, "lowest_mw", "highest_mw", digits=6)


@query("hydro_share", f"""
WITH {UNITS_SQL}, {HOURLY_SQL}, n AS (SELECT case_name, count(*) AS n FROM units WHERE fuel = 'Hydro' GROUP BY 1)
SELECT name, hour_index, total * pmax / n.n AS active_power_mw
FROM units JOIN n USING (case_name), hourly WHERE fuel = 'Hydro' AND hour_index < 8760""")
def hydro_share(t):
    hydro = units(t).filter(F.col("fuel") == "Hydro")
    rows = s.shared_profile(hourly(t), hydro, "Hydro")
    return rows.select("name", "hour_index", "active_power_mw")


@query("area_bus", """
SELECT CAST(s_nationkey % 3 + 1 AS VARCHAR) AS area, min(s_suppkey) AS bus_number FROM supplier GROUP BY 1""")
def area_bus(t):
    return s.representative_bus(_bus_map(t))


def _bus_map(t: Tables) -> DataFrame:
    return t.supplier.select(
        (F.col("s_nationkey") % 3 + 1).cast("string").alias("Area"),
        F.col("s_suppkey").alias("Bus ID"),
    )


@query("area_load", f"""
WITH long AS (
  SELECT CAST(date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) AS INTEGER) AS hour_index,
         user_id % 3 + 1 AS area, sum(value) AS p FROM events GROUP BY 1, 2),
grid AS (SELECT DISTINCT hour_index, a FROM long, range(1, 4) r(a)),
rep AS (SELECT s_nationkey % 3 + 1 AS area, min(s_suppkey) AS bus FROM supplier GROUP BY 1)
SELECT {AT_SQL.replace('hour_index', 'g.hour_index')} AS time, 'Load_Area' || g.a AS load_id,
       CAST(bus AS VARCHAR) AS bus_id, round(p, 4) AS active_power_mw,
       round(p * 0.3, 4) AS reactive_power_mvar, coalesce(s_name, 'Bus' || bus) AS bus_name
FROM grid g LEFT JOIN long ON long.hour_index = g.hour_index AND long.area = g.a
JOIN rep ON rep.area = g.a JOIN supplier ON s_suppkey = bus""")
def area_load(t):
    areas = ["Area1", "Area2", "Area3"]
    regional = t.events.groupBy(_hour_index()).agg(
        *[
            F.sum(F.when(F.col("user_id") % 3 + 1 == i + 1, F.col("value"))).alias(a)
            for i, a in enumerate(areas)
        ]
    )
    buses = t.supplier.select(
        F.lit("RTS_GMLC").alias("case_name"),
        F.col("s_suppkey").alias("number"),
        F.col("s_name").alias("name"),
    )
    rows = s.area_load(regional, _bus_map(t), buses, areas)
    return rounded(rows, "active_power_mw", "reactive_power_mvar").select(
        "time", "load_id", "bus_id", "active_power_mw", "reactive_power_mvar", "bus_name"
    )


@query("area_loads", """
SELECT 'Load_' || r_name AS name, r_name AS area, count(*) AS buses, min(n_nationkey) AS first_bus,
       max(n_nationkey) AS last_bus
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def area_loads(t):
    bus_map = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("Area"), F.col("n_nationkey").alias("Bus ID")
    )
    loads = convert.rts_loads(bus_map, "NATIONS")
    return loads.groupBy("name", "area").agg(
        F.sum(F.size("buses")).alias("buses"),
        F.min(F.array_min("buses")).cast("int").alias("first_bus"),
        F.max(F.array_max("buses")).cast("int").alias("last_bus"),
    )


@query("generator_year", f"""
WITH {UNITS_SQL}, {HOURLY_SQL}, n AS (SELECT case_name, count(*) AS n FROM units WHERE fuel = 'Hydro' GROUP BY 1),
rows AS (
  SELECT unit_key, name, bus_number, fuel, CAST(h AS INTEGER) AS hour_index, pmin + 0.7 * (pmax - pmin) AS p
  FROM units, range(8760) r(h) WHERE fuel NOT IN ('Wind', 'Hydro')
  UNION ALL
  SELECT unit_key, name, bus_number, fuel, hour_index, total * pmax / n.n
  FROM units JOIN n USING (case_name), hourly WHERE fuel = 'Hydro' AND hour_index < 8760
  UNION ALL
  SELECT unit_key, name, bus_number, fuel, hour_index, total / 1000 * pmax
  FROM units, hourly WHERE fuel = 'Wind' AND unit_key % 2 = 0 AND hour_index < 8760)
SELECT name AS generator_id, CAST(bus_number AS VARCHAR) AS bus_id, {UNIT_TYPE_SQL} AS generator_type,
       count(*) AS hours, min({AT_SQL}) AS first_hour, max({AT_SQL}) AS last_hour,
       round(min(p), 4) AS lowest_mw, round(max(p), 4) AS highest_mw,
       round(sum(p) / 1000, 2) AS energy_gwh, round(sum(p * 0.3) / 1000, 2) AS reactive_gvarh
FROM rows GROUP BY 1, 2, 3""")
def generator_year(t):
    """A year of every unit, reported by unit. The wind profile has no column for units
    with an odd key, which so have no rows; solar has no file."""
    frame = units(t).withColumn("marginal_cost", F.lit(30.0))
    known = frame.filter((F.col("fuel") == "Wind") & (F.col("unit_key") % 2 == 0)).select("name")
    # The profile is made where the join with its units will look for it.
    year = hourly(t).filter(F.col("hour_index").between(0, s.HOURS_PER_YEAR - 1))
    hours = s.each_step(known, s.HOURS_PER_YEAR, by=["name"]).join(F.broadcast(year), "hour_index")
    wind = hours.select("hour_index", "name", (F.col("Hydro") / 1000).alias("share"))
    rows = s.generator_year(frame, wind=wind, solar=None, hydro=hourly(t), start=START)
    year = rows.groupBy("generator_id", "bus_id", "generator_type").agg(
        F.count(F.lit(1)).alias("hours"),
        F.min("time").alias("first_hour"),
        F.max("time").alias("last_hour"),
        F.min("active_power_mw").alias("lowest_mw"),
        F.max("active_power_mw").alias("highest_mw"),
        (F.sum("active_power_mw") / 1000).alias("energy_gwh"),
        (F.sum("reactive_power_mvar") / 1000).alias("reactive_gvarh"),
    )
    year = rounded(year, "lowest_mw", "highest_mw")
    return rounded(year, "energy_gwh", "reactive_gvarh", digits=2)


def _suppliers_as_units(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.lit("SUPPLIERS").alias("case_name"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("bus_number"),
        F.lit(10.0).alias("pmin"),
        (F.abs("s_acctbal") + 10).alias("pmax"),
        F.lit(30.0).alias("cost_linear"),
        F.lit("THERMAL").alias("type"),
    )


@query("load_factor_series", f"""
SELECT s_name AS generator_id, CAST(s_nationkey AS VARCHAR) AS bus_id, {AT_SQL.replace('hour_index', 'h')} AS time,
  round(10 + (0.6 + 0.3 * sin((h % 24 - 6) * pi() / 12)) * abs(s_acctbal), 6) AS active_power_mw,
  round((10 + (0.6 + 0.3 * sin((h % 24 - 6) * pi() / 12)) * abs(s_acctbal)) * 0.3, 6) AS reactive_power_mvar,
  30.0::DOUBLE AS marginal_cost
FROM supplier, range(168) r(h)""")
def load_factor_series(t):
    rows = s.simulate_generators(_suppliers_as_units(t), 168, START, noise=False)
    return rounded(rows, "active_power_mw", "reactive_power_mvar", digits=6).select(
        "generator_id", "bus_id", "time", "active_power_mw", "reactive_power_mvar", "marginal_cost"
    )


@query("bus_series", f"""
SELECT CAST(s_suppkey AS VARCHAR) AS bus_id, s_name AS bus_name, {AT_SQL.replace('hour_index', 'h')} AS time,
  1.01::DOUBLE AS voltage_magnitude, round(radians(s_nationkey), 8) AS voltage_angle_rad,
  60.0::DOUBLE AS frequency_hz, 100 AS measurement_quality
FROM supplier, range(168) r(h)""")
def bus_series(t):
    buses = t.supplier.select(
        F.lit("SUPPLIERS").alias("case_name"),
        F.col("s_suppkey").alias("number"),
        F.col("s_name").alias("name"),
        F.lit(1.01).alias("voltage_magnitude"),
        F.col("s_nationkey").cast("double").alias("angle"),
    )
    rows = s.simulate_buses(buses, 168, START, noise=False)
    return rounded(rows, "voltage_angle_rad", digits=8).drop("source", "case_name")


@query("load_series", f"""
SELECT s_name AS load_id, {AT_SQL.replace('hour_index', 'h')} AS time,
  round(abs(s_acctbal) * (0.6 + 0.3 * sin((h % 24 - 6) * pi() / 12)), 6) AS active_power_mw,
  round(s_nationkey * (0.6 + 0.3 * sin((h % 24 - 6) * pi() / 12)), 6) AS reactive_power_mvar
FROM supplier, range(168) r(h)""")
def load_series(t):
    loads = t.supplier.select(
        F.lit("SUPPLIERS").alias("case_name"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("bus_number"),
        F.abs("s_acctbal").alias("active_power"),
        F.col("s_nationkey").cast("double").alias("reactive_power"),
    )
    rows = s.simulate_loads(loads, 168, START, noise=False)
    return rounded(rows, "active_power_mw", "reactive_power_mvar", digits=6).select(
        "load_id", "time", "active_power_mw", "reactive_power_mvar"
    )


def _digest_sql(stream: str, start: int) -> str:
    key = f"'{stream}|SUPPLIERS|' || s_name || '|' || CAST(h AS VARCHAR)"
    return f"(CAST('0x' || substr(md5({key}), {start}, 13) AS BIGINT)::DOUBLE / pow(16, 13))"


@query("synthetic_noise", f"""
SELECT s_name AS generator_id, {AT_SQL.replace('hour_index', 'h')} AS time,
  round(10 + (0.6 + 0.3 * sin((h % 24 - 6) * pi() / 12)) * abs(s_acctbal)
    + 0.02 * (abs(s_acctbal) + 10) * sqrt(-2 * ln(1 - {_digest_sql('generation', 1)}))
      * cos(2 * pi() * {_digest_sql('generation', 14)}), 4) AS active_power_mw
FROM supplier, range(168) r(h)""")
def synthetic_noise(t):
    """Noise comes from a hash of the keys, so SQL can state it as well."""
    rows = s.simulate_generators(
        _suppliers_as_units(t), 168, START, noise=True, scada=True, source="SYNTHETIC"
    )
    return rounded(rows, "active_power_mw").select("generator_id", "time", "active_power_mw")


@query("noise_statistics", """
SELECT bus_name, TRUE AS voltage_plausible, TRUE AS frequency_plausible, 168::BIGINT AS rows
FROM (SELECT s_name AS bus_name FROM supplier) x""")
def noise_statistics(t):
    """Noisy bus series stay within six sigma of their nominal values."""
    buses = t.supplier.select(
        F.lit("SUPPLIERS").alias("case_name"),
        F.col("s_suppkey").alias("number"),
        F.col("s_name").alias("name"),
        F.lit(1.0).alias("voltage_magnitude"),
        F.lit(0.0).alias("angle"),
    )
    rows = s.simulate_buses(buses, 168, START, scada=True, source="SYNTHETIC")
    return rows.groupBy("bus_name").agg(
        (F.max(F.abs(F.col("voltage_magnitude") - 1)) < 0.06).alias("voltage_plausible"),
        (
            (F.max(F.abs(F.col("frequency_hz") - 60)) < 0.12)
            & (F.min("measurement_quality") >= 95)
            & (F.max("measurement_quality") <= 100)
        ).alias("frequency_plausible"),
        F.count(F.lit(1)).alias("rows"),
    )


@query("fuel_type", f"""
WITH {UNITS_SQL} SELECT name, fuel, {UNIT_TYPE_SQL} AS type FROM units""")
def fuel_type(t):
    return units(t).select("name", "fuel", unit_type(F.col("fuel")).alias("type"))


@query("thermal_units", f"""
WITH {UNITS_SQL} SELECT name, fuel FROM units
WHERE {UNIT_TYPE_SQL} = 'THERMAL'""")
def thermal_units(t):
    typed = units(t).withColumn("type", unit_type(F.col("fuel")))
    return convert.thermal_units(typed).select("name", "fuel")


@query("skipped_units", f"""
WITH {UNITS_SQL}, typed AS (SELECT {UNIT_TYPE_SQL} AS type FROM units)
SELECT type, count(*) AS units FROM typed WHERE type <> 'THERMAL' GROUP BY 1""")
def skipped_units(t):
    return convert.skipped_units(units(t).withColumn("type", unit_type(F.col("fuel"))))


@query("large_units", f"""
WITH {UNITS_SQL} SELECT name, pmax FROM units WHERE pmax > 950""")
def large_units(t):
    return units(t).filter(F.col("pmax") > 950).select("name", "pmax")
