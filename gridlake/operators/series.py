"""Hourly series: time axes, profiles, area loads, simulated measurements.

A series is made by exploding each component into blocks of hours, dealing the
blocks out to all tasks, and exploding them there: a component table is small and
often one partition, its series is neither. No component-to-component product is formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.noise import gaussian, uniform_integer
from gridlake.functions.scalars import (
    hours_after,
    in_range,
    load_factor,
    reactive_power,
    unit_type,
    zero_if_missing,
)
from gridlake.operators.joins import lookup_bus, spread_join
from gridlake.operators.ordered import first_per_group

# First hour of loaded years, their length, the share of the range
# a unit without a profile runs at, and the nominal frequency.
SERIES_START = "2024-01-01 00:00:00"
HOURS_PER_YEAR = 8760
THERMAL_LOADING = 0.7
NOMINAL_HZ = 60.0
# Steps of the smallest block, and blocks that a row is cut into where these are larger;
# no block is longer than a year.
BLOCK_STEPS = 168
BLOCKS = 8


def each_step(
    df: DataFrame, steps: int, output: str = "hour_index", first: int = 0, by: Sequence[str] = ()
) -> DataFrame:
    """Each row once per step ``first``, ``first + 1``, ...; ``steps`` in all, none below 1.

    The rows of one block of steps are dealt to a task by the hash of their columns and
    the block, so a table of one partition, or of one row, is spread as well. A row has few
    blocks, so what is grouped by it later meets few partial sums. With ``by``, rows are dealt
    by these columns alone, and a join on them finds all steps in their place.
    """
    if steps < 1:
        return df.withColumn(output, F.lit(first)).limit(0)
    size, last = _block_size(steps), F.lit(steps - 1)
    start = F.col("_block") * size
    inside = F.sequence(start, F.least(start + F.lit(size - 1), last))
    step = F.explode(F.transform(inside, lambda i: i + F.lit(first)) if first else inside)
    return _dealt(df, steps, by).withColumn(output, step).drop("_block")


def _block_size(steps: int) -> int:
    return min(max(BLOCK_STEPS, -(-steps // BLOCKS)), HOURS_PER_YEAR)


def _dealt(df: DataFrame, steps: int, by: Sequence[str] = ()) -> DataFrame:
    """Each row once per ``_block`` of its steps, dealt out to all tasks."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    block = F.explode(F.sequence(F.lit(0), F.lit((steps - 1) // _block_size(steps))))
    if by:
        return df.repartition(tasks, *[F.col(f"`{c}`") for c in by]).withColumn("_block", block)
    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.withColumn("_block", block).repartition(tasks, F.xxhash64(*columns, "_block"))


def _with_profile(units: DataFrame, profile: DataFrame, hours: int, start: str) -> DataFrame:
    """Every unit and block with its hours of a profile (hour_index, share) that all units
    follow: ``_steps``, an array of (time, share). A block without hours has no row.

    What is broadcast is a row per block, an entry per hour of the axis.
    """
    inside = profile.filter((F.col("hour_index") >= 0) & (F.col("hour_index") < hours))
    block = F.floor(F.col("hour_index") / _block_size(hours)).cast("int").alias("_block")
    packed = with_time(inside, start).groupBy(block).agg(F.collect_list(F.struct("time", "share")).alias("_steps"))
    return _dealt(units, hours).join(F.broadcast(packed), "_block").drop("_block")


def with_hours(df: DataFrame, hours: int, start: str = SERIES_START) -> DataFrame:
    """Each row once per hour, with ``hour_index`` and ``time``."""
    return with_time(each_step(df, hours), start)


def with_time(df: DataFrame, start: str = SERIES_START) -> DataFrame:
    """Time of a 0-based ``hour_index``."""
    return df.withColumn("time", hours_after(F.col("hour_index"), start))


def wide_to_long(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per id and value column."""
    return df.unpivot(list(ids), list(columns), name, value)


def scale_profile(
    profile: DataFrame, units: DataFrame, hours: int = HOURS_PER_YEAR, spread: int = 1
) -> DataFrame:
    """Wide profile times unit capacity; a unit without a column gives no rows.

    ``profile`` has ``hour_index`` and one column per unit name, or is already long
    with ``hour_index``, ``name`` and ``share``; ``units`` has ``name`` and ``pmax``.
    A long profile is not sorted for the join, nor moved where it lies by name.
    """
    long = profile.filter(F.col("hour_index") < hours)
    if set(profile.columns) == {"hour_index", "name", "share"}:
        units = units.hint("shuffle_hash")
    if set(profile.columns) != {"hour_index", "name", "share"}:
        names = [c for c in profile.columns if c != "hour_index"]
        long = wide_to_long(long, ["hour_index"], names, "name", "share")
    return spread_join(long, units, ["name"], "inner", spread).withColumn(
        "active_power_mw", F.col("share") * F.col("pmax")
    ).drop("share")


def constant_series(units: DataFrame, hours: int = HOURS_PER_YEAR) -> DataFrame:
    """Every hour at 70 % of the unit's range."""
    return each_step(units.withColumn("active_power_mw", _steady_level()), hours)


def _steady_level() -> Column:
    return in_range(F.lit(THERMAL_LOADING), F.col("pmin"), F.col("pmax"))


def _sharing(units: DataFrame, case: Sequence[str]) -> DataFrame:
    """Units with the number of units of their case: ``_units``."""
    return units.join(units.groupBy(*case).agg(F.count(F.lit(1)).alias("_units")), list(case))


def shared_profile(
    profile: DataFrame,
    units: DataFrame,
    column: str,
    case: Sequence[str] = ("case_name",),
    hours: int = HOURS_PER_YEAR,
) -> DataFrame:
    """One profile shared equally by the units of a case.

    The units are exploded into hours and meet the profile on the hour. The profile is
    broadcast, a row per hour of the axis, so the series is not shuffled for it.
    """
    hourly = each_step(_sharing(units, case), hours)
    values = profile.filter((F.col("hour_index") >= 0) & (F.col("hour_index") < hours)).select(
        "hour_index", F.col(f"`{column}`").alias("_share")
    )
    return (
        hourly.join(F.broadcast(values), "hour_index")
        .withColumn("active_power_mw", F.col("_share") * F.col("pmax") / F.col("_units"))
        .drop("_share", "_units")
    )


def representative_bus(bus_map: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """First bus of each area: by ``order`` if the map has one, else the smallest."""
    columns = bus_map.select(
        F.col("Area").cast("string").alias("area"),
        F.col("Bus ID").alias("bus_number"),
        *(order or []),
    )
    return first_per_group(columns, ["area"], order or ["bus_number"]).select(
        "area", "bus_number"
    )


def area_load(
    regional: DataFrame,
    bus_map: DataFrame,
    buses: DataFrame | None = None,
    areas: Sequence[str] = ("Area1", "Area2", "Area3"),
    case_name: str = "RTS_GMLC",
    start: str = SERIES_START,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Load rows per area and hour, placed at the area's first bus.

    The area is the last character of the regional column's name; an area
    without buses gives no rows.
    """
    present = [a for a in areas if a in regional.columns]
    long = wide_to_long(regional, ["hour_index"], present, "_area", "active_power_mw")
    # The bus is named before the join: one row per area instead of per hour.
    places = representative_bus(bus_map, order).withColumn("case_name", F.lit(case_name))
    named = []
    if buses is not None:
        places = lookup_bus(places, buses, "bus_number", "bus_name")
        named = ["bus_name"]
    placed = long.withColumn("area", F.right("_area", F.lit(1))).join(places, "area")
    load_id = F.concat(F.lit("Load_"), "_area")
    return with_time(placed, start).select(
        "time",
        load_id.alias("load_id"),
        load_id.alias("load_name"),
        F.col("bus_number").cast("string").alias("bus_id"),
        *named,
        "active_power_mw",
        reactive_power(F.col("active_power_mw")).alias("reactive_power_mvar"),
        F.lit("RTS-GMLC").alias("source"),
        "case_name",
    )


def generator_year(
    units: DataFrame,
    wind: DataFrame | None = None,
    solar: DataFrame | None = None,
    hydro: DataFrame | None = None,
    hydro_column: str = "Hydro",
    hours: int = HOURS_PER_YEAR,
    start: str = SERIES_START,
    spread: int = 1,
) -> DataFrame:
    """Unit series by fuel.

    Wind and solar units follow their own profile column, hydro units share one
    profile, all others run at a constant level. Where a whole profile file is
    missing (None) its units run at the constant level as well; where only the
    unit's column is missing the unit has no rows.
    """
    fuel = F.col("fuel")
    # What a unit keeps all year is made once per unit.
    units = units.select(
        "case_name", "name", "pmin", "pmax", "fuel", "marginal_cost",
        F.col("bus_number").cast("string").alias("bus_id"), unit_type(fuel).alias("generator_type"),
    )
    one = F.lit(1.0)
    profiled: list[str] = []
    series: list[DataFrame] = []
    kept = ["name", "bus_id", "marginal_cost", "generator_type", "case_name", "_factor", "_parts", "_steps"]
    for name, profile in (("Wind", wind), ("Solar", solar)):
        if profile is not None:
            profiled.append(name)
            scaled = with_time(scale_profile(profile, units.filter(fuel == name), hours, spread), start)
            step = F.array(F.struct("time", F.col("active_power_mw").alias("share")))
            series.append(scaled.withColumns({"_factor": one, "_parts": one, "_steps": step}).select(kept))
    if hydro is not None:
        profiled.append("Hydro")
        if hydro_column in hydro.columns:
            shared = hydro.select("hour_index", F.col(f"`{hydro_column}`").cast("double").alias("share"))
            sharing = _sharing(units.filter(fuel == "Hydro"), ["case_name"])
            sharing = sharing.withColumns({"_factor": F.col("pmax"), "_parts": F.col("_units").cast("double")})
            series.append(_with_profile(sharing, shared, hours, start).select(kept))
    steady = units.filter(~F.coalesce(fuel.isin(profiled), F.lit(False))) if profiled else units
    steady = steady.withColumns({"_factor": _steady_level(), "_parts": one})
    axis = units.sparkSession.range(hours).select(F.col("id").cast("int").alias("hour_index"), one.alias("share"))
    rows = _with_profile(steady, axis, hours, start).select(kept)
    for s in series:
        rows = rows.unionByName(s)
    # Blocks are joined and put together, and only then made rows: the last step, which what
    # follows can be fused with.
    rows = rows.select("*", F.explode("_steps").alias("_step"))
    power = zero_if_missing(F.col("_step.share") * F.col("_factor") / F.col("_parts"))
    return rows.select(
        F.col("_step.time").alias("time"),
        F.col("name").alias("generator_id"),
        F.col("name").alias("generator_name"),
        "bus_id",
        power.alias("active_power_mw"),
        reactive_power(power).alias("reactive_power_mvar"),
        F.lit(True).alias("commitment_status"),
        "marginal_cost",
        "generator_type",
        F.lit("RTS-GMLC").alias("source"),
        "case_name",
    )


def _noise(stream: str, sigma: float | Column, keys: Sequence[str], on: bool) -> Column:
    if not on:
        return F.lit(0.0)
    return gaussian(stream, *[F.col(k) for k in keys]) * sigma


def simulate_buses(
    buses: DataFrame,
    hours: int = 168,
    start: str = SERIES_START,
    noise: bool = True,
    scada: bool = False,
    source: str = "SIMULATED",
) -> DataFrame:
    """Voltage, angle (degrees to radians) and frequency per bus and hour.

    ``scada`` adds frequency noise and a quality between 95 and 100.
    """
    keys = ["case_name", "number", "hour_index"]
    rows = with_hours(buses, hours, start)
    hz = F.lit(NOMINAL_HZ) + _noise("frequency", 0.02, keys, noise and scada)
    quality = (
        uniform_integer("quality", 95, 100, *[F.col(k) for k in keys])
        if scada and noise
        else F.lit(100)
    )
    return rows.select(
        "time",
        F.col("number").cast("string").alias("bus_id"),
        F.col("name").alias("bus_name"),
        (F.col("voltage_magnitude") + _noise("voltage", 0.01, keys, noise)).alias(
            "voltage_magnitude"
        ),
        (F.radians("angle") + _noise("angle", 0.05, keys, noise)).alias("voltage_angle_rad"),
        hz.alias("frequency_hz"),
        quality.alias("measurement_quality"),
        F.lit(source).alias("source"),
        "case_name",
    )


def simulate_generators(
    generators: DataFrame,
    hours: int = 168,
    start: str = SERIES_START,
    noise: bool = True,
    scada: bool = False,
    source: str = "SIMULATED",
) -> DataFrame:
    """Output along the daily shape; noise of 2 MW, or 2 % of capacity (``scada``)."""
    keys = ["case_name", "name", "hour_index"]
    rows = with_hours(generators, hours, start)
    sigma = F.col("pmax") * 0.02 if scada else F.lit(2.0)
    power = in_range(load_factor(F.col("time")), F.col("pmin"), F.col("pmax")) + _noise(
        "generation", sigma, keys, noise
    )
    return rows.withColumn("active_power_mw", power).select(
        "time",
        F.col("name").alias("generator_id"),
        F.col("name").alias("generator_name"),
        F.col("bus_number").cast("string").alias("bus_id"),
        "active_power_mw",
        reactive_power(F.col("active_power_mw")).alias("reactive_power_mvar"),
        F.lit(True).alias("commitment_status"),
        F.col("cost_linear").alias("marginal_cost"),
        F.col("type").alias("generator_type"),
        F.lit(source).alias("source"),
        "case_name",
    )


def simulate_loads(
    loads: DataFrame,
    hours: int = 168,
    start: str = SERIES_START,
    noise: bool = True,
    source: str = "SIMULATED",
) -> DataFrame:
    """Demand along the daily shape, noise of 1 MW on the active part."""
    keys = ["case_name", "name", "hour_index"]
    rows = with_hours(loads, hours, start)
    shape = load_factor(F.col("time"))
    return rows.select(
        "time",
        F.col("name").alias("load_id"),
        F.col("name").alias("load_name"),
        F.col("bus_number").cast("string").alias("bus_id"),
        (F.col("active_power") * shape + _noise("demand", 1.0, keys, noise)).alias(
            "active_power_mw"
        ),
        (F.col("reactive_power") * shape).alias("reactive_power_mvar"),
        F.lit(source).alias("source"),
        "case_name",
    )
