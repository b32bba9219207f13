"""Solution tables of an allocation model: dense grids, objective, audits.

Solutions are sparse tables keyed by index columns; a missing row is 0. Sums are
formed before a parameter is joined, so a hot county, year or basin is combined
on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.operators.ordered import number_rows

# Parameter defaults, transport price per ton-mile, pipeline limit.
PRICE_DEFAULT = 1000.0
DISTANCE_DEFAULT = 1000.0
POTENTIAL_DEFAULT = 0.0
TRANSPORT_PRICE = 0.163
PIPELINE_CAPACITY = 1_000_000.0


def with_parameter(
    df: DataFrame, parameter: DataFrame, on: Sequence[str], value: str, default: float | None
) -> DataFrame:
    """Adds a sparse parameter's value; ``default`` where it has no row."""
    joined = df.join(parameter.select(*on, value), list(on), "left")
    if default is None:
        return joined
    return joined.withColumn(value, F.coalesce(value, F.lit(default)))


def index_grid(axes: dict[str, DataFrame]) -> DataFrame:
    """All combinations of the index sets, one column per axis.

    Each axis is numbered, the combinations are the numbers of one range, and
    every axis value is fetched by an equi-join on its own number: evenly
    spread, whatever the sizes, and never a product of two tables. Its output is
    every combination by definition; audits and costs use :func:`with_parameter`.
    """
    sizes = {name: df.count() for name, df in axes.items()}
    spark = next(iter(axes.values())).sparkSession
    total = 1
    for n in sizes.values():
        total *= n
    grid = spark.range(total).withColumnRenamed("id", "_cell")
    stride = total
    for name, df in axes.items():
        if sizes[name] == 0:
            grid = grid.withColumn(name, F.lit(None).cast(df.schema[name].dataType))
            continue
        stride //= sizes[name]
        number = F.expr(f"_cell div {stride} % {sizes[name]}")
        numbered = number_rows(df.select(name), name, f"_n_{name}")
        grid = (
            grid.withColumn(f"_n_{name}", number)
            .join(numbered, f"_n_{name}")
            .drop(f"_n_{name}")
        )
    return grid.drop("_cell")


def densify(axes: dict[str, DataFrame], sparse: DataFrame, value: str, default: float) -> DataFrame:
    """Value for every combination of the index sets. To look up single values
    use :func:`with_parameter`, which needs no grid."""
    return with_parameter(index_grid(axes), sparse, list(axes), value, default)


def dense_totals(
    axes: dict[str, DataFrame], sparse: DataFrame, value: str, default: float, by: str | None = None
) -> DataFrame:
    """Count, sum, mean and extremes of :func:`densify` without its grid, in all or per ``by``.

    A group has as many cells as the other axes have combinations. What the stored cells do
    not fill has the default, so a sum is ``stored + (cells - stored cells) * default``: the
    work grows with the stored cells and the axes, not with the combinations.

    An axis holds each value once, and ``sparse`` each cell once. Stored cells outside the
    axes do not count, a stored null has the default. Without cells the measures are null.
    """
    # An axis' size is looked up once, as a number of the plan, and starts no job here.
    cells = F.lit(1).cast("bigint")
    for name, df in axes.items():
        if name != by:
            cells = cells * df.agg(F.count(F.lit(1))).scalar()
    inside = sparse.filter(F.col(value).isNotNull())
    for name, df in axes.items():
        inside = inside.join(df.select(name), name, "left_semi")
    measures = [
        F.count(F.lit(1)).alias("stored"),
        F.sum(value).alias("_sum"),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
    ]
    if by is None:
        found, keys = inside.agg(*measures), []
    else:
        found, keys = axes[by].select(by).join(inside.groupBy(by).agg(*measures), by, "left"), [by]
    stored, rest = F.coalesce("stored", F.lit(0)), F.col("cells") - F.col("stored")
    fill = F.when(rest > 0, F.lit(float(default)))
    return (
        found.withColumns({"cells": cells, "stored": stored})
        .withColumn("total", F.coalesce("_sum", F.lit(0.0)) + F.coalesce(rest * fill, F.lit(0.0)))
        .select(
            *keys,
            "cells",
            "stored",
            F.when(F.col("cells") > 0, F.col("total")).alias("total"),
            F.when(F.col("cells") > 0, F.col("total") / F.col("cells")).alias("mean"),
            F.least("_low", fill).alias("low"),
            F.greatest("_high", fill).alias("high"),
        )
    )


def _reduced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Amounts summed before a parameter or region is joined."""
    return df.groupBy(*keys).agg(F.sum("amount").alias("amount"))


def objective_terms(
    x: DataFrame,
    y: DataFrame,
    z: DataFrame,
    feedstock_price: DataFrame,
    feedstock_distance: DataFrame,
    co2_distance: DataFrame,
    co2_price: DataFrame,
    injection_price: DataFrame,
    transport_price: float = TRANSPORT_PRICE,
) -> DataFrame:
    """The four cost terms of a solution and their total.

    ``x(feedstock, source, county, year)``, ``y(tech, county, basin, year)`` and
    ``z(basin, year)`` have an ``amount``; parameters have a ``value``.
    """

    def term(name: str, df: DataFrame, cost: Column) -> DataFrame:
        return df.agg(F.coalesce(F.sum(cost), F.lit(0.0)).alias("cost")).select(
            F.lit(name).alias("term"), "cost"
        )

    amount = F.col("amount")
    by_origin = _reduced(x, ["feedstock", "source", "year"])
    by_route = _reduced(x, ["source", "county"])
    by_pipe = _reduced(y, ["county", "basin", "year"])
    by_basin = _reduced(z, ["basin"])
    # Ton-miles per year first: the price then meets one row per year.
    ton_miles = (
        with_parameter(by_pipe, co2_distance, ["county", "basin"], "value", DISTANCE_DEFAULT)
        .groupBy("year")
        .agg(F.sum(F.col("value") * amount).alias("amount"))
        .join(co2_price, "year")
    )
    terms = term(
        "feedstock",
        with_parameter(
            by_origin, feedstock_price, ["feedstock", "source", "year"], "value", PRICE_DEFAULT
        ),
        F.col("value") * amount,
    )
    for part in (
        term(
            "feedstock_transport",
            with_parameter(
                by_route, feedstock_distance, ["source", "county"], "value", DISTANCE_DEFAULT
            ),
            F.lit(transport_price) * F.col("value") * amount,
        ),
        term("co2_transport", ton_miles, F.col("value") * amount),
        term("injection", by_basin.join(injection_price, "basin"), F.col("value") * amount),
    ):
        terms = terms.unionByName(part)
    # Four rows; the rollup adds the total without stating the terms again.
    return (
        terms.rollup("term")
        .agg(F.sum("cost").alias("cost"))
        .select(F.coalesce("term", F.lit("total")).alias("term"), "cost")
    )


def balance(
    left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: float = 1e-6
) -> DataFrame:
    """Audit of ``sum(left) = sum(right)`` per key, on either side's keys.

    Both tables have an ``amount``. A key that is missing on one side has 0.
    """
    a = left.groupBy(*keys).agg(F.sum("amount").alias("left_total"))
    b = right.groupBy(*keys).agg(F.sum("amount").alias("right_total"))
    return (
        a.join(b, list(keys), "full_outer")
        .na.fill(0.0, ["left_total", "right_total"])
        .withColumn("residual", F.col("left_total") - F.col("right_total"))
        .withColumn("violated", F.abs("residual") > tolerance)
    )


def capacity(
    used: DataFrame,
    limit: DataFrame | float,
    keys: Sequence[str],
    default: float | None = None,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Audit of ``sum(used) <= limit`` per key.

    ``limit`` is one number or a table with a ``capacity``; ``default`` is the
    capacity of a key without a row, without it such a key is not limited. Keys
    that only the limit table has are reported with use 0.
    """
    total = used.groupBy(*keys).agg(F.sum("amount").alias("used"))
    if isinstance(limit, (int, float)):
        joined = total.withColumn("capacity", F.lit(float(limit)))
    else:
        joined = total.join(limit.select(*keys, "capacity"), list(keys), "full_outer").na.fill(
            0.0, ["used"]
        )
        if default is not None:
            joined = joined.na.fill(default, ["capacity"])
    return joined.withColumn(
        "violated", F.coalesce(F.col("used") > F.col("capacity") + tolerance, F.lit(False))
    )


def converted(df: DataFrame, factor: DataFrame, on: Sequence[str]) -> DataFrame:
    """``amount`` times the factor's ``value`` (energy to feedstock, energy to CO2)."""
    return df.join(factor.select(*on, "value"), list(on)).withColumn(
        "amount", F.col("amount") * F.col("value")
    ).drop("value")


def to_region(df: DataFrame, mapping: DataFrame, county: str = "county") -> DataFrame:
    """Adds the region of each county; counties outside the mapping drop out."""
    return df.join(mapping.select(county, "region"), county)


def energy_audit(u: DataFrame, demand: DataFrame, mapping: DataFrame) -> DataFrame:
    """Energy made per technology, region and year against the demand."""
    return balance(
        to_region(_reduced(u, ["tech", "county", "year"]), mapping), demand, ["tech", "region", "year"]
    )


def feedstock_audit(x: DataFrame, u: DataFrame, per_energy: DataFrame) -> DataFrame:
    """Feedstock received per county and year against what the plants consume."""
    energy = _reduced(u, ["tech", "county", "year"])
    return balance(x, converted(energy, per_energy, ["tech"]), ["county", "year"])


def potential_audit(x: DataFrame, potential: DataFrame) -> DataFrame:
    """Feedstock taken per origin against its potential (0 where unknown)."""
    return capacity(x, potential, ["feedstock", "source", "year"], POTENTIAL_DEFAULT)


def basin_audit(z: DataFrame, basin_capacity: DataFrame) -> DataFrame:
    return capacity(z, basin_capacity, ["basin"])


def pipeline_audit(y: DataFrame, limit: float = PIPELINE_CAPACITY) -> DataFrame:
    return capacity(y, limit, ["county", "basin", "year"])


def transport_audit(y: DataFrame, u: DataFrame, co2_per_energy: DataFrame) -> DataFrame:
    """CO2 sent per plant against what its energy produces."""
    energy = _reduced(u, ["tech", "county", "year"])
    return balance(y, converted(energy, co2_per_energy, ["tech"]), ["tech", "county", "year"])


def arrival_audit(y: DataFrame, z: DataFrame) -> DataFrame:
    """CO2 arriving per basin and year against what is injected."""
    return balance(y, z, ["basin", "year"])
