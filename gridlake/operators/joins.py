"""Lookups, reference checks and joins that tolerate hot keys.

Catalyst and AQE broadcast a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and sort-merge with skew splitting
otherwise; no plan depends on a count made beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.operators.ordered import first_per_group, latest_per_group


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread: int = 1,
) -> DataFrame:
    """Equi-join where one key of ``facts`` may hold a large share of its rows.

    With ``spread`` > 1 each lookup row is repeated once per slice and each fact
    row goes to the slice its own content hashes to, so a hot key is shared by
    that many tasks. ``how`` is ``inner``, ``left``, ``left_semi`` or
    ``left_anti``; the lookup should hold few rows per key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join does not support {how!r}")
    if spread <= 1:
        return facts.join(lookup, list(on), how)
    sliced = facts.withColumn(
        "_slice", F.pmod(F.xxhash64(*facts.columns), F.lit(spread)).cast("int")
    )
    copies = lookup.withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    )
    return sliced.join(copies, [*on, "_slice"], how).drop("_slice")


def lookup_bus(
    df: DataFrame,
    buses: DataFrame,
    key: str,
    output: str,
    case: Sequence[str] = ("case_name",),
    bus_key: str = "number",
    bus_name: str = "name",
    order: Sequence[str] | None = None,
    spread: int = 1,
) -> DataFrame:
    """Bus name for ``key``, or ``Bus<id>`` where the bus is unknown.

    The first bus wins where a number occurs twice (``order``, default by name).
    """
    names = first_per_group(
        buses.select(
            *case,
            F.col(bus_key).alias(key),
            F.col(bus_name).alias(output),
            *[F.col(c).alias(f"_o_{c}") for c in (order or [])],
        ),
        [*case, key],
        [f"_o_{c}" for c in (order or [])] + [output],
    ).select(*case, key, output)
    joined = spread_join(df, names, [*case, key], "left", spread)
    return joined.withColumn(
        output, F.coalesce(F.col(output), F.concat(F.lit("Bus"), F.col(key).cast("string")))
    )


def dangling(
    df: DataFrame, reference: DataFrame, key: str, reference_key: str
) -> DataFrame:
    """Rows whose ``key`` has no partner in ``reference``."""
    known = reference.select(F.col(reference_key).alias(key)).distinct()
    return df.join(known, key, "left_anti")


def missing_components(
    series: DataFrame, components: DataFrame, key: str, component_key: str
) -> DataFrame:
    """Ids that have series rows but no component, with their row counts."""
    return dangling(
        series.groupBy(key).agg(F.count(F.lit(1)).alias("rows")),
        components,
        key,
        component_key,
    )


def attach_series(
    series: DataFrame, components: DataFrame, on: Sequence[str], spread: int = 1
) -> DataFrame:
    """Series rows of known components together with the component's columns."""
    return spread_join(series, components, on, "inner", spread)


def new_cases(new: DataFrame, existing: DataFrame, key: str = "case_name") -> DataFrame:
    """Rows of ``new`` whose case is not loaded yet."""
    return new.join(existing.select(key).distinct(), key, "left_anti")


def as_of_version(
    topology: DataFrame,
    as_of: Column,
    case: str = "case_name",
    valid_from: str = "valid_from",
    valid_until: str = "valid_until",
    tie: str = "topology_id",
) -> DataFrame:
    """Newest version per case that has not expired at ``as_of``."""
    alive = topology.filter(F.col(valid_until).isNull() | (F.col(valid_until) > as_of))
    return latest_per_group(alive, [case], [valid_from, tie])


def affected_elements(
    contingencies: DataFrame,
    elements: str,
    output: str,
    keep: Sequence[str] = ("contingency_name",),
) -> DataFrame:
    """One row per contingency and affected element (null element where none)."""
    return contingencies.select(*keep, F.explode_outer(elements).alias(output))
