"""Scalar column expressions used by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fuel names as they occur in unit files, and the unit type each
# one stands for. Every other fuel counts as THERMAL.
FUEL_TYPES = {
    "Coal": "THERMAL",
    "NG": "THERMAL",
    "Nuclear": "NUCLEAR",
    "Oil": "THERMAL",
    "Hydro": "HYDRO",
    "Wind": "WIND",
    "Solar": "SOLAR",
    "Sync_Cond": "SYNC_COND",
    "Storage": "STORAGE",
}
DEFAULT_UNIT_TYPE = "THERMAL"

# Fixed value: reactive power per MW of active power.
REACTIVE_SHARE = 0.3


def unit_type(fuel: Column) -> Column:
    """Unit type of a fuel name."""
    pairs = [F.lit(part) for item in FUEL_TYPES.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), fuel), F.lit(DEFAULT_UNIT_TYPE))


def load_factor(time: Column) -> Column:
    """Daily load shape: 0.6 with a swing of 0.3, lowest at 00:00, highest at 12:00."""
    return F.lit(0.6) + F.lit(0.3) * F.sin((F.hour(time) - 6) * F.lit(math.pi) / 12)


def in_range(fraction: Column, low: Column, high: Column) -> Column:
    """Point at ``fraction`` of the way from ``low`` to ``high``."""
    return low + fraction * (high - low)


def reactive_power(active: Column) -> Column:
    return active * F.lit(REACTIVE_SHARE)


def zero_if_missing(value: Column) -> Column:
    """0 for NULL and for NaN."""
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(0.0))


def monday_based_weekday(time: Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(time)


def parse_iso_time(text: Column) -> Column:
    """Timestamp of an ISO text, NULL where it does not parse."""
    return F.try_to_timestamp(text)


def midnight(time: Column) -> Column:
    return F.date_trunc("day", time)


def magnitude(a: Column, b: Column) -> Column:
    return F.sqrt(a * a + b * b)


def power_factor(active: Column, reactive: Column) -> Column:
    """Active over apparent power, NULL for a unit at rest."""
    apparent = magnitude(active, reactive)
    return F.when(apparent > 0, active / apparent)


def topology_id(case_name: Column) -> Column:
    """Deterministic id of a case, so reloading a case yields the same id."""
    return F.xxhash64(case_name)


def hours_after(hour: Column, start: str) -> Column:
    """Time that lies ``hour`` whole hours after ``start``."""
    return F.to_timestamp_ntz(F.lit(start)) + F.make_dt_interval(
        F.lit(0), hour.cast("int"), F.lit(0), F.lit(0)
    )
