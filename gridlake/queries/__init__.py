"""Queries on the driver tables, each with the SQL that checks it."""

from __future__ import annotations

from gridlake.queries import (  # noqa: F401
    appends,
    case_lines,
    cases,
    chunks,
    derived,
    inputs,
    measurements,
    quality,
    results,
    scenario,
    series,
    solution,
    streams,
)
from gridlake.queries.registry import ORACLE, QUERIES  # noqa: F401
