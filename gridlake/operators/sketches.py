"""Distinct counts that can be merged: a stored sketch per cell, the exact count beside it.

A cell is a day and an execution, or any other keys. A batch adds cells of its own rows; a
later question over many cells merges their sketches and reads no row again. Counts of cells
cannot be added, but they bound the answer: a union has at least as many members as its
largest cell and at most as many as all cells together, so the estimate is cut to that range.
A group of a single cell is therefore exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.sinks.once import append_once, read_once

# 2^12 registers: at most 4 KB a cell, and fewer where a cell has few members.
LG_REGISTERS = 12


def standard_error(lg_registers: int = LG_REGISTERS) -> float:
    """Relative standard error of a merged sketch."""
    return 1.04 / math.sqrt(2**lg_registers)


def distinct_cells(
    df: DataFrame, entity: str, keys: Sequence[str], lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """``(*keys, n_rows, n_distinct, sketch)``: rows, exact count and sketch of ``entity``.

    Rows are reduced to one per key and entity first, before the shuffle too, so a cell that
    holds a third of all rows is shared among tasks and the exact count costs no second pass.
    A null entity counts as a row and not as a member; null keys form a cell. ``entity`` is a
    string, binary or integer column.
    """
    once = df.groupBy(*keys, F.col(entity).alias("_member")).agg(F.count(F.lit(1)).alias("_n"))
    return once.groupBy(*keys).agg(
        F.sum("_n").alias("n_rows"),
        F.count("_member").alias("n_distinct"),
        F.hll_sketch_agg("_member", F.lit(lg_registers)).alias("sketch"),
    )


def store_cells(cells: DataFrame, path: str, batch: str) -> bool:
    """Add a batch's cells once, however often its job runs; says whether they were added."""
    return append_once(cells, path, batch)


def stored_cells(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_once(spark, path, schema)


def merged_distinct(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, n_cells, n_rows, at_least, at_most, estimate, n_distinct)`` of the cells' unions.

    ``n_distinct`` is the estimate within its bounds. Sketches are merged before the shuffle,
    a few KB per group and task. Cells of one day from several batches merge like any others.
    """
    merged = cells.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.sum("n_rows").alias("n_rows"),
        F.max("n_distinct").alias("at_least"),
        F.sum("n_distinct").alias("at_most"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"),
    )
    within = F.least(F.greatest("estimate", "at_least"), "at_most")
    return merged.withColumn("n_distinct", within)
