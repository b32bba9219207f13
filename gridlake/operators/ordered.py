"""Order-dependent operators that stay parallel inside one hot group.

A plain window over ``partitionBy(entity)`` sorts a whole entity in one task. An
entity may hold a third of all rows, so these operators cut each entity into
buckets that follow the order (a day of time, a run of arrival numbers), work
inside the buckets, and carry only one small summary row per bucket across.

``bucket`` must be non-decreasing in ``order`` within a group: every row of an
earlier bucket sorts before every row of a later one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridlake.session import fresh_path

_BUCKET = "_bucket"
_CELL = "_cell"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def time_bucket(column: str, unit: str = "day") -> Column:
    """Bucket for data ordered by time.

    A bucket should hold many rows of an entity, or the summary grows as large as
    the data, yet no more than one task can sort: days suit series of one value
    per second up to one per hour, hours suit denser ones.
    """
    return F.date_trunc(unit, F.col(column))


def number_bucket(column: str, width: int = 100_000) -> Column:
    """Bucket for data ordered by a unique number; holds at most ``width`` rows."""
    number = F.col(column)
    return number - F.pmod(number, F.lit(width))


# Rows of a cell that one task should sort.
RANGE_ROWS = 100_000
_RANGE = "_range"


def spread_ranges(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    bucket: Column | None = None,
    slot: Column | None = None,
    most: int | None = None,
) -> tuple[DataFrame, Column]:
    """The rows with ``_range``, and a bucket that cuts large cells into ranges of about ``most``
    rows (RANGE_ROWS without it).

    Rows are counted per cell and ``slot`` (a minute of ``by``), a combinable sum; the running
    count over a cell's slots gives the splitters. Only cells above ``most`` have ranges, and
    where there are none the rows are not joined with anything. Rows of one slot stay together.
    """
    most = RANGE_ROWS if most is None else most
    base = time_bucket(by) if bucket is None else bucket
    at = F.date_trunc("minute", F.col(by)) if slot is None else slot
    cell = F.struct(*[F.col(k) for k in keys], base.alias(_BUCKET))
    counted = df.groupBy(cell.alias(_CELL), at.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy(_CELL)
    before = F.sum("_n").over(inside.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1))
    ranges = counted.withColumns({"_before": F.coalesce(before, F.lit(0)), "_all": F.sum("_n").over(inside)})
    ranges = ranges.filter(F.col("_all") > most).select(
        F.struct(_CELL, "_slot").alias("_place"), F.floor(F.col("_before") / most).cast("long").alias(_RANGE)
    )
    ranges = stage(ranges, "ranges")
    split = F.struct(base.alias("_base"), F.col(_RANGE).alias("_of"))
    if ranges.isEmpty():
        return df.withColumn(_RANGE, F.lit(0).cast("long")), split
    placed = df.withColumn("_place", F.struct(cell.alias(_CELL), at.alias("_slot"))).join(ranges, "_place", "left")
    return placed.drop("_place").withColumn(_RANGE, F.coalesce(_RANGE, F.lit(0).cast("long"))), split


def _cells(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """Tag rows with their (group, bucket) cell.

    The cell is one struct column: a null key still forms a group, and window,
    aggregate and join share a single partitioning on it.
    """
    return df.withColumn(_CELL, F.struct(*keys, bucket.alias(_BUCKET)))


def _across(keys: Sequence[str]):
    return Window.partitionBy(*[F.col(f"{_CELL}.{k}") for k in keys]).orderBy(
        F.col(f"{_CELL}.{_BUCKET}")
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    output: str = "position",
) -> DataFrame:
    """0-based position of each row in its group."""
    rows = _cells(df, keys, bucket)
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(_CELL)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(_CELL, F.sum("_n").over(before).alias("_before"))
    )
    inside = Window.partitionBy(_CELL).orderBy(*order)
    return (
        rows.withColumn("_at", F.row_number().over(inside))
        .join(offsets, _CELL, "left")
        .select(
            *df.columns,
            (F.coalesce("_before", F.lit(0)) + F.col("_at") - 1).alias(output),
        )
    )


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    bucket: Column,
    prefix: str = "prev_",
) -> DataFrame:
    """Values of the preceding row of the group, as ``prev_<column>``."""
    rows = _cells(df, keys, bucket)
    # With one order column the values are kept singly, which a hash aggregate
    # can hold; a struct would make Spark sort the rows first.
    if len(order) == 1:
        lasts = [F.max_by(v, order[0]).alias(f"_last_{v}") for v in values]
        last = F.struct(*[F.col(f"_last_{v}").alias(v) for v in values])
    else:
        lasts = [F.max_by(F.struct(*values), F.struct(*order)).alias("_last")]
        last = F.col("_last")
    carried = (
        rows.groupBy(_CELL)
        .agg(*lasts)
        .select(_CELL, F.lag(last).over(_across(keys)).alias("_carry"))
    )
    inside = Window.partitionBy(_CELL).orderBy(*order)
    return (
        rows.withColumn("_here", F.lag(F.struct(*values)).over(inside))
        .join(carried, _CELL, "left")
        .withColumn("_prev", F.coalesce("_here", "_carry"))
        .select(
            *df.columns, *[F.col(f"_prev.{v}").alias(f"{prefix}{v}") for v in values]
        )
    )


def with_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    bucket: Column,
    output: str = "running_sum",
) -> DataFrame:
    """Sum of ``value`` from the group's first row up to and including each row."""
    rows = _cells(df, keys, bucket)
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(_CELL)
        .agg(F.sum(value).alias("_total"))
        .select(_CELL, F.sum("_total").over(before).alias("_before"))
    )
    inside = (
        Window.partitionBy(_CELL)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_inside", F.sum(value).over(inside))
        .join(offsets, _CELL, "left")
        .select(
            *df.columns,
            (F.coalesce("_before", F.lit(0)) + F.col("_inside")).alias(output),
        )
    )


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """First row of each group; a combinable aggregate, so no sort or window."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def latest_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Last row of each group by ``order``."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def number_rows(df: DataFrame, key: str, output: str = "position", buckets: int = 1024) -> DataFrame:
    """Dense 0-based numbers for the rows of a set with a unique ``key``.

    Rows are numbered inside hash buckets and shifted by the sizes of the lower
    buckets; the only single-task step handles ``buckets`` rows.
    """
    rows = df.withColumn(_BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)))
    shift = (
        rows.groupBy(_BUCKET)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.sum("_n").over(
                Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .drop("_n")
    )
    inside = Window.partitionBy(_BUCKET).orderBy(key)
    return (
        rows.withColumn("_at", F.row_number().over(inside))
        .join(F.broadcast(shift), _BUCKET)  # at most `buckets` rows
        .withColumn(output, F.coalesce("_before", F.lit(0)) + F.col("_at") - 1)
        .drop("_before", "_at", _BUCKET)
    )
