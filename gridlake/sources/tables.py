"""CSV tables, wide hourly profiles and Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators.ordered import with_position


def is_missing_path(error: AnalysisException) -> bool:
    """True where the path is absent; any other fault of a reader is not hidden."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType, file_order: bool = False
) -> DataFrame:
    """CSV with a header, typed by column name.

    Columns of ``schema`` that the file lacks stay absent, so a converter can
    tell "no such column" from "empty value"; columns unknown to ``schema`` are
    kept as text. With ``file_order`` a ``row_no`` column gives the 0-based
    position in the file.
    """
    raw = spark.read.option("header", True).csv(path)
    declared = {field.name: field.dataType for field in schema.fields}
    typed = raw.select(
        *[
            F.col(f"`{c}`").try_cast(declared[c]).alias(c)
            if c in declared
            else F.col(f"`{c}`")
            for c in raw.columns
        ],
        *_file_place(file_order),
    )
    return _number_by_place(typed) if file_order else typed


def _file_place(wanted: bool) -> list[Column]:
    if not wanted:
        return []
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    ]


def _number_by_place(df: DataFrame) -> DataFrame:
    """Position in the file: blocks by offset, rows in reading order inside one.

    A block is read by one task from front to back, so the order holds however
    blocks are spread over tasks.
    """
    return with_position(df, ["_file"], ["_seq"], F.col("_block"), "row_no").drop(
        "_file", "_block", "_seq"
    )


def read_profiles(
    spark: SparkSession, folder: str, stem: str, order_column: str | None = None
) -> DataFrame | None:
    """Wide hourly file ``<folder>/<stem>.csv`` as ``hour_index`` + one column per
    unit, or None where the folder or the file is missing.

    The hour is the row's place in the file, or ``order_column`` where the data
    names it (needed when the profile is a folder of several files).
    """
    try:
        raw = spark.read.option("header", True).csv(f"{folder}/{stem}.csv")
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return None
    columns = raw.columns
    if not columns:
        return None
    if order_column is not None:
        return raw.select(
            F.col(f"`{order_column}`").cast("int").alias("hour_index"),
            *[
                F.col(f"`{c}`").try_cast("double").alias(c)
                for c in columns
                if c != order_column
            ],
        )
    typed = raw.select(
        *[F.col(f"`{c}`").try_cast("double").alias(c) for c in columns],
        *_file_place(True),
    )
    return _number_by_place(typed).withColumnRenamed("row_no", "hour_index")


def profile_stems(spark: SparkSession, folder: str) -> DataFrame:
    """``(stem, rows)`` of the profiles in a folder, each one file or a folder of several
    with the profile's name; empty if there is none."""
    reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
    try:
        lines = reader.option("recursiveFileLookup", True).csv(folder)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return spark.createDataFrame([], "stem string, rows bigint")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.csv(?:/part-[^/]*)?$", 1)
    return lines.groupBy(name.alias("stem")).agg(F.count(F.lit(1)).alias("rows"))


def read_custom_loads(spark: SparkSession, path: str, case_name: str) -> DataFrame:
    """Load measurements from a custom CSV; ids are ``Load_<bus>``."""
    from gridlake.schemas import CUSTOM_LOAD_CSV

    return custom_loads(read_csv_table(spark, path, CUSTOM_LOAD_CSV), case_name)


def custom_loads(raw: DataFrame, case_name: str) -> DataFrame:
    load_id = F.concat(F.lit("Load_"), F.col("bus_id").cast("string"))
    return raw.select(
        F.col("timestamp").alias("time"),
        load_id.alias("load_id"),
        load_id.alias("load_name"),
        F.col("bus_id").cast("string").alias("bus_id"),
        "active_power_mw",
        "reactive_power_mvar",
        F.lit("CUSTOM").alias("source"),
        F.lit(case_name).alias("case_name"),
    )


def rows_with_marker(df: DataFrame, column: str, marker: str = "DE") -> DataFrame:
    """Rows whose text column contains the marker."""
    return df.filter(F.col(column).cast("string").contains(marker))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; filters and columns chosen later reach the scan."""
    return spark.read.parquet(path)


def read_measurements(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Measurement table written by ``gridlake.sinks``, closed time range.

    The same range is put on the ``date`` partition column, so folders outside
    it are not listed or read.
    """
    table = spark.read.parquet(path)
    if start is not None:
        table = table.filter(
            (F.col("date") >= F.to_date(F.lit(start)))
            & (F.col("time") >= F.to_timestamp_ntz(F.lit(start)))
        )
    if end is not None:
        table = table.filter(
            (F.col("date") <= F.to_date(F.lit(end)))
            & (F.col("time") <= F.to_timestamp_ntz(F.lit(end)))
        )
    return table


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, column: str, low: str, high: str, parts: int
) -> DataFrame:
    """Database table read in ``parts`` ranges of ``column``."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts
    )
