"""Appends, idempotent loads, retention and exports.

Every writer is a distributed Spark write; columns are matched by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators.joins import new_cases
from gridlake.session import fresh_path

# Days a raw table is kept; loads are kept for ever.
RETENTION_DAYS = {
    "power_measurements": 90,
    "generator_measurements": 90,
    "branch_measurements": 90,
    "renewable_forecasts": 30,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name and type; NULL where ``df`` has none."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def stage(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a table written to the shared folder.

    For a result that several jobs use: it is computed once, and a lost executor
    repeats a scan instead of the joins before it.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_measurements(
    df: DataFrame,
    path: str,
    time: str = "time",
    entity: str | None = None,
    schema: T.StructType | None = None,
) -> None:
    """Append to a Parquet table partitioned by ``date``, with the columns of ``schema``
    if it is given, so that loaders of different sources write one layout.

    The rebalance hint brings rows of a day together and lets Spark split a day
    that is larger than the advisory partition size over several tasks, so quiet
    days make few files and a hot day is still written in parallel.
    """
    rows = df if schema is None else conform(df, schema)
    (
        rows.withColumn("date", F.to_date(time))
        .hint("rebalance", "date")
        .sortWithinPartitions("date", *([entity] if entity else []), time)
        .write.mode("append")
        .partitionBy("date")
        .parquet(path)
    )


def append_results(df: DataFrame, schema: T.StructType, path: str) -> None:
    """Append result rows in the column order of ``schema``, matched by name."""
    conform(df, schema).write.mode("append").parquet(path)


def append_new_cases(new: DataFrame, existing: DataFrame, path: str, key: str = "case_name") -> None:
    """Append only cases that are not there yet."""
    new_cases(new, existing, key).write.mode("append").parquet(path)


def tag_results(df: DataFrame, execution_id: str | Column, written_at: Column | None = None) -> DataFrame:
    """Result rows with the execution's id and the write time."""
    ident = F.lit(execution_id) if isinstance(execution_id, str) else execution_id
    return df.withColumns(
        {
            "execution_id": ident,
            "recorded_at": F.current_timestamp() if written_at is None else written_at,
        }
    )


# Settings an execution record gets where the run gives none.
EXECUTION_DEFAULTS = {
    "optimization_horizon_hours": 24,
    "triggered_by": "MANUAL",
}


def execution_records(runs: DataFrame, generate_id: bool = True) -> DataFrame:
    """Run settings as execution records, with defaults and a new id per row.

    Write the result before using it twice: a generated id is new on every run.
    """
    columns: dict[str, Column] = {}
    for name, default in EXECUTION_DEFAULTS.items():
        given = F.col(name) if name in runs.columns else F.lit(None)
        columns[name] = F.coalesce(given, F.lit(default))
    if "execution_time" in runs.columns:
        columns["execution_time"] = F.coalesce(
            "execution_time", F.current_timestamp().cast("timestamp_ntz")
        )
    else:
        columns["execution_time"] = F.current_timestamp().cast("timestamp_ntz")
    if generate_id:
        columns["execution_id"] = F.expr("uuid()")
    return runs.withColumns(columns)


def apply_retention(df: DataFrame, as_of: Column, days: int, time: str = "time") -> DataFrame:
    """Rows young enough to keep at ``as_of``."""
    return df.filter(F.col(time) >= as_of - F.make_dt_interval(F.lit(days)))


def apply_table_retention(df: DataFrame, table: str, as_of: Column, time: str = "time") -> DataFrame:
    """Retention by the table's own days; a table without an entry keeps everything."""
    days = RETENTION_DAYS.get(table)
    return df if days is None else apply_retention(df, as_of, days, time)


def expired_dates(df: DataFrame, as_of: Column, days: int, date: str = "date") -> DataFrame:
    """``date`` partitions that lie wholly before the retention limit."""
    limit = F.to_date(as_of - F.make_dt_interval(F.lit(days)))
    return df.filter(F.col(date) < limit).select(date).distinct()


def rewrite_retained(df: DataFrame, as_of: Column, days: int, path: str, time: str = "time") -> None:
    """Write the retained rows of a date-partitioned table to a new folder.

    The date predicate prunes expired folders, so they are not read.
    """
    limit = as_of - F.make_dt_interval(F.lit(days))
    kept = apply_retention(df.filter(F.col("date") >= F.to_date(limit)), as_of, days, time)
    append_measurements(kept.drop("date"), path, time)


def write_csv(df: DataFrame, path: str, quote_all: bool = True) -> None:
    """CSV folder with a header; as many files as the data has partitions."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", quote_all).csv(path)


# Columns of the four solution exports.
SOLUTION_COLUMNS = {
    "biomass": ["Resource", "SourceCounty", "ProdCounty", "Year", "Production"],
    "energy": ["Tech", "County", "Year", "Energy"],
    "co2_transport": ["Tech", "County", "Basin", "Year", "Amount"],
    "co2_sequestration": ["Basin", "Year", "Amount"],
}


def write_solution_csv(df: DataFrame, path: str, kind: str) -> None:
    """Export a solution table under its fixed headings, by position."""
    write_csv(df.toDF(*SOLUTION_COLUMNS[kind]), path)


def write_report(df: DataFrame, path: str, form: str = "json") -> None:
    """Report rows as JSON lines or CSV."""
    if form == "json":
        df.write.mode("overwrite").json(path)
    elif form == "csv":
        write_csv(df, path)
    else:
        raise ValueError(f"unknown report form {form!r}")
