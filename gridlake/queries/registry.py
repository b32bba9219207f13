"""Registry of queries and the table access they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed time that stands for "now" in the registered queries.
AS_OF = "2024-01-25 00:00:00"


class Tables:
    """The Parquet tables of a directory, by name: ``t.events``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def path(self, name: str) -> str:
        return f"{self.directory}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` with its checking SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            use_utc(spark)
            return fn(Tables(spark, directory))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


def as_of(text: str = AS_OF) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Floating sums depend on the order of addition in the last bits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
