"""Case text files: matrices of numbers and quoted names in a script-like text.

One file is one row, so parsing is parallel over files and never shuffles: a
block is cut out, split into lines, cleaned and checked inside the row, and only
then exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_BASE_MVA = 100.0

_BLANKS = " \t\r\f\x0b"


def read_case_text(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(case_name, content)`` for the case files below ``path``.

    The case name is the file stem, or the value of a ``case_name=`` folder.
    """
    files = spark.read.text(path, wholetext=True)
    if "case_name" in files.columns:
        return files.select(F.col("case_name").cast("string"), F.col("value").alias("content"))
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    return files.select(stem.alias("case_name"), F.col("value").alias("content"))


def base_mva(cases: DataFrame) -> DataFrame:
    """``(case_name, base_mva)``; 100 where the file does not say."""
    digits = F.regexp_extract("content", r"mpc\.baseMVA\s*=\s*(\d+\.?\d*)", 1)
    return cases.select(
        "case_name",
        F.coalesce(digits.try_cast("double"), F.lit(DEFAULT_BASE_MVA)).alias("base_mva"),
    )


def _block(name: str, opening: str, closing: str) -> Column:
    pattern = rf"(?s)mpc\.{name}\s*=\s*{opening}(.*?){closing};"
    return F.regexp_extract("content", pattern, 1)


def trim_blanks(text: Column) -> Column:
    return F.trim(text, F.lit(_BLANKS))


def clean_line(line: Column) -> Column:
    without_comment = trim_blanks(F.substring_index(line, "%", 1))
    return trim_blanks(F.rtrim(without_comment, F.lit(";")))


def _lines(name: str) -> Column:
    """Non-empty cleaned lines of a matrix block, in file order."""
    lines = F.transform(F.split(_block(name, r"\[", r"\]"), "\n"), clean_line)
    return F.filter(lines, lambda line: line != "")


def numbers(line: Column) -> Column:
    return F.transform(F.split(line, r"\s+"), lambda token: token.try_cast("double"))


def all_numbers(values: Column) -> Column:
    return F.forall(values, lambda v: v.isNotNull())


def suffixed(line: Column) -> Column:
    """A number with a type letter, which a cast takes but a case file may not have."""
    return line.rlike(r"[\d.][dDfF](\s|$)")


def matrix_rows(cases: DataFrame, name: str) -> DataFrame:
    """``(case_name, row_no, values)`` of the block ``mpc.<name>``.

    A row with a token that is not a number is left out and does not count; see
    :func:`rejected_lines`. Rows may differ in length.
    """
    return _exploded(cases, _matrix(name), "values")


def _exploded(cases: DataFrame, rows: Column, output: str) -> DataFrame:
    """Array entries as rows. The outer form keeps Spark from computing the array
    a second time to filter empty ones beforehand."""
    exploded = cases.select("case_name", F.posexplode_outer(rows).alias("row_no", output))
    return exploded.filter(F.col("row_no").isNotNull())


def _matrix(name: str) -> Column:
    """Rows of numbers of a block, in file order."""
    plain = F.filter(_lines(name), lambda line: ~suffixed(line))
    return F.filter(F.transform(plain, numbers), all_numbers)


BLOCKS = ("bus", "gen", "branch", "gencost")


def stage_blocks(cases: DataFrame, path: str) -> None:
    """Parse all blocks in one pass over the texts and store them by block.

    Each text is cut and checked once however many tables are made of it.
    """
    no_values, no_label = F.lit(None).cast("array<double>"), F.lit(None).cast("string")

    def entry(block: str, row_no: Column, values: Column, label: Column) -> Column:
        return F.struct(
            F.lit(block).alias("block"),
            row_no.alias("row_no"),
            values.alias("values"),
            label.alias("label"),
        )

    def matrix(block: str) -> Column:
        return F.transform(_matrix(block), lambda v, i: entry(block, i, v, no_label))

    names = F.transform(_names(), lambda label, i: entry("bus_name", i, no_values, label))
    rows = F.concat(*[matrix(block) for block in BLOCKS], names)
    exploded = cases.select("case_name", F.inline_outer(rows))
    exploded.filter(F.col("block").isNotNull()).write.partitionBy("block").parquet(path)


def staged_rows(spark: SparkSession, path: str, name: str) -> DataFrame:
    """:func:`matrix_rows` of a staged block; other blocks are not read."""
    stored = _staged(spark, path).filter(F.col("block") == name)
    return stored.select("case_name", "row_no", "values")


def staged_names(spark: SparkSession, path: str) -> DataFrame:
    """:func:`bus_names` of staged texts."""
    stored = _staged(spark, path).filter(F.col("block") == "bus_name")
    return stored.select("case_name", "row_no", F.col("label").alias("bus_name"))


def _staged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "case_name string, row_no int, values array<double>, label string, block string"
    ).parquet(path)


def rejected_lines(cases: DataFrame, name: str) -> DataFrame:
    """``(case_name, line)`` for block lines that are not rows of numbers."""
    bad = F.filter(
        _lines(name), lambda line: suffixed(line) | ~all_numbers(numbers(line))
    )
    return _exploded(cases, bad, "line").drop("row_no")


def bus_names(cases: DataFrame) -> DataFrame:
    """``(case_name, row_no, bus_name)`` from the quoted name list."""
    return _exploded(cases, _names(), "bus_name")


def _names() -> Column:
    lines = F.transform(F.split(_block("bus_name", r"\{", r"\}"), "\n"), trim_blanks)
    quoted = F.filter(lines, lambda line: line.rlike("^'.*?'"))
    return F.transform(quoted, lambda line: F.regexp_extract(line, "'(.*?)'", 1))
