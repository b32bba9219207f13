"""Case texts of any size, read line by line: one file is shared among many tasks.

Same results as :mod:`gridlake.sources.case_text`, which holds a text in one row. Here Spark
cuts a file into splits, and a block may begin in one and end in another. A first pass leaves
one row per split (its first opening of each block, its first closing brackets); from these
rows follows which part of which split lies in a block. The lines are then cut, checked and
numbered within their split, and the number of rows of earlier splits is carried over.

An opening, ``mpc.bus = [``, must stand on one line; :func:`broken_openings` lists the texts
where a line ends before the bracket, which :mod:`case_text` reads. Empty files have no lines
and so no rows. Two files of one case name are kept apart, as there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators.ordered import stage, with_position
from gridlake.sources import case_text

NAMES_BLOCK = "bus_name"
_CLOSING = {"[": "];", "{": "};"}


def read_case_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(file, case_name, split, line_id, line)``; ``line_id`` grows within a split.

    Lines end at a line feed only, so that one file gives the same lines as its whole text.
    """
    read = spark.read.option("lineSep", "\n").text(path)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    name = F.col("case_name").cast("string") if "case_name" in read.columns else stem
    return read.select(
        F.col("_metadata.file_path").alias("file"),
        name.alias("case_name"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )


def broken_openings(lines: DataFrame) -> DataFrame:
    """``(file, case_name)`` of texts with a line that ends within an assignment's head."""
    broken = F.col("line").rlike(r"mpc\.\w+\s*(=\s*)?$")
    return lines.filter(broken).select("file", "case_name").distinct()


def base_mva(lines: DataFrame) -> DataFrame:
    """``(case_name, base_mva)``, one row per file; 100 where the file does not say."""
    digits = F.regexp_extract("line", r"mpc\.baseMVA\s*=\s*(\d+\.?\d*)", 1)
    found = F.when(digits != "", F.struct("split", "line_id", digits.alias("digits")))
    first = lines.groupBy("file", "case_name").agg(F.min(found).alias("first"))
    value = F.col("first.digits").try_cast("double")
    return first.select("case_name", F.coalesce(value, F.lit(case_text.DEFAULT_BASE_MVA)).alias("base_mva"))


def _bracket(block: str) -> str:
    return "{" if block == NAMES_BLOCK else "["


def _closing(block: str) -> str:
    return _CLOSING[_bracket(block)]


def _opening(block: str) -> str:
    return rf"mpc\.{block}\s*=\s*\{_bracket(block)}"


def _first(condition: Column, *more: Column) -> Column:
    return F.min(F.when(condition, F.struct("line_id", *more)))


def _split_summary(lines: DataFrame, blocks: Sequence[str]) -> DataFrame:
    """One row per split and block: the first opening with the text after it, the first closing."""
    heads = {f"_head_{b}": F.regexp_substr("line", F.lit(_opening(b))) for b in blocks}
    found = []
    for block in blocks:
        head = f"_head_{block}"
        after = F.expr(f"substring(line, instr(line, {head}) + length({head}))")
        found += [
            _first(F.col(head).isNotNull(), after.alias("after")).alias(f"opened_{block}"),
            _first(F.contains("line", F.lit(_closing(block)))).alias(f"closed_{block}"),
        ]
    entries = [
        F.struct(
            F.lit(block).alias("block"),
            F.lit(_closing(block)).alias("closing"),
            F.col(f"opened_{block}").alias("opened"),
            F.col(f"closed_{block}.line_id").alias("closed_id"),
        )
        for block in blocks
    ]
    per_split = lines.withColumns(heads).groupBy("file", "case_name", "split").agg(*found)
    return per_split.select("file", "case_name", "split", F.inline(F.array(*entries)))


def block_ranges(lines: DataFrame, blocks: Sequence[str]) -> DataFrame:
    """The part of each split that lies in a block.

    ``(file, block, split, closing, head_id, after, end_id)``: lines from ``head_id`` to
    ``end_id``, each null where the block goes on beyond the split; ``after`` is what the first
    line holds behind the opening. A block goes from its first opening in the file to the first
    closing behind it; without one it has no lines.
    """
    summary = stage(_split_summary(lines, blocks), "case_splits")
    keys = ["file", "block"]
    opening = (
        summary.filter("opened IS NOT NULL")
        .groupBy(*keys, "closing")
        .agg(F.min(F.struct("split", F.col("opened.line_id").alias("id"), "opened.after")).alias("o"))
        .select(*keys, "closing", F.col("o.split").alias("head_split"), F.col("o.id").alias("head_id"), "o.after")
    )
    # The first closing of the opening's own split may lie before the opening, so that one
    # split is looked through again; of the later splits the summary rows are enough.
    here = lines.select("file", F.col("split").alias("head_split"), "line_id", "line").filter(
        F.contains("line", F.lit("];")) | F.contains("line", F.lit("};"))
    )
    own = (
        here.join(opening, ["file", "head_split"])
        .filter((F.col("line_id") > F.col("head_id")) & F.contains("line", F.col("closing")))
        .groupBy(*keys)
        .agg(F.min(F.struct(F.col("head_split").alias("split"), F.col("line_id").alias("id"))).alias("close"))
    )
    later = (
        summary.filter("closed_id IS NOT NULL")
        .join(opening.select(*keys, "head_split"), keys)
        .filter("split > head_split")
        .groupBy(*keys)
        .agg(F.min(F.struct("split", F.col("closed_id").alias("id"))).alias("close"))
    )
    same = opening.filter(F.contains("after", F.col("closing"))).select(
        *keys, F.struct(F.col("head_split").alias("split"), F.col("head_id").alias("id")).alias("close")
    )
    # The least one is the nearest: all of them lie behind the opening.
    ends = own.unionByName(later).unionByName(same).groupBy(*keys).agg(F.min("close").alias("close"))
    ranges = (
        summary.select(*keys, "split")
        .join(opening.join(ends, keys), keys)
        .filter("split BETWEEN head_split AND close.split")
    )
    is_head = F.col("split") == F.col("head_split")
    return stage(
        ranges.select(
            *keys, "split", "closing",
            F.when(is_head, F.col("head_id")).alias("head_id"),
            F.when(is_head, F.col("after")).alias("after"),
            F.when(F.col("split") == F.col("close.split"), F.col("close.id")).alias("end_id"),
        ),
        "case_ranges",
    )


def block_lines(lines: DataFrame, blocks: Sequence[str]) -> DataFrame:
    """``(file, case_name, block, split, line_id, line)``: the raw lines inside the blocks."""
    at = F.col("line_id")
    inside = F.coalesce(at >= F.col("head_id"), F.lit(True)) & F.coalesce(at <= F.col("end_id"), F.lit(True))
    found = lines.join(block_ranges(lines, blocks), ["file", "split"]).filter(inside)
    text = F.when(at == F.col("head_id"), F.col("after")).otherwise(F.col("line"))
    cut = F.when(at == F.col("end_id"), F.expr("substring_index(_text, closing, 1)")).otherwise(F.col("_text"))
    return found.withColumn("_text", text).select(
        "file", "case_name", "block", "split", "line_id", cut.alias("line")
    )


def _checked(lines: DataFrame, blocks: Sequence[str]) -> DataFrame:
    """Non-empty cleaned lines; ``values`` is null where a line is no row of numbers."""
    cleaned = block_lines(lines, blocks).withColumn("line", case_text.clean_line(F.col("line")))
    numbers = case_text.numbers(F.col("line"))
    good = ~case_text.suffixed(F.col("line")) & case_text.all_numbers(numbers)
    return cleaned.filter("line != ''").withColumn("values", F.when(good, numbers))


def _labels(lines: DataFrame) -> DataFrame:
    quoted = block_lines(lines, [NAMES_BLOCK]).withColumn("line", case_text.trim_blanks(F.col("line")))
    return quoted.filter(F.col("line").rlike("^'.*?'")).withColumn(
        "label", F.regexp_extract("line", "'(.*?)'", 1)
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """``row_no`` by file and block; the rows are staged, so the texts are not read again for
    the counts that are carried from split to split."""
    kept = stage(rows, "case_rows")
    placed = with_position(kept, ["file", "block"], ["line_id"], F.col("split"), "row_no")
    return placed.withColumn("row_no", F.col("row_no").cast("int"))


def matrix_rows(lines: DataFrame, name: str) -> DataFrame:
    """:func:`case_text.matrix_rows`, from lines."""
    rows = _checked(lines, [name]).filter("values IS NOT NULL")
    return _numbered(rows.drop("line")).select("case_name", "row_no", "values")


def rejected_lines(lines: DataFrame, name: str) -> DataFrame:
    """:func:`case_text.rejected_lines`, from lines."""
    return _checked(lines, [name]).filter("values IS NULL").select("case_name", "line")


def bus_names(lines: DataFrame) -> DataFrame:
    """:func:`case_text.bus_names`, from lines."""
    named = _numbered(_labels(lines).drop("line"))
    return named.select("case_name", "row_no", F.col("label").alias("bus_name"))


def stage_blocks(lines: DataFrame, path: str) -> None:
    """:func:`case_text.stage_blocks` from lines: the same table, read by the same functions."""
    raw = block_lines(lines, [*case_text.BLOCKS, NAMES_BLOCK])
    is_name = F.col("block") == NAMES_BLOCK
    text = F.when(is_name, case_text.trim_blanks(F.col("line"))).otherwise(case_text.clean_line(F.col("line")))
    numbers = case_text.numbers(F.col("line"))
    good = ~case_text.suffixed(F.col("line")) & case_text.all_numbers(numbers)
    rows = (
        raw.withColumn("line", text)
        .filter("line != ''")
        .withColumn("values", F.when(~is_name & good, numbers))
        .withColumn("label", F.when(is_name & F.col("line").rlike("^'.*?'"), F.regexp_extract("line", "'(.*?)'", 1)))
        .filter("values IS NOT NULL OR label IS NOT NULL")
    )
    numbered = _numbered(rows.drop("line"))
    numbered.select("case_name", "row_no", "values", "label", "block").write.partitionBy("block").parquet(path)
