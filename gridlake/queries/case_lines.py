"""Large case texts: order lines are written as case files, then read line by line.

The suppliers of a run of 25 make one case; a line of theirs is a row of the block ``bus`` or
``gen``. Texts grow with the lines per supplier, their number with the suppliers. The checking
SQL states the rows from the order lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.queries.registry import Tables, query
from gridlake.session import fresh_path
from gridlake.sources import case_lines

LINES_SQL = """ln AS (
  SELECT 'case_' || lpad(CAST(l_suppkey // 25 AS VARCHAR), 9, '0') AS case_name, l_orderkey, l_linenumber,
         l_quantity, l_quantity > 20 AS bus, l_linenumber = 2 AND l_quantity > 45 AS bad
  FROM lineitem)"""


def case_files(t: Tables) -> str:
    """Folder with one text per case. A text is one file, so one task sorts and writes it, with
    spilling and never as one value."""
    line = t.lineitem.select(
        F.concat(F.lit("case_"), F.lpad(F.floor(F.col("l_suppkey") / 25).cast("string"), 9, "0")).alias("case_name"),
        "l_orderkey", "l_linenumber", "l_quantity",
        (F.col("l_quantity") > 20).alias("bus"),
        ((F.col("l_linenumber") == 2) & (F.col("l_quantity") > 45)).alias("bad"),
    )
    key, number = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    second = F.when(F.col("bad"), F.concat(F.lit("n"), number)).otherwise(number)
    text = F.concat(
        F.lit("\t"), key, F.lit("  "), second, F.lit(" "), F.col("l_quantity").cast("string"), F.lit("; % of an order"),
        F.when(F.col("l_linenumber") == 3, F.lit("\n%% 1 2 3 ]\n\n")).otherwise(F.lit("")),
    )
    rows = line.select(
        "case_name", F.when(F.col("bus"), 2).otherwise(5).alias("part"), "l_orderkey", "l_linenumber", "l_quantity",
        text.alias("value"),
    )
    names = line.filter("l_linenumber = 1").select(
        "case_name", F.lit(8).alias("part"), "l_orderkey", "l_linenumber", "l_quantity",
        F.concat(F.lit("  'Order "), key, F.lit("';")).alias("value"),
    )
    frame = F.array(*[
        F.struct(F.lit(part).alias("part"), F.lit(value).alias("value"))
        for part, value in (
            (0, "function mpc = x\nmpc.baseMVA = 50.5;\nmpc.other = [ 1 2 ];"),
            (1, "mpc.bus = ["), (3, "];"), (4, "mpc.gen\t=  [ 0 0 0.5"), (6, "\t9 9 9.5 ]; % end"),
            (7, "mpc.bus_name = {"), (9, "};"),
        )
    ])
    none = F.lit(None).cast("bigint")
    around = line.select("case_name").distinct().select("case_name", F.inline(frame)).select(
        "case_name", "part", none.alias("l_orderkey"), none.cast("int").alias("l_linenumber"),
        none.cast("double").alias("l_quantity"), "value"
    )
    path = fresh_path(t.spark, "case_lines")
    (
        rows.unionByName(names).unionByName(around)
        .repartition("case_name")
        .sortWithinPartitions("case_name", "part", "l_orderkey", "l_linenumber", "l_quantity")
        .select("case_name", "value")
        .write.partitionBy("case_name")
        .text(path)
    )
    return path


def lines(t: Tables) -> DataFrame:
    return case_lines.read_case_lines(t.spark, case_files(t))


@query("case_line_rows", f"""
WITH {LINES_SQL}
SELECT case_name, CAST(row_number() OVER (PARTITION BY case_name ORDER BY l_orderkey, l_linenumber, l_quantity) - 1 AS INTEGER) AS row_no,
       CAST(l_orderkey AS DOUBLE) AS order_id, CAST(l_linenumber AS DOUBLE) AS line_no, CAST(l_quantity AS DOUBLE) AS quantity
FROM ln WHERE bus AND NOT bad""")
def case_line_rows(t):
    return _three(case_lines.matrix_rows(lines(t), "bus"))


@query("case_line_edges", f"""
WITH {LINES_SQL}
SELECT case_name, count(*) + 2 AS rows, CAST(count(*) + 1 AS INTEGER) AS last_row, 0.5::DOUBLE AS first_quantity, 9.5::DOUBLE AS last_quantity
FROM ln WHERE NOT bus GROUP BY 1
UNION ALL SELECT case_name, 2, 1, 0.5, 9.5 FROM ln GROUP BY 1 HAVING bool_and(bus)""")
def case_line_edges(t):
    """Rows that stand on the line of an opening or a closing bracket."""
    rows = _three(case_lines.matrix_rows(lines(t), "gen"))
    return rows.groupBy("case_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("row_no").alias("last_row"),
        F.min_by("quantity", "row_no").alias("first_quantity"),
        F.max_by("quantity", "row_no").alias("last_quantity"),
    )


def _three(rows: DataFrame) -> DataFrame:
    value = lambda i: F.get("values", F.lit(i))
    return rows.select(
        "case_name", "row_no", value(0).alias("order_id"), value(1).alias("line_no"), value(2).alias("quantity")
    )


@query("case_line_rejected", f"""
WITH {LINES_SQL}
SELECT case_name, count(*) AS lines, count(DISTINCT l_orderkey || ' ' || l_quantity) AS different
FROM ln WHERE bad GROUP BY 1""")
def case_line_rejected(t):
    bad = case_lines.rejected_lines(lines(t), "bus")
    return bad.groupBy("case_name").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("line").alias("different")
    )


@query("case_line_names", f"""
WITH {LINES_SQL}
SELECT case_name, CAST(row_number() OVER (PARTITION BY case_name ORDER BY l_orderkey) - 1 AS INTEGER) AS row_no,
       'Order ' || l_orderkey AS bus_name
FROM ln WHERE l_linenumber = 1""")
def case_line_names(t):
    return case_lines.bus_names(lines(t))
