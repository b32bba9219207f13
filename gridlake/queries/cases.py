"""Case texts: parts are written as case files, read back and converted.

A thousand parts make one case; each part is a bus, a unit and a branch of it.
Even cases have the short bus and branch rows and no base MVA, odd cases the long
ones. The checking SQL states the expected components from the part table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import convert, documents, joins
from gridlake.operators.documents import to_system_document
from gridlake.plans.load_case import contingencies_of, matpower_components, staged
from gridlake.queries.registry import Tables, query, rounded
from gridlake.session import fresh_path
from gridlake.sources import case_text

CASE_ROWS = 1000
NAMED = 500
PRICED = 900

PARTS_SQL = f"""p AS (
  SELECT *, p_partkey // {CASE_ROWS} AS chunk,
         row_number() OVER (PARTITION BY p_partkey // {CASE_ROWS} ORDER BY p_partkey) - 1 AS pos,
         'case_' || lpad(CAST(p_partkey // {CASE_ROWS} AS VARCHAR), 6, '0') AS case_name,
         p_partkey // {CASE_ROWS} % 2 = 1 AS long
  FROM part)"""

BUS_SQL = f"""bus AS (
  SELECT case_name, pos AS row_no, p_partkey AS number,
         CASE WHEN pos < {NAMED} THEN 'BUS ' || p_partkey ELSE 'Bus' || p_partkey END AS name,
         CAST(p_size % 3 AS DOUBLE) AS Pd, CAST(p_size % 4 AS DOUBLE) AS Qd,
         CAST(chunk % 4 AS VARCHAR) AS area,
         CASE WHEN long THEN 230.0 ELSE 138.0 END AS base_voltage,
         CASE WHEN long THEN '2' ELSE '1' END AS zone,
         CASE WHEN long THEN 1.05 ELSE 1.1 END AS voltage_max,
         CASE WHEN long THEN 0.95 ELSE 0.9 END AS voltage_min
  FROM p)"""


def case_files(t: Tables) -> str:
    """Folder with one text per case, rendered from the part table."""
    key = F.col("p_partkey")
    case_no = F.floor(key / CASE_ROWS)
    long = case_no % 2 == 1
    pos = key % CASE_ROWS
    size = F.col("p_size")
    text = lambda *cols: F.concat_ws("  ", *[c.cast("string") for c in cols])
    lit = F.lit
    bus = F.concat(
        text(key, lit(1), size % 3, size % 4, lit(0), lit(0), case_no % 4, lit(1.0), lit(0)),
        F.when(long, lit("\t230 2 1.05 0.95")).otherwise(lit("")),
    )
    gen = text(
        key, lit(0), lit(0), lit(30), lit(-30), lit(1.0), lit(100), size % 2,
        F.col("p_retailprice"), size,
    )
    branch = F.concat(
        text(
            key, key + 1, lit(0.01), lit("1e-1"), lit(0.02), lit(100), lit(90), lit(80),
            F.when(size % 3 == 0, lit("0")).when(size % 3 == 1, lit("0.95")).otherwise(lit("1")),
            F.when(size % 5 == 0, lit("5")).otherwise(lit("0")), lit(1),
        ),
        F.when(long, lit(" -30 30")).otherwise(lit("")),
    )
    cost = (
        F.when(size % 4 == 0, text(lit(2), size, lit(7), lit(3), lit(0.5), lit(20), size))
        .when(size % 4 == 1, text(lit(2), size, lit(7), lit(2), lit(25), size))
        .when(size % 4 == 2, text(lit(2), size, lit(7), lit(4), lit(1), lit(2), lit(3), lit(4)))
        .otherwise(text(lit(1), size, lit(7), lit(2), lit(0), lit(0), lit(10), lit(300)))
    )
    # Lines the parser must drop: comments, a bad token, an inner semicolon.
    junk = F.when(size == 7, lit("\n% remark\n 1 2 x 4;\n 1 2; 3 4;\n")).otherwise(lit("\n"))

    def block(name: str, line, keep=None, opening="[", closing="]"):
        row = F.struct(key, F.concat(lit("\t"), line, lit("; % row"), junk))
        rows = F.collect_list(row if keep is None else F.when(keep, row))
        lines = F.transform(F.array_sort(rows), lambda r: r["col2"])
        return F.concat(
            lit(f"mpc.{name} = {opening}\n"), F.array_join(lines, ""), lit(f"{closing};\n")
        )

    rendered = t.part.groupBy(case_no.alias("case_no")).agg(
        block("bus", bus).alias("bus"),
        block("gen", gen).alias("gen"),
        block("branch", branch).alias("branch"),
        block("gencost", cost, pos < PRICED).alias("gencost"),
        block(
            "bus_name", F.concat(lit("'BUS "), key.cast("string"), lit("'")), pos < NAMED, "{", "}"
        ).alias("names"),
    )
    base = F.when(F.col("case_no") % 2 == 1, lit("mpc.baseMVA = 50.5;\n")).otherwise(lit(""))
    name = F.concat(lit("case_"), F.lpad(F.col("case_no").cast("string"), 6, "0"))
    path = fresh_path(t.spark, "cases")
    rendered.select(
        name.alias("case_name"),
        F.concat(lit("function mpc = x\n"), base, "bus", "gen", "branch", "gencost", "names").alias(
            "value"
        ),
    ).write.partitionBy("case_name").text(path)
    return path


def cases(t: Tables) -> DataFrame:
    return case_text.read_case_text(t.spark, case_files(t))


@query("case_base_mva", f"""
WITH {PARTS_SQL} SELECT DISTINCT case_name, CASE WHEN long THEN 50.5 ELSE 100.0 END::DOUBLE AS base_mva FROM p""")
def case_base_mva(t):
    return case_text.base_mva(cases(t))


@query("case_matrix_rows", f"""
WITH {PARTS_SQL}
SELECT case_name, CAST(pos AS INTEGER) AS row_no, CAST(CASE WHEN long THEN 13 ELSE 9 END AS INTEGER) AS width,
       CAST(p_partkey AS DOUBLE) AS first_value, CAST(p_size % 3 AS DOUBLE) AS third_value
FROM p""")
def case_matrix_rows(t):
    rows = case_text.matrix_rows(cases(t), "bus")
    return rows.select(
        "case_name", "row_no", F.size("values").alias("width"),
        F.get("values", F.lit(0)).alias("first_value"), F.get("values", F.lit(2)).alias("third_value"),
    )


@query("case_rejected_lines", f"""
WITH {PARTS_SQL}
SELECT case_name, line, count(*) AS lines
FROM (SELECT case_name, unnest(['1 2 x 4', '1 2; 3 4']) AS line FROM p WHERE p_size = 7) x GROUP BY 1, 2""")
def case_rejected_lines(t):
    bad = case_text.rejected_lines(cases(t), "branch")
    return bad.groupBy("case_name", "line").agg(F.count(F.lit(1)).alias("lines"))


@query("bus_names", f"""
WITH {PARTS_SQL}
SELECT case_name, CAST(pos AS INTEGER) AS row_no, 'BUS ' || p_partkey AS bus_name FROM p WHERE pos < {NAMED}""")
def bus_names(t):
    return case_text.bus_names(cases(t))


@query("case_buses", f"""
WITH {PARTS_SQL}, {BUS_SQL}
SELECT case_name, number, name, Pd, Qd, area, base_voltage::DOUBLE AS base_voltage, zone,
       voltage_max::DOUBLE AS voltage_max, voltage_min::DOUBLE AS voltage_min FROM bus""")
def case_buses(t):
    return matpower_components(cases(t))["buses"].select(
        "case_name", "number", "name", "Pd", "Qd", "area", "base_voltage", "zone",
        "voltage_max", "voltage_min",
    )


_COST = f"""cost AS (
  SELECT case_name, 'Gen' || (pos + 1) AS name, p_partkey AS bus_number,
    CASE WHEN pos < {NAMED} THEN 'BUS ' || p_partkey ELSE 'Bus' || p_partkey END AS bus_name,
    'THERMAL' AS type, CAST(p_size AS DOUBLE) AS pmin, p_retailprice AS pmax, p_retailprice * 0.5 AS ramp_up,
    CAST(p_size % 2 AS INTEGER) AS status,
    CASE WHEN pos >= {PRICED} THEN NULL WHEN p_size % 4 = 0 THEN 0.5 WHEN p_size % 4 = 1 THEN 0.0 END::DOUBLE AS cost_quadratic,
    CASE WHEN pos >= {PRICED} THEN 30.0 WHEN p_size % 4 = 0 THEN 20.0 WHEN p_size % 4 = 1 THEN 25.0 ELSE 30.0 END::DOUBLE AS cost_linear,
    CASE WHEN pos < {PRICED} AND p_size % 4 < 2 THEN p_size ELSE 0 END::DOUBLE AS cost_constant,
    CASE WHEN pos < {PRICED} THEN p_size ELSE 0 END::DOUBLE AS startup_cost,
    CASE WHEN pos < {PRICED} THEN 7 ELSE 0 END::DOUBLE AS shutdown_cost
  FROM p)"""


@query("case_generators", f"""
WITH {PARTS_SQL}, {_COST}
SELECT case_name, name, bus_number, bus_name, type, pmin, pmax, ramp_up, status FROM cost""")
def case_generators(t):
    return matpower_components(cases(t))["generators"].select(
        "case_name", "name", "bus_number", "bus_name", "type", "pmin", "pmax", "ramp_up", "status"
    )


@query("cost_curve", f"""
WITH {PARTS_SQL}, {_COST}
SELECT case_name, name, cost_quadratic, cost_linear, cost_constant, startup_cost, shutdown_cost FROM cost""")
def cost_curve(t):
    texts = cases(t)
    units = convert.matpower_generators(case_text.matrix_rows(texts, "gen"))
    priced = convert.cost_curve(units, case_text.matrix_rows(texts, "gencost"))
    return priced.select(
        "case_name", "name", "cost_quadratic", "cost_linear", "cost_constant",
        "startup_cost", "shutdown_cost",
    )


_BRANCH = f"""branch AS (
  SELECT p.case_name, 'Line' || (pos + 1) AS name, p_partkey AS from_bus, p_partkey + 1 AS to_bus,
    f.name AS from_bus_name, coalesce(b.name, 'Bus' || (p_partkey + 1)) AS to_bus_name,
    CASE WHEN p_size % 3 = 1 THEN 0.95 ELSE 1.0 END::DOUBLE AS ratio,
    CASE WHEN p_size % 5 = 0 THEN 5 ELSE 0 END::DOUBLE AS angle,
    CASE WHEN long THEN -30 ELSE -360 END::DOUBLE AS angle_min,
    CASE WHEN long THEN 30 ELSE 360 END::DOUBLE AS angle_max,
    CASE WHEN p_size % 3 = 1 OR p_size % 5 = 0 THEN 'transformer' ELSE 'line' END AS type
  FROM p JOIN bus f ON f.case_name = p.case_name AND f.number = p_partkey
  LEFT JOIN bus b ON b.case_name = p.case_name AND b.number = p_partkey + 1)"""


@query("case_branches", f"""
WITH {PARTS_SQL}, {BUS_SQL}, {_BRANCH}
SELECT * FROM branch""")
def case_branches(t):
    return matpower_components(cases(t))["branches"].select(
        "case_name", "name", "from_bus", "to_bus", "from_bus_name", "to_bus_name",
        "ratio", "angle", "angle_min", "angle_max", "type",
    )


@query("branch_class", f"""
WITH {PARTS_SQL}, {BUS_SQL}, {_BRANCH}
SELECT case_name, type, CASE WHEN ratio <> 1 THEN 'transformer' ELSE 'line' END AS type_by_ratio,
       count(*) AS branches FROM branch GROUP BY 1, 2, 3""")
def branch_class(t):
    rows = convert.matpower_branches(case_text.matrix_rows(cases(t), "branch"))
    by_ratio = convert.branch_class(F.col("ratio"))
    return rows.groupBy("case_name", "type", by_ratio.alias("type_by_ratio")).agg(
        F.count(F.lit(1)).alias("branches")
    )


@query("nonzero_loads", f"""
WITH {PARTS_SQL}, {BUS_SQL}
SELECT case_name, 'Load_' || name AS name, number AS bus_number, name AS bus_name,
       Pd AS active_power, Qd AS reactive_power FROM bus WHERE Pd > 0 OR Qd > 0""")
def nonzero_loads(t):
    return matpower_components(cases(t))["loads"]


@query("case_statistics", f"""
WITH {PARTS_SQL}, {BUS_SQL}
SELECT case_name, count(*) AS num_buses, count(*) AS num_generators, count(*) AS num_branches,
  CAST(sum(CASE WHEN p_size % 3 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_loads,
  CAST(sum(CASE WHEN p_size % 3 > 0 OR p_size % 4 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_load_elements,
  CAST(sum(p_size % 3) AS DOUBLE) AS total_load_mw, round(sum(p_retailprice), 4) AS total_capacity_mw
FROM p GROUP BY 1""")
def case_statistics(t):
    c = matpower_components(cases(t))
    stats = convert.case_statistics(c["buses"], c["generators"], c["branches"])
    return rounded(stats, "total_capacity_mw")


def _topology(t: Tables) -> DataFrame:
    """Stored topology rows."""
    texts = cases(t)
    path = fresh_path(t.spark, "topology")
    document = to_system_document(
        staged(matpower_components(texts)), case_text.base_mva(texts), "MATPOWER"
    )
    document.write.parquet(path)
    return t.spark.read.parquet(path)


@query("system_document", f"""
WITH {PARTS_SQL}
SELECT case_name, count(*) AS num_buses, count(*) AS num_generators, count(*) AS num_branches,
  CAST(sum(CASE WHEN p_size % 3 > 0 OR p_size % 4 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_loads,
  CASE WHEN bool_or(long) THEN 50.5 ELSE 100.0 END::DOUBLE AS base_mva
FROM p GROUP BY 1""")
def system_document(t):
    return (
        _topology(t)
        .select("case_name", "num_buses", "num_generators", "num_branches", "num_loads", "base_mva")
        .distinct()
    )


@query("component_counts", f"""
WITH {PARTS_SQL}
SELECT case_name, count(*) AS num_buses, count(*) AS num_generators, count(*) AS num_branches,
  CAST(sum(CASE WHEN p_size % 3 > 0 OR p_size % 4 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_loads
FROM p GROUP BY 1""")
def component_counts(t):
    return documents.component_counts(_topology(t))


@query("document_buses", f"""
WITH {PARTS_SQL}, {BUS_SQL}
SELECT case_name, number, name, base_voltage::DOUBLE AS base_voltage, 0.0::DOUBLE AS angle,
  1.0::DOUBLE AS voltage_magnitude, voltage_min::DOUBLE AS voltage_min, voltage_max::DOUBLE AS voltage_max,
  area, zone FROM bus""")
def document_buses(t):
    return documents.document_buses(_topology(t))


@query("document_generators", f"""
WITH {PARTS_SQL}, {_COST}
SELECT case_name, name, bus_name, status <> 0 AS status, pmin, pmax, -30.0::DOUBLE AS qmin, ramp_up,
       cost_linear, cost_constant AS cost_fixed, startup_cost FROM cost""")
def document_generators(t):
    return documents.document_generators(_topology(t)).select(
        "case_name", "name", "bus_name", "status", "pmin", "pmax", "qmin", "ramp_up",
        "cost_linear", "cost_fixed", "startup_cost",
    )


@query("document_branches", f"""
WITH {PARTS_SQL}, {BUS_SQL}, {_BRANCH}
SELECT case_name, name, from_bus_name, to_bus_name, TRUE AS available, 0.01::DOUBLE AS shunt_from,
       0.01::DOUBLE AS shunt_to, 100.0::DOUBLE AS rating, angle_min, angle_max FROM branch""")
def document_branches(t):
    return documents.document_branches(_topology(t)).select(
        "case_name", "name", "from_bus_name", "to_bus_name", "available", "shunt_from", "shunt_to",
        "rating", "angle_min", "angle_max",
    )


@query("document_loads", f"""
WITH {PARTS_SQL}, {BUS_SQL}
SELECT case_name, 'Load_' || name AS name, name AS bus_name, Pd AS active_power,
       round(Pd * 1.2, 6) AS max_active_power, round(Qd * 1.2, 6) AS max_reactive_power
FROM bus WHERE Pd > 0 OR Qd > 0""")
def document_loads(t):
    loads = documents.document_loads(_topology(t)).select(
        "case_name", "name", "bus_name", "active_power", "max_active_power", "max_reactive_power"
    )
    return rounded(loads, "max_active_power", "max_reactive_power", digits=6)


@query("topology_checks", f"""
WITH {PARTS_SQL}
SELECT case_name, count(*) AS actual_buses,
       count(*) + CASE WHEN bool_or(long) THEN 1 ELSE 0 END AS declared_buses,
       NOT bool_or(long) AS counts_match, bool_or(p_size = 49) AS generator_field_missing,
       NOT bool_or(long) AND NOT bool_or(p_size = 49) AS success,
       count(*) * 2 AS contingencies
FROM p GROUP BY 1""")
def topology_checks(t):
    """Odd cases declare one bus too many; units of size 49 lose a required key."""
    texts = cases(t)
    components = staged(matpower_components(texts))
    found = contingencies_of(components)
    broken = F.col("pmin") == 49
    components["generators"] = components["generators"].withColumn(
        "bus_number", F.when(~broken, F.col("bus_number"))
    )
    odd = F.col("case_name").substr(-1, 1).cast("int") % 2
    document = to_system_document(components, case_text.base_mva(texts))
    document = document.withColumn("num_buses", F.col("num_buses") + odd)
    report = documents.topology_checks(document, found)
    return report.select(
        "case_name", "actual_buses", "declared_buses", "counts_match",
        "generator_field_missing", "success", "contingencies",
    )


@query("dangling_refs", f"""
WITH {PARTS_SQL}
SELECT case_name, 'Line' || (pos + 1) AS name, p_partkey + 1 AS to_bus FROM p
WHERE p_partkey + 1 NOT IN (SELECT p_partkey FROM part)""")
def dangling_refs(t):
    """Branch ends that are no bus of any case."""
    c = matpower_components(cases(t))
    return joins.dangling(c["branches"], c["buses"], "to_bus", "number").select(
        "case_name", "name", "to_bus"
    )


@query("case_contingencies", f"""
WITH {PARTS_SQL}
SELECT case_name, 'N-1' AS contingency_type, severity_level, count(*) AS contingencies,
       CAST(round(sum(probability), 4) AS DOUBLE) AS expected
FROM (SELECT case_name, 2 AS severity_level, 0.01 AS probability FROM p
      UNION ALL SELECT case_name, 3, 0.005 FROM p WHERE p_retailprice > 950) x GROUP BY 1, 3""")
def case_contingencies(t):
    c = matpower_components(cases(t))
    found = contingencies_of(c, min_pmax=950.0)
    names = c["buses"].select("case_name").distinct().withColumn(
        "topology_id", F.xxhash64("case_name")
    )
    per = found.groupBy("topology_id", "contingency_type", "severity_level").agg(
        F.count(F.lit(1)).alias("contingencies"), F.round(F.sum("probability"), 4).alias("expected")
    )
    return per.join(names, "topology_id").drop("topology_id")


@query("bus_lookup", """
SELECT s_suppkey, s_nationkey, coalesce(n_name, 'Bus' || s_nationkey) AS bus_name
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON s_nationkey = n_nationkey""")
def bus_lookup(t):
    """Nations of three regions are the known buses."""
    buses = t.nation.filter("n_regionkey < 3").select(
        F.lit("C").alias("case_name"), F.col("n_nationkey").alias("number"), F.col("n_name").alias("name")
    )
    rows = t.supplier.select(F.lit("C").alias("case_name"), "s_suppkey", "s_nationkey")
    return joins.lookup_bus(rows, buses, "s_nationkey", "bus_name", spread=4).drop("case_name")


@query("missing_components", """
SELECT l_suppkey AS supplier_id, count(*) AS rows FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) GROUP BY 1""")
def missing_components(t):
    """Suppliers in debt are taken as unknown."""
    series = t.lineitem.select(F.col("l_suppkey").alias("supplier_id"))
    return joins.missing_components(
        series, t.supplier.filter("s_acctbal >= 0"), "supplier_id", "s_suppkey"
    )


@query("attach_series", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, s_name FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal >= 0""")
def attach_series(t):
    series = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity"
    )
    known = t.supplier.filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return joins.attach_series(series, known, ["l_suppkey"])


@query("new_cases", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')""")
def new_cases(t):
    """Customers without an order since 2001."""
    loaded = t.orders.filter(
        F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit("2001-01-01 00:00:00"))
    ).select(F.col("o_custkey").alias("c_custkey"))
    return joins.new_cases(t.customer.select("c_custkey", "c_name"), loaded, "c_custkey")
