"""Allocation model audits; lineitem gives the solution tables.

The index columns are feedstock = return flag, source = supplier, county = part,
tech = line status, basin = line number, year = ship year. Sparse parameters are
means over some of the line items, so that keys are missing from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import solution as so
from gridlake.queries.registry import Tables, query, rounded


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_returnflag").alias("feedstock"),
        F.col("l_suppkey").alias("source"),
        F.col("l_partkey").alias("county"),
        F.col("l_linestatus").alias("tech"),
        F.col("l_linenumber").alias("basin"),
        F.year("l_shipdate").alias("year"),
        F.col("l_quantity").alias("amount"),
        "l_tax",
        "l_discount",
    )


LINES_SQL = """ln AS (
  SELECT l_returnflag AS feedstock, l_suppkey AS source, l_partkey AS county, l_linestatus AS tech,
         l_linenumber AS basin, CAST(year(l_shipdate) AS INTEGER) AS year, l_quantity AS amount, l_tax, l_discount
  FROM lineitem)"""


def _parameter(lines: DataFrame, keys: list[str], value, keep=None) -> DataFrame:
    rows = lines if keep is None else lines.filter(keep)
    return rows.groupBy(*keys).agg(F.avg(value).alias("value"))


@query("lp_objective", f"""
WITH {LINES_SQL},
fp AS (SELECT feedstock, source, year, avg(l_tax * 100) AS v FROM ln WHERE l_tax > 0.02 GROUP BY 1, 2, 3),
td AS (SELECT source, county, avg(l_tax * 1000) AS v FROM ln WHERE l_tax > 0.02 GROUP BY 1, 2),
cd AS (SELECT county, basin, avg(l_discount * 100) AS v FROM ln WHERE l_discount > 0.02 GROUP BY 1, 2),
terms AS (
  SELECT 'feedstock' AS term, sum(coalesce(v, 1000) * amount) AS cost
    FROM ln LEFT JOIN fp USING (feedstock, source, year)
  UNION ALL SELECT 'feedstock_transport', sum(0.163 * coalesce(v, 1000) * amount)
    FROM ln LEFT JOIN td USING (source, county)
  UNION ALL SELECT 'co2_transport', sum(coalesce(v, 1000) * (year - 1990) * amount)
    FROM ln LEFT JOIN cd USING (county, basin)
  UNION ALL SELECT 'injection', sum(basin * 10 * amount) FROM ln)
SELECT term, round(cost, 0) AS cost FROM terms
UNION ALL SELECT 'total', round(sum(cost), 0) FROM terms""")
def lp_objective(t):
    ln = _lines(t)
    terms = so.objective_terms(
        x=ln, y=ln, z=ln,
        feedstock_price=_parameter(
            ln, ["feedstock", "source", "year"], F.col("l_tax") * 100, F.col("l_tax") > 0.02
        ),
        feedstock_distance=_parameter(
            ln, ["source", "county"], F.col("l_tax") * 1000, F.col("l_tax") > 0.02
        ),
        co2_distance=_parameter(
            ln, ["county", "basin"], F.col("l_discount") * 100, F.col("l_discount") > 0.02
        ),
        co2_price=ln.groupBy("year").agg(F.max(F.col("year") - 1990).cast("double").alias("value")),
        injection_price=ln.groupBy("basin").agg(
            F.max(F.col("basin") * 10).cast("double").alias("value")
        ),
    )
    return rounded(terms, "cost", digits=0)


@query("lp_densify", """
WITH grid AS (
  SELECT s_suppkey AS source, basin, feedstock FROM supplier,
    (SELECT DISTINCT l_linenumber AS basin FROM lineitem) b,
    (SELECT DISTINCT l_returnflag AS feedstock FROM lineitem) f),
used AS (SELECT l_suppkey AS source, l_linenumber AS basin, l_returnflag AS feedstock,
         sum(l_quantity) AS amount FROM lineitem WHERE l_discount > 0.08 GROUP BY 1, 2, 3)
SELECT source, basin, feedstock, coalesce(amount, -1) AS amount FROM grid LEFT JOIN used USING (source, basin, feedstock)""")
def lp_densify(t):
    """Every supplier, line number and flag, with -1 where nothing was used."""
    ln = _lines(t)
    axes = {
        "source": t.supplier.select(F.col("s_suppkey").alias("source")),
        "basin": ln.select("basin").distinct(),
        "feedstock": ln.select("feedstock").distinct(),
    }
    used = ln.filter(F.col("l_discount") > 0.08).groupBy(*axes).agg(F.sum("amount").alias("amount"))
    return so.densify(axes, used, "amount", -1.0)


def _price_cells(t):
    """Unit prices per supplier, line number and flag, known for some of them."""
    ln = _lines(t)
    axes = {
        "source": t.supplier.select(F.col("s_suppkey").alias("source")),
        "basin": ln.select("basin").distinct(),
        "feedstock": ln.select("feedstock").distinct(),
    }
    known = ln.filter(F.col("l_discount") > 0.08).groupBy(*axes).agg(F.sum("amount").alias("amount"))
    return axes, known


DENSE_SQL = """
WITH grid AS (
  SELECT s_suppkey AS source, basin, feedstock FROM supplier,
    (SELECT DISTINCT l_linenumber AS basin FROM lineitem) b,
    (SELECT DISTINCT l_returnflag AS feedstock FROM lineitem) f),
known AS (SELECT l_suppkey AS source, l_linenumber AS basin, l_returnflag AS feedstock,
          sum(l_quantity) AS amount FROM lineitem WHERE l_discount > 0.08 GROUP BY 1, 2, 3),
dense AS (SELECT source, basin, feedstock, amount IS NOT NULL AS is_stored, coalesce(amount, 1000.0) AS v
          FROM grid LEFT JOIN known USING (source, basin, feedstock))
SELECT {key} count(*) AS cells, count(*) FILTER (WHERE is_stored) AS stored, round(sum(v), 4) AS total,
       round(avg(v), 6) AS mean, min(v) AS low, max(v) AS high FROM dense {group}"""


@query("lp_dense_totals", DENSE_SQL.format(key="source,", group="GROUP BY source"))
def lp_dense_totals(t):
    """Default-filled prices per supplier, without the combinations."""
    axes, known = _price_cells(t)
    found = so.dense_totals(axes, known, "amount", so.PRICE_DEFAULT, by="source")
    return rounded(rounded(found, "total"), "mean", digits=6)


@query("lp_dense_total", DENSE_SQL.format(key="", group=""))
def lp_dense_total(t):
    axes, known = _price_cells(t)
    found = so.dense_totals(axes, known, "amount", so.PRICE_DEFAULT)
    return rounded(rounded(found, "total"), "mean", digits=6)


@query("lp_balance", """
SELECT coalesce(o_orderkey, l_orderkey) AS order_key, round(coalesce(p, 0), 4) AS left_total,
  round(coalesce(o_totalprice, 0), 4) AS right_total,
  round(coalesce(p, 0) - coalesce(o_totalprice, 0), 4) AS residual,
  abs(coalesce(p, 0) - coalesce(o_totalprice, 0)) > 1000 AS violated
FROM orders FULL OUTER JOIN (SELECT l_orderkey, sum(l_extendedprice) AS p FROM lineitem GROUP BY 1) l
  ON l_orderkey = o_orderkey""")
def lp_balance(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_key"), F.col("l_extendedprice").alias("amount"))
    totals = t.orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("amount"))
    audit = so.balance(lines, totals, ["order_key"], tolerance=1000.0)
    return rounded(audit, "left_total", "right_total", "residual")


@query("lp_energy_audit", f"""
WITH {LINES_SQL}, made AS (
  SELECT tech, p_brand AS region, year, sum(amount) AS a FROM ln JOIN part ON county = p_partkey GROUP BY 1, 2, 3),
need AS (
  SELECT tech, p_brand AS region, year, sum(amount) AS b FROM ln JOIN part ON county = p_partkey
  WHERE l_discount > 0 GROUP BY 1, 2, 3)
SELECT tech, region, year, coalesce(a, 0) AS left_total, coalesce(b, 0) AS right_total,
  coalesce(a, 0) - coalesce(b, 0) AS residual, abs(coalesce(a, 0) - coalesce(b, 0)) > 1e-6 AS violated
FROM made FULL OUTER JOIN need USING (tech, region, year)""")
def lp_energy_audit(t):
    ln = _lines(t)
    mapping = t.part.select(F.col("p_partkey").alias("county"), F.col("p_brand").alias("region"))
    demand = so.to_region(ln.filter(F.col("l_discount") > 0), mapping)
    return so.energy_audit(ln, demand, mapping)


@query("lp_feedstock_audit", f"""
WITH {LINES_SQL}, l AS (SELECT county, year, sum(amount) AS a FROM ln GROUP BY 1, 2),
r AS (SELECT county, year, sum(CASE WHEN tech = 'F' THEN 2 ELSE 0.5 END * amount) AS b FROM ln GROUP BY 1, 2)
SELECT county, year, a AS left_total, b AS right_total, a - b AS residual, abs(a - b) > 1e-6 AS violated
FROM l JOIN r USING (county, year)""")
def lp_feedstock_audit(t):
    ln = _lines(t)
    return so.feedstock_audit(ln, ln, _factor(ln))


def _factor(ln: DataFrame) -> DataFrame:
    return ln.groupBy("tech").agg(
        F.max(F.when(F.col("tech") == "F", 2.0).otherwise(0.5)).alias("value")
    )


@query("lp_potential_audit", f"""
WITH {LINES_SQL}, u AS (SELECT feedstock, source, year, sum(amount) AS used FROM ln GROUP BY 1, 2, 3),
c AS (SELECT feedstock, source, year, sum(amount) * 1.5 AS capacity FROM ln WHERE l_tax > 0.02 GROUP BY 1, 2, 3)
SELECT feedstock, source, year, used, coalesce(capacity, 0) AS capacity,
  used > coalesce(capacity, 0) + 1e-6 AS violated FROM u LEFT JOIN c USING (feedstock, source, year)""")
def lp_potential_audit(t):
    ln = _lines(t)
    limit = ln.filter(F.col("l_tax") > 0.02).groupBy("feedstock", "source", "year").agg(
        (F.sum("amount") * 1.5).alias("capacity")
    )
    return so.potential_audit(ln, limit)


@query("lp_basin_audit", f"""
WITH {LINES_SQL}, u AS (SELECT basin, sum(amount) AS used FROM ln GROUP BY 1),
c AS (SELECT basin, sum(l_tax) * 600 AS capacity FROM ln GROUP BY 1)
SELECT basin, used, round(capacity, 4) AS capacity, used > capacity + 1e-6 AS violated FROM u JOIN c USING (basin)""")
def lp_basin_audit(t):
    ln = _lines(t)
    limit = ln.groupBy("basin").agg((F.sum("l_tax") * 600).alias("capacity"))
    return rounded(so.basin_audit(ln, limit), "capacity")


@query("lp_pipeline_audit", f"""
WITH {LINES_SQL}
SELECT county, basin, year, sum(amount) AS used, 60.0::DOUBLE AS capacity, sum(amount) > 60 + 1e-6 AS violated
FROM ln GROUP BY 1, 2, 3""")
def lp_pipeline_audit(t):
    return so.pipeline_audit(_lines(t), 60.0)


@query("lp_transport_audit", f"""
WITH {LINES_SQL}, l AS (SELECT tech, county, year, sum(amount) AS a FROM ln GROUP BY 1, 2, 3)
SELECT tech, county, year, a AS left_total, a * CASE WHEN tech = 'F' THEN 2 ELSE 0.5 END AS right_total,
  a - a * CASE WHEN tech = 'F' THEN 2 ELSE 0.5 END AS residual,
  abs(a - a * CASE WHEN tech = 'F' THEN 2 ELSE 0.5 END) > 1e-6 AS violated FROM l""")
def lp_transport_audit(t):
    ln = _lines(t)
    return so.transport_audit(ln, ln, _factor(ln))


@query("lp_arrival_audit", f"""
WITH {LINES_SQL}, l AS (SELECT basin, year, sum(amount) AS a FROM ln GROUP BY 1, 2),
r AS (SELECT basin, year, sum(amount) AS b FROM ln WHERE l_discount > 0 GROUP BY 1, 2)
SELECT basin, year, a AS left_total, coalesce(b, 0) AS right_total, a - coalesce(b, 0) AS residual,
  abs(a - coalesce(b, 0)) > 1e-6 AS violated FROM l LEFT JOIN r USING (basin, year)""")
def lp_arrival_audit(t):
    ln = _lines(t)
    return so.arrival_audit(ln, ln.filter(F.col("l_discount") > 0))


@query("lp_region_subset", """
SELECT p_brand AS region, count(*) AS lines, sum(l_quantity) AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def lp_region_subset(t):
    """Quantities are reduced per county before the region is looked up."""
    per_county = _lines(t).groupBy("county").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount")
    )
    mapping = t.part.select(F.col("p_partkey").alias("county"), F.col("p_brand").alias("region"))
    return so.to_region(per_county, mapping).groupBy("region").agg(
        F.sum("lines").alias("lines"), F.sum("amount").alias("amount")
    )
