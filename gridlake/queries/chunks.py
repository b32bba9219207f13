"""Chunked documents of case texts, and distinct counts from stored sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import document_chunks, documents, sketches
from gridlake.plans.load_case import contingencies_of, matpower_components, staged
from gridlake.queries import cases as whole
from gridlake.queries.mapping import dispatch
from gridlake.queries.registry import ORACLE, Tables, query
from gridlake.session import fresh_path
from gridlake.sources import case_lines

# Small enough that every case of a thousand parts has several chunks per section.
ELEMENTS = 150


def _case_lines(t: Tables) -> DataFrame:
    return case_lines.read_case_lines(t.spark, whole.case_files(t))


def _chunks(t: Tables, components: dict[str, DataFrame]) -> str:
    path = fresh_path(t.spark, "chunks")
    document_chunks.write_chunks(document_chunks.to_chunks(components, ELEMENTS), path)
    return path


def _section(t: Tables, section: str) -> DataFrame:
    """Stored chunks of one section, of texts read by line."""
    path = _chunks(t, {section: matpower_components(_case_lines(t))[section]})
    return document_chunks.read_chunks(t.spark, path, section)


@query("chunk_generators", ORACLE["document_generators"])
def chunk_generators(t):
    return documents.document_generators(_section(t, "generators")).select(
        "case_name", "name", "bus_name", "status", "pmin", "pmax", "qmin", "ramp_up",
        "cost_linear", "cost_fixed", "startup_cost",
    )


@query("chunk_branches", ORACLE["document_branches"])
def chunk_branches(t):
    return documents.document_branches(_section(t, "branches")).select(
        "case_name", "name", "from_bus_name", "to_bus_name", "available", "shunt_from", "shunt_to",
        "rating", "angle_min", "angle_max",
    )


@query("chunk_topology", ORACLE["system_document"])
def chunk_topology(t):
    """Counts come from the chunks' rows; no document is parsed."""
    lines = _case_lines(t)
    chunks = document_chunks.read_chunks(t.spark, _chunks(t, matpower_components(lines)))
    return document_chunks.chunked_topology(chunks, case_lines.base_mva(lines), "MATPOWER").select(
        "case_name", "num_buses", "num_generators", "num_branches", "num_loads", "base_mva"
    )


@query("chunk_checks", ORACLE["topology_checks"])
def chunk_checks(t):
    """Odd cases declare one bus too many; units of size 49 lose a required key."""
    components = staged(matpower_components(_case_lines(t)))
    found = contingencies_of(components)
    components["generators"] = components["generators"].withColumn(
        "bus_number", F.when(F.col("pmin") != 49, F.col("bus_number"))
    )
    chunks = document_chunks.read_chunks(t.spark, _chunks(t, components))
    topology = document_chunks.chunked_topology(chunks)
    odd = F.col("case_name").substr(-1, 1).cast("int") % 2
    topology = topology.withColumn("num_buses", F.col("num_buses") + odd)
    return document_chunks.chunk_checks(topology, chunks, found).select(
        "case_name", "actual_buses", "declared_buses", "counts_match",
        "generator_field_missing", "success", "contingencies",
    )


def _cells(t: Tables) -> DataFrame:
    """Buses with dispatch per day and scenario, stored in two batches, one of them offered twice."""
    path = fresh_path(t.spark, "sketches")
    rows = dispatch(t).withColumn("day", F.to_date("target_datetime"))
    for batch, part in (("early", "time_step <= 3"), ("late", "time_step > 3"), ("early", "time_step <= 3")):
        cells = sketches.distinct_cells(rows.filter(part), "bus_id", ["day", "scenario_type"])
        sketches.store_cells(cells, path, batch)
    return sketches.stored_cells(t.spark, path, cells.schema)


@query("distinct_cells", """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, l_returnflag AS scenario_type, l_linenumber <= 3 AS early,
       count(*) AS n_rows, count(DISTINCT l_partkey) AS n_distinct
FROM lineitem GROUP BY 1, 2, 3""")
def distinct_cells(t):
    """Exact counts beside the sketches, a batch at a time."""
    rows = dispatch(t).select(
        F.to_date("target_datetime").alias("day"), "scenario_type", (F.col("time_step") <= 3).alias("early"), "bus_id"
    )
    return sketches.distinct_cells(rows, "bus_id", ["day", "scenario_type", "early"]).select(
        F.col("day").cast("string").alias("day"), "scenario_type", "early", "n_rows", "n_distinct"
    )


@query("distinct_merged", """
WITH cell AS (
  SELECT year(l_shipdate) AS year, l_returnflag AS scenario_type, CAST(l_shipdate AS DATE) AS day, l_linenumber <= 3 AS early,
         count(*) AS n, count(DISTINCT l_partkey) AS members
  FROM lineitem GROUP BY 1, 2, 3, 4),
whole AS (
  SELECT year(l_shipdate) AS year, l_returnflag AS scenario_type, count(DISTINCT l_partkey) AS n_exact FROM lineitem GROUP BY 1, 2)
SELECT CAST(year AS INTEGER) AS year, scenario_type, count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS n_rows, max(members) AS at_least,
       CAST(sum(members) AS BIGINT) AS at_most, any_value(n_exact) AS n_exact, TRUE AS is_close
FROM cell JOIN whole USING (year, scenario_type) GROUP BY 1, 2""")
def distinct_merged(t):
    """Merged sketches beside the exact count of the rows; close means four standard errors."""
    merged = sketches.merged_distinct(_cells(t).withColumn("year", F.year("day")), ["year", "scenario_type"])
    exact = (
        dispatch(t)
        .groupBy(F.year("target_datetime").alias("year"), "scenario_type")
        .agg(F.count_distinct("bus_id").alias("n_exact"))
    )
    off = F.abs(F.col("n_distinct") - F.col("n_exact"))
    close = off <= 4 * sketches.standard_error() * F.col("n_exact")
    return merged.join(exact, ["year", "scenario_type"]).select(
        "year", "scenario_type", "n_cells", "n_rows", "at_least", "at_most", "n_exact", close.alias("is_close")
    )
