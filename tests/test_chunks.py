"""Chunked documents against whole ones; distinct counts from merged sketches."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_case_text import LONG, SHORT

from gridlake.operators import document_chunks as dc
from gridlake.operators import documents, sketches
from gridlake.plans.load_case import contingencies_of, matpower_components, staged
from gridlake.sources import case_text


@pytest.fixture(scope="module")
def components(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("chunks")
    (path / "small.m").write_text(LONG)
    (path / "short.m").write_text(SHORT)
    big = "mpc.bus = [\n" + "".join(f"{i} 1 {i % 3} 0 0 0 1 1 0\n" for i in range(2500)) + "];\n"
    (path / "big.m").write_text(big)
    return staged(matpower_components(case_text.read_case_text(spark, str(path))))


@pytest.fixture(scope="module")
def chunks(components):
    return dc.to_chunks(components, 100).cache()


def test_chunks_are_bounded_and_whole(components, chunks):
    big = chunks.filter("case_name = 'big' AND section = 'buses'")
    sizes = [r.num_elements for r in big.collect()]
    assert sum(sizes) == 2500 and 20 <= len(sizes) <= 25 and max(sizes) < 160
    for section in ("buses", "generators", "branches", "loads"):
        got = documents.explode_section(chunks.filter(F.col("section") == section), section)
        assert rows(got.select("case_name", "name")) == rows(components[section].select("case_name", "name"))


def test_whole_documents_equal_those_made_at_once(components, chunks):
    base = components["buses"].select("case_name").distinct().withColumn("base_mva", F.lit(50.5))
    topology = dc.chunked_topology(chunks, base, "M")
    columns = ["topology_id", "case_name", "num_buses", "num_generators", "num_branches", "num_loads", "system_data", "source"]
    want = documents.to_system_document(components, base, "M").select(*columns)
    assert rows(dc.whole_documents(topology, chunks).select(*columns)) == rows(want)
    assert [r.case_name for r in dc.whole_documents(topology, chunks, ["short"]).collect()] == ["short"]


def test_checks_equal_those_of_whole_documents(components, chunks):
    found = contingencies_of(components)
    want = documents.topology_checks(documents.to_system_document(components), found)
    got = dc.chunk_checks(dc.chunked_topology(chunks), chunks, found)
    assert rows(got.select(*want.columns)) == rows(want)


def test_only_the_sections_folder_is_read(spark, chunks, tmp_path):
    path = str(tmp_path / "stored")
    dc.write_chunks(chunks, path)
    units = dc.read_chunks(spark, path, "generators")
    assert rows(documents.document_generators(units), "case_name", "name") == [("small", f"Gen{i}") for i in range(1, 6)]
    files = units.select(F.col("_metadata.file_path")).distinct().collect()
    assert files and all("section=generators" in f[0] for f in files)
    plan = units._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(section" in plan


def test_empty_table_gives_no_chunks(components):
    none = {name: df.limit(0) for name, df in components.items()}
    chunks = dc.to_chunks(none)
    assert chunks.count() == 0 and dc.chunked_topology(chunks).count() == 0


SCHEMA = "day int, run string, unit bigint"


def test_nulls_empty_cells_and_empty_tables(spark):
    data = [(1, "a", 5), (1, "a", 5), (1, "a", None), (2, "a", None), (None, "a", 7)]
    cells = sketches.distinct_cells(spark.createDataFrame(data, SCHEMA), "unit", ["day"])
    assert rows(cells, "day", "n_rows", "n_distinct") == [(1, 3, 1), (2, 1, 0), (None, 1, 1)]
    assert rows(sketches.merged_distinct(cells, ["day"]), "day", "n_distinct") == [(1, 1), (2, 0), (None, 1)]
    assert sketches.merged_distinct(cells.limit(0), ["day"]).count() == 0


def test_error_of_merged_sketches_is_bounded(spark):
    """One run holds a third of all rows; days overlap, so cells cannot be added."""
    number = F.col("id")
    data = spark.range(600_000).select(
        (number % 30).cast("int").alias("day"),
        F.when(number % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), number % 50)).alias("run"),
        F.pmod(F.xxhash64(number), F.lit(1) + (number % 40) * 2000).alias("unit"),
    ).cache()
    cells = sketches.distinct_cells(data, "unit", ["day", "run"]).cache()
    for by in (["run"], ["day"], []):
        exact = data.groupBy(*by).agg(F.count_distinct("unit").alias("exact"), F.count(F.lit(1)).alias("rows"))
        merged = sketches.merged_distinct(cells, by)
        both = (merged.join(exact, by) if by else merged.crossJoin(exact)).collect()
        assert len(both) == exact.count()
        for r in both:
            assert r.n_rows == r.rows and r.at_least <= r.exact <= r.at_most
            assert abs(r.n_distinct - r.exact) <= 4 * sketches.standard_error() * r.exact
    single = sketches.merged_distinct(cells, ["day", "run"]).join(
        data.groupBy("day", "run").agg(F.count_distinct("unit").alias("exact")), ["day", "run"]
    )
    assert single.filter("n_distinct != exact").count() == 0


def test_any_cut_into_batches_merges_to_one_answer(spark, tmp_path):
    data = spark.range(20_000).selectExpr("cast(id % 5 AS int) AS day", "'x' AS run", "id * 7 % 9001 AS unit")
    answers = set()
    for n in (1, 3):
        path = str(tmp_path / str(n))
        for batch in [*range(n), 0]:
            part = data.filter(F.pmod(F.xxhash64("unit", "day"), F.lit(n)) == batch)
            cells = sketches.distinct_cells(part, "unit", ["day"])
            sketches.store_cells(cells, path, f"b{batch}")
        stored = sketches.stored_cells(spark, path, cells.schema)
        answers.add(tuple(rows(sketches.merged_distinct(stored, []), "n_rows")))
        got = sketches.merged_distinct(stored, []).head()
        assert abs(got.n_distinct - 9001) <= 4 * sketches.standard_error() * 9001
    assert answers == {((20_000,),)}
