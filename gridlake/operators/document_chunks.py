"""Nested documents in chunks: one topology row per case, its sections as numbered chunks.

:mod:`gridlake.operators.documents` holds a case in one row. Here a section is dealt into
chunks of about ``CHUNK_ELEMENTS`` components, so no task holds a whole case and a reader of
one section reads that section's chunks only (they are stored by section). A chunk is a
document of one section: the readers of ``documents`` take chunks as they take documents.
:func:`whole_documents` joins the chunks again, for the cases it is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.scalars import topology_id
from gridlake.operators import documents

CHUNK_ELEMENTS = 1000
CHUNK_SCHEMA = (
    "topology_id bigint, case_name string, chunk_no bigint, num_elements bigint, system_data string, section string"
)
_KEYS = ["case_name", "section"]


def _elements(sections: dict[str, DataFrame]) -> DataFrame:
    """``(case_name, section, _spread, <one column per section>)`` of all components."""
    tagged = None
    for name, df in sections.items():
        row = df.select(
            "case_name",
            F.lit(name).alias("section"),
            F.xxhash64(F.lit(name), F.col("name")).alias("_spread"),
            documents.element(df, documents.SECTIONS[name]).alias(name),
        )
        tagged = row if tagged is None else tagged.unionByName(row, allowMissingColumns=True)
    return tagged


def to_chunks(sections: dict[str, DataFrame], elements: int = CHUNK_ELEMENTS) -> DataFrame:
    """``(topology_id, case_name, section, chunk_no, num_elements, system_data)``.

    A section of ``n`` components has ``ceil(n / elements)`` chunks; the hash of a component's
    name, over the range of hashes, says which. Components of one name share a chunk. Chunk
    numbers without a component are absent. Components without a case are kept under null.
    """
    # One struct as key: a null case still forms a cell.
    tagged = _elements(sections).withColumn("_cell", F.struct(*_KEYS))
    counted = tagged.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / elements).alias("_chunks"))
    # The hash's upper 48 bits as a share of their range: exact in doubles.
    share = (F.shiftright("_spread", 16) + F.lit(1 << 47)) / F.lit(float(1 << 48))
    placed = tagged.join(counted, "_cell").select(
        *_KEYS, *sections, F.floor(share * F.col("_chunks")).alias("chunk_no")
    )
    arrays = [F.collect_list(name).alias(name) for name in sections]
    chunks = placed.groupBy(*_KEYS, "chunk_no").agg(F.count(F.lit(1)).alias("num_elements"), *arrays)
    own = [F.when(F.col("section") == name, F.array_sort(name)).alias(name) for name in sections]
    return chunks.select(
        topology_id(F.col("case_name")).alias("topology_id"),
        "case_name", "chunk_no", "num_elements",
        F.to_json(F.struct(*own)).alias("system_data"),
        "section",
    )


def chunked_topology(chunks: DataFrame, base_mva: DataFrame | None = None, source: str = "") -> DataFrame:
    """One row per case: counts of components and chunks, base MVA. Reads no document."""
    counts = [
        F.coalesce(F.sum(F.when(F.col("section") == s, F.col("num_elements"))), F.lit(0).cast("bigint")).alias(c)
        for s, c in documents.COUNTS.items()
    ]
    rows = chunks.groupBy("topology_id", "case_name").agg(*counts, F.count(F.lit(1)).alias("num_chunks"))
    if base_mva is None:
        rows = rows.withColumn("base_mva", F.lit(100.0))
    else:
        rows = rows.join(base_mva.select("case_name", "base_mva"), "case_name", "left")
    return rows.select(
        "topology_id", "case_name", *documents.COUNTS.values(), "num_chunks", "base_mva", F.lit(source).alias("source")
    )


def write_chunks(chunks: DataFrame, path: str) -> None:
    chunks.write.mode("append").partitionBy("section").parquet(path)


def read_chunks(spark: SparkSession, path: str, section: str | None = None) -> DataFrame:
    """Stored chunks; those of one section lie in its own folder."""
    stored = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    return stored if section is None else stored.filter(F.col("section") == section)


def chunk_checks(
    topology: DataFrame, chunks: DataFrame, contingencies: DataFrame | None = None
) -> DataFrame:
    """:func:`documents.topology_checks` of chunked cases. Chunks are judged one by one and
    reduced to a row per case before they meet the topology rows."""
    checked = ["buses", "generators", "branches"]
    judged = documents.shallow(chunks).groupBy("topology_id").agg(
        *[F.sum(documents.array_size(s)).alias(f"actual_{s}") for s in checked],
        F.max(documents.incomplete("buses", documents.REQUIRED_BUS_FIELDS)).alias("bus_field_missing"),
        F.max(documents.incomplete("generators", documents.REQUIRED_GENERATOR_FIELDS)).alias("generator_field_missing"),
    )
    declared = [F.col(documents.COUNTS[s]).alias(f"declared_{s}") for s in checked]
    report = topology.select("topology_id", "case_name", *declared).join(judged, "topology_id", "left")
    report = report.na.fill(0, [f"actual_{s}" for s in checked]).na.fill(
        False, ["bus_field_missing", "generator_field_missing"]
    )
    return documents.with_verdict(report, checked, contingencies)


def whole_documents(topology: DataFrame, chunks: DataFrame, cases: list[str] | None = None) -> DataFrame:
    """Documents as :func:`documents.to_system_document` makes them: a row, and so a task's
    memory, per case. ``cases`` limits them to the cases asked for."""
    if cases is not None:
        topology = topology.filter(F.col("case_name").isin(cases))
        chunks = chunks.filter(F.col("case_name").isin(cases))
    schema = T.StructType([T.StructField(s, T.ArrayType(e)) for s, e in documents.SECTIONS.items()])
    parsed = chunks.select("topology_id", F.from_json("system_data", schema).alias("_doc"))
    joined = parsed.groupBy("topology_id").agg(
        *[F.array_sort(F.flatten(F.collect_list(f"_doc.{s}"))).alias(s) for s in documents.SECTIONS]
    )
    return topology.join(joined, "topology_id").select(
        *topology.columns, F.to_json(F.struct("base_mva", *documents.SECTIONS)).alias("system_data")
    )
