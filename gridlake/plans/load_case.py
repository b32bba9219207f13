"""Load network cases: components, topology rows, contingencies, series."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.functions.scalars import topology_id
from gridlake.operators import convert, documents, scenarios, series
from gridlake.operators.joins import new_cases
from gridlake.session import fresh_path
from gridlake.sinks import tables as sinks
from gridlake.sources import case_lines, case_text
from gridlake.sources.tables import is_missing_path, read_csv_table, read_measurements, read_profiles


def matpower_components(cases: DataFrame) -> dict[str, DataFrame]:
    """Component tables of any number of case texts at once, as whole texts or as lines.

    The parsed blocks are staged in the shared folder, so the texts are read and
    parsed once and a lost executor repeats only a Parquet scan.
    """
    spark = cases.sparkSession
    path = fresh_path(spark, "blocks")
    _reader(cases).stage_blocks(cases, path)
    rows = lambda name: case_text.staged_rows(spark, path, name)
    buses = convert.matpower_buses(rows("bus"), case_text.staged_names(spark, path))
    return {
        "buses": buses,
        "generators": convert.matpower_generators(rows("gen"), rows("gencost"), buses),
        "branches": convert.matpower_branches(rows("branch"), buses),
        "loads": convert.matpower_loads(buses),
    }


def _reader(cases: DataFrame):
    return case_lines if "line" in cases.columns else case_text


def staged(components: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Component tables that several outputs use, written once."""
    return {name: sinks.stage(df, name) for name, df in components.items()}


def rts_components(spark: SparkSession, folder: str, case_name: str = "RTS_GMLC") -> dict[str, DataFrame]:
    """Component tables of a folder with bus, gen, branch and bus_map CSVs."""
    file = read_csv_table(spark, f"{folder}/bus.csv", schemas.BUS_CSV, file_order=True)
    buses = convert.rts_buses(file, case_name)
    # Of several buses with one number the first in the file gives the name.
    named = file.select(
        F.lit(case_name).alias("case_name"),
        F.col("Bus ID").cast("bigint").alias("number"),
        F.col("Bus Name").cast("string").alias("name"),
        "row_no",
    )
    return {
        "buses": buses,
        "generators": convert.rts_generators(
            read_csv_table(spark, f"{folder}/gen.csv", schemas.GEN_CSV), case_name, named, ["row_no"]
        ),
        "branches": convert.rts_branches(
            read_csv_table(spark, f"{folder}/branch.csv", schemas.BRANCH_CSV), case_name, named, ["row_no"]
        ),
        "loads": convert.rts_loads(
            read_csv_table(spark, f"{folder}/bus_map.csv", schemas.BUS_MAP_CSV), case_name
        ),
    }


def contingencies_of(
    components: dict[str, DataFrame], min_pmax: float | None = None, with_capacity: bool = False
) -> DataFrame:
    """Single outages of every branch and unit, keyed by topology id."""
    with_id = lambda df: df.withColumn("topology_id", topology_id(F.col("case_name")))
    return scenarios.n1_contingencies(
        with_id(components["branches"]), with_id(components["generators"]), min_pmax,
        with_capacity=with_capacity,
    )


def load_matpower_cases(
    spark: SparkSession, path: str, warehouse: str, hours: int = 168, start: str = series.SERIES_START,
    noise: bool = True, by_line: bool = False,
) -> None:
    """Parse all case files below ``path`` and append topology, contingencies and
    simulated measurements; cases that are loaded already are skipped. ``by_line`` reads
    texts that are too large for one task."""
    cases = case_lines.read_case_lines(spark, path) if by_line else case_text.read_case_text(spark, path)
    existing = _existing(spark, f"{warehouse}/network_topology")
    if existing is not None:
        cases = new_cases(cases, existing)
    components = staged(matpower_components(cases))
    # The topology row marks a case as loaded and comes last. Each table takes
    # only cases it does not hold, so a run that broke off is simply repeated.
    for table, rows, entity in (
        ("power_measurements", series.simulate_buses(components["buses"], hours, start, noise), "bus_id"),
        (
            "generator_measurements",
            series.simulate_generators(components["generators"], hours, start, noise),
            "generator_id",
        ),
        ("load_measurements", series.simulate_loads(components["loads"], hours, start, noise), "load_id"),
    ):
        _append_series(spark, rows, f"{warehouse}/{table}", entity, start, hours)
    _append_contingencies(spark, contingencies_of(components), warehouse)
    sinks.append_results(
        documents.to_system_document(components, _reader(cases).base_mva(cases), "MATPOWER"),
        schemas.NETWORK_TOPOLOGY,
        f"{warehouse}/network_topology",
    )


def _append_series(
    spark: SparkSession, rows: DataFrame, path: str, entity: str, start: str, hours: int
) -> None:
    """Append the cases that have no rows in the same time range yet."""
    if _existing(spark, path) is not None:
        end = (datetime.fromisoformat(start) + timedelta(hours=hours)).isoformat(" ")
        rows = new_cases(rows, read_measurements(spark, path, start, end))
    table = path.rsplit("/", 1)[1]
    sinks.append_measurements(rows, path, entity=entity, schema=schemas.MEASUREMENTS[table])


def _append_contingencies(spark: SparkSession, found: DataFrame, warehouse: str) -> None:
    path = f"{warehouse}/contingencies"
    existing = _existing(spark, path)
    if existing is not None:
        found = new_cases(found, existing, "topology_id")
    sinks.append_results(found, schemas.CONTINGENCIES, path)


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return None


def load_rts_case(
    spark: SparkSession, folder: str, warehouse: str, case_name: str = "RTS_GMLC"
) -> None:
    """Load an RTS folder: topology, a year of load and unit series, outages of
    all branches and of the large units. A loaded case is skipped."""
    existing = _existing(spark, f"{warehouse}/network_topology")
    if existing is not None and not existing.filter(F.col("case_name") == case_name).isEmpty():
        return
    components = staged(rts_components(spark, folder, case_name))
    profiles = f"{folder}/timeseries_data_files"
    regional = read_profiles(spark, f"{profiles}/Load", "regional_Load")
    if regional is not None:
        bus_map = read_csv_table(
            spark, f"{folder}/bus_map.csv", schemas.BUS_MAP_CSV, file_order=True
        )
        loads = series.area_load(
            regional, bus_map, components["buses"], case_name=case_name, order=["row_no"]
        )
        _append_series(
            spark, loads, f"{warehouse}/load_measurements", "load_id",
            series.SERIES_START, series.HOURS_PER_YEAR,
        )
    units = series.generator_year(
        components["generators"],
        wind=read_profiles(spark, f"{profiles}/WIND", "wind_total_2007"),
        solar=read_profiles(spark, f"{profiles}/PV", "pv_2007"),
        hydro=read_profiles(spark, f"{profiles}/Hydro", "Hydro_1"),
    )
    _append_series(
        spark, units, f"{warehouse}/generator_measurements", "generator_id",
        series.SERIES_START, series.HOURS_PER_YEAR,
    )
    _append_contingencies(
        spark, contingencies_of(components, scenarios.LARGE_UNIT_MW, with_capacity=True), warehouse
    )
    sinks.append_results(
        documents.to_system_document(components, source="RTS-GMLC"),
        schemas.NETWORK_TOPOLOGY,
        f"{warehouse}/network_topology",
    )
