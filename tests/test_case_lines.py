"""Case texts by line: any cut into splits gives the whole-text reader's rows."""

import pytest
from conftest import rows
from test_case_text import LONG, SHORT

from gridlake.plans.load_case import load_matpower_cases
from gridlake.sources import case_lines, case_text

# Closings before and within the opening's line, an unclosed block, a block in a block,
# rows beside the brackets, repeated blocks, carriage returns, and blanks of all kinds.
ODD = (
    "]; };\nmpc.baseMVA = 7\nmpc.baseMVA = 8;\n];\r\n"
    "mpc.bus = [ 1 2\r\n 3\t4 ;; % ]\n\x0b5 6\nmpc.gen=[7 8\n\n9 10 ]; 11 12\n 13 14];\n"
    "mpc.bus = [\n 99 99\n];\nmpc.branch = [1 2 x]; mpc.branch = [3];\n"
    "mpc.bus_name\t= { 'A' \n'B''C'\n  x 'D'\n 'É'; };\nmpc.gencost = [\n1 2\n"
)
LARGE = "mpc.bus = [\n" + "".join(f"{i} {i % 7}{' x' if i % 50 == 0 else ''};\n" for i in range(3000)) + "];\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("lines")
    for name, text in {"small": LONG, "short": SHORT, "odd": ODD, "large": LARGE, "plain": "nothing"}.items():
        (path / f"{name}.m").write_bytes(text.encode())
    return str(path)


@pytest.fixture(params=[16, 2000, 1 << 20])
def split_bytes(spark, request):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], request.param)
    spark.conf.set(names[1], 0)
    yield request.param
    for n, value in zip(names, before):
        spark.conf.set(n, value)


def plain(df):
    return rows(df.selectExpr(*[f"cast({c} AS string) AS {c}" for c in df.columns]))


def test_same_rows_as_whole_texts(spark, folder, split_bytes):
    if split_bytes < 2000:
        folder = f"{folder}/odd.m"
    lines, whole = case_lines.read_case_lines(spark, folder), case_text.read_case_text(spark, folder)
    if split_bytes <= 2000:
        assert lines.rdd.getNumPartitions() > 10
    for block in ("bus", "gen", "branch", "gencost"):
        assert plain(case_lines.matrix_rows(lines, block)) == plain(case_text.matrix_rows(whole, block))
        assert plain(case_lines.rejected_lines(lines, block)) == plain(case_text.rejected_lines(whole, block))
    assert plain(case_lines.bus_names(lines)) == plain(case_text.bus_names(whole))
    assert plain(case_lines.base_mva(lines)) == plain(case_text.base_mva(whole))
    assert case_lines.broken_openings(lines).count() == 0


def test_staged_blocks_are_the_same_table(spark, folder, tmp_path):
    by_line, whole = str(tmp_path / "line"), str(tmp_path / "whole")
    case_lines.stage_blocks(case_lines.read_case_lines(spark, folder), by_line)
    case_text.stage_blocks(case_text.read_case_text(spark, folder), whole)
    for block in case_text.BLOCKS:
        assert plain(case_text.staged_rows(spark, by_line, block)) == plain(case_text.staged_rows(spark, whole, block))
    assert plain(case_text.staged_names(spark, by_line)) == plain(case_text.staged_names(spark, whole))


def test_one_case_in_two_files_is_kept_apart(spark, tmp_path):
    for i, text in enumerate(["mpc.bus = [\n1\n2\n];", "mpc.bus = [\n3\n", "];\nmpc.bus = [4];"]):
        folder = tmp_path / "case_name=a"
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.txt").write_text(text)
    lines, whole = (r(spark, str(tmp_path)) for r in (case_lines.read_case_lines, case_text.read_case_text))
    got = plain(case_lines.matrix_rows(lines, "bus"))
    assert got == plain(case_text.matrix_rows(whole, "bus")) and len(got) == 3


def test_broken_openings_are_listed(spark, tmp_path):
    (tmp_path / "a.m").write_text("mpc.bus =\n[1];")
    (tmp_path / "b.m").write_text("mpc.bus = [1];")
    lines = case_lines.read_case_lines(spark, str(tmp_path))
    assert [c for _, c in rows(case_lines.broken_openings(lines))] == ["a"]


def test_load_by_line(spark, folder, tmp_path):
    for by_line in (False, True):
        load_matpower_cases(spark, folder, str(tmp_path / str(by_line)), hours=24, by_line=by_line)
    for table in ("power_measurements", "generator_measurements", "load_measurements", "contingencies"):
        counts = [spark.read.parquet(f"{tmp_path}/{b}/{table}").count() for b in (False, True)]
        assert counts[0] == counts[1] > 0
    same = [
        plain(spark.read.parquet(f"{tmp_path}/{b}/network_topology").select("case_name", "base_mva", "system_data"))
        for b in (False, True)
    ]
    assert same[0] == same[1]
