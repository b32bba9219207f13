import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from gridlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Sorted tuples of the chosen columns."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
