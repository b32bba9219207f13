"""Closed versions and the version valid at a time, against a plain search."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridlake.operators.versions import close_versions, with_valid_version

VERSIONS = "case_name string, topology_id int, valid_from timestamp_ntz, valid_until timestamp_ntz"
FACTS = "case_name string, time timestamp_ntz, v int"
START = datetime(2024, 1, 1)


def plain(versions, case, time):
    """The newest version begun by then, if it has not run out."""
    if case is None or time is None:
        return None
    begun = [v for v in versions if v[0] == case and v[2] is not None and v[2] <= time]
    if not begun:
        return None
    newest = max(begun, key=lambda v: (v[2], v[1]))
    return newest[1] if newest[3] is None or time < newest[3] else None


@pytest.mark.parametrize("seed", range(3))
def test_against_a_plain_search(spark, seed):
    rng = random.Random(seed)

    def moment(hours):
        return START + timedelta(hours=rng.choice(range(0, hours, rng.choice([1, 6, 24]))))

    versions = []
    for ident in range(40):
        begin = None if rng.random() < 0.05 else moment(400)
        ends = begin + timedelta(hours=rng.randrange(60)) if begin and rng.random() < 0.5 else None
        versions.append((rng.choice(["a", "b", "c", None]), ident, begin, ends))
    facts = [
        (rng.choice(["a", "a", "b", "c", "d", None]), None if rng.random() < 0.05 else moment(500), n) for n in range(300)
    ]
    facts += facts[:20]  # repeated rows stay
    got = with_valid_version(spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS))
    assert rows(got) == sorted(
        ((c, t, n, plain(versions, c, t)) for c, t, n in facts), key=lambda r: tuple((x is None, str(x)) for x in r)
    )


def test_closing(spark):
    day = [START + timedelta(days=n) for n in range(4)]
    df = spark.createDataFrame(
        [("c", 1, day[0], None), ("c", 2, day[1], day[3]), ("c", 3, day[1], None), ("c", 4, day[2], None), ("d", 5, day[0], day[1])],
        VERSIONS,
    )
    got = rows(close_versions(df), "topology_id", "valid_until")
    assert got == [(1, day[1]), (2, day[1]), (3, day[2]), (4, None), (5, day[1])]
    assert rows(close_versions(close_versions(df))) == rows(close_versions(df))


def test_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], VERSIONS)
    facts = spark.createDataFrame([("c", START, 1)], FACTS)
    assert rows(with_valid_version(facts, none)) == [("c", START, 1, None)]
    one = spark.createDataFrame([("c", 7, START, None)], VERSIONS)
    assert rows(with_valid_version(facts.limit(0), one)) == []
    with pytest.raises(ValueError, match="topology_id"):
        with_valid_version(facts.withColumn("topology_id", F.lit(1)), one)
