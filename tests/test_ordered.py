"""Order operators against brute force, with a hot group and null keys."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlake.operators import ordered
from gridlake.operators.joins import spread_join
from gridlake.operators.rollups import series_arrays


@pytest.fixture(scope="module")
def frame():
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        data.append((key, i * 3 + (1000 if i > 1500 else 0), float(rng.randint(0, 100))))
    rng.shuffle(data)
    return pd.DataFrame(data, columns=["k", "n", "v"])


@pytest.fixture(scope="module")
def df(spark, frame):
    data = [(None if pd.isna(k) else k, int(n), float(v)) for k, n, v in frame.itertuples(index=False)]
    return spark.createDataFrame(data, "k string, n bigint, v double").repartition(4)


def _sorted(frame):
    out = frame.copy()
    out["k"] = out["k"].fillna("<null>")
    return out.sort_values(["k", "n"]).reset_index(drop=True)


def _collect(result):
    out = result.toPandas()
    out["k"] = out["k"].fillna("<null>")
    return out.sort_values(["k", "n"]).reset_index(drop=True)


@pytest.mark.parametrize("width", [1, 10, 500, 10**6])
def test_all_bucket_widths_agree(df, frame, width):
    bucket = ordered.number_bucket("n", width)
    want = _sorted(frame)
    group = want.groupby("k")
    got = _collect(ordered.with_position(df, ["k"], ["n"], bucket))
    assert (got["position"] == group.cumcount()).all()
    got = _collect(ordered.with_previous(df, ["k"], ["n"], ["n", "v"], bucket))
    pd.testing.assert_series_equal(
        got["prev_v"].astype(float), group["v"].shift(1), check_names=False
    )
    assert got["prev_n"].fillna(-1).astype(int).tolist() == group["n"].shift(1).fillna(-1).astype(int).tolist()
    got = _collect(ordered.with_running_sum(df, ["k"], ["n"], "v", bucket))
    assert (got["running_sum"] == group["v"].cumsum()).all()


def test_previous_with_two_order_columns(df, frame):
    got = _collect(
        ordered.with_previous(df, ["k"], ["n", "v"], ["v"], ordered.number_bucket("n", 50))
    )
    want = _sorted(frame).groupby("k")["v"].shift(1)
    pd.testing.assert_series_equal(got["prev_v"].astype(float), want, check_names=False)


def test_first_and_latest(df, frame):
    want = _sorted(frame)
    first = ordered.first_per_group(df, ["k"], ["n"]).toPandas()
    assert sorted(first["n"]) == sorted(want.groupby("k")["n"].min())
    last = ordered.latest_per_group(df, ["k"], ["n"]).toPandas()
    assert sorted(last["n"]) == sorted(want.groupby("k")["n"].max())


def test_numbers_are_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7).alias("x"))
    got = sorted(r.position for r in ordered.number_rows(df, "x").collect())
    assert got == list(range(1000))


def test_series_chunks_are_bounded_and_whole(df, frame):
    chunks = series_arrays(
        df.na.fill("<null>"), "k", "n", "v", chunk_rows=100, bucket=ordered.number_bucket("n", 40)
    ).collect()
    assert max(len(c["values"]) for c in chunks) <= 100
    for key, want in _sorted(frame).groupby("k"):
        mine = sorted((c for c in chunks if c["k"] == key), key=lambda c: c["chunk_no"])
        assert [v for c in mine for v in c["values"]] == want["v"].tolist()
        assert all(len(c["values"]) == 100 for c in mine[:-1])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, df, how):
    lookup = spark.createDataFrame([("hot", 1), ("a", 2)], "k string, w int")
    plain = spread_join(df, lookup, ["k"], how, 1).toPandas()
    spread = spread_join(df, lookup, ["k"], how, 5).toPandas()
    order = ["n"]
    pd.testing.assert_frame_equal(
        plain.sort_values(order).reset_index(drop=True)[sorted(plain.columns)],
        spread.sort_values(order).reset_index(drop=True)[sorted(plain.columns)],
    )


def test_spread_join_refuses_full_outer(df):
    with pytest.raises(ValueError):
        spread_join(df, df, ["k"], "full_outer", 2)


def test_one_hot_day_is_cut_into_ranges(spark, monkeypatch):
    """Minutes of one entity and day are spread; previous rows, gaps, ramps and arrays are as in one piece."""
    from gridlake.operators import derived

    start = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    rows = spark.range(6000).select(
        F.when(F.col("id") < 5000, "hot").when(F.col("id") < 5990, "b").alias("k"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") * 13.5)).alias("time"),
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("v"),
    )
    placed, bucket = ordered.spread_ranges(rows, ["k"], "time", most=300)
    cells = placed.groupBy("k", bucket.alias("cell")).count().filter("k = 'hot'")
    assert cells.count() >= 15 and cells.agg(F.max("count")).first()[0] <= 310
    monkeypatch.setattr(ordered, "RANGE_ROWS", 300)
    day = ordered.time_bucket("time")
    want = derived.ramp_rates(rows, ["k"], "time", "v", bucket=day)
    got = derived.ramp_rates(rows, ["k"], "time", "v")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    reports = [derived.gap_report(rows, ["k"], "time", bucket=b) for b in (None, day)]
    assert len({str(sorted(map(str, r.collect()))) for r in reports}) == 1
    chunks = [c for c in series_arrays(rows, "k", "time", "v", 500).collect() if c["k"] == "hot"]
    values = [v for c in sorted(chunks, key=lambda c: c["chunk_no"]) for v in c["values"]]
    assert values == [r["v"] for r in rows.filter("k = 'hot'").orderBy("time").collect()]


def test_ranges_of_null_keys_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, None), (None, "2024-01-01 00:00:00")], "k string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    placed, _ = ordered.spread_ranges(rows, ["k"], "t", most=1)
    assert placed.count() == 2
    assert ordered.spread_ranges(rows.limit(0), ["k"], "t")[0].count() == 0
