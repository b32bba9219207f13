"""Streams: broken messages, duplicates, late rows, stream against batch."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import quality as q
from gridlake.operators import rollups
from gridlake.streaming import first_writes as first
from gridlake.streaming import measurements as st
from gridlake.streaming import partials

SCHEMA = (
    "time timestamp, bus_id string, case_name string, voltage_magnitude double,"
    " active_power_mw double, reactive_power_mvar double"
)


def message(t, bus, v, **more):
    return json.dumps({"timestamp": t, "bus_id": bus, "voltage_magnitude": v, "active_power_mw": 1.0, **more})


@pytest.fixture()
def drain(spark, tmp_path):
    def run(stream, label):
        out = str(tmp_path / label)
        st.store_stream(stream, out, str(tmp_path / f"{label}-cp")).awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    return run


def test_decode_split_store_alert(spark, tmp_path, drain):
    texts = [
        message("2024-01-01T00:00:00Z", "1", 1.0),
        message("2024-01-01T00:00:00Z", "2", 1.2),
        message("2024-01-01T00:00:00Z", None, 1.0),
        '{"timestamp": broken',
        "",
        message("2024-01-01T00:00:00Z", "3", 0.89),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.txt").write_text("\n".join(texts) + "\n")
    stream = spark.readStream.text(str(tmp_path / "in"))
    decoded = st.decode(stream, schemas.STREAM_MESSAGE)
    checked = st.split_valid(decoded, [q.not_null("bus_id"), q.between("voltage_magnitude", 0.5, 1.5)])
    stored = drain(st.to_measurements(checked.filter("valid")), "stored")
    assert rows(stored, "bus_id", "source") == [("1", "SCADA"), ("2", "SCADA"), ("3", "SCADA")]
    assert {r.value for r in drain(st.dead_letters(decoded), "dead").collect()} == {'{"timestamp": broken', ""}
    alerts = drain(st.alerts(st.to_measurements(checked.filter("valid"))), "alerts")
    assert rows(alerts, "bus_id") == [("2",), ("3",)]


def batches(spark, folder, *groups):
    """One file per group, read one per trigger in order."""
    import os
    import time

    os.makedirs(folder)
    for i, group in enumerate(groups):
        data = [(t, b, "c", v, v, v) for t, b, v in group]
        df = spark.createDataFrame(data, SCHEMA.replace("time timestamp", "time string"))
        df = df.withColumn("time", F.col("time").cast("timestamp"))
        df.coalesce(1).write.parquet(f"{folder}/b{i}")
        for name in os.listdir(f"{folder}/b{i}"):
            if name.startswith("part"):
                stamp = time.time() - 1000 + 10 * i
                os.utime(f"{folder}/b{i}/{name}", (stamp, stamp))
    return (
        spark.readStream.schema(SCHEMA)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/b*")
    )


def test_requests_are_unique_per_batch(spark, tmp_path):
    stream = batches(
        spark,
        str(tmp_path / "in"),
        [("2024-01-01 00:00:00", "1", 2.0), ("2024-01-01 00:01:00", "1", 3.0), ("2024-01-01 00:00:00", "2", 1.0)],
        [("2024-01-01 01:00:00", "1", 2.0), ("2024-01-01 01:00:00", "3", 0.5)],
    )
    out = str(tmp_path / "requests")
    st.request_reruns(st.alerts(stream), out, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.option("recursiveFileLookup", True).parquet(out)
    assert rows(got, "batch_id", "bus_id") == [(0, "1"), (1, "1"), (1, "3")]


def store(spark, tmp_path, stream, label, keys=("time", "bus_id"), **options):
    out = str(tmp_path / label)
    first.store_first(stream, out, str(tmp_path / f"{label}-cp"), keys, **options).awaitTermination()
    return first.stored_rows(spark, out, stream.schema), first.stored_rows(spark, out, stream.schema, "copies")


def test_first_row_of_a_key_wins(spark, tmp_path):
    stream = batches(
        spark,
        str(tmp_path / "in"),
        [("2024-01-01 00:00:00", "1", 7.0), ("2024-01-01 00:00:00", "1", 1.0), ("2024-01-01 00:00:00", "2", 2.0)],
        [("2024-01-01 00:00:00", "1", 0.5), ("2024-01-01 01:00:00", "1", 3.0), ("2023-11-01 00:00:00", None, 4.0)],
        [("2023-11-01 00:00:00", None, 5.0), ("2024-01-01 00:00:00", "2", 6.0), (None, "9", 8.0), (None, "9", 9.0)],
    )
    got, copies = store(spark, tmp_path, stream, "unique", arrival="voltage_magnitude")
    assert rows(got, "bus_id", "voltage_magnitude") == [("1", 1.0), ("1", 3.0), ("2", 2.0), ("9", 8.0), (None, 4.0)]
    assert rows(copies, "voltage_magnitude") == [(0.5,), (5.0,), (6.0,), (7.0,), (9.0,)]


def test_keys_without_time_meet_across_dates(spark, tmp_path):
    days = [[(f"2024-01-0{d} 00:00:00", b, float(d)) for b in ("1", f"x{d}")] for d in (3, 1, 2)]
    got, _ = store(spark, tmp_path, batches(spark, str(tmp_path / "in"), *days), "unique", keys=["bus_id"])
    assert rows(got, "bus_id", "voltage_magnitude") == [("1", 3.0), ("x1", 1.0), ("x2", 2.0), ("x3", 3.0)]


def test_full_bitmap_changes_nothing(spark, tmp_path, monkeypatch):
    """With one word of bits every key is suspected; stored keys decide."""
    monkeypatch.setattr(first, "FILTER_BITS", 64)
    groups = [[(f"2024-01-01 00:{m:02d}:00", "1", float(10 * k + m)) for m in range(5 * k, 5 * k + 30)] for k in range(3)]
    got, copies = store(spark, tmp_path, batches(spark, str(tmp_path / "in"), *groups), "unique")
    assert got.count() == 40 and copies.count() == 50
    assert got.filter("batch = 0").count() == 30


def test_batch_that_is_run_again(spark, tmp_path):
    path = str(tmp_path / "table")
    data = [[("2024-01-01 00:00:00", str(b), float(b)) for b in range(k, k + 4)] for k in (0, 2)]
    frames = [
        spark.createDataFrame([(t, b, "c", v, v, v) for t, b, v in d], SCHEMA.replace("time timestamp", "time string"))
        .withColumn("time", F.col("time").cast("timestamp")) for d in data
    ]
    for batch in (0, 0, 1, 1):
        first.store_batch(frames[batch], batch, path, ["time", "bus_id"], rollups=[(partials.HOURLY, f"{path}-hourly")])
    got = first.stored_rows(spark, path, frames[0].schema)
    assert rows(got, "batch", "bus_id") == [(0, "0"), (0, "1"), (0, "2"), (0, "3"), (1, "4"), (1, "5")]
    rolled = partials.read_rollup(spark, f"{path}-hourly", frames[0].schema, partials.HOURLY)
    assert rows(rolled, "bus_id", "measurement_count") == [(str(b), 1) for b in range(6)]


def test_foreign_checkpoint_is_refused(spark, tmp_path):
    stream = batches(spark, str(tmp_path / "in"), [("2024-01-01 00:00:00", "1", 1.0)])
    store(spark, tmp_path, stream, "rows")
    with pytest.raises(ValueError, match="another checkpoint"):
        first.store_first(stream, str(tmp_path / "rows"), str(tmp_path / "new"))


def test_result_does_not_depend_on_batches(spark, tmp_path):
    events = spark.range(400).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.pmod(F.col("id") * 37, F.lit(90)).cast("int"))).alias("time"),
        F.concat(F.lit("b"), F.pmod("id", F.lit(7)).cast("string")).alias("bus_id"),
        F.lit("c").alias("case_name"),
        (F.col("id") % 11).cast("double").alias("voltage_magnitude"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("active_power_mw"),
        F.lit(0.0).alias("reactive_power_mvar"),
    ).dropDuplicates(["time", "bus_id"])
    # Unsorted files; every row comes twice, some in another file.
    events.union(events).repartition(4, "voltage_magnitude").write.parquet(str(tmp_path / "in"))
    want = rows(rollups.hourly_rollup(events).select(*partials.finish(partials.partial(events, partials.HOURLY), partials.HOURLY).columns))
    for files in (1, 2, 3, 100):
        stream = st.file_stream(spark, str(tmp_path / "in"), events.schema, files_per_trigger=files)
        target = str(tmp_path / f"rollup{files}")
        stored, copies = store(spark, tmp_path, stream, f"rows{files}", rollups=[(partials.HOURLY, target)])
        assert rows(stored, "time", "bus_id") == rows(events, "time", "bus_id")
        assert copies.count() == events.count()
        for step in range(3):
            got = partials.read_rollup(spark, target, events.schema, partials.HOURLY)
            assert rows(got) == want, (files, step)
            assert partials.compact(spark, target, events.schema, partials.HOURLY) == stored.agg(F.max("batch")).first()[0]
        late = first.late_rows(stored, F.expr("INTERVAL 3 HOURS")).count()
        assert (late > 0) == (files < 4)


def test_parts_survive_a_broken_compaction(spark, tmp_path):
    path = str(tmp_path / "parts")
    frame = spark.createDataFrame([("1", 2.0)], "bus_id string, v double").withColumn("time", F.lit("2024-01-01 05:00:00").cast("timestamp"))
    rollup = partials.Rollup(("bus_id",), means={"mean": "v"}, lows={"low": "v"}, count="n")
    assert partials.read_rollup(spark, path, frame.schema, rollup).count() == 0
    assert partials.compact(spark, path, frame.schema, rollup) == -1
    for batch in range(3):
        partials.store_partial(frame.withColumn("v", F.col("v") + batch), rollup, path, batch)
    (tmp_path / "parts" / "merged" / "upto=2" / "bucket_date=2024-01-01").mkdir(parents=True)  # no commit marker
    read = lambda: [tuple(r)[1:] for r in partials.read_rollup(spark, path, frame.schema, rollup).collect()]
    assert read() == [("1", 3.0, 2.0, 3)]
    assert partials.compact(spark, path, frame.schema, rollup) == 2
    partials.store_partial(frame.withColumn("v", F.lit(None).cast("double")), rollup, path, 3)
    assert read() == [("1", 3.0, 2.0, 4)]
    assert partials.compact(spark, path, frame.schema, rollup) == 3
    assert read() == [("1", 3.0, 2.0, 4)]
    assert partials.read_rollup(spark, path, frame.schema, rollup, ("2024-01-02", "2024-01-03")).count() == 0
