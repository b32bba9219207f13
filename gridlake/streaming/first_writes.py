"""Streams whose first write of a key wins, however late it comes and however the input is cut.

Next to the rows, every batch stores its keys, by date and sorted by a slot of their hash, and a
bitmap of the hashes per date. A new batch looks its keys up in the bitmaps of their dates: a
key whose bit is not set was never stored. Only the others are compared with stored keys, in the
slots that they lie in. So a batch reads bitmaps of fixed size and a few pages of keys, and no
stored row; nothing is kept in memory between batches. In a batch the row that arrived first
wins; its other rows, and rows whose key came in an earlier batch, are the side output.

Folders below the table's path, each with ``batch=<id>``: ``rows`` and ``copies`` by date,
``keys`` and ``filters`` by the keys' date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridlake.streaming.partials import Rollup, store_partial, whole_folders

# Bits of a date's bitmap, and slots in which a date's keys are sorted.
FILTER_BITS = 1 << 24
SLOTS = 64


def in_arrival_order(rows: DataFrame, keys: Sequence[str], arrival: str | None = None) -> DataFrame:
    """The rows with ``copy``: false for the first of each key by ``arrival``, null last; among
    equal ones, and without it, the smallest row is first, so the choice does not depend on how
    tasks deliver rows. Null keys are keys."""
    rank = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    order = [F.col(arrival).asc_nulls_last()] if arrival else []
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, rank))
    return rows.withColumn("copy", place > 1)


def _placed(rows: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Adds the date that the keys are filed under, and their place in its bitmap and slots.
    Keys without the time are filed under one date: equal keys must meet."""
    date = F.to_date(time) if time in keys else F.lit(None).cast("date")
    place = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    return rows.withColumns({"key_date": F.coalesce(date, F.make_date(F.lit(1970), F.lit(1), F.lit(1))), "_place": place}).withColumns(
        {"_word": F.floor(F.col("_place") / 64), "_bit": F.pmod("_place", F.lit(64)).cast("int"), "slot": F.pmod("_place", F.lit(SLOTS)).cast("int")}
    )


def _earlier(spark: SparkSession, folder: str, batch_id: int, layout: T.StructType) -> DataFrame | None:
    """What batches before this one stored below ``folder``."""
    if not any(batch < batch_id for batch in whole_folders(spark, folder, "batch")):
        return None
    layout = T.StructType([*layout.fields, T.StructField("batch", T.LongType()), T.StructField("key_date", T.DateType())])
    return spark.read.schema(layout).parquet(folder).filter(F.col("batch") < batch_id)


_FILTER = T.StructType([T.StructField("_word", T.LongType()), T.StructField("bits", T.LongType())])


def mark_stored(rows: DataFrame, path: str, batch_id: int, keys: Sequence[str]) -> DataFrame:
    """Placed ``rows`` with ``stored``: whether an earlier batch holds their key."""
    spark = rows.sparkSession
    filters = _earlier(spark, f"{path}/filters", batch_id, _FILTER)
    if filters is None:
        return rows.withColumn("stored", F.lit(False))
    dates = [r["key_date"] for r in rows.select("key_date").distinct().collect()]  # one row per day
    bitmap = filters.filter(F.col("key_date").isin(dates)).groupBy("key_date", "_word").agg(F.bit_or("bits").alias("bits"))
    probed = rows.join(bitmap, ["key_date", "_word"], "left")
    # shiftright keeps the sign, but the lowest bit is the one asked for.
    probed = probed.withColumn("_hit", F.coalesce(F.expr("(shiftright(bits, _bit) & 1L) = 1"), F.lit(False))).drop("bits")
    hits = probed.filter("_hit")
    places = hits.select("key_date", "slot").distinct().collect()  # SLOTS rows per day at most
    if not places:
        return probed.withColumn("stored", F.lit(False)).drop("_hit")
    layout = T.StructType([*[rows.schema[k] for k in keys], T.StructField("slot", T.IntegerType())])
    known = _earlier(spark, f"{path}/keys", batch_id, layout).filter(
        F.col("key_date").isin(sorted({r["key_date"] for r in places})) & F.col("slot").isin(sorted({r["slot"] for r in places}))
    )
    known = known.select(F.struct("key_date", *keys).alias("_key")).distinct().withColumn("_known", F.lit(True))
    # A struct compares null parts as equal values; rows without a hit do not take part.
    key = F.when(F.col("_hit"), F.struct("key_date", *keys))
    checked = probed.withColumn("_key", key).join(known, "_key", "left")
    return checked.withColumn("stored", F.coalesce("_known", F.lit(False))).drop("_hit", "_key", "_known")


def _refuse_foreign(spark: SparkSession, path: str, checkpoint: str) -> None:
    """A new checkpoint begins with batch 0: over a stored table it would replace that table's
    first batch and store copies of the rest."""
    jvm = spark.sparkContext._jvm
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    there = []
    for folder in (f"{checkpoint}/offsets", path):
        place = jvm.org.apache.hadoop.fs.Path(folder)
        there.append(place.getFileSystem(settings).exists(place))
    if there[1] and not there[0]:
        raise ValueError(f"{path} holds rows of another checkpoint than {checkpoint}")


def _write(rows: DataFrame, date: str, folder: str) -> None:
    """One file per date, more where a date is large."""
    rows.hint("rebalance", date).write.mode("overwrite").partitionBy(date).parquet(folder)


def store_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    keys: Sequence[str],
    arrival: str | None = None,
    time: str = "time",
    rollups: Sequence[tuple[Rollup, str]] = (),
) -> None:
    """Store one batch below ``path``. Its folders are replaced when it is run again, and only
    batches before it are looked at, so a repeated batch stores the same rows."""
    columns = batch.columns
    marked = mark_stored(_placed(in_arrival_order(batch, keys, arrival), keys, time), path, batch_id, keys)
    marked = marked.withColumn("date", F.to_date(time)).persist()
    try:
        fresh = marked.filter("NOT copy AND NOT stored")
        _write(fresh.select(*columns, "date"), "date", f"{path}/rows/batch={batch_id}")
        _write(marked.filter("copy OR stored").select(*columns, "date"), "date", f"{path}/copies/batch={batch_id}")
        for rollup, folder in rollups:
            store_partial(fresh.select(*columns), rollup, folder, batch_id)
        filed = fresh.select(*keys, "slot", "key_date").repartition("key_date").sortWithinPartitions("key_date", "slot")
        filed.write.mode("overwrite").partitionBy("key_date").parquet(f"{path}/keys/batch={batch_id}")
        # The bitmap comes last: once it is whole, so are the keys that it leads to.
        bits = fresh.groupBy("key_date", "_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("bits"))
        _write(bits, "key_date", f"{path}/filters/batch={batch_id}")
    finally:
        marked.unpersist()


def store_first(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("time", "bus_id"),
    arrival: str | None = None,
    time: str = "time",
    rollups: Sequence[tuple[Rollup, str]] = (),
) -> StreamingQuery:
    """Append the first write of every key below ``path``, its copies beside it, and the parts
    of the new rows to ``rollups`` (a rollup and its folder each)."""
    _refuse_foreign(stream.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, path, keys, arrival, time, rollups)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_rows(spark: SparkSession, path: str, rows: T.StructType, part: str = "rows") -> DataFrame:
    """Rows (or ``copies``) below ``path``, with ``batch`` and ``date``; ``rows`` is their schema."""
    layout = T.StructType([*rows.fields, T.StructField("batch", T.LongType()), T.StructField("date", T.DateType())])
    return spark.read.schema(layout).parquet(f"{path}/{part}")


def late_rows(stored: DataFrame, delay: Column, time: str = "time") -> DataFrame:
    """The side output of late rows: stored rows that are older than the newest time of the
    batches before theirs by more than ``delay`` (an interval)."""
    newest = stored.groupBy("batch").agg(F.max(time).alias("newest"))
    before = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)  # one row per batch
    marks = newest.select("batch", F.max("newest").over(before).alias("seen"))
    return stored.join(marks, "batch").filter(F.col(time) < F.col("seen") - delay).drop("seen")
