"""Helpers that several text operators share.

Texts reach Python in Arrow batches. Each batch is cut into runs of about a
megabyte, and a run is handled as one byte array, so memory does not depend on
the batch or on how long single texts are (one text is always held whole).
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import fresh_path

# The characters that separate words.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_RNG = np.random.default_rng(20240101)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
# Bits of the bitmap that sifts documents by id.
ID_BITS = 1 << 22
_BASE = np.uint64(0x5851F42D4C957F2D)
_BASE_INV = np.uint64(pow(0x5851F42D4C957F2D, -1, 2**64))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps neither
    repeat the work nor depend on an executor that may be lost."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` whose workers can import this package, wherever they start:
    its source goes to them as a Spark file, once per application. What functions of other
    modules have kept in a reused worker is let go first."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        archive = Path(tempfile.mkdtemp(prefix="gridlake-code-")) / "gridlake.zip"
        package = Path(__file__).resolve().parents[1]
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    owner = run.__module__

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others(owner)
        yield from run(batches)

    return df.mapInArrow(task, schema)


_kept: dict[str, Callable[[], None]] = {}


def on_release(owner: str, release: Callable[[], None]) -> None:
    """``release`` empties what ``owner`` keeps in a worker between its tasks."""
    _kept[owner] = release


def release_others(owner: str) -> None:
    for name, release in _kept.items():
        if name != owner:
            release()


def driver_tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Letters beyond A-Z that lower() would change: titles, Roman and circled forms too.
_OTHER_UPPER = r"[\p{Lu}\p{Lt}\x{2160}-\x{216F}\x{24B6}-\x{24CF}&&[^A-Z]]"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; lower() is much the faster where it does the same."""
    return F.when(text.rlike(_OTHER_UPPER), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def hold(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed here, once per row: filters and projections
    that follow are not merged with the expressions behind the columns."""
    return df.select(F.explode(F.array(F.struct("*"))).alias("held")).select("held.*")


def runs(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``size`` bytes; null counts as empty."""
    if len(column) == 0:
        return
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = max(first + 1, min(last, len(column)))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, made as needed."""

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            up = np.full(size, _BASE, np.uint64)
            down = np.full(size, _BASE_INV, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


_POWERS = _Powers()


class Prefixes:
    """Hash of any slice of a sequence of 64-bit values, by prefix sums."""

    def __init__(self, values: np.ndarray):
        up, self.down = _POWERS.get(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64)
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + length * np.uint64(0x9E3779B97F4A7C15))


    def all_of(self, size: int) -> np.ndarray:
        """Hashes of all slices of ``size``, for ordering; two multiplications each."""
        count = len(self.sums) - size
        x = (self.sums[size:] - self.sums[:count]) * self.down[:count]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUE[data]


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of every word of a run; no word crosses two texts."""
    solid = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    finishes = solid.copy()
    finishes[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hash of every word; ``fold`` lower-cases A-Z first."""
    return Prefixes(byte_values(_LOWER[data] if fold else data)).of(starts, ends)


def per_row(rows: np.ndarray, count: int) -> np.ndarray:
    """Offsets of each row's items, items being sorted by row."""
    return np.searchsorted(rows, np.arange(count + 1))


def _id_bitmap(ids: DataFrame) -> bytes:
    """Bits of the hashed ids; at most ID_BITS / 64 rows reach the driver."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BITS))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    rows = ids.select(place.alias("place")).groupBy(F.floor(F.col("place") / 64).alias("at")).agg(F.bit_or(bit).alias("bits"))
    longs = np.zeros(ID_BITS // 64, np.int64)
    for row in rows.collect():
        longs[row["at"]] = row["bits"]
    return longs.tobytes()


def split_by_ids(docs: DataFrame, ids: DataFrame, apply=None, schema="doc_id long, text string") -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, text) whose id may be among ``ids``, and those whose id is surely not.

    The test is a bitmap of fixed size, so what is sent to all tasks does not grow with the
    data; a full bitmap lets more documents through to the join that follows. ``apply`` maps
    the batches of the first ones (to ``schema``) in the same worker that sifts them.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_id_bitmap(ids))

    def sieve(keep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            longs = np.frombuffer(bits.value, np.uint64)
            for batch in batches:
                place = batch.column(2).to_numpy()
                there = (longs[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
                yield batch.select([0, 1]).filter(pa.array(there == keep))

        return run

    placed = docs.select("doc_id", "text", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(ID_BITS)), F.lit(0)).alias("place"))
    chosen = sieve(True)
    run = chosen if apply is None else lambda batches: apply(chosen(batches))
    maybe = map_batches(placed.where("doc_id is not null"), run, schema)
    surely = map_batches(placed.where("doc_id is not null"), sieve(False), "doc_id long, text string")
    return maybe, surely.union(docs.where("doc_id is null"))


def sift(rows: DataFrame, keys: DataFrame, key: str, apply=None, schema=None) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` (not null) may be among ``keys``, and rows whose key surely is not,
    with all their columns. The test is a bitmap of fixed size, as in ``split_by_ids``.
    ``apply`` maps the batches of the second ones (to ``schema``) in the worker that sifts them."""
    bits = rows.sparkSession.sparkContext.broadcast(_id_bitmap(keys.select(F.col(key).alias("doc_id"))))

    def sieve(keep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            longs = np.frombuffer(bits.value, np.uint64)
            for batch in batches:
                place = batch.column(batch.num_columns - 1).to_numpy()
                there = (longs[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
                yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(there == keep))

        return run

    placed = rows.select("*", F.pmod(F.xxhash64(key), F.lit(ID_BITS)).alias("__place"))
    others = sieve(False)
    run = others if apply is None else lambda batches: apply(others(batches))
    return map_batches(placed, sieve(True), rows.schema), map_batches(placed, run, schema or rows.schema)


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b), component being the
    smallest node reachable. Alternating large-star and small-star steps: each
    step is a grouped minimum and a join, so a hub of any degree is spread over
    tasks by the skew join and no task holds a whole component."""

    def canonical(df: DataFrame) -> DataFrame:
        return df.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def is_star_forest(df: DataFrame) -> bool:
        """Every node has no edge down, or one and none up: the centres are the components."""
        ends = df.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
        ends = ends.union(df.select("b", F.lit(0), F.lit(1)))
        nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        open_nodes = F.count_if((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0)))
        return nodes.agg(open_nodes).first()[0] == 0

    current = stage(canonical(edges), f"{label}-edges")
    while not is_star_forest(current):
        both = current.union(current.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = canonical(large)
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        current = stage(canonical(small), f"{label}-edges")
    return current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
