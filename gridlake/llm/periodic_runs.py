"""Periodic runs of words: maximal stretches that repeat with a period.

Method. A document is exploded into overlapping tiles, one series per octave of periods
[P, 2P): a tile owns a range of boundaries (every ``spacing``-th word) and carries the words
around it. A run of period ``q`` of the octave equals itself ``q`` words on over at least
``spacing`` words, so one of the boundaries lies in it. At a boundary ``b`` the run reaches
as far as the Z-function says: forward, the common beginning of the words from ``b`` and from
``b + q``; backward, the same on the reversed words. Both are cut at the tile's reach, which
is longer than any period of the octave, so a cut stretch is one of many overlapping
fragments. Fragments are shuffled by document and period and stitched to whole stretches;
equal stretches of several periods belong to the smallest.

A tile's work and size follow the octave and not the document, up to the document itself in
its last octaves. Words are numbered within their document, so comparing is exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import map_batches, sift, stage

MIN_LENGTH = 12
# Words a tile owns, at least; octaves own a multiple of their period.
TILE_WORDS = 4096
# Matches longer than this are left to the Z-function.
_DIRECT = 32
# Words of tiles handled as one array, and texts written at a time.
_RUN = 1 << 19
_TEXTS = 1000

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def octave(low: int, min_length: int) -> tuple[int, int, int]:
    """(spacing of boundaries, reach to each side, owned words of a tile) for periods [low, 2 * low)."""
    spacing = min(max(q, min_length - q) for q in range(low, min(2 * low, low + min_length + 1)))
    reach = max(2 * low, min_length)
    owned = max(TILE_WORDS, 8 * low)
    return spacing, reach, owned - owned % spacing


def number_words(text: str) -> np.ndarray:
    """Words of a text, each as the number of its first occurrence among distinct words."""
    known: dict[bytes, int] = defaultdict(lambda: len(known))
    return np.array([known[word] for word in text.encode().split()], np.int32)


def _tiles(min_length: int):
    """Rows (key, text) to tiles (key, period, first, lead, owned, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "low", "first", "lead", "owned", "words"]
        for batch in batches:
            rows, size = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = number_words(text.as_py() or "")
                low = 1
                while max(2 * low, min_length) <= len(words):
                    spacing, reach, owned = octave(low, min_length)
                    for start in range(0, len(words) - low, owned):
                        lead = min(start, reach)
                        part = words[start - lead : start + owned + reach + 2 * low]
                        rows.append((key, low, start - lead, lead, owned, part.tobytes()))
                        size += len(part)
                    low *= 2
                    if size >= _RUN:
                        yield _table(rows, names)
                        rows, size = [], 0
            yield _table(rows, names)

    return run


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    kinds = [pa.binary(), *[pa.int64()] * (len(names) - 2), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def z_function(words: list[int]) -> list[int]:
    """Length of the common beginning of ``words`` and of each of its suffixes."""
    size = len(words)
    out = [size] + [0] * (size - 1)
    left = right = 0
    for i in range(1, size):
        known = min(out[i - left], right - i) if i < right else 0
        while i + known < size and words[known] == words[i + known]:
            known += 1
        out[i] = known
        if i + known > right:
            left, right = i, i + known
    return out


def _extend(x: np.ndarray, near: np.ndarray, far: np.ndarray, step: int, limit: int) -> np.ndarray:
    """How many of the next ``limit`` words match, from ``near`` and ``far`` on."""
    out = np.zeros(len(near), np.int64)
    alive = np.arange(len(near))
    for k in range(limit):
        alive = alive[x[near[alive] + step * k] == x[far[alive] + step * k]]
        if not len(alive):
            break
        out[alive] += 1
    return out


def boundary_fragments(
    tiles: list[tuple[int, int, np.ndarray]], low: int, min_length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tile, period, start, end) of the stretches around the tiles' boundaries that match the
    words one period on. ``tiles`` are (lead, owned, words); places count from a tile's start."""
    spacing, reach, _ = octave(low, min_length)
    direct = min(_DIRECT, reach)
    pad = direct + 2 * low + 1
    # Numbers of different tiles differ, so no match crosses from one to another.
    parts, bases, at, offset = [np.full(pad, -1, np.int64)], [], pad, 0
    places, owners = [], []
    for k, (lead, owned, words) in enumerate(tiles):
        parts.append(words.astype(np.int64) + offset)
        offset += int(words.max()) + 1 if len(words) else 0
        bases.append(at)
        inside = np.arange(lead, min(lead + owned, len(words) - low), spacing)
        places.append(at + inside)
        owners.append(np.full(len(inside), k))
        at += len(words)
    x = np.concatenate([*parts, np.full(pad, -2, np.int64)])
    places, owners, bases = np.concatenate(places), np.concatenate(owners), np.array(bases)
    periods = np.arange(low, 2 * low)
    found = []
    rows = max(1, _RUN // low)
    for first in range(0, len(places), rows):
        some = places[first : first + rows]
        i, q = np.nonzero(x[some[:, None] + periods] == x[some][:, None])
        found.append((i + first, q + low))
    i, q = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    need = np.maximum(q, min_length - q)
    b = places[i]
    forward = _extend(x, b, b + q, 1, direct)
    backward = _extend(x, b - 1, b + q - 1, -1, direct)
    long = (forward == direct) | (backward == direct)
    if direct < reach and long.any():
        cut = np.flatnonzero(long)
        for mine in np.split(cut, np.flatnonzero(np.diff(i[cut])) + 1):
            here, tile = int(b[mine[0]]), int(owners[i[mine[0]]])
            begin = int(bases[tile])
            stop = begin + len(tiles[tile][2])
            ahead = z_function(x[here : min(stop, here + reach + 2 * low)].tolist())
            back = x[max(begin, here - reach) : here][::-1].tolist()
            span = x[max(begin, here + low - reach) : min(stop, here + 2 * low)][::-1].tolist()
            behind = z_function([*back, -3, *span])
            end = min(stop, here + 2 * low)
            for m in mine:
                p = int(q[m])
                forward[m] = min(ahead[p], reach)
                backward[m] = min(behind[len(back) + 1 + end - (here + p)], reach)
    keep = forward + backward >= need
    tile = owners[i[keep]]
    start = b[keep] - backward[keep] - bases[tile]
    end = b[keep] + forward[keep] - bases[tile]
    return _joined(tile, q[keep], start, end)


def _joined(tile, period, start, end):
    """Fragments of one stretch that meet within a tile become one."""
    order = np.lexsort((end, start, period, tile))
    tile, period, start, end = tile[order], period[order], start[order], end[order]
    if not len(tile):
        return tile, period, start, end
    # Within a stretch, starts and ends follow the boundaries, so the row before decides.
    fresh = np.ones(len(tile), bool)
    fresh[1:] = (tile[1:] != tile[:-1]) | (period[1:] != period[:-1]) | (start[1:] > end[:-1])
    firsts = np.flatnonzero(fresh)
    return tile[firsts], period[firsts], start[firsts], np.maximum.reduceat(end, firsts)


def _solve(min_length: int):
    """Tiles to fragments (key, period, start, end), places counted in the document."""

    def solved(tiles: list[tuple], low: int) -> pa.RecordBatch:
        parts = [(lead, owned, words) for _, _, lead, owned, words in tiles]
        tile, period, start, end = boundary_fragments(parts, low, min_length)
        keys = pa.array([t[0] for t in tiles], pa.binary()).take(pa.array(tile))
        first = np.array([t[1] for t in tiles], np.int64)[tile]
        places = [pa.array(c, pa.int64()) for c in (period, start + first, end + first)]
        return pa.RecordBatch.from_arrays([keys, *places], names=["key", "period", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_octave: dict[int, list] = defaultdict(list)
            sizes: dict[int, int] = defaultdict(int)
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for key, low, first, lead, owned, words in zip(*columns, batch.column(5), strict=True):
                numbers = np.frombuffer(words.as_buffer(), np.int32)
                by_octave[low].append((key, first, lead, owned, numbers))
                sizes[low] += len(numbers)
                if sizes[low] >= _RUN:
                    yield solved(by_octave.pop(low), low)
                    sizes[low] = 0
            for low, tiles in by_octave.items():
                yield solved(tiles, low)

    return run


def _fragments(min_length: int):
    """Rows (key, text) to fragments. A worker makes its tiles and solves them, a run of tiles
    at a time: they go neither to another worker nor through the JVM."""
    tiles, solve = _tiles(min_length), _solve(min_length)
    return lambda batches: solve(tiles(batches))


def stitch(fragments: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Runs (key, start, length, period) from fragments (key, period, start, end) that overlap."""
    order = Window.partitionBy("key", "period").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.withColumn("fresh", (before.isNull() | (F.col("start") > before)).cast("long"))
    marked = marked.withColumn("stretch", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = marked.groupBy("key", "period", "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start") + F.col("period")
    runs = whole.select("key", "period", "start", length.alias("length"))
    runs = runs.where((F.col("length") >= min_length) & (F.col("length") >= 2 * F.col("period")))
    return runs.groupBy("key", "start", "length").agg(F.min("period").alias("period"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, _TEXTS):
            yield batch.slice(first, _TEXTS)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the text without what the runs repeat; columns: ..., text, runs."""
    for batch in _slices(batches):
        at = batch.schema.get_field_index("runs")
        out = []
        for text, runs in zip(batch.column("text"), batch.column(at), strict=True):
            words = (text.as_py() or "").encode().split()
            found = runs.as_py()
            if found:
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, [r["start"] + r["period"] for r in found], 1)
                np.add.at(depth, [r["start"] + r["length"] for r in found], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
            out.append(b" ".join(words).decode())
        kept = [batch.column(k) for k in range(batch.num_columns) if batch.schema.names[k] != "text"]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.string())], names=[*names, "collapsed"])


def _respaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, collapsed) of texts without runs; columns: id, text."""
    for batch in _slices(batches):
        texts = (b" ".join((text.as_py() or "").encode().split()).decode() for text in batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "collapsed"])


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_length: int = MIN_LENGTH
) -> DataFrame:
    """One row per input row: the id, ``runs`` (start, length and smallest period of every run,
    in words, by start and period) and ``collapsed``, the words that no run repeats, joined by
    one space.

    A run is a stretch of at least ``min_length`` words and of two periods that no neighbour
    extends. Null and empty texts have no runs and an empty ``collapsed``. Repeated rows, equal
    ids with different texts and null ids are documents of their own. Long texts are cut into
    tiles, so only the text itself is held whole. An empty table gives no rows. Other columns
    are not read.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    docs = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    # Rows of one text share their runs, whatever their ids.
    docs = docs.withColumn("key", F.unhex(F.md5("text")))
    fragments = map_batches(docs.select("key", "text"), _fragments(min_length), "key binary, period long, start long, end long")
    runs = stitch(stage(fragments, "run-fragments"), min_length)
    run = F.struct("start", "length", "period")
    lists = runs.groupBy("key").agg(F.collect_list(run).alias("runs"))
    # By start, then period: equal starts have different periods.
    by_place = F.transform("runs", lambda r: F.struct(r["start"], r["period"], r["length"]))
    by_place = F.transform(F.array_sort(by_place), lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    lists = stage(lists.select("key", by_place.alias("runs")), "runs")
    kind = docs.schema["id"].dataType.simpleString()
    maybe, surely = sift(docs, lists.select("key"), "key", _respaced, f"id {kind}, collapsed string")
    # Merged, not broadcast: the workers that sift are done before those that collapse begin.
    with_runs = maybe.join(lists.hint("merge"), "key", "left").select("id", "text", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))
    collapsed = map_batches(with_runs, _collapse, f"id {kind}, runs {RUNS}, collapsed string")
    without = surely.select("id", F.array().cast(RUNS).alias("runs"), "collapsed")
    return collapsed.union(without).withColumnRenamed("id", id_column)


def longest(runs: Column) -> Column:
    """The longest run; of equal ones that with the smallest start, then period. Null without runs."""
    ranked = F.transform(
        runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
    )
    return F.array_max(ranked)


def plant_period(text: Column, doc_id: Column) -> Column:
    """The text with a period in its later words for every tenth hash of an id, else as it is.

    With the hash h of the decimal id, g = floor(h / 10) and n words, the words from a = g % n
    on become periodic with p = 1 + floor((n - a) / (3 + g % 8)) words where h % 10 is 0.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def spread(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, place(i))), " "))

    planted = F.transform(F.array(words), spread)[0]
    return F.when(F.pmod(h, F.lit(10)) == 0, F.coalesce(planted, text)).otherwise(text)
