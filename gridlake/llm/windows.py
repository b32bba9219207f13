"""Windows that also start in an earlier document, found from thinned positions.

A window is ``window`` consecutive units (bytes or words) of one document. Its anchor
is the leftmost smallest of the hashes of its ``k``-unit strings, so equal windows have
equal anchors, and neighbouring windows mostly share one: about two in
``window - k + 2`` positions are anchors. All windows of one anchor form a run; runs
with equal content (``run``) behave alike.

1. Every document gives its distinct (rank, run) pairs, rank being the name of the
   k units at the anchor. Spark sorts them by rank, run and document.
2. In that order, a run that an earlier document has is wholly repeated there. A rank
   with one run is settled; where several runs of a rank also agree on a longer
   string to the right or to the left, as any common window needs, their first
   documents go on.
3. These give the units around the anchor, which are sorted by rank again and handed
   to the operator's own resolver: it tells which windows of a run start earlier.
4. Each document marks its windows from what was found for its runs.

A group is one rank, with one row per document and run; its rows stream through a
task in sorted order, and at most ``hot`` distinct runs of the current rank are held.
A rank with more runs than that is hot: its runs all go on, and in step 3 each of their
windows gets a key of its own instead, the hash of its units. A task keeps the smallest
document of each key it has seen, so of a window that millions share it sends on hardly
more than one row; the keys' rows are sorted by key and document, and all but the first
document have the window in an earlier one.
Which documents take part in steps 3 and 4 is first tested on a bitmap of fixed
size, the only thing sent to all tasks; joins follow, so a full bitmap costs
shuffle and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import (
    Prefixes,
    byte_values,
    find_words,
    map_batches,
    mix,
    runs,
    split_by_ids,
    stage,
    word_values,
)

_SALT = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Shape:
    window: int
    k: int
    words: bool  # units are words, else bytes
    hot: int  # a rank of more distinct runs is handled window by window

    @property
    def span(self) -> int:
        return self.window - self.k + 1

    @property
    def right(self) -> int:
        """A common window reaches this far from the anchor, or ``left`` before it."""
        return (self.window + self.k) // 2

    @property
    def left(self) -> int:
        return self.window - self.right + 1


def unit_values(data: np.ndarray, words: bool, offsets: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Hash of every unit, with starts and ends in bytes, and the text each belongs to."""
    offsets = np.array([0, len(data)]) if offsets is None else offsets
    if words:
        starts, ends, texts = find_words(data, offsets)
        return word_values(data, starts, ends), starts, ends, texts
    places = np.arange(len(data))
    return byte_values(data), places, places + 1, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


# Keys are compared by 40 bits, so that key and place fit one number in most texts.
_PLACE_BITS = 24


def _leftmost_smallest(keys: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` keys the place of the leftmost smallest."""
    keys = keys >> np.uint64(_PLACE_BITS)
    places = np.arange(len(keys))
    if len(keys) < 1 << _PLACE_BITS:
        low, width = keys << np.uint64(_PLACE_BITS) | places.astype(np.uint64), 1
        while width < span:
            step = min(width, span - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        return (low & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    low, at, width = keys, places, 1
    while width < span:
        step = min(width, span - width)
        later = low[step:] < low[:-step]
        at = np.where(later, at[step:], at[:-step])
        low = np.where(later, low[step:], low[:-step])
        width += step
    return at


@dataclass
class Anchors:
    at: np.ndarray  # places of anchors
    first: np.ndarray  # first window of each
    last: np.ndarray
    rank: np.ndarray
    run: np.ndarray
    sides: np.ndarray  # 12 bits each of the longer strings to the right and left
    text: np.ndarray


def anchors(values: np.ndarray, shape: Shape, texts: np.ndarray) -> Anchors | None:
    """Anchors of the windows of one or several texts that lie behind each other;
    ``texts`` tells each unit's text. No window crosses two of them."""
    if len(values) < shape.window:
        return None
    with np.errstate(over="ignore"):
        names = Prefixes(values)
        keys = names.all_of(shape.k)
        at = _leftmost_smallest(keys, shape.span)
        inside = texts[: len(at)] == texts[shape.window - 1 :]
        edges = np.flatnonzero((np.diff(at) != 0) | np.diff(inside) | (np.diff(texts[: len(at)]) != 0)) + 1
        first = np.concatenate(([0], edges))
        last = np.concatenate((edges - 1, [len(at) - 1]))
        first, last = first[inside[first]], last[inside[first]]
        if not len(first):
            return None
        at = at[first]
        text = texts[first]
        begin, end = np.searchsorted(texts, text), np.searchsorted(texts, text, "right")
        run = mix(names.of(first, last + shape.window) + (at - first).astype(np.uint64) * _SALT)
        far, near = at + shape.right, at - shape.left
        right = names.of(at, np.minimum(far, end)) + np.where(far > end, run, np.uint64(0))
        left = names.of(np.maximum(near, begin), at + shape.k) + np.where(near < begin, run, np.uint64(0))
        sides = (right >> np.uint64(52)) << np.uint64(16) | (left >> np.uint64(52))
        return Anchors(at, first, last, keys[at] >> np.uint64(24), run, sides, text)


def _positions(shape: Shape):
    """(doc_id, text) to distinct (rank, run, sides, doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for start, data, offsets in runs(batch.column(1)):
                values, _, _, texts = unit_values(data, shape.words, offsets)
                found = anchors(values, shape, texts)
                if found is None:
                    continue
                order = np.lexsort((found.run, found.text))
                name, text = found.run[order], found.text[order]
                once = np.ones(len(order), bool)
                once[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
                order = order[once]
                sides = found.sides[order].astype(np.uint32).view(np.int32)
                arrays = [found.rank[order].view(np.int64), found.run[order].view(np.int64), sides, ids[start + found.text[order]]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["rank", "run", "sides", "doc_id"])

    return run


REPEATED, OPEN, HOT = 0, 1, 2


def _rerank(hot: int):
    """Rows sorted by rank, run, doc_id to (doc_id, run, rank, state): repeated runs, and
    the first documents of runs whose rank stays undecided, or is hot."""

    def emit(doc, run, rank, state):
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(run), pa.array(rank), pa.array(np.full(len(doc), state, np.int32))],
            names=["doc_id", "run", "rank", "state"],
        )

    def undecided(rank, run, sides, doc):
        """Of distinct runs, those that share a side with another run of their rank, from two documents."""
        if not len(rank):
            return emit(doc, run, rank, OPEN)
        keep = np.zeros(len(rank), bool)
        for side in (sides.view(np.uint32) >> np.uint32(16), sides.view(np.uint32) & np.uint32(0xFFFF)):
            order = np.lexsort((doc, side, rank))
            r, s, d = rank[order], side[order], doc[order]
            new = np.ones(len(r), bool)
            new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(r)))
            several = d[starts] != d[np.append(starts[1:], len(r)) - 1]
            keep[order[np.repeat(several & (sizes > 1), sizes)]] = True
        return emit(doc[keep], run[keep], rank[keep], OPEN)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the distinct runs of the last rank, whose rows may go on; of a hot rank the last run only
        hot_rank = None  # the last rank, where it is hot: its kept run has been given
        for batch in batches:
            if not batch.num_rows:
                continue
            rank, run, sides, doc = (batch.column(k).to_numpy() for k in range(4))
            if kept is not None:
                rank, run, sides, doc = (np.concatenate(x) for x in zip(kept, (rank, run, sides, doc), strict=True))
            new = np.ones(len(rank), bool)
            new[1:] = (rank[1:] != rank[:-1]) | (run[1:] != run[:-1])
            firsts = np.flatnonzero(new)
            low = np.repeat(doc[firsts], np.diff(np.append(firsts, len(rank))))
            again = doc > low
            yield emit(doc[again], run[again], rank[again], REPEATED)
            rank, run, sides, doc = rank[firsts], run[firsts], sides[firsts], doc[firsts]
            starts = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
            sizes = np.diff(np.append(starts, len(rank)))
            is_hot = np.repeat((sizes > hot) | (rank[starts] == hot_rank if hot_rank is not None else False), sizes)
            given = np.zeros(len(rank), bool)
            given[0] = hot_rank is not None
            fresh = is_hot & ~given
            yield emit(doc[fresh], run[fresh], rank[fresh], HOT)
            ended = rank != rank[-1]
            yield undecided(*(x[ended & ~is_hot] for x in (rank, run, sides, doc)))
            hot_rank = rank[-1] if is_hot[-1] else None
            last = slice(-1, None) if is_hot[-1] else ~ended
            kept = tuple(x[last] for x in (rank, run, sides, doc))
        if kept is not None and hot_rank is None:
            yield undecided(*kept)

    return run_batches


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [press.compress(x.as_py().encode()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "packed"])


# Kinds of rows beside passages, in the place of their number of windows.
_KEY, _KNOWN = 0, -1
# Keys whose smallest document a task keeps in mind.
_LOW_KEYS = 1 << 18


def _windows_of(names: Prefixes, first: np.ndarray, last: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Owner, step and key of every window of some runs."""
    counts = last - first + 1
    owner = np.repeat(np.arange(len(first)), counts)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = first[owner] + step
    return owner, step, names.of(start, start + window).view(np.int64)


def _around(shape: Shape):
    """(doc_id, packed, wanted, hot: runs) to (rank, run, doc_id, at, windows, around): the
    units of a run; of a run of a hot rank the keys of its windows, ``at`` being the window,
    and as _KNOWN, with bits in ``at``, the windows that this task saw in an earlier document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress, out, count = zstandard.ZstdDecompressor(), [], 0
        lows: dict[int, int] = {}

        def by_window(values, found, chosen, doc):
            with np.errstate(over="ignore"):
                owner, step, keys = _windows_of(Prefixes(values), found.first[chosen], found.last[chosen], shape.window)
            known = np.fromiter((lows.get(k, doc) < doc for k in keys.tolist()), bool, len(keys))
            for key in keys[~known].tolist():
                lows[key] = doc
            if len(lows) > _LOW_KEYS:
                lows.clear()
            runs_here = found.run[chosen].view(np.int64)
            bits = np.zeros(len(chosen), np.int64)
            np.bitwise_or.at(bits, owner[known], np.int64(1) << step[known])
            hit, rest = np.flatnonzero(bits), np.flatnonzero(~known)
            # Rows whose windows are known have no group; they are spread by their run.
            for rank, name, at, kind in (
                (runs_here[hit], runs_here[hit], bits[hit], _KNOWN),
                (keys[rest], runs_here[owner[rest]], step[rest], _KEY),
            ):
                out.append((rank, name, np.full(len(rank), doc, np.int64), at, np.full(len(rank), kind, np.int64), [b""] * len(rank)))
            return len(hit) + len(rest)

        def table() -> pa.RecordBatch:
            columns = [np.concatenate([part[k] for part in out]) for k in range(5)]
            arrays = [*(pa.array(c) for c in columns), pa.array([x for part in out for x in part[5]], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["rank", "run", "doc_id", "at", "windows", "around"])

        for batch in batches:
            (ends, every), (hot_ends, hot) = ((x.offsets.to_numpy(), x.values.to_numpy()) for x in (batch.column(2), batch.column(3)))
            for i, (doc, packed) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                data = np.frombuffer(unpress.decompress(packed.as_py()), np.uint8)
                values, _, _, texts = unit_values(data, shape.words)
                found = anchors(values, shape, texts)
                if found is None:
                    continue
                _, once = np.unique(found.run, return_index=True)
                if hot_ends[i] < hot_ends[i + 1]:
                    chosen = once[np.isin(found.run[once].view(np.int64), hot[hot_ends[i] : hot_ends[i + 1]])]
                    count += by_window(values, found, chosen, doc)
                chosen = once[np.isin(found.run[once].view(np.int64), every[ends[i] : ends[i + 1]])]
                first, last, at = found.first[chosen], found.last[chosen], found.at[chosen]
                units = values if shape.words else data
                pieces = [units[a:b].tobytes() for a, b in zip(first.tolist(), (last + shape.window).tolist(), strict=True)]
                names = found.rank[chosen].view(np.int64), found.run[chosen].view(np.int64)
                out.append((*names, np.full(len(chosen), doc, np.int64), at - first, last - first + 1, pieces))
                count += len(chosen)
                if count >= 4000:
                    yield table()
                    out, count = [], 0
        if out:
            yield table()

    return run


def _cover(values: np.ndarray, shape: Shape, names: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Units inside windows that are known to start earlier; -1 stands for all windows of a run."""
    marks = np.zeros(len(values) + 1, np.int64)
    found = anchors(values, shape, np.zeros(len(values), np.int64)) if len(names) else None
    if found is not None:
        order = np.argsort(names)
        names, bits = names[order], bits[order]
        once = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        names, bits = names[once], np.bitwise_or.reduceat(bits, once)
        runs_here = found.run.view(np.int64)
        at = np.minimum(np.searchsorted(names, runs_here), len(names) - 1)
        hit = names[at] == runs_here
        whole = hit & (bits[at] < 0)
        np.add.at(marks, found.first[whole], 1)
        np.subtract.at(marks, found.last[whole] + shape.window, 1)
        part = np.flatnonzero(hit & (bits[at] >= 0))
        if len(part):
            steps = np.arange(shape.span)
            owner, step = np.nonzero(bits[at[part]][:, None] >> steps & 1)
            starts = found.first[part][owner] + step
            np.add.at(marks, starts, 1)
            np.subtract.at(marks, starts + shape.window, 1)
    return np.cumsum(marks)[:-1] > 0


def _resolve_keys(resolve: Callable):
    """Rows of keys come before passages, sorted by key and document: they need no more
    than the smallest document of the last key. The passages go to ``resolve``."""

    def found(doc, name, bits):
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(name), pa.array(bits)], names=["doc_id", "run", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = low = None
        for batch in batches:
            key, name, doc, at, kind = (batch.column(k).to_numpy() for k in range(5))
            known, keyed = kind == _KNOWN, kind == _KEY
            yield found(doc[known], name[known], at[known])
            if keyed.any():
                key, name, doc, at = (x[keyed] for x in (key, name, doc, at))
                starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                lows = doc[starts]
                if key[0] == last:
                    lows[0] = low
                again = doc > np.repeat(lows, np.diff(np.append(starts, len(key))))
                yield found(doc[again], name[again], np.int64(1) << at[again])
                last, low = key[-1], lows[-1]
            if (kind > 0).any():
                yield from resolve(chain([batch.filter(pa.array(kind > 0))], batches))

    return run


def _keep(shape: Shape, packed: bool):
    """(doc_id, text or packed, found) to (doc_id, n_units, n_removed, n_spans, kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            rows, size = [], 0
            if packed:
                lists = batch.column(2)
                limits = lists.offsets.to_numpy()
                names, bits = (lists.values.field(k).to_numpy() for k in (0, 1))
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                text = unpress.decompress(text) if packed else (text or "").encode()
                mine = slice(limits[i], limits[i + 1]) if packed else slice(0)
                known = packed and mine.stop > mine.start
                data = np.frombuffer(text, np.uint8)
                if known:
                    values, starts, ends, _ = unit_values(data, shape.words)
                    removed = _cover(values, shape, names[mine], bits[mine])
                else:
                    values = data
                    if shape.words:
                        values, ends, _ = find_words(data, np.array([0, len(data)]))
                        starts = values
                    removed = np.zeros(len(values), bool)
                if shape.words:
                    left = ~removed
                    kept = b" ".join(text[a:b] for a, b in zip(starts[left].tolist(), ends[left].tolist(), strict=True))
                else:
                    kept = data[~removed].tobytes() if known else text
                spans = int((removed[1:] & ~removed[:-1]).sum() + removed[:1].sum())
                rows.append((batch.column(0)[i].as_py(), len(values), int(removed.sum()), spans, kept))
                size += len(kept)
                if size > 4 << 20 or i == batch.num_rows - 1:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    arrays = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_units", "n_removed", "n_spans", "kept"])
                    rows, size = [], 0

    return run


def remove_repeats(docs: DataFrame, shape: Shape, resolve: Callable, id_column: str, text_column: str) -> DataFrame:
    """One row per document: doc_id, n_units, n_removed, n_spans, kept (binary). Rows of one id
    with different texts are judged each by its own text, and never by one another's.

    ``resolve`` gets batches of (rank, run, doc_id, at, windows, around) sorted by rank
    and gives (doc_id, run, bits), a bit for each window of the run, counted from its
    first, that starts in a document with a smaller id.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    positions = map_batches(docs.where("doc_id is not null"), _positions(shape), "rank long, run long, sides int, doc_id long")
    ordered = positions.repartition("rank").sortWithinPartitions("rank", "run", "doc_id")
    decided = stage(map_batches(ordered, _rerank(shape.hot), "doc_id long, run long, rank long, state int"), "repeat-runs")
    sets = [F.collect_set(F.when(F.col("state") == state, F.col("run"))).alias(name) for state, name in ((OPEN, "wanted"), (HOT, "hot"))]
    waiting = decided.where(F.col("state") != REPEATED).groupBy("doc_id").agg(*sets)
    waiting = stage(waiting, "repeat-waiting")
    maybe, _ = split_by_ids(docs, waiting)
    # An id may stand over several texts: all of them may hold its runs. Copies are one.
    texts = map_batches(maybe, _pack, "doc_id long, packed binary").groupBy("doc_id").agg(F.collect_set("packed").alias("texts"))
    texts = texts.select("doc_id", F.explode("texts").alias("packed"))
    around = map_batches(
        texts.join(waiting, "doc_id"), _around(shape), "rank long, run long, doc_id long, at long, windows long, around binary"
    )
    around = around.repartition("rank").sortWithinPartitions(F.col("windows") > 0, "rank", "doc_id")
    resolved = stage(map_batches(around, _resolve_keys(resolve), "doc_id long, run long, bits long"), "repeat-windows")
    whole = decided.where(F.col("state") == REPEATED).select("doc_id", "run", F.lit(-1).cast("long").alias("bits"))
    found = whole.union(resolved).groupBy("doc_id").agg(F.collect_list(F.struct("run", "bits")).alias("found"))
    found = stage(found, "repeat-found")
    maybe, surely = split_by_ids(docs, found)
    result = "doc_id long, n_units long, n_removed long, n_spans long, kept binary"
    texts = map_batches(maybe, _pack, "doc_id long, packed binary").join(found, "doc_id", "left")
    cleaned = map_batches(texts, _keep(shape, True), result)
    same = map_batches(surely.withColumn("found", F.lit(None).cast("string")), _keep(shape, False), result)
    return cleaned.union(same)


def whole_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one batch after another, cut so that a rank never spans two lists."""
    rows: list[tuple] = []
    for batch in batches:
        rows += zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True)
        cut = len(rows)
        while cut and rows[cut - 1][0] == rows[-1][0]:
            cut -= 1
        if cut:
            yield rows[:cut]
            rows = rows[cut:]
    if rows:
        yield rows
