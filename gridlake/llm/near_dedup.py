"""Near-duplicate documents by fast similarity sketching.

Method. A document is the set of its distinct word shingles. Its sketch has
``BINS`` bins. In round ``i`` every shingle is hashed into one bin, by chance in
the first ``BINS`` rounds and into bin ``i - BINS`` in the next ``BINS``; a bin
keeps the smallest value of the first round that reaches it, and the rounds stop
once all bins are full. So every bin fills, and equal bins estimate the
similarity with Chernoff bounds. Bands of bins propose candidates and full sets
decide: a pair at 0.85 shares no band with probability 4e-7.

Documents with equal sets are one node, so copies cost one row each. Nodes that
share a band are chained to clusters, and only links inside a cluster can exist.
A cluster is dealt into blocks of bounded size; a block is held whole against
itself and against some hubs of its cluster, and returns a spanning forest of
its links, so no list of pairs is formed anywhere. Where a cluster has several
blocks, the nodes outside its largest component meet all its blocks in turn.
A link within a component can add nothing, so the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import connected_components, find_words, map_batches, mix, per_row, runs, split_by_ids, stage, word_values

BANDS = 25
BAND_ROWS = 5
BINS = BANDS * BAND_ROWS
# A block holds about so many nodes and shingles.
BLOCK_NODES = 512
BLOCK_SHINGLES = 1_000_000
# Shingles of a set that are met with the block's sets at once, times these sets.
MEETINGS = 1 << 18
HUBS = 64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their rows, sorted by row and hash."""
    starts, ends, rows = find_words(data, offsets)
    values = word_values(data, starts, ends, fold=True)
    total = len(values)
    hashes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if total >= words:
        whole = rows[: total - words + 1] == rows[words - 1 :]
        joined = np.zeros(total - words + 1, np.uint64)
        for k in range(words):
            joined = mix(joined + values[k : total - words + 1 + k])
        hashes, owners = joined[whole], rows[: total - words + 1][whole]
    bounds = per_row(rows, len(offsets) - 1)
    counts = np.diff(bounds)
    for row in np.flatnonzero((counts > 0) & (counts < words)):  # the whole sequence is one shingle
        joined = np.full(1, counts[row], np.uint64)
        for value in values[bounds[row] : bounds[row + 1]]:
            joined = mix(joined + value)
        hashes, owners = np.append(hashes, joined), np.append(owners, row)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[fresh], owners[fresh]
    return hashes, owners


def sketch(hashes: np.ndarray, owners: np.ndarray, count: int, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values per set; rows without shingles keep the largest value."""
    empty = np.uint64(2**64 - 1)
    values = np.full(count * bins, empty, np.uint64)
    present = np.zeros(count, bool)
    present[owners] = True
    with np.errstate(over="ignore"):
        for turn in range(2 * bins):
            if not len(hashes):
                break
            mixed = mix(hashes + np.uint64(turn + 1) * np.uint64(0x9E3779B97F4A7C15))
            if turn < bins:
                place = ((mixed >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
                mixed = mix(mixed)
            else:
                place = np.full(len(hashes), turn - bins, np.int64)
            key = owners * bins + place
            free = values[key] == empty
            np.minimum.at(values, key[free], np.minimum(mixed[free], empty - np.uint64(1)))
            unfilled = (values.reshape(count, bins) == empty).any(axis=1)
            keep = unfilled[owners]
            hashes, owners = hashes[keep], owners[keep]
    return values.reshape(count, bins)


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in runs(batch.column(1)):
                count = len(offsets) - 1
                with np.errstate(over="ignore"):
                    hashes, owners = shingle_sets(data, offsets, words)
                    bounds = per_row(owners, count)
                    sizes = np.diff(bounds)
                    one, two = (
                        np.diff(np.concatenate(([np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(salt)))))[bounds])
                        for salt in (0x1234567, 0x89ABCDEF)
                    )
                    values = sketch(hashes, owners, count)
                    parts = values.reshape(count, BANDS, BAND_ROWS)
                    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (count, 1))
                    for k in range(BAND_ROWS):
                        keys = mix(keys * np.uint64(31) + parts[:, :, k])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, count),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "one", "two", "bands"],
                )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = [press.compress((x.as_py() or "").encode()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["node", "packed"])


def _forest(texts: list[bytes], names: list[int], words: int, percent: int) -> list[tuple[int, int]]:
    """Links that span the components of one block."""
    unpress = zstandard.ZstdDecompressor()
    sets = []
    with np.errstate(over="ignore"):
        for text in texts:
            data = np.frombuffer(unpress.decompress(text), np.uint8)
            sets.append(shingle_sets(data, np.array([0, len(data)]), words)[0])
    sizes = np.array([len(x) for x in sets])
    items = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(items, kind="stable")
    _, ids, counts = np.unique(items[order], return_inverse=True, return_counts=True)
    owners_by_item = owners[order]
    item_of = np.empty(len(items), np.int64)
    item_of[order] = ids
    firsts = np.concatenate(([0], np.cumsum(counts)))
    roots = list(range(len(sets)))

    def root(x: int) -> int:
        while roots[x] != x:
            roots[x] = roots[roots[x]]
            x = roots[x]
        return x

    links, low = [], 0
    for x, size in enumerate(sizes):
        mine = item_of[low : low + size]
        low += size
        mine = mine[counts[mine] > 1]
        common = np.zeros(len(sets), np.int64)
        # A shingle meets at most the block's sets, so a slice has a bounded number of meetings.
        width = max(1, MEETINGS // len(sets))
        for part in (mine[k : k + width] for k in range(0, len(mine), width)):
            lengths = counts[part]
            steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            common += np.bincount(owners_by_item[np.repeat(firsts[part], lengths) + steps], minlength=len(sets))
        alike = np.flatnonzero(100 * common >= percent * (size + sizes - common))
        for y in alike[alike > x]:
            a, b = root(x), root(int(y))
            if a != b and names[a] != names[b]:
                roots[a] = b
                links.append((names[x], names[y]))
    return links


def _blocks(words: int, percent: int):
    """Rows (cluster, unit, node, packed) in order of cluster and unit to links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, texts = None, [], []

        def links() -> pa.RecordBatch:
            found = _forest(texts, names, words, percent) if len(names) > 1 else []
            columns = [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            for cluster, unit, node, packed in zip(*(batch.column(k) for k in range(4)), strict=True):
                now = (cluster.as_py(), unit.as_py())
                if now != key:
                    yield links()
                    key, names, texts = now, [], []
                if node.as_py() not in names[-1:]:
                    names.append(node.as_py())
                    texts.append(packed.as_py())
        yield links()

    return run


def _block_links(units: DataFrame, words: int, percent: int) -> DataFrame:
    rows = units.select("cluster", "unit", "node", "packed").repartition("cluster", "unit")
    rows = rows.sortWithinPartitions("cluster", "unit", "node")
    return map_batches(rows, _blocks(words, percent), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Sets that share at least ``percent`` in a hundred of their union are linked;
    a document of fewer than ``words`` words is one shingle; without words it is
    linked with nothing. ``component_id`` is the smallest id reachable. Repeated
    rows are copies of one document. Null text counts as empty, and a row with a
    null id is linked with nothing and kept. An empty table gives no rows. Other
    columns are not read.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    signed = stage(
        map_batches(
            docs,
            _signatures(words),
            "doc_id long, n_shingles long, one long, two long, bands array<long>",
        ),
        "near-signatures",
    )
    live = signed.where("n_shingles > 0 and doc_id is not null")
    classes = stage(
        live.groupBy("one", "two", "n_shingles").agg(F.min("doc_id").alias("node")).withColumnRenamed("n_shingles", "n"),
        "near-classes",
    )
    first = live.join(
        classes,
        (live.one == classes.one) & (live.two == classes.two) & (live.n_shingles == classes.n) & (live.doc_id == classes.node),
        "left_semi",
    ).dropDuplicates(["doc_id"])
    banded = first.select(F.col("doc_id").alias("node"), "n_shingles", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("low")).where("members > 1")
    chained = banded.join(shared, "key").groupBy("node", "low").agg(F.sum("members").alias("score"), F.first("n_shingles").alias("n"))
    chained = stage(chained, "near-chained")
    clusters = connected_components(chained.select(F.col("node").alias("a"), F.col("low").alias("b")), "near-clusters")
    clusters = clusters.union(clusters.select("component", "component").distinct())
    scores = chained.groupBy("node").agg(F.sum("score").alias("score"), F.max("n").alias("n"))
    members = stage(scores.join(clusters.withColumnRenamed("component", "cluster"), "node"), "near-members")
    blocks = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    )
    placed = members.join(blocks, "cluster").withColumn("unit", F.pmod(F.xxhash64("node"), F.col("blocks")))
    several = placed.where("blocks > 1")
    hubs = several.groupBy("cluster", "blocks", F.pmod(F.xxhash64("node"), F.lit(HUBS)).alias("slot")).agg(
        F.max(F.struct("score", "node")).alias("hub")
    )
    hubs = hubs.select(F.col("hub.node").alias("node"), "cluster", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("unit"))
    rows = placed.select("node", "cluster", "blocks", "unit", F.lit(False).alias("hub"))
    rows = rows.unionByName(hubs.withColumn("hub", F.lit(True)))
    texts, _ = split_by_ids(docs, members.select(F.col("node").alias("doc_id")), _packed, "node long, packed binary")
    units = stage(texts.join(rows, "node"), "near-units")
    links = stage(_block_links(units, words, percent), "near-links")
    components = stage(connected_components(links, "near"), "near-components")

    spread = units.where("blocks > 1 and not hub").join(components, "node", "left")
    spread = spread.withColumn("component", F.coalesce("component", "node"))
    main = spread.groupBy("cluster", "component").agg(F.count("*").alias("nodes"))
    main = main.groupBy("cluster").agg(F.max_by("component", F.struct("nodes", "component")).alias("main"))
    spread = spread.join(main, "cluster").withColumn("minor", F.col("component") != F.col("main"))
    minors = spread.groupBy("cluster").agg(F.ceil(F.count_if("minor") / BLOCK_NODES).alias("minor_blocks")).where("minor_blocks > 0")
    spread = spread.join(minors, "cluster")
    columns = ["cluster", "node", "packed"]
    each_minor = F.explode(F.sequence(F.lit(0).cast("long"), F.col("minor_blocks") - 1))
    each_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    place = F.col("i") * F.col("blocks") + F.col("j")
    all_rows = spread.select(*columns, "blocks", F.col("unit").alias("j"), each_minor.alias("i"))
    minor_rows = spread.where("minor").select(
        *columns, "blocks", F.pmod(F.xxhash64("node", F.lit(1)), F.col("minor_blocks")).alias("i"), each_block.alias("j")
    )
    meetings = all_rows.unionByName(minor_rows).select(*columns, place.alias("unit"))
    more = stage(_block_links(meetings, words, percent), "near-links")
    if not more.isEmpty():
        components = stage(connected_components(links.union(more), "near"), "near-components")
    out = signed.select("doc_id", "n_shingles", "one", "two")
    names = classes.select(F.col("one").alias("c1"), F.col("two").alias("c2"), "n", "node")
    out = out.join(names, (out.one == names.c1) & (out.two == names.c2) & (out.n_shingles == names.n), "left")
    out = out.join(components, "node", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(
        F.col("n_shingles") > 0, F.coalesce("component", "node")
    ).otherwise(F.col("doc_id"))
    return out.select(
        F.col("doc_id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
