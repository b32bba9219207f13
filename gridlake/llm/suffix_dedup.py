"""Repeated byte strings by distributed prefix doubling.

Positions and the ranks of the strings that start there are sorted by Spark at
growing lengths; a rank that is unique leaves, and the rest goes on until the length
reaches the threshold. All positions of a corpus are too many to sort, so the first
lengths are ranked at anchor positions only (see ``windows``): 16 bytes, then 33 to
either side. What is left are the places where repeated passages begin and end; there
every position is ranked, by 25 bytes and then by the pair of ranks at offset 25; where a
string of 16 bytes has more than ``Shape.hot`` surroundings, by 50 bytes at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridlake.llm.common import Prefixes, byte_values
from gridlake.llm.windows import Shape, remove_repeats, whole_ranks

THRESHOLD = 50
SHAPE = Shape(window=THRESHOLD, k=16, words=False, hot=20_000)


def _earlier(window: int):
    """Windows of undecided runs that also start in a smaller document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = window // 2
        for rows in whole_ranks(batches):
            sizes = np.array([len(r[5]) for r in rows])
            counts = np.array([r[4] for r in rows])
            begin = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(rows)), counts)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            place = begin[owner] + step
            with np.errstate(over="ignore"):
                names = Prefixes(byte_values(np.frombuffer(b"".join(r[5] for r in rows), np.uint8)))
                near = names.of(place, place + half)
                # Positions whose first half is unique leave; the rest is ranked by pairs.
                _, group, many = np.unique(near, return_inverse=True, return_counts=True)
                live = many[group] > 1
                owner, step, place, near = owner[live], step[live], place[live], near[live]
                pair = near * np.uint64(0x9E3779B97F4A7C15) + names.of(place + half, place + window)
            doc = np.array([r[2] for r in rows], np.int64)
            mine = doc[owner] if len(owner) else np.zeros(0, np.int64)
            order = np.lexsort((mine, pair))
            new = np.ones(len(order), bool)
            new[1:] = pair[order][1:] != pair[order][:-1]
            firsts = np.flatnonzero(new)
            low = np.repeat(mine[order][firsts], np.diff(np.append(firsts, len(order))))
            again = order[mine[order] > low]
            bits = np.zeros(len(rows), np.int64)
            np.bitwise_or.at(bits, owner[again], np.int64(1) << step[again])
            hit = np.flatnonzero(bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[hit]), pa.array(np.array([r[1] for r in rows], np.int64)[hit]), pa.array(bits[hit])],
                names=["doc_id", "run", "bits"],
            )

    return run


def remove_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shape: Shape = SHAPE) -> DataFrame:
    """One row per document: doc_id, n_units (bytes), n_removed, n_spans, kept (binary).

    Texts are UTF-8 bytes. Every byte goes that a string of the threshold length covers
    which also starts in a document with a smaller id; strings never cross documents and
    are judged on the input. Null counts as empty and shorter texts stay; copies under one
    id are one document; a row with a null id stays whole and is no source. An empty table
    gives no rows. Extra columns are not read.
    """
    return remove_repeats(docs, shape, _earlier(shape.window), id_column, text_column)
