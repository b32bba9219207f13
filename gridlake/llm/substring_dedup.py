"""Repeated word windows by suffix automata over shards of reference text.

Sending automata of the whole corpus to every task would make the work grow with the
square of the corpus. So the reference is first cut to the passages that can matter
(see ``windows``): runs of words around anchors that several documents share in
different surroundings. They are dealt into shards by the rank of their anchor; ranks of
more than ``Shape.hot`` runs are decided window by window instead. A task
builds the automaton of a shard, each state knowing the smallest document that holds
its strings, and streams the shard's passages through it: the matching statistics give
at each word the longest match, shortened along suffix links to the window's length, and
so whether the window also starts in an earlier document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridlake.llm.windows import Shape, remove_repeats, whole_ranks

WINDOW = 13
SHAPE = Shape(window=WINDOW, k=4, words=True, hot=2_500)
# Words of a shard's automaton, give or take one rank of at most SHAPE.hot runs; it bounds the memory of a task.
SHARD_WORDS = 60_000


class SuffixAutomaton:
    """All substrings of several sequences; ``low`` of a state is the smallest owner of its strings."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.low = [-1], [0], [None]

    def _state(self, edges: dict[int, int], link: int, length: int, low) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.low.append(low)
        return len(self.next) - 1

    def _split(self, parent: int, symbol: int, child: int) -> int:
        """The state of the strings of ``child`` that are at most one longer than ``parent``."""
        clone = self._state(dict(self.next[child]), self.link[child], self.length[parent] + 1, None)
        self.link[child] = clone
        while parent >= 0 and self.next[parent].get(symbol) == child:
            self.next[parent][symbol] = clone
            parent = self.link[parent]
        return clone

    def add(self, sequence: Sequence[int], owner: int) -> None:
        """Add a sequence; owners must come in ascending order."""
        last = 0
        for symbol in sequence:
            child = self.next[last].get(symbol)
            if child is not None:
                if self.length[child] != self.length[last] + 1:
                    child = self._split(last, symbol, child)
                last = child
            else:
                state = self._state({}, 0, self.length[last] + 1, None)
                parent = last
                while parent >= 0 and symbol not in self.next[parent]:
                    self.next[parent][symbol] = state
                    parent = self.link[parent]
                if parent >= 0:
                    child = self.next[parent][symbol]
                    if self.length[child] != self.length[parent] + 1:
                        child = self._split(parent, symbol, child)
                    self.link[state] = child
                last = state
            if self.low[last] is None or owner < self.low[last]:
                self.low[last] = owner

    def close(self) -> None:
        """Owners of a state also own the strings of its suffix links."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            parent, low = self.link[state], self.low[state]
            if parent > 0 and low is not None and (self.low[parent] is None or low < self.low[parent]):
                self.low[parent] = low

    def first_owners(self, sequence: Sequence[int], window: int) -> list[int | None]:
        """For each window of ``sequence`` the smallest owner of its words, if any."""
        state, size, owners = 0, 0, []
        for i, symbol in enumerate(sequence):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state, size = self.next[state][symbol], size + 1
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
                size = self.length[state]
            if i >= window - 1:
                owners.append(self.low[state] if size >= window else None)
        return owners


def _earlier(window: int):
    def resolve(rows: list[tuple]) -> pa.RecordBatch:
        automaton = SuffixAutomaton()
        passages = [(doc, name, np.frombuffer(around, np.int64).tolist()) for _, name, doc, _, _, around in rows]
        for doc, _, units in sorted(passages, key=lambda p: p[0]):
            automaton.add(units, doc)
        automaton.close()
        found = []
        for doc, name, units in passages:
            bits = 0
            for i, owner in enumerate(automaton.first_owners(units, window)):
                if owner is not None and owner < doc:
                    bits |= 1 << i
            if bits:
                found.append((doc, name, bits))
        columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "run", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_ranks(batches):
            shard, words = [], 0
            for i, row in enumerate(rows):
                if words >= SHARD_WORDS and row[0] != rows[i - 1][0]:
                    yield resolve(shard)
                    shard, words = [], 0
                shard.append(row)
                words += len(row[5]) // 8
            yield resolve(shard)

    return run


def remove_repeated_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shape: Shape = SHAPE) -> DataFrame:
    """One row per document: doc_id, n_units (words), n_removed, n_spans, kept (binary: words joined by a space).

    Every word goes that lies in a window of words which also starts in a document with
    a smaller id; windows are judged on the input. Words are runs of anything but ASCII
    white space. Null counts as empty and shorter texts stay; copies under one id are one
    document; a row with a null id stays whole and is no source. An empty table gives no
    rows. Extra columns are not read.
    """
    return remove_repeats(docs, shape, _earlier(shape.window), id_column, text_column)
