"""Passages that stand in thousands of surroundings."""

import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from brute_text import brute_repeats, words_of

from gridlake.llm import substring_dedup, suffix_dedup, windows

LINE = "this one line of words stands in very many documents between others, each its own"


@pytest.fixture(scope="module")
def crowd(spark):
    """A line in 1500 surroundings; some share a neighbour, some have it twice, some a part of it."""
    rng = random.Random(7)
    table = []
    for i in range(1500):
        words = [f"{rng.choice('abc')}{rng.randrange(10**6)}" for _ in range(24)]
        before = ["common", "neighbour", "here"] if i % 50 == 1 else []
        line = LINE if i % 7 else " ".join(LINE.split()[: 13 + i % 3])
        again = [line] if i % 90 == 4 else []
        table.append((5000 - i if i % 2 else i, " ".join([*words[:12], *before, line, *words[12:], *again])))
    return spark.createDataFrame(table, "doc_id long, text string").repartition(6)


def bounded(resolve, hot):
    """``resolve`` that fails where a rank has more rows than ``hot``."""

    def run(batches):
        def watched():
            sizes = Counter()
            for batch in batches:
                sizes.update(batch.column(0).to_pylist())
                assert max(sizes.values()) <= hot, "a rank is held whole"
                yield batch

        yield from resolve(watched())

    return run


@pytest.mark.parametrize("hot", [40, 10**6])
def test_hot_bytes(crowd, hot):
    rows = {r.doc_id: r.text.encode() for r in crowd.collect()}
    want = brute_repeats(list(rows.items()), 50)
    shape = replace(suffix_dedup.SHAPE, hot=hot)
    got = windows.remove_repeats(crowd, shape, bounded(suffix_dedup._earlier(50), hot), "doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in got:
        assert bytes(r.kept) == bytes(b for i, b in enumerate(rows[r.doc_id]) if i not in want[r.doc_id])
    assert sum(r.n_removed for r in got) > 1000 * 50


@pytest.mark.parametrize("hot", [40, 10**6])
def test_hot_words(crowd, hot):
    rows = {r.doc_id: tuple(words_of(r.text)) for r in crowd.collect()}
    want = brute_repeats(list(rows.items()), 13)
    shape = replace(substring_dedup.SHAPE, hot=hot)
    got = windows.remove_repeats(crowd, shape, bounded(substring_dedup._earlier(13), hot), "doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in got:
        assert bytes(r.kept).decode() == " ".join(w for i, w in enumerate(rows[r.doc_id]) if i not in want[r.doc_id])
    assert sum(r.n_removed for r in got) > 1000 * 13


@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_one_id_over_several_texts(spark, kind):
    """Ids 0 to 9 have one text, 10 to 29 two or three with parts of earlier ones, some of them twice."""
    rng = random.Random(3)

    def fresh(n):
        return [f"{rng.choice('xyz')}{rng.randrange(10**6)}" for _ in range(n)]

    base = [fresh(60) for _ in range(10)]
    table = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i in range(10, 30):
        for _ in range(2 + i % 2):
            at, size = rng.randrange(30), rng.randrange(13, 30)
            part = rng.choice(base)[at : at + size]
            table.append((i, " ".join([*fresh(15), *part, *fresh(9)])))
            base.append(table[-1][1].split())
        if i % 3 == 0:
            table.append(table[-1])
    shape, earlier, window, units = {
        "bytes": (suffix_dedup.SHAPE, suffix_dedup._earlier, 50, lambda t: t.encode()),
        "words": (substring_dedup.SHAPE, substring_dedup._earlier, 13, lambda t: tuple(words_of(t))),
    }[kind]
    first = {}
    for doc, text in table:
        u = units(text)
        for i in range(len(u) - window + 1):
            first[u[i : i + window]] = min(first.get(u[i : i + window], doc), doc)

    def kept(doc, text):
        u, covered = units(text), set()
        for i in range(len(u) - window + 1):
            if first[u[i : i + window]] < doc:
                covered.update(range(i, i + window))
        left = [x for i, x in enumerate(u) if i not in covered]
        return bytes(left) if kind == "bytes" else " ".join(left).encode()

    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    got = windows.remove_repeats(docs, shape, earlier(window), "doc_id", "text").collect()
    assert sorted((r.doc_id, bytes(r.kept)) for r in got) == sorted((d, kept(d, t)) for d, t in table)
    assert sum(r.n_removed for r in got) > 20 * window


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_hot_rank_is_not_held(size):
    """Rank 1 has 6 runs, rank 2 has 5; every run's first document comes once, in one state."""
    table = [(1, run, run << 16 | 5, doc) for run in range(6) for doc in (3, 4)]
    table += [(2, run, 7 << 16 | run, run + 1) for run in range(5)] + [(3, 0, 0, 1)]
    columns = [np.array(c) for c in zip(*table, strict=True)]
    kinds = (np.int64, np.int64, np.int32, np.int64)
    arrays = [pa.array(c.astype(kind)) for c, kind in zip(columns, kinds, strict=True)]
    whole = pa.RecordBatch.from_arrays(arrays, names=["rank", "run", "sides", "doc_id"])
    cut = [whole.slice(i, size) for i in range(0, len(table), size)]
    got = sorted((r["state"], r["rank"], r["run"], r["doc_id"]) for b in windows._rerank(5)(iter(cut)) for r in b.to_pylist())
    want = [(windows.REPEATED, 1, run, 4) for run in range(6)]
    want += [(windows.OPEN, 2, run, run + 1) for run in range(5)] + [(windows.HOT, 1, run, 3) for run in range(6)]
    assert got == sorted(want)
