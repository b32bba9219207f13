"""Periodic runs against a search of all periods and stretches."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridlake.llm import periodic_runs, queries

CASES = {
    1: "",
    2: None,
    3: "a " * 50,
    4: "a b " * 10,
    5: " ".join(f"w{i % 9}" for i in range(200)),
    6: "x y z " * 3 + "q " + "x y z " * 5,
    7: "\t one\ntwo\x0bthree " * 20 + "tail é ü",
    8: "a b a b a b a b a b a",
    9: " ".join(bin(i).count("1") % 2 and "u" or "v" for i in range(700)),
    10: "lone",
}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words, least=12):
    """(start, length, period) of all runs, by start, then period."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        start = None
        for i in range(len(words) - q + 1):
            same = i < len(words) - q and words[i] == words[i + q]
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i - start + q
                if length >= max(least, 2 * q):
                    best.setdefault((start, length), q)
                start = None
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def brute_plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def check(rows, texts):
    assert len(rows) == len(texts)
    for row in rows:
        words = words_of(texts[row["doc_id"]])
        expected = brute_runs(words)
        assert [tuple(r) for r in row["runs"]] == expected, row["doc_id"]
        assert row["collapsed"] == brute_collapse(words, expected), row["doc_id"]


def test_cases(spark):
    docs = spark.createDataFrame(list(CASES.items()), "doc_id long, text string")
    check(periodic_runs.periodic_runs(docs).collect(), CASES)


def test_random_texts_and_small_tiles(spark, monkeypatch):
    """Few different words, and planted copies; tiles so small that every run is stitched."""
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", 24)
    draw = random.Random(5)
    texts = {}
    for k in range(60):
        words = [draw.choice("abc") for _ in range(draw.randrange(400))]
        for _ in range(3):
            if words:
                at, size = draw.randrange(len(words)), draw.randrange(1, 90)
                words[at:at] = words[at : at + size] * draw.randrange(1, 6)
        texts[k] = " ".join(words)
    # In this process the small tiles hold; the tasks of Spark take the usual ones.
    for text in texts.values():
        words = periodic_runs.number_words(text)
        found = {}
        low = 1
        while max(2 * low, 12) <= len(words):
            spacing, reach, owned = periodic_runs.octave(low, 12)
            tiles, firsts = [], []
            owned = max(spacing, 24 - 24 % spacing)
            for start in range(0, len(words) - low, owned):
                lead = min(start, reach)
                tiles.append((lead, owned, words[start - lead : start + owned + reach + 2 * low]))
                firsts.append(start - lead)
            for tile, q, start, end in zip(*periodic_runs.boundary_fragments(tiles, low, 12), strict=True):
                found.setdefault(int(q), []).append((int(start) + firsts[tile], int(end) + firsts[tile]))
            low *= 2
        best = {}
        for q in sorted(found):
            merged = []
            for start, end in sorted(found[q]):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([start, end])
            for start, end in merged:
                if end - start + q >= max(12, 2 * q):
                    best.setdefault((start, end - start + q), q)
        assert sorted((s, n, q) for (s, n), q in best.items()) == sorted(brute_runs(words.tolist()))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(periodic_runs.periodic_runs(docs).collect(), texts)


def test_long_text_over_many_tiles(spark):
    draw = random.Random(8)
    block = [str(draw.randrange(50)) for _ in range(3000)]
    words = [str(draw.randrange(900)) for _ in range(9000)] + block * 4 + ["z"] * 9000
    row = periodic_runs.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    runs = [tuple(r) for r in row["runs"]]
    assert (9000, 12000, 3000) in runs and (21000, 9000, 1) in runs
    assert row["collapsed"] == brute_collapse(words, runs)


def test_odd_tables(spark):
    rows = [(1, "a b " * 9, "clash", 0), (1, "a b " * 9, "clash", 0), (1, "other text", "x", 1), (None, "a " * 12, None, 2), (None, None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, key long")
    out = periodic_runs.periodic_runs(docs)
    assert sorted(((r[0], len(r["runs"]), r["collapsed"]) for r in out.collect()), key=str) == sorted(
        [(1, 1, "a b"), (1, 1, "a b"), (1, 0, "other text"), (None, 1, "a"), (None, 0, "")], key=str
    )
    assert out.columns == ["doc_id", "runs", "collapsed"]
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").where(F.length("text") < 12000)
    texts = {r[0]: r[1] for r in docs.collect()}
    checked = 0
    for row in queries.op11_periodic_runs(spark, path).collect():
        if row["doc_id"] not in texts:
            continue
        words = brute_plant(row["doc_id"], words_of(texts[row["doc_id"]]))
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest()
        checked += 1
    assert checked > 100


def test_one_python_worker_per_task(spark, monkeypatch):
    """Every stage passes its rows through Python once: no worker feeds another."""
    plans = []
    write = periodic_runs.stage

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(periodic_runs, "stage", noted)
    table = spark.createDataFrame(list(CASES.items()), "doc_id long, text string")
    out = periodic_runs.periodic_runs(table)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and "MapInArrow" in plans[0]
    for plan in plans:
        open_at = []
        for line in plan.splitlines():
            at = len(line) - len(line.lstrip(" :+-"))
            open_at = [(d, kind) for d, kind in open_at if d < at]
            kind = line.lstrip(" :+-").split(" ")[0]
            inside = [k for _, k in open_at]
            last = inside[len(inside) - inside[::-1].index("Exchange") :] if "Exchange" in inside else inside
            assert not (kind == "MapInArrow" and "MapInArrow" in last), plan
            open_at.append((at, kind))
    got = {r.doc_id: (len(r.runs), r.collapsed) for r in out.collect()}
    for doc_id, text in CASES.items():
        runs = brute_runs(words_of(text))
        assert got[doc_id] == (len(runs), brute_collapse(words_of(text), runs))
