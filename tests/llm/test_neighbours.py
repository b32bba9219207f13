"""Neighbours on pruned graphs against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import neighbours, queries


def brute(ids, vectors, wanted, keep):
    """query -> [(rank, id, score)] over all rows but the query's own."""
    ids, vectors = np.array(ids), np.array(vectors, np.float32).astype(np.float64)
    out = {}
    for at in np.flatnonzero(np.isin(ids, wanted)):
        score = (vectors * vectors[at]).sum(axis=1)
        order = [k for k in np.lexsort((ids, -score)) if k != at][:keep]
        out[int(ids[at])] = [(r + 1, int(ids[k]), float(score[k])) for r, k in enumerate(order)]
    return out


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def recall(found, true):
    hits = sum(len({x[1] for x in found.get(q, [])} & {x[1] for x in rows}) for q, rows in true.items())
    return hits / sum(len(rows) for rows in true.values())


def test_prune_keeps_diverse_edges():
    # Two points in a row to the right and one above: the second on the right is covered by the first.
    vectors = np.array([[0, 0], [1, 0], [1.5, 0], [0, 2]], np.float32)
    kept = neighbours.robust_prune(vectors, np.array([0]), np.array([[1, 2, 3, 1, 0, -1]]), 3, 1.2)
    assert kept.tolist() == [[1, 3, -1]]


def test_every_node_is_reached_and_found():
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 8)) * 40  # far clusters
    vectors = (centres[draw.integers(0, 12, 900)] + draw.normal(size=(900, 8))).astype(np.float32)
    graph = neighbours.build_graph(vectors, degree=8, beam=16)
    met, _ = neighbours.beam_search(graph, vectors[:5], 900)
    assert all(sorted(row) == list(range(900)) for row in met.tolist())


def test_few_rows_come_back_whole(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [1.0, 0.0]), (4, [-1.0, 0.0]), (5, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = grouped(neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0, shard_nodes=2).collect())
    assert out == brute([r[0] for r in rows], [r[1] for r in rows], [0, 20], 20)
    assert [x[1] for x in out[0]] == [5, 3, 20, 4]


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0], "q", 1), (0, [1.0, 2.0], "q", 2), (1, [1.0, 2.0], None, 0), (2, None, "x", 0), (3, [0.0, 0.0], "x", 0),
        (4, [1.0, None], "x", 0), (5, [nan, 1.0], "x", 0), (6, [inf, 1.0], "x", 0), (None, [1.0, 1.0], "x", 0), (7, [], "x", 0),
        (20, [1.0, 0.0, 0.0], "x", 0), (21, [0.5, 0.0, 0.0], "x", 0), (40, None, "x", 0), (60, [-0.0, 3.0], "x", 0), (61, [0.0, 3.0], "x", 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, ids string, rank int")
    out = grouped(neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect())
    assert out == {
        0: [(1, 60, 6.0), (2, 61, 6.0), (3, 1, 5.0)],
        20: [(1, 21, 0.5)],
        60: [(1, 61, 9.0), (2, 0, 6.0), (3, 1, 6.0)],
    }
    assert neighbours.nearest_neighbours(df.limit(0), F.lit(True)).count() == 0


def test_copies_are_ranked_by_id(spark):
    """One vector under a third of all ids: the smallest ids are the nearest."""
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(900, 6)).astype(np.float32)
    vectors[300:600] = vectors[300]
    ids = draw.permutation(900)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>")
    out = grouped(neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0, shard_nodes=150).collect())
    true = brute(ids, vectors, list(range(0, 900, 20)), 20)
    assert recall(out, true) >= 0.99
    hot = int(min(i for i in ids[300:600] if i % 20 == 0))
    copies = sorted(int(i) for i in ids[300:600] if i != hot)
    if true[hot][0][1] in copies[:1]:
        assert [x[1] for x in out[hot]] == [x[1] for x in true[hot]]


@pytest.mark.parametrize("shard_nodes", [neighbours.SHARD_NODES, 300])
def test_recall_on_given_table(spark, shard_nodes):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    pairs = [(r[0], r[1]) for r in table.select("vec_id", "embedding").collect()]
    true = brute([p[0] for p in pairs], [p[1] for p in pairs], [p[0] for p in pairs if p[0] % 20 == 0], 20)
    found = grouped(neighbours.nearest_neighbours(table, F.col("vec_id") % 20 == 0, shard_nodes=shard_nodes).collect())
    assert found.keys() == true.keys() and all(len(x) == 20 for x in found.values())
    assert recall(found, true) >= 0.95
    scores = {(q, x[1]): x[2] for q, rows in true.items() for x in rows}
    assert all(abs(scores[q, x[1]] - x[2]) < 1e-12 for q, rows in found.items() for x in rows if (q, x[1]) in scores)


def test_query(spark):
    out = queries.op13_neighbours(spark, "/root/testdata/sf0.001")
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert out.count() == 25 * 20
