"""Vector joins and top-k against all pairs."""

import numpy as np
import pytest

from tests.llm.test_simhash import plain_roots
from wicketworks.llm import grid_join, topk
from wicketworks.llm.grid_join import near_vectors
from wicketworks.llm.topk import top_k

VECTORS = "vec_id bigint, embedding array<float>, label int"


def edge_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(90):
        v = centres[i % 6] + rng.normal(size=8) * (0.25 if i % 2 else 1.0)
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 3))
    nan, inf = float("nan"), float("inf")
    rows += [(200, None, 1), (201, [0.0] * 8, None), (202, [1.0, None, *[0.0] * 6], 1), (203, [nan] * 8, 1), (204, [inf, *[0.0] * 7], 1), (205, [], 0)]
    rows += [rows[3], (206, rows[5][1], 0), (207, rows[5][1], 0), (None, rows[5][1], 0), (208, [1.0, 2.0], 0), (209, [2.0, 4.0], 0), (220, [1e30] * 8, 1), (240, [2e30] * 8, 1)]
    return spark.createDataFrame(rows, VECTORS)


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def widened(v):
    return np.array([*v, *[0.0] * (8 - len(v))])


def plain_links(rows):
    vectors = [widened(r.embedding) if usable(r.embedding) and any(r.embedding) else None for r in rows]
    units = [None if v is None else v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for v in vectors]

    def linked(a, b):
        return units[a] is not None and units[b] is not None and units[a] @ units[b] >= 0.9

    roots = plain_roots(range(len(rows)), linked)
    least = {}
    for i, r in enumerate(rows):
        if r.vec_id is not None:
            least[roots[i]] = min(least.get(roots[i], r.vec_id), r.vec_id)
    out = []
    for i, r in enumerate(rows):
        n = sum(linked(i, j) for j in range(len(rows)) if j != i)
        out.append((r.vec_id, n, least.get(roots[i]), r.vec_id == least.get(roots[i])))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_rows,strip_rows", [(4096, 512), (7, 3), (1, 1)])
def test_links_of_edge_vectors(spark, monkeypatch, block_rows, strip_rows):
    monkeypatch.setattr(grid_join, "STRIP_ROWS", strip_rows)
    vectors = edge_vectors(spark)
    for df in (vectors, vectors.selectExpr("*", "1L AS class", "'x' AS node", "2 AS n", "3 AS root")):
        got = near_vectors(df, block_rows=block_rows)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted(map(tuple, got.collect()), key=str) == plain_links(vectors.collect())
        if block_rows == 1:
            break


def test_pairs_of_intervals_cross_exchanges_without_their_vectors(spark, monkeypatch):
    """What is dealt for a pair has a fixed size, whatever its intervals hold, and pairs are dealt over many tasks."""
    dealt = {}

    def noted(df, name):
        if name == "grid-links":
            dealt["row"] = df._jdf.queryExecution().analyzed().children().apply(0).schema().simpleString()
            dealt["tasks"] = df.rdd.getNumPartitions()
        return plain(df, name)

    plain = grid_join.materialize
    monkeypatch.setattr(grid_join, "materialize", noted)
    vectors = edge_vectors(spark)
    assert sorted(map(tuple, near_vectors(vectors, block_rows=7).collect()), key=str) == plain_links(vectors.collect())
    assert dealt["row"] == "struct<a:bigint,b:bigint,left:string,right:string>"
    assert dealt["tasks"] > 1


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    assert near_vectors(spark.createDataFrame([(1, None, 1), (2, None, 1)], VECTORS)).count() == 2
    assert top_k(spark.createDataFrame([], VECTORS)).count() == 0


def plain_top_k(rows, k, every):
    rows = [r for r in rows if r.vec_id is not None and usable(r.embedding)]
    whole = [[int(np.floor(64 * x)) if abs(x) < 1e9 else None for x in map(float, r.embedding)] for r in rows]
    out = []
    for q, v in zip(rows, whole):
        if q.vec_id % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), r.vec_id) for r, w in zip(rows, whole) if r.vec_id != q.vec_id)
        out += [(q.vec_id, i + 1, d, -s) for i, (s, d) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows,k", [(2048, 20), (5, 3), (3, 500)])
def test_top_k_of_edge_vectors(spark, monkeypatch, block_rows, k):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    vectors = edge_vectors(spark).where("vec_id IS NULL OR vec_id NOT IN (220, 240)")
    for df in (vectors, vectors.selectExpr("*", "1L AS block", "'x' AS rank", "2 AS v", "3 AS score")):
        got = top_k(df, k=k, every=5)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == plain_top_k(vectors.collect(), k, 5)


def test_pruned_blocks_hold_no_result(spark, monkeypatch):
    """Clustered vectors, so that bounds fall below the k-th score."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(5 * np.eye(8)[i % 8] * (1 if i % 16 < 8 else -1) + rng.normal(size=8) / 10)], 0) for i in range(400)]
    vectors = spark.createDataFrame(rows, VECTORS)
    assert sorted(map(tuple, top_k(vectors, k=4, every=20).collect())) == plain_top_k(vectors.collect(), 4, 20)
