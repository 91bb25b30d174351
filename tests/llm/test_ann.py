import __spark_entry__ as contract
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import ann


def exact(rows, queries, k):
    """{query: [(id, cosine)]}, ties to the smaller id."""
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) and i is not None]
    out = {}
    for q, x in good:
        if q in queries:
            near = sorted({(-float(x @ y / np.sqrt((x @ x) * (y @ y))), i) for i, y in good if i != q and len(x) == len(y)})
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def recall(got, want):
    by = {}
    for r in got.orderBy("query_id", "rank").collect():
        by.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q, near in want.items():
        rows = by.get(q, [])
        assert [r.rank for r in rows] == list(range(1, len(near) + 1))
        assert all(a.score > b.score or a.score == b.score and a.vec_id < b.vec_id for a, b in zip(rows, rows[1:]))
        if near:
            hits += sum(r.score >= near[-1][1] - 1e-12 for r in rows)
            total += len(near)
    assert set(by) == {q for q, near in want.items() if near}
    return hits / total if total else 1.0


def test_query_recall(spark, table):
    rows = [(r.vec_id, r.embedding) for r in table("embeddings").collect()]
    want = exact(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    assert recall(contract.queries()["op1_nearest_vectors"](spark, SF), want) >= 0.95


def test_shards_and_copies(spark, clash):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(900)]
    rows += [(i, rows[7][1]) for i in range(1000, 1300)]  # a third are copies
    rows += [(i, [2 * x for x in rows[9][1]]) for i in range(1300, 1310)]
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = ann.neighbours(df, F.col("id") % 100 < 10, k=5, shard_size=200)
    want = exact(rows, {i for i, _ in rows if i % 100 < 10}, 5)
    assert recall(got, want) >= 0.95
    assert [r.vec_id for r in got.where("query_id = 7").orderBy("rank").collect()] == [1000, 1001, 1002, 1003, 1004]


def test_unusable_vectors_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0, 0.0]),
            (8, []), (None, [1.0, 0.1]), (9, [2.0, 0.0]), (9, [2.0, 0.0]), (10, [1.0])]
    got = ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.lit(True), k=5)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got.collect()) == [(0, 1, 9), (0, 2, 1), (1, 1, 0), (1, 2, 9), (9, 1, 0), (9, 2, 1)]


@pytest.mark.parametrize("schema", ["vec_id long, embedding array<float>"])
def test_empty(spark, schema):
    assert ann.neighbours(spark.createDataFrame([], schema), F.lit(True)).count() == 0


def test_pruning_keeps_diverse_edges():
    unit = np.array([[1, 0], [0.99, 0.14], [0.98, 0.199], [0, 1], [-1, 0]], float)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    kept = ann.robust_prune(unit, np.array([0]), np.array([[1, 2, 3, 4, 0, -1]]), 3)
    assert kept[0].tolist()[:2] == [1, 3] and 2 not in kept


def test_a_third_of_the_vectors_are_multiples_of_one(spark):
    """Multiples have the cosine 1 (to rounding): a query among them finds only them."""
    r = np.random.default_rng(5)
    base = r.normal(size=16)
    rows = [(i, (r.normal(size=16)).tolist()) for i in range(300)]
    rows += [(1000 + i, (base * (i + 1) * 0.37).tolist()) for i in range(150)] + [(5000, (base * 1e200).tolist()), (5001, (base * 1e-200).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.neighbours(df, F.col("id") % 50 == 0, shard_size=64).collect()
    vectors = {i: ann.units(np.array(v)) for i, v in rows}
    found = {}
    for x in got:
        found.setdefault(x.query_id, []).append(x)
        assert abs(x.score - vectors[x.query_id] @ vectors[x.vec_id]) < 1e-12
    for q, hits in found.items():
        exact = sorted((-(vectors[q] @ v) for i, v in vectors.items() if i != q))[:5]
        assert len(hits) == 5 and len({h.vec_id for h in hits}) == 5
        if q >= 1000:
            assert all(h.score > 1 - 1e-9 and h.vec_id >= 1000 for h in hits)
        close = sum(-e <= h.score + 1e-9 for e, h in zip(exact, sorted(hits, key=lambda h: h.rank)))
        assert close >= 4
