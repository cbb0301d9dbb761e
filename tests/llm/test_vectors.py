"""Nearest neighbours and exact top-k against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import ann, blocks, topk


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def vectors(n, dim, seed=1):
    x = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


ODD = [(9000, None), (9020, []), (9040, [1.0, None]), (9060, [float("nan")] * 8), (9080, [float("inf")] * 8), (9100, [0.0] * 8), (None, [1.0] * 8), (9120, [1.0, 2.0]), (9140, [1.0, 3.0])]


def brute_top(ids, z, k, every):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = z @ z[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


@pytest.mark.parametrize("bins", [512, 3])
def test_top_k_is_exact_with_ties(spark, monkeypatch, bins):
    monkeypatch.setattr(topk, "BINS", bins)
    monkeypatch.setattr(topk, "CANDIDATES_A_BLOCK", 100)
    monkeypatch.setattr(topk, "QUERIES_A_BLOCK", 7)
    x = vectors(700, 8)
    x[100:400] = x[100]  # a large group of copies
    ids = np.arange(700) * 2
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)]
    got = topk.exact_top_k(frame(spark, rows + [(i, v, 0) for i, v in ODD]).withColumn("score", F.lit("clash")), 5, 50).collect()
    z = np.floor(x.astype(float) * 256)
    want = brute_top(ids, z, 5, 50)
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    odd = {9100: by.pop(9100)}
    assert len(odd[9100]) == 5
    small = by
    assert {q: v for q, v in small.items() if q < 9000} == {q: [(i, int(s)) for i, s in v] for q, v in want.items()}


@pytest.mark.parametrize("size", [1e6, 1e7, 1e8, 1e14, 1e200, 1.7e308])
def test_top_k_of_huge_components(spark, size):
    """Whole numbers of any size, cut off at the ends of a long."""
    x = np.random.default_rng(8).normal(size=(120, 6))
    x[::7] *= size
    x[::7] = np.clip(x[::7], -1.79e308, 1.79e308)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 50).collect()
    with np.errstate(over="ignore"):
        z = [[int(v) for v in np.clip(np.floor(row * 256), -np.finfo(float).max, np.finfo(float).max)] for row in x]
    score = lambda i, j: max(-topk.MOST, min(topk.MOST, sum(a * b for a, b in zip(z[i], z[j], strict=True))))
    want = [(q, r, j, -s) for q in (0, 50, 100) for r, (s, j) in enumerate(sorted((-score(q, j), j) for j in range(120) if j != q)[:5], 1)]
    assert sorted(tuple(r) for r in got) == want


def test_top_k_of_few_rows(spark):
    got = topk.exact_top_k(frame(spark, [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (50, [-1.0, 0.0], 0), (100, [1.0], 0)]), 5, 50).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [(0, 1, 1, 32768), (0, 2, 50, -65536), (50, 1, 1, -32768), (50, 2, 0, -65536)]
    assert topk.exact_top_k(frame(spark, []), 5, 50).count() == 0


def test_queries_sent_to_many_places_are_not_broadcast(spark):
    """Spark sizes an exploded table as before the explode, so it would broadcast any number of copies."""
    v = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(40)], "id long, v array<double>, low long")
    q, c = blocks.pack(v.where("id % 10 = 0"), 1).persist(), blocks.pack(v, 1).persist()
    assert (q.count(), c.count()) == (4, 40)
    made = blocks.paired(q, c, 4, 30)
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
    got = [(blocks.unpack(r["q_ids"], r["q_data"], 2)[0][0], blocks.unpack(r["ids"], r["data"], 2)[0][0]) for r in made.collect()]
    assert sorted(got) == [(i, j) for i in range(0, 40, 10) for j in range(40)]


@pytest.mark.parametrize("values, width", [([1.0, -32768.0, 32767.0], 2), ([1.0, 32768.0, 0.5], 4), ([1.0, 2.0**24 + 1, 0.1], 8), ([1.0, 1e39, -1e300], 8)])
def test_blocks_hold_the_same_numbers_in_few_bytes(spark, values, width):
    r = blocks.pack(spark.createDataFrame([(7, values, 0)], "id long, v array<double>, low long"), 10).first()
    ids, data = blocks.unpack(r["ids"], r["data"], 3)
    assert (ids.tolist(), data.tolist(), len(r["data"])) == ([7], [values], 3 * width)


def test_nearest_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS_A_SHARD", 1000)
    x = vectors(3000, 32) * np.random.default_rng(2).uniform(0.5, 1.5, (3000, 1)).astype(np.float32)
    ids = np.arange(3000)
    got = ann.nearest(frame(spark, [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)]), 20, 20).collect()
    want = brute_top(ids, x.astype(float), 20, 20)
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append(r)
    assert by.keys() == want.keys() and all(len(v) == 20 for v in by.values())
    assert np.mean([len({r["vec_id"] for r in by[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.95
    for q, v in by.items():
        assert [r["score"] for r in v] == sorted((r["score"] for r in v), reverse=True)
        for r in v:
            assert r["score"] == pytest.approx(float(x[q].astype(float) @ x[r["vec_id"]].astype(float)), rel=1e-12)


def test_nearest_with_copies_and_odd_rows(spark):
    x = vectors(300, 8, 3)
    x[50:250] = x[50]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = ann.nearest(frame(spark, rows + [(i, v, 0) for i, v in ODD] + rows[:3]), 20, 20).collect()
    mine = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 60]
    assert mine == [i for i in range(50, 71) if i != 60]
    assert {r["query_id"] for r in got} == {*range(0, 300, 20), 9120, 9140}
    assert [(r["vec_id"], r["score"]) for r in got if r["query_id"] == 9120] == [(9140, 7.0)]
    assert ann.nearest(frame(spark, []), 20, 20).count() == 0


def test_nearest_when_a_querys_own_rows_crowd_a_vector(spark):
    v, w = [1.0, 2.0, 0.5], [0.2, 0.1, 0.0]
    rows = [(0, v)] * 60 + [(7, v), (8, v), (9, w)]
    got = sorted((r["rank"], r["vec_id"]) for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 20, 20).collect())
    assert got == [(1, 7), (2, 8), (3, 9)]
    many = [(i, v) for i in range(200)] + [(0, v)] * 50 + [(0, w)] * 50
    got = [r["vec_id"] for r in ann.nearest(spark.createDataFrame(many, "vec_id long, embedding array<double>"), 20, 1000).orderBy("rank").collect()]
    assert got == list(range(1, 21))


@pytest.mark.parametrize("size", [1e-200, 1e150, 1e200])
def test_nearest_of_very_large_and_small_vectors(spark, size):
    x = vectors(60, 5, 9).astype(float) * size
    got = ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), 3, 20).collect()
    assert len(got) == 9
    near = {q: [j for j in np.argsort(-((x / size) @ (x[q] / size))) if j != q][:3] for q in (0, 20, 40)}
    if 1e-150 < size < 1e160:  # else products pass the doubles, and ties go by id
        assert all([r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == near[q] for q in near)


def test_neighbours_across_shards_and_repeated_ids(spark, monkeypatch):
    """Seven shards against brute force; rows that repeat an id are candidates each, a query's own rows are none."""
    import numpy as np

    monkeypatch.setattr(ann, "ROWS_A_SHARD", 150)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1050, 12))
    ids = [*range(1000), *range(0, 1000, 20)]
    frame = spark.createDataFrame([(i, v.tolist(), 0.5) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>, score double")
    got = {}
    for r in ann.nearest(frame, k=20, every=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 1000, 20))
    hits = 0
    for q, found in got.items():
        own = min((x[i].tolist() for i in range(1050) if ids[i] == q))
        best = sorted(((-float(np.dot(own, x[i])), ids[i]) for i in range(1050) if ids[i] != q))[:20]
        assert [r for r, _, _ in sorted(found)] == list(range(1, 21)) and q not in {v for _, v, _ in found}
        hits += len({round(-s, 9) for s, _ in best} & {round(s, 9) for _, _, s in found})
    assert hits >= 0.9 * 20 * len(got)
