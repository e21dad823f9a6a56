import random

import pytest

from vitrina.llm import topk


def brute(rows, k=5):
    import math

    v = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, a in v:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in v if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("chunks", [(16_384, 2_048, 128), (64, 3, 8)])
def test_equals_brute_force(spark, monkeypatch, chunks):
    monkeypatch.setattr(topk, "CHUNK_ROWS", chunks[0])
    monkeypatch.setattr(topk, "CHUNK_QUERIES", chunks[1])
    r = random.Random(2)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(400 + i, [1.0] * 6) for i in range(50)]  # ties
    rows += [(450, None), (451, []), (452, [1.0, None]), (453, [float("nan")] * 6), (454, [float("inf")] * 6), (None, [1.0] * 6), (500, [0.5, 0.5]), (-50, [0.0] * 6)]
    df = spark.createDataFrame([(*x, "q", 1) for x in rows], "vec_id long, embedding array<double>, query_id string, v int").repartition(4)
    v = topk.integer_vectors(df)
    got = topk.top_k(v, v.where("vec_id % 50 = 0"))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    v = topk.integer_vectors(df)
    assert list(map(tuple, topk.top_k(v, v.where("vec_id = 0")).collect())) == [(0, 1, 1, 256 * 512)]
    empty = v.where("vec_id = 9")
    assert topk.top_k(empty, empty).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0 ** 22, 1.0]), (1, [2.0 ** 22, 1.0]), (2, [2.0 ** 22, 1.00390625])]
    v = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk.top_k(v, v.where("vec_id = 0")).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 2 ** 60 + 256 * 257), (1, 2 ** 60 + 65536)]
