import math
import random

import pytest

from wellspring.llm import ann, topk

SCHEMA = "embedding array<float>, vec_id bigint, x string, rank int, block string"


def table(spark, vectors):
    return spark.createDataFrame([(v, i, "x", 1, "b") for i, v in vectors], SCHEMA).repartition(7)


def made(n, dim, seed, copies=0):
    rng = random.Random(seed)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    for i in rng.sample(range(n), copies):
        vectors[i] = (i, vectors[0][1])
    return vectors


def odd(dim):
    return [(1000, None), (1001, []), (1002, [None] * dim), (1003, [math.nan] * dim), (1004, [math.inf] + [0.0] * (dim - 1)), (None, [1.0] * dim), (1050, [1.0] * (dim + 1))]


def single(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def brute(vectors, score, k):
    out = set()
    for q, a in vectors:
        if q % 50 == 0:
            found = sorted((-score(a, b), c) for c, b in vectors if c != q and len(a) == len(b))[:k]
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(found)}
    return out


def inner(a, b):
    return sum(math.floor(single(x) * 256) * math.floor(single(y) * 256) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("copies", [0, 90])
def test_top_k_equals_brute_force(spark, monkeypatch, copies):
    """Several blocks and rounds; with ``copies``, ties beyond k in every block."""
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "CELLS", 16)
    vectors = made(300, 8, 1, copies)
    rows = table(spark, vectors + odd(8))
    got = topk.top_k(rows.where("vec_id % 50 = 0"), rows, 5)
    assert {tuple(r) for r in got.collect()} == brute(vectors, inner, 5)  # 1050 is alone in its length


def test_top_k_of_few_or_no_rows(spark):
    rows = table(spark, [(0, [1.0, 2.0]), (50, [-1.0, 0.5]), (7, [0.0, 0.0])])
    got = {tuple(r) for r in topk.top_k(rows.where("vec_id % 50 = 0"), rows, 5).collect()}
    assert got == {(0, 1, 7, 0), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 7, 0)}
    assert topk.top_k(rows.where("false"), rows, 5).collect() == []
    assert topk.top_k(rows.where("false"), rows.where("false"), 5).collect() == []


def test_top_k_of_large_numbers(spark):
    rows = table(spark, [(0, [3e30, 1.0]), (50, [1e20, 1.0]), (1, [1e7, 1.0]), (2, [-1e30, 0.0])])
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(rows.where("vec_id = 0"), rows, 5).collect()}
    top = topk.LARGEST
    assert got == {(0, 1): (1, top), (0, 2): (50, top), (0, 3): (2, -top)}


def cosine(a, b):
    a, b = [single(x) for x in a], [single(x) for x in b]
    return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def recall(got, want):
    found = {(r.query_id, r.vec_id) for r in got}
    return sum((q, c) in found for q, _, c, _ in want) / len(want)


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATES", 1000)
    vectors = made(2500, 32, 5)
    rows = table(spark, vectors + odd(32) + [(1100, [0.0] * 32)])
    got = ann.nearest(rows.where("vec_id % 50 = 0"), rows, 5).collect()
    want = brute(vectors, cosine, 5)
    assert recall(got, want) >= 0.9
    of = dict(vectors)
    assert all(abs(r.score - cosine(of[r.query_id], of[r.vec_id])) < 1e-12 for r in got)
    for q in {r.query_id for r in got}:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)


def test_copies_do_not_crowd_out_neighbours(spark):
    vectors = made(900, 24, 6, copies=600)
    rows = table(spark, vectors)
    got = ann.nearest(rows.where("vec_id % 50 = 0"), rows, 5).collect()
    # equal up to the last digits: copies tie
    of = dict(vectors)
    for q, rank, c, s in brute(vectors, cosine, 5):
        own = {r["rank"]: r for r in got if r.query_id == q}
        if of[c] == of[0]:
            assert own[rank].vec_id == c
    assert recall(got, brute(vectors, cosine, 5)) >= 0.9


def test_nearest_of_few_or_no_rows(spark):
    rows = table(spark, [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [1.0, 1.0])])
    got = {(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(rows.where("vec_id = 50"), rows, 5).collect()}
    assert got == {(50, 1, 7), (50, 2, 0), (50, 3, 0)}
    assert ann.nearest(rows.where("false"), rows.where("false"), 5).collect() == []


def test_query_agrees_with_sql(same):
    same("op5_exact_topk")


def test_query_rows_that_repeat_an_id(spark):
    """Each is answered by itself."""
    vectors = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    rows = table(spark, vectors)
    for found in (topk.top_k, ann.nearest):
        got = sorted((r.query_id, r.rank, r.vec_id) for r in found(rows.where("vec_id % 50 = 0"), rows, 5).collect())
        assert got == [(0, 1, 1), (0, 1, 1), (0, 1, 2), (0, 2, 1), (0, 2, 2), (0, 2, 2)]


def test_more_lengths_than_have_pivots(spark, monkeypatch):
    """70 lengths, of which a few have pivots: every query is answered."""
    monkeypatch.setattr(ann, "MOST_LENGTHS", 3)
    vectors = [(i, [1.0] * (i % 70) + [float(i + 1)]) for i in range(350)]
    rows = table(spark, vectors)
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    got = {(r.query_id, r.rank): r.score for r in ann.nearest(rows.where("vec_id % 50 = 0"), rows, 2).collect()}
    for q, a in vectors[::50]:
        want = sorted((-cosine(a, b) for c, b in vectors if c != q and len(b) == len(a)))[:2]
        assert all(abs(got[q, i + 1] + w) < 1e-12 for i, w in enumerate(want))
