import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspring.llm import negatives as n

SCHEMA = "place int, embedding array<float>, block string, label int, vec_id bigint, nth int"


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def score(a, b):
    return sum(math.floor(single(x) * 256) * math.floor(single(y) * 256) for x, y in zip(a, b, strict=True))


def brute(rows):
    """rows: (vec_id, label, vector), all of which take part"""
    out = []
    for a, label, v in rows:
        if a % 50:
            continue
        scored = [(-score(v, w), c, other) for c, other, w in rows if c != a and len(w) == len(v)]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            found = sorted(s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p)[:3]
            out += [(a, positive, r + 1, c, -p, -s) for r, (s, c, _) in enumerate(found)]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(1, v, "b", label, i, 2) for i, label, v in rows], SCHEMA).repartition(7)
    return sorted(tuple(r) for r in n.hard_negatives(df, F.col("vec_id") % 50 == 0).collect())


def made(count, dim, seed, spread=1.0):
    """Vectors around a few directions; ``spread`` 0 makes copies of these."""
    rng = random.Random(seed)
    hubs = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    near = lambda: [x + rng.gauss(0, spread) for x in rng.choice(hubs)]
    return [(i, rng.randint(0, 2), near()) for i in range(count)]


def odd(dim):
    return [(1000, 1, None), (1001, 1, []), (1002, 1, [None] * dim), (1003, 1, [math.nan] * dim), (1050, None, [1.0] * dim), (None, 1, [9.0] * dim), (1004, 1, [math.inf] * dim)]


@pytest.mark.parametrize("spread", [1.0, 0.2, 0.0])
def test_equals_brute_force(spark, monkeypatch, spread):
    """Several blocks, groups and stretches of a list; without spread, ties everywhere."""
    for name, value in {"CANDIDATES": 40, "QUERIES": 3, "STRIDE": 8, "ANCHOR_BLOCKS": 2, "CANDIDATE_BLOCKS": 2}.items():
        monkeypatch.setattr(n, name, value)
    rows = made(400, 6, 1, spread)
    others = [(2000 + 50 * i, 1, [1.0] * 7) for i in range(2)] + [(2001, 0, [0.7] * 7), (2002, 1, [1.0] * 7)]  # of another length
    zeros = [(3000, 0, [0.0] * 6), (3001, 0, [0.0] * 6), (3002, 1, [0.0] * 6)]
    want = brute(rows + others + zeros)
    assert len(want) > 15 and any(w[0] >= 2000 for w in want)
    assert run(spark, rows + others + zeros + odd(6)) == want


def test_large_components(spark):
    """Scores beyond what leaves room for ties in 64 bits."""
    rows = [(i, label, [x * 2.0**21 for x in v]) for i, label, v in made(120, 3, 2, 0.3)]
    assert run(spark, rows) == brute(rows)


def test_repeated_rows(spark):
    """A repeated positive has its own negatives; a repeated anchor its own answers."""
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (1, 1, [1.0, 0.1]), (2, 2, [0.9, 0.1])]
    assert run(spark, rows) == [(0, 1, 1, 2, 65536, 58880)] * 2
    assert run(spark, [rows[0], *rows]) == [(0, 1, 1, 2, 65536, 58880)] * 4


def test_few_or_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []
    assert run(spark, [(0, 1, [1.0]), (2, 2, [1.0])]) == []
    assert run(spark, [(0, 1, [1.0]), (2, 1, [-1.0]), (3, 2, [-0.7])]) == []  # a band below zero is empty


def test_walks_end_early():
    """In data with structure a member sees little of its list, and misses nothing."""
    rng = np.random.default_rng(3)
    hubs = rng.normal(size=(20, 32))
    x = np.floor(256 * (hubs[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 32)) / 20)).astype(np.int64)
    import pyarrow as pa

    width = 33
    block = np.concatenate((np.zeros((4000, 1), np.int64), x), axis=1)
    have = n.Candidates(pa.table({"dim": [width], "data": [block.tobytes()], "ids": [list(range(4000))]}), width)
    points = n.unit(hubs)
    asked, seen = x[:64], 0
    true = asked @ x.T
    needed = np.sort(true, axis=1)[:, -5].astype(float)
    found = np.zeros(64, int)

    def take(rows, places, scores):
        nonlocal seen
        seen += scores.size
        found[rows] += (scores >= needed[rows, None]).sum(axis=1)
        return needed[rows]

    n.walk(asked, points, have, needed.copy(), take)
    assert (found == (true >= needed[:, None]).sum(axis=1)).all()
    assert seen < 0.35 * 64 * 4000


def test_query(same):
    same("op12_hard_negatives")
