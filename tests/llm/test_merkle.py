import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from wellspring.llm import merkle

SCHEMA = "leaf string, doc_id bigint, text string, lang string, n_chars bigint, tree string, place int, outer string"
FIELDS = ["doc_id", "lang", "n_chars", "text"]


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(doc_id, lang, n_chars, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, lang, n_chars, text)))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def climb(i, levels):
    """(siblings, how each node of the path is made from the one below)"""
    for row in levels[:-1]:
        yield row[i - 1] if i % 2 else row[i + 1] if i + 1 < len(row) else None, i % 2
        i //= 2


def brute(rows):
    """rows: (doc_id, lang, n_chars, text)"""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        order = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[g] = order, levels_of([leaf(*r) for r in order])
    top = levels_of([trees[g][1][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        order, levels = trees[g]
        for i, r in enumerate(order):
            steps = [*climb(i, levels), *climb(at, top)]
            node = leaf(r[0], r[1], None if r[2] is None else r[2] + 1, r[3]) if changed(r[0]) else leaf(*r)
            for beside, odd in steps:
                node = h(node if beside is None else beside + node if odd else node + beside)
            proof = "".join(s for s, _ in steps if s is not None)
            root = top[-1][0]
            out.append((r[0], r[1], leaf(*r), i, levels[-1][0], root, proof, h(proof), node, node == root))
    return sorted(map(repr, out))


def changed(doc_id):
    return doc_id is not None and doc_id % 3 == 0


def run(spark, rows, height):
    df = spark.createDataFrame([("x", i, t, g, n, "t", 1, "o") for i, g, n, t in rows], SCHEMA).repartition(5)
    n = F.col("n_chars").cast("decimal(20,0)")
    other = F.when(F.col("doc_id") % 3 == 0, n + 1).otherwise(n)
    found = merkle.manifest(df, "lang", "doc_id", FIELDS, {"n_chars": other}, height)
    return sorted(map(repr, (tuple(r) for r in found.collect())))


@pytest.mark.parametrize("height", [1, 3, 12])
def test_equals_brute_force(spark, height):
    """One group with most rows, one of a single row, sizes that leave lone nodes at
    several levels, null groups, keys and fields, repeated rows, a length at the end of
    64 bits; superblocks so low that upper levels are climbed by superblocks too."""
    rng = random.Random(height)
    rows = [(i, rng.choice(["en", "en", "en", "dé", "", None]), rng.choice([None, i]), rng.choice(["", None, "é" * i])) for i in rng.sample(range(900), 150)]
    rows += [(7, "one", 1, "lone")] + [(3, "en", 4, "copy")] * 40 + [(3, "en", 5, "tie"), (None, "en", 1, "a"), (None, None, None, None)]
    rows += [(6, "en", 2**63 - 1, "long")]
    got = run(spark, rows, height)
    assert got == brute(rows)
    assert any("True" in r for r in got) and any("False" in r for r in got)


def test_empty_and_single(spark):
    assert run(spark, [], 2) == []
    assert run(spark, [(1, None, 2, "x")], 2) == brute([(1, None, 2, "x")])


def test_without_tampering_all_proofs_hold(spark):
    df = spark.createDataFrame([(i, "g", 1, "t") for i in range(11)], "doc_id bigint, lang string, n_chars int, text string")
    assert merkle.manifest(df, "lang", "doc_id", FIELDS, height=2).where("verified").count() == 11


def test_query(same):
    same("op11_merkle")
