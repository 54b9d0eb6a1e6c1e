import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspring.llm import decontaminate as d


def words(text):
    text = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return re.findall(r"[0-9a-z\x80-\U0010FFFF]+", text)


def brute(docs, items, size):
    phrases = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            phrases.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in phrases:
                    hit[i : i + n] = [True] * n
                    found |= phrases[tuple(w[i : i + n])] - {None}
        spans, i = [], 0
        while i < len(w):
            j = i
            while j < len(w) and hit[j]:
                j += 1
            if j > i:
                spans.append((i, j - i))
            i = max(j, i + 1)
        out.append((doc, len(w), sum(hit), spans, sorted(found)))
    return sorted(map(repr, out))


def run(spark, docs, items, size, **options):
    docs = spark.createDataFrame([(3, "x", t, i, "n") for i, t in docs], "spans int, word string, text string, doc_id bigint, n_hit string")
    items = spark.createDataFrame([(1, i, t) for i, t in items], "phrase int, item_id bigint, text string")
    found = d.benchmark_spans(docs.repartition(4), items.repartition(3), size, **options)
    return [(r.doc_id, r.n_words, r.n_hit, [(s.word, s.words) for s in r.spans], sorted(r["items"])) for r in found.collect()]


def made(seed):
    rng = random.Random(seed)
    text = lambda n, v=9: " ".join(rng.choice(["A", "b", "ñ", "d1", "É", "的", "zz", "g", "h"][:v]) + rng.choice(["", "", ",", "."]) for _ in range(n))
    items = [(i, text(rng.randint(0, 14), 4)) for i in range(25)] + [(7, "other words of one item"), (None, "null item here"), (90, None), (91, "...")]
    items += [(95, items[3][1]), (96, "b b b b b b b b")]
    docs = [(i, text(rng.randint(0, 60), rng.choice([2, 4, 9]))) for i in range(80)]
    docs += [(200 + i, f"{text(3)} {t} and {t} {text(2)}") for i, (_, t) in enumerate(items) if t]
    docs += [(300, None), (301, ""), (302, "!?"), (None, "Null item HERE"), (303, "x " * 3000 + "b " * 4000), (200, docs[5][1])]
    return docs + [(400, "a copy b b b b b b b b b b b d1 a a b")] * 60, items


@pytest.mark.parametrize("most", [d.PAIRS, 40])
@pytest.mark.parametrize("size", [3, 10])
def test_equals_brute_force(spark, monkeypatch, size, most):
    """Phrases of every length up to ``size``, copies, long runs of one word, odd rows;
    several shards in a task; one block of phrases or several."""
    monkeypatch.setattr(d, "SHARD", 2000)
    docs, items = made(size)
    got = run(spark, docs, items, size, most=most)
    assert sorted(map(repr, got)) == brute(docs, items, size)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")], 2) == []
    assert run(spark, [(1, "a b")], [], 2) == [(1, 2, 0, [], [])]


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(1, "É, keep this: the Test passage! ñandú 的 end"), (2, None)], "doc_id int, text string")
    items = spark.createDataFrame([("i", "the test PASSAGE")], "item_id string, text string")
    found = d.benchmark_spans(docs, items, 3).select("doc_id", "spans").join(docs, "doc_id")
    got = dict(found.select("doc_id", d.without_spans(F.col("text"), F.col("spans"))).collect())
    assert got == {1: "É, keep this: ! ñandú 的 end", 2: None}


def test_index_counts_and_locates():
    rng = np.random.default_rng(1)
    for n, sigma in ((50, 2), (400, 3), (3000, 40)):
        text = rng.integers(0, sigma + 1, n)
        text[-20:-10] = 1
        text[-1] = 0
        order = d.suffixes(text)
        assert sorted(order) == list(range(n))
        index = d.Index(text, sigma, 4)
        for length in (1, 2, 5):
            asked = np.unique(rng.integers(1, sigma + 1, (60, length)), axis=0)
            which, low, high = index.search(np.pad(asked, ((0, 0), (2, 0))))
            got = {int(w): sorted(index.locate(np.arange(a, b))) for w, a, b in zip(which, low, high, strict=True)}
            want = {i: [p for p in range(n - length + 1) if (text[p : p + length] == a).all()] for i, a in enumerate(asked)}
            assert got == {i: p for i, p in want.items() if p}


def test_words_of_equal_hash_are_told_apart(spark, monkeypatch):
    """Hashes that all collide with a benchmark's words hide nothing and add nothing."""
    real = d.Tokens.of

    def weak(self, data, offsets):
        data, hashes, starts, ends, first = real(self, data, offsets)
        return data, np.where(data[starts] == ord("q"), np.uint64(7), hashes) if len(starts) else hashes, starts, ends, first

    known = {}
    tokens = d.Tokens()
    monkeypatch.setattr(d.Tokens, "of", weak)
    items = spark.createDataFrame([(1, "qa b")], "item_id int, text string")
    known = d.compact(d.phrases(items, 2), 2)
    data = np.frombuffer(b"qx b qa b qab b", np.uint8)
    n, spans, found = d.found_in(known, tokens, data, np.array([0, len(data)]))
    assert [(s["word"], s["words"]) for s in spans[0]] == [(2, 2)] and found == [[1]]


def test_query(same):
    same("op13_decontaminate")
