import math
from collections import Counter
from itertools import pairwise

import numpy as np
import pyarrow as pa

from wellspring.llm import pieces

V = pieces.vocabulary()
IDS: dict[bytes, int] = {p: i for i, p in enumerate(V.pieces) if p and i not in set(V.byte_ids)}


def paths(data):
    """Every segmentation of the bytes, as ids."""
    if not data:
        return [()]
    out = [(IDS[data[:n]], *rest) for n in range(1, len(data) + 1) if data[:n] in IDS for rest in paths(data[n:])]
    size = next(n for n in (1, 2, 3, 4) if n == len(data) or data[n] & 0xC0 != 0x80)
    if data[:size] not in IDS:
        out += [(*V.byte_ids[list(data[:size])], *rest) for rest in paths(data[size:])]
    return out


def distribution(text, alpha=1.0):
    found = {p: math.exp(alpha * V.weights[list(p)].sum()) for p in paths(b" " + text.encode())}
    total = sum(found.values())
    return {p: w / total for p, w in found.items()}


def drawn(texts, k, seeds=None, alpha=1.0):
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array(seeds or range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["key", "seed", "text"]
    )
    return pa.Table.from_batches(pieces.decoded(V, pieces.encoded(V, alpha, k, [batch]))).to_pylist()


TEXTS = ["", "a", "the", " of  the", "é", "日本\n", "▁x ▁", "🙂 a\tb", "the the", "\u0000", "n\n\nn"]


def test_round_trip_and_probabilities():
    rows = drawn(TEXTS, 3)
    for r in rows:
        assert r["decoded"] == TEXTS[r["key"]]
    for i, t in enumerate(TEXTS[1:], 1):
        want = distribution(t)
        own = [r for r in rows if r["key"] == i]
        assert len(own) == min(3, len(want)) == len({tuple(r["ids"]) for r in own})
        for r in own:
            assert abs(math.exp(r["log_prob"]) - want[tuple(r["ids"])]) < 1e-9
        if len(want) <= 3:
            assert all(r["log_inclusion"] == 0 for r in own)
    assert [r["ids"] for r in rows if r["key"] == 0] == [[]]


def test_draws_follow_sampling_without_replacement():
    """First and second draws of many keys against exact probabilities."""
    text, n, alpha = "then at", 6000, 0.3
    p = distribution(text, alpha)
    rows = drawn([text] * n, 2, [i * 7919 + 1 for i in range(n)], alpha)
    first = Counter(tuple(r["ids"]) for r in rows if r["sample"] == 1)
    both = Counter()
    for a, b in pairwise(rows):
        if a["key"] == b["key"]:
            both[tuple(a["ids"]), tuple(b["ids"])] += 1
    for path, q in p.items():
        assert abs(first[path] - n * q) < 5 * math.sqrt(n * q * (1 - q)) + 3
    for (a, b), seen in both.items():
        q = p[a] * p[b] / (1 - p[a])
        assert abs(seen - n * q) < 5 * math.sqrt(n * q * (1 - q)) + 3
    # inclusion: the inverse-probability sum of the sample estimates the total, 1
    total = np.array([math.exp(r["log_prob"] - r["log_inclusion"]) for r in rows]).sum() / n
    assert abs(total - 1) < 0.05


def test_draws_do_not_depend_on_the_batch():
    texts = ["some words of a text", "others", "the same words again " * 30]
    alone = [drawn([t], 2, [9 + i])[j]["ids"] for i, t in enumerate(texts) for j in (0, 1)]
    assert alone == [r["ids"] for r in drawn(texts, 2, [9, 10, 11])]


def test_rows(spark):
    rows = [("a text", 1, "x", 1), (None, 2, "x", 1), ("", 3, "x", 1), ("word " * 40_000, 4, "x", 1), ("y" * 3000, 5, "x", 1), ("a text", None, "x", 1), ("a text", 1, "x", 1)]
    docs = spark.createDataFrame(rows, "text string, doc_id bigint, ids string, sample int").repartition(3)
    got = pieces.sample(docs, k=2).collect()
    assert Counter(r.doc_id for r in got) == {1: 4, 2: 1, 3: 1, 4: 2, 5: 2, None: 2}
    texts = {i: t or "" for t, i, *_ in rows}
    assert all(r.decoded == texts[r.doc_id] for r in got)
    assert len({tuple(r.ids) for r in got if r.doc_id == 1}) == 2
    assert pieces.sample(docs.where("false")).collect() == []
