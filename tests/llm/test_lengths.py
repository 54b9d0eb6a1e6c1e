from collections import Counter

from wellspring.llm import lengths
from wellspring.llm.queries import QUERIES

from .conftest import SF


def expected(sizes):
    out = {}
    for limit in sorted(set(sizes)):
        upto = [s for s in sizes if s <= limit]
        out[limit] = (sizes.count(limit), len(upto), sum(upto), len(sizes) - len(upto), sum(min(s, limit) for s in sizes), len(upto) / len(sizes))
    return out


def answer(df):
    return {r.length: tuple(r)[1:] for r in df.collect()}


def test_running_sums_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(lengths, "RANGE", 7)
    sizes = [0, 0, 3, 6, 7, 7, 7, 20, 21, 100, 1000]
    counts = spark.createDataFrame(list(Counter(sizes).items()), "length bigint, documents bigint")
    table = lengths.limits(counts)
    assert answer(table) == expected(sizes)
    assert [lengths.tokens_cut(counts, n) for n in (0, 5, 50, 5000)] == [sum(min(s, n) for s in sizes) for n in (0, 5, 50, 5000)]
    assert lengths.quantiles(table, [0.1, 0.5, 1.0]) == [0, 7, 1000]


def test_odd_texts(spark):
    rows = [(None, 1, 2), ("", 1, 2), ("<|endoftext|>", 1, 2), ("a" * 50_000, 1, 2), ("a" * 50_000, 1, 2), (" \n\t é🙂", 1, 2)]
    docs = spark.createDataFrame(rows, "text string, length int, documents int").repartition(3)
    with open(lengths.RANKS, "rb") as f:
        encode = lengths.encoder(f.read()).encode_ordinary
    sizes = [len(encode(t or "")) for t, *_ in rows]
    assert answer(lengths.limits(lengths.histogram(docs))) == expected(sizes)
    assert lengths.limits(lengths.histogram(docs.where("false"))).collect() == []
    assert lengths.tokens_cut(lengths.histogram(docs.where("false")), 5) == 0


def test_whole_table(spark):
    with open(lengths.RANKS, "rb") as f:
        encode = lengths.encoder(f.read()).encode_ordinary
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    assert answer(QUERIES["op8_token_counts"](spark, SF)) == expected([len(encode(t)) for t in texts])
