from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from wellspring.llm import pieces
from wellspring.llm.common import stored, table

from .conftest import SF
from .test_minhash import brute


def test_stages_hand_on_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    before = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name == "near_duplicates":
            want = brute([(r.doc_id, r.text) for r in before.collect()], 5, 80, 100)
            assert sorted(kept[name]) == sorted(i for i, w in want.items() if w[2])
        before = docs
    marks = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good = [i for i in kept["language"] if marks.get(i) == 1]
    assert len(set(good) & set(kept["quality"])) >= 0.98 * len(good)
    assert len(kept["quality"]) < len(kept["language"])
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    v = pieces.vocabulary()
    assert {r.doc_id for r in last} == set(texts)
    assert all(b"".join(v.pieces[i] for i in r.ids)[1:].decode() == texts[r.doc_id] for r in last)


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels"):
        table(spark, SF, t).where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows_pass_every_stage(spark, tmp_path):
    """Nulls, long and repeated texts, and columns named like the operators' own."""
    docs = table(spark, SF, "documents").limit(60)
    clashes = ("score", "lang_pred", "has_letter", "set_key", "node", "rate", "copy", "sample", "ids", "x", "tokens")
    odd = spark.createDataFrame(
        [(None, "words of a text", None, None, None), (-1, None, "en", "s", 0), (-2, "", None, "s", 0), (-3, "long words " * 20_000, "en", None, 3), (-4, "same words here " * 9, "en", "s", 1), (-4, "same words here " * 9, "en", "s", 1), (-5, "1 2 3", "en", "s", 1)],
        docs.schema,
    )
    path = str(tmp_path / "documents.parquet")
    docs.union(odd).withColumns({c: F.lit(None).cast("string") for c in clashes}).write.parquet(path)
    labels = table(spark, SF, "labels").union(spark.createDataFrame([(None, 1, 1), (-3, None, None), (-4, 1, 0)], table(spark, SF, "labels").schema))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    df = spark.read.parquet(path)
    for name, stage in corpus_pipeline.STAGES:
        before, df = df, stored(stage(spark, df, str(tmp_path)), name)
        if name != "segmentation":
            assert df.columns == before.columns
        if name == "language":
            assert {-1, -2, -5}.isdisjoint(r.doc_id for r in df.collect())
    assert df.count() > 0


def test_mixing_keeps_clean_documents(spark, tmp_path):
    """Labelled clean documents stay, and nearly all of those whose label is held out."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels").where("quality = 1")
    labels.where("crc32(string(doc_id)) % 2 = 0").write.parquet(str(tmp_path / "labels.parquet"))
    rates = {r.doc_id: r.rate for r in corpus_pipeline.mixing_rates(spark, docs, str(tmp_path)).collect()}
    left = Counter(r.doc_id for r in corpus_pipeline.mixing_stage(spark, docs, str(tmp_path)).select("doc_id").collect())
    clean = labels.where("toxic = 0").selectExpr("doc_id", "crc32(string(doc_id)) % 2 = 0 AS known").collect()
    known, held = ([r.doc_id for r in clean if r.known == k] for k in (True, False))
    assert all(rates[i] >= 1 and left[i] for i in known)
    assert not any(rates[i] == 0 for i in held)
    assert sum(left[i] == 0 for i in held) <= 0.1 * len(held)
