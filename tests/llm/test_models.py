import random

import numpy as np
from pyspark.sql import functions as F

from wellspring.llm import langid, quality
from wellspring.llm.common import crc_fold
from wellspring.llm.queries import QUERIES

from .conftest import SF

SCHEMA = "text string, doc_id bigint, lang string, score double, lang_pred string, has_letter int, label_id int"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = langid.ByteNet(["a", "b", "c"])
    x, y = rng.integers(97, 110, (6, 40)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        net.fold()
        return -np.log(net.probabilities(x)[np.arange(6), y]).mean()

    gradients = net.gradients(x, y)
    for name in net.p:
        for _ in range(8):
            at = tuple(rng.integers(0, s) for s in net.p[name].shape)
            if name == "filters" and not net.mask[at[0], 0, at[2]]:
                continue
            old, step = net.p[name][at], 1e-3
            net.p[name][at] = old + step
            up = loss()
            net.p[name][at] = old - step
            slope = (up - loss()) / (2 * step)
            net.p[name][at] = old
            assert abs(slope - gradients[name][at]) < 2e-3


def test_windows_cover_the_whole_text():
    net = langid.ByteNet(["a", "b"])
    texts = [b"", b"x", b"ab" * 128, b"abc" * 300, b"q" * (256 * 40 + 1)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = net.predict(data, offsets)
    for t, p in zip(texts, got, strict=True):
        total = np.zeros(2)
        for i in range(0, len(t), 256):
            x = np.zeros((1, 256), np.uint8)
            x[0, : len(t[i : i + 256])] = np.frombuffer(t[i : i + 256], np.uint8)
            total += net.probabilities(x)[0] * len(t[i : i + 256])
        assert np.allclose(p, total / max(len(t), 1), atol=1e-6)


def made(n, seed=2):
    rng = random.Random(seed)
    parts = {"aa": ["sho", "ti", "wen", "ka"], "bb": ["grü", "ßen", "ver", "ach"], "cc": ["ción", "ñas", "que", "do"]}
    rows = []
    for i in range(n):
        lang = ("aa", "bb", "cc")[i % 3]
        text = " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(rng.randint(1, 200)))
        rows.append((text if i % 7 else text.upper(), i, lang if i % 5 else None, 0.0, "x", 1, 2))
    return rows


def test_languages_of_held_out_and_odd_rows(spark):
    odd = [(None, 900, "aa", 0.0, "", 0, 0), ("", 901, "aa", 0.0, "", 0, 0), ("12 + 3 = 15 !", 902, "aa", 0.0, "", 0, 0), ("sho " * 60_000, 903, None, 0.0, "", 0, 0), ("sho ti", None, None, 0.0, "", 0, 0)]
    docs = spark.createDataFrame(made(300) + odd, SCHEMA).repartition(3)
    usable = crc_fold(F.col("doc_id"), 3) != 1
    got = {r.doc_id: r for r in langid.identify(docs, usable).collect()}
    assert len(got) == 305 and all(0 <= r.score <= 1 for r in got.values())
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert got[903].lang_pred == got[None].lang_pred == "aa"
    right = [got[i].lang_pred == ("aa", "bb", "cc")[i % 3] for i in range(300)]
    assert sum(right) >= 297
    kept = langid.known_language(docs, usable)
    assert kept.columns == docs.columns and {900, 901, 902}.isdisjoint(r.doc_id for r in kept.collect())


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([("some text", 1, None, 0.0, "", 0, 0)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, F.lit(True)).collect()] == [("und", 0.0)]
    assert langid.identify(docs.where("false"), F.lit(True)).collect() == []
    labels = spark.createDataFrame([(1, None)], "doc_id bigint, quality int")
    assert [r.score for r in quality.quality(docs, labels, F.lit(True)).collect()] == [0.5]
    assert quality.good(docs, labels, F.lit(True)).count() == 1
    assert quality.quality(docs.where("false"), labels.where("false"), F.lit(True)).collect() == []


def test_held_out_accuracy(spark):
    found = QUERIES["op3_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = found.where("held_out").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.95 * n
    found = QUERIES["op10_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    right, n = found.where("held_out").agg(F.sum((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert right >= 0.85 * n  # 19 rows in the smallest tables


def plain(text):
    """Some of the statistics of a text, word by word."""
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).lower().split(" ") if w]
    size = len(text.encode())
    n = max(len(words), 1)
    return [
        np.log1p(size), np.log1p(len(words)), np.log1p(sum(len(w.encode()) for w in words) / n),
        len(set(words)) / n if words else 1.0, max((words.count(w) for w in set(words)), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / (len(words) - 1) if len(words) > 1 else 1.0,
    ]


def test_statistics_equal_a_plain_count():
    texts = ["", "a", "A a a b", "one two\nthree  one two", "x " * 500, "é ß é", "\n\t "]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    got = quality.Statistics().of(data, offsets)[:, [0, 1, 2, 12, 13, 14, 15]]
    assert np.allclose(got, [plain(t) for t in texts])


def test_isotonic_equals_the_best_monotone_fit():
    rng = np.random.default_rng(1)
    value, y, w = np.arange(40.0), rng.random(40) + np.arange(40) / 40, rng.random(40) + 0.1
    at, level = quality.isotonic(value, y, w)
    # the maximum over left of the minimum over right of block means
    mean = lambda a, b: (y[a:b] * w[a:b]).sum() / w[a:b].sum()
    want = [max(min(mean(a, b) for b in range(i + 1, 41)) for a in range(i + 1)) for i in range(40)]
    assert np.allclose(sorted(set(np.round(want, 9))), np.round(level, 9)) and (np.diff(at) > 0).all()


def test_quality_of_odd_rows(spark):
    rng = random.Random(4)
    good = [" ".join(rng.choice(["river", "stone", "of", "the", "light", "over"]) + str(i) for i in range(60)) for _ in range(80)]
    bad = ["!!! *** ||| " * 20 + rng.choice("abc") for _ in range(40)]
    rows = [(t, i, None, 0.0, "", 0, 0) for i, t in enumerate(good + bad)] + [(None, 500, None, 0.0, "", 0, 0), ("", 501, None, 0.0, "", 0, 0), (good[0], None, None, 0.0, "", 0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    labels = spark.createDataFrame([(i, int(i < 80)) for i in range(120)] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    usable = crc_fold(F.col("doc_id"), 5) != 0
    got = {r.doc_id: r.score for r in quality.quality(docs, labels, usable).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and abs(got[500] - got[501]) < 1e-9
    assert abs(got[None] - got[0]) < 1e-9
    assert all((got[i] >= 0.3) == (i < 80) for i in range(120))
    kept = quality.good(docs, labels, usable)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} & set(range(120)) == set(range(80))


def test_more_labels_than_are_learned(spark):
    """300 languages: the most frequent are learned, none is an error."""
    rng = random.Random(4)
    rows = [("der hund und die katze " + str(rng.random()), i, "de") for i in range(40)] + [("the dog and the cat " + str(rng.random()), 100 + i, "en") for i in range(40)]
    rows += [(f"wort{i}", 1000 + i, f"x{i:03d}") for i in range(300)]
    docs = spark.createDataFrame(rows, "text string, doc_id bigint, lang string")
    windows = langid.labelled_windows(docs, F.lit(True))
    languages = {r["lang"] for r in windows}
    assert len(languages) == langid.MOST_LANGUAGES and {"de", "en", "x000"} <= languages and "x299" not in languages


def test_network_equals_plain_loops():
    """Embedding, filters of every width, maxima and softmax by explicit sums."""
    rng = np.random.default_rng(5)
    net = langid.ByteNet(["a", "b", "c"])
    x = rng.integers(0, 256, (3, 40)).astype(np.uint8)
    net.train(x.repeat(9, axis=0), rng.integers(0, 3, 27))
    for row, got in zip(x, net.probabilities(x), strict=True):
        z = list(net.p["bias"])
        for f in range(langid.FILTERS * len(langid.WIDTHS)):
            width = langid.WIDTHS[f // langid.FILTERS]
            best = max(
                sum(net.p["embedding"][row[at + j]] @ net.p["filters"][j, :, f] for j in range(width))
                for at in range(len(row) - max(langid.WIDTHS) + 1)
            )
            for c in range(3):
                z[c] += max(best + net.p["shift"][f], 0) * net.p["dense"][f, c]
        e = np.exp(np.array(z) - max(z))
        assert np.allclose(got, e / e.sum(), atol=1e-5)


def test_ridge_equals_one_matrix(spark):
    """The weights from sums over partitions are those of all rows in one matrix."""
    rng = np.random.default_rng(6)
    width = len(quality.STATISTICS)
    x, y = rng.normal(size=(300, width)), rng.integers(0, 2, 300)
    rows = [(i % 2, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    model = quality.fit(spark.createDataFrame(rows, "half int, x array<double>, y int").repartition(6))
    z = quality.features(x, model.mean, model.scale)
    stacked = np.vstack((z / np.sqrt(len(z)), np.sqrt(quality.RIDGE) * np.eye(z.shape[1])))
    want = np.linalg.lstsq(stacked, np.concatenate((y / np.sqrt(len(z)), np.zeros(z.shape[1]))), rcond=None)[0]
    assert np.allclose(model.weights, want, atol=1e-6)
