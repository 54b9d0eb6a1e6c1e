import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wellspring.llm import mixing

SCHEMA = "text string, doc_id bigint, rate string, tokens int, domain string"
CLASHES = ("rated_id", "copy", "posterior", "bucket", "word")


def made(n=240, seed=1):
    rng = random.Random(seed)
    words = {"a": ["red", "blue", "sky"], "b": ["plus", "minus", "sum"], "c": ["yes", "no"]}
    rows = []
    for i in range(n):
        d = rng.choices("abc", (6, 3, 1))[0]
        e = rng.choice("abc")
        text = [rng.choice(words[d if rng.random() < 0.8 else e]) for _ in range(rng.randint(1, 40))]
        rows.append((" ".join(text), i, "r", 0, d))
    return rows


def projected(n, p, goal, most):
    """The same descent in numpy."""
    total = n.sum()
    weight = np.linalg.inv((p * n[:, None]).T @ p / total + 1e-9 * np.eye(p.shape[1]))
    r = np.ones(len(n))
    for _ in range(mixing.ROUNDS):
        error = (p * (r * n)[:, None]).sum(0) / total - goal
        if np.abs(error).max() < mixing.CLOSE:
            break
        r = np.clip(r - p @ (weight @ error), 0, most)
    return r


def test_rates_reach_the_targets(spark):
    rows = made()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    labelled = docs.where("doc_id % 2 = 0").select("doc_id", "domain")
    for goal, most in (({"a": 0.4, "b": 0.3, "c": 0.3}, 50.0), ({"a": 0.9, "b": 0.1}, 6.0), ({"c": 1.0}, 6.0)):
        found, names = mixing.mixed(docs, labelled, goal, most=most)
        got = {r.doc_id: r for r in found.collect()}
        assert names == ["a", "b", "c"] and sorted(got) == list(range(len(rows)))
        n = np.array([got[i].tokens for i in range(len(rows))], float)
        p = np.array([got[i].posterior for i in range(len(rows))])
        rate = np.array([got[i].rate for i in range(len(rows))])
        assert np.allclose(p.sum(1), 1) and (n == [len(t.split()) for t, *_ in rows]).all()
        want = np.array([goal.get(d, 0.0) for d in names])
        assert np.allclose(rate, projected(n, p, want, most), atol=1e-6)
        assert (rate >= 0).all() and (rate <= most).all()
        share = (p * (rate * n)[:, None]).sum(0) / n.sum()
        if most > 6:
            assert np.abs(share - want).max() < 1e-4
        else:  # out of reach: the descent has settled on better totals than equal rates
            assert np.abs(share - want).sum() < np.abs((p * n[:, None]).sum(0) / n.sum() - want).sum()


def test_rates_settle_without_a_bound_above(spark):
    """Targets that need rates of 0 and over 4 are met, and others as closely as can be."""
    docs = spark.createDataFrame(made(), SCHEMA).repartition(4)
    labelled = docs.where("doc_id % 2 = 0").select("doc_id", "domain")
    for goal, can in (({"a": 0.05, "b": 0.05, "c": 0.9}, True), ({"a": 0.1, "b": 0.1, "c": 0.8}, True), ({"c": 1.0}, False)):
        found, names = mixing.mixed(docs, labelled, goal)
        got = found.collect()
        n, p, rate = (np.array([r[c] for r in got], float) for c in ("tokens", "posterior", "rate"))
        error = (p * (rate * n)[:, None]).sum(0) / n.sum() - [goal.get(d, 0.0) for d in names]
        assert np.allclose(mixing.reached(found, 3), (p * (rate * n)[:, None]).sum(0) / n.sum())
        assert (rate >= 0).all() and rate.max() > 4
        if can:
            assert np.abs(error).max() < 2e-6
        weight = np.linalg.inv((p * n[:, None]).T @ p / n.sum() + 1e-9 * np.eye(3))
        assert np.abs(np.where(rate > 0, p @ weight @ error, np.minimum(p @ weight @ error, 0))).max() < 1e-4


def test_kept_domain_has_a_floor(spark):
    docs = spark.createDataFrame(made(), SCHEMA)
    found, names = mixing.mixed(docs, docs.select("doc_id", "domain"), {"a": 0.99, "b": 0.01}, keep="a")
    for r in found.collect():
        assert r.rate >= (1 if r.posterior[0] >= 0.5 else r.posterior[0])
    known, _ = mixing.mixed(docs, docs.where("doc_id < 9").select("doc_id", "domain"), {"a": 0.9, "b": 0.1}, known=True)
    first = {r.doc_id: r.posterior for r in known.where("doc_id < 9").collect()}
    domains = sorted({r[4] for r in made()[:9]})
    assert all(first[r[1]] == [float(r[4] == d) for d in domains] for r in made()[:9])


def test_posteriors_equal_plain_naive_bayes(spark):
    rows = made(60, 3)
    docs = spark.createDataFrame(rows, SCHEMA)
    labelled = docs.where("doc_id % 3 > 0").select("doc_id", "domain")
    found, names = mixing.mixed(docs, labelled, {"a": 1.0})
    words = {r.w: r.b for r in spark.createDataFrame([(w,) for t, *_ in rows for w in t.split()], "w string").distinct().select("w", F.pmod(F.xxhash64("w"), F.lit(mixing.BUCKETS)).alias("b")).collect()}
    known = [r for r in rows if r[1] % 3]
    counts = {d: Counter(words[w] for t, *_, e in known if e == d for w in t.split()) for d in names}
    prior = {d: (sum(e == d for *_, e in known) + 1) / (len(known) + len(names)) for d in names}
    for r in found.collect():
        text = rows[r.doc_id][0].split()
        scale = min(1, mixing.EVIDENCE / len(text))
        score = [math.log(prior[d]) + scale * sum(math.log((counts[d][words[w]] + 1) / (sum(counts[d].values()) + mixing.BUCKETS)) for w in text) for d in names]
        raised = np.exp(np.array(score) - max(score))
        assert np.allclose(r.posterior, raised / raised.sum())


def test_odd_rows_and_copies(spark):
    rows = [("red sky", 1, "r", 0, "a"), ("red sky", 1, "r", 0, "a"), (None, 2, "r", 0, "b"), ("", 3, "r", 0, None), ("sum", None, "r", 0, "b"), ("plus " * 30_000, 4, "r", 0, "b")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found, _ = mixing.mixed(docs, docs.select("doc_id", "domain"), {"a": 0.5, "b": 0.5})
    got = {r.doc_id: r for r in found.collect()}
    assert sorted(got) == [1, 2, 3, 4] and got[1].tokens == 4 and got[2].tokens == got[3].tokens == 0 and got[4].tokens == 30_000
    assert got[2].posterior == got[3].posterior
    rates = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, 1.0)], "doc_id bigint, rate double")
    docs = docs.withColumns({c: F.lit("x") for c in CLASHES})
    out = mixing.applied(docs, rates)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == {1: 4, 3: 1, None: 1, 4: 1}


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([("x y", 1, "r", 0, None)], SCHEMA)
    found, names = mixing.mixed(docs, docs.select("doc_id", "domain"), {"a": 1.0})
    assert names == [] and [(r.doc_id, r.rate) for r in found.collect()] == [(1, 1.0)]
    some = spark.createDataFrame([(1, "a")], "doc_id bigint, domain string")
    found, _ = mixing.mixed(docs.where("false"), some, {"a": 1.0})
    assert found.collect() == []


def test_copies_average_to_the_rate(spark):
    n = spark.range(4000).agg(F.sum(mixing.copies(F.lit(1.3), F.col("id")))).first()[0]
    assert abs(n / 4000 - 1.3) < 0.03


def test_more_domains_than_are_told_apart(spark, monkeypatch):
    """The rarest share one target."""
    monkeypatch.setattr(mixing, "MOST_DOMAINS", 4)
    rows = [(f"w{i % 10} x{i % 10}", i, "r", 0, f"d{min(i % 10, i // 12)}") for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labelled = docs.select("doc_id", "domain")
    often = [d for d, _ in sorted(Counter(r[4] for r in rows).items(), key=lambda x: (-x[1], x[0]))][:3]
    found, names = mixing.mixed(docs, labelled, {f"d{i}": 0.1 for i in range(10)})
    assert names == sorted([*often, mixing.REST])
    assert found.count() == 100 and all(abs(x - (0.7 if d == mixing.REST else 0.1)) < 0.1 for d, x in zip(names, mixing.reached(found, 4), strict=True))


def to_convergence(n, p, goal, rounds=400):
    """Accelerated projected gradient descent in numpy."""
    total = n.sum()
    weight = np.linalg.inv((p * n[:, None]).T @ p / total + 1e-9 * np.eye(p.shape[1]))
    rate, ahead, momentum = np.ones(len(n)), np.ones(len(n)), 1.0
    for _ in range(rounds):
        error = (p * (ahead * n)[:, None]).sum(0) / total - goal
        new = np.maximum(ahead - p @ (weight @ error), 0)
        moved = np.sqrt((n * (new - ahead) ** 2).sum() / total)
        if np.abs((p * (new * n)[:, None]).sum(0) / total - goal).max() < mixing.CLOSE or moved < mixing.CLOSE / 10:
            return new
        if (n * (ahead - new) * (new - rate)).sum() > 0:
            momentum = 1.0
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, rate, momentum = new + (momentum - 1) / following * (new - rate), new, following
    raise AssertionError("not settled")


def test_rates_are_those_of_projected_gradient_descent(spark, monkeypatch):
    """Without a bound above: targets that need one step, and some that need many; the
    query's own targets on its own tables."""
    def no_newton(*_):
        raise AssertionError("the descent has not settled")

    monkeypatch.setattr(mixing, "fitted", no_newton)
    docs = spark.createDataFrame(made(), SCHEMA).repartition(4)
    labelled = docs.where("doc_id % 2 = 0").select("doc_id", "domain")
    for goal in ({"a": 0.6, "b": 0.3, "c": 0.1}, {"a": 0.2, "b": 0.2, "c": 0.6}):
        found, names = mixing.mixed(docs, labelled, goal)
        got = found.collect()
        n, p, rate = (np.array([r[c] for r in got], float) for c in ("tokens", "posterior", "rate"))
        want = to_convergence(n, p, np.array([goal.get(d, 0.0) for d in names]))
        assert np.allclose(rate, want, atol=1e-6)
    from wellspring.llm.queries import QUERIES

    from .conftest import SF

    got = QUERIES["op7_mixing"](spark, SF).collect()
    n, rate = (np.array([r[c] for r in got], float) for c in ("tokens", "rate"))
    p = np.array([[r.p_good, r.p_low, r.p_toxic] for r in got])
    assert np.allclose(rate, to_convergence(n, p, np.array([0.85, 0.08, 0.07])), atol=1e-6)
    assert np.abs((p * (rate * n)[:, None]).sum(0) / n.sum() - [0.85, 0.08, 0.07]).max() < 2e-6


def test_floors_leave_the_total_as_it_is(spark):
    docs = spark.createDataFrame(made(), SCHEMA)
    known = docs.select("doc_id", "domain")
    found, names = mixing.mixed(docs, known, {"a": 0.2, "b": 0.8}, known=True, keep="a")
    total = found.agg(F.sum(F.col("rate") * F.col("tokens")) / F.sum("tokens")).first()[0]
    shares = mixing.reached(found, 3)
    own = found.agg(*(F.sum(F.get("posterior", F.lit(i)) * F.col("tokens")) / F.sum("tokens") for i in range(3))).first()
    assert abs(total - 1) < 1e-5 and abs(shares[0] - own[0]) < 1e-5  # a keeps all it has, b gives way
    assert mixing.above([0.2, 0.8], [0.5, 0.1], 1.0) == [0.5, 0.5]
