"""Mixing documents to target weights of domains they belong to by degrees.

A naive Bayes classifier over hashed words is fitted on a labelled table and gives each
document a posterior over the domains. The evidence of a text is scaled to that of
``EVIDENCE`` words if it is longer, since its words do not speak independently. With
n tokens and posterior p, a document read r times on average is expected to bring
r n p[d] tokens to domain d. Rates r are fitted so that the totals match the target
weights of ``epochs`` times all tokens: of the rates that do, those nearest to the same
rate for all, none below 0 or, with ``keep``, below a floor.

With little evidence a posterior stays near the prior, so a domain's tokens lie mostly
in documents of other domains, and a small target takes those away too. ``evidence``
sets how many words count; ``known`` gives a labelled document its label (several: their
shares) instead of a posterior.

The rates are found by accelerated projected gradient descent on the squared error of the
totals, weighted by the inverse of the domains' second moments, so that the first step is
the exact solution as long as no rate meets a bound. Each round is one sum over the
documents; momentum starts anew whenever it points uphill. The descent ends when totals
are ``CLOSE`` to the targets or the projected gradient is a tenth of that. Rates are stored
every few rounds, which keeps their expression short.

Targets far from what the documents hold make the descent slow. If ``DESCENT`` rounds do
not settle it, Newton steps on the dual problem find the rates instead: then such a rate
is a linear function of the posterior, cut off at the bound, whose coefficients are the
prices of the targets, and where no rates reach the targets, a proximal term (``FIRM``)
leads to the totals with the least squared error. The totals reached are logged beside
the caller's targets, as a warning if they miss one (also by :func:`reached`).

With ``keep``, a document has at least its posterior of that domain as rate, and 1 if it
belongs there more likely than not (times ``epochs`` below 1). A target that all floors
together exceed is raised to them, and the others give way in proportion to what they
have above their floors, so that there are as many tokens as asked for.

An explicit bound ``most`` of the rates takes ``ROUNDS`` rounds of projected gradient
descent on the same error instead; a miss is logged as well.

Odd rows: null and empty texts have no tokens and the prior as posterior. Rows that
share a ``doc_id`` are one document; rows without one are never fitted and get the
rate 1. Without labels or tokens all rates are 1. Labels are drawn from a bounded
sample: the first ``LABELS`` rows with a domain by hash. Beyond ``MOST_DOMAINS`` domains
the ones with the fewest labels (ties: the later name) are one, ``REST``, whose target
is the sum of theirs. Domains without a target have weight 0; a target without labels
cannot be met. Other columns are not read.
"""

from __future__ import annotations

import logging
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, unused

log = logging.getLogger(__name__)

BUCKETS = 1 << 13
EVIDENCE = 32
LABELS = 20_000
MOST_DOMAINS = 64
REST = "(rest)"
#: Rounds of the descent that an explicit upper bound takes.
ROUNDS = 25
#: Rounds of accelerated descent before Newton steps take over, and after how many of
#: them the rates are stored.
DESCENT = 40
STORED_EVERY = 6
CLOSE = 1e-6
#: Weight of the squared error against the distance from equal rates.
FIRM = 1e8
#: Words as counted and hashed here.
SPACE = r"[\x20\x09-\x0D]+"


def worded(docs: DataFrame) -> DataFrame:
    """One row per word: doc_id and the word's bucket; null for a text without words."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACE), lambda w: w != "")
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.explode_outer(words).alias("word"))
    return rows.select("doc_id", F.when(F.col("word").isNotNull(), F.pmod(F.xxhash64(F.lower("word")), F.lit(BUCKETS))).alias("bucket"))


def vectors(names: list[str], column) -> Column:
    return F.array(*(column(d) for d in names))


def classifier(docs: DataFrame, labelled: DataFrame, names: list[str]) -> DataFrame:
    """(bucket, logs): log probability of a word's bucket in each domain; the row with a
    null bucket has the log priors. At most ``BUCKETS`` + 1 rows."""
    sample = labelled.select("doc_id", "domain").orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(LABELS)
    # The sample is bounded, so the texts need not be shuffled to meet it.
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACE), lambda w: w != "")
    words = known.select("domain", F.explode(words).alias("word"))
    counts = words.groupBy(F.pmod(F.xxhash64(F.lower("word")), F.lit(BUCKETS)).alias("bucket")).agg(
        *(F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(names))
    )
    counts = stored(counts, "word-counts")
    totals = counts.agg(*(F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(names)))).first()
    share = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    rows = sum(share.values())
    everything = counts.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket")).join(counts, "bucket", "left")
    logs = F.array(*(F.log((F.coalesce(F.col(f"n{i}"), F.lit(0)) + 1.0) / float(totals[f"n{i}"] + BUCKETS)) for i in range(len(names))))
    prior = F.array(*(F.log(F.lit((share.get(d, 0) + 1.0) / (rows + len(names)))) for d in names))
    first = counts.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("bucket"), prior.alias("logs"))
    return stored(everything.select("bucket", logs.alias("logs")).union(first), "classifier")


def posteriors(docs: DataFrame, labelled: DataFrame, names: list[str], evidence: float = EVIDENCE) -> DataFrame:
    """(doc_id, tokens, posterior): one row per document id."""
    model = classifier(docs, labelled, names)
    priors = model.where("bucket is null").first()["logs"]
    sums = [F.coalesce(F.sum(F.get("logs", F.lit(i))), F.lit(0.0)) for i in range(len(names))]
    # BUCKETS rows at most, whatever the input
    rows = worded(docs).join(F.broadcast(model.where("bucket is not null")), "bucket", "left")
    rows = rows.groupBy("doc_id").agg(F.count("bucket").alias("tokens"), F.array(*sums).alias("sums"))
    scale = F.least(F.lit(1.0), F.lit(float(evidence)) / F.greatest("tokens", F.lit(1)))
    score = F.array(*(F.lit(p) + F.get("sums", F.lit(i)) * scale for i, p in enumerate(priors)))
    rows = rows.withColumn("score", score)
    raised = F.transform("score", lambda s: F.exp(s - F.array_max("score")))
    rows = rows.withColumn("raised", raised)
    total = reduce(lambda a, b: a + b, (F.get("raised", F.lit(i)) for i in range(len(names))))
    return rows.select("doc_id", "tokens", F.array(*(F.get("raised", F.lit(i)) / total for i in range(len(names)))).alias("posterior"))


def by_label(rows: DataFrame, labelled: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with the shares of its labels as posterior of a labelled document."""
    shares = F.array(*(F.avg((F.col("domain") == d).cast("double")) for d in names))
    own = labelled.groupBy("doc_id").agg(shares.alias("own"))
    return rows.join(own, "doc_id", "left").select("doc_id", "tokens", F.coalesce("own", "posterior").alias("posterior"))


def inverse(m: list[list[float]]) -> list[list[float]]:
    """Inverse of a small positive definite matrix by elimination."""
    n = len(m)
    a = [list(map(float, row)) + [float(i == j) for j in range(n)] for i, row in enumerate(m)]
    for c in range(n):
        pivot = max(range(c, n), key=lambda r: abs(a[r][c]))
        a[c], a[pivot] = a[pivot], a[c]
        a[c] = [x / a[c][c] for x in a[c]]
        for r in range(n):
            if r != c:
                a[r] = [x - a[r][c] * y for x, y in zip(a[r], a[c], strict=True)]
    return [row[n:] for row in a]


def fitted(rows: DataFrame, goal: list[float], second: list[list[float]], total: float, epochs: float, low: Column) -> Column:
    """The rates of at least ``low`` nearest to ``epochs`` whose totals are ``goal``."""
    n = len(goal)
    p = [F.get("posterior", F.lit(i)) for i in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    second = np.array(second)

    def free(prices):
        return F.lit(float(epochs)) - dot(F.col("posterior"), prices)

    def look(prices, base):
        """(value, gradient and curvature of the dual less its proximal term, error)."""
        some = rows.select("tokens", "posterior", free(prices).alias("free"), low.alias("low"))
        some = some.select("*", F.greatest("free", "low").alias("rate"))
        weight = F.when(F.col("free") > F.col("low"), F.col("tokens")).otherwise(0)
        change = F.col("rate") - float(epochs)
        value = F.sum(F.col("tokens") * (0.5 * change * change + (float(epochs) - F.col("free")) * F.col("rate")))
        found = some.agg(value, *(F.sum(F.col("rate") * F.col("tokens") * x) for x in p), *(F.sum(weight * p[i] * p[j]) for i, j in pairs))
        found = np.array(found.first(), float) / total
        error = found[1 : n + 1] - goal
        curve = np.zeros((n, n))
        for (i, j), x in zip(pairs, found[n + 1 :], strict=True):
            curve[i, j] = curve[j, i] = x
        away = second @ (prices - base) / FIRM
        return found[0] - prices @ goal - (prices - base) @ away / 2, error - away, curve + second / FIRM, error

    base = prices = np.zeros(n)
    before = None
    while True:
        value, slope, curve, error = look(prices, base)
        while max(abs(error)) >= CLOSE and max(abs(slope)) >= CLOSE / 10:
            step = np.linalg.lstsq(curve, slope, rcond=None)[0]
            noise, part = 1e-12 * (1 + abs(value)), 1.0
            if slope @ step <= noise:
                break
            found = look(prices + step, base)
            while part > 1e-12 and found[0] < value + 1e-4 * part * (slope @ step) - noise:
                part /= 4
                found = look(prices + part * step, base)
            if part <= 1e-12:
                break
            prices = prices + part * step
            value, slope, curve, error = found
        if max(abs(error)) < CLOSE or before is not None and max(abs(error - before)) < CLOSE:
            return F.greatest(free(prices), low)
        before, base = error, prices


def dot(values: Column, numbers) -> Column:
    """The sum of products of an array and given numbers. These are an argument of the
    generated code and no part of it, so it is compiled once for all rounds."""
    products = F.zip_with(values, F.lit([float(x) for x in numbers]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda a, b: a + b)


def accelerated(rows: DataFrame, goal: list[float], second: list[list[float]], total: float, epochs: float, low: Column) -> DataFrame | None:
    """``rows`` with the rates of at least ``low`` that projected gradient descent leads
    to, or None if it has not settled."""
    n = len(goal)
    p = [F.get("posterior", F.lit(i)) for i in range(n)]
    weight, goal = np.array(inverse(second)), np.array(goal)
    start = F.lit(float(epochs))
    state = rows.select("*", low.alias("low"), start.alias("rate"), start.alias("ahead"))
    ahead = rate = epochs * np.array(rows.agg(*(F.sum(F.col("tokens") * x) for x in p)).first(), float) / total
    momentum = 1.0
    for done in range(DESCENT):
        step = weight @ (ahead - goal)
        state = state.withColumn("next", F.greatest(F.col("ahead") - dot(F.col("posterior"), step), "low"))
        moved, turned = F.col("next") - F.col("ahead"), (F.col("ahead") - F.col("next")) * (F.col("next") - F.col("rate"))
        sums = [*(F.col("next") * x for x in p), moved * moved, turned]
        *found, gradient, uphill = np.array(state.agg(*(F.sum(F.col("tokens") * x) for x in sums)).first(), float) / total
        found = np.array(found)
        if max(abs(found - goal)) < CLOSE or gradient**0.5 < CLOSE / 10:
            return state.select(*rows.columns, F.col("next").alias("rate"))
        momentum = 1.0 if uphill > 0 else momentum
        following = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        share, momentum = (momentum - 1) / following, following
        ahead, rate = found + share * (found - rate), found
        state = state.withColumn("ahead", F.col("next") + dot(F.array(F.col("next") - F.col("rate")), [share])).drop("rate").withColumnRenamed("next", "rate")
        if done % STORED_EVERY == STORED_EVERY - 1:
            state = stored(state, "rates")
    return None


def descended(rows: DataFrame, goal: list[float], second: list[list[float]], total: float, epochs: float, most: float) -> Column:
    """Rates of at most ``most`` after ``ROUNDS`` rounds of projected gradient descent."""
    p = [F.get("posterior", F.lit(i)) for i in range(len(goal))]
    weight = inverse(second)
    rate = F.lit(float(min(epochs, most)))
    for _ in range(ROUNDS):
        found = rows.agg(*(F.sum(rate * F.col("tokens") * x) for x in p)).first()
        error = [r / total - g for r, g in zip(found, goal, strict=True)]
        if max(map(abs, error)) < CLOSE:
            break
        step = [sum(w * e for w, e in zip(row, error, strict=True)) for row in weight]
        change = reduce(lambda a, b: a + b, (x * s for x, s in zip(p, step, strict=True)))
        rate = F.least(F.greatest(rate - change, F.lit(0.0)), F.lit(float(most)))
    return rate


def reached(rows: DataFrame, n: int) -> list[float]:
    """The totals of the ``n`` domains at the rates of ``rows``, as shares of all tokens."""
    tokens = F.col("rate") * F.col("tokens")
    found = rows.agg(F.sum("tokens"), *(F.sum(tokens * F.get("posterior", F.lit(i))) for i in range(n))).first()
    return [x / found[0] for x in found[1:]] if found[0] else [0.0] * n


def rated(rows: DataFrame, targets: list[float], epochs: float, most: float | None = None, keep: int | None = None) -> DataFrame:
    """``rows`` (doc_id, tokens, posterior) with ``rate``."""
    n = len(targets)
    p = [F.get("posterior", F.lit(i)) for i in range(n)]
    moments = [F.sum(F.col("tokens") * p[i] * p[j]) for i in range(n) for j in range(i, n)]
    sums = rows.agg(F.sum("tokens"), *moments).first()
    total = sums[0] or 0
    if not n or not total or not sum(targets):
        return rows.withColumn("rate", F.lit(1.0))
    found = iter(sums[1:])
    second = [[0.0] * n for _ in range(n)]
    for i in range(n):
        for j in range(i, n):
            second[i][j] = second[j][i] = next(found) / total
    for i in range(n):
        second[i][i] += 1e-9
    goal = [epochs * t / sum(targets) for t in targets]
    low = F.lit(0.0)
    if keep is not None:
        low = F.when(p[keep] >= 0.5, 1.0).otherwise(p[keep]) * float(min(1.0, epochs))
        found = rows.agg(*(F.sum(low * F.col("tokens") * x) for x in p)).first()
        goal = above(goal, [x / total for x in found], epochs)
    found = accelerated(rows, goal, second, total, epochs, low) if most is None else None
    if found is None:
        rate = fitted(rows, goal, second, total, epochs, low) if most is None else descended(rows, goal, second, total, epochs, most)
        found = rows.withColumn("rate", rate)
    asked, shares = [t / sum(targets) for t in targets], reached(found, n)
    miss = max(abs(x - t) for x, t in zip(shares, asked, strict=True))
    log.log(logging.WARNING if miss >= 2 * CLOSE else logging.INFO, "mixing: totals %s for targets %s, off by up to %.3g", shares, asked, miss)
    return found


def above(goal: list[float], least: list[float], epochs: float) -> list[float]:
    """``goal`` raised to ``least`` where it is lower; the others give way in proportion
    to what they have above theirs, so that the sum stays ``epochs``."""
    raised = [max(g, x) for g, x in zip(goal, least, strict=True)]
    spare = [g - x for g, x in zip(raised, least, strict=True)]
    excess = sum(raised) - epochs
    part = min(1.0, excess / sum(spare)) if sum(spare) > 0 and excess > 0 else 0.0
    return [g - part * s for g, s in zip(raised, spare, strict=True)]


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], epochs: float = 1.0, most: float | None = None,
          evidence: float = EVIDENCE, known: bool = False, keep: str | None = None):
    """(rows, names): doc_id, tokens, posterior (in the order of ``names``), rate per
    document. ``labelled``: (doc_id, domain); rows with a null in either are not used."""
    labelled = labelled.where("doc_id is not null and domain is not null")
    most_labels = labelled.groupBy("domain").count().orderBy(F.desc("count"), "domain").limit(MOST_DOMAINS + 1)
    names = [r["domain"] for r in most_labels.collect()]
    if len(names) > MOST_DOMAINS:
        names = names[: MOST_DOMAINS - 1]
        own = F.col("domain").isin(names)
        labelled = labelled.withColumn("domain", F.when(own, F.col("domain")).otherwise(REST))
        targets = {d: t for d, t in targets.items() if d in names} | {REST: sum(t for d, t in targets.items() if d not in names)}
        names = [*(d for d in names if d != REST), REST]
    names.sort()
    if names:
        rows = posteriors(docs, labelled, names, evidence)
        rows = stored(by_label(rows, labelled, names) if known else rows, "posteriors")
    else:
        rows = docs.where("doc_id is not null").groupBy("doc_id").agg(
            F.lit(0).cast("bigint").alias("tokens"), F.array().cast("array<double>").alias("posterior")
        )
    return rated(rows, [float(targets.get(d, 0.0)) for d in names], epochs, most, names.index(keep) if keep in names else None), names


def copies(rate: Column, key: Column) -> Column:
    """How often a row is read: the whole part of its rate, and once more with the
    fraction as probability, drawn by a hash of its key."""
    draw = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 40)) / float(1 << 40)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("bigint")).cast("int")


def applied(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says."""
    key, rate, copy = (unused(docs, name) for name in ("rated_id", "rate", "copy"))
    rates = rates.select(F.col("doc_id").alias(key), F.col("rate").alias(rate))
    rows = docs.join(rates, docs["doc_id"] == F.col(key), "left")
    n = copies(F.coalesce(rate, F.lit(1.0)), F.col("doc_id"))
    return rows.withColumn(copy, F.explode(F.array_repeat(F.lit(0), n))).select(*docs.columns)
