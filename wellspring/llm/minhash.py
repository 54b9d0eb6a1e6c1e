"""Near-duplicate documents by HyperMinHash.

A document is its set of distinct word shingles. One pass over the texts keeps,
per document, the set's size, a digest of the set and 512 registers: the set is
dealt into 512 buckets by the top bits of each shingle hash, and of the least hash
of a bucket the register stores the count of leading zeros (6 bits), the next 9
bits and a mark. An empty bucket takes the register of a filled one, the first in an
order of its own, and is marked so; registers of two sets then agree with the sets'
Jaccard similarity as probability, however small the sets are.

Four registers make a band, which is 64 bits; equal bands make candidates. With 32
bands a pair at similarity 0.85 is missed with probability 6e-11, at 0.8 with 5e-8.
Candidates are first judged by the unmarked registers, after subtracting the
agreement that compression causes by chance, and then on the full sets. The estimate
may be 4.5 standard errors low, which a pair just at the threshold is with
probability 3e-6.

Groups of copies cost no pairs among themselves: documents with equal sets are one
node, and every bucket is first verified against one of its members only (a star).
A second round takes the buckets that still hold several components, cuts each into
blocks of bounded size and compares registers block by block inside the tasks; only
pairs of different components whose estimate allows a link leave a task. Every pair
of a bucket is thus either judged or already in one component.

Nulls and odd rows: a text without words (or null) has no shingles and links with
nothing; a null ``doc_id`` gets a null component and is kept; rows that share a
``doc_id`` count as one document, whose sets are linked with each other whether they
are alike or not. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, among, mix, shingle_hashes, stored, text_slices, unused, without

BUCKET_BITS = 9
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 9
BANDS = 32
#: Standard errors below the threshold at which an estimate still goes to verification.
SLACK = 4.5
#: Rows of a bucket that are compared at a time.
BLOCK = 1024


class Sketcher:
    """Shingle sets and their registers."""

    def __init__(self, shingle_words: int):
        self.size = shingle_words
        self.words = Words()
        self.edges = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
        rng = np.random.default_rng(20240607)
        self.order = np.argsort(rng.random((BUCKETS, BUCKETS)), axis=1).astype(np.int16)

    def sets(self, data: np.ndarray, offsets: np.ndarray):
        """The sorted distinct shingle hashes of each text."""
        words, first = self.words.hashes(data, offsets)
        runs, edges = shingle_hashes(words, first, self.size)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a > 1:
                s = np.sort(runs[a:b])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            else:
                yield runs[a:b]

    def registers(self, s: np.ndarray) -> np.ndarray:
        """Registers of a non-empty sorted set."""
        at = np.searchsorted(s, self.edges)
        filled = at < np.append(at[1:], len(s))
        least = s[np.minimum(at, len(s) - 1)] << np.uint64(BUCKET_BITS)
        part, power = np.frexp(least.astype(np.float64))
        zeros = np.minimum(64 - power, 63)
        mantissa = ((2 * part - 1) * (1 << MANTISSA_BITS)).astype(np.int64) % (1 << MANTISSA_BITS)
        out = ((zeros << MANTISSA_BITS | mantissa) << 1).astype(np.uint16)
        if not filled.all():
            empty, full = np.flatnonzero(~filled), np.flatnonzero(filled)
            out[empty] = out[full[self.order[np.ix_(empty, full)].argmin(axis=1)]] | 1
        return out


def sketches(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, registers) of every row; the last two are null
    for an empty set."""

    def run(batches):
        sketch = Sketcher(shingle_words)
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1)):
                sizes, keys, registers = [], [], []
                for s in sketch.sets(data, offsets):
                    sizes.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    registers.append(sketch.registers(s).tobytes() if len(s) else None)
                ids = batch.column(0).slice(row, len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(registers, pa.binary())],
                    names=["doc_id", "n_shingles", "set_key", "registers"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, set_key binary, registers binary"
    )


def shingle_sets(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(set_key, hashes): the whole sets, eight bytes per shingle, sorted; equal sets
    once per task."""

    def run(batches):
        sketch = Sketcher(shingle_words)
        seen = set()
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                new = {}
                for s in sketch.sets(data, offsets):
                    key = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    if len(s) and key not in seen:
                        seen.add(key)
                        new[key] = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(new), pa.binary()), pa.array(list(new.values()), pa.binary())], names=["set_key", "hashes"]
                )

    return docs.select("text").mapInArrow(run, "set_key binary, hashes binary")


def register_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """The keys of the bands: four registers each, mixed with the band's number."""
    salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    return mix((registers[:, : 4 * BANDS] >> 1).view(np.uint64) ^ salt).view(np.int64)


def bands(nodes: DataFrame) -> DataFrame:
    """(band, node, doc_id): one row per band of each node's registers."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                values = band_keys(register_rows(batch.column(1)))
                rows = pa.array(np.repeat(np.arange(len(values)), BANDS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.ravel()), batch.column(0).take(rows), batch.column(2).take(rows)], names=["band", "node", "doc_id"]
                )

    kind, id_kind = (nodes.schema[c].dataType.simpleString() for c in ("node", "doc_id"))
    return nodes.select("node", "registers", "doc_id").mapInArrow(run, f"band bigint, node {kind}, doc_id {id_kind}")


def chance_agreement(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of disjoint sets of ``n`` and ``m`` shingles agree
    because both minima fall into one cell of leading zeros and mantissa."""
    n, m = (np.maximum(x / BUCKETS, 1.0)[:, None] for x in (n, m))
    cell = 0.5 ** np.arange(1, 58)[None, :]
    return ((cell / (1 << MANTISSA_BITS)) * (n * m / (n + m)) * (np.exp(-(n + m) * cell) - np.exp(-2 * (n + m) * cell))).sum(1)


def plausible(a, b, n, m, similarity: float) -> np.ndarray:
    """Whether registers and sizes leave it possible that the sets are linked.

    Of the buckets filled in either set, the share that agrees estimates the
    similarity, as a sample without replacement from the union of the sets.
    """
    own = ((a | b) & 1) == 0
    filled = ((a & b) & 1 == 0).sum(axis=1)
    chance = chance_agreement(n, m)
    estimate = (((a == b) & own).sum(axis=1) / filled - chance) / (1 - chance)
    small, large = np.minimum(n, m), np.maximum(n, m)
    union = (n + m) / (1 + similarity)
    error = np.sqrt(similarity * (1 - similarity) / filled * np.maximum(1 - filled / union, 2 / union))
    # The similarity of two sets is at most the ratio of their sizes.
    return (estimate >= similarity - SLACK * error) & (small >= similarity * large - 1e-9)


def likely(pairs: DataFrame, sketch: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose corrected estimate is not clearly below ``similarity``."""
    side = lambda x: sketch.select(
        F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}")
    )

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (2, 4))
                a, b = (register_rows(batch.column(i)) for i in (3, 5))
                yield batch.select([0, 1]).filter(pa.array(plausible(a, b, n, m, similarity)))

    kind = pairs.schema["a"].dataType.simpleString()
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "n_a", "r_a", "n_b", "r_b").mapInArrow(run, f"a {kind}, b {kind}")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, shingle_words: int, num: int, den: int) -> DataFrame:
    """Pairs with den * |intersection| >= num * |union| on the full sets. ``nodes``:
    (node, set_key, doc_id), the last being a document that has the set."""
    key = lambda x: nodes.select(F.col("node").alias(x), F.col("set_key").alias(f"k_{x}"), F.col("doc_id").alias(f"d_{x}"))
    keyed = stored(pairs.join(key("a"), "a").join(key("b"), "b"), "keyed")
    ids = stored(keyed.select("d_a").distinct().union(keyed.select("d_b").distinct()).distinct(), "ids")
    some = among(docs.select("doc_id", "text"), "doc_id", ids)
    sets = stored(shingle_sets(some, shingle_words), "sets")
    side = lambda x: sets.select(F.col("set_key").alias(f"k_{x}"), F.col("hashes").alias(f"h_{x}"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(bool(den * both >= num * (len(x) + len(y) - both)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    joined = keyed.join(side("b"), "k_b").join(side("a"), "k_a")
    return joined.select("a", "b", "h_a", "h_b").mapInArrow(run, f"a {kind}, b {kind}")


def across(rows: DataFrame, registers: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b), a < b, of one bucket and different components that may be linked.

    ``rows``: (band, node, component, parts), parts being the number of blocks the
    bucket is cut into. A pair is judged in the first bucket it shares only.
    """
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    blocks = (
        rows.join(registers, "node")
        .groupBy("band", part.alias("part"))
        .agg(F.collect_list(F.struct("node", "component", "n_shingles", "registers")).alias("rows"))
    )
    left = blocks.select("band", F.col("part").alias("i"), F.col("rows").alias("x"))
    right = blocks.select("band", F.col("part").alias("j"), F.col("rows").alias("y"))

    def columns(value):
        node, component, n, registers = value.flatten()
        as_numpy = lambda x: x.to_numpy(zero_copy_only=False)
        regs = register_rows(registers)
        return as_numpy(node), as_numpy(component), as_numpy(n).astype(float), regs, band_keys(regs)

    def run(batches):
        for batch in batches:
            low, high = [], []
            for band, same, x, y in zip(*(batch.column(i) for i in range(4)), strict=True):
                node, component, n, regs, keys = columns(x.values)
                node2, component2, n2, regs2, keys2 = columns(y.values)
                for i in range(len(node)):
                    start = i + 1 if same.as_py() else 0
                    other = start + np.flatnonzero(component2[start:] != component[i])
                    if len(other):
                        other = other[keys[i][(keys2[other] == keys[i]).argmax(axis=1)] == band.as_py()]
                        other = other[plausible(regs2[other], regs[i], n2[other], np.full(len(other), n[i]), similarity)]
                        for j in other:
                            low.append(min(node[i], node2[j]))
                            high.append(max(node[i], node2[j]))
            kind = x.type.value_type.field(0).type if batch.num_rows else None
            if low:
                yield pa.RecordBatch.from_arrays([pa.array(low, kind), pa.array(high, kind)], names=["a", "b"])

    kind = rows.schema["node"].dataType.simpleString()
    pairs = left.join(right, "band").where("i <= j").select("band", (F.col("i") == F.col("j")).alias("same"), "x", "y")
    return pairs.mapInArrow(run, f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links but the least of each
    component: the least node it is connected with.

    Large-star and small-star steps alternate, each a grouped minimum and an equi
    join, until every node points at a root. Each round is stored.
    """
    down = stored(
        links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component")).where("node <> component").distinct(),
        "links",
    )
    while True:
        both = down.union(down.select(F.col("component").alias("node"), F.col("node").alias("component")))
        least = both.groupBy("node").agg(F.min("component").alias("low"))
        # large star: larger neighbours of a node move to its least neighbour
        large = (
            both.join(least, "node")
            .where("component > node")
            .select(F.col("component").alias("node"), F.least("node", "low").alias("component"))
            .distinct()
        )
        low = large.groupBy("node").agg(F.min("component").alias("low"))
        # small star: smaller neighbours of a node move to the least of them
        small = (
            large.join(low, "node")
            .select(F.explode(F.array("node", "component")).alias("node"), F.col("low").alias("component"))
            .where("node <> component")
            .distinct()
        )
        after = stored(small, "links")
        if after.exceptAll(down).isEmpty() and down.exceptAll(after).isEmpty():
            return after
        down = after


def near_duplicates(docs: DataFrame, shingle_words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if den * |intersection| >= num * |union| of their sets of
    ``shingle_words``-word shingles. ``component_id`` is the least doc_id a document
    is connected with; only that document is ``kept``.
    """
    similarity = num / den
    sketch = stored(sketches(docs, shingle_words), "sketch")
    nodes = stored(
        sketch.where("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "n_shingles", "registers")).alias("s"))
        .select(F.monotonically_increasing_id().alias("node"), "set_key", "s.*"),
        "nodes",
    )
    # Documents with several sets (rows that share an id), and those with a set and an empty text.
    several = stored(
        sketch.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("set_key").alias("first_key"), F.max("set_key").alias("last_key"), F.count_if(F.col("set_key").isNull()).alias("n"))
        .where("first_key <> last_key or n > 0 and first_key is not null")
        .select("doc_id", "first_key"),
        "several",
    )
    key = lambda x, c: nodes.select(F.col("set_key").alias(c), F.col("node").alias(x))
    own = sketch.select("doc_id", "set_key").join(several, "doc_id").where("set_key <> first_key").select("first_key", "set_key").distinct()
    own = own.join(key("a", "first_key"), "first_key").join(key("b", "set_key"), "set_key").select("a", "b")
    # The star's middle is of the least document, so that few nodes are in several stars.
    member = bands(nodes)
    shared = member.groupBy("band").agg(F.min(F.struct("doc_id", "node")).alias("least"), F.count(F.lit(1)).alias("n"))
    shared = shared.where("n > 1").select("band", F.col("least.node").alias("a"))
    member = stored(member.select("band", "node").join(shared, "band"), "members")
    registers = stored(among(nodes.select("node", "n_shingles", "registers"), "node", member.select("node")), "registers")

    star = stored(member.where("node <> a").select("a", F.col("node").alias("b")).distinct(), "star")
    close = stored(likely(star, registers, similarity), "close")
    links = stored(verified(close, docs, nodes, shingle_words, num, den).union(own), "confirmed")
    # Second round: buckets that still hold several components.
    known = components(links)
    placed = member.join(known, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    open_bands = (
        placed.groupBy("band")
        .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("band", F.ceil(F.col("n") / BLOCK).alias("parts"))
    )
    open_rows = stored(placed.join(open_bands, "band"), "open")
    judged = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = across(open_rows, registers, similarity).distinct().join(judged, ["a", "b"], "left_anti")
    more = stored(verified(stored(found, "pairs"), docs, nodes, shingle_words, num, den), "confirmed")
    known = components(links.union(more))
    # The least document of every component, for each set.
    label = nodes.select("node", "set_key", "doc_id").join(known, "node", "left")
    label = label.select("set_key", "doc_id", F.coalesce("component", "node").alias("component"))
    least = label.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    label = label.join(least, "component").select(F.col("set_key").alias("key"), "component_id")
    placed = sketch.select("doc_id", "n_shingles", "set_key").join(several, "doc_id", "left")
    placed = placed.withColumn("key", F.coalesce("set_key", "first_key")).join(label, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def first_of_each(docs: DataFrame, shingle_words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group of near duplicates in ``docs``.

    It is a row of the least document that :func:`near_duplicates` keeps; of several
    rows with that id, the one with the longest text. Rows without an id are a document
    per distinct text here, after all ids; those without words all stay.
    """
    name = unused(docs, "document")
    missing = F.col("doc_id").isNull()
    text = F.when(missing, F.sha2(F.coalesce("text", F.lit("")), 256))
    keyed = docs.withColumn(name, F.struct(missing.alias("missing"), F.col("doc_id").alias("id"), text.alias("digest")))
    found = near_duplicates(keyed.select(F.col(name).alias("doc_id"), "text"), shingle_words, num, den)
    found = stored(found.select("doc_id", "n_shingles", "kept"), "found")
    gone = found.where(~F.col("kept")).select("doc_id")
    again = found.where(F.col("kept") & (~F.col("doc_id.missing") | (F.col("n_shingles") > 0)))
    again = stored(again.groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    rows = without(keyed, name, gone)
    longest = F.max_by(F.struct(*(docs[c] for c in docs.columns)), F.struct(F.length("text"), F.col("text")))
    one = among(rows, name, again).groupBy(name).agg(longest.alias("row")).select("row.*")
    return without(rows, name, again).select(*docs.columns).union(one)
