"""Sampled segmentations of texts into SentencePiece pieces, and decoding.

A text is prefixed with a space and its segmentations are the paths of a lattice whose
edges are the pieces of a vocabulary. A piece with score rank r weighs like
1 / (r + 2) (Zipf's law over the merge order of a BPE model), raised to the power
``alpha``; the probability of a path is the product of its weights over the sum of all
paths. Characters without a piece of their own are spelled in byte pieces, so every
text has a segmentation and decoding gives the text back.

For each text the ``k`` paths with the largest Gumbel-perturbed log probabilities are
found, which are ``k`` distinct draws without replacement, by a best-first search: the
agenda holds sets of paths (a prefix that leaves the paths drawn so far at some
node), each with its exact total log probability, known from sums over the lattice,
and its largest perturbed value, a Gumbel variate truncated at the value of the set it
was split from. Popping the best set draws its best path and splits the rest along it.
The k+1st perturbed value is the threshold of the sample; a path with log probability
p is included with probability 1 - exp(-exp(p - threshold)).

No piece reaches over the beginning of a run of spaces, so the lattice is a chain of
small ones, one per word. Those are built once per distinct word of about
``SLICE`` bytes of text, all words at once, and fresh paths are drawn for all words of
all texts at once. Draws depend on row key, draw number and place in the text only,
not on how rows are dealt to tasks.

Odd rows: null counts as empty; an empty text has one segmentation, without pieces.
Texts with fewer than ``k`` segmentations give all of them, with inclusion 1. Rows
that share key and text get equal samples. Memory follows the longest text. Other
columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, text_slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 1 << 20
#: Paths that leave a path where its prefix has lost so much log probability are left
#: out of the agenda if others leave with at least e^(FAR / 2) times their mass. They
#: would change a draw with probability under 1e-20.
FAR = 120.0
#: Uniform numbers made for every text at once; a search that needs more makes them.
READY = 96
SPACE = 0x20
MARK = "▁"  # how pieces write a space


class Vocabulary(NamedTuple):
    """Pieces as bytes (b"" if never emitted), log weights, and a trie over them."""

    pieces: list[bytes]
    weights: np.ndarray
    byte_ids: np.ndarray
    root: np.ndarray  # the state after one byte, or 0
    pair: np.ndarray  # the state after two bytes, or 0
    keys: np.ndarray  # state * 256 + byte, by place in a hash table; -1 where it is free
    targets: np.ndarray
    ends: np.ndarray  # the piece that ends in a state, or -1
    single: np.ndarray  # bytes that no piece but their byte piece has


def vocabulary(path: str = MODEL) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces, byte_ids, plain = [b""] * n, np.zeros(256, np.int32), []
    for i in range(n):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            pieces[i] = bytes([int(name[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[i] = name.replace(MARK, " ").encode()
            plain.append(i)
    if any(b" " in pieces[i].lstrip(b" ") for i in plain):
        raise ValueError("a piece reaches over the beginning of a word")
    weights = np.full(n, -np.log(n + 2.0))
    for rank, i in enumerate(sorted(plain, key=lambda i: (-model.get_score(i), i))):
        weights[i] = -np.log(rank + 2.0)
    states: dict[tuple[int, int], int] = {}
    ends = [-1]
    for i in plain:
        at = 0
        for b in pieces[i]:
            if (at, b) not in states:
                states[at, b] = len(ends)
                ends.append(-1)
            at = states[at, b]
        ends[at] = i
    table, targets = hashed(np.array([s * 256 + b for s, b in states], np.int64), np.array(list(states.values()), np.int32))
    root, pair = np.zeros(256, np.int32), np.zeros(1 << 16, np.int32)
    first = {s: b for (at, b), s in states.items() if at == 0}
    root[list(first.values())] = list(first)
    for (at, b), s in states.items():
        if at in first:
            pair[first[at] * 256 + b] = s
    used = np.zeros(256, bool)
    used[np.frombuffer(b"".join(pieces[i] for i in plain), np.uint8)] = True
    return Vocabulary(pieces, weights, byte_ids, root, pair, table, targets, np.array(ends, np.int32), ~used & (np.arange(256) < 128))


def slot(keys: np.ndarray, size: int) -> np.ndarray:
    """First place of a key in a hash table of ``size``, a power of two."""
    x = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(65 - size.bit_length())).astype(np.int64)


def hashed(keys: np.ndarray, values: np.ndarray):
    """(keys, values): an open hash table at most a quarter full."""
    size = 4 << int(len(keys)).bit_length()
    table, held = np.full(size + len(keys), -1, np.int64), np.zeros(size + len(keys), np.int32)
    at, rest = slot(keys, size), np.arange(len(keys))
    while len(rest):
        free = rest[table[at[rest]] < 0]
        _, first = np.unique(at[free], return_index=True)
        table[at[free[first]]], held[at[free[first]]] = keys[free[first]], values[free[first]]
        rest = rest[table[at[rest]] != keys[rest]]
        at[rest] += 1
    return table, held


class Lattice:
    """The lattices of distinct words, laid one after the other.

    Node = place in ``data``, plus one end node per word. The edges of a node are
    ``first[node]`` up to ``first[node + 1]``, with piece ``piece``, next node ``after``,
    conditional log probability ``log_p`` and the running sum ``reach`` of the
    probabilities (beyond 1 at the last edge).
    """

    def __init__(self, v: Vocabulary, alpha: float, data: np.ndarray, lengths: np.ndarray):
        n = len(data)
        ends = np.cumsum(lengths) - 1  # the end node of each word
        end = np.repeat(ends, lengths).astype(np.int32)
        start, size, piece = self.matches(v, data, end)
        order = np.argsort(start, kind="stable")
        start, self.piece = start[order], piece[order]
        self.after = start + size[order]
        del size, piece, order
        self.first = np.searchsorted(start, np.arange(n + 1, dtype=np.int32)).astype(np.int32)
        count = np.diff(self.first)
        total = np.full(n, -np.inf)
        total[ends] = 0.0
        # from the end of the words towards their beginnings
        nodes = np.flatnonzero(count).astype(np.int32)
        away = end[nodes] - nodes
        by_level = np.argsort(away.astype(np.uint16) if len(away) and away.max() < 1 << 16 else away, kind="stable")
        nodes, away, many = nodes[by_level], away[by_level], count[nodes[by_level]]
        edge_from = np.concatenate(([0], np.cumsum(many)))
        edges = np.repeat(self.first[nodes] - edge_from[:-1].astype(np.int32), many) + np.arange(edge_from[-1], dtype=np.int32)
        weight, after = (alpha * v.weights)[self.piece[edges]], self.after[edges]
        self.log_p = np.empty(len(edges))
        level = np.flatnonzero(np.concatenate(([True], away[1:] != away[:-1], [True]))) if len(nodes) else []
        for a, b in zip(level[:-1], level[1:], strict=True):
            own = slice(edge_from[a], edge_from[b])
            x = weight[own] + total[after[own]]
            at = edge_from[a:b] - edge_from[a]
            top = np.maximum.reduceat(x, at)
            sums = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, many[a:b])), at))
            total[nodes[a:b]] = sums
            weight[own] = x - np.repeat(sums, many[a:b])
        self.log_p[edges] = np.minimum(weight, 0.0)
        running = np.concatenate(([0.0], np.cumsum(np.exp(self.log_p))))
        self.reach = running[1:] - np.repeat(running[self.first[:-1]], count)
        self.reach[self.first[1:][count > 0] - 1] = 2.0
        self.is_end = np.zeros(n, bool)
        self.is_end[ends] = True

    def rest(self, edges: np.ndarray) -> np.ndarray:
        """Log probability of leaving each edge's node by another edge."""
        with np.errstate(divide="ignore"):
            return np.log(-np.expm1(self.log_p[edges]))

    @staticmethod
    def matches(v: Vocabulary, data: np.ndarray, end: np.ndarray):
        """(node, bytes, piece) of all edges."""
        at, state, depth = np.flatnonzero(np.arange(len(data)) < end).astype(np.int32), np.zeros(0, np.int32), 0
        found = []
        octets = data.astype(np.int64)
        size = 1 << (len(v.keys).bit_length() - 1)
        lead = np.array([1 if b < 0x80 else 0 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in range(256)])
        spelled = lead[data]  # bytes of the character that begins here, unless it has a piece
        spelled[end] = 0
        while len(at):
            if depth < 2:
                to = v.pair[octets[at] << 8 | octets[at + 1]] if depth else v.root[data[at]]
                ok = to > 0
            else:
                key = (state.astype(np.int64) << 8) | octets[at + depth]
                j = slot(key, size)
                held = v.keys[j]
                late = np.flatnonzero((held != key) & (held >= 0))  # the place is another key's
                while len(late):
                    j[late] += 1
                    held[late] = v.keys[j[late]]
                    late = late[(held[late] != key[late]) & (held[late] >= 0)]
                ok, to = held == key, v.targets[j]
            at, state = at[ok], to[ok]
            depth += 1
            piece = v.ends[state]
            hit = piece >= 0
            found.append((at[hit], np.full(np.count_nonzero(hit), depth, np.int32), piece[hit]))
            whole = at[hit]
            spelled[whole[spelled[whole] == depth]] = 0
            more = at + depth < end[at]
            at, state = at[more], state[more]
        for k in range(4):
            own = (np.flatnonzero(spelled > k) + k).astype(np.int32)
            found.append((own, np.ones(len(own), np.int32), v.byte_ids[data[own]]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def draw(self, nodes: np.ndarray, keys: np.ndarray, places: np.ndarray):
        """A random path from each node: (edges of all paths in order, where each path
        begins and one past the last)."""
        taken, owners = [], []
        live, steps = np.arange(len(nodes), dtype=np.int32), np.zeros(len(nodes) + 1, np.int32)
        at, ahead = nodes, places - nodes  # a path's place is its node and what it is ahead of it
        while len(live):
            u = uniform(keys, ahead + at)
            edge = self.first[at]
            late = np.flatnonzero(u >= self.reach[edge])
            u = u[late]
            while len(late):
                edge[late] += 1
                more = np.flatnonzero(u >= self.reach[edge[late]])
                late, u = late[more], u[more]
            taken.append(edge)
            owners.append(live)
            steps[live + 1] += 1
            at = self.after[edge]
            go = np.flatnonzero(~self.is_end[at])
            live, at, ahead, keys = live[go], at[go], ahead[go], keys[go]
        begins = np.cumsum(steps, dtype=np.int64)
        out = np.empty(begins[-1], np.int32)
        for step, (o, edge) in enumerate(zip(owners, taken, strict=True)):
            out[begins[o] + step] = edge
        return out, begins


def uniform(keys: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) by key and counter: :func:`mix` of both, in place."""
    x = keys + counters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    x >>= np.uint64(12)
    u = x.astype(np.float64)
    u += 0.5
    u *= 2.0**-52
    return u


def truncated(place: np.ndarray, u: np.ndarray, most: float) -> np.ndarray:
    """Gumbel variates at ``place``, given that they are at most ``most``."""
    with np.errstate(over="ignore"):
        return np.where(place == -np.inf, -np.inf, place - np.log(np.exp(np.minimum(place - most, 700.0)) - np.log(u)))


class Path(NamedTuple):
    edges: np.ndarray
    word_ends: np.ndarray  # one past the last edge of each word
    sums: np.ndarray  # log probability of the edges before each
    log_prob: float
    bounds: np.ndarray  # best perturbed value of the paths that leave here


def search(lattice: Lattice, words: np.ndarray, draws: list, key: np.ndarray, ready: np.ndarray, k: int):
    """The k best perturbed paths through ``words`` (their first nodes), best first,
    as (edges, log probability), and the threshold. ``draws[j]``: a fresh path as
    (edges, word ends), used for whatever the jth path does not inherit. ``ready`` are
    the first of the key's uniform numbers."""
    serial = 0

    def fresh(n: int) -> np.ndarray:
        nonlocal serial
        serial += n
        return ready[serial - n : serial] if serial <= len(ready) else uniform(key, np.arange(serial - n, serial))

    def path(edges, word_ends, branch: int, most: float) -> Path:
        sums = np.empty(len(edges) + 1)
        sums[0] = 0.0
        np.cumsum(lattice.log_p[edges], out=sums[1:])
        # Sums fall, so the part that is near enough is found from its own end.
        far, stop = len(edges), branch + 64
        while stop <= len(edges) and sums[stop] > sums[branch] - FAR:
            stop *= 2
        stop = min(stop, len(edges))
        far = min(int(np.searchsorted(-sums[: stop + 1], FAR - sums[branch])), len(edges))
        place = sums[branch:far] + lattice.rest(edges[branch:far])
        if far < len(edges) and not place.max(initial=-np.inf) > sums[far] + FAR / 2:
            place = sums[branch:-1] + lattice.rest(edges[branch:])  # nothing leaves nearby
        bounds = np.full(branch + len(place), -np.inf)
        bounds[branch:] = truncated(place, fresh(len(place)), most)
        return Path(edges, word_ends, sums, float(sums[-1]), bounds)

    best = float(-np.log(-np.log(fresh(1)[0])))
    paths = [path(*draws[0], 0, best)]
    steps = []  # where the best of the rest leaves each path
    left: dict[tuple[int, int], list[int]] = {}  # edges drawn at a node of a path
    while True:
        steps += [int(p.bounds.argmax()) if len(p.bounds) else -1 for p in paths[len(steps) :]]
        tops = [float(p.bounds[at]) if at >= 0 else -np.inf for p, at in zip(paths, steps, strict=True)]
        source = tops.index(max(tops))
        if len(paths) == k or tops[source] == -np.inf:
            return [(p.edges, p.log_prob) for p in paths], tops[source]
        old, most, step = paths[source], tops[source], steps[source]
        drawn = left.setdefault((source, step), [int(old.edges[step])])
        word = int(np.searchsorted(old.word_ends, step, "right"))
        node = int(words[word] if step == (old.word_ends[word - 1] if word else 0) else lattice.after[old.edges[step - 1]])
        # one of the node's other edges, then to the end of the word, then a fresh path
        options = [e for e in range(lattice.first[node], lattice.first[node + 1]) if e not in drawn]
        mass = np.exp(lattice.log_p[options])
        tail = [choose(options, mass, fresh(1)[0])]
        drawn.append(tail[0])
        rest = float(mass.sum() - np.exp(lattice.log_p[tail[0]])) if len(options) > 1 else 0.0
        place = float(old.sums[step]) + (math.log(rest) if rest > 0 else -math.inf)
        old.bounds[step] = truncated_one(place, float(fresh(1)[0]), most)
        steps[source] = int(old.bounds.argmax())
        while not lattice.is_end[node := lattice.after[tail[-1]]]:
            options = range(lattice.first[node], lattice.first[node + 1])
            tail.append(choose(options, np.exp(lattice.log_p[options.start : options.stop]), fresh(1)[0]))
        other, other_ends = draws[len(paths)]
        seam = other_ends[word]
        edges = np.concatenate((old.edges[:step], tail, other[seam:]))
        shift = step + len(tail)
        word_ends = np.concatenate((old.word_ends[:word], [shift], other_ends[word + 1 :] - seam + shift))
        paths.append(path(edges, word_ends, step + 1, most))


def truncated_one(place: float, u: float, most: float) -> float:
    """:func:`truncated` for one number."""
    return place if place == -math.inf else place - math.log(math.exp(min(place - most, 700.0)) - math.log(u))


def choose(options, mass: np.ndarray, u: float) -> int:
    running = list(accumulate(mass.tolist()))
    return int(options[min(bisect_right(running, float(u) * running[-1]), len(running) - 1)])


def words_of(v: Vocabulary, data: np.ndarray, offsets: np.ndarray):
    """Texts with a space before each: (bytes, text begins, word begins). A word begins
    at a run of spaces and around bytes that no longer piece has."""
    n = len(offsets) - 1
    some = np.diff(offsets) > 0
    shift = np.concatenate(([0], np.cumsum(some)))
    out = np.full(len(data) + shift[-1], SPACE, np.uint8)
    out[np.arange(len(data)) + np.repeat(shift[1:], np.diff(offsets))] = data
    begins = offsets + shift
    space, alone = out == SPACE, v.single[out]
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut |= alone
    cut[1:] |= alone[:-1]
    cut[begins[:n][some]] = True
    return out, begins, np.flatnonzero(cut)


def samples(v: Vocabulary, alpha: float, k: int, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray):
    """Per text: ([(ids, log probability)], threshold)."""
    octets, begins, word = words_of(v, data, offsets)
    size = np.diff(np.append(word, len(octets)))
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    # equal words by a 64-bit polynomial of their bytes
    power = np.full(int(size.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    inside = np.arange(len(octets)) - np.repeat(word, size)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes[octets] * power[inside])))
    name = mix(sums[word + size] - sums[word] + size.astype(np.uint64))
    _, example, kind = np.unique(name, return_index=True, return_inverse=True)
    lengths = size[example] + 1
    base = (np.cumsum(lengths) - lengths).astype(np.int32)
    source = np.repeat(word[example] - base, lengths) + np.arange(lengths.sum())
    lattice = Lattice(v, alpha, octets[np.minimum(source, max(len(octets) - 1, 0))], lengths)
    nodes = base[kind]
    text = np.searchsorted(begins, word, "right") - 1
    in_text = np.searchsorted(word, begins)  # the words of each text
    fresh = []
    for j in range(k):
        stream = mix(keys + np.uint64((j + 1) * 0xC2B2AE3D27D4EB4F % (1 << 64)))
        fresh.append(lattice.draw(nodes, stream[text], word - begins[text]))
    own = mix(keys ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    ready = uniform(own[:, None], np.arange(READY))
    for i in range(len(keys)):
        a, b = in_text[i], in_text[i + 1]
        if a == b:
            yield [(np.zeros(0, np.int32), 0.0)], -np.inf
            continue
        draws = [(edges[at[a] : at[b]], at[a + 1 : b + 1] - at[a]) for edges, at in fresh]
        found, threshold = search(lattice, nodes[a:b], draws, own[i : i + 1], ready[i], k)
        yield [(lattice.piece[edges], log_prob) for edges, log_prob in found], threshold


def encoded(v: Vocabulary, alpha: float, k: int, batches):
    """Batches (key, seed, text) -> batches of samples."""
    for batch in batches:
        for row, data, offsets in text_slices(batch.column(2), SLICE):
            n = len(offsets) - 1
            keys = mix(batch.column(1).slice(row, n).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            rows, ranks, ids, logs, inclusion = [], [], [], [], []
            for i, (found, threshold) in enumerate(samples(v, alpha, k, data, offsets, keys)):
                for rank, (piece, log_prob) in enumerate(found):
                    rows.append(row + i)
                    ranks.append(rank + 1)
                    ids.append(piece)
                    logs.append(log_prob)
                    inclusion.append(log_inclusion(log_prob, threshold))
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            pieces = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(ranks, pa.int32()), pieces, pa.array(logs), pa.array(inclusion)],
                names=["key", "sample", "ids", "log_prob", "log_inclusion"],
            )


def log_inclusion(log_prob: float, threshold: float) -> float:
    """log(1 - exp(-exp(p - threshold)))."""
    x = log_prob - threshold
    return 0.0 if x > 700 else float(np.log(-np.expm1(-np.exp(x)))) if x > -30 else x


def decoded(v: Vocabulary, batches):
    """Batches of samples -> the same with the texts their pieces spell, without the
    space that was put before them."""
    spelled = np.frombuffer(b"".join(v.pieces), np.uint8)
    size = np.array([len(p) for p in v.pieces], np.int32)
    begin = np.cumsum(size) - size
    for batch in batches:
        ids = batch.column(2)
        flat, rows = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        width = size[flat]
        ends = np.concatenate(([0], np.cumsum(width)))
        octets = spelled[np.repeat((begin[flat] - ends[:-1]).astype(np.int32), width) + np.arange(ends[-1], dtype=np.int32)]
        first = ends[rows[:-1][np.diff(rows) > 0]]
        octets = np.delete(octets, first)
        begins = ends[rows] - np.concatenate(([0], np.cumsum(np.diff(rows) > 0)))
        texts = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(octets))
        yield pa.RecordBatch.from_arrays([*batch.columns, texts.cast(pa.string())], names=[*batch.schema.names, "decoded"])


def sample(docs: DataFrame, k: int = 2, alpha: float = 1.0, model: str = MODEL, seed: Column | None = None) -> DataFrame:
    """doc_id, sample (from 1), ids, log_prob, log_inclusion, decoded: up to ``k``
    distinct segmentations of every row's text, in the order they were drawn, and the
    text each decodes to. ``seed``: a 64-bit row key, the hash of doc_id by default."""
    v = vocabulary(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.xxhash64("doc_id") if seed is None else seed.cast("bigint")
    rows = docs.select(F.col("doc_id").alias("key"), key.alias("seed"), "text")
    out = rows.mapInArrow(
        lambda batches: decoded(v, encoded(v, alpha, k, batches)),
        f"key {kind}, sample int, ids array<int>, log_prob double, log_inclusion double, decoded string",
    )
    return out.withColumnRenamed("key", "doc_id")
