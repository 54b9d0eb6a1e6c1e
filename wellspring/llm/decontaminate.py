"""Benchmark passages found in documents by an FM-index per shard.

A phrase is a run of ``size`` consecutive words of a benchmark item, or all words of an
item that has fewer. A shard is a run of documents of about ``SHARD`` bytes within a
task, or one longer document. Its words that occur in phrases become numbers, all else a
separator, and the shard gets an FM-index over these numbers: suffixes sorted by
doubling, their preceding symbols in a wavelet tree, and every ``STEP``-th suffix
position. All phrases are searched backwards at once, one word a step, by ranks in the
wavelet tree; occurrences are located by walking to the next sampled position, their
words compared byte by byte, and overlapping ones merged to spans.

Documents are read once and never shuffled: nothing depends on how often a passage
occurs. The phrases go to the executors whole, as numbers, up to ``PAIRS`` pairs of a
phrase and an item. A larger benchmark is split into blocks of about that size, searched
one after the other in stored documents, and the finds of a document are united.

Words are runs of bytes other than 0x00-0x2F, 0x3A-0x60 and 0x7B-0x7F, after A-Z are
lower-cased: digits, letters and all that is not ASCII.

Odd rows: a null or empty text, or one without words, has no words and no hits. Items
without words take no part; of a null item, words are hit but no item is listed. Rows
that repeat an id are documents (or texts of one item) of their own. Columns other than
those named are not read, so their names do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Words, stored, text_slices

PAIRS = 1 << 19
SHARD = SLICE_BYTES
#: Every how many positions of a shard are sampled.
STEP = 16
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPANS = "array<struct<word: bigint, words: bigint, byte: bigint, bytes: bigint>>"


class Tokens(Words):
    """Words of digits, letters and bytes beyond ASCII."""

    def __init__(self):
        super().__init__()
        self.space[:] = True
        for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
            self.space[first : last + 1] = False

    def of(self, data: np.ndarray, offsets: np.ndarray):
        """(lower-cased bytes, hashes, starts, ends, first word of each text and one
        past the last)"""
        data = self.lower[data]
        hashes, _ = self.hashes(data, offsets)
        return data, hashes, *self.bounds(data, offsets)


def phrases(benchmark: DataFrame, size: int) -> DataFrame:
    """(phrase, item_id): the distinct phrases of every item, as arrays of words."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(1))
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    return (
        benchmark.select("item_id", words.alias("words"))
        .where(n > 0)
        .select("item_id", "words", F.explode(starts).alias("start"))
        .select(F.slice("words", F.col("start"), F.lit(size)).alias("phrase"), "item_id")
        .distinct()
    )


def compact(pairs: DataFrame, size: int) -> dict:
    """Phrases as arrays of numbers, for the executors.

    ``hashes`` are the words' hashes in order, a word's place there plus one its number;
    ``bytes`` and ``ends`` hold the words themselves. ``numbers`` has a phrase per row,
    at its right end, zeros before it. ``items`` of phrase i are those from ``first[i]``
    on, as places in ``ids``.
    """
    found = pairs.select(F.transform("phrase", lambda w: F.xxhash64(w)).alias("phrase"), "item_id").toArrow()
    vocabulary = pairs.select(F.explode("phrase").alias("word")).distinct().select("word", F.xxhash64("word").alias("mark")).toArrow()
    word = vocabulary.column("word").combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(word.buffers()[1], np.int64)[: len(word) + 1] if len(word) else np.zeros(1, np.int64)
    data = np.frombuffer(word.buffers()[2], np.uint8)[: offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
    _, hashes, *_ = Tokens().of(data, offsets) if len(data) else (data, np.zeros(0, np.uint64))
    order = np.argsort(hashes)
    sizes = np.diff(offsets)[order]
    ends = np.cumsum(sizes)
    at = np.repeat(offsets[order] - (ends - sizes), sizes) + np.arange(offsets[-1])
    mark = vocabulary.column("mark").to_numpy()
    by_mark = np.argsort(mark)
    number = np.empty(len(mark), np.int64)
    number[order] = np.arange(1, len(mark) + 1)

    phrase = found.column("phrase").combine_chunks()
    lengths = np.diff(phrase.offsets.to_numpy())
    flat = phrase.flatten().to_numpy()
    table = np.zeros((len(phrase), size), np.int32)
    table[np.arange(size) >= size - lengths[:, None]] = number[by_mark][np.searchsorted(mark[by_mark], flat)] if len(flat) else 0
    numbers, owner = np.unique(table, axis=0, return_inverse=True)
    item = found.column("item_id").combine_chunks()
    ids = item.unique()
    place = pc.index_in(item, ids).to_numpy()
    by_phrase = np.argsort(owner.ravel(), kind="stable")
    return {
        "hashes": hashes[order], "bytes": data[at], "ends": ends, "numbers": numbers, "items": place[by_phrase],
        "first": np.searchsorted(owner.ravel()[by_phrase], np.arange(len(numbers) + 1)), "ids": ids,
    }


def suffixes(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order. Zeros are separators: smaller than all else, each
    smaller than later ones, so no comparison goes beyond one. The text ends with one."""
    n = len(text)
    zeros = np.flatnonzero(text == 0)
    key = text.astype(np.int64) + len(zeros)
    key[zeros] = np.arange(len(zeros))
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)  # place of the first suffix of the same prefix

    def regroup(places: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Ranks of the suffixes at ``places``, which are sorted by ``key``; the places
        that still share theirs."""
        new = np.ones(len(places), bool)
        new[1:] = key[1:] != key[:-1]
        first = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        rank[order[places]] = first
        last = np.ones(len(places), bool)
        last[:-1] = new[1:]
        return places[~(new & last)]

    open_ = regroup(np.arange(n), key[order])
    step = 1
    while len(open_):
        at = order[open_]
        key = rank[at] * n + rank[at + step]
        by = np.argsort(key, kind="stable")
        order[open_] = at[by]
        open_ = regroup(open_, key[by])
        step *= 2
    return order


class WaveletTree:
    """Ranks of symbols in a sequence. Level by level, from the highest bit, the sequence
    is split stably into symbols without the bit and with it; a level keeps how many
    bits there are before every place."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for shift in reversed(range(bits)):
            bit = (symbols >> shift) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((shift, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def below(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where ``place`` ends up after the last level, on the way of ``symbol``: the
        symbol's rank, from the start of its run there on."""
        for shift, ones, zeros in self.levels:
            up = ones[place]
            place = np.where((symbol >> shift) & 1, zeros + up, place - up)
        return place

    def at(self, place: np.ndarray):
        """(symbol at ``place``, where it ends up after the last level)"""
        symbol = np.zeros(len(place), np.int64)
        for shift, ones, zeros in self.levels:
            up = ones[place]
            bit = ones[place + 1] - up
            place = np.where(bit, zeros + up, place - up)
            symbol |= bit.astype(np.int64) << shift
        return symbol, place


class Index:
    """FM-index of numbers up to ``largest``; zeros are separators, one is at the end."""

    def __init__(self, text: np.ndarray, largest: int, step: int = STEP):
        order = suffixes(text)
        before = text[order - 1]
        self.tree = WaveletTree(before, max(1, int(largest).bit_length()))
        self.counts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1))))
        all_symbols = np.arange(largest + 1)
        self.shift = self.counts[:-1] - self.tree.below(all_symbols, np.zeros(largest + 1, np.int64))
        # A separator's row says nothing about the one before, so the suffixes that
        # follow one are sampled as well.
        sampled = (order % step == 0) | (before == 0)
        self.sampled = np.concatenate(([0], np.cumsum(sampled)))
        self.positions = order[sampled]

    def search(self, numbers: np.ndarray):
        """(phrase, first row, one past the last) of the phrases that occur; ``numbers``
        as :func:`compact` gives them."""
        which = np.arange(len(numbers))
        symbol = numbers[:, -1]
        low, high = self.counts[symbol], self.counts[symbol + 1]
        for column in range(numbers.shape[1] - 2, -1, -1):
            there = high > low
            which, low, high = which[there], low[there], high[there]
            symbol = numbers[which, column]
            more = symbol > 0
            low, high = low.copy(), high.copy()
            for ends in (low, high):
                ends[more] = self.shift[symbol[more]] + self.tree.below(symbol[more], ends[more])
        there = high > low
        return which[there], low[there], high[there]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at ``rows``."""
        rows, walked = rows.copy(), np.zeros(len(rows), np.int64)
        away = np.arange(len(rows))
        while len(away := away[self.sampled[rows[away] + 1] == self.sampled[rows[away]]]):
            symbol, place = self.tree.at(rows[away])
            rows[away] = self.shift[symbol] + place
            walked[away] += 1
        return self.positions[self.sampled[rows]] + walked


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``sizes`` many."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def occurrences(known: dict, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
    """(phrase, first word) of every occurrence in a shard's words."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    vocabulary = known["hashes"]
    if not len(vocabulary) or not len(hashes):
        return none
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    here = vocabulary[place] == hashes
    words = np.flatnonzero(here)
    if not len(words):
        return none
    # A separator before a word that begins a document or follows another word's gap.
    new = np.ones(len(words), bool)
    new[1:] = np.diff(words) > 1
    begins = np.zeros(len(hashes) + 1, bool)
    begins[first] = True
    new |= begins[words]
    spot = np.arange(len(words)) + np.cumsum(new)
    text = np.zeros(spot[-1] + 2, np.int32)
    text[spot] = place[words] + 1
    word_at = np.full(len(text), -1)
    word_at[spot] = words
    index = Index(text, len(vocabulary))
    which, low, high = index.search(known["numbers"])
    if not len(which):
        return none
    phrase = np.repeat(which, high - low)
    begin = word_at[index.locate(runs(low, high - low))]
    # Equal hashes are no proof: the words' bytes decide.
    sizes = (known["numbers"][phrase] > 0).sum(axis=1)
    hit = np.unique(runs(begin, sizes))
    number = place[hit]
    lengths = known["ends"][number] - np.concatenate(([0], known["ends"]))[number]
    equal = ends[hit] - starts[hit] == lengths
    same = hit[equal]
    if len(same):
        lengths = lengths[equal]
        own = data[runs(starts[same], lengths)] == known["bytes"][runs(known["ends"][number[equal]] - lengths, lengths)]
        equal[equal] = np.logical_and.reduceat(own, np.cumsum(lengths) - lengths)
    if not equal.all():
        bad = np.zeros(len(hashes) + 1, np.int64)
        bad[hit[~equal] + 1] = 1
        bad = np.cumsum(bad)
        whole = bad[begin + sizes] == bad[begin]
        phrase, begin = phrase[whole], begin[whole]
    return phrase, begin


def found_in(known: dict, tokens: Tokens, data: np.ndarray, offsets: np.ndarray):
    """Of the texts of a shard: (words, [spans], [items]); spans as (first word, words,
    first byte, bytes), items as ids, none for null."""
    data, hashes, starts, ends, first = tokens.of(data, offsets)
    phrase, begin = occurrences(known, data, hashes, starts, ends, first)
    texts = len(offsets) - 1
    spans: list[list[dict]] = [[] for _ in range(texts)]
    items: list[list] = [[] for _ in range(texts)]
    if len(phrase):
        sizes = (known["numbers"][phrase] > 0).sum(axis=1)
        depth = np.bincount(begin, minlength=len(hashes) + 1) - np.bincount(begin + sizes, minlength=len(hashes) + 1)
        hit = np.cumsum(depth)[:-1] > 0
        before, after = np.zeros(len(hit), bool), np.zeros(len(hit), bool)
        before[1:], after[:-1] = hit[:-1], hit[1:]
        edges = first[(first > 0) & (first < len(hit))]
        before[edges], after[edges - 1] = False, False
        span_from, span_to = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after)
        text = np.searchsorted(first, span_from, "right") - 1
        for t, a, b in zip(text.tolist(), span_from.tolist(), span_to.tolist(), strict=True):
            byte = int(starts[a] - offsets[t])
            spans[t].append({"word": a - int(first[t]), "words": b - a + 1, "byte": byte, "bytes": int(ends[b] - offsets[t]) - byte})
        text = np.searchsorted(first, begin, "right") - 1
        pairs = np.unique(text * len(known["numbers"]) + phrase)
        text, phrase = pairs // len(known["numbers"]), pairs % len(known["numbers"])
        counts = known["first"][phrase + 1] - known["first"][phrase]
        pairs = np.unique(np.repeat(text, counts) * len(known["ids"]) + known["items"][runs(known["first"][phrase], counts)])
        ids = known["ids"].to_pylist()
        for pair in pairs.tolist():
            item = ids[pair % len(ids)]
            if item is not None:
                items[pair // len(ids)].append(item)
    return np.diff(first), spans, items


def merged(spans: list[dict]) -> list[dict]:
    """Spans of one text with overlapping and touching ones made one."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["word"], s["words"])):
        last = out[-1] if out else None
        if last and s["word"] <= last["word"] + last["words"]:
            end = max(last["byte"] + last["bytes"], s["byte"] + s["bytes"])
            last["words"] = max(last["word"] + last["words"], s["word"] + s["words"]) - last["word"]
            last["bytes"] = end - last["byte"]
        else:
            out.append(dict(s))
    return out


def searched(rows: DataFrame, key: str, known: dict, item_kind: str) -> DataFrame:
    """(key, n_words, spans, items) of every row (key, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(known)
    limit = max(SHARD, min(16 * SHARD, 32 * len(known["numbers"])))
    schema = f"key {rows.schema[key].dataType.simpleString()}, n_words bigint, spans {SPANS}, items array<{item_kind}>"

    def run(batches):
        known, tokens = shared.value, Tokens()
        span = pa.list_(pa.struct([(n, pa.int64()) for n in ("word", "words", "byte", "bytes")]))
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1), limit):
                n_words, spans, items = found_in(known, tokens, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(n_words)), pa.array(n_words, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(known["ids"].type))],
                    names=["key", "n_words", "spans", "items"],
                )

    return rows.select(key, "text").mapInArrow(run, schema)


def benchmark_spans(docs: DataFrame, benchmark: DataFrame, size: int = 10, most: int = PAIRS) -> DataFrame:
    """doc_id, n_words, n_hit, spans, items of every row of ``docs`` (doc_id, text).

    ``spans`` are the words inside any occurrence of a phrase, merged, in order: first
    word, words, first byte of the UTF-8 text, bytes. ``n_hit`` is the words they hold.
    ``items`` are the distinct ids of ``benchmark`` (item_id, text) whose phrases occur,
    in no order. ``most`` bounds the pairs of a phrase and an item that are held at once.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()
    pairs = stored(phrases(benchmark, size), "phrases")
    blocks = max(1, -(-pairs.count() // most))
    if blocks == 1:
        found = searched(docs, "doc_id", compact(pairs, size), kind).withColumnRenamed("key", "doc_id")
    else:
        rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "documents")
        block = F.pmod(F.xxhash64("phrase", "item_id"), F.lit(blocks))
        parts = None
        for i in range(blocks):
            part = searched(rows, "row", compact(pairs.where(block == i), size), kind)
            part = stored(part if i == 0 else part.where(F.size("spans") > 0), "finds")
            parts = part if parts is None else parts.union(part)
        together = lambda c: F.flatten(F.collect_list(c)).alias(c)
        united = parts.groupBy("key").agg(F.max("n_words").alias("n_words"), together("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

        def run(batches):
            for batch in batches:
                spans = pa.array([merged(s) for s in batch.column("spans").to_pylist()], batch.column("spans").type)
                yield batch.set_column(batch.schema.get_field_index("spans"), "spans", spans)

        united = united.mapInArrow(run, united.schema)
        found = rows.select("row", "doc_id").join(united, F.col("row") == F.col("key")).select("doc_id", "n_words", "spans", "items")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["words"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items")


def without_spans(text: Column, spans: Column) -> Column:
    """The text less the bytes of ``spans``, as a column; null stays null."""
    data = text.cast("binary")
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["byte"] + s["bytes"]))
    starts = F.concat(F.transform(spans, lambda s: s["byte"]), F.array(F.octet_length(data).cast("bigint")))
    kept = F.zip_with(starts, ends, lambda to, since: F.substring(data, (since + 1).cast("int"), (to - since).cast("int")).cast("string"))
    return F.when(text.isNotNull(), F.array_join(kept, ""))
