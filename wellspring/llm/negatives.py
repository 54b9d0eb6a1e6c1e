"""Hard negatives by anchor-clustered shared lists.

Scores are integer inner products of floor(256 * x). Anchors are dealt to clusters by
direction, around centres found on a sample of at most ``SAMPLE`` of them. For a cluster,
no member's score with a candidate can be more than the member's length times
|candidate| * cos(max(0, a - r)), where a is the angle between candidate and centre and r
the largest between a member and the centre. A task sorts its candidates by that bound
once for a cluster; every member walks this one list until no bound further on reaches
the worst score it still needs, which proves that nothing is missed.

Two walks: the first finds the positives, the rows of the anchor's own label with the
highest scores. It starts from the scores among the anchors of a block themselves, which
are candidates too. The second finds the negatives of every positive within its band of
scores, whose lower end stops the walk from the start.

Anchors and candidates are sorted by cluster and packed into blocks of bounded size, so
a list holds candidates of similar direction and most walks end early where the data
has structure. Groups of blocks meet pairwise: a block crosses the network once per
group of the other side. Tasks return at most the wanted rows for each anchor or
positive, whatever copies there are.

Odd rows: rows without ``vec_id`` or label, or whose vector is null, empty or holds null
or non-finite components, take no part. Vectors meet those of their own length only. A
row is not its own candidate, nor is any row with its id. Rows that repeat an id are
otherwise rows of their own: each is a candidate, each anchor among them gets its own
positives and each positive its own negatives, ranked apart (equal rows give equal
results). Components beyond 64 bits are set to the nearest 64-bit integer, scores beyond
+-(2^62 - 1) to that bound. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocks import CANDIDATES, QUERIES, finite, matrix, packed
from .common import stored
from .topk import LARGEST, products

SAMPLE = 4096
CLUSTERS = 64
#: Candidates scored at a time on the way down a list.
STRIDE = 512
#: Blocks of a group: a task holds one group of each side.
ANCHOR_BLOCKS = 8
CANDIDATE_BLOCKS = 2
LEAST = -(1 << 63)


def labelled(rows: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part, x being the label and the components."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * 256).cast("bigint"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("embedding")))
    return rows.select("vec_id", F.concat(F.array(F.col("label").cast("bigint")), x).alias("x"))


def lengths(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    return np.sqrt((x * x).sum(axis=1))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; those of length 0 stay."""
    return x / np.maximum(lengths(x), 1e-300)[:, None]


def centres(anchors: DataFrame) -> dict[int, np.ndarray]:
    """Directions the anchors of each vector length gather around, by spherical k-means
    on the sample. A length that is not in the sample has none."""
    sample: dict[int, list] = {}
    for r in anchors.select("x").orderBy(F.xxhash64("x"), "x").limit(SAMPLE).collect():
        sample.setdefault(len(r["x"]), []).append(r["x"][1:])
    found = {}
    for width, rows in sample.items():
        x = unit(np.array(rows, dtype=float))
        c = x[: min(CLUSTERS, -(-len(x) // 8))]
        for _ in range(8):
            nearest = (x @ c.T).argmax(axis=1)
            sums = np.zeros_like(c)
            np.add.at(sums, nearest, x)
            c = np.where(lengths(sums)[:, None] > 1e-9, unit(sums), c)
        found[width] = c
    return found


def cluster(x: np.ndarray, points: np.ndarray | None) -> np.ndarray:
    """The nearest centre of each row of components; 0 where there is none."""
    return np.zeros(len(x), np.int64) if points is None else (unit(x) @ points.T).argmax(axis=1)


def in_blocks(rows: DataFrame, points: dict[int, np.ndarray], size: int) -> DataFrame:
    """Blocks of rows of similar direction."""

    def run(batches):
        for batch in batches:
            x = batch.column(1)
            widths = pc.list_value_length(x).to_numpy()
            numbers = np.zeros(len(widths), np.int32)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                numbers[at] = cluster(x.take(pa.array(at)).flatten().to_numpy().reshape(-1, width)[:, 1:], points.get(int(width)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], names=["vec_id", "x", "cluster"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    keys = [F.size("x").alias("width"), F.col("cluster"), F.col("vec_id"), F.monotonically_increasing_id().alias("row")]
    near = rows.mapInArrow(run, f"vec_id {kind}, x array<bigint>, cluster int").select("x", *keys)
    order = ["width", "cluster", "vec_id", "row"]
    return packed(near.repartitionByRange(*order).sortWithinPartitions(*order), size)


def met(anchors: DataFrame, candidates: DataFrame):
    """Groups of anchor blocks cogrouped with groups of candidate blocks, all pairs."""
    here, there = (max(1, -(-df.count() // size)) for df, size in ((anchors, ANCHOR_BLOCKS), (candidates, CANDIDATE_BLOCKS)))
    group = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("a_group", group(here)).withColumn("c_group", every(there))
    right = candidates.withColumn("c_group", group(there)).withColumn("a_group", every(here))
    return left.groupBy("a_group", "c_group").cogroup(right.groupBy("a_group", "c_group"))


class Candidates:
    """The candidates of one vector length in a task."""

    def __init__(self, blocks: pa.Table, width: int):
        parts = [i for i, w in enumerate(blocks["dim"].to_pylist()) if w == width]
        data = [matrix(blocks["data"][i], width, np.int64) for i in parts] or [np.zeros((0, width), np.int64)]
        data = np.concatenate(data)
        self.ids = [v for i in parts for v in blocks["ids"][i].as_py()]
        self.labels, self.x = data[:, 0], np.ascontiguousarray(data[:, 1:])
        self.sizes, self.unit = lengths(self.x), unit(self.x)
        # The later in the order of ids, the lower; added to a score it settles ties.
        place = np.empty(len(data), np.int64)
        place[np.argsort(np.array(self.ids), kind="stable")] = np.arange(len(data))
        self.tie = len(data) - 1 - place
        self.by_tie = np.argsort(self.tie)
        self.id_array = np.array(self.ids)

    def ordered(self, centre: np.ndarray, radius: float):
        """(places, bounds) by falling bound on the score with a cluster's member of
        length 1. A millionth more covers rounding."""
        angle = np.arccos(np.clip(self.unit @ centre, -1, 1))
        bound = self.sizes * (np.cos(np.maximum(0, angle - radius)) + 1e-6)
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]

    def keys(self, scores: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Numbers that sort by score, then by falling id; whole numbers of any size
        where 64 bits are too few."""
        n = len(self.x)
        if scores.size and max(abs(int(scores.min())), abs(int(scores.max()))) * n >= LARGEST:
            scores = scores.astype(object)
        return scores * n + self.tie[places]

    def of_key(self, key) -> tuple:
        """(id, score)"""
        n = len(self.x)
        return self.ids[self.by_tie[int(key) % n]], int(key) // n


def best(kept: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The largest of both, as many per row as are kept, the smallest first."""
    k = kept.shape[1]
    if keys.dtype == object or kept.dtype == object:
        return np.sort(np.concatenate((kept.astype(object), keys.astype(object)), axis=1), axis=1)[:, -k:]
    return np.sort(np.partition(np.concatenate((kept, keys), axis=1), -k, axis=1)[:, -k:], axis=1)


def walk(x: np.ndarray, points: np.ndarray | None, have: Candidates, needed: np.ndarray, take) -> None:
    """Lets every row of ``x`` walk its cluster's list. ``needed`` is the lowest score a
    row still needs. ``take(rows, places, scores)`` sees each stretch of the list and
    returns their new ``needed``; a row stops where no bound further on reaches it."""
    sizes, directions, clusters = lengths(x), unit(x), cluster(x, points)
    for number in np.unique(clusters):
        members = np.flatnonzero(clusters == number)
        centre = unit(directions[members].sum(axis=0, keepdims=True))[0]
        some = members[sizes[members] > 0]
        radius = float(np.arccos(np.clip(directions[some] @ centre, -1, 1)).max()) if len(some) else 0.0
        order, bounds = have.ordered(centre, radius)
        for start in range(0, len(order), STRIDE):
            reach = np.maximum(sizes[members] * bounds[start] * (1 + 1e-9) + 1, -LARGEST)
            members = members[reach >= needed[members]]
            if not len(members):
                break
            places = order[start : start + STRIDE]
            needed[members] = take(members, places, products(x[members], have.x[places]))


def blocks_of(anchors: pa.Table, candidates: pa.Table):
    """(row, ids, labels, components, candidates) of every anchor block in a task."""
    have: dict[int, Candidates] = {}
    for i in range(anchors.num_rows):
        width = anchors["dim"][i].as_py()
        if width not in have:
            have[width] = Candidates(candidates, width)
        data = matrix(anchors["data"][i], width, np.int64)
        if len(have[width].ids):
            yield i, np.array(anchors["ids"][i].as_py()), data[:, 0], np.ascontiguousarray(data[:, 1:]), have[width]


def as_numbers(lowest: np.ndarray, n: int) -> np.ndarray:
    """The scores of keys as floating point, the least number for missing ones."""
    return np.where(lowest == LEAST, -np.inf, (lowest // n).astype(float))


def found_positives(met_blocks, points: dict[int, np.ndarray], k: int, kind: str) -> DataFrame:
    """(block, place, anchor_id, vec_id, score): the ``k`` highest of the anchor's own
    label in each task."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        for i, ids, labels, x, have in blocks_of(anchors, candidates):
            # Among themselves the anchors already show how high the kth score must be.
            own = np.where((labels[:, None] == labels) & (ids[:, None] != ids), products(x, x).astype(float), -np.inf)
            needed = np.sort(own, axis=1)[:, -k] if len(ids) >= k else np.full(len(ids), -np.inf)
            needed, state = lowered(needed), [np.full((len(ids), k), LEAST)]

            def take(rows, places, scores):
                fits = (labels[rows, None] == have.labels[places]) & (ids[rows, None] != have.id_array[places])
                keys = np.where(fits, have.keys(scores, places), LEAST)
                kept = best(state[0][rows], keys)
                if kept.dtype == object:
                    state[0] = state[0].astype(object)
                state[0][rows] = kept
                return np.maximum(needed[rows], lowered(as_numbers(kept[:, 0], len(have.ids))))

            walk(x, points.get(x.shape[1] + 1), have, needed, take)
            block = anchors["block"][i].as_py()
            out += [(block, p, ids[p].item(), *have.of_key(key)) for p, row in enumerate(state[0]) for key in row if key != LEAST]
        return as_table(out, [pa.int64(), pa.int32(), type_of(anchors), type_of(anchors), pa.int64()], ["block", "place", "anchor_id", "vec_id", "score"])

    return met_blocks.applyInArrow(run, f"block bigint, place int, anchor_id {kind}, vec_id {kind}, score bigint")


def lowered(scores: np.ndarray) -> np.ndarray:
    """A little lower, as a float may lie above the whole number it stands for."""
    return np.where(np.isfinite(scores), scores - np.abs(scores) * 1e-9, scores)


def type_of(blocks: pa.Table) -> pa.DataType:
    return blocks.schema.field("ids").type.value_type


def as_table(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def found_negatives(met_blocks, points: dict[int, np.ndarray], k: int, band: tuple[int, int], kind: str) -> DataFrame:
    """(block, place, nth, anchor_id, positive_id, positive_score, negative_id,
    negative_score): for every positive the ``k`` highest of another label within the
    band, in each task."""

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        for i, ids, labels, x, have in blocks_of(anchors, candidates):
            asked = anchors["asked"][i].as_py()
            most = max(a["nth"] for a in asked)
            # Bands in whole numbers; one without a positive is empty.
            low, high = np.full((len(ids), most), LARGEST), np.full((len(ids), most), -LARGEST)
            for a in asked:
                low[a["place"], a["nth"] - 1] = -(-band[0] * a["score"] // 100)
                high[a["place"], a["nth"] - 1] = band[1] * a["score"] // 100
            needed = lowered(np.where(low <= high, low.astype(float), np.inf).min(axis=1))
            state = [np.full((len(ids), most, k), LEAST)]

            def take(rows, places, scores):
                other = (labels[rows, None] != have.labels[places]) & (ids[rows, None] != have.id_array[places])
                keys = have.keys(scores, places)
                if keys.dtype == object:
                    state[0] = state[0].astype(object)
                still = np.full(len(rows), np.inf)
                for n in range(most):
                    lo, hi = low[rows, n], high[rows, n]
                    kept = best(state[0][rows, n], np.where(other & (scores >= lo[:, None]) & (scores <= hi[:, None]), keys, LEAST))
                    state[0][rows, n] = kept
                    lowest = np.maximum(lo.astype(float), as_numbers(kept[:, 0], len(have.ids)))
                    still = np.minimum(still, np.where(lo <= hi, lowest, np.inf))
                return lowered(still)

            walk(x, points.get(x.shape[1] + 1), have, needed, take)
            block = anchors["block"][i].as_py()
            for a in asked:
                for key in state[0][a["place"], a["nth"] - 1]:
                    if key != LEAST:
                        out.append((block, a["place"], a["nth"], ids[a["place"]].item(), a["vec_id"], a["score"], *have.of_key(key)))
        t = type_of(anchors)
        names = ["block", "place", "nth", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return as_table(out, [pa.int64(), pa.int32(), pa.int32(), t, t, pa.int64(), t, pa.int64()], names)

    return met_blocks.applyInArrow(
        run,
        f"block bigint, place int, nth int, anchor_id {kind}, positive_id {kind}, positive_score bigint, negative_id {kind}, negative_score bigint",
    )


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, band: tuple[int, int] = (50, 95)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are (vec_id, label, embedding), ``anchors`` tells which are anchors. An
    anchor's positives are its ``positives`` other rows of the same label with the
    highest scores; for each come the ``negatives`` highest rows of another label whose
    score is from ``band[0]`` to ``band[1]`` per cent of the positive's. Ties go to the
    smaller id. All are returned where there are fewer.
    """
    kind = rows.schema["vec_id"].dataType.simpleString()
    chosen = labelled(rows.where(anchors))
    points = centres(chosen)
    ask, have = in_blocks(chosen, points, QUERIES), in_blocks(labelled(rows), points, CANDIDATES)
    highest = W.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
    found = found_positives(met(ask, have), points, positives, kind).withColumn("nth", F.row_number().over(highest))
    found = stored(found.where(F.col("nth") <= positives), "positives")
    asked = found.groupBy("block").agg(F.collect_list(F.struct("place", "nth", "vec_id", "score")).alias("asked"))
    ask = stored(ask.join(asked, "block"), "anchors")
    highest = W.partitionBy("block", "place", "nth").orderBy(F.desc("negative_score"), "negative_id")
    mined = found_negatives(met(ask, have), points, negatives, band, kind).withColumn("rank", F.row_number().over(highest))
    return mined.where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
