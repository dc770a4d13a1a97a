"""Hard negatives by best-first search of an STR-packed R-tree.

Vectors become integer codes ``floor(256 * x)``; a row's score is its inner product with the
anchor. Rows are dealt out by ranges of the coordinate that varies most and packed in each task
by sort-tile-recurse over the next ones: slabs of one coordinate are cut into slabs of the next
until a tile is a leaf. A leaf keeps its minimum bounding box, and with an anchor q every box
gives an interval of inner products, coordinate by coordinate: q * low and q * high bound q * x.
A queue visits boxes by their highest possible score; boxes outside all score windows of an
anchor, and boxes whose highest score is strictly below the k-th row found (or equals it, with
no smaller key), are never opened.

The packed leaves are stored once and searched twice for each block of anchors: for positives,
then for the negatives in the windows that the positives' scores span. A block's anchors are sent
to all tasks (their number is a parameter), and only the best rows per task and window return.

Edge cases: rows with a null key, label or vector, an empty vector, or a null or non-finite
component take no part, nor do rows with components whose products a 64-bit integer can't hold
(|code| over 2^31 - 2 or sqrt(2^62 / dimension)). Only rows of equal dimension meet. Rows that repeat a key
are rows of their own, but never the positive or negative of an anchor with that key; equal anchors
count once. An anchor without positives, or a window without rows, has no result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.tables import first_ranks
from wordloom.session import staged

SCALE = 256
#: A negative's score lies between these shares (of 100) of its positive's.
SHARES = (30, 90)
POSITIVES, NEGATIVES = 5, 10
#: Anchors that are searched for at once; more anchors take more passes.
ANCHORS = 5_000
#: Rows from which the order of the coordinates is taken; the result doesn't depend on it.
SAMPLE = 10_000
LEAF, FANOUT, TILED = 256, 16, 6
#: Rows that are packed together, and leaves that are searched together, to bound a task's memory.
PACKED, SEARCHED = 65_536, 400
LEAVES = "dim int, ids binary, labels binary, codes binary, low binary, high binary"


def tiles(codes: np.ndarray, rows: np.ndarray, coordinates: list[int]) -> Iterator[np.ndarray]:
    """The rows in tiles of LEAF at most, cut by one coordinate after the other."""
    if len(rows) <= LEAF:
        yield rows
        return
    rows = rows[np.argsort(codes[rows, coordinates[0]], kind="stable")]
    leaves = math.ceil(len(rows) / LEAF)
    slabs = leaves if len(coordinates) == 1 else math.ceil(leaves ** (1 / len(coordinates)))
    size = math.ceil(leaves / slabs) * LEAF
    for at in range(0, len(rows), size):
        yield from tiles(codes, rows[at : at + size], coordinates[1:] or coordinates)


def _packer(order: list[int]):
    def leaves(ids: list, labels: list, vectors: list) -> Iterator[tuple]:
        sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
        for dim in np.unique(sizes).tolist():
            mine = np.flatnonzero(sizes == dim)
            codes = np.array([vectors[i] for i in mine], np.int32).reshape(len(mine), dim)
            keys, classes = np.array(ids, np.int64)[mine], np.array(labels, np.int64)[mine]
            coordinates = [c for c in order if c < dim][1 : TILED + 1] or [0]
            for tile in tiles(codes, np.arange(len(mine)), coordinates):
                box = codes[tile]
                yield (dim, keys[tile].tobytes(), classes[tile].tobytes(), box.tobytes(), box.min(0).tobytes(), box.max(0).tobytes())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []
        for batch in batches:
            ids += batch["id"].to_pylist()
            labels += batch["label"].to_pylist()
            vectors += batch["codes"].to_numpy(zero_copy_only=False).tolist()
            if len(ids) >= PACKED:
                yield _leaf_batch(leaves(ids, labels, vectors))
                ids, labels, vectors = [], [], []
        if ids:
            yield _leaf_batch(leaves(ids, labels, vectors))

    return pack


def _leaf_batch(rows: Iterator[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["dim", "ids", "labels", "codes", "low", "high"])


class BoxTree:
    """Leaves of one dimension below boxes of boxes; the levels run from the root's children to the leaves."""

    def __init__(self, dim: int, rows: list[dict]):
        def read(name, kind):
            return [np.frombuffer(r[name], kind) for r in rows]

        self.ids, self.labels = np.concatenate(read("ids", np.int64)), np.concatenate(read("labels", np.int64))
        self.codes = np.concatenate(read("codes", np.int32)).reshape(-1, dim)
        self.ends = np.cumsum([len(r["ids"]) // 8 for r in rows])
        low, high = np.stack(read("low", np.int32)), np.stack(read("high", np.int32))
        least = np.array([x.min() for x in read("ids", np.int64)])
        self.levels = [(low, high, least)]
        while len(low) > FANOUT:
            at = np.arange(0, len(low), FANOUT)
            low, high, least = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(least, at)
            self.levels.insert(0, (low, high, least))
        self.reach = int(np.abs(self.codes.astype(np.int64)).max(initial=0))
        self.exact: dict[type, tuple] = {}

    def typed(self, query: np.ndarray) -> tuple:
        """Codes and levels in doubles if these hold all products with the query exactly, else in integers."""
        bound = self.reach * int(np.abs(query).max(initial=0)) * len(query)
        kind = np.float64 if bound < 1 << 53 else np.int64
        if kind not in self.exact:
            self.exact[kind] = (self.codes.astype(kind), [(a.astype(kind), b.astype(kind), c) for a, b, c in self.levels])
        return kind, *self.exact[kind]

    def search(self, query: np.ndarray, own: int, label: int, same: bool, windows: list["Window"]) -> None:
        """Offer the windows every row that may be among their best."""
        kind, codes, levels = self.typed(query)
        query = query.astype(kind)
        above, below = np.maximum(query, 0), np.minimum(query, 0)
        queue: list[tuple] = []

        def push(level: int, first: int, last: int) -> None:
            low, high, least = (x[first:last] for x in levels[level])
            most, fewest = (high @ above + low @ below).tolist(), (low @ above + high @ below).tolist()
            for i, (top, bottom, key) in enumerate(zip(most, fewest, least.tolist())):
                best = max((min(top, w.high) for w in windows if w.may_hold(top, bottom, key)), default=None)
                if best is not None:
                    heapq.heappush(queue, (-best, level, first + i, top, bottom, key))

        push(0, 0, len(levels[0][0]))
        while queue:
            _, level, node, top, bottom, key = heapq.heappop(queue)
            open_windows = [w for w in windows if w.may_hold(top, bottom, key)]
            if not open_windows:
                continue
            if level + 1 < len(levels):
                push(level + 1, node * FANOUT, min((node + 1) * FANOUT, len(levels[level + 1][0])))
                continue
            rows = slice(self.ends[node - 1] if node else 0, self.ends[node])
            ids = self.ids[rows]
            fit = ((self.labels[rows] == label) == same) & (ids != own)
            scores, ids = (codes[rows] @ query).astype(np.int64)[fit], ids[fit]
            for w in open_windows:
                w.offer(scores, ids)


class Window:
    """Scores from low to high, and the best k of them so far: highest first, then smallest key."""

    def __init__(self, low: float, high: float, k: int):
        self.low, self.high, self.k = low, high, k
        self.scores = self.ids = np.zeros(0, np.int64)

    def may_hold(self, top: float, bottom: float, least: int) -> bool:
        if top < self.low or bottom > self.high:
            return False
        if len(self.scores) < self.k:
            return True
        last = self.scores[-1]
        return top > last or (top == last and least < self.ids[-1])

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        low = self.low if len(self.scores) < self.k else max(self.low, self.scores[-1])
        hit = (scores >= low) & (scores <= self.high)
        if hit.any():
            scores, ids = np.concatenate([self.scores, scores[hit]]), np.concatenate([self.ids, ids[hit]])
            best = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[best], ids[best]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, BoxTree]]:
    held: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            rows = held.setdefault(row["dim"], [])
            rows.append(row)
            if len(rows) == SEARCHED:
                yield row["dim"], BoxTree(row["dim"], held.pop(row["dim"]))
    for dim, rows in held.items():
        yield dim, BoxTree(dim, rows)


def _search(leaves: DataFrame, asked: list[tuple], same: bool, k: int) -> DataFrame:
    """The best k of each task per anchor and window. ``asked``: key, label, codes and windows of each anchor."""
    sent = leaves.sparkSession.sparkContext.broadcast(asked)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [(i, key, label, np.array(codes, np.int64), [Window(a, b, k) for a, b in windows])
                   for i, (key, label, codes, windows) in enumerate(sent.value)]
        for dim, tree in _trees(batches):
            for _, key, label, codes, windows in queries:
                if len(codes) == dim:
                    tree.search(codes, key, label, same, windows)
        found = [(i, j, int(a), int(s)) for i, *_, windows in queries for j, w in enumerate(windows) for a, s in zip(w.ids, w.scores)]
        columns = list(zip(*found)) or [()] * 4
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["anchor", "part", "id", "score"])

    rows = leaves.mapInArrow(search, "anchor int, part int, id bigint, score bigint")
    return first_ranks(rows, ["anchor", "part"], [F.desc("score"), F.asc("id")], k, "id")


def _coded(rows: DataFrame, anchors: Column, key: str, vector: str, label: str) -> DataFrame:
    narrow = rows.select(
        rows[key].cast("bigint").alias("id"), rows[label].cast("bigint").alias("label"),
        rows[vector].cast("array<double>").alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    # Not-a-number and infinity are above every limit, so one comparison refuses them too.
    limit = F.least(F.lit(2.0**31 - 2), F.sqrt(F.lit(2.0**62) / F.size("v")))
    sized = narrow.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)).withColumn("limit", limit)
    fit = F.forall("v", lambda x: F.coalesce(F.abs(x) * SCALE < F.col("limit"), F.lit(False)))
    return sized.where(fit).select("id", "label", "anchor", F.transform("v", lambda x: F.floor(x * SCALE).cast("int")).alias("codes"))


def pack(coded: DataFrame) -> DataFrame:
    """All rows in leaves, stored."""
    sample = coded.select("id", "codes").orderBy(F.xxhash64("id")).limit(SAMPLE).select("codes").collect()
    dim = max((len(r[0]) for r in sample), default=1)
    spread = np.var([r[0] for r in sample if len(r[0]) == dim], axis=0) if sample else np.zeros(1)
    order = np.argsort(-spread, kind="stable").tolist()
    dealt = coded.select("id", "label", "codes").repartitionByRange(F.get("codes", F.lit(order[0])), "id")
    return staged(dealt.mapInArrow(_packer(order), LEAVES), "leaves")


def mine_negatives(rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, shares: tuple[int, int] = SHARES) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``key`` and ``label`` are integers. The positives of an anchor are its best other rows of its
    label; for each, the best rows of other labels whose scores lie within ``shares`` of the positive's.
    """
    spark = rows.sparkSession
    coded = _coded(rows, anchors, key, vector, label)
    leaves = pack(coded)
    asked = staged(coded.where("anchor").select("id", "label", "codes").distinct(), "anchors")
    passes = math.ceil(asked.count() / ANCHORS) or 1
    result = None
    for number in range(passes):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == number).collect()
        everything = [(r.id, r.label, r.codes, [(-math.inf, math.inf)]) for r in block]
        best = _search(leaves, everything, True, positives).select("anchor", "id", "score").collect()
        windows: list[dict[int, int]] = [{} for _ in block]
        for r in best:
            windows[r.anchor].setdefault(r.score, len(windows[r.anchor]))
        spans = [(r.id, r.label, r.codes, [(-(-shares[0] * s // 100), shares[1] * s // 100) for s in w])
                 for r, w in zip(block, windows)]
        known = spark.createDataFrame(
            [(r.anchor, windows[r.anchor][r.score], block[r.anchor].id, r.id, r.score) for r in best],
            "anchor int, part int, anchor_id bigint, positive_id bigint, positive_score bigint")
        found = _search(leaves, spans, False, negatives).join(F.broadcast(known), ["anchor", "part"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        found = staged(found, "negatives") if passes > 1 else found
        result = found if result is None else result.unionByName(found)
    return result
