"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Vectors are centred, turned to their principal axes and rotated so that their signs keep as
much as can be (iterative quantisation); the signs are a code of BITS bits. A code is split
into SUBSTRINGS bytes, each of which has an index from value to rows. Two codes within a
Hamming radius are close in at least one byte (pigeonhole principle), so probing
each index with all values close enough to the query's byte finds every code within the
radius. Those are reranked by their Euclidean distance.

Rotation and radius are learned from a bounded sample; every row is coded and indexed. Queries
and rows are dealt into blocks, every pair of blocks is searched by a task, and only the
nearest of each query leave it. Queries with too few codes in the radius are searched again
without one.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.session import staged

BITS, SUBSTRINGS = 64, 8
#: Rows that the rotation is learned from, and of these the queries that the radius is learned from.
SAMPLE, SAMPLE_QUERIES = 20_000, 300
#: Share of the sample's true neighbours that lie within the radius.
WITHIN = 0.975
#: Rows and queries that a task searches.
ROW_BLOCK, QUERY_BLOCK = 20_000, 2_000
NEAREST = 10
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


@dataclass(frozen=True)
class CodeBook:
    """Centre and projection of the codes, and the radius to search."""

    centre: np.ndarray
    projection: np.ndarray
    radius: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        return np.packbits((x - self.centre) @ self.projection > 0, axis=1)


def _rotation(z: np.ndarray, rng: np.random.Generator, steps: int = 30) -> np.ndarray:
    """The rotation after which the signs of ``z`` are closest to it."""
    r = np.linalg.qr(rng.normal(size=(z.shape[1], z.shape[1])))[0]
    for _ in range(steps):
        u, _, v = np.linalg.svd(np.where(z @ r > 0, 1.0, -1.0).T @ z)
        r = (u @ v).T
    return r


def fit_codes(x: np.ndarray, nearest: int = NEAREST, seed: int = 7) -> CodeBook:
    """Learn projection and radius; the same rows in any order give the same book."""
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    centre = x.mean(axis=0) if len(x) else np.zeros(width)
    _, axes = np.linalg.eigh(np.cov((x - centre).T).reshape(width, width)) if len(x) > 1 else (0, np.eye(width))
    axes = axes[:, ::-1][:, :BITS]
    parts = []
    for _ in range(math.ceil(BITS / axes.shape[1])):  # narrow vectors get several rotations
        z = (x - centre) @ axes
        parts.append(axes @ (_rotation(z, rng) if len(z) else np.eye(axes.shape[1])))
    book = CodeBook(centre, np.concatenate(parts, axis=1)[:, :BITS], BITS)
    found = []
    codes = book.encode(x) if len(x) else np.zeros((0, SUBSTRINGS), np.uint8)
    for i in range(min(len(x), SAMPLE_QUERIES)):
        far = ((x - x[i]) ** 2).sum(axis=1)
        far[i] = np.inf
        near = np.argpartition(far, min(nearest, len(x) - 1))[:nearest]
        found.append(_ONES[codes[near] ^ codes[i]].sum(axis=1))
    radius = int(np.quantile(np.concatenate(found), WITHIN, method="higher")) if found else BITS
    return CodeBook(centre, book.projection, radius)


@functools.lru_cache(maxsize=64)
def _probes(radius: int) -> np.ndarray:
    """Differences of a byte with at most so many bits."""
    return np.flatnonzero(radius >= _ONES).astype(np.uint8)


class MultiIndex:
    """For each byte of the codes, the rows by its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, s], kind="stable") for s in range(SUBSTRINGS)]
        self.starts = [
            np.concatenate(([0], np.cumsum(np.bincount(codes[:, s], minlength=256)))) for s in range(SUBSTRINGS)
        ]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code differs in at most ``radius`` bits.

        The bytes' own radii and one for each add up to more than ``radius``, so a code within it
        cannot exceed them all.
        """
        if radius >= BITS:
            return np.arange(len(self.codes))
        marked = np.zeros(len(self.codes), bool)
        share, more = divmod(radius + 1, SUBSTRINGS)
        for s in range(SUBSTRINGS):
            own = share + (s < more) - 1
            if own < 0:
                continue
            starts = self.starts[s]
            for value in (_probes(own) ^ code[s]).tolist():
                marked[self.order[s][starts[value] : starts[value + 1]]] = True
        rows = np.flatnonzero(marked)
        return rows[_ONES[self.codes[rows] ^ code].sum(axis=1) <= radius]


def _search(book: CodeBook, radius: int, k: int):
    """A function from a block of rows and one of queries to the nearest rows of each query."""

    def search(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            x = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
            ids = rows["vec_id"].to_numpy()
            index = MultiIndex(np.stack([np.frombuffer(c, np.uint8) for c in rows["code"]]))
            for query, vector, code in zip(queries["vec_id"], queries["embedding"], queries["code"]):
                near = index.within(np.frombuffer(code, np.uint8), radius)
                near = near[ids[near] != query]
                far = np.sqrt(((x[near] - np.asarray(vector, np.float64)) ** 2).sum(axis=1))
                first = np.lexsort((ids[near], far))[:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[near][first], "score": far[first]}))
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        return pd.concat(out) if out else empty

    return search


def valid_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and embedding of the rows that take part; of several lengths the commonest does."""
    df = table.select(table[key].cast("bigint").alias("vec_id"), table[vector].cast("array<double>").alias("embedding"))
    finite = ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    df = df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    df = df.where(F.exists("embedding", lambda v: v != 0))
    sizes = df.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return df.where(F.size("embedding") == (sizes[0]["size"] if sizes else 0))


def build_index(vectors: DataFrame) -> tuple[DataFrame, CodeBook]:
    """vec_id, embedding and code of every row, stored, and the book they are coded by."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").collect()
    book = fit_codes(np.array([r[0] for r in sample]).reshape(len(sample), -1) if sample else np.zeros((0, BITS)))

    def encode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                codes = book.encode(np.stack(batch["embedding"].to_numpy()))
                yield batch.assign(code=[c.tobytes() for c in codes])

    return staged(vectors.mapInPandas(encode, "vec_id bigint, embedding array<double>, code binary"), "codes"), book


def _blocks(rows: DataFrame, queries: DataFrame) -> tuple:
    """Both sides dealt out by hash, each block together with every block of the other."""
    row_blocks = max(1, math.ceil(rows.count() / ROW_BLOCK))
    query_blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    return (
        rows.select("*", block(row_blocks).alias("r"), every(query_blocks).alias("q")),
        queries.select("*", every(row_blocks).alias("r"), block(query_blocks).alias("q")),
    )


def _nearest(rows: DataFrame, queries: DataFrame, book: CodeBook, radius: int, k: int) -> DataFrame:
    left, right = _blocks(rows, queries)
    found = left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInPandas(
        _search(book, radius, k), "query_id bigint, vec_id bigint, score double")
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.select("*", F.row_number().over(by).alias("rank")).where(F.col("rank") <= k)
    return staged(ranked.select("query_id", "rank", "vec_id", "score"), "nearest")


def search_nearest(table: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest rows found for each query.

    ``is_query`` is a condition on ``vec_id``. Null, zero and non-finite vectors and rows without
    key take no part; a key that repeats is asked once, and no row with the query's own key is
    found; ties go to the smaller key; an empty table gives no rows; other columns are not read.
    """
    rows, book = build_index(valid_vectors(table, key, vector))
    queries = rows.where(is_query).dropDuplicates(["vec_id"])
    found = _nearest(rows, queries, book, book.radius, k)
    short = staged(
        queries.join(found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti"), "short")
    if not short.limit(1).count():
        return found
    again = _nearest(rows, short, book, BITS, k)
    return found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
