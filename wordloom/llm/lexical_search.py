"""Ranked lexical search over a length-stratified index.

A document's score for an item depends on its terms only by how often each occurs and by one
normaliser ``m`` of its length. Documents of equal ``m`` form a stratum; a term's postings lie
by stratum and, inside it, by ``tf``, so that the impact of a posting is worked out once for each
(stratum, tf) and shared by all items. The last posting of a term in a stratum has its highest
impact; weighted and summed over an item's terms that bounds every score of the stratum. Strata
are visited by falling bound until the next bound is strictly below the k-th score.

Documents are posted where they are read and searched in the blocks of the posted table, each
block an index of its own; only the best ``k`` of a task are shuffled. Items come in blocks
of bounded size, each block against all documents.

Edge cases: null and empty texts have no term and are never found; a null key counts as the
largest; repeated rows are documents of their own; the rows of one item (also of the null item)
are read as one text; an item without terms has no rows; columns of other names are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from wordloom.llm.tables import first_ranks
from wordloom.session import staged

#: What ends a term, and the letters that are folded.
DIGITS, CAPITALS, LETTERS = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_BREAKS = bytes(c for c in range(128) if c not in DIGITS + CAPITALS + LETTERS)
_FOLD = bytes.maketrans(_BREAKS + CAPITALS, b" " * len(_BREAKS) + LETTERS)

BEST = 50
#: Bytes of item texts that are searched for at once; more items take more passes.
ITEM_BYTES = 4 << 20
#: Postings that are indexed together, to bound a task's memory.
TOGETHER = 1_500_000
#: Documents of the first strata that are visited; later visits take four times as many.
FIRST_VISIT = 1024


def split_terms(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def normalisers(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    return 100 - 50 + (50 * n * documents) // length


class LengthIndex:
    """Postings of a block of documents by term, stratum and tf."""

    def __init__(self, m: np.ndarray, owner: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_terms: int):
        levels, stratum = np.unique(m, return_inverse=True)
        base = int(tfs.max(initial=0)) + 1
        cells, cell = np.unique(stratum[owner] * base + tfs, return_inverse=True)
        tf, level = cells % base, cells // base
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * levels[level])
        order = np.argsort(terms * max(len(cells), 1) + cell, kind="stable")
        terms, cell = terms[order], cell[order]
        self.docs, self.impacts = owner[order], impact[cell]
        place = level[cell]
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (place[1:] != place[:-1])
        starts = np.flatnonzero(new)
        self.starts = np.append(starts, len(terms))
        self.run_stratum, self.run_best = place[starts], self.impacts[self.starts[1:] - 1]
        self.first_run = np.searchsorted(terms[starts], np.arange(n_terms + 1))
        self.sizes = np.bincount(stratum, minlength=len(levels))
        self.scores = np.zeros(len(m), np.int64)

    def visit(self, terms: list[int], weights: list[int], k: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Documents and scores of at least ``least`` (sent anew after each yield), stratum by stratum."""
        runs = [(w, slice(self.first_run[t], self.first_run[t + 1])) for t, w in zip(terms, weights)]
        bound = np.zeros(len(self.sizes), np.int64)
        for w, run in runs:
            bound[self.run_stratum[run]] += w * self.run_best[run]
        order = np.argsort(-bound, kind="stable")
        falling, filled = bound[order], np.cumsum(self.sizes[order])
        at, size = 0, FIRST_VISIT
        while True:
            worth = int(np.searchsorted(-falling, -least, side="right"))
            if at >= worth:
                return
            end = int(np.searchsorted(filled, (filled[at - 1] if at else 0) + size)) + 1
            chosen = np.zeros(len(self.sizes), bool)
            chosen[order[at : min(end, worth)]] = True
            at, size = end, size * 4
            for w, run in runs:
                wanted = chosen[self.run_stratum[run]]
                first, last = self.starts[run.start], self.starts[run.stop]
                docs, impacts = self.docs[first:last], self.impacts[first:last]
                if not wanted.all():
                    posting = np.repeat(wanted, np.diff(self.starts[run.start : run.stop + 1]))
                    docs, impacts = docs[posting], impacts[posting]
                self.scores[docs] += w * impacts
            hit = np.flatnonzero(self.scores >= least)
            found = self.scores[hit]
            self.scores[:] = 0
            least = yield hit, found


class _Best:
    """The best k of an item so far, as (-score, key is null, key)."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def least(self) -> int:
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, hits: np.ndarray, scores: np.ndarray, rank: np.ndarray, keys: pa.Array) -> int:
        best = np.lexsort((rank[hits], -scores))[: self.k]
        values = keys.take(pa.array(hits[best])).to_pylist()
        rows = [(-int(s), v is None, v) for s, v in zip(scores[best], values)]
        self.rows = sorted([*self.rows, *rows], key=lambda r: r if not r[1] else (r[0], True, 0))[: self.k]
        return self.least


def _post(docs: DataFrame, key: str, text: str, vocabulary: list[bytes]) -> DataFrame:
    """``doc, n, terms, tfs``: a document's number of terms, and which of the vocabulary it holds how often."""
    known = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    schema = StructType([
        StructField("doc", docs.schema[key].dataType), StructField("n", LongType()),
        StructField("terms", ArrayType(IntegerType())), StructField("tfs", ArrayType(IntegerType())),
    ])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for batch in batches:
            n, offsets, terms, tfs = [], [0], [], []
            for value in batch["text"]:
                words = split_terms(value.as_py())
                n.append(len(words))
                counts = Counter(filter(numbers.__contains__, words))
                terms.extend(map(numbers.__getitem__, counts))
                tfs.extend(counts.values())
                offsets.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, pa.int32())) for v in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch["doc"], pa.array(n, pa.int64()), *lists], ["doc", "n", "terms", "tfs"])

    narrow = docs.select(docs[key].alias("doc"), docs[text].cast("string").cast("binary").alias("text"))
    return narrow.mapInArrow(post, schema)


def _searched(posted: DataFrame, asked: list[tuple[list[int], list[int]]], n_terms: int, documents: int,
              length: int, k: int) -> DataFrame:
    """``item`` (its place in ``asked``), ``doc``, ``score``: the best k of each task."""
    wanted = posted.sparkSession.sparkContext.broadcast(asked)
    schema = StructType([StructField("item", IntegerType()), posted.schema["doc"], StructField("score", LongType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in wanted.value]
        kind = None
        for block in _blocks(batches):
            kind = block["doc"].type
            lists, n = block["terms"].combine_chunks(), block["n"].to_numpy()
            owner = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
            terms = lists.flatten().to_numpy().astype(np.int64)
            tfs = block["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
            index = LengthIndex(normalisers(n, documents, length), owner, terms, tfs, n_terms)
            keys = block["doc"].combine_chunks()
            rank = np.empty(len(n), np.int64)
            rank[pc.sort_indices(keys).to_numpy()] = np.arange(len(n))
            for top, (numbers, weights) in zip(best, wanted.value):
                visits = index.visit(numbers, weights, k, top.least)
                found = next(visits, None)
                while found:
                    least = top.add(*found, rank, keys)
                    try:
                        found = visits.send(least)
                    except StopIteration:
                        break
        if kind is not None:
            rows = [(i, r[2], -r[0]) for i, top in enumerate(best) for r in top.rows]
            items, found, scores = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int32()), pa.array(found, kind), pa.array(scores, pa.int64())], ["item", "doc", "score"])

    return posted.mapInArrow(search, schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch["terms"].flatten()) + len(batch)
        if size >= TOGETHER:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def search_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                     item: str = "item_id", item_text: str = "text", k: int = BEST) -> DataFrame:
    """``item``, ``rank`` (from 1), ``key``, ``score``: the k best documents of each item, scores above 0."""
    spark = docs.sparkSession
    asked = items.select(items[item].alias("item"), items[item_text].cast("string").cast("binary").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = math.ceil(size / ITEM_BYTES) or 1
    found = None
    for number in range(passes):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).collect()
        terms: dict[object, set[bytes]] = {}
        for row in block:
            terms.setdefault(row["item"], set()).update(split_terms(bytes(row["text"]) if row["text"] else None))
        vocabulary = sorted(set().union(*terms.values()))
        posted = staged(_post(docs, key, text, vocabulary), "postings")
        documents, length = posted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        df = dict(posted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()) if length else {}
        number_of = {t: i for i, t in enumerate(vocabulary)}
        wanted = []
        for words in terms.values():
            numbers = sorted(number_of[t] for t in words if number_of[t] in df)
            wanted.append((numbers, [math.floor(1000 * math.log((2 * documents + 2) / (2 * df[i] + 1))) for i in numbers]))
        names = spark.createDataFrame(
            list(enumerate(terms)), StructType([StructField("item", IntegerType()), StructField("_name", asked.schema["item"].dataType)]))
        rows = _searched(posted, wanted, len(vocabulary), documents, max(length or 0, 1), k)
        best = first_ranks(rows, ["item"], [F.desc("score"), F.asc_nulls_last("doc")], k, "doc")
        part = best.join(F.broadcast(names), "item").select(
            F.col("_name").alias(item), "rank", F.col("doc").alias(key), "score")
        part = staged(part, "found") if passes > 1 else part
        found = part if found is None else found.unionByName(part)
    return found
