"""Near-duplicate detection by DartMinHash signatures of weighted shingles.

A document is a set of shingles weighted by how often they occur. Darts are thrown at the plane
of weight and rank over each shingle: cells of one unit of weight and growing intervals of
rank receive a Poisson number of darts that depends on the shingle and the cell alone. A dart hits the
document if it lies below the shingle's weight, and has a coordinate of the signature; each
coordinate keeps its dart of least rank. Two documents agree in a coordinate with the
probability of their weighted Jaccard similarity. Only about ``k log k`` darts of lowest rank are
thrown for a document, however long it is.

Documents that agree in all coordinates of a band are candidates. Within such a bucket all
members are compared with one hub, the member that meets most others; members that are not
in the hub's class then are compared with the members of other classes that share one of their
rarest shingles, as all similar ones do, so that no link between two classes is missed and neither
a large group nor a passage that many texts share turns into all its pairs. Pairs whose signatures leave the outcome open are checked exactly on all their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.components import connected
from wordloom.llm.shingles import mix, numbered, shingles, slices
from wordloom.llm.tables import narrow
from wordloom.session import staged

#: Bands and their coordinates: pairs of similarity 0.8 share a band with a chance of 0.9995.
BANDS, ROWS = 32, 7
SIMILAR = 0.8
#: Agreement of the coordinates from which a pair is checked exactly, and from which it is sure:
#: 4.5 deviations below and above SIMILAR.
COORDINATES = BANDS * ROWS
_MARGIN = 4.5 * math.sqrt(SIMILAR * (1 - SIMILAR) / COORDINATES)
LIKELY, SURE = SIMILAR - _MARGIN, SIMILAR + _MARGIN
#: Cells of the table that tells rare shingles from common ones.
CELLS = 2**18
#: The first interval of ranks and the longest one.
FINEST, WIDEST = 2.0**-5, 32.0


def _chances(mean: float) -> np.ndarray:
    """Cumulative Poisson probabilities, as far as they differ from one."""
    term, total, out = math.exp(-mean), 0.0, []
    for count in range(int(mean + 12 * math.sqrt(mean) + 20)):
        total += term
        out.append(total)
        term *= mean / (count + 1)
    return np.array(out)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(hashes: np.ndarray, rows: np.ndarray, weights: np.ndarray, n: int,
               k: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of ``n`` documents, and which of them have one (any weight at all).

    Every entry is one shingle of a row with a positive weight. The expected number of darts
    that hit a document up to a rank is that rank times its total weight.
    """
    cells = np.ceil(weights).astype(np.int64)
    entry = np.repeat(np.arange(len(hashes)), cells)
    cell = np.arange(len(entry)) - np.repeat(np.cumsum(cells) - cells, cells)
    owner, limit = rows[entry], weights[entry]
    seed = mix(hashes[entry] ^ mix(cell.astype(np.uint64)))
    total = np.bincount(rows, weights=weights, minlength=n)
    out, filled = np.zeros((n, k), np.uint64), np.zeros((n, k), bool)
    known = total > 0
    enough = np.where(known, k * (math.log(k) + 2) / np.maximum(total, 1e-300), 0.0)
    low, width, level = 0.0, FINEST, 0
    alive = known.copy()
    while alive.any():
        on = alive[owner]
        if not on.all():
            seed, owner, limit, cell = seed[on], owner[on], limit[on], cell[on]
        here = mix(seed + mix(np.full(1, level, np.uint64)))
        counts = np.searchsorted(_chances(width), _unit(here), side="right")
        hit = np.flatnonzero(counts)
        number = counts[hit]
        at = np.repeat(hit, number)
        which = np.arange(len(at)) - np.repeat(np.cumsum(number) - number, number)
        dart = mix(here[at] + mix(which.astype(np.uint64) + np.uint64(1)))
        below = cell[at] + _unit(mix(dart ^ np.uint64(0x5BD1E995))) < limit[at]
        at, dart = at[below], dart[below]
        rank = _unit(mix(dart ^ np.uint64(0xC2B2AE35)))
        place = owner[at] * k + (mix(dart ^ np.uint64(0x27D4EB2F)) % np.uint64(k)).astype(np.int64)
        free = ~filled.ravel()[place]
        place, dart, rank = place[free], dart[free], rank[free]
        order = np.argsort(-rank, kind="stable")  # of several darts the one of least rank is written last
        out.ravel()[place[order]] = dart[order]
        filled.ravel()[place] = True
        low, level = low + width, level + 1
        width = min(low, WIDEST)
        if (low >= enough[alive]).any():
            alive &= (low < enough) | ~filled.all(axis=1)
    return out, known


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash for each band of each signature."""
    parts = signature.reshape(len(signature), bands, -1)
    total = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64)), parts.shape[:2])
    for r in range(parts.shape[2]):
        total = mix(total ^ parts[:, :, r])
    return total.view(np.int64)


def _weighted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, rows, repeat = numbered(*shingles(texts))
    last = np.append(repeat[1:] == 0, True) if len(repeat) else np.zeros(0, bool)
    return hashes[last], rows[last], (repeat[last] + 1).astype(np.float64)


def sign_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ``same`` (a digest of the text), ``bands`` (empty without words) and ``marks``.

    ``marks`` has a byte of every coordinate.
    """

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                signature, known = signatures(*_weighted(part["text"]), part.num_rows)
                bands = band_hashes(signature)
                marks = (signature & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["same"],
                     pa.array([b if y else [] for b, y in zip(bands, known)], pa.list_(pa.int64())),
                     pa.array([m.tobytes() if y else b"" for m, y in zip(marks, known)], pa.binary())],
                    ["doc_id", "same", "bands", "marks"],
                )

    df = narrow(docs, key, text).select("doc_id", F.md5("text").alias("same"), "text")
    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(sign, f"doc_id {kind}, same string, bands array<bigint>, marks binary")


def _elements(docs: DataFrame) -> DataFrame:
    """doc_id and 32-bit hashes of its shingles, the n-th of equal ones told from the others."""

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, rows, repeat = numbered(*shingles(part["text"]))
                values = (mix(hashes ^ mix(repeat.astype(np.uint64))) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                offsets = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.RecordBatch.from_arrays([part["doc_id"], listed], ["doc_id", "elements"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(collect, f"doc_id {kind}, elements array<int>")


def _both_ends(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(table.select(F.col("doc_id").alias(end), F.col(column).alias(f"{column}_{end}")), end)
    return pairs


def _agreement(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, marks_a, marks_b) that may be similar, with the agreement of their signatures."""

    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8) for c in ("marks_a", "marks_b")]
            equal = (ends[0] == ends[1]).reshape(batch.num_rows, COORDINATES).mean(axis=1)
            out = pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(equal)], ["a", "b", "agreement"])
            yield out.filter(pa.array(equal >= LIKELY))

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.select("a", "b", "marks_a", "marks_b").mapInArrow(agree, f"a {kind}, b {kind}, agreement double")


def _similar(pairs: DataFrame, marks: DataFrame, elements: DataFrame) -> DataFrame:
    """The pairs whose weighted Jaccard similarity is SIMILAR or more, stored."""
    likely = staged(_agreement(_both_ends(pairs, marks, "marks")), "likely")
    open_ = _both_ends(likely.where(F.col("agreement") < SURE).select("a", "b"), elements, "elements")
    common = F.size(F.array_intersect("elements_a", "elements_b"))
    either = F.size("elements_a") + F.size("elements_b") - common
    checked = open_.where(common >= SIMILAR * either).select("a", "b")
    return staged(likely.where(F.col("agreement") >= SURE).select("a", "b").unionByName(checked).distinct(), "similar")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _rarest(sought: DataFrame, held: np.ndarray) -> DataFrame:
    """The rarest elements of each text: two similar texts have one of them in common.

    At least four fifths of the elements of either text are in both, so of its elements, in any order
    that is the same for all texts, one of the first ``n - 4n/5 + 1`` is. ``place`` is its number from 0.
    """

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch["elements"]
            values = whole.flatten().to_numpy(zero_copy_only=False)
            n = pc.list_value_length(whole).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((values, held[values.view(np.uint32) % np.uint32(CELLS)], rows))
            place = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            first = place < (n - (4 * n + 4) // 5 + 1)[rows]
            taken = pa.array(rows[first])
            yield pa.RecordBatch.from_arrays(
                [*[batch[c].take(taken) for c in ("doc_id", "class", "aside")], pa.array(n[rows][first]),
                 pa.array(place[first]), pa.array(values[order][first])],
                ["doc_id", "class", "aside", "n", "place", "element"])

    kind = sought.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, class {kind}, aside boolean, n bigint, place bigint, element int"
    return sought.select("doc_id", "class", "aside", "elements").mapInArrow(post, columns)


def _meeting(sought: DataFrame) -> DataFrame:
    """Pairs (a, b) of different classes, one of them aside, that may be similar: no similar one is left out.

    A passage that all texts of a bucket share is no rare part of any, so they do not meet by it. How many
    texts hold an element is counted in a table of CELLS cells; a shared cell only changes the order.
    """
    sought = staged(sought, "sought")
    cell = F.pmod(F.col("element").cast("bigint"), F.lit(CELLS)).alias("cell")
    counts = sought.select(F.explode("elements").alias("element")).groupBy(cell).count().toPandas()
    held = np.zeros(CELLS, np.int64)
    held[counts["cell"].to_numpy(np.int64)] = counts["count"]
    posted = staged(_rarest(sought, held), "posted")
    x, y = (posted.select("element", *[F.col(c).alias(f"{c}_{e}") for c in ("doc_id", "class", "aside", "n", "place")])
            for e in ("x", "y"))
    # What can still be common, this element included, against the eight ninths of the mean that have to be.
    left = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    met = x.where("aside_x").join(y, "element").where(
        (F.col("class_x") != F.col("class_y")) & (~F.col("aside_y") | (F.col("doc_id_x") < F.col("doc_id_y")))
        & (9 * left >= 4 * (F.col("n_x") + F.col("n_y"))))
    return met.select(*_pair("doc_id_x", "doc_id_y")).distinct()


def similar_pairs(texts: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of different texts that are near-duplicates and connect all that are.

    ``texts`` has a row for each different text: doc_id, bands and marks; ``docs`` has doc_id and text.
    """
    listed = texts.select("doc_id", F.explode("bands").alias("bucket"))
    met = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = staged(listed.join(met, "bucket"), "members")
    degree = members.groupBy("doc_id").agg(F.sum("members").alias("degree"))
    hubs = staged(members.join(degree, "doc_id").groupBy("bucket").agg(
        F.max_by("doc_id", F.struct("degree", "doc_id")).alias("hub")), "hubs")
    members = members.select("bucket", "doc_id")
    # The texts are many times their keys, which a merge join takes at any size.
    wanted = members.select("doc_id").distinct().hint("merge")
    elements = staged(_elements(docs.join(wanted, "doc_id", "left_semi")).dropDuplicates(["doc_id"]), "elements")
    marks = texts.select("doc_id", "marks")
    tried = staged(members.join(hubs, "bucket").where("doc_id != hub").select(*_pair("doc_id", "hub")).distinct(), "tried")
    similar = _similar(tried, marks, elements)
    # Members outside their hub's class meet the members of other classes.
    labels = connected(similar).select(F.col("node").alias("doc_id"), "label")
    named = members.join(labels, "doc_id", "left").select("bucket", "doc_id", F.coalesce("label", "doc_id").alias("class"))
    named = staged(named, "named")
    mine = hubs.join(named.withColumnRenamed("doc_id", "hub"), ["bucket", "hub"]).select("bucket", F.col("class").alias("hub_class"))
    aside = F.col("class") != F.col("hub_class")
    told = staged(named.join(mine, "bucket").select("bucket", "doc_id", "class", aside.alias("aside")), "told")
    mixed = told.where("aside").select("bucket").distinct()
    sought = told.join(mixed, "bucket", "left_semi").groupBy("doc_id", "class").agg(F.max("aside").alias("aside"))
    swept = _meeting(sought.join(elements, "doc_id"))
    swept = staged(swept.join(tried, ["a", "b"], "left_anti"), "swept")
    return similar.unionByName(_similar(swept, marks, elements))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and class_id (the least key of its class of near-duplicates) of every row.

    Equal texts are one class, texts without words included (a null text counts as empty); only
    one of them goes on to be compared. Classes are what pairs of similarity SIMILAR or more
    connect. Repeated rows each stay; a row without key takes the class of a keyed copy, else
    null; an empty table gives no rows; other columns are not read.
    """
    df = narrow(docs, key, text)
    signed = staged(sign_documents(df), "signed")
    texts = staged(
        signed.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"),
                                   F.first("marks").alias("marks")), "texts")
    labels = connected(similar_pairs(texts.where("doc_id IS NOT NULL").drop("same"), df))
    named = texts.select("same", "doc_id").join(labels, texts["doc_id"] == labels["node"], "left")
    named = named.select("same", F.coalesce("label", "doc_id").alias("class_id"))
    return signed.select("doc_id", "same").join(named, "same").select("doc_id", "class_id")


def keep_one_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key is the least of its class; rows with one key go together."""
    gone = near_duplicates(docs, key, text).where("doc_id != class_id").select(F.col("doc_id").alias("_gone"))
    gone = staged(gone.distinct(), "gone")
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")
