"""Removal of repeated byte strings by a sparse suffix array over the whole corpus.

A byte goes if it lies in a string of SPAN bytes that also starts earlier (in an earlier document, or
earlier in its own); strings never cross documents. All strings are judged on the input.

*Sampling.* Every string of SPAN bytes picks the position of its least LEAD-byte gram by a hash, so
equal strings pick the same place. Only suffixes at picked positions (some 2 in 86 bytes of prose) are
sorted; a string is found through the position it picks. What a suffix's strings can hold, its context, are
the SPAN - LEAD bytes before it and the SPAN bytes from it on.

*First sort.* Suffixes are range-partitioned by their leading LEAD bytes, a digest of their context
and their place, with splitters that Spark samples; each partition is sorted. A suffix behind another
one of the same context only has strings that start earlier. Since the place is part of the key, a
passage that a third of all documents hold is split over many partitions; the class that crosses a
boundary is compared across it by an aggregate of one row for each side.

*Second sort.* The first suffixes of different contexts with equal leading bytes (these lie near the ends of repeats
and near edits) get their contexts, are range-partitioned by suffix and sorted by
a multikey quicksort over 8-byte words, forwards and, with the bytes before them, backwards. Lengths of
common prefixes of neighbours then give, for each number of bytes before the suffix, the classes of
equal strings. Groups of leading bytes that may cross a boundary also send a digest of each
of their different strings to an aggregate, which compares them across boundaries however many partitions a group fills.

Edge cases: null texts are empty; nothing goes from texts under SPAN bytes. Documents come in the order
of their key, null first, then of a digest of the text for equal keys; equal rows are one document
and get the same result each. Columns of other names are ignored.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from wordloom.llm.shingles import mix, slices
from wordloom.session import staged

SPAN, LEAD = 100, 16
#: Bytes before a suffix that a string which picks it can hold; one more is the number of grams of a string.
BEFORE = SPAN - LEAD
#: Contexts that are sorted together, to bound a task's memory; a group of leading bytes may be larger.
TOGETHER = 20_000
#: What a row of the first sort says.
COPY, CONTEXT, OUTER = 0, 1, 2
_ZSTD_LEVEL = 1


# -- positions ------------------------------------------------------------------------------

def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) over each run of ``width`` values, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = choose(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return choose(values[: len(values) - rest], values[rest:]) if rest else values


def _words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a number, most significant byte first."""
    two = (data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]
    four = (two[:-2].astype(np.uint32) << np.uint32(16)) | two[2:]
    return (four[:-4].astype(np.uint64) << np.uint64(32)) | four[4:]


def picked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions that some string of a text picks, and their leading bytes as two numbers.

    ``data`` holds texts, one after the other; ``starts`` and ``ends`` say where.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(data) < SPAN:
        return none
    words = _words_at(data)
    first, second = words[:-8], words[8:]
    grams = (mix(first ^ (mix(second) >> np.uint64(1))) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _sliding(grams, BEFORE + 1, np.minimum)  # of the string that starts there
    inside = np.zeros(len(data) + 1, np.int64)
    long = ends - starts >= SPAN
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - SPAN + 1, -1)
    least = np.where(np.cumsum(inside)[: len(least)] > 0, least, np.uint32(0))
    edge = np.zeros(BEFORE, np.uint32)
    best = _sliding(np.concatenate([edge, least, edge]), BEFORE + 1, np.maximum)[: len(grams)]
    at = np.flatnonzero(best == grams)
    return at, first[at], second[at]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            lengths = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
            text = b"".join(batch["text"].to_pylist())
            ends = np.cumsum(lengths)
            starts = ends - lengths
            at, lead, next_ = picked(np.frombuffer(text, np.uint8), starts, ends)
            if not len(at):
                continue
            row = np.searchsorted(ends, at, side="right")
            begin, end = np.maximum(starts[row], at - BEFORE), np.minimum(ends[row], at + SPAN)
            digest = np.fromiter((xxhash.xxh3_64_intdigest(text[a:b], c) for a, b, c in zip(
                begin.tolist(), end.tolist(), (at - begin).tolist())), np.uint64, len(at))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lead.view(np.int64)), pa.array(next_.view(np.int64)), pa.array(digest.view(np.int64)),
                 batch["doc"].take(take), batch["text_id"].take(take), pa.array((at - starts[row]).astype(np.int32))],
                ["lead", "next", "context", "doc", "text_id", "at"])


# -- first sort -----------------------------------------------------------------------------

SUFFIX = ("lead", "next", "context", "doc", "text_id", "at")


def _repeats(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """True for rows of the same document and position as the row before: the document is there twice."""
    same = np.zeros(len(rows), bool)
    same[1:] = True
    for name in ("doc", "text_id", "at"):
        column = rows[name].combine_chunks() if isinstance(rows, pa.Table) else rows[name]
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        same[1:] &= codes[1:] == codes[:-1]
    return same


def _first_sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes: those behind one of equal context, and the firsts of contexts that share leading bytes.

    The firsts of the partition's outermost contexts are also reported as OUTER, and all contexts of its
    outermost groups as CONTEXT, as their equals may stand across the boundary.
    """
    last = held = final = before = None  # key of the last row, the open group's only context so far, the last context, the last row
    for batch in batches:
        if not len(batch):
            continue
        joined = batch if before is None else pa.concat_batches([before, batch])
        batch = joined.filter(pa.array(~_repeats(joined))).slice(0 if before is None else 1)
        if not len(batch):
            continue
        before = batch.slice(len(batch) - 1)
        lead, next_, context = (batch[c].to_numpy() for c in SUFFIX[:3])
        group, kind = np.ones(len(batch), bool), np.ones(len(batch), bool)
        group[1:] = (lead[1:] != lead[:-1]) | (next_[1:] != next_[:-1])
        kind[1:] = group[1:] | (context[1:] != context[:-1])
        group[0] = last is not None and last[:2] != (lead[0], next_[0])
        kind[0] = last is None or last != (lead[0], next_[0], context[0])
        if last is None:
            yield _said(batch.slice(0, 1), OUTER)
        last = (lead[-1], next_[-1], context[-1])
        if not kind.all():
            yield _said(batch.filter(pa.array(~kind)), COPY)
        firsts = np.flatnonzero(kind)
        if not len(firsts):
            continue
        rows, fresh = batch.take(pa.array(firsts)), group[firsts]
        final = rows.slice(len(rows) - 1)
        if held is not None:
            rows, fresh = pa.concat_batches([held, rows]), np.append(True, fresh)
        run = np.cumsum(fresh)
        shared = np.bincount(run) > 1
        shared[0] = True  # rows of a group that was reported before, or of the partition's first
        if shared[run].any():
            yield _said(rows.filter(pa.array(shared[run])), CONTEXT)
        held = None if shared[run[-1]] else final
    if final is not None:
        yield _said(final, OUTER)
    if held is not None:
        yield _said(held, CONTEXT)


def _said(rows: pa.RecordBatch, what: int) -> pa.RecordBatch:
    said = pa.array(np.full(len(rows), what, np.int32))
    return pa.RecordBatch.from_arrays([said, *[rows[c] for c in SUFFIX]], ["said", *SUFFIX])


# -- second sort ----------------------------------------------------------------------------

def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of 8-byte words, and for each place in it the number of leading words shared with the one before.

    Rows are split by one word; only those that are still equal go on to the next.
    """
    n, width = words.shape
    order, shared = np.arange(n), np.zeros(n, np.int64)
    part = np.zeros(n, np.int64)  # by place: where the run of rows that are equal so far begins
    open_ = np.arange(n)
    for level in range(width):
        if not len(open_):
            break
        values = words[order[open_], level]
        moved = np.lexsort((values, part[open_]))
        order[open_] = order[open_[moved]]
        values = values[moved]
        same = np.zeros(len(open_), bool)
        same[1:] = (part[open_[1:]] == part[open_[:-1]]) & (values[1:] == values[:-1])
        shared[open_[same]] = level + 1
        part[open_[~same]] = open_[~same]
        begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(open_))))
        part[open_] = open_[begin]
        keep = same.copy()
        keep[:-1] |= same[1:]
        open_ = open_[keep]
    return order, shared


def _prefix_classes(texts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of zero-padded byte rows, and how many bytes each place shares with the one before."""
    width = -(-texts.shape[1] // 8) * 8
    padded = np.zeros((len(texts), width), np.uint8)
    padded[:, : texts.shape[1]] = texts
    order, shared = multikey_order(padded.view(">u8").astype(np.uint64))
    bytes_ = shared * 8
    for i in range(8):  # the bytes of the first word that differs
        place = np.minimum(bytes_, width - 1)
        at = np.arange(1, len(order))
        equal = (padded[order[at], place[at]] == padded[order[at - 1], place[at]]) & (bytes_[at] == shared[at] * 8 + i) & (bytes_[at] < width)
        bytes_[at[equal]] += 1
    # Padding is no text: what two rows share ends with the shorter one, unless they are equal.
    before = np.append(0, sizes[order][:-1])
    ended = np.minimum(sizes[order], before)
    return order, np.where((sizes[order] == before) & (bytes_ >= ended), np.iinfo(np.int64).max, np.minimum(bytes_, ended))


def earlier_strings(left: list[bytes], right: list[bytes], place: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each number of bytes before the suffix: the rows whose string with so many is also that of a row of lower ``place``."""
    n = len(left)
    before, after = (np.fromiter(map(len, x), np.int64, n) for x in (left, right))
    ahead = np.frombuffer(b"".join(x.ljust(SPAN, b"\0") for x in right), np.uint8).reshape(n, SPAN)
    behind = np.frombuffer(b"".join(x[::-1].ljust(BEFORE, b"\0") for x in left), np.uint8).reshape(n, BEFORE)
    forward, forward_shared = _prefix_classes(ahead, after)
    backward, backward_shared = _prefix_classes(behind, before)
    by_place = np.argsort(place, kind="stable")
    for o in range(BEFORE + 1):
        fit = (before >= o) & (after >= SPAN - o)
        if fit.sum() < 2:
            continue
        suffix, prefix = np.empty(n, np.int64), np.empty(n, np.int64)
        suffix[forward] = np.cumsum(forward_shared < SPAN - o)
        prefix[backward] = np.cumsum(backward_shared < o)
        rows = by_place[fit[by_place]]
        strings = suffix[rows] * (n + 1) + prefix[rows]
        _, first = np.unique(strings, return_index=True)
        later = np.ones(len(rows), bool)
        later[first] = False
        if later.any():
            yield o, rows[later]


def _places(table: pa.Table) -> np.ndarray:
    """The order of the rows by document and position."""
    order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in ("doc", "text_id", "at")], null_placement="at_start")
    place = np.empty(len(table), np.int64)
    place[order.to_numpy()] = np.arange(len(table))
    return place


def _spans(table: pa.Table, rows: np.ndarray, begins: np.ndarray, ends: np.ndarray, strings: pa.Array) -> pa.RecordBatch:
    take = pa.array(rows)
    return pa.RecordBatch.from_arrays(
        [strings, table["doc"].combine_chunks().take(take), table["text_id"].combine_chunks().take(take),
         pa.array(begins.astype(np.int32)), pa.array(ends.astype(np.int32))], ["string", "doc", "text_id", "begin", "end"])


def _later(table: pa.Table) -> tuple[np.ndarray, pa.RecordBatch | None]:
    """By row and number of bytes before the suffix: strings that start earlier in the table; a span for each context."""
    at = table["at"].to_numpy().astype(np.int64)
    later = np.zeros((len(at), BEFORE + 1), bool)
    for o, rows in earlier_strings(table["left"].to_pylist(), table["right"].to_pylist(), _places(table)):
        later[rows, o] = True
    rows = np.flatnonzero(later.any(1))
    if not len(rows):
        return later, None
    # The strings of one context overlap, so they cover one span.
    least, most = later[rows].argmax(1), BEFORE - later[rows, ::-1].argmax(1)
    return later, _spans(table, rows, at[rows] - most, at[rows] - least + SPAN, pa.nulls(len(rows), pa.binary()))


def _inner(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """What whole groups of contexts hold that starts earlier."""
    _, spans = _later(table.filter(pa.array(~_repeats(table))))
    if spans is not None:
        yield spans


def _outer(table: pa.Table, edges: list[bytes] | None = None) -> Iterator[pa.RecordBatch]:
    """The same for contexts whose group may go on across a boundary, and a digest of each string that is new here.

    ``edges`` has the suffixes of a whole group at the partition's boundaries. Rows are sorted by suffix, so a string that also
    stands beyond a boundary has the bytes from the picked position on in common with the row there; the others are left out.
    """
    table = table.filter(pa.array(~_repeats(table)))
    later, spans = _later(table)
    if spans is not None:
        yield spans
    digests, rows, begins = [], [], []
    for i, (a, b, at) in enumerate(zip(table["left"].to_pylist(), table["right"].to_pylist(), table["at"].to_pylist())):
        text = a + b
        reach = len(b) if edges is None else max(len(os.path.commonprefix([b, edge])) for edge in edges)
        for o in range(max(0, SPAN - reach), len(a) + 1):
            if not later[i, o]:
                digests.append(xxhash.xxh3_128_digest(text[len(a) - o : len(a) - o + SPAN]))
                rows.append(i)
                begins.append(at - o)
    if rows:
        starts = np.array(begins, np.int64)
        yield _spans(table, np.array(rows), starts, starts + SPAN, pa.array(digests, pa.binary()))


def _group_starts(table: pa.Table) -> np.ndarray:
    lead, next_ = table["lead"].to_numpy(), table["next"].to_numpy()
    return np.flatnonzero((lead[1:] != lead[:-1]) | (next_[1:] != next_[:-1])) + 1


def _second_sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted contexts: the spans whose strings start earlier, and the different strings of the outermost groups."""
    held, opening, last = None, True, None
    first = None  # the suffix of the partition's first row, as long as no row of its group was given on
    for batch in batches:
        if not len(batch):
            continue
        key = (batch["lead"][0].as_py(), batch["next"][0].as_py())
        if held is None and last is not None and key != last:
            opening = False
        if last is None:
            first = batch["right"][0].as_py()
        last = (batch["lead"][-1].as_py(), batch["next"][-1].as_py())
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        starts = _group_starts(held)
        if opening and len(starts):
            yield from _outer(held.slice(0, int(starts[0])), None if first is None else [first])
            held, starts, opening = held.slice(int(starts[0])), starts[1:] - starts[0], False
        if opening and len(held) >= TOGETHER:
            yield from _outer(held)
            held = first = None
        elif len(starts) and starts[-1] >= TOGETHER:
            yield from _inner(held.slice(0, int(starts[-1])))
            held = held.slice(int(starts[-1]))
    if held is not None:
        starts = _group_starts(held)
        end = int(starts[-1]) if len(starts) else 0
        if end:
            yield from _inner(held.slice(0, end))
        whole = end or not opening
        edge = held["right"][-1].as_py()
        yield from _outer(held.slice(end), [edge] if whole else None if first is None else [first, edge])


# -- the operator ---------------------------------------------------------------------------

def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc, text_id, text``: a document and a digest that tells apart texts of one key."""
    value = F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")
    return docs.select(docs[key].alias("doc"), value.alias("text")).select("doc", F.xxhash64("text").alias("text_id"), "text")


def _packed(texts: DataFrame) -> DataFrame:
    """The texts compressed, for an exchange."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=_ZSTD_LEVEL).compress
        for batch in batches:
            for part in slices(batch):
                packed = pa.array([compress(t) for t in part["text"].to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part["doc"], part["text_id"], packed], ["doc", "text_id", "text"])

    return texts.mapInArrow(pack, texts.schema)


def _beside(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Packed texts with the rows of their document."""
    same = texts["doc"].eqNullSafe(lists["doc"]) & (texts["text_id"] == lists["text_id"])
    rest = [lists[c] for c in lists.columns if c not in ("doc", "text_id")]
    return texts.join(lists, same, how).select(texts["doc"], texts["text_id"], texts["text"], *rest)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        lead, next_, left, right, rows, places = [], [], [], [], [], []
        for i, (packed, positions) in enumerate(zip(batch["text"].to_pylist(), batch["ats"].to_pylist())):
            text = expand(packed)
            for at in set(positions):
                lead.append(int.from_bytes(text[at : at + 8], "big", signed=True))
                next_.append(int.from_bytes(text[at + 8 : at + 16], "big", signed=True))
                left.append(text[max(0, at - BEFORE) : at])
                right.append(text[at : at + SPAN])
                rows.append(i)
                places.append(at)
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lead, pa.int64()), pa.array(next_, pa.int64()), pa.array(left, pa.binary()), pa.array(right, pa.binary()),
             batch["doc"].take(take), batch["text_id"].take(take), pa.array(places, pa.int32())],
            ["lead", "next", "left", "right", "doc", "text_id", "at"])


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that spans cover; spans that touch are one."""
    if not len(begins):
        return begins, ends
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.append(True, begins[1:] > reach[:-1])
    return begins[new], np.append(reach[:-1][new[1:]], reach[-1])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for whole in batches:
        for batch in slices(whole):
            sizes, kept, found = [], [], []
            for packed, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                text = expand(packed)
                sizes.append(len(text))
                spans = np.array([(s["begin"], s["end"]) for s in spans or ()], np.int64).reshape(-1, 2)
                begins, ends = merged(np.maximum(spans[:, 0], 0), np.minimum(spans[:, 1], len(text)))
                found.append([{"begin": b, "end": e} for b, e in zip(begins.tolist(), ends.tolist())])
                kept.append(b"".join(text[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(text)])))
            runs = pa.array(found, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.array(sizes, pa.int64()), runs, pa.array(kept, pa.binary())], ["doc", "n_bytes", "spans", "kept"])


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, text_id, begin, end``: spans of bytes that go; they may overlap and reach over the text's ends."""
    texts = _texts(docs, key, text)
    doc = texts.schema["doc"]
    place = [doc, StructField("text_id", LongType()), StructField("at", IntegerType())]
    ordered = [StructField(c, LongType()) for c in SUFFIX[:3]]
    suffixes = texts.mapInArrow(_suffixes, StructType([*ordered, *place]))
    sorted_ = suffixes.repartitionByRange(*SUFFIX).sortWithinPartitions(*SUFFIX)
    said = staged(sorted_.mapInArrow(_first_sort, StructType([StructField("said", IntegerType()), *ordered, *place])), "suffixes")

    spot = F.struct("doc", "text_id", "at")
    outer = said.where(F.col("said") == OUTER)
    first = outer.groupBy(*SUFFIX[:3]).agg(F.min(spot).alias("first"))
    across = outer.join(first, [*SUFFIX[:3]]).where(spot > F.col("first"))
    copies = said.where(F.col("said") == COPY).select("doc", "text_id", "at").unionByName(across.select("doc", "text_id", "at"))

    wanted = said.where(F.col("said") == CONTEXT).groupBy("doc", "text_id").agg(F.collect_list("at").alias("ats"))
    words = [StructField(c, LongType()) for c in SUFFIX[:2]]
    sides = [StructField(c, BinaryType()) for c in ("left", "right")]
    contexts = staged(_beside(_packed(texts), wanted, "inner").mapInArrow(_contexts, StructType([*words, *sides, *place])), "contexts")
    order = ["lead", "next", "right", "doc", "text_id", "at"]
    spans = [doc, StructField("text_id", LongType()), StructField("begin", IntegerType()), StructField("end", IntegerType())]
    judged = staged(contexts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _second_sort, StructType([StructField("string", BinaryType()), *spans])), "spans")
    start = F.struct("doc", "text_id", "begin")
    strings = judged.where(F.col("string").isNotNull())
    earliest = strings.groupBy("string").agg(F.min(start).alias("first"))
    later = strings.join(earliest, "string").where(start > F.col("first"))
    columns = ["doc", "text_id", "begin", "end"]
    return (
        copies.select("doc", "text_id", (F.col("at") - BEFORE).alias("begin"), (F.col("at") + SPAN).alias("end"))
        .unionByName(judged.where(F.col("string").isNull()).select(*columns)).unionByName(later.select(*columns))
    )


def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``spans`` (begin, end of each maximal removed run), ``kept`` (the other bytes)."""
    spans = repeated_spans(docs, key, text).groupBy("doc", "text_id").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    texts = _texts(docs, key, text)
    run = StructType([StructField("begin", LongType()), StructField("end", LongType())])
    schema = StructType([texts.schema["doc"], StructField("n_bytes", LongType()),
                         StructField("spans", ArrayType(run)), StructField("kept", BinaryType())])
    return _beside(_packed(texts), spans, "left").mapInArrow(_cut, schema).withColumnRenamed("doc", key)
