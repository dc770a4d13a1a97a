"""Line deduplication by an exact set-similarity join.

A line is the set of its words; lines under MIN_WORDS words are left alone. A line goes when an
earlier one (by document key and line number) has a Jaccard similarity of SIMILAR or more.
The words of a line are put in order of rarity, counted over the whole corpus; similar lines
share one of the rarest few (prefix filter), are about as long (length filter), and have it at
places that leave enough common words possible (positional filter). Each line's words also
set the bits of a small map; bits in which two maps differ are words that only one line has,
which bounds what they have in common. Candidates are verified on their words, each a 64-bit hash, which tells classes too.

Lines with equal sets of words are one class and are joined once, however many they are. Classes
come together by word; a word of very many is dealt out in pairs of blocks. A group of near copies does
not turn into its pairs: each class is told by its edits, the words that only it or only its hub has, and the
classes of one hub are a star. Two classes differ in the edits that not both have. If they share none, their similarity
follows from one number each, the excess, so earlier matches are counted by excess without pairs. Only classes that the
edits they share make similar, and classes of different stars, meet and are verified in pairs. No link is lost. Any set of words can be
what a star's edits are told from: a hub joins the star of its own hub with its members, and edits that most members have are
taken into it, so that few pairs share any.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.line_words import line_words
from wordloom.llm.shingles import mix, slices
from wordloom.llm.tables import narrow
from wordloom.session import staged

MIN_WORDS = 5
#: Similarity as a fraction, so that the filters are exact.
NUMERATOR, DENOMINATOR = 4, 5
#: Two sets of n and m words of which d are in one only are similar if d * APART <= (n + m) * TOTAL.
APART, TOTAL = DENOMINATOR + NUMERATOR, DENOMINATOR - NUMERATOR
#: Counters for the rarity of words; words that share one are ordered by their joint count.
COUNTERS = 1 << 18
#: Counters that are handed on as one row.
CHUNK = 1 << 14
#: Rows of one word that are compared with each other in one task, rows that are worked on together.
BLOCK = 4000
TOGETHER = 100_000
#: Classes of a star that are compared by their edits in one task.
STAR_BLOCK = 1500
#: Times that the classes of a hub follow it into the star of its own hub.
HOPS = 2
#: Classes that a task keeps in mind to post them once.
REMEMBERED = 500_000
#: Groups that cells are dealt to, and posted rows that a task gathers to hand on those of a group as one row.
GROUPS = 1 << 13
GATHERED = 300_000
#: Bits of the map of the documents whose texts are asked for, and of a stretch of it.
PLACES = 1 << 25
STRETCH = 1 << 15
POSTED = ["cell", "at", "digest", "high", "low"]


def _digests(hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A number for each set of words, of the hashes of one line after another."""
    if not len(size):
        return np.zeros(0, np.int64)
    total = np.add.reduceat(mix(hashes), np.cumsum(size) - size)
    return mix(mix(total) ^ size.astype(np.uint64)).view(np.int64)


def _counters(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(COUNTERS - 1)).view(np.int64)


def describe_texts(docs: DataFrame) -> DataFrame:
    """A row for each text: doc_id, and numbers and digests (of the sets of words) of its lines; and rows of counters.

    Every task adds up its own COUNTERS numbers of how many lines have a word of each counter; ``seen`` has CHUNK of
    them, little-endian, and ``chunk`` says which.
    """

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        names = ["doc_id", "numbers", "digests", "chunk", "seen"]
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in slices(batch):
                row, number, size, hashes, _ = line_words(part["text"], MIN_WORDS)
                total += np.bincount(_counters(hashes), minlength=COUNTERS)
                ends = pa.array(np.searchsorted(row, np.arange(len(part["text"]) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, x) for x in (pa.array(number, pa.int32()), pa.array(_digests(hashes, size)))]
                nothing = [pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *lists, *nothing], names)
        chunks = total.reshape(-1, CHUNK)
        used = np.flatnonzero(chunks.any(1))
        if len(used):
            empty = [pa.nulls(len(used), t) for t in (kind, pa.list_(pa.int32()), pa.list_(pa.int64()))]
            seen = pa.array([chunks[c].tobytes() for c in used.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*empty, pa.array(used, pa.int32()), seen], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(describe, f"doc_id {kind}, numbers array<int>, digests array<bigint>, chunk int, seen binary")


def _lines_of(texts: DataFrame) -> DataFrame:
    lines = texts.select("doc_id", "numbers", F.posexplode("digests").alias("k", "digest"))
    return lines.select("doc_id", F.col("numbers")[F.col("k")].alias("line"), "digest")


def describe_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line and digest (of the set of words) of each line."""
    return _lines_of(describe_texts(docs).where("numbers IS NOT NULL"))


def _summed(counted: DataFrame) -> np.ndarray:
    """The COUNTERS numbers of all tasks added up."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, seen in zip(batch["chunk"].to_pylist(), batch["seen"]):
                total[chunk] = total.get(chunk, 0) + np.frombuffer(seen.as_buffer(), np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([
                pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["chunk", "seen"])

    counts = np.zeros((COUNTERS // CHUNK, CHUNK), np.int64)
    for row in counted.repartition("chunk").mapInArrow(add, "chunk int, seen binary").collect():
        counts[row["chunk"]] = np.frombuffer(row["seen"], np.int64)
    return counts.reshape(-1)


def _bit_maps(hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each line 128 bits, each set if an odd number of its words falls on it, as two integers."""
    if not len(size):
        return np.zeros((0, 2), np.int64)
    bit = np.uint64(1) << ((hashes >> np.uint64(57)) & np.uint64(63))
    upper = hashes >> np.uint64(63)
    start = np.cumsum(size) - size
    maps = [np.bitwise_xor.reduceat(bit * half, start) for half in (upper, np.uint64(1) - upper)]
    return np.stack(maps, axis=1).view(np.int64)


def _cells(word: np.ndarray, digest: np.ndarray, held: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, cell, side): the cells that each entry goes to; every two entries of a word share one.

    The entries of a word that more than ``size`` lines have are dealt to blocks by digest, and each
    pair of blocks is a cell. ``side`` is 0 in the cell of one block, which has the pairs inside it, and
    1 or 2 in a cell of two, which has the pairs between them.
    """
    blocks = np.maximum(-(-held // size), 1)
    block = (mix(digest.view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
    entry = np.repeat(np.arange(len(word)), blocks)
    other = np.arange(len(entry)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    mine = block[entry]
    low, high = np.minimum(mine, other), np.maximum(mine, other)
    pair = mix((low.astype(np.uint64) << np.uint64(32)) | high.astype(np.uint64))
    side = np.where(low == high, 0, np.where(mine == low, 1, 2))
    return entry, mix(word[entry] ^ pair).view(np.int64), side


def _by_group(rows: np.ndarray) -> pa.RecordBatch:
    """group and rows: the posted rows of each group of cells one after another, as little-endian 64-bit integers."""
    group = (rows[:, 0].view(np.uint64) % np.uint64(GROUPS)).astype(np.uint16)
    held = np.bincount(group, minlength=GROUPS)
    used = np.flatnonzero(held)
    ends = np.append(0, np.cumsum(held[used]) * rows.itemsize * len(POSTED)).astype(np.int32)
    data = rows[np.argsort(group, kind="stable")]
    packed = pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), packed], ["group", "rows"])


def post_prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """cell, at, digest, high and low for each of the rarest words of each class of equal lines, by group of cells.

    ``at`` has the number of different words, the place of this one and the side in its cell.
    A task posts a class once for every REMEMBERED different classes that it comes by.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # COUNTERS numbers
    block, most = BLOCK, GATHERED

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        seen: set[int] = set()
        gathered, waiting = [], 0
        for batch in batches:
            for part in slices(batch):
                _, _, size, hashes, line = line_words(part["text"], MIN_WORDS, counts)
                digest = _digests(hashes, size)
                if len(seen) > REMEMBERED:
                    seen.clear()
                _, first = np.unique(digest, return_index=True)
                fresh = np.zeros(len(size), bool)
                fresh[[k for k in first.tolist() if int(digest[k]) not in seen]] = True
                seen.update(digest[fresh].tolist())
                maps = _bit_maps(hashes, size)
                place = np.arange(len(hashes)) - np.repeat(np.cumsum(size) - size, size)
                prefix = np.where(fresh, size - -(-size * NUMERATOR // DENOMINATOR) + 1, 0)
                use = np.flatnonzero(place < np.repeat(prefix, size))
                held = counts[_counters(hashes[use])]
                # Words that no other line has cannot make a match.
                use, held = use[held > 1], held[held > 1]
                line, place = line[use], place[use]
                entry, cell, side = _cells(hashes[use], digest[line], held, block)
                line, place = line[entry], place[entry]
                gathered.append(np.stack([cell, (size[line] << 32) | (place << 2) | side, digest[line],
                                          maps[line, 0], maps[line, 1]], axis=1))
                waiting += len(cell)
                if waiting >= most:
                    yield _by_group(np.concatenate(gathered))
                    gathered, waiting = [], 0
        if waiting:
            yield _by_group(np.concatenate(gathered))

    return docs.mapInArrow(post, "group int, rows binary")


def _ungrouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The posted rows, one by one again, with their group."""
    for batch in batches:
        for k in range(0, batch.num_rows, 1000):
            part = batch.slice(k, 1000)
            packed = part["rows"]
            _, ends, data = packed.buffers()
            ends = np.frombuffer(ends, np.int32)[packed.offset : packed.offset + len(packed) + 1]
            rows = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(np.int64).reshape(-1, len(POSTED))
            group = np.repeat(part["group"].to_numpy(), np.diff(ends) // rows.strides[0])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.ascontiguousarray(c)) for c in rows.T), pa.array(group)], [*POSTED, "group"])


def _by_cell(rows: DataFrame) -> DataFrame:
    return rows.repartition("cell").sortWithinPartitions("cell")


def _cells_in_order(batches: Iterable[pa.RecordBatch], key: str = "cell") -> Iterator[pa.Table]:
    """Whole cells of two rows or more, their rows in order, of rows sorted by ``key``, which all rows of a cell share."""
    for rows in _whole_cells(batches, key):
        cell = rows["cell"].to_numpy()
        order = np.argsort(cell)
        same = cell[order[1:]] == cell[order[:-1]]
        order = order[np.append(same, False) | np.append(False, same)]
        if len(order):
            digest, at, cell = (rows[c].to_numpy()[order] for c in ("digest", "at", "cell"))
            yield rows.select([c for c in rows.column_names if c != "group"]).take(pa.array(order[np.lexsort((digest, at, cell))])).combine_chunks()


def _whole_cells(batches: Iterable[pa.RecordBatch], key: str = "cell", together: int | None = None) -> Iterator[pa.Table]:
    """Rows sorted by ``key`` in tables of about ``together`` (or TOGETHER), none of which ends inside a key."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size < (together or TOGETHER):
            continue
        rows = pa.Table.from_batches(waiting)
        cell = rows[key].to_numpy()
        same = np.flatnonzero(cell != cell[-1])
        end = int(same[-1]) + 1 if len(same) else 0  # the last cell may go on
        if end:
            yield rows.slice(0, end)
        waiting = rows.slice(end).to_batches()
        size = rows.num_rows - end
    if size:
        yield pa.Table.from_batches(waiting)


def _pairs_of(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, words, differ): rows x of whole sorted cells and earlier rows y of them that may match.

    No row is twice among the rows x or y that come at once. ``words`` is the number of words of both together,
    ``differ`` a lower bound of those that one has alone.
    """
    cell, at, digest, high, low = (rows[c].to_numpy() for c in POSTED)
    n, place, side = at >> 32, (at & 0xFFFFFFFF) >> 2, at & 3
    new = np.append(True, cell[1:] != cell[:-1])
    rank = np.arange(len(cell)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    copy = np.append(False, ~new[1:] & (digest[1:] == digest[:-1]))  # posted by several tasks
    x, back = np.flatnonzero((rank > 0) & ~copy), 1
    while len(x):
        y = x - back
        near = n[y] * DENOMINATOR >= n[x] * NUMERATOR  # rows further back are no longer
        x, y = x[near], y[near]
        words, i, j = n[x] + n[y], place[x], place[y]
        ok = ~copy[y] & ((side[x] == 0) | (side[x] != side[y]))
        ok &= (np.minimum(i, j) + 1 + np.minimum(n[x] - i - 1, n[y] - j - 1)) * (NUMERATOR + DENOMINATOR) >= words * NUMERATOR
        u, v, words = x[ok], y[ok], words[ok]
        differ = sum(np.bitwise_count((m[u] ^ m[v]).view(np.uint64)).astype(np.int64) for m in (high, low))
        ok = (words - differ) * (NUMERATOR + DENOMINATOR) >= 2 * words * NUMERATOR
        yield u[ok], v[ok], words[ok], differ[ok]
        back += 1
        x = x[rank[x] >= back]


def _note_degrees(posted: DataFrame) -> DataFrame:
    """The posted rows that have a possible match in their cell, with ``degree``, which grows with their number and nearness, stored.

    That of the text that a group of copies was made from is the highest, as copies are further from each other.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells_in_order(_ungrouped(batches), "group"):
            degree = np.zeros(len(rows), np.int64)
            for x, y, words, differ in _pairs_of(rows):
                nearness = words * TOTAL - differ * APART + 1  # above 0 for possible matches
                degree[x] += nearness
                degree[y] += nearness
            yield from rows.append_column("degree", pa.array(degree)).filter(pa.array(degree > 0)).combine_chunks().to_batches()

    named = ", ".join(f"{c} bigint" for c in [*POSTED, "degree"])
    return staged(posted.repartition("group").sortWithinPartitions("group").mapInArrow(find, named), "matched")


def _find_hubs(matched: DataFrame) -> DataFrame:
    """Classes (x) and, for each of their cells, the possible match (y) whose degree in any cell (``most``) is the highest, if above theirs."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells_in_order(batches):
            digest, most = rows["digest"].to_numpy(), rows["most"].to_numpy()
            order = np.lexsort((digest, most))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            best = rank.copy()
            for x, y, _, _ in _pairs_of(rows):
                best[x] = np.maximum(best[x], rank[y])
                best[y] = np.maximum(best[y], rank[x])
            hub = order[best]
            other = best > rank
            yield pa.RecordBatch.from_arrays([pa.array(c[other]) for c in (digest, digest[hub], most[hub])], ["x", "y", "most"])

    degrees = matched.groupBy("digest").agg(F.max("degree").alias("most"))
    ranked = matched.drop("degree").join(degrees, "digest").select(*POSTED, "most")
    return _by_cell(ranked).mapInArrow(find, "x bigint, y bigint, most bigint").distinct()


def _meet(matched: DataFrame, stars: DataFrame) -> DataFrame:
    """Pairs (x, y) of classes of different stars that may match, each once, stored."""

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells_in_order(batches):
            digest, star = rows["digest"].to_numpy(), rows["star"].to_numpy()
            for x, y, _, _ in _pairs_of(rows):
                apart = star[x] != star[y]
                a, b = digest[x[apart]], digest[y[apart]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["x", "y"])

    placed = matched.join(stars.select("digest", "star"), "digest").select(*POSTED, "star")
    return staged(_by_cell(placed).mapInArrow(meet, "x bigint, y bigint").distinct(), "candidates")


def _asked_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and the compressed text of all documents of ``wanted`` and few others, by a map of bounded size."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(PLACES))
    stretch, bit = (place / STRETCH).cast("int"), place % STRETCH
    bits = np.zeros((PLACES // STRETCH, STRETCH // 8), np.uint8)
    for r in wanted.groupBy(stretch.alias("stretch")).agg(F.bitmap_construct_agg(bit).alias("bits")).collect():
        bits[r["stretch"]] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits.reshape(-1))  # PLACES bits

    def shrink(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            place = batch["place"].to_numpy()
            batch = batch.filter(pa.array((shared.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))
            texts = pa.array((small(t.as_buffer()) for t in batch["text"]), pa.large_binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], texts], ["doc_id", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", place.alias("place")).mapInArrow(shrink, f"doc_id {kind}, text binary")


def _words_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """digest and the different words, as the hashes that digests are made of, of one line of each digest; texts travel compressed, stored."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                digests, found = [], []
                for text, asked in zip(part["text"], part["asked"]):
                    lines = grow(text.as_py()).decode().split("\n")
                    for a in asked.as_py():
                        if a["line"] < len(lines):
                            digests.append(a["digest"])
                            found.append(lines[a["line"]])
                row, _, size, hashes, line = line_words(pa.array(found, pa.large_string()), MIN_WORDS)
                # Rows with one key may have different texts: only the line that was meant.
                own = _digests(hashes, size)
                meant = own == np.array(digests, np.int64)[row]
                ends = np.append(0, np.cumsum(size[meant])).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[meant[line]].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(own[meant]), words], ["digest", "words"])

    wanted = staged(wanted, "wanted")
    small = _asked_texts(docs, wanted)
    asked = wanted.groupBy("doc_id").agg(F.collect_set(F.struct("line", "digest")).alias("asked"))
    # The texts are many times the lines asked for; a merge join takes either at any size.
    found = small.join(asked.hint("merge"), "doc_id").select("text", "asked")
    found = found.mapInArrow(read, "digest bigint, words array<bigint>")
    return staged(found.dropDuplicates(["digest"]), "words")


def _with_words(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs (x, y) of classes with their words, and ``common`` and ``total``, the number of words of both and the sum of theirs."""
    for s in "xy":
        pairs = pairs.join(words.select(F.col("digest").alias(s), F.col("words").alias(f"words_{s}")), s)
    pairs = pairs.withColumn("common", F.size(F.array_intersect("words_x", "words_y")))
    return pairs.withColumn("total", F.size("words_x") + F.size("words_y"))


def _similar(pairs: DataFrame, times: int = 1) -> DataFrame:
    """Those of similar classes, or within ``times`` the distance that they may have."""
    return pairs.where((F.col("total") - 2 * F.col("common")) * APART <= F.col("total") * TOTAL * times)


def _moved(stars: DataFrame, way: str) -> DataFrame:
    """The stars with their edits told from another set of words, which differs from the one before by the words of ``way``."""
    edits = F.concat(F.array_except("edits", way), F.array_except(way, "edits"))
    return stars.withColumn("told", edits).select(
        "digest", "star", (F.col("excess") + (F.size("told") - F.size("edits")) * APART).alias("excess"), F.col("told").alias("edits"))


def _stars(matched: DataFrame, words: DataFrame) -> DataFrame:
    """digest, ``star``, ``excess`` and ``edits`` of each class with possible matches, stored.

    ``edits`` has a hash of each word that only the class or only the star's set of words has. The words that two classes of
    a star do not share are the edits that only one of them has, so they are similar if the sum of
    their excess is at most 2 * APART for each edit that both have.
    """
    tried = _similar(_with_words(_find_hubs(matched), words), 2)  # any distance will do, near ones have fewer edits
    edits = F.concat(F.array_except("words_x", "words_y"), F.array_except("words_y", "words_x"))
    excess = (F.col("total") - 2 * F.col("common")) * APART - F.size("words_x") * TOTAL
    tried = tried.select(F.col("x").alias("digest"), F.struct(
        "most", F.col("y").alias("star"), excess.cast("bigint").alias("excess"),
        edits.alias("edits")).alias("to"))
    best = tried.groupBy("digest").agg(F.max("to").alias("to"))
    alone = (F.size("words") * -TOTAL).cast("bigint")
    stars = staged(words.select("digest", alone.alias("alone")).join(best, "digest", "left").select(
        "digest", F.coalesce("to.star", "digest").alias("star"), F.coalesce("to.excess", "alone").alias("excess"),
        F.coalesce("to.edits", F.array().cast("array<bigint>")).alias("edits")), "hubs")
    for _ in range(HOPS):
        up = stars.where("star != digest").select(F.col("digest").alias("star"), F.col("star").alias("hub"), F.col("edits").alias("way"))
        hop = stars.join(up, "star", "left").withColumn("star", F.coalesce("hub", "star"))
        stars = staged(_moved(hop.withColumn("way", F.coalesce("way", F.array().cast("array<bigint>"))), "way"), "hubs")
    members = stars.groupBy("star").agg(F.count(F.lit(1)).alias("members")).where("members > 2")
    held = stars.select("star", F.explode("edits").alias("edit")).groupBy("star", "edit").agg(F.count(F.lit(1)).alias("held"))
    most = held.join(members, "star").where("2 * held > members").groupBy("star").agg(F.collect_list("edit").alias("way"))
    told = stars.join(most, "star", "left").withColumn("way", F.coalesce("way", F.array().cast("array<bigint>")))
    return staged(_moved(told, "way"), "stars")


def _sharing_edits(stars: DataFrame) -> DataFrame:
    """Pairs (x, y) of classes of one star that only the edits which both have make similar.

    A star of more than STAR_BLOCK such classes is dealt out in pairs of blocks.
    """

    def share(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches, together=TOGETHER // 10):
            cell, digest, excess, side = (rows[c].to_numpy() for c in ("cell", "digest", "excess", "side"))
            edits = rows["edits"].combine_chunks()
            row = np.repeat(np.arange(len(edits)), pc.list_value_length(edits).to_numpy())
            edit = edits.flatten().to_numpy()
            order = np.lexsort((row, edit, cell[row]))
            row, edit = row[order], edit[order]
            new = np.append(True, (edit[1:] != edit[:-1]) | (cell[row[1:]] != cell[row[:-1]]))
            rank = np.arange(len(row)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            at, back, found = np.flatnonzero(rank > 0), 1, [np.zeros(0, np.int64)]
            while len(at):
                u, v = row[at], row[at - back]
                ok = (excess[u] + excess[v] > 0) & ((side[u] == 0) | (side[u] != side[v]))
                found.append(u[ok] * len(cell) + v[ok])
                back += 1
                at = at[rank[at] >= back]
            pairs, both = np.unique(np.concatenate(found), return_counts=True)
            u, v = pairs // len(cell), pairs % len(cell)
            ok = excess[u] + excess[v] <= 2 * APART * both
            yield pa.RecordBatch.from_arrays([pa.array(digest[u[ok]]), pa.array(digest[v[ok]])], ["x", "y"])

    # Sums of two above 0 need one above 0.
    top = stars.groupBy("star").agg(F.max("excess").alias("top")).where("top > 0")
    far = staged(stars.join(top, "star").where("excess + top > 0 AND size(edits) > 0").drop("top"), "far")
    sizes = far.groupBy("star").agg(F.ceil(F.count(F.lit(1)) / STAR_BLOCK).cast("int").alias("blocks"))
    dealt = far.join(sizes, "star").withColumn("mine", F.pmod(F.xxhash64("digest"), "blocks").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    dealt = dealt.select(F.xxhash64("star", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
                         "digest", "excess", side.alias("side"), "edits")
    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(share, "x bigint, y bigint")


def _similar_classes(posted: DataFrame, lines: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stars, and the similar classes (x, y) that are of different stars or share edits, both stored.

    Classes not listed are a star each.
    """
    matched = _note_degrees(posted)
    ends = matched.select("digest").distinct()
    first = lines.join(ends, "digest", "left_semi").groupBy("digest").agg(F.min(F.struct("doc_id", "line")).alias("at"))
    words = _words_of(docs, first.select("at.doc_id", "at.line", "digest"))
    stars = _stars(matched, words)
    apart = _similar(_with_words(_meet(matched, stars), words)).select("x", "y")
    return stars, staged(apart.unionByName(_sharing_edits(stars)), "alike")


def _earlier_in_star(star: np.ndarray, place: np.ndarray, excess: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For rows sorted by star and place: the weight of the star's rows of lower place that are similar without shared edits."""
    n = len(star)
    if not n:
        return np.zeros(0, np.int64)
    new = np.append(True, star[1:] != star[:-1])
    fresh = new | np.append(True, place[1:] != place[:-1])
    starts, ends = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], n)
    start, tie = starts[np.cumsum(new) - 1], np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    total = np.append(0, np.cumsum(weight))
    out = total[tie] - total[start]
    top = np.maximum.reduceat(excess, starts)
    for s in np.flatnonzero((top > 0) & (ends - starts > 1)).tolist():
        a, b = starts[s], ends[s]
        mine = excess[a:b]
        for e in np.unique(mine[mine + top[s] > 0]).tolist():
            at = np.flatnonzero(mine == e)
            near = np.append(0, np.cumsum(np.where(mine + e <= 0, weight[a:b], 0)))
            out[a + at] = near[tie[a + at] - a]
    return out


def _earlier_in_ranges(per_range: DataFrame, group: str) -> DataFrame:
    """``before``: the lines of the group in all earlier ranges, for each row (group, range, m, here) that is here."""
    before = Window.partitionBy(group).orderBy("range").rangeBetween(Window.unboundedPreceding, -1)
    summed = per_range.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
    return summed.where("here").select(group, "range", "before")


def _place_lines(lines: DataFrame) -> DataFrame:
    """The lines with ``range``, a stretch of the order, and ``inside``, the earlier matches in it by excess, stored."""

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches, "star"):
            doc = rows["doc_id"].combine_chunks().dictionary_encode().indices.to_numpy()
            line, star = rows["line"].to_numpy(), rows["star"].to_numpy()
            at = np.cumsum(np.append(True, (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])))
            inside = _earlier_in_star(star, at, rows["excess"].to_numpy(), np.ones(len(rows), np.int64))
            yield from rows.append_column("inside", pa.array(inside)).combine_chunks().to_batches()

    ranges = lines.repartitionByRange("doc_id", "line").withColumn("range", F.spark_partition_id())
    ranges = ranges.select("doc_id", "line", "digest", "star", "excess", "range").sortWithinPartitions("star", "doc_id", "line")
    named = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema)
    return staged(ranges.mapInArrow(place, f"{named}, inside bigint"), "placed")


def _before_ranges(placed: DataFrame) -> DataFrame:
    """star, range, excess and ``before``, the matches by excess in all earlier ranges."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches, "star"):
            before = _earlier_in_star(*(rows[c].to_numpy() for c in ("star", "range", "excess", "m")))
            yield pa.RecordBatch.from_arrays(
                [*(rows[c].combine_chunks() for c in ("star", "range", "excess")), pa.array(before)], ["star", "range", "excess", "before"])

    counted = placed.groupBy("star", "range", "excess").agg(F.count(F.lit(1)).alias("m"))
    ordered = counted.repartition("star").sortWithinPartitions("star", "range")
    return ordered.mapInArrow(count, "star bigint, range int, excess bigint, before bigint")


def _count_links(lines: DataFrame, stars: DataFrame, alike: DataFrame) -> DataFrame:
    """doc_id, line and links, the number of earlier lines that it matches, of each line with any.

    Lines are dealt to ranges of the order. The lines of a star or class in earlier ranges are added up by
    range; lines meet only within a range, so a class of any size is counted in as many tasks as there are.
    """
    # Equal lines share all edits.
    equal = stars.where("excess > 0").select("digest", F.col("digest").alias("other"))
    near = staged(alike.select(F.col("x").alias("digest"), F.col("y").alias("other")).unionByName(
        alike.select(F.col("y").alias("digest"), F.col("x").alias("other"))).unionByName(equal), "near")
    several = lines.groupBy("digest").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("digest")
    linked = several.unionByName(stars.select("digest")).distinct().join(stars.drop("edits"), "digest", "left")
    linked = linked.select("digest", F.coalesce("star", "digest").alias("star"), F.coalesce("excess", F.lit(0)).alias("excess"))
    placed = _place_lines(lines.join(linked, "digest").distinct())
    m = F.count(F.lit(1)).alias("m")
    # Earlier lines of the same star.
    own = placed.join(_before_ranges(placed), ["star", "range", "excess"])
    own = own.select("doc_id", "line", "digest", (F.col("before") + F.col("inside")).alias("links"))
    # Earlier lines of the similar classes of other stars, or by shared edits.
    met = placed.join(near.select("digest").distinct(), "digest", "left_semi")
    per_range = staged(met.groupBy("digest", "range").agg(m), "per_range")
    theirs = per_range.select(F.col("digest").alias("other"), "range", "m")
    seen = near.join(theirs, "other").groupBy("digest", "range").agg(F.sum("m").alias("m"))
    mine = per_range.select("digest", "range", F.lit(0).cast("bigint").alias("m"), F.lit(True).alias("here"))
    steps = _earlier_in_ranges(seen.withColumn("here", F.lit(False)).unionByName(mine), "digest")
    points = near.join(per_range.select("digest", "range"), "digest").join(
        met.select(F.col("digest").alias("other"), "range", "doc_id", "line"), ["other", "range"])
    points = points.select("digest", "range", "doc_id", "line", F.lit(1).alias("point"))
    events = met.select("digest", "range", "doc_id", "line", F.lit(0).alias("point")).unionByName(points)
    running = Window.partitionBy("digest", "range").orderBy("doc_id", "line", "point").rowsBetween(Window.unboundedPreceding, 0)
    ranked = events.withColumn("inside", F.sum("point").over(running)).where("point = 0").join(steps, ["digest", "range"])
    others = ranked.select("doc_id", "line", "digest", (F.col("before") + F.col("inside")).alias("links"))
    counted = own.unionByName(others).groupBy("doc_id", "line", "digest").agg(F.sum("links").alias("links"))
    return staged(counted.where("links > 0").groupBy("doc_id", "line").agg(F.max("links").alias("links")), "removed")


def similar_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts with the numbers of their lines that take part, and the lines to remove (doc_id, line, links), stored.

    ``docs`` has doc_id and text; ``links`` counts all earlier lines that a line matches.
    """
    described = staged(describe_texts(docs), "lines")
    texts = described.where("numbers IS NOT NULL").drop("chunk", "seen")
    lines = _lines_of(texts)
    counts = _summed(described.where("chunk IS NOT NULL").select("chunk", "seen"))
    return texts, _count_links(lines, *_similar_classes(post_prefixes(docs, counts), lines, docs))


def _count_lines(texts: DataFrame) -> DataFrame:
    """doc_id and n_lines; of the texts of one key, lines of one number are one."""
    counted = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.size("numbers")).alias("n"))
    several = texts.join(counted.where("texts > 1").select("doc_id"), "doc_id", "left_semi")
    several = several.select("doc_id", F.explode("numbers").alias("line")).distinct()
    several = several.groupBy("doc_id").agg(F.count(F.lit(1)).alias("different"))
    return counted.join(several, "doc_id", "left").select("doc_id", F.coalesce("different", "n").alias("n_lines"))


def find_similar_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per key: doc_id, n_lines that take part, n_removed, removed_lines (from 0) and n_links.

    Null and empty texts have no lines; rows with one key are one document, whose lines are
    judged alike, as the same line is not an earlier one; rows without key take no part; an empty table gives no rows; other columns
    are not read.
    """
    df = narrow(docs, key, text).where("doc_id IS NOT NULL")
    texts, removed = similar_lines(df)
    gone = removed.distinct().groupBy("doc_id").agg(
        F.sort_array(F.collect_list("line")).alias("removed_lines"), F.sum("links").alias("n_links"))
    every = _count_lines(texts).join(gone, "doc_id", "left")
    empty = F.array().cast("array<int>")
    return every.select(
        "doc_id", "n_lines",
        F.coalesce(F.size("removed_lines"), F.lit(0)).alias("n_removed"),
        F.coalesce("removed_lines", empty).alias("removed_lines"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def remove_similar_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without the lines that have an earlier match; the rest of a text is unchanged."""
    _, removed = similar_lines(narrow(docs, key, text).where("doc_id IS NOT NULL"))
    gone = removed.select(F.col("doc_id").alias("_key"), "line").distinct().groupBy("_key").agg(
        F.collect_set("line").alias("_gone"))
    joined = docs.join(gone, docs[key] == gone["_key"], "left")
    kept = F.filter(F.split(docs[text], "\n"), lambda line, i: ~F.array_contains("_gone", i))
    cleaned = F.when(F.col("_gone").isNull(), docs[text]).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[cleaned.alias(c) if c == text else docs[c] for c in docs.columns])
