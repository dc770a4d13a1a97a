"""Which texts stand inside other texts, without comparing all pairs.

A text that stands inside another one shares all its grams (runs of GRAM characters) with it, so it
is enough to look it up by one of them. Each asked text takes its rarest gram, by a table of counters
of fixed size; texts shorter than a gram are a gram of their own length. The other side posts all its
grams, less those that no asked text can have taken, and what meets is checked by ``contains``.

Who asks only whether and where first a text stands needs no pairs, which are many where texts share
their grams: ``first_holders`` finds the asked texts as wholes, in time that grows with the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from wordloom.session import staged

GRAM = 8
#: Counters of how many texts hold a gram; grams that share one count together, which costs only time.
COUNTERS = 1 << 16
#: Cells that tell grams nobody asks for; bounds the list that is sent to all tasks.
CELLS = 1 << 20
#: Bits in the map of the asked texts of a size, four of which a text marks: as many a text, between 32 KB and 16 MB.
MARKS_PER_TEXT, MIN_BITS, MAX_BITS = 128, 18, 27
#: Bytes that are hashed at a time.
STRETCH = 1 << 20
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
#: Two ways to find the cell of a head and two for that of a whole text.
HEAD = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
WHOLE = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
BYTE_VALUES = np.random.default_rng(1).integers(0, 1 << 64, 256, dtype=np.uint64)


def text_grams(text: Column, size: int) -> Column:
    """Hashes of the different runs of ``size`` characters of a text."""
    runs = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
    return F.transform(F.array_distinct(runs), lambda g: F.xxhash64(g))


def _posted(holders: DataFrame, size: int) -> DataFrame:
    return holders.where(F.char_length("text") >= size).select("holder", F.explode(text_grams(F.col("text"), size)).alias("gram"))


def _cell(gram: str, cells: int) -> Column:
    return F.pmod(F.col(gram), F.lit(cells)).cast("int")


def _rarest(asked: DataFrame, holders: DataFrame) -> DataFrame:
    """``asked, gram``: of each text of at least a gram, the gram that the fewest holders have."""
    counters = staged(_posted(holders, GRAM).groupBy(_cell("gram", COUNTERS).alias("cell")).agg(F.count(F.lit(1)).alias("n")), "counters")
    grams = asked.where(F.char_length("text") >= GRAM).select("asked", F.explode(text_grams(F.col("text"), GRAM)).alias("gram"))
    known = grams.withColumn("cell", _cell("gram", COUNTERS)).join(F.broadcast(counters), "cell")
    best = known.groupBy("asked").agg(F.min(F.struct("n", "gram")).alias("best"), F.count(F.lit(1)).alias("grams"))
    # A gram without a counter stands in no holder, nor does the text then.
    whole = grams.groupBy("asked").agg(F.count(F.lit(1)).alias("grams"))
    return best.join(whole, ["asked", "grams"]).select("asked", F.col("best.gram").alias("gram"))


def contained(asked: DataFrame, holders: DataFrame) -> DataFrame:
    """``asked, holder`` for each asked text and each holder whose text contains it; other columns of theirs come along.

    ``asked``: ``asked, text``; ``holders``: ``holder, text``; keys are unique and not null. Null texts neither
    contain nor stand anywhere; the empty text stands in all, which is a fact and no list of pairs, so it is left to the caller.
    """
    asked = asked.where(F.char_length("text") > 0)
    wanted = _rarest(asked, holders).withColumn("size", F.lit(GRAM))
    short = asked.where(F.char_length("text") < GRAM).select("asked", F.xxhash64("text").alias("gram"), F.char_length("text").alias("size"))
    wanted = staged(wanted.unionByName(short), "wanted")
    found = None
    for (size,) in wanted.select("size").distinct().orderBy("size").collect():  # eight at most
        mine = wanted.where(F.col("size") == size).select("asked", "gram")
        cells = mine.select(_cell("gram", CELLS).alias("cell")).distinct()
        posted = _posted(holders, size).withColumn("cell", _cell("gram", CELLS)).join(F.broadcast(cells), "cell", "left_semi")
        part = posted.join(mine, "gram").select("asked", "holder")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = asked.select("asked").join(holders.select("holder").limit(0), F.lit(True))
    near = found.join(asked.withColumnRenamed("text", "_asked"), "asked").join(holders, "holder")
    return near.where(F.contains("text", "_asked")).drop("text", "_asked")


def _window_sums(data: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Running sums whose differences are the hashes of all windows of the bytes, times a power of their place."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers[: len(data)], out=sums[1:])
    return sums


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers)


def _cells_of(windows: np.ndarray, way: np.uint64, bits: int | np.ndarray) -> np.ndarray:
    return (windows * way) >> np.asarray(64 - bits, np.uint64)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts of a batch, and where each text starts; the end comes last."""
    text = batch.column("text").cast(pa.large_binary())
    _, places, content = text.buffers()
    if not len(text) or content is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return np.frombuffer(content, np.uint8), np.frombuffer(places, np.int64)[text.offset: text.offset + len(text) + 1]


def _head(length: int) -> int:
    """The power of two of bytes by which a text of that many bytes is looked up first."""
    return 1 << (length.bit_length() - 1)


def _asked_cells(batches: Iterator[pa.RecordBatch], bits: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """``size, cell`` of each asked text, by its head and as a whole."""
    of_size = np.array([bits.get(1 << k, MIN_BITS) for k in range(32)])
    for batch in batches:
        data, starts = _flat(batch)
        first = 0
        while first < len(starts) - 1:
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + STRETCH, side="right")) - 1)
            part, at, length = data[starts[first]: starts[last]], starts[first:last] - starts[first], np.diff(starts[first: last + 1])
            sums, inverse = _window_sums(part, _powers(BASE, len(part))), _powers(UNBASE, len(part))[at]
            order = np.log2(length).astype(np.int64)
            size = 1 << order
            cells = [_cells_of((sums[at + n] - sums[at]) * inverse, way, of_size[order]) for n, ways in ((size, HEAD), (length, WHOLE)) for way in ways]
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(size, len(cells))), pa.array(np.concatenate(cells).view(np.int64))], ["size", "cell"])
            first = last


def _occurrences(batches: Iterator[pa.RecordBatch], lengths: dict[int, list[int]], marks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Stretches of the texts that fall in the cells of asked ones, once a batch with their lowest ``held``."""
    longest = max(max(sizes) for sizes in lengths.values())
    step = max(STRETCH, longest)
    powers, inverse = _powers(BASE, step + longest), _powers(UNBASE, step + longest)

    def marked(windows: np.ndarray, ways: tuple, size: int) -> np.ndarray:
        """Places of the windows whose cells are all marked."""
        left, bits = None, (len(marks[size]) * 8).bit_length() - 1
        for way in ways:
            cells = _cells_of(windows if left is None else windows[left], way, bits)
            bit = (marks[size][(cells >> np.uint64(3)).view(np.int64)] >> (cells & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
            here = np.flatnonzero(bit)
            left = here if left is None else left[here]
        return left

    for batch in batches:
        data, starts = _flat(batch)
        rank = pc.rank(batch.column("held"), "ascending", null_placement="at_start").to_numpy()
        first: dict[bytes, int] = {}
        for begin in range(int(starts[0]), int(starts[-1]), step):
            part = data[begin: min(begin + step + longest - 1, int(starts[-1]))]
            sums = _window_sums(part, powers)
            for size, sizes in lengths.items():
                n = min(step, len(part) - size + 1)
                if n <= 0:
                    continue
                heads = (sums[size: size + n] - sums[:n]) * inverse[:n]
                at = marked(heads, HEAD, size)
                row = np.searchsorted(starts, begin + at, side="right") - 1
                room = starts[row + 1] - (begin + at)
                for length in sizes:
                    fits = np.flatnonzero(room >= length)
                    here = at[fits]
                    whole = (sums[here + length] - sums[here]) * inverse[here]
                    for i in fits[marked(whole, WHOLE, size)].tolist():
                        found, holder = part[at[i]: at[i] + length].tobytes(), int(row[i])
                        known = first.get(found)
                        if known is None or rank[holder] < rank[known]:
                            first[found] = holder
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(first), pa.binary()), batch.column("held").take(pa.array(list(first.values()), pa.int64()))], ["text", "held"])


def first_holders(asked: DataFrame, holders: DataFrame) -> DataFrame:
    """``text, first`` for each asked text that stands inside a holder: a struct of the lowest ``held``, null before all.

    ``asked``: ``text``; ``holders``: ``text, held``. Null and empty texts are left out on both sides. No pairs are made:
    the holders are read once, and what they post are the asked texts themselves, once a batch, to be counted together.
    Where they may stand is told by hashes of all their windows, of sizes that are powers of two and then of the lengths
    asked for, against bit maps of bounded size; what falls in by chance equals no asked text and goes out in the join.
    """
    filled = lambda df, *keep: df.where(F.octet_length("text") > 0).select(F.col("text").cast("binary").alias("text"), *keep)
    texts = staged(filled(asked).distinct(), "asked")
    held = holders.schema["held"].dataType
    lengths: dict[int, list[int]] = {}
    counts: dict[int, int] = {}
    for length, n in texts.groupBy(F.octet_length("text").alias("length")).agg(F.count(F.lit(1))).orderBy("length").collect():
        lengths.setdefault(_head(length), []).append(length)
        counts[_head(length)] = counts.get(_head(length), 0) + n
    if not lengths:
        return texts.select("text", F.struct(F.lit(None).cast(held).alias("held")).alias("first"))
    bits = {size: min(max((MARKS_PER_TEXT * n - 1).bit_length(), MIN_BITS), MAX_BITS) for size, n in counts.items()}
    cells = texts.mapInArrow(lambda batches: _asked_cells(batches, bits), "size bigint, cell bigint").select("size", (F.col("cell") + 1).alias("cell"))
    maps = cells.groupBy("size", F.bitmap_bucket_number("cell").alias("no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("map"))
    marks = {size: np.zeros(1 << (n - 3), np.uint8) for size, n in bits.items()}
    for size, no, part in maps.collect():  # MAX_BITS a size
        marks[size][(no - 1) * len(part): no * len(part)] = np.frombuffer(part, np.uint8)
    schema = StructType([StructField("text", BinaryType()), StructField("held", held)])
    posted = filled(holders, "held").mapInArrow(lambda batches: _occurrences(batches, lengths, marks), schema)
    return staged(posted.groupBy("text").agg(F.min(F.struct("held")).alias("first")).join(texts, "text"), "first")
