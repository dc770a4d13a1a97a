"""Packing documents into sequences of a fixed number of tokens, with certified bounds.

Each partition of the pieces is packed best fit decreasing. Dual feasible functions, which map
lengths to numbers such that whatever fits into one sequence adds up to one at most, give a
lower bound for its number of sequences. A partition that meets its bound is done for good.
The others hand in the pieces of all their sequences that are not full; these are dealt out
anew, to fewer partitions, packed again and bounded again, as long as that saves sequences.
"""

from __future__ import annotations

import functools
import math
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.pieces import piece_starts
from wordloom.llm.shingles import slices
from wordloom.llm.tables import narrow
from wordloom.session import staged

#: Tokens of a sequence, the id that ends a document, pieces packed by one task, exchanges.
CAPACITY = 2048
END_ID = 0
PER_TASK = 200_000
ROUNDS = 4
KEPT_PIECES = 400_000
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(16)]

PIECES = "doc_id {key}, piece int, start bigint, length bigint, ids_crc32 bigint"


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, re.compile("|".join(map(re.escape, added)) or r"(?!)").search, {}


def _distinct_pieces(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different pieces of some texts, each piece by its number among them, and the pieces of each text."""
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.cumsum(sizes) - sizes
    start = piece_starts(points, at[sizes > 0])
    data = whole.encode()
    first = np.flatnonzero(start)
    if len(data) > len(points):
        width = 1 + sum((points >= least).astype(np.int8) for least in (0x80, 0x800, 0x10000))
        first = (np.cumsum(width, dtype=np.int64) - width)[first]
    offsets = np.append(first, len(data))
    pieces = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    passed = np.append(0, np.cumsum(start))
    return pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy(), passed[at + sizes] - passed[at]


def _encode_batch(path: str, texts: list[str]) -> list[bytes]:
    """The ids of each text; only pieces that this process has not met go to the tokenizer.

    Pieces are found, told apart and put together again for all texts at once; each different one is looked up once.
    Strings of added tokens are these tokens, as the file says; a text that holds one is encoded as a whole.
    """
    tokenizer, added, known = _tokenizer(path)
    wholes = {row: tokenizer.encode(text, add_special_tokens=False).ids for row, text in enumerate(texts) if added(text)}
    met, codes, sizes = _distinct_pieces(["" if row in wholes else text for row, text in enumerate(texts)])
    new = [p for p in met if p not in known]
    if len(known) + len(new) > KEPT_PIECES:
        kept = {p: known[p] for p in met if p in known}  # the frequent ones are among them
        known.clear()
        known.update(kept)
    encoded = tokenizer.encode_batch_fast(new, add_special_tokens=False)
    known.update(zip(new, [_PACKED[len(ids)](*ids) if len(ids) < 16 else struct.pack(f"<{len(ids)}I", *ids)
                           for ids in (e.ids for e in encoded)]))
    parts = list(map(known.__getitem__, met))
    length = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    ids, long = np.frombuffer(b"".join(parts), np.uint32), length[codes]
    end = np.append(0, np.cumsum(long))
    place = np.repeat((np.cumsum(length) - length)[codes] - end[:-1], long) + np.arange(end[-1])
    out, ends = ids[place].tobytes(), (4 * end[np.append(0, np.cumsum(sizes))]).tolist()
    found = [out[a:b] for a, b in zip(ends, ends[1:])]
    for row, ids in wholes.items():
        found[row] = struct.pack(f"<{len(ids)}I", *ids)
    return found


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, length, ids) of the pieces: all but the first hold ``capacity`` ids."""
    n = len(ids) // 4
    first = n % capacity or min(n, capacity)
    start, length = 0, first
    while start < n:
        yield start, length, ids[4 * start : 4 * (start + length)]
        start, length = start + length, capacity


def tokenized_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """The pieces of every row: its ids, then END_ID, cut where they exceed ``capacity``."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = END_ID.to_bytes(4, "little")
        for batch in (part for whole in batches for part in slices(whole)):
            rows, numbers = [], []
            for row, ids in enumerate(_encode_batch(path, batch["text"].to_pylist())):
                for number, (start, length, part) in enumerate(cut(ids + end, capacity)):
                    rows.append(row)
                    numbers.append((number, start, length, zlib.crc32(part)))
            columns = list(zip(*numbers)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int32())), pa.array(columns[0], pa.int32())]
                + [pa.array(c, pa.int64()) for c in columns[1:]],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    df = narrow(docs, key, text)
    return df.mapInArrow(encode, PIECES.format(key=df.schema["doc_id"].dataType.simpleString()))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, and the number of sequences.

    Open sequences are kept by the room they have left; the set of rooms is one integer, whose
    lowest bit from the length on is the best fit.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, count
            count += 1
        bins[i], offsets[i] = chosen, capacity - room
        if room > length:
            by_room[room - length].append(chosen)
            rooms |= 1 << (room - length)
    return bins, offsets, count


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The least number of sequences that dual feasible functions prove necessary.

    For each threshold t up to half the capacity, lengths above ``capacity - t`` count as one,
    those below t as nothing and the rest by their length; lengths rounded by k parts count as
    ``floor((k + 1) * length / capacity) / k`` unless that division is exact.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    number, total = np.cumsum(counts), np.cumsum(counts * sizes)
    best = -(-int(total[-1]) // capacity)
    for t in range(1, capacity // 2 + 1):
        large = int(number[-1] - number[capacity - t])
        middle = int(total[capacity - t] - total[t - 1])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 101):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, k * sizes, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def _pack(pieces: DataFrame, parts: int, salt: int, capacity: int) -> DataFrame:
    """Deal the pieces out and pack each part; ``gap`` is its sequences above the bound."""
    dealt = pieces.withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.lit(salt)), F.lit(parts))
    )

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy()
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        used = np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)
        return group.drop(columns="part").assign(
            sequence_id=(np.int64(salt) << 56) + (group["part"].to_numpy() << 32) + bins,
            offset=offsets, room=capacity - used[bins], gap=count - lower_bound(lengths, capacity),
        )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("part").applyInPandas(
        pack, f"{schema}, sequence_id bigint, offset bigint, room bigint, gap bigint"
    )


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, per_task: int = PER_TASK,
                rounds: int = ROUNDS) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``; ``pieces`` should be a stored table.

    Parts hold about ``per_task`` pieces whatever the size of the corpus. Repeated rows are
    pieces of their own; no pieces, no sequences.
    """
    extra = ("sequence_id", "offset", "room", "gap")
    parts = max(1, math.ceil(pieces.count() / per_task))
    now = staged(_pack(pieces, parts, 0, capacity), "packed")
    done = []
    for salt in range(1, rounds + 1):
        open_ = (F.col("gap") > 0) & (F.col("room") > 0)
        counted = now.where(open_).agg(
            F.count(F.lit(1)).alias("pieces"), F.count(F.when(F.col("offset") == 0, 1)).alias("sequences")
        ).first()
        if not counted["pieces"] or parts == 1:
            break
        parts = min(max(1, math.ceil(counted["pieces"] / per_task)), max(1, parts // 2))
        again = staged(_pack(now.where(open_).drop(*extra), parts, salt, capacity), "packed")
        if again.where("offset = 0").count() >= counted["sequences"]:
            break
        done.append(now.where(~open_))
        now = again
    return functools.reduce(DataFrame.unionByName, done, now).drop("room", "gap")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Every row's pieces, packed: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is END_ID alone. Rows with the same key are packed each on its own; an
    empty table gives no rows; other columns are not read. The tokenizer's file has to lie at
    ``path`` on every machine.
    """
    return pack_pieces(staged(tokenized_pieces(docs, path, capacity, key, text), "pieces"), capacity)
