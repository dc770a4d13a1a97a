"""Five-word shingles of many texts at once, as 64-bit hashes.

Words are maximal runs of anything but ASCII white space. A text of fewer words than a shingle
has one shingle of them all; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
#: Characters of the texts that are worked on together, to bound a task's memory.
TOGETHER = 2_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x + _ODD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about TOGETHER characters; a longer text is alone."""
    sizes = np.nan_to_num(pc.binary_length(batch[column]).to_numpy(zero_copy_only=False)).astype(np.int64)
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > TOGETHER:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the row of each, in order."""
    listed = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    rows = pc.list_parent_indices(listed).to_numpy()
    coded = listed.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    real = np.fromiter((bool(w) for w in distinct), bool, len(distinct))[codes] if distinct else np.zeros(0, bool)
    return (table[codes[real]] if distinct else table), rows[real].astype(np.int64)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, with repetitions, and the row of each, by row."""
    hashes, rows = word_hashes(texts)
    if not len(hashes):
        return hashes, rows
    counts = np.bincount(rows, minlength=len(texts))
    ends = np.cumsum(counts)
    left = ends[rows] - np.arange(len(rows))  # words from this one to the end of its text
    first = np.arange(len(rows)) == (ends - counts)[rows]
    total = np.zeros(len(hashes), np.uint64)
    for k in range(WORDS):
        ahead = np.zeros(len(hashes), np.uint64)
        ahead[: len(hashes) - k] = hashes[k:]
        total = np.where(left > k, mix(total ^ ahead), total)
    whole = (left >= WORDS) | first
    return total[whole], rows[whole]


def numbered(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of each row sorted, with the number (from 0) of each among its equals."""
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    starts = np.flatnonzero(new)
    repeat = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))
    return hashes, rows, repeat
