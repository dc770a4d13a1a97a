"""The different words of each line of many texts at once, as 64-bit hashes.

Lines end at ``\\n``; words are maximal runs of anything but ASCII white space. Words are hashed
where they lie in the texts' bytes, eight bytes at a time; those over LONG bytes by the difference of two
running sums of their bytes times the powers of an odd number, moved to the start of the word.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from wordloom.llm.shingles import mix

#: Bytes that are hashed together, to bound a task's memory.
SPAN = 1 << 20
#: Bytes of the longest word that is hashed by eights.
LONG = 64
_BASE = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(256, dtype=np.uint64))
#: For a word of n bytes: those of its last eight that count, and its first term.
_KEPT = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_LENGTHS = mix(mix(np.arange(LONG + 1, dtype=np.uint64)))


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers))
    return out[0], out[1]


def _hash_long(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes; stretches are in order and do not overlap."""
    out = np.zeros(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + SPAN, side="right")))
        first, last = start[a], end[b - 1]
        up, down = _powers(max(SPAN, int(last - first)))
        total = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_BYTES[data[first:last]] * up[: last - first], out=total[1:])
        s = start[a:b] - first
        out[a:b] = mix((total[end[a:b] - first] - total[s]) * down[s])
        a = b
    return out


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes; stretches are in order and do not overlap."""
    size = end - start
    padded = np.append(data, np.zeros(8, np.uint8))
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # those that start at each byte
    out = mix((eights[start] & _KEPT[np.minimum(size, 8)]) + _LENGTHS[np.minimum(size, LONG)])
    more = np.flatnonzero((size > 8) & (size <= LONG))
    done = 8
    while len(more):
        left = np.minimum(size[more] - done, 8)
        out[more] = mix(out[more] ^ mix(eights[start[more] + done] & _KEPT[left]))
        done += 8
        more = more[size[more] > done]
    long = np.flatnonzero(size > LONG)
    out[long] = _hash_long(data, start[long], end[long])
    return out


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each starts (and the last ends)."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return whole, at - at[0]


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends; words do not go on from one text into the next."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = (data != 32) & ((data - np.uint8(9)) > 4)  # 9 to 13, as smaller bytes turn to large ones
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    inner = np.unique(at)
    joined = inner[solid[inner] & solid[inner + 1]]
    if len(joined):
        edges = np.insert(edges, np.repeat(np.searchsorted(edges, joined), 2), np.repeat(joined, 2))
    return edges[::2], edges[1::2]


def line_words(texts: pa.Array, least: int, held: np.ndarray | None = None):
    """(row, number, size) of each line of ``least`` or more words, and (hash, line) of its different words.

    ``number`` counts the lines of a row from 0, ``size`` the different words. The words of a line
    come by hash; with ``held`` (how many lines have a word, in cells by hash) the rarest come first.
    """
    if not len(texts):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), none
    data, at = _bytes_of(texts)
    start, end = _words(data, at)
    breaks = np.flatnonzero(data == 10)
    row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(breaks, at)) + 1)
    number = np.arange(len(row)) - np.searchsorted(row, row)
    line_start = np.empty(len(row), np.int64)
    line_start[number == 0], line_start[number > 0] = at[:-1], breaks + 1
    words = np.diff(np.append(np.searchsorted(start, line_start), len(start)))
    long_enough = words >= least
    mine = np.repeat(long_enough, words)
    start, end, line = start[mine], end[mine], np.repeat(np.arange(long_enough.sum()), words[long_enough])
    row, number = row[long_enough], number[long_enough]
    coded = pa.array(hash_spans(data, start, end)).dictionary_encode()
    table, codes = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(table)
    if held is not None:
        order = order[np.argsort(held[(table[order] % np.uint64(len(held))).astype(np.int64)], kind="stable")]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    table, codes = table[order], rank[codes]
    bits = max(len(table), 1).bit_length()
    key = np.sort((line << bits) | codes)  # faster here than np.unique
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    line = key >> bits
    return row, number, np.bincount(line, minlength=len(row)), table[key & ((1 << bits) - 1)], line
