"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is exactly one token that its encoding ends with. A token
may end a prefix when it follows the last token of the shorter prefix without a merge
across their border, so the table of last tokens is filled from left to right and the
encoding is read off backwards. Appending bytes leaves the table of the old prefix as it is,
and after an edit only the prefixes from the edit on are filled again, until as many of
them as the longest token has bytes come out as before.

Two tokens may stand side by side when no merge across the border comes before the merges
that formed them. Undoing the latest merge at the border again and again shows all the
pairs that ever met there.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.pieces import splitter
from wordloom.llm.tables import narrow

#: Entries that a process keeps of each kind; older ones are worked out again when needed.
KEPT_PIECES = 400_000
KEPT_PAIRS = 500_000
_LATER = 1 << 40


class PrefixEncoder:
    """Encodes one piece of bytes by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        self._pairs: dict[tuple[bytes, bytes], bool] = {}
        self._parts: dict[bytes, tuple[bytes, bytes] | None] = {}

    def parts(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge formed this one; none for a single byte."""
        if token not in self._parts:
            found = None
            if len(token) > 1:
                rank = self.ranks[token]
                pieces = [token[i : i + 1] for i in range(len(token))]
                while len(pieces) > 2:
                    at = min(range(len(pieces) - 1), key=lambda i: self._merged(pieces, i, rank))
                    if self._merged(pieces, at, rank) == _LATER:
                        break
                    pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
                found = (pieces[0], pieces[1]) if len(pieces) == 2 else None
            self._parts[token] = found
        return self._parts[token]

    def _merged(self, pieces: list[bytes], i: int, below: int) -> int:
        rank = self.ranks.get(pieces[i] + pieces[i + 1], _LATER)
        return rank if rank < below else _LATER

    def adjoins(self, left: bytes, right: bytes) -> bool:
        """Whether the encoding of ``left + right`` is these two tokens."""
        try:
            return self._pairs[left, right]
        except KeyError:
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            known = self._pairs[left, right] = self._stays_apart(left, right)
            return known

    def _stays_apart(self, a: bytes, b: bytes) -> bool:
        ranks = self.ranks
        taken_a = taken_b = _LATER  # when the part at the border becomes part of a longer one
        while True:
            across = ranks.get(a + b, _LATER)
            # Of equal merges the left one comes first.
            if across < taken_a and across <= taken_b and across < _LATER:
                return False
            parts_a, parts_b = self.parts(a), self.parts(b)
            if parts_a and (not parts_b or ranks[a] > ranks[b]):
                taken_a, a = ranks[a], parts_a[1]
            elif parts_b:
                taken_b, b = ranks[b], parts_b[0]
            else:
                return True

    def fill(self, piece: bytes, last: list[bytes], old: list[bytes] = ()) -> list[bytes]:
        """Extend ``last``, the last tokens of the prefixes 0, 1, ..., to all prefixes of the piece.

        ``old`` has what the prefixes after these were before an edit, aligned at the end; it is
        taken over as soon as a whole longest token's worth of entries agrees.
        """
        ranks, adjoins, size, agreed = self.ranks, self.adjoins, len(piece), 0
        shift = len(old) - (size + 1)
        for end in range(len(last), size + 1):
            # One token alone can end the prefix, so the short ones, which are likelier, go first.
            for begin in range(end - 1, max(-1, end - self.longest - 1), -1):
                token = piece[begin:end]
                if token in ranks and (not begin or adjoins(last[begin], token)):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            if old:
                same = 0 <= end + shift < len(old) and old[end + shift] == last[end]
                agreed = agreed + 1 if same else 0
                if agreed >= self.longest:
                    last.extend(old[end + shift + 1 :])
                    break
        return last

    def read(self, last: list[bytes]) -> list[int]:
        """The ids of the whole piece from the table of last tokens."""
        out, end = [], len(last) - 1
        while end:
            out.append(self.ranks[last[end]])
            end -= len(last[end])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        """The ids of a piece; a piece that is a token itself is that token."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.read(self.fill(piece, [b""]))


class EditablePiece:
    """A piece of bytes with its table, for appends and edits without encoding it anew."""

    def __init__(self, encoder: PrefixEncoder, piece: bytes = b""):
        self.encoder, self.piece = encoder, b""
        self.last: list[bytes] = [b""]
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.encoder.fill(self.piece, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put ``new`` in place of the bytes from ``start`` to ``stop``."""
        old = self.last
        self.piece = self.piece[:start] + new + self.piece[stop:]
        # What lies before the end of the new bytes is not compared with the old table.
        kept = self.encoder.fill(self.piece[: start + len(new)], old[: start + 1])
        self.last = self.encoder.fill(self.piece, kept, old)

    def ids(self) -> list[int]:
        whole = self.encoder.ranks.get(self.piece)
        return [whole] if whole is not None else self.encoder.read(self.last)


class _Packed(dict):
    """Pieces of text and their ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT_PIECES:
            self.clear()
        ids = self.encoder.encode(piece.encode())
        packed = self[piece] = b"".join(i.to_bytes(4, "little") for i in ids)
        return packed


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks by bytes, from a file with a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.lru_cache(maxsize=4)
def _packed(path: str) -> _Packed:
    return _Packed(PrefixEncoder(load_ranks(path)))


@functools.lru_cache(maxsize=4)
def _spelling(path: str) -> dict[bytes, bytes]:
    return {i.to_bytes(4, "little"): token for token, i in load_ranks(path).items()}


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (binary, little-endian unsigned 32-bit integers) of each row.

    A null or empty text has no ids; repeated rows are encoded alike and each stays a row; an
    empty table gives none; other columns are not read. Texts are encoded whole, row by row.
    The vocabulary file has to lie at ``path`` on every machine.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, packed = splitter(), _packed(path)
        for batch in batches:
            ids = pa.array((b"".join(map(packed.__getitem__, split(t.as_py()))) for t in batch["text"]), pa.large_binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])

    df = narrow(docs, key, text)
    return df.mapInArrow(encode, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode_texts`` with the bytes that their ``ids`` spell, as ``decoded``."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = _spelling(path)
        for batch in batches:
            texts = []
            for value in batch["ids"]:
                ids = value.as_py()
                texts.append(b"".join([spelling[ids[i : i + 4]] for i in range(0, len(ids), 4)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.large_binary())],
                                             [*batch.schema.names, "decoded"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decode, f"{schema}, decoded binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens and digests of the ids and of what they decode to, for each document."""
    both = decode_ids(encode_texts(docs, path), path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
