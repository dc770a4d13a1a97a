"""Bags of words and TF-IDF weights."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from wordloom.functions.phrases import WIDE_SPACE

WORD_OF_TWO = r"[\p{L}\p{N}_]{2,}"
BROADCAST_FEATURES = 100_000
#: Words that are counted at a time.
SLICE = 1 << 20


def binary_terms(docs: DataFrame, key: str, text: str, *keep: str) -> DataFrame:
    """Each lower-case white-space token once per document, with weight 1."""
    tokens = F.filter(F.split(F.lower(F.col(text)), f"[{WIDE_SPACE}]+"), lambda t: t != "")
    return docs.select(key, *keep, F.explode(F.array_distinct(tokens)).alias("term")).withColumn(
        "x", F.lit(1.0)
    )


def counted_terms(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """``term, tf`` for each different term of a text, counted inside the row.

    Terms are the words of two or more characters and the pairs of neighbours. Equal terms are
    neighbours once the terms are sorted, so a term's count is the distance to the next other one.
    Words, sorted terms and starts are columns of their own: a lambda that held the expressions
    behind them would run these again for every element.
    """
    words = docs.select(
        *keep, F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_OF_TWO), F.lit(0)).alias("_words"))
    pairs = F.zip_with("_words", F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))),
                       lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    terms = words.select(*keep, F.sort_array(F.array_compact(F.concat("_words", pairs))).alias("_terms"))
    new = F.transform(
        "_terms", lambda t, i: F.when(F.coalesce(F.get("_terms", i - 1) != t, F.lit(True)), i))
    starts = terms.select(*keep, "_terms", F.array_compact(new).alias("_starts"))
    counted = F.transform("_starts", lambda at, k: F.struct(
        F.get("_terms", at).alias("term"),
        (F.coalesce(F.get("_starts", k + 1), F.size("_terms")) - at).alias("tf"),
    ))
    return starts.select(*keep, F.explode(counted).alias("t")).select(*keep, "t.term", "t.tf")


def word_lists(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """The lower-case words of two or more characters of each text, in order, as ``words``."""
    return docs.select(*keep, F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_OF_TWO), F.lit(0)).alias("words"))


@dataclass(frozen=True)
class CodedWords:
    """Words of some texts as numbers of their entry in ``words``, each with its text's place in the batch."""

    words: pa.Array
    codes: np.ndarray
    rows: np.ndarray

    @property
    def paired(self) -> np.ndarray:
        """Places of the words that have a neighbour behind them in their text."""
        return np.flatnonzero(self.rows[1:] == self.rows[:-1])


def _coded(batch: pa.RecordBatch) -> Iterator[CodedWords]:
    """The word lists of a batch, some SLICE words at a time and no text in two parts."""
    lists = batch.column("words")
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE, side="right")) - 1)
        flat = lists.slice(first, last - first).flatten().dictionary_encode()
        if len(flat):
            yield CodedWords(flat.dictionary, flat.indices.to_numpy().astype(np.int64), np.repeat(np.arange(first, last), sizes[first:last]))
        first = last


def _tally(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different codes, how often each is there, and in how many texts. ``rows`` do not fall."""
    order = np.argsort(codes, kind="stable")
    code, row = codes[order], rows[order]
    other = np.ones(len(code), bool)
    other[1:] = code[1:] != code[:-1]
    text = other.copy()
    text[1:] |= row[1:] != row[:-1]
    starts = np.flatnonzero(other)
    return code[starts], np.diff(np.append(starts, len(code))), np.add.reduceat(text.astype(np.int64), starts) if len(starts) else starts


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``term, n, df`` of words and of pairs of neighbours, once a slice."""
    for batch in batches:
        for coded in _coded(batch):
            code, n, df = _tally(coded.codes, coded.rows)
            yield pa.RecordBatch.from_arrays([coded.words.take(pa.array(code)), pa.array(n), pa.array(df)], ["term", "n", "df"])
            at, size = coded.paired, len(coded.words)
            pair, n, df = _tally(coded.codes[at] * size + coded.codes[at + 1], coded.rows[at])
            terms = pc.binary_join_element_wise(coded.words.take(pa.array(pair // size)), coded.words.take(pa.array(pair % size)), " ")
            yield pa.RecordBatch.from_arrays([terms, pa.array(n), pa.array(df)], ["term", "n", "df"])


def _weigh(batches: Iterator[pa.RecordBatch], terms: list[str], idf: list[float]) -> Iterator[pa.RecordBatch]:
    """The columns of each text with each of its ``terms`` and its weight ``x``."""
    idf, known = np.array(idf), pa.array(terms, pa.string())
    pairs = [(i, *term.split(" ")) for i, term in enumerate(terms) if " " in term]
    parts = pa.array(sorted({word for _, *words in pairs for word in words}), pa.string())
    place = {word: i for i, word in enumerate(parts.to_pylist())}
    size = len(parts)
    listed = sorted((place[a] * size + place[b], i) for i, a, b in pairs)
    pair_codes, pair_terms = (np.array([row[i] for row in listed], np.int64) for i in (0, 1))

    def numbers(words: pa.Array, among: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, among), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    for batch in batches:
        rest = [c for c in batch.schema.names if c != "words"]
        for coded in _coded(batch):
            term, row = numbers(coded.words, known)[coded.codes], coded.rows
            if size:
                part, at = numbers(coded.words, parts)[coded.codes], coded.paired
                at = at[(part[at] >= 0) & (part[at + 1] >= 0)]
                pair = part[at] * size + part[at + 1]
                found = np.minimum(np.searchsorted(pair_codes, pair), len(pair_codes) - 1)
                same = pair_codes[found] == pair
                term, row = np.concatenate([term, pair_terms[found[same]]]), np.concatenate([row, row[at[same]]])
            here = term >= 0
            cell, tf = np.unique(row[here] * len(terms) + term[here], return_counts=True)
            if not len(cell):
                continue
            row, term = np.divmod(cell, len(terms))
            weight = tf * idf[term]
            starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            norm = np.repeat(np.sqrt(np.add.reduceat(weight * weight, starts)), np.diff(np.append(starts, len(row))))
            columns = [batch.column(c).take(pa.array(row)) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, known.take(pa.array(term)), pa.array(weight / norm)], [*rest, "term", "x"])


@dataclass(frozen=True)
class TfIdf:
    """``features``: ``term, idf``; at most ``size`` rows, which BROADCAST_FEATURES bounds."""

    features: DataFrame
    size: int

    def __post_init__(self) -> None:
        if self.size > BROADCAST_FEATURES:
            raise ValueError(f"at most {BROADCAST_FEATURES} features")

    def weights(self, docs: DataFrame, key: str, text: str, *keep: str) -> DataFrame:
        """Weight of each known term per document (a row with its own key), of length 1 per document.

        The features go to the tasks, where a text's terms are met, counted and weighed; nothing is shuffled.
        """
        known = self.features.collect()  # BROADCAST_FEATURES at most
        terms, idf = [r["term"] for r in known], [r["idf"] for r in known]
        words = word_lists(docs, text, key, *keep)
        schema = StructType([*(words.schema[c] for c in (key, *keep)), StructField("term", StringType()), StructField("x", DoubleType())])
        return words.mapInArrow(lambda batches: _weigh(batches, terms, idf), schema)


def fit_tfidf(docs: DataFrame, text: str, max_features: int = 5000) -> TfIdf:
    """The most frequent terms of the corpus and their smoothed inverse document frequency.

    Terms are the words of two or more characters and the pairs of neighbours. Tasks count them by the slice;
    one aggregate gives both how often a term occurs and how many documents hold it. Equal
    counts are cut in alphabetical order.
    """
    found = word_lists(docs, text).mapInArrow(_count_terms, "term string, n bigint, df bigint")
    counted = found.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    chosen = counted.orderBy(F.desc("n"), "term").limit(max_features)
    n = docs.agg(F.count(F.lit(1))).scalar()
    idf = F.ln((1 + n) / (1 + F.col("df"))) + 1
    return TfIdf(chosen.select("term", idf.alias("idf")), max_features)
