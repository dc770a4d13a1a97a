"""Word and sentence tagging: by table join, or by a Python model over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from wordloom.functions.phrases import short_description
from wordloom.operators import textprep as tp
from wordloom.operators.skew import hot_join
from wordloom.session import staged

Tagger = Callable[[pd.DataFrame], pd.DataFrame]

#: Words, and bytes of words and labels, up to which a table of labels is handed to every task.
TASK_WORDS, TASK_BYTES = 1 << 17, 4 << 20
#: Bytes of texts that are read together, to bound a task's memory.
STRETCH = 1 << 21
#: Letters and hyphens as lower case, all other bytes 0.
_LOWER = np.zeros(256, np.uint8)
_LOWER[45] = 45
_LOWER[97:123] = _LOWER[65:91] = np.arange(97, 123)
_ENDS = np.zeros(256, bool)
_ENDS[[33, 46, 63]] = True  # ! . ?


def tag_words(words: DataFrame, make_tagger: Callable[[], Tagger], schema: str) -> DataFrame:
    """Run a model over the words.

    ``make_tagger`` builds the model once per task; the tagger it returns maps a batch
    of rows to a batch of rows of ``schema``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = make_tagger()
        for batch in batches:
            yield tagger(batch)

    return words.mapInPandas(run, schema)


def tag_by_table(words: DataFrame, tags: DataFrame) -> DataFrame:
    """Tags from a table; words it lacks get nulls."""
    return words.join(tags, "word", "left")


def describe_tags(tags: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Tag codes to the first part of their description."""
    short = descriptions.select("tag", short_description(F.col("description")).alias("POS"))
    return tags.join(short, "tag", "left")


def vote_per_sentence(tokens: DataFrame, table: DataFrame, keys: Sequence[str],
                      sentences: DataFrame, default: str = "neutral") -> DataFrame:
    """Label of each sentence by the votes of its words; no vote gives ``default``.

    Ties go to the alphabetically first label. Words that many tokens are are spread over
    several tasks when they meet their label.
    """
    counted = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("hits"))
    voters = staged(counted.join(table.select("word", "label"), "word"), "voters")
    votes = hot_join(tokens, voters, "word", "hits", keys[0]).groupBy(*keys, "label").agg(
        F.count(F.lit(1)).alias("n")
    )
    best = votes.groupBy(*keys).agg(
        F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("label")
    )
    return sentences.select(*keys).join(best, list(keys), "left").withColumn(
        "label", F.lower(F.coalesce("label", F.lit(default)))
    )


def _stretches(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first, data, at): the first of some texts, their bytes one after another, and where each starts (and the last ends)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + STRETCH, side="right")) - 1)
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def _sentences(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, position) of each sentence with letters or hyphens, and (sentence, word) of its words, as ``textprep`` has them."""
    plain = _LOWER[data]
    solid = plain > 0
    fresh = np.zeros(len(data) + 1, bool)  # a text starts here, or all end
    fresh[at] = True
    before = np.append(False, solid[:-1])[: len(data)] & ~fresh[:-1]
    after = np.append(solid[1:], False)[: len(data)] & ~fresh[1:]
    start, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    ended = np.append(False, _ENDS[data[:-1]])[: len(data)] & ~fresh[:-1]
    breaks = np.flatnonzero((data == 32) & ended)
    row = np.searchsorted(at, start, side="right") - 1
    passed = np.searchsorted(breaks, start)
    position = passed - np.searchsorted(breaks, at)[row]
    new = np.append(True, (row[1:] != row[:-1]) | (passed[1:] != passed[:-1]))[: len(row)]
    sentence = np.cumsum(new) - 1
    row, position = row[new], position[new]
    start, end = start + (plain[start] == 45), end - (plain[end - 1] == 45)
    word = end - start > 1
    start, end, sentence = start[word], end[word], sentence[word]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1  # a word may end where one of the next text starts
    letters = plain[np.cumsum(edge[:-1], dtype=np.int8) > 0]
    offsets = np.append(0, np.cumsum(end - start))
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters))
    return row, position, sentence, words


def _elect(sentence: np.ndarray, label: np.ndarray, sentences: int, labels: int) -> np.ndarray:
    """The label with the most votes of each sentence, of equals the first; -1 without any vote."""
    cell, n = np.unique(sentence * labels + label, return_counts=True)
    sentence, label = np.divmod(cell, max(labels, 1))
    order = np.lexsort((label, -n, sentence))
    sentence, label = sentence[order], label[order]
    out = np.full(sentences, -1, np.int64)
    first = np.append(True, sentence[1:] != sentence[:-1])[: len(sentence)]
    out[sentence[first]] = label[first]
    return out


def _fits_a_task(table: DataFrame) -> bool:
    """Whether ``table`` is small, with one label for each word."""
    size = table.select("word", "label").limit(TASK_WORDS + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("word").alias("words"), F.count("label").alias("labels"),
        F.coalesce(F.sum(F.octet_length("word") + F.octet_length("label")), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] == size["words"] == size["labels"] <= TASK_WORDS and size["bytes"] <= TASK_BYTES


def _vote_in_tasks(texts: DataFrame, text: str, key: str, table: DataFrame, default: str) -> DataFrame:
    """``key, sent_pos, label`` of each sentence, decided where its text is read; nothing is shuffled."""
    rows = table.select("word", "label").collect()  # TASK_WORDS and TASK_BYTES at most
    names = sorted({r["label"] for r in rows}, key=str.encode)
    number = {name: i for i, name in enumerate(names)}
    known = pa.array([r["word"] for r in rows], pa.large_string())
    code = np.array([number[r["label"]] for r in rows], np.int64)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array([*names, default], pa.string())  # -1 is the default
        for batch in batches:
            for first, data, at in _stretches(batch["text"]):
                row, position, sentence, words = _sentences(data, at)
                found = pc.index_in(words, known)
                voting = pc.is_valid(found).to_numpy(zero_copy_only=False)
                label = code[found.drop_null().to_numpy()]
                best = _elect(sentence[voting], label, len(row), len(names)) % (len(names) + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch["key"].take(pa.array(first + row)), pa.array(position, pa.int32()), listed.take(pa.array(best))],
                    [key, "sent_pos", "label"])

    schema = StructType([StructField(key, texts.schema[key].dataType), StructField("sent_pos", IntegerType()),
                         StructField("label", StringType())])
    named = texts.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    voted = named.mapInArrow(vote, schema)
    # A sentence without key has no votes, as its words cannot be told from others'.
    return voted.withColumn("label", F.lower(F.when(F.col(key).isNull(), default).otherwise(F.col("label"))))


def vote_in_texts(texts: DataFrame, text: str, key: str, table: DataFrame, default: str = "neutral") -> DataFrame:
    """``key, sent_pos, label``: the sentences of the texts, labelled as ``vote_per_sentence`` does.

    With a small ``table`` that has one label for each word, a sentence is decided where its text is read. Rows
    that share their key vote together, and a table of any other size or kind is joined. ``texts`` is read several times.
    """
    def together(rows: DataFrame) -> DataFrame:
        keys = [key, "sent_pos"]
        sentences = tp.sentence_rows(rows, text, [key])
        return vote_per_sentence(tp.sentence_tokens(sentences, keys), table, keys, sentences, default)

    table = table.where("word IS NOT NULL")
    if not _fits_a_task(table):
        return together(texts)
    counted = texts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    shared = staged(counted.where("_rows > 1").select(key), "shared")
    if shared.isEmpty():
        return _vote_in_tasks(texts, text, key, table, default)
    alone = _vote_in_tasks(texts.join(shared, key, "left_anti"), text, key, table, default)
    return alone.unionByName(together(texts.join(shared, key, "left_semi")))
