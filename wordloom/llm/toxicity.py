"""Toxicity by compression distance with separate zstandard dictionaries.

The ordinary dictionary is trained on windows of ordinary texts. The toxic one holds the
stretches of words that mark toxic texts: five-letter grams that stand in many more contexts
there, joined where they overlap. A context is a word with the word before it, so that copies
of one text count once. A window of words is compressed with the ordinary dictionary and
again with the toxic one at its end; the bytes saved are its gain. Both dictionaries share
everything else, and each window stands between passages that both hold, so that a window
without toxic stretches comes out equally long. A text's two largest gains are turned into a
probability by the calibrated table of the labelled sample.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.tables import held_out, narrow
from wordloom.session import staged

#: Labelled texts that a model is fitted on at most, of each class.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 2000, 4000
#: Words of a window, characters of one at most, windows of a text that go into training.
WINDOW, LONGEST, WINDOWS_TRAINED = 8, 512, 8
#: Letters of a gram; contexts it needs, and how much commoner it must be in toxic texts.
GRAM, MIN_CONTEXTS, MIN_RATIO = 5, 5, 20.0
ORDINARY_BYTES, CARRIER_BYTES = 16384, 40
MOST_GAIN = 60
PREDICT = 0.5


@dataclass(frozen=True)
class ToxicModel:
    """The two dictionaries, the passage both end with, and the probability for each gain."""

    ordinary: bytes
    toxic: bytes
    carrier: bytes
    probability: tuple[float, ...]


@functools.lru_cache(maxsize=4)
def _compressors(model: ToxicModel):
    # Every byte of the longer dictionary is in reach of a window.
    reach = max(17, (2 * (len(model.ordinary) + len(model.toxic) + len(model.carrier) + 8 * LONGEST)).bit_length())
    settings = zstandard.ZstdCompressionParameters(
        window_log=reach, chain_log=reach - 1, hash_log=reach - 1, search_log=5, min_match=6, target_length=32,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    made = []
    for content in (model.ordinary + model.carrier, model.ordinary + model.toxic + model.carrier):
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=settings)
        made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings).compress)
    return made


def windows(text: str) -> list[str]:
    """The words of a text in lower case, WINDOW at a time; overlong windows in overlapping parts."""
    words = text.lower().split()
    out = []
    for i in range(0, len(words), WINDOW):
        window = f" {' '.join(words[i : i + WINDOW])} "
        if len(window) <= LONGEST:
            out.append(window)
        else:
            out += [window[k : k + LONGEST] for k in range(0, len(window), LONGEST - 32)]
    return out


def gains(model: ToxicModel, text: str) -> list[int]:
    """Bytes that the toxic dictionary saves on each window."""
    ordinary, toxic = _compressors(model)
    carrier = model.carrier
    # zstandard looks for no match in the last 16 bytes, so a window does not end its input.
    filled = [carrier + w.encode() + carrier for w in windows(text)]
    return [len(ordinary(w)) - len(toxic(w)) for w in filled]


def evidence(model: ToxicModel, text: str) -> int:
    """The two largest gains of a text together, between 0 and MOST_GAIN."""
    first = second = 0
    for gain in gains(model, text):
        if gain > first:
            first, second = gain, first
        elif gain > second:
            second = gain
    return min(first + second, MOST_GAIN)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of the labelled documents with the smallest hashes, so many of each class, stored."""
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    mixed = F.xxhash64("doc_id")
    picked = [
        known.where(F.col("toxic") == c).orderBy(mixed, "doc_id").limit(n).select("doc_id", "toxic")
        for c, n in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE))
    ]
    ids = staged(picked[0].unionByName(picked[1]), "sampled")
    return staged(docs.join(F.broadcast(ids), "doc_id"), "labelled")


def _contexts(sample: DataFrame) -> DataFrame:
    """word, toxic and the number of its contexts in that class."""
    words = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "")
    listed = sample.select("toxic", words.alias("words"))
    pairs = F.transform("words", lambda w, i: F.struct(F.get("words", i - 1).alias("before"), w.alias("word")))
    return (
        listed.select("toxic", F.explode(F.array_distinct(pairs)).alias("p"))
        .select("toxic", "p.before", "p.word").distinct()
        .groupBy("word", "toxic").agg(F.count(F.lit(1)).alias("contexts"))
    )


def _marking_words(contexts: DataFrame) -> tuple[set[str], list[tuple[str, int]]]:
    """Grams that mark toxic texts, and the words of toxic texts that hold one, with their contexts."""
    spaced = F.concat(F.lit(" "), "word", F.lit(" "))
    starts = F.sequence(F.lit(1), F.greatest(F.length(spaced) - (GRAM - 1), F.lit(1)))
    grams = contexts.select("*", F.explode(F.array_distinct(
        F.transform(starts, lambda i: F.substring(spaced, i, F.lit(GRAM))))).alias("gram"))
    of = lambda c: F.sum(F.when(F.col("toxic") == c, F.col("contexts")).otherwise(0))
    totals = contexts.agg(of(1).alias("t1"), of(0).alias("t0")).first()
    counted = grams.groupBy("gram").agg(of(1).alias("c1"), of(0).alias("c0")).where(F.length("gram") == GRAM)
    t1, t0 = float(totals["t1"] or 0), float(totals["t0"] or 0)
    marking = counted.where((F.col("c1") >= MIN_CONTEXTS) & (F.col("c1") * t0 >= MIN_RATIO * t1 * (F.col("c0") + 0.5)))
    marking = staged(marking.select("gram"), "grams")
    words = grams.where("toxic = 1").join(marking, "gram").select("word", "contexts").distinct()
    return {r[0] for r in marking.collect()}, [(r[0], r[1]) for r in words.collect()]


def marked_stretches(word: str, marking: set[str]) -> list[str]:
    """The parts of a word, with the spaces around it, that marking grams cover."""
    spaced, out, end = f" {word} ", [], 0
    for i in range(len(spaced) - GRAM + 1):
        if spaced[i : i + GRAM] in marking:
            if out and i < end:
                out[-1] += spaced[end : i + GRAM]
            else:
                out.append(spaced[i : i + GRAM])
            end = i + GRAM
    return out


def _toxic_content(marking: set[str], words: Iterable[tuple[str, int]]) -> bytes:
    """All stretches, the commonest at the end, where zstandard reaches them most cheaply."""
    counts = Counter()
    for word, contexts in words:
        for stretch in marked_stretches(word, marking):
            counts[stretch] += contexts
    content = b""
    for stretch, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if stretch.encode() not in content:
            content = stretch.encode() + content
    return content


def _ordinary_content(sample: DataFrame) -> bytes:
    """A dictionary trained on a few windows of each ordinary text of the sample."""

    def pick(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                every = windows(text)
                step = max(1, len(every) // WINDOWS_TRAINED)
                found += every[::step][:WINDOWS_TRAINED]
            yield pd.DataFrame({"window": found}, dtype=object)

    rows = sample.where("toxic = 0").select("text").mapInPandas(pick, "window string").orderBy("window").collect()
    samples = [r[0].encode() for r in rows]
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples for training: they are the dictionary
        return b"".join(samples)[:ORDINARY_BYTES]


def _score(docs: DataFrame, model: ToxicModel, shared: tuple[str, ...]) -> DataFrame:
    """The columns ``shared`` and the ``evidence`` of each text."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([evidence(model, t.as_py()) for t in batch["text"]], pa.int32())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in shared], found], [*shared, "evidence"])

    fields = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in shared]
    return docs.select(*shared, "text").mapInArrow(score, ", ".join([*fields, "evidence int"]))


def calibrate(toxic: Counter, ordinary: Counter, share: float) -> tuple[float, ...]:
    """Probability of toxic for each evidence from 0 to MOST_GAIN, never falling with it.

    Neighbouring values are pooled until the ratio of the classes rises; ``share`` is the share of
    toxic texts among all labelled ones.
    """
    n1, n0 = max(1, sum(toxic.values())), max(1, sum(ordinary.values()))
    blocks: list[list[float]] = []
    for gain in range(MOST_GAIN + 1):
        blocks.append([share * toxic[gain] / n1, (1 - share) * ordinary[gain] / n0, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a, b, size = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a, blocks[-1][1] + b, blocks[-1][2] + size]
    smooth = 0.5 / (n1 + n0)
    return tuple(
        (a + share * smooth) / (a + b + smooth) for a, b, size in blocks for _ in range(int(size))
    )


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """Dictionaries and calibration from a bounded sample of the labels that may be learned from.

    ``docs`` has doc_id and text. With one class or no labels every text gets the same score.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    totals = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("n1")).first()
    share = ((totals["n1"] or 0) + 0.5) / (totals["n"] + 1)
    sample = _sample(docs, labels)
    marking, words = _marking_words(staged(_contexts(sample), "contexts"))
    ordinary = _ordinary_content(sample)
    carrier = ordinary[-CARRIER_BYTES:] or b" the carrier of a window "
    model = ToxicModel(ordinary, _toxic_content(marking, words), carrier, ())
    found = {0: Counter(), 1: Counter()}
    for r in _score(sample, model, ("toxic",)).groupBy("toxic", "evidence").count().collect():
        found[r["toxic"]][r["evidence"]] += r["count"]
    return ToxicModel(model.ordinary, model.toxic, model.carrier, calibrate(found[1], found[0], share))


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, evidence, score and predicted of every row of ``docs``.

    A null or empty text has no windows and gets the lowest score. Repeated rows are scored
    alike and each stays a row; an empty table gives none; other columns are not read. ``labels``
    with nulls teach nothing.
    """
    df = narrow(docs, key, text)
    model = fit_toxicity(df, labels)
    scored = _score(df, model, ("doc_id",))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "evidence", *_verdict(model))


def _verdict(model: ToxicModel) -> list:
    score = F.get(F.array(*[F.lit(float(p)) for p in model.probability]), F.col("evidence"))
    return [score.alias("score"), (score >= PREDICT).cast("int").alias("predicted")]


def keep_civil(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, unchanged; no text is shuffled."""
    df = narrow(docs, key, text, carry=True)
    model = fit_toxicity(df.select("doc_id", "text"), labels)
    marked = _score(df, model, ("row",)).select("row", *_verdict(model))
    return marked.where("predicted = 0").select(*[F.col("row")[c].alias(c) for c in docs.columns])
