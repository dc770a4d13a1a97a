"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame

ARTICLE = (
    "title STRING, authorDetails STRUCT<authName: STRING, relLink: STRING, email: STRING>, "
    "publishTime STRING, articleBrief STRING, contents ARRAY<STRING>, url STRING"
)
DICTIONARY = "word STRING, meanings ARRAY<STRING>, synonym ARRAY<STRING>, antonym ARRAY<STRING>"
LEXICON = "word STRING, definitions ARRAY<STRING>, word_count BIGINT, POS STRING, Label STRING"
EDGE = "rel STRING, src_type STRING, src STRING, dst_type STRING, dst STRING"
PROVERB = "peribahasa STRING, meaning STRING"
WORD_COUNT = "word STRING, count BIGINT"
MORPHOLOGY = "word STRING, stem STRING, prefix STRING, suffix STRING, core_word STRING"
MESSAGE = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, value STRING"
QUERY_CATALOG = "name STRING, query STRING, created_at TIMESTAMP, last_used TIMESTAMP"
WORD_SAMPLE = "word STRING, sentiment STRING, stem STRING, prefix STRING, suffix STRING"
EMOTION_SAMPLE = "sentence STRING, sentiment STRING, emotion STRING, pos STRING"
LABELLED_SENTENCE = "cleaned_text STRING, label STRING"


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail early where a table lacks a column it must have."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
