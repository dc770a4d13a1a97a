"""Batch look-ups and the catalogue of stored queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.phrases import trim_all
from wordloom.operators.containment import first_holders
from wordloom.operators.lexicon import update_where
from wordloom.operators.numbering import number_rows
from wordloom.operators.records import first_per_key
from wordloom.session import staged
from wordloom.sources.schemas import PROVERB

# The messages for a proverb that is not there, and for a first letter that is none.
NOT_FOUND = "Proverb not found."
BAD_LETTER = "Invalid first letter of the proverb."
QUERY_KEYWORDS = ("SELECT", "WITH")
SHOWN_CHARS = 100
PAGE_SIZE = 10


def search(terms: DataFrame, lexicon: DataFrame, proverbs: DataFrame) -> DataFrame:
    """Words and proverbs by lower-case, trimmed term; terms without a match are absent."""
    asked = terms.select(trim_all(F.lower("term")).alias("term")).distinct()
    entries = lexicon.select(
        F.col("word").alias("term"), F.lit("WORD").alias("type"), "definitions", "POS", "Label",
        "word_count", F.lit(None).cast("string").alias("meaning"),
    ).unionByName(
        proverbs.select(F.col("peribahasa").alias("term"), F.lit("PERIBAHASA").alias("type"), "meaning"),
        allowMissingColumns=True,
    )
    return asked.join(entries, "term")


def with_initial(proverbs: DataFrame) -> DataFrame:
    """Half of the alphabet a proverb belongs to: the column to partition its table by."""
    letter = F.lower(F.left("peribahasa", F.lit(1)))
    return proverbs.withColumn(
        "half", F.when(letter.between("a", "m"), "A-M").when(letter.between("n", "z"), "N-Z")
    )


def store_proverbs(proverbs: DataFrame, path: str) -> None:
    """The table by halves of the alphabet, a folder each."""
    with_initial(proverbs).select("peribahasa", "meaning", "half").write.mode("overwrite").partitionBy("half").parquet(path)


def stored_proverbs(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """The halves of a stored table that the asked proverbs belong to; the others are not read."""
    halves = [r["half"] for r in with_initial(asked).select("half").distinct().collect() if r["half"]]  # two at most
    return spark.read.schema(f"{PROVERB}, half STRING").parquet(path).where(F.col("half").isin(halves)).drop("half")


def find_proverbs(asked: DataFrame, proverbs: DataFrame) -> DataFrame:
    """First meaning per asked proverb, or why there is none."""
    halves = with_initial(asked)
    known = with_initial(proverbs).where(F.col("half").isNotNull())
    answer = (
        F.when(F.col("half").isNull(), BAD_LETTER)
        .otherwise(F.coalesce("meaning", F.lit(NOT_FOUND)))
    )
    return halves.join(known, ["half", "peribahasa"], "left").select("peribahasa", answer.alias("answer"))


def valid_queries(queries: DataFrame, keywords: Sequence[str] = QUERY_KEYWORDS) -> DataFrame:
    """Named queries that hold at least one of the keywords."""
    upper = F.upper("query")
    hit = F.lit(False)
    for word in keywords:
        hit = hit | F.contains(upper, F.lit(word))
    return queries.where((F.trim("name") != "") & hit)


def store_queries(catalog: DataFrame, new: DataFrame, now) -> DataFrame:
    """Upsert by name (one row per name in ``new``): stored now and not used yet."""
    fresh = new.select(
        "name", "query", F.lit(now).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("last_used"),
    )
    return catalog.join(new.select("name"), "name", "left_anti").unionByName(fresh)


def list_pages(queries: DataFrame, order: str) -> DataFrame:
    """Numbered listing, ten to a page, long texts cut for display."""
    shown = F.when(
        F.length("query") > SHOWN_CHARS, F.concat(F.left("query", F.lit(SHOWN_CHARS)), F.lit("..."))
    ).otherwise(F.col("query"))
    return number_rows(queries, order, "no").select(
        F.ceil(F.col("no") / PAGE_SIZE).cast("bigint").alias("page"), "no", "name", shown.alias("query")
    )


def recent_first(catalog: DataFrame) -> DataFrame:
    """Last used first, then by name backwards; queries never used come last."""
    return catalog.orderBy(F.desc_nulls_last("last_used"), F.desc("name"))


def run_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Any SQL text over the given tables."""
    return spark.sql(sql, **tables)


def run_stored(spark: SparkSession, catalog: DataFrame, position: int, now, **tables: DataFrame):
    """Run the query at a 1-based place of the recent-first list; returns rows and catalogue."""
    chosen = recent_first(catalog).offset(position - 1).limit(1).first()
    if position < 1 or chosen is None:
        raise IndexError(f"no stored query at {position}")
    stamped = update_where(catalog, "name", chosen["name"], {"last_used": F.lit(now).cast("timestamp")})
    return run_query(spark, chosen["query"], **tables), stamped


def append_numbered(existing: DataFrame, new: DataFrame, order: str, seen: str = "equal") -> DataFrame:
    """New entries the list lacks, numbered on from its length. ``new``: ``order, query``.

    With ``seen="contains"`` an entry is there already if it stands inside a listed entry or inside
    a new one before it. An entry inside a refused one also stands inside what holds that one, so all
    new entries can be asked at once. The empty entry is then only taken into an empty list, as its first.
    """
    once = first_per_key(new.select("query", order), "query", F.col(order))
    if seen == "equal":
        unseen = once.join(existing.select("query"), "query", "left_anti")
    elif seen == "contains":  # equal entries stand inside each other as well
        unseen = _outside_others(existing, once, order)
    else:
        raise ValueError("seen is 'equal' or 'contains'")
    return number_rows(unseen, order, "no", first=0).select(
        (F.col("no") + existing.agg(F.count(F.lit(1))).scalar()).alias("no"), "query"
    )


def _outside_others(existing: DataFrame, new: DataFrame, order: str) -> DataFrame:
    new = staged(new, "entries")
    listed = existing.where(F.col("query").isNotNull())
    filled = not listed.isEmpty()
    ahead = F.lit(None).cast(new.schema[order].dataType)
    keyed = new.where(F.col("query").isNotNull()).select(F.col("query").alias("text"), F.col(order).alias("held"))
    holders = listed.select(F.col("query").alias("text"), ahead.alias("held")).unionByName(keyed)
    found = first_holders(keyed, holders).select(F.col("text").cast("string").alias("text"), F.col("first.held").alias("first"))
    inside = keyed.join(found, "text").where(F.col("first").isNull() | (F.col("first") < F.col("held")))
    rest = new.join(inside.select(F.col("held").alias(order)), order, "left_anti")
    first = new.agg(F.min(F.struct(order, "query"))["query"]).scalar()
    keep_empty = F.lit(False) if filled else F.coalesce(first == "", F.lit(False))
    return rest.where((F.col("query") != "") | F.col("query").isNull() | keep_empty)


def numbered_list(entries: DataFrame) -> DataFrame:
    """Entries by place; places close up where numbers were removed."""
    return number_rows(entries, "no", "place").select("place", "query")


def entry_at(entries: DataFrame, place: int) -> DataFrame:
    return numbered_list(entries).where(F.col("place") == place)


def remove_number(entries: DataFrame, number: int) -> DataFrame:
    """Remove by stored number; the others keep theirs."""
    return entries.where(F.col("no") != number)
