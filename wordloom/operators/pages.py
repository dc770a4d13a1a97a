"""Records from raw pages: articles, listings, dictionary entries, proverbs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import html as hx
from wordloom.functions.arrays import after
from wordloom.functions.phrases import expand_abbreviations, normalize_phrase, trim_all
from wordloom.functions.senses import numbered_senses

Place = tuple[str, str | None]

SYNONYM_HEADING = "Bersinonim dengan"
ANTONYM_HEADING = "Berantonim dengan"
WIKI_LANGUAGE = "Bahasa Melayu"


@dataclass(frozen=True)
class ArticleLayout:
    """Where an article page keeps its fields: tag and class of each block.

    The defaults are fixed values of the news site the articles come from.
    """

    title: Place = ("span", "d-inline-block mr-1")
    meta: Place = ("div", "article-meta mb-2 mb-lg-0 d-flex align-items-center")
    brief: Place = ("figcaption", "p-2")
    body: Place = ("div", "dable-content-wrapper")
    ads: Place = ("div", "google-anno-skip google-anno-sc")


@dataclass(frozen=True)
class ListingLayout:
    """Where a listing page keeps its teasers; defaults as above."""

    teaser: str = r'(?i)<div\s[^>]*class="(?![^"]*\bd-block\b)[^"]*\barticle-teaser\b[^"]*"[^>]*>'
    time: Place = ("span", "created-ago")


def _cut_first(text: Column, tag: str) -> Column:
    return F.regexp_replace(text, rf"(?is)^(.*?)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", "$1")


def _first_link(block: Column) -> tuple[Column, Column]:
    text = hx.text_of(F.regexp_extract(block, r"(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>", 1))
    target = F.regexp_extract(block, r'(?is)<a\s[^>]*?href="([^"]*)"', 1)
    return text, target


def extract_articles(pages: DataFrame, layout: ArticleLayout = ArticleLayout(), *keep: str) -> DataFrame:
    """Article records from ``url, html``.

    The first link of the meta block is the author, the second the address, and what text
    remains is the publish time. Missing fields are ''. Pages without a meta block are
    dropped.
    """
    raw = F.col("html")
    blocks = pages.where(hx.has_element(raw, *layout.meta)).select(
        *keep,
        "url",
        hx.element(raw, *layout.title).alias("title"),
        hx.element(raw, *layout.meta).alias("meta"),
        hx.element(raw, *layout.brief).alias("brief"),
        hx.element(hx.drop_elements(hx.without_scripts(raw), *layout.ads), *layout.body).alias("body"),
    )
    author, target = _first_link(F.col("meta"))
    after_author = _cut_first(F.col("meta"), "a")
    address, _ = _first_link(after_author)
    rest = _cut_first(_cut_first(after_author, "a"), "span")
    return blocks.select(
        *keep,
        hx.text_of(F.col("title")).alias("title"),
        F.struct(
            author.alias("authName"), target.alias("relLink"), address.alias("email")
        ).alias("authorDetails"),
        hx.text_of(rest).alias("publishTime"),
        hx.text_of(F.col("brief")).alias("articleBrief"),
        hx.paragraphs(F.col("body")).alias("contents"),
        "url",
    )


def listing_items(pages: DataFrame, layout: ListingLayout = ListingLayout()) -> DataFrame:
    """Links and time texts of listing pages ``page_no, html`` in listing order.

    From page 1 to 19 the first teaser repeats the last one of the page before.
    """
    parts = F.split("html", layout.teaser)
    teasers = after(parts, 1)
    return (
        pages.select("page_no", F.posexplode(teasers).alias("pos", "teaser"))
        .where(~(F.col("page_no").between(1, 19) & (F.col("pos") == 0)))
        .select(
            "page_no", "pos",
            F.get(hx.links(F.col("teaser")), F.lit(0)).alias("url"),
            hx.text_of(hx.element(F.col("teaser"), *layout.time)).alias("time_text"),
        )
    )


def page_links(pages: DataFrame, key: str) -> DataFrame:
    return pages.select(key, F.posexplode(hx.links(F.col("html"))).alias("pos", "url"))


def _tab_texts(html: Column) -> Column:
    tabs = F.split(html, r'(?i)<div\s[^>]*class="[^"]*\btab-pane\b[^"]*"[^>]*>')
    return F.transform(
        after(tabs, 1),
        lambda tab: hx.decode_entities(F.regexp_replace(tab, hx.TAG, "")),
    )


def extract_dictionary(pages: DataFrame) -> DataFrame:
    """Dictionary entries from ``word, html``: senses, synonyms and antonyms.

    Pages without a sense are words the dictionary does not have. Senses are cleaned.
    """
    senses = F.flatten(F.transform(_tab_texts(F.col("html")), numbered_senses))
    return pages.select(
        "word",
        F.transform(senses, lambda sense: expand_abbreviations(sense)).alias("meanings"),
        hx.links_after_heading(F.col("html"), SYNONYM_HEADING).alias("synonym"),
        hx.links_after_heading(F.col("html"), ANTONYM_HEADING).alias("antonym"),
    ).where(F.size("meanings") > 0)


def extract_wiki_senses(pages: DataFrame, language: str = WIKI_LANGUAGE) -> DataFrame:
    """Items of the first list under the language's heading; words without one are dropped."""
    return pages.select(
        "word", hx.list_after_heading(F.col("html"), language).alias("definitions")
    ).where(F.size("definitions") > 0)


def extract_proverbs(pages: DataFrame) -> DataFrame:
    """Proverbs and meanings from the tables of ``page_no, html``, in reading order."""
    rows = pages.select("page_no", F.posexplode(hx.table_rows(F.col("html"))).alias("pos", "cells"))
    return rows.where(F.size("cells") >= 2).select(
        "page_no", "pos",
        normalize_phrase(hx.text_of(F.col("cells")[0])).alias("peribahasa"),
        trim_all(hx.joined_text_of(F.col("cells")[1])).alias("meaning"),
    )
