"""One run of the construction cycle, from raw pages to analysis messages, committed as a whole.

Every step writes folders of its own run beside those of earlier runs; a manifest, replaced last,
names the current folders of all tables and holds the mark. A run that fails at any point leaves
the tables as they were, and saying it again writes the same folders anew. Work follows the size of the
batch: urls are compared with a bucketed history, and word, proverb, edge, article and author
tables only replace the buckets that the batch touches.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.times import parse_publish_time
from wordloom.operators import edges as eg
from wordloom.operators import lexicon as lx
from wordloom.operators import records as rc
from wordloom.operators import textprep as tp
from wordloom.operators.buckets import BucketTable
from wordloom.operators.numbering import page_rows
from wordloom.operators.pages import ArticleLayout, extract_articles
from wordloom.plans.analyses import analysis_messages, analysis_tables
from wordloom.plans.cycle import LEDGER, SENTENCES, Lexicon
from wordloom.sources.history import History
from wordloom.sources.manifest import Manifest
from wordloom.sources.schemas import ARTICLE, EDGE, LEXICON, PROVERB
from wordloom.sources.state import newer_than

BUCKETS = 64
ARTICLE_NODE = "title STRING, author STRING, articleBrief STRING, contents ARRAY<STRING>, url STRING"
AUTHOR_NODE = "name STRING, relLink STRING, email STRING"
MESSAGES = "topic STRING, partition INT, value STRING"
#: Tables that grow by a folder per run, and tables in buckets with their keys.
GROWING = {"articles": ARTICLE, "sentences": SENTENCES, "ledger": LEDGER, "mentions": EDGE}
BUCKETED = {
    "words": (LEXICON, ("word",)), "proverbs": (PROVERB, ("peribahasa",)),
    "edges": (EDGE, ("rel", "src_type", "src", "dst_type", "dst")),
    "article_nodes": (ARTICLE_NODE, ("title",)), "author_nodes": (AUTHOR_NODE, ("name",)),
}


@dataclass(frozen=True)
class Snapshot:
    """All tables of a store as one finished run left them."""

    spark: SparkSession
    run: int = -1
    since: str | None = None
    proverbs_done: int = 0
    buckets: int = BUCKETS
    grown: dict[str, list[str]] = field(default_factory=dict)
    bucketed: dict[str, dict[str, str]] = field(default_factory=dict)
    messages_folder: str | None = None

    def grows(self, name: str) -> DataFrame:
        """``articles``, ``sentences``, ``ledger`` or ``mentions``."""
        folders = self.grown.get(name, [])
        if not folders:
            return self.spark.createDataFrame([], GROWING[name])
        return self.spark.read.schema(GROWING[name]).parquet(*folders)

    def table(self, name: str) -> BucketTable:
        """``words``, ``proverbs``, ``edges``, ``article_nodes`` or ``author_nodes``."""
        schema, key = BUCKETED[name]
        return BucketTable(self.spark, schema, key, self.buckets, self.bucketed.get(name, {}))

    def lexicon(self) -> Lexicon:
        return Lexicon(self.table("words").read(), self.table("proverbs").read(), self.table("edges").read())

    def messages(self) -> DataFrame:
        if self.messages_folder is None:
            return self.spark.createDataFrame([], MESSAGES)
        return self.spark.read.schema(MESSAGES).json(self.messages_folder)

    def as_content(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "spark"}


@dataclass(frozen=True)
class Knowledge:
    """What a run looks words up in. ``tags``: ``word, base, POS, Label``; ``proverbs``: ``peribahasa, meaning, ord``."""

    dictionary: DataFrame
    tags: DataFrame
    proverbs: DataFrame
    stopwords: DataFrame
    layout: ArticleLayout = ArticleLayout()


def _manifest(spark: SparkSession, root: str) -> Manifest:
    return Manifest(spark, f"{root}/manifest.json")


def open_store(spark: SparkSession, root: str) -> Snapshot:
    """The store as its last finished run left it; an empty one before the first."""
    return Snapshot(spark, **(_manifest(spark, root).read() or {}))


def url_history(spark: SparkSession, root: str, buckets: int = BUCKETS) -> History:
    return History(spark, f"{root}/urls", f"urls_{zlib.crc32(root.encode()):08x}", "url", buckets)


def new_articles(pages: DataFrame, layout: ArticleLayout, since: str | None, crawl_start: datetime) -> DataFrame:
    """Articles of the crawl published after the mark, once per url; an unreadable time counts as new."""
    found = extract_articles(pages, layout)
    if since:
        # Wall-clock times, as the pages give them.
        at = parse_publish_time(F.col("publishTime"), F.lit(crawl_start.isoformat(" ")).cast("timestamp"))
        timed = found.withColumn("_at", at)
        found = newer_than(timed, "_at", F.lit(since).cast("timestamp")).unionByName(timed.where(F.col("_at").isNull())).drop("_at")
    return rc.first_per_key(found, "url", F.struct("publishTime", "title"))


def run_cycle(spark: SparkSession, root: str, pages: DataFrame, crawl_start: datetime, known: Knowledge,
              proverbs_per_run: int = 0, buckets: int = BUCKETS, watch: Callable[[str], None] = lambda step: None) -> bool:
    """Take a crawl ``url, html`` into the store; False where it is done already or holds nothing new.

    The mark moves to the start of the crawl, not to its newest article. ``watch`` is told of every
    finished step. A store has one writer at a time.
    """
    before = open_store(spark, root)
    if before.since == crawl_start.isoformat():
        return False
    run = before.run + 1
    buckets = buckets if before.run < 0 else before.buckets
    done = Snapshot(spark, run, crawl_start.isoformat(), before.proverbs_done, buckets,
                    dict(before.grown), dict(before.bucketed))
    history = url_history(spark, root, buckets)

    def folder(name: str) -> str:
        return f"{root}/{name}/run-{run}"

    def grow(name: str, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(folder(name))
        done.grown[name] = [*before.grown.get(name, []), folder(name)]
        watch(name)
        return spark.read.schema(GROWING[name]).parquet(folder(name))

    def upsert(name: str, rows: DataFrame, merge, step: str | None = None) -> BucketTable:
        step = step or name
        after = done.table(name).upsert(rows, merge, folder(step))
        done.bucketed[name] = after.paths
        watch(step)
        return after

    fresh = history.unseen(new_articles(pages, known.layout, before.since, crawl_start), [str(r) for r in range(run)])
    articles = grow("articles", fresh)
    if articles.isEmpty():
        return False
    history.record(articles, str(run))
    watch("urls")
    sentences = grow("sentences", tp.sentence_rows(tp.article_texts(articles), "text", ["url", "part"]))
    counts = grow("ledger", tp.word_count(tp.text_tokens(sentences, "sentence")))

    enriched = lx.enrich(counts, known.dictionary, known.tags)
    upsert("words", lx.as_nodes(enriched), lx.upsert_counts)
    listed = page_rows(known.proverbs, "ord", before.proverbs_done, proverbs_per_run)
    phrases = lx.first_meanings(listed)
    upsert("proverbs", phrases, lambda old, new: lx.insert_if_absent(old, new, "peribahasa"))
    phrase_words = lx.phrase_words(phrases)
    others = F.array_distinct(F.concat(F.array("base"), "synonym", "antonym"))
    derived = enriched.select(F.explode(others).alias("word")).unionByName(phrase_words.select("word"))
    nodes = lx.as_nodes(lx.dictionary_nodes(derived, known.dictionary, known.tags))
    words = upsert("words", nodes, lambda old, new: lx.insert_if_absent(old, new, "word"), "derived")

    links = (
        eg.lemma_edges(enriched, known.dictionary)
        .unionByName(eg.list_edges(enriched, known.dictionary, "synonym", "SYNONYM_OF"))
        .unionByName(eg.list_edges(enriched, known.dictionary, "antonym", "ANTONYM_OF"))
        .unionByName(eg.proverb_edges(phrase_words, known.dictionary)).distinct()
    )
    key = list(BUCKETED["edges"][1])
    upsert("edges", links, lambda old, new: old.unionByName(new.join(old, key, "left_anti")))
    order = F.struct("publishTime", "url")
    upsert("article_nodes", lx.articles_by_title(articles, order), lambda old, new: lx.insert_if_absent(old, new, "title"))
    upsert("author_nodes", lx.authors_by_name(articles, order), lambda old, new: lx.insert_if_absent(old, new, "name"))
    held = tp.text_tokens(sentences, "sentence", ["url"]).distinct()
    hit = [b for b, p in words.paths.items() if p.startswith((folder("words"), folder("derived")))]
    grow("mentions", eg.mention_edges(held, words.read(hit), "url"))

    lexicon = done.lexicon()
    lemmas = lexicon.edges.where(F.col("rel") == "LEMMATIZED").select(F.col("src").alias("word"), F.col("dst").alias("stem"))
    stems = lexicon.words.select("word").join(lemmas, "word", "left").withColumn("stem", F.coalesce("stem", "word"))
    messages = analysis_messages(analysis_tables(lexicon, stems, known.stopwords))
    messages.write.mode("overwrite").json(folder("messages"))
    watch("messages")

    taken = listed.count()
    _manifest(spark, root).replace({**done.as_content(), "proverbs_done": before.proverbs_done + taken,
                                    "messages_folder": folder("messages")})
    watch("manifest")
    return True
