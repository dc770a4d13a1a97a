"""The construction cycle: one batch of articles into the lexicon's tables.

Raw articles, sentences and the word ledger are written per batch, each replacing its own
batch, and the lexicon is folded from the ledger. Running a batch again, after a failure
at any point, leaves the same tables; there is no step after which a batch counts as done
while its words are missing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators import edges as eg
from wordloom.operators import lexicon as lx
from wordloom.operators import records as rc
from wordloom.operators import textprep as tp
from wordloom.sources.files import read_batches, write_batch
from wordloom.sources.schemas import ARTICLE

SENTENCES = "url STRING, part STRING, sent_pos INT, sentence STRING"
LEDGER = "word STRING, count BIGINT"


@dataclass(frozen=True)
class Store:
    """Tables of one lexicon below a shared folder."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def articles(self) -> DataFrame:
        return read_batches(self.spark, self.table("articles"), ARTICLE)

    def sentences(self) -> DataFrame:
        return read_batches(self.spark, self.table("sentences"), SENTENCES)

    def ledger(self) -> DataFrame:
        return read_batches(self.spark, self.table("ledger"), LEDGER)

    def word_counts(self) -> DataFrame:
        return lx.fold_ledger(self.ledger())

    def clear(self) -> None:
        """Empty every table of the store."""
        for name, df in (("articles", self.articles()), ("sentences", self.sentences()),
                         ("ledger", self.ledger())):
            lx.emptied(df.drop("batch_id")).write.mode("overwrite").parquet(self.table(name))


def new_in_batch(store: Store, articles: DataFrame, batch_id: str) -> DataFrame:
    """Articles of a batch, once per url, that no *other* batch holds."""
    earlier = store.articles().where(F.col("batch_id") != F.lit(str(batch_id))).select("url")
    once = rc.first_per_key(articles, "url", F.struct("publishTime", "title"))
    return rc.not_yet_processed(once, earlier, "url")


def load_batch(store: Store, articles: DataFrame, batch_id: str) -> bool:
    """Write one batch; returns False where it holds nothing new.

    Each step reads what the step before has written, so no text is worked on twice.
    """
    spark = store.spark
    fresh = new_in_batch(store, articles, batch_id)
    write_batch(fresh, store.table("articles"), batch_id)
    written = spark.read.schema(ARTICLE).parquet(f"{store.table('articles')}/batch_id={batch_id}")
    texts = tp.article_texts(written)
    write_batch(tp.sentence_rows(texts, "text", ["url", "part"]), store.table("sentences"), batch_id)
    sentences = spark.read.schema(SENTENCES).parquet(f"{store.table('sentences')}/batch_id={batch_id}")
    write_batch(tp.word_count(tp.text_tokens(sentences, "sentence")), store.table("ledger"), batch_id)
    return not written.isEmpty()


@dataclass(frozen=True)
class Lexicon:
    """Word and proverb nodes and their edges."""

    words: DataFrame
    proverbs: DataFrame
    edges: DataFrame


def build_lexicon(counts: DataFrame, dictionary: DataFrame, tags: DataFrame,
                  proverbs: DataFrame) -> Lexicon:
    """All nodes and edges from counts, dictionary, tags and proverbs ``peribahasa, meaning, ord``."""
    enriched = lx.enrich(counts, dictionary, tags)
    phrases = lx.first_meanings(proverbs)
    phrase_words = lx.phrase_words(phrases)
    others = F.concat(F.array("base"), "synonym", "antonym")
    derived = enriched.select(F.explode(F.array_distinct(others)).alias("word")).unionByName(
        phrase_words.select("word")
    )
    nodes = lx.as_nodes(lx.dictionary_nodes(derived, dictionary, tags))
    edges = (
        eg.lemma_edges(enriched, dictionary)
        .unionByName(eg.list_edges(enriched, dictionary, "synonym", "SYNONYM_OF"))
        .unionByName(eg.list_edges(enriched, dictionary, "antonym", "ANTONYM_OF"))
        .unionByName(eg.proverb_edges(phrase_words, dictionary))
    )
    return Lexicon(lx.insert_if_absent(lx.as_nodes(enriched), nodes, "word"), phrases, edges)
