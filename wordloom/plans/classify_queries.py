"""Registered queries: classifiers and extrinsic evaluation.

Trained on the documents that have labels, applied to all documents, evaluated on the
labelled ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.phrases import TEST_EMOTIONS, normalize_emotion, sentiment_code
from wordloom.operators import bayes as nb
from wordloom.operators import evaluate as ev
from wordloom.operators.bayes_ledger import BayesLedger
from wordloom.operators.features import TfIdf, binary_terms, fit_tfidf
from wordloom.plans import standins as si
from wordloom.plans.oracle import with_ctes
from wordloom.session import staged, work_folder

SENTIMENTS = ("negative", "neutral", "positive")
LANGUAGES = ("de", "en", "es", "fr")
MAX_FEATURES = 5000
RAW_EMOTIONS = ("sad", "Angry", "happy", "FEAR", "love", "surprise", "neutral", "jealous", "bored")


def _sentiment_model(spark: SparkSession, sf: str) -> nb.BayesModel:
    docs = si.labelled_documents(spark, sf)
    terms = binary_terms(docs, "doc_id", "text", "label")
    return _stored(nb.train(docs, terms, "label", SENTIMENTS))


def _stored(model: nb.BayesModel) -> nb.BayesModel:
    """Training stored the terms; the few rows of the classes are stored as well."""
    return nb.BayesModel(model.labels, model.terms, staged(model.classes, "classes"))


def nb_train(spark: SparkSession, sf: str) -> DataFrame:
    terms = nb.term_table(_sentiment_model(spark, sf))
    return terms.withColumn("log_prob", F.round("log_prob", 6))


def nb_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same model learned in three batches, one of them first in a wrong and then in its right version."""
    docs = si.labelled_documents(spark, sf)
    terms = binary_terms(docs, "doc_id", "text", "label")
    ledger = BayesLedger(spark, work_folder(spark, "bayes"), SENTIMENTS)
    part = F.pmod("doc_id", F.lit(3))
    ledger.learn(1, docs, terms, "label")
    for i in range(3):
        ledger.learn(i, docs.where(part == i), terms.where(part == i), "label")
    return nb.term_table(_stored(ledger.model())).withColumn("log_prob", F.round("log_prob", 6))


def nb_predict(spark: SparkSession, sf: str) -> DataFrame:
    docs = si.table(spark, sf, "documents")
    terms = binary_terms(docs, "doc_id", "text")
    return nb.predict(_sentiment_model(spark, sf), docs, terms, "doc_id")


def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    docs = si.table(spark, sf, "documents")
    model = fit_tfidf(docs, "text", MAX_FEATURES)
    model = TfIdf(staged(model.features, "features"), model.size)
    weights = model.weights(docs, "doc_id", "text")
    return weights.withColumn("x", F.round("x", 6))


def nb_tfidf_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document from the labelled documents' TF-IDF weights."""
    train = si.labelled_documents(spark, sf).select("doc_id", "text", "lang")
    docs = si.table(spark, sf, "documents")
    model = fit_tfidf(train, "text", MAX_FEATURES)
    model = TfIdf(staged(model.features, "features"), model.size)
    known = model.weights(train, "doc_id", "text", "lang")
    bayes = _stored(nb.train(train, known, "lang", LANGUAGES))
    return nb.predict(bayes, docs, model.weights(docs, "doc_id", "text"), "doc_id")


def _confusion(spark: SparkSession, sf: str) -> DataFrame:
    actual = si.labelled_documents(spark, sf).select("doc_id", "label")
    return ev.confusion_counts(nb_predict(spark, sf).join(actual, "doc_id"), "label", "predicted")


def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return ev.accuracy(_confusion(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


def class_report(spark: SparkSession, sf: str) -> DataFrame:
    report = ev.class_report(_confusion(spark, sf))
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion_matrix(_confusion(spark, sf), SENTIMENTS)


def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    coded = si.lexicon(spark, sf).select("word", sentiment_code(F.col("Label")).alias("label_int"))
    return coded.where(F.col("label_int").isNotNull())


def label_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """Raw emotion names, picked by the length of each turn."""
    names = F.array(*[F.lit(e) for e in RAW_EMOTIONS])
    raw = F.get(names, F.length("text") % len(RAW_EMOTIONS))
    return si.table(spark, sf, "conversations").select(
        "conv_id", "turn", normalize_emotion(F.lower(raw)).alias("label")
    ).where(F.col("label").isin(*TEST_EMOTIONS))


def eval_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Raw evaluation rows with missing and unreadable labels, picked by turn length."""
    raw = F.get(
        F.array(*[F.lit(v) for v in ("1", "0", "-1", None, "n/a", "2.0")]), F.length("text") % 6
    )
    rows = si.table(spark, sf, "conversations").select(
        F.col("text").alias("word"), raw.alias("sentiment")
    )
    return clean_evaluation(rows)


def clean_evaluation(rows: DataFrame) -> DataFrame:
    """``word, sentiment`` to ``filtered_tokens, sentiment_label``: only rows with a number."""
    number = F.col("sentiment").try_cast("double").cast("int")
    return rows.select(
        F.col("word").alias("filtered_tokens"), number.alias("sentiment_label")
    ).where(F.col("sentiment_label").isNotNull() & F.col("filtered_tokens").isNotNull())


QUERIES = {
    "q_nb_train": nb_train,
    "q_nb_batches": nb_batches,
    "q_nb_predict": nb_predict,
    "q_label_encode": label_encode,
    "q_tfidf": tfidf,
    "q_nb_tfidf_predict": nb_tfidf_predict,
    "q_accuracy": accuracy,
    "q_class_report": class_report,
    "q_confusion": confusion,
    "q_label_normalize": label_normalize,
    "q_eval_clean": eval_clean,
}

_TERMS = """
  bag AS (SELECT DISTINCT doc_id, term, 1.0::DOUBLE AS x FROM (
            SELECT doc_id, unnest(string_split_regex(lower(text), '\\s+')) AS term FROM documents)
          WHERE term <> '')"""


def _bayes(train: str, bag: str, train_bag: str) -> str:
    """CTEs up to ``pred``; ``train`` has ``doc_id, label``, the bags ``doc_id, term, x``."""
    return f"""
  tc AS (SELECT term, label, sum(x) AS w FROM {train_bag} JOIN {train} USING (doc_id) GROUP BY 1, 2),
  v AS (SELECT count(DISTINCT term) AS v FROM tc),
  cl AS (SELECT label, count(*) AS n, ln(count(*) / (SELECT count(*) FROM {train})) AS prior FROM {train} GROUP BY 1),
  sp AS (SELECT label, sum(w) + any_value(v) AS space FROM tc, v GROUP BY label),
  known AS (SELECT doc_id, term, x FROM {bag} WHERE term IN (SELECT term FROM tc)),
  k AS (SELECT doc_id, sum(x) AS k FROM known GROUP BY doc_id),
  hit AS (SELECT doc_id, label, sum(x * ln(w + 1)) AS s FROM known JOIN tc USING (term) GROUP BY 1, 2),
  score AS (SELECT d.doc_id, cl.label,
                   round(prior + coalesce(k, 0) * ln(1 / space) + coalesce(s, 0), 6) AS score
            FROM documents d CROSS JOIN cl JOIN sp ON sp.label = cl.label
                 LEFT JOIN k ON k.doc_id = d.doc_id
                 LEFT JOIN hit ON hit.doc_id = d.doc_id AND hit.label = cl.label),
  pred AS (SELECT doc_id, label AS predicted, score FROM (
             SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rn FROM score)
           WHERE rn = 1)"""


_SENTIMENT_BAYES = with_ctes("lab") + "," + _TERMS + "," + _bayes("lab", "bag", "bag")
_CONFUSION = _SENTIMENT_BAYES + """,
  cm AS (SELECT label AS actual, predicted, count(*) AS n FROM pred JOIN lab USING (doc_id) GROUP BY 1, 2)"""

_GRAMS = """
  words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_][\\p{L}\\p{N}_]+') AS ws FROM documents),
  uni AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM words),
  gram AS (SELECT doc_id, w AS term FROM uni
           UNION ALL
           SELECT doc_id, term FROM (
             SELECT doc_id, w || ' ' || lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS term FROM uni)
           WHERE term IS NOT NULL),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM gram GROUP BY 1, 2)"""


def _tfidf(fit: str) -> str:
    return f"""
  feat AS (SELECT term, count(*) AS df FROM tf WHERE doc_id IN (SELECT doc_id FROM {fit})
           GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {MAX_FEATURES}),
  idf AS (SELECT term, ln((1 + (SELECT count(*) FROM {fit})) / (1 + df)) + 1 AS idf FROM feat),
  raw AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
  wt AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS x FROM raw)"""


ORACLES = {
    "q_nb_train": _SENTIMENT_BAYES + """
        SELECT t.term, c.label, coalesce(tc.w, 0) AS weight,
               round(ln((coalesce(tc.w, 0) + 1) / space), 6) AS log_prob
        FROM (SELECT DISTINCT term FROM tc) t CROSS JOIN cl c JOIN sp ON sp.label = c.label
             LEFT JOIN tc ON tc.term = t.term AND tc.label = c.label""",
    "q_nb_predict": _SENTIMENT_BAYES + "\nSELECT doc_id, predicted, score FROM pred",
    "q_label_encode": with_ctes("lex") + """
        SELECT word, CASE Label WHEN 'positive' THEN 1 WHEN 'neutral' THEN 0 WHEN 'negative' THEN -1 END AS label_int
        FROM lex WHERE Label IN ('positive', 'neutral', 'negative')""",
    "q_tfidf": "WITH" + _GRAMS + "," + _tfidf("documents") + """
        SELECT doc_id, term, round(x, 6) AS x FROM wt""",
    "q_nb_tfidf_predict": "WITH" + _GRAMS + """,
  tr AS (SELECT doc_id, lang AS label FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),"""
    + _tfidf("tr") + "," + _bayes("tr", "wt", "wt") + "\nSELECT doc_id, predicted, score FROM pred",
    "q_accuracy": _CONFUSION + """
        SELECT sum(n) AS total, round(sum(n) FILTER (actual = predicted) / sum(n), 6) AS accuracy FROM cm""",
    "q_class_report": _CONFUSION + """,
  names AS (SELECT actual AS label FROM cm UNION SELECT predicted FROM cm),
  one AS (SELECT label,
                 coalesce((SELECT sum(n) FROM cm WHERE actual = label AND predicted = label), 0) AS r,
                 coalesce((SELECT sum(n) FROM cm WHERE predicted = label), 0) AS f,
                 coalesce((SELECT sum(n) FROM cm WHERE actual = label), 0) AS s FROM names),
  per AS (SELECT label, coalesce(r / nullif(f, 0), 0) AS p, coalesce(r / nullif(s, 0), 0) AS rc,
                 coalesce(2 * r / nullif(f + s, 0), 0) AS f1, s FROM one)
        SELECT label, round(p, 6) AS precision, round(rc, 6) AS recall, round(f1, 6) AS f1, s AS support FROM per
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(rc), 6), round(avg(f1), 6), sum(s) FROM per
        UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(rc * s) / sum(s), 6),
                         round(sum(f1 * s) / sum(s), 6), sum(s) FROM per""",
    "q_confusion": _CONFUSION + """
        SELECT l.actual, """ + ", ".join(
        f"coalesce(sum(n) FILTER (predicted = '{s}'), 0) AS pred_{s}" for s in SENTIMENTS
    ) + """
        FROM (SELECT unnest(['negative', 'neutral', 'positive']) AS actual) l LEFT JOIN cm ON cm.actual = l.actual
        GROUP BY l.actual""",
    "q_label_normalize": f"""
        SELECT conv_id, turn, label FROM (
          SELECT conv_id, turn, CASE raw WHEN 'sad' THEN 'sadness' WHEN 'angry' THEN 'anger' ELSE raw END AS label
          FROM (SELECT conv_id, turn, lower(([{", ".join(f"'{e}'" for e in RAW_EMOTIONS)}])
                                            [(length(text) % {len(RAW_EMOTIONS)}) + 1]) AS raw FROM conversations))
        WHERE label IN ({", ".join(f"'{e}'" for e in TEST_EMOTIONS)})""",
    "q_eval_clean": """
        SELECT filtered_tokens, sentiment_label FROM (
          SELECT text AS filtered_tokens,
                 CASE length(text) % 6 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN -1 WHEN 5 THEN 2 END AS sentiment_label
          FROM conversations) WHERE sentiment_label IS NOT NULL""",
}
ORACLES["q_nb_batches"] = ORACLES["q_nb_train"]
