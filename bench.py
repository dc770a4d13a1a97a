"""Time the headline queries and print one JSON line.

Each query's time is also written to standard error as soon as it is known. A query that takes
more than BENCH_LIMIT seconds is cancelled and counts as that limit; the others still run.
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordloom.plans.registry import QUERIES  # noqa: E402
from wordloom.session import build_session  # noqa: E402
from wordloom.sources.files import TEXT_PARTITIONS  # noqa: E402

HEADLINE = (
    "q_word_count", "q_sentences", "q_tokens", "q_doc_tokens_nostop", "q_page_fields",
    "q_page_paragraphs", "q_page_links", "q_expand_abbrev", "q_spell_correct", "q_lexicon_upsert",
    "q_lexicon_nodes", "q_edges_mentioned", "q_proverbs", "q_majority_label", "q_top_words_nostop",
    "q_morphology", "q_length_density", "q_sentence_emotion", "q_definition_overlap", "q_coverage",
    "q_nb_train", "q_nb_predict", "q_tfidf", "q_nb_tfidf_predict", "q_class_report", "q_search",
    "q_proverb_lookup", "q_paginate", "stream_latest", "stream_word_count",
)


ANALYSES = (
    "q_word_length_stats", "q_lemma_length_stats", "q_lexicon_totals", "q_label_dist", "q_pos_dist",
    "q_top_words", "q_top_words_nostop", "q_morphology",
)


def timed(spark, name: str, sf: str, limit: int) -> tuple[float, bool]:
    """Seconds a query takes, and whether it ended within its limit."""
    start, done = time.perf_counter(), threading.Event()

    def guard() -> None:
        wait = limit
        while not done.wait(wait):  # again and again: between two jobs there is nothing to cancel
            spark.sparkContext.cancelAllJobs()
            wait = 1

    threading.Thread(target=guard, daemon=True).start()
    try:
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    except Exception:
        if time.perf_counter() - start < limit:
            raise
        return float(limit), False
    finally:
        done.set()
    return round(time.perf_counter() - start, 3), True


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    limit = int(os.environ.get("BENCH_LIMIT", "120"))
    names = sys.argv[1:] or list(dict.fromkeys((*HEADLINE, *ANALYSES)))
    spark = build_session(f"local[{cpus}]", cpus, "bench", "16g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set(TEXT_PARTITIONS, str(cpus))  # the test tables have one row group each
    QUERIES["q_word_count"](spark, sf).write.format("noop").mode("overwrite").save()
    seconds, late = {}, []
    for name in names:
        seconds[name], ended = timed(spark, name, sf, limit)
        if not ended:
            late.append(name)
        print(json.dumps({"query": name, "sec": seconds[name], "ended": ended}), file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "late": late,
        "analyses": round(sum(seconds.get(n, 0.0) for n in ANALYSES), 3), "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
