"""All registered queries and their check SQL."""

from __future__ import annotations

from wordloom.plans import (
    analytics_queries,
    classify_queries,
    lexicon_queries,
    lookup_queries,
    page_queries,
    stream_queries,
    text_queries,
)

_GROUPS = (
    text_queries, page_queries, lexicon_queries, analytics_queries, classify_queries,
    lookup_queries, stream_queries,
)

QUERIES = {name: query for group in _GROUPS for name, query in group.QUERIES.items()}
ORACLES = {name: sql for group in _GROUPS for name, sql in group.ORACLES.items()}
