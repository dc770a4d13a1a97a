"""Check SQL of the operators that SQL can express, with the iterations written out."""

from __future__ import annotations

from wordloom.llm import host_trust as hosts
from wordloom.llm import quality_rules as rules


def _vote_cases() -> str:
    """The votes of the rules in the order of RULES, over the table ``stats``."""
    ratio = lambda a, b: f"coalesce({a} / nullif({b}, 0)::DOUBLE, 0)"
    vote = lambda bad, good: f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"
    mean, share = ratio("word_chars", "n_words"), ratio("n_symbols", "word_chars")
    upper, marks = ratio("n_upper", "word_chars"), ratio("n_marks", "n_words")
    repeats, dups = ratio("n_repeat_words", "n_words"), ratio("n_dup_lines", "n_lines")
    return ", ".join([
        vote("n_words < 10", "n_words >= 50"),
        vote(f"{ratio('n_symbols', 'n_words')} > 0.5", "n_symbols = 0"),
        vote(f"{share} > 0.05", f"{share} < 0.01"),
        vote(f"({mean} < 2.5 OR {mean} > 14)", f"({mean} >= 3 AND {mean} <= 11)"),
        vote(f"{upper} > 0.4", f"{upper} < 0.15"),
        vote(f"{marks} > 0.3", f"{marks} < 0.05"),
        vote(f"{repeats} > 0.2", f"{repeats} < 0.1"),
        vote(f"{dups} > 0.3", "n_words >= 50 AND n_dup_lines = 0"),
        vote("n_words >= 20 AND n_distinct * n_distinct < 4 * n_words", "n_distinct * n_distinct > 16 * n_words"),
    ])


def quality_rules() -> str:
    good, bad, share = rules.PRIOR_GOOD, rules.PRIOR_BAD, rules.PRIOR_SHARE
    part = lambda p: p[0] / sum(p)
    steps = [f"""m0 AS MATERIALIZED (SELECT DISTINCT rule, {part(good)}::DOUBLE AS g, {part(bad)}::DOUBLE AS b,
        {part(share)}::DOUBLE AS s FROM voted)"""]
    odds = """1 / (1 + exp(-(max(ln(s / (1 - s))) + sum(CASE vote WHEN 1 THEN ln(g / (1 - b))
        WHEN -1 THEN ln((1 - g) / b) ELSE 0 END))))"""
    for i in range(rules.STEPS):
        steps.append(f"""q{i} AS MATERIALIZED (SELECT votes, {odds} AS q FROM voted JOIN m{i} USING (rule) GROUP BY votes)""")
        steps.append(f"""m{i + 1} AS MATERIALIZED (SELECT rule,
            (sum(n * q) FILTER (vote = 1) + {good[0]}) / (sum(n * q) FILTER (vote <> 0) + {sum(good)}) AS g,
            (sum(n * (1 - q)) FILTER (vote = -1) + {bad[0]}) / (sum(n * (1 - q)) FILTER (vote <> 0) + {sum(bad)}) AS b,
            (sum(n * q) + {share[0]}) / (sum(n) + {sum(share)}) AS s
            FROM (SELECT rule, vote, n, q FROM voted JOIN q{i} USING (votes)
                  UNION ALL SELECT rule, v, 0, 0.5 FROM m0, unnest([-1, 1]) AS t(v)) GROUP BY rule)""")
    return f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS MATERIALIZED (
    SELECT r, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM (SELECT r, regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+') AS ws FROM docs)),
windows AS MATERIALIZED (
    SELECT r, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS five
    FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i, five IS NOT NULL AND count(*) OVER (PARTITION BY r, five) > 1 AS again FROM windows),
covered AS (SELECT r, max(CASE WHEN again THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM twice),
repeats AS (SELECT r, sum(c)::BIGINT AS n_repeat_words FROM covered GROUP BY r),
by_word AS (SELECT r, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, count(DISTINCT w) AS n_distinct FROM words GROUP BY r),
by_line AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM docs) WHERE regexp_matches(l, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY r),
stats AS MATERIALIZED (
    SELECT r, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_distinct, 0) AS n_distinct,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(text, '[^!?]', '', 'g')) AS n_marks,
        length(regexp_replace(text, '\\P{{Lu}}', '', 'g')) AS n_upper
    FROM docs LEFT JOIN by_word USING (r) LEFT JOIN by_line USING (r) LEFT JOIN repeats USING (r)),
judged AS MATERIALIZED (SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed, [{_vote_cases()}] AS votes FROM stats),
patterns AS (SELECT votes, count(*) FILTER (NOT base_failed) AS n FROM judged GROUP BY votes),
voted AS MATERIALIZED (SELECT votes, n, unnest(votes) AS vote, generate_subscripts(votes, 1) AS rule FROM patterns),
{", ".join(steps)},
final AS MATERIALIZED (SELECT votes, {odds} AS q FROM voted JOIN m{rules.STEPS} USING (rule) GROUP BY votes)
SELECT doc_id, n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND q >= {rules.KEEP} AS kept
FROM judged JOIN final USING (votes)"""


def host_trust() -> str:
    ordered = sorted(hosts.RULES, key=lambda r: -len(r[1]))

    def cases(said: bool) -> str:
        parts = []
        for verdict, rule in ordered:
            domain, slash, path = rule.partition("/")
            fits = f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + path}')"
            parts.append(f"WHEN {fits} THEN '{verdict if said else rule}'")
        return f"CASE {' '.join(parts)} END"

    lower = lambda x: f"translate({x}, '{hosts.UPPER}', '{hosts.LOWER}')"
    quoted = lambda x: x.replace("'", "''")
    first = f"(1 - {hosts.DAMPING})"
    steps = [f"t0 AS MATERIALIZED (SELECT *, {first} * allowed AS trust, {first} * blocked AS distrust FROM hosts)"]
    for i in range(hosts.STEPS):
        steps.append(f"""t{i + 1} AS MATERIALIZED (
            SELECT h.host, pages, allowed, blocked, {first} * allowed + {hosts.DAMPING} * coalesce(t, 0) AS trust,
                {first} * blocked + {hosts.DAMPING} * coalesce(d, 0) AS distrust
            FROM hosts h LEFT JOIN (SELECT receiver, sum(f.trust * s.trust) AS t, sum(f.distrust * s.distrust) AS d
                FROM flows f JOIN t{i} s ON f.sender = s.host GROUP BY receiver) g ON h.host = g.receiver)""")
    return f"""
WITH parsed AS MATERIALIZED (
    SELECT page_id, html, coalesce({lower(f"regexp_extract(url, '{hosts.URL}', 1)")}, '') AS host,
        coalesce(regexp_extract(url, '{hosts.URL}', 2), '') AS path FROM pages),
ruled AS MATERIALIZED (SELECT *, {cases(False)} AS rule, {cases(True)} AS said FROM parsed),
hosts AS MATERIALIZED (
    SELECT host, count(*) AS pages, avg(CASE WHEN said = 'allow' THEN 1.0 ELSE 0.0 END) AS allowed,
        avg(CASE WHEN said = 'block' THEN 1.0 ELSE 0.0 END) AS blocked FROM ruled GROUP BY host),
linked AS (SELECT host AS source, target, count(*) AS links FROM (
    SELECT DISTINCT page_id, host, {lower("u")} AS target
    FROM parsed, unnest(regexp_extract_all(html, '{quoted(hosts.LINK)}', 1)) AS t(u)) GROUP BY ALL),
up AS (SELECT host AS source, regexp_extract(host, '^[^.]+\\.(.+)$', 1) AS target FROM hosts),
either AS (
    SELECT source, target, links FROM linked WHERE source <> target
    UNION ALL SELECT source, target, 1 FROM up WHERE target IN (SELECT host FROM hosts)
    UNION ALL SELECT target, source, 1 FROM up WHERE target IN (SELECT host FROM hosts)),
edges AS MATERIALIZED (SELECT source, target, sum(links) AS links FROM either WHERE target IN (SELECT host FROM hosts) GROUP BY ALL),
flows AS MATERIALIZED (
    SELECT source AS sender, target AS receiver, links / sum(links) OVER (PARTITION BY source) AS trust, 0.0 AS distrust FROM edges
    UNION ALL SELECT target, source, 0.0, links / sum(links) OVER (PARTITION BY target) FROM edges),
{", ".join(steps)}
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN (distrust - trust) / {first} > {hosts.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN t{hosts.STEPS} USING (host)"""


def lexical_search() -> str:
    """Terms, normalisers and scores of all pairs of item and document that share a term."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    folded = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all({folded}, '{pattern}')) AS term FROM documents WHERE text IS NOT NULL
), held AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), lengths AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), corpus AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths
), normal AS (
  SELECT doc_id, 100 - 50 + (50 * n * docs) // terms AS m FROM lengths, corpus
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, corpus GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({folded}, '{pattern}')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN normal USING (doc_id) GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""


def hard_negatives() -> str:
    """Positives and negatives of every anchor by all inner products."""
    return """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""
