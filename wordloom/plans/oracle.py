"""Shared pieces of the check SQL: common table expressions by name."""

from __future__ import annotations

from wordloom.plans.standins import EMOTIONS, SUFFIXES, TAG_DESCRIPTIONS


def _sentences(table: str, keys: str) -> str:
    return f"""
      SELECT {keys}, sent_pos, sentence FROM (
        SELECT {keys}, generate_subscripts(parts, 1) - 1 AS sent_pos,
               trim(regexp_replace(unnest(parts), '[^a-zA-Z-]+', ' ', 'g')) AS sentence
        FROM (SELECT {keys}, string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS parts
              FROM {table}))
      WHERE sentence <> ''"""


def _tokens(sentences: str, keys: str) -> str:
    return f"""
      SELECT {keys}, sent_pos, word_pos, sentence, word FROM (
        SELECT {keys}, sent_pos, sentence, generate_subscripts(ws, 1) - 1 AS word_pos,
               lower(regexp_replace(unnest(ws), '(^-|-$)', '', 'g')) AS word
        FROM (SELECT *, string_split(sentence, ' ') AS ws FROM {sentences}))
      WHERE length(word) > 1"""


_SUFFIX_LIST = ", ".join(f"'{s}'" for s in SUFFIXES)
_EMOTION_LIST = ", ".join(f"'{e}'" for e in EMOTIONS)
_DESCRIPTION_ROWS = ", ".join(f"('{t}', '{d}')" for t, d in TAG_DESCRIPTIONS)
_SENTIMENT = "CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END"
NORMALIZED = (
    "lower(trim(regexp_replace(regexp_replace({}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+', ' ', 'g')))"
)


def text_of(fragment: str) -> str:
    """Tags to spaces, entities decoded, white space collapsed."""
    out = f"regexp_replace({fragment}, '<[^>]+>', ' ', 'g')"
    for name, sign in (
        ("&nbsp;", " "), ("&quot;", '"'), ("&apos;", "''"), ("&lt;", "<"), ("&gt;", ">"),
        ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
    ):
        out = f"replace({out}, '{name}', '{sign}')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


# name -> (names it builds on, body)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "sent": ((), _sentences("documents", "doc_id")),
    "tok": (("sent",), _tokens("sent", "doc_id")),
    "wc": (("tok",), "SELECT word, count(*) AS n FROM tok GROUP BY word"),
    "bsent": ((), _sentences("benchmark", "item_id")),
    "btok": (("bsent",), _tokens("bsent", "item_id")),
    "csent": ((), _sentences("conversations", "conv_id, turn")),
    "ctok": (("csent",), _tokens("csent", "conv_id, turn")),
    "cwc": (("ctok",), "SELECT word, count(*) AS n FROM ctok GROUP BY word"),
    "dict": (("btok",), f"""
      SELECT word, CASE WHEN f = l THEN [f] ELSE [f, l] END AS meanings,
             list_transform([{_SUFFIX_LIST}], lambda s: word || s) AS synonym,
             [reverse(word)] AS antonym
      FROM (SELECT word, arg_min(sentence, item_id * 1000000 + sent_pos) AS f,
                   arg_max(sentence, item_id * 1000000 + sent_pos) AS l
            FROM btok GROUP BY word)"""),
    "extdef": (("ctok",), """
      SELECT word, arg_min(sentence, conv_id * 1000000000 + turn * 100000 + sent_pos) AS definition
      FROM ctok GROUP BY word"""),
    "lab": ((), f"SELECT doc_id, {_SENTIMENT} AS label FROM labels"),
    "vote": (("tok", "lab"), """
      SELECT word, label FROM (SELECT DISTINCT doc_id, word FROM tok) JOIN lab USING (doc_id)"""),
    "wlabel": (("vote",), """
      SELECT word, CASE WHEN s * 10 >= n * 7 THEN 'positive' WHEN s * 10 < n * 6 THEN 'negative'
                        ELSE 'neutral' END AS label
      FROM (SELECT word, count(*) AS n, sum(CASE label WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END) AS s
            FROM vote GROUP BY word)"""),
    "stems": (("dict",), f"""
      SELECT d.word, coalesce(b.base, d.word) AS base
      FROM dict d LEFT JOIN (
        SELECT word, arg_min(stem, length(stem)) AS base
        FROM (SELECT word, left(word, length(word) - length(s)) AS stem
              FROM (SELECT word, unnest([{_SUFFIX_LIST}]) AS s FROM dict)
              WHERE ends_with(word, s) AND length(word) > length(s) + 1)
        WHERE stem IN (SELECT word FROM dict) GROUP BY word) b ON d.word = b.word"""),
    "allstems": (("wc", "dict"), f"""
      SELECT d.word, coalesce(b.stem, d.word) AS stem
      FROM wc d LEFT JOIN (
        SELECT word, arg_min(stem, length(stem)) AS stem
        FROM (SELECT word, left(word, length(word) - length(s)) AS stem
              FROM (SELECT word, unnest([{_SUFFIX_LIST}]) AS s FROM wc)
              WHERE ends_with(word, s) AND length(word) > length(s) + 1)
        WHERE stem IN (SELECT word FROM dict) GROUP BY word) b ON d.word = b.word"""),
    "morph": (("allstems",), """
      SELECT word, stem,
             CASE WHEN word <> stem AND instr(word, stem) > 0 THEN left(word, instr(word, stem) - 1) END AS prefix,
             CASE WHEN word <> stem AND instr(word, stem) > 0
                  THEN substr(word, instr(word, stem) + length(stem)) END AS suffix,
             trim(stem) AS core_word
      FROM allstems"""),
    "descr": ((), f"SELECT * FROM (VALUES {_DESCRIPTION_ROWS}) AS t(tag, description)"),
    "tagged": (("dict", "descr"), """
      SELECT word, tag, trim(split_part(description, ',', 1)) AS pos
      FROM (SELECT word, CASE WHEN length(word) <= 2 THEN 'ADP' WHEN length(word) <= 4 THEN 'VERB'
                              WHEN length(word) <= 8 THEN 'NOUN' ELSE 'PROPN' END AS tag FROM dict)
           JOIN descr USING (tag)"""),
    "entry": (("dict", "stems", "tagged", "wlabel"), """
      SELECT d.word, d.meanings AS definitions, t.pos AS POS, coalesce(l.label, '') AS Label,
             s.base, d.synonym, d.antonym
      FROM dict d JOIN stems s ON s.word = d.word JOIN tagged t ON t.word = d.word
           LEFT JOIN wlabel l ON l.word = d.word"""),
    "enriched": (("wc", "entry"), "SELECT e.*, wc.n AS word_count FROM entry e JOIN wc ON wc.word = e.word"),
    "lex": (("enriched",), "SELECT word, definitions, word_count, POS, Label FROM enriched"),
    "lemma": (("enriched", "dict"), """
      SELECT 'LEMMATIZED' AS rel, 'WORD' AS src_type, word AS src, 'WORD' AS dst_type, base AS dst
      FROM enriched WHERE base = word OR base IN (SELECT word FROM dict)"""),
    "syn": (("enriched", "dict"), """
      SELECT DISTINCT 'SYNONYM_OF' AS rel, 'WORD' AS src_type, src, 'WORD' AS dst_type, dst
      FROM (SELECT word AS src, unnest(synonym) AS dst FROM enriched) WHERE dst IN (SELECT word FROM dict)"""),
    "ant": (("enriched", "dict"), """
      SELECT DISTINCT 'ANTONYM_OF' AS rel, 'WORD' AS src_type, src, 'WORD' AS dst_type, dst
      FROM (SELECT word AS src, unnest(antonym) AS dst FROM enriched) WHERE dst IN (SELECT word FROM dict)"""),
    "nodes": (("enriched", "lemma", "syn", "ant", "entry"), """
      SELECT word, definitions, word_count, POS, Label FROM enriched
      UNION ALL
      SELECT word, definitions, 0, POS, Label FROM entry
      WHERE word IN (SELECT dst FROM lemma UNION SELECT dst FROM syn UNION SELECT dst FROM ant)
        AND word NOT IN (SELECT word FROM enriched)"""),
    "peri": ((), f"""
      SELECT ord, peribahasa, meaning FROM (
        SELECT doc_id AS ord, {NORMALIZED.format("parts[1]")} AS peribahasa, coalesce(parts[2], '') AS meaning
        FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS parts
              FROM documents))
      WHERE peribahasa <> ''"""),
    "proverbs": (("peri",), """
      SELECT peribahasa, arg_min(meaning, ord) AS meaning FROM peri GROUP BY peribahasa"""),
    "emotion": (("dict",), f"""
      SELECT word, ([{_EMOTION_LIST}])[(length(word) % {len(EMOTIONS)}) + 1] AS label FROM dict"""),
    "sentemo": (("sent", "tok", "emotion"), """
      SELECT s.doc_id, s.sent_pos, coalesce(b.label, 'neutral') AS label
      FROM sent s LEFT JOIN (
        SELECT doc_id, sent_pos, arg_min(label, -n * 100 + rk) AS label
        FROM (SELECT doc_id, sent_pos, label, count(*) AS n,
                     row_number() OVER (PARTITION BY doc_id, sent_pos ORDER BY label) AS rk
              FROM tok JOIN emotion USING (word) GROUP BY doc_id, sent_pos, label)
        GROUP BY doc_id, sent_pos) b ON s.doc_id = b.doc_id AND s.sent_pos = b.sent_pos"""),
    "pg": ((), r"""
      SELECT page_id, url,
             regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
             regexp_extract(html, '(?is)<nav[^>]*>(.*?)</nav>', 1) AS meta,
             regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS brief,
             regexp_extract(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'),
                            '(?is)<article[^>]*>(.*?)</article>', 1) AS body
      FROM pages WHERE regexp_matches(html, '(?i)<nav')"""),
    "para": (("pg",), f"""
      SELECT page_id, list_filter(list_transform(string_split_regex(body, '(?i)<p>')[2:],
               lambda p: {text_of("string_split_regex(p, '(?i)</p>|</article>|</div>')[1]")}),
               lambda t: t <> '') AS contents
      FROM pg"""),
    "art": (("pg", "para"), f"""
      SELECT page_id, url, {text_of("title")} AS title,
             {text_of("regexp_extract(meta, '(?is)<a[^>]*>(.*?)</a>', 1)")} AS author,
             regexp_extract(meta, '(?is)<a [^>]*href="([^"]*)"', 1) AS rel_link,
             {text_of("regexp_extract(meta, '(?is)<a[^>]*>.*?</a>.*?<a[^>]*>(.*?)</a>', 1)")} AS email,
             {text_of("regexp_replace(regexp_replace(meta, '(?is)<a[^>]*>.*?</a>', ''), '(?is)<a[^>]*>.*?</a>', '')")} AS publish_text,
             {text_of("brief")} AS brief, contents
      FROM pg JOIN para USING (page_id)"""),
}


def with_ctes(*names: str) -> str:
    """``WITH`` clause of the named pieces and all they build on, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in _CTES[name][0]:
            visit(needed)
        order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({_CTES[n][1]})" for n in order) + "\n"
