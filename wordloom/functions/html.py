"""Field extraction from raw HTML with regular expressions and folds."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions.arrays import after, bound
from wordloom.functions.phrases import WIDE_SPACE, collapse_spaces, trim_all

# The named character references of the HTML standard, from the table of Python's library.
NAMED = {name.removesuffix(";"): sign for name, sign in sorted(html5.items()) if name.endswith(";")}
REFERENCE = r"&(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]{1,31});"
PAIR = r"(?i)&#(?:x(d[89ab][0-9a-f]{2})|(5[5-6][0-9]{3}));&#(?:x(d[c-f][0-9a-f]{2})|(5[6-7][0-9]{3}));"
SCRIPT_OR_STYLE = r"(?is)<(script|style)[^>]*>.*?</(script|style)>"
TAG = r"<[^>]+>"


def opening(tag: str, css_class: str | None = None) -> str:
    """Pattern of an opening tag, with that exact class text where one is given."""
    if css_class is None:
        return rf"(?is)<{tag}(?:\s[^>]*)?>"
    return rf"(?is)<{tag}\s[^>]*class=\"{css_class}\"[^>]*>"


def _code(reference: Column) -> Column:
    """Number of a reference ``#...`` or ``#x...``."""
    hexadecimal = F.conv(F.substring(reference, 3, 8), 16, 10)
    decimal = F.substring(reference, 2, 8)
    return F.when(F.lower(F.substring(reference, 2, 1)) == "x", hexadecimal).otherwise(decimal).cast("int")


def _character(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _names() -> Column:
    """The named references by their first letter: a constant, folded once, that is searched in two short steps."""
    by_letter: dict[str, list[str]] = {}
    for name, sign in NAMED.items():
        by_letter.setdefault(name[0], []).append(f"{name}\x01{sign}")
    maps = {a: F.str_to_map(F.lit("\x02".join(pairs)), F.lit("\x02"), F.lit("\x01")) for a, pairs in by_letter.items()}
    return F.create_map(*[x for a, names in maps.items() for x in (F.lit(a), names)])


def _decoded(reference: Column) -> Column:
    """What a reference stands for; null for an unknown name or a number that is no character."""
    named = F.try_element_at(F.try_element_at(_names(), F.substring(reference, 1, 1)), reference)
    code = _code(reference)
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(reference.startswith("#"), F.when(valid, _character(code))).otherwise(named)


def decode_entities(text: Column) -> Column:
    """Character references decoded once, from left to right; unknown ones stay as they are.

    Two references that are the halves of a surrogate pair are one character. The text is taken
    apart at its references, so that what a reference gives is not read as another one.
    """
    pairs = F.array_distinct(F.regexp_extract_all(text, F.lit(PAIR), F.lit(0)))

    def joined(acc: Column, pair: Column) -> Column:
        halves = F.transform(F.regexp_extract_all(pair, F.lit(REFERENCE), F.lit(1)), _code)
        high, low = F.get(halves, F.lit(0)) - 0xD800, F.get(halves, F.lit(1)) - 0xDC00
        code = 0x10000 + high * 1024 + low
        right = high.between(0, 1023) & low.between(0, 1023)
        return F.when(right, F.replace(acc, pair, F.concat(F.lit("&#"), code.cast("string"), F.lit(";")))).otherwise(acc)

    whole = F.aggregate(pairs, text, joined)
    between = F.split(whole, REFERENCE)
    found = F.regexp_extract_all(whole, F.lit(REFERENCE), F.lit(1))
    signs = F.transform(found, lambda r: F.coalesce(_decoded(r), F.concat(F.lit("&"), r, F.lit(";"))))
    mixed = F.zip_with(between, signs, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(mixed, "")).otherwise(text)


def text_of(fragment: Column) -> Column:
    """Visible text: tags become spaces, entities are decoded, white space collapses."""
    return collapse_spaces(decode_entities(F.regexp_replace(fragment, TAG, " ")))


def joined_text_of(fragment: Column) -> Column:
    """Visible text with the text nodes trimmed and set side by side."""
    bare = F.regexp_replace(fragment, rf"[{WIDE_SPACE}]*{TAG}[{WIDE_SPACE}]*", "")
    return trim_all(decode_entities(bare))


def without_scripts(html: Column) -> Column:
    return F.regexp_replace(html, SCRIPT_OR_STYLE, "")


def has_element(html: Column, tag: str, css_class: str | None = None) -> Column:
    return F.rlike(html, F.lit(opening(tag, css_class)))


def element(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Inner HTML of the first such element, '' where there is none.

    Elements of the same name inside it are followed to their own end: the rest of the
    page is cut before each opening and closing tag and folded with a depth counter, which
    gives the number of pieces inside. The fold carries numbers only, so it is linear.
    """
    rest = F.get(F.split(html, opening(tag, css_class), 2), F.lit(1))
    pieces = F.split(rest, rf"(?i)(?=<{tag}[\s>]|</{tag}\s*>)")
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(state: Column, piece: Column) -> Column:
        opens = F.rlike(piece, F.lit(rf"(?i)^<{tag}[\s>]")).cast("int")
        closes = F.rlike(piece, F.lit(rf"(?i)^</{tag}\s*>")).cast("int")
        depth, at = state["depth"] + opens - closes, state["at"] + 1
        ended = F.struct(depth.alias("depth"), at.alias("at"), F.when(depth <= 0, at).otherwise(0).alias("end"))
        return F.when(state["end"] > 0, state).otherwise(ended)

    def inside(pieces: Column) -> Column:
        return F.aggregate(
            pieces, start, step,
            lambda state: F.when(state["end"] > 0, state["end"] - 1).otherwise(state["at"]),
        )

    inner = bound(pieces, lambda p: F.array_join(F.slice(p, 1, inside(p)), ""))
    return F.coalesce(inner, F.lit(""))


def drop_elements(html: Column, tag: str, css_class: str) -> Column:
    """Remove flat elements of that class, such as advertisement blocks."""
    return F.regexp_replace(html, opening(tag, css_class) + rf".*?</{tag}\s*>", "")


def paragraphs(html: Column) -> Column:
    """Non-empty paragraph texts in order; unclosed paragraphs end where the next starts."""
    pieces = F.split(without_scripts(html), r"(?i)<p(?:\s[^>]*)?>")
    bodies = after(pieces, 1)
    texts = F.transform(bodies, lambda p: text_of(F.split(p, "(?i)</p>|</article>|</div>")[0]))
    return F.filter(texts, lambda t: t != "")


def links(html: Column) -> Column:
    """All link targets in order."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1))


def link_texts(html: Column) -> Column:
    found = F.regexp_extract_all(html, F.lit(r"(?is)<a(?:\s[^>]*)?>(.*?)</a>"), F.lit(1))
    return F.transform(found, text_of)


def links_after_heading(html: Column, heading: str) -> Column:
    """Link texts between each bold ``heading`` and the next bold text."""
    parts = F.split(html, rf"(?is)<b(?:\s[^>]*)?>\s*{heading}\s*</b>")
    sections = after(parts, 1)
    return F.flatten(F.transform(sections, lambda s: link_texts(F.split(s, r"(?i)<b[\s>]")[0])))


def list_after_heading(html: Column, words: str) -> Column:
    """Items of the first ordered list after the first ``h2`` whose text has ``words``."""
    pieces = F.split(html, r"(?i)<h2(?:\s[^>]*)?>")
    sections = after(pieces, 1)
    hit = F.array_position(
        F.transform(
            sections, lambda s: F.contains(text_of(F.split(s, "(?i)</h2>")[0]), F.lit(words))
        ),
        F.lit(True),
    )
    rest = F.array_join(after(sections, F.greatest(hit, F.lit(1)).cast("int") - 1), " ")
    ordered = F.regexp_extract(rest, r"(?is)<ol(?:\s[^>]*)?>(.*?)</ol>", 1)
    items = F.split(ordered, r"(?i)<li(?:\s[^>]*)?>")
    texts = F.transform(after(items, 1), text_of)
    return F.when(hit > 0, texts).otherwise(F.array().cast("array<string>"))


def table_rows(html: Column) -> Column:
    """Cells of every table row but each table's first; rows as arrays of inner HTML."""
    tables = F.split(html, r"(?i)<table(?:\s[^>]*)?>")

    def rows_of(table: Column) -> Column:
        rows = F.split(F.split(table, "(?i)</table>")[0], r"(?i)<tr(?:\s[^>]*)?>")
        return F.transform(after(rows, 2), cells_of)

    def cells_of(row: Column) -> Column:
        cells = F.split(F.split(row, "(?i)</tr>")[0], r"(?i)<td(?:\s[^>]*)?>")
        return F.transform(after(cells, 1), lambda c: F.split(c, "(?i)</td>|<th")[0])

    return F.flatten(F.transform(after(tables, 1), rows_of))
