"""Regex columns over an HTML text column.

They cover flat tags, where no tree is needed, and stay inside the JVM.  Nested selectors
go through :mod:`shelfmark.functions.markup`.  Arguments name a column, or are any Spark SQL
expression of text; the result is generated as SQL text and parsed once.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import SPACE_EDGES, sql_text

# Unclosed parts end with the page (or, for a link, at the next one), as a browser has it; this
# also keeps matching linear on broken pages.
_HIDDEN = r"(?is)<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script>|\z)|style\b.*?(?:</style>|\z))"
_COMMENT_OR_TAG = r"(?s)<(?:!--.*?(?:-->|\z)|[a-zA-Z/!?][^>]*+(?:>|\z))"
_ANCHOR = r"(?is)<a(?:\s[^>]*+)?(?:>|\z).*?(?:</a>|(?=<a[\s>])|\z)"
_PARAGRAPH_START = r"(?i)<p(?:\s[^>]*)?>"
_PARAGRAPH = r"(?is)\A(.*?)(?:</p>|</?(?:article|div|ul|ol|table|h[1-6]|footer|section)\b|\z)"

# The names HTML gives to characters, from the standard library's table.
NAMED = {name.removesuffix(";"): text for name, text in html5.items()}
_REFERENCE = "(?:#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);"
# Names that count without their semicolon as well: in text always, in an attribute only where
# neither ``=`` nor a letter or digit follows.
_BARE = "(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
_BARE_ATTRIBUTE = f"{_BARE}(?![=A-Za-z0-9;])"

_fresh = count()


def _let(value: str, body: Callable[[str], str]) -> str:
    """``body`` over a value computed once; higher-order functions share no subexpressions."""
    name = f"_v{next(_fresh)}"
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def _replaced(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {sql_text(pattern)}, {sql_text(by)})"


def _extracted(x: str, pattern: str, group: int) -> str:
    return f"regexp_extract({x}, {sql_text(pattern)}, {group})"


def _visible(html: str) -> str:
    """The page without comments, scripts and styles (their content is not markup)."""
    return _replaced(html, _HIDDEN)


def _character(reference: str) -> str:
    """Character of a reference without ``&`` and ``;``, NULL when the name is unknown."""
    # Zeros in front count for nothing; a number of more than eight digits is out of range anyway.
    short = "CASE WHEN length({0}) > 8 THEN '99999999' WHEN {0} = '' THEN '0' ELSE {0} END"
    plain = {n: _let(f"ltrim('0', substr({reference}, {n}))", short.format) for n in (2, 3)}
    digits = (
        f"CASE WHEN {reference} RLIKE '^#[xX]' THEN conv({plain[3]}, 16, 10) "
        f"WHEN startswith({reference}, '#') THEN {plain[2]} END"
    )

    def numbered(n: str) -> str:
        known = f"CASE WHEN {n} BETWEEN 1 AND 55295 OR {n} BETWEEN 57344 AND 1114111 THEN {n} ELSE 65533 END"
        # Spark's char() knows Latin-1 only.
        return f"CASE WHEN {n} IS NOT NULL THEN decode(unhex(lpad(hex({known}), 8, '0')), 'UTF-32') END"

    names = f"from_json({sql_text(json.dumps(NAMED))}, 'map<string,string>')"
    return f"coalesce({_let(f'try_cast({digits} AS BIGINT)', numbered)}, try_element_at({names}, {reference}))"


def _decoded(x: str, bare: bool = True) -> str:
    either = f"{_REFERENCE}|{_BARE if bare else _BARE_ATTRIBUTE}"

    def known(piece: str, reference: str) -> str:
        return f"concat({_character(_replaced(reference, ';'))}, substr({piece}, length({reference}) + 1))"

    def rebuilt(piece: str, reference: str) -> str:
        # An unknown name may still begin with an old one, which counts in text.
        begins = _let(_extracted(piece, rf"\A{_BARE}", 0), lambda name: known(piece, name))
        return f"coalesce({known(piece, reference)}, {begins + ', ' if bare else ''}concat('&', {piece}))"

    def joined(text: str) -> str:
        piece, i = f"_v{next(_fresh)}", f"_i{next(_fresh)}"
        tail = _let(_extracted(piece, rf"\A(?:{either})", 0), lambda reference: rebuilt(piece, reference))
        pieces = f"split({text}, {sql_text(f'&(?={either})')})"
        return f"array_join(transform({pieces}, ({piece}, {i}) -> CASE WHEN {i} = 0 THEN {piece} ELSE {tail} END), '')"

    return _let(x, lambda text: f"CASE WHEN contains({text}, '&') THEN {joined(text)} ELSE {text} END")


def _inner_text(fragment: str) -> str:
    """Text of a fragment: tags out, entities decoded, ends trimmed."""
    return _replaced(_decoded(_replaced(fragment, _COMMENT_OR_TAG)), SPACE_EDGES)


def _attr(open_tag: str, attr: str, absent: str = "''") -> str:
    """Attribute of one opening tag: double-quoted, single-quoted or bare; ``absent`` when it has none."""
    value = rf"""(?is)\A<\w+\b[^>]*?\s{attr}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""

    def text(raw: str) -> str:
        return f"CASE WHEN {raw} = '' THEN {absent} ELSE {_decoded(_replaced(raw, r"""\A["']|["']\z"""), bare=False)} END"

    return _let(_extracted(open_tag, value, 1), text)


def decode_entities(text: str, bare: bool = True) -> Column:
    """Decode named and numeric character references, each once.

    ``bare`` takes the old names without a semicolon wherever they stand, as HTML does in text;
    without it only where it does so in attributes.  Text without ``&`` is passed through.
    """
    return F.expr(_decoded(text, bare))


def page_text(html: str) -> Column:
    """All text of a page, script and style text included."""
    return F.expr(_decoded(_replaced(html, _COMMENT_OR_TAG)))


def tag_text(html: str, tag: str) -> Column:
    """Text of the first ``tag`` element, '' when there is none."""
    return F.expr(_inner_text(_extracted(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)(?:</{tag}>|\z)", 1)))


def tag_attr(html: str, tag: str, attr: str) -> Column:
    """Quoted attribute of the first ``tag`` that has it, '' when there is none."""
    value = _extracted(html, rf"""(?is)<{tag}\s[^>]*?\b{attr}\s*=\s*["']([^"'>]*)""", 1)
    return F.expr(_decoded(value, bare=False))


def anchors(html: str) -> Column:
    """Every anchor in page order: ``array<struct<pos bigint, href, title, text>>``; no href is NULL."""
    found = f"regexp_extract_all({_visible(html)}, {sql_text(_ANCHOR)}, 0)"
    fields = f"{_attr('_a', 'href', 'NULL')} AS href, {_attr('_a', 'title')} AS title, {_inner_text('_a')} AS text"
    return F.expr(f"transform({found}, (_a, _pos) -> struct(CAST(_pos AS BIGINT) AS pos, {fields}))")


def paragraphs(html: str) -> Column:
    """Text of every ``<p>`` in page order; an unclosed one ends where the next block starts or ends."""
    pieces = f"filter(split({_visible(html)}, {sql_text(_PARAGRAPH_START)}), (_p, _i) -> _i > 0)"
    return F.expr(f"transform({pieces}, _p -> {_inner_text(_extracted('_p', _PARAGRAPH, 1))})")
