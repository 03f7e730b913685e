"""One Arrow function that selects elements of a page by simple CSS selectors.

Spark has no HTML functions and its xpath needs well-formed XML.  This helper parses each
page once and returns, for every named selector, the matches as arrays; all rules on top
of them (typing, prices, fallbacks, longest text …) are Spark expressions in
:mod:`shelfmark.operators.extract`.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from html import unescape
from html.entities import html5
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tasks get this module's functions by value: executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

# Fixed values of HTML: elements without content, and which open elements a start tag closes.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {
    **dict.fromkeys("address article aside blockquote div dl footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), {"p"}),
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "option": {"option"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "tr": {"tr", "td", "th", "p"},
    "tbody": {"tr", "td", "th", "thead", "tbody", "p"},
    "tfoot": {"tr", "td", "th", "thead", "tbody", "p"},
}
SCOPES = {"table", "ul", "ol", "dl", "select", "html", "body"}

#: Pages that are held as Python objects at a time.
SLICE_BYTES, SLICE_PAGES = 1 << 20, 500


@dataclass(frozen=True)
class Select:
    """What to read from a page.

    ``kind`` says what to return:

    * ``nodes``: text, href and class of each match;
    * ``first``, ``last``: the text of the first or the last match;
    * ``rows``: cell texts and link texts per cell of each matching table row;
    * ``price_rows``: the cell texts of the matching rows numbered ``wanted``, counted in the
      table body (rows of a head or foot are left out), None where there is none;
    * ``labelled``: of the first matching row whose first cell holds ``word`` and whose second is
      usable, that cell's text and link texts, trimmed; usable is a text, or with
      ``least_bytes`` a link text longer than that, and only such ones are returned, none that
      lies in another;
    * ``longest``: the trimmed text with the most bytes, if more than ``least_bytes``;
    * ``last_match``: what the pattern ``word``, without anchors, finds first in the last match that has it;
    * ``text``: the text of the whole page, lower-cased, without a selector;
    * ``flag``: whether the first match, or else the first telephone link of the page, holds a
      value; the value itself never leaves the function.

    Cells may hold tables; all but ``nodes`` and ``rows`` return no more than the page is long.
    """

    name: str
    selector: str = ""
    kind: str = "nodes"
    word: str = ""
    least_bytes: int = 0
    wanted: tuple[int, ...] = ()


_NODE = pa.struct([("text", pa.string()), ("href", pa.string()), ("class", pa.string())])
_ROW = pa.struct([("cells", pa.list_(pa.string())), ("links", pa.list_(pa.list_(pa.string())))])
_LABELLED = pa.struct([("text", pa.string()), ("links", pa.list_(pa.string()))])
_ARROW = {
    "nodes": pa.list_(_NODE), "rows": pa.list_(_ROW), "flag": pa.bool_(), "price_rows": pa.list_(pa.list_(pa.string())),
    "labelled": _LABELLED, **dict.fromkeys(("first", "last", "longest", "last_match", "text"), pa.string()),
}
_DDL = {
    "nodes": "array<struct<text:string,href:string,class:string>>",
    "rows": "array<struct<cells:array<string>,links:array<array<string>>>>",
    "flag": "boolean",
    "price_rows": "array<array<string>>",
    "labelled": "struct<text:string,links:array<string>>",
    **dict.fromkeys(("first", "last", "longest", "last_match", "text"), "string"),
}


# What shelfmark.functions.text.trim_space strips.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_SPACE_CODES = np.array(sorted(map(ord, _SPACES)), np.uint32)

# Comment or declaration; element whose content is text only; end tag; start tag; text.
# Every alternative may also end with the page and none gives back what it took, so the time
# is linear in the page whatever it holds.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(script|style|title|textarea)\b([^>]*+)(?:>|\Z)(.*?)(?:</\1\s*>|\Z)"""
    r"""|</([a-z][^\s/>]*+)[^>]*+(?:>|\Z)"""
    r"""|<([a-z][^\s/>]*+)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)"""
    r"""|([^<]+|<)""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")


_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|([A-Za-z][A-Za-z0-9]*;?))")


def _attribute_text(value: str) -> str:
    """References in an attribute: a name without its semicolon counts only if neither = nor a letter or digit follows."""

    def character(m: re.Match) -> str:
        name = m[1]
        if name is None:
            return unescape(m[0])
        if not name.endswith(";") and value[m.end() : m.end() + 1] == "=":
            return m[0]
        return html5.get(name, m[0])

    return _REFERENCE.sub(character, value) if "&" in value else value


class _Page:
    """Flat element table in page order: tag, attributes, parent, and where the element ends.

    ``span`` holds first and end text chunk and the end of the element's descendants, which
    follow it directly, so "inside" is a range test.  The page's text is joined once; the text of an
    element is a range of it, whose trimmed ends and bytes are looked up, not counted.
    """

    def __init__(self, html: str):
        self.tag, self.attrs, self.parent, self.span, self.open = [], [], [], [], []
        self.open_at, self.scopes = {}, []  # depths of the open elements, by tag, and of the open scopes
        chunks = self.chunks = []
        for token in _TOKEN.finditer(html):
            raw, raw_attrs, content, end, start, attrs, text = token.groups()
            if text:
                chunks.append(unescape(text) if "&" in text else text)
            elif start:
                self._start(start.lower(), attrs)
            elif end:
                self._end(end.lower())
            elif raw:
                self._start(raw.lower(), raw_attrs)
                chunks.append(unescape(content) if raw.lower() in ("title", "textarea") else content)
                self._pop()
        while self.open:
            self._pop()
        self.full = "".join(chunks)
        self.at = [0, *accumulate(map(len, chunks))]

    def _pop(self):
        i = self.open.pop()
        self.open_at[self.tag[i]].pop()
        if self.tag[i] in SCOPES:
            self.scopes.pop()
        self.span[i][1:] = len(self.chunks), len(self.tag)

    def _start(self, tag: str, attrs: str):
        # Close from the outermost element this tag ends, but not past a table or list.
        inner, cut = self.scopes[-1] if self.scopes else -1, len(self.open)
        for name in CLOSES.get(tag, ()):
            depths = self.open_at.get(name)
            if depths and depths[-1] > inner:
                cut = min(cut, depths[bisect_right(depths, inner)])
        while len(self.open) > cut:
            self._pop()
        self.tag.append(tag)
        found = {}
        for name, *values in _ATTRIBUTE.findall(attrs) if attrs else ():
            value = values[0] or values[1] or values[2]
            found.setdefault(name.lower(), _attribute_text(value))
        self.attrs.append(found)
        self.parent.append(self.open[-1] if self.open else -1)
        self.span.append([len(self.chunks), len(self.chunks), len(self.tag)])
        if tag not in VOID:
            self.open_at.setdefault(tag, []).append(len(self.open))
            if tag in SCOPES:
                self.scopes.append(len(self.open))
            self.open.append(len(self.tag) - 1)

    def _end(self, tag: str):
        if self.open_at.get(tag):
            while self.tag[self.open[-1]] != tag:
                self._pop()
            self._pop()

    def range(self, i) -> tuple[int, int]:
        """Where the text of an element begins and ends."""
        first, end, _ = self.span[i]
        return self.at[first], self.at[end]

    def text(self, i):
        begin, end = self.range(i)
        return self.full[begin:end]

    def inside(self, i, indexes, most=None):
        """The members of an ascending index list that lie inside element ``i``, the first ``most`` of them."""
        first, end = bisect_right(indexes, i), bisect_left(indexes, self.span[i][2])
        return indexes[first : end if most is None else min(end, first + most)]

    @cached_property
    def codes(self):
        return np.frombuffer(self.full.encode("utf-32-le", "surrogatepass"), "<u4")

    @cached_property
    def solid(self):
        """Positions of the characters that trimming leaves."""
        return np.flatnonzero(~np.isin(self.codes, _SPACE_CODES))

    @cached_property
    def bytes_at(self):
        """Bytes of UTF-8 before each position."""
        sizes = 1 + (self.codes >= 0x80) + (self.codes >= 0x800) + (self.codes >= 0x10000)
        return np.concatenate([[0], np.cumsum(sizes)])

    def trimmed(self, i) -> tuple[int, int]:
        """Where the text of an element begins and ends without the white space around it."""
        begin, end = self.range(i)
        first, after = np.searchsorted(self.solid, (begin, end))
        return (int(self.solid[first]), int(self.solid[after - 1]) + 1) if first < after else (begin, begin)

    def n_bytes(self, begin: int, end: int) -> int:
        return int(self.bytes_at[end] - self.bytes_at[begin])


_SIMPLE = re.compile(r"""(\w+)|#([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:([*^$]?=)["']?([^"'\]]*)["']?)?\]""")
_TESTS = {
    "=": lambda have, want: have == want,
    "*=": lambda have, want: want in have,
    "^=": lambda have, want: have.startswith(want),
    "$=": lambda have, want: have.endswith(want),
}


def _compile(selector: str):
    """``a.b > c[d^='e']`` to steps [(needs_direct_parent, [test(attrs)], tag or None)]."""
    steps, direct = [], False
    for part in re.findall(r"""(?:\[[^\]]*\]|[^\s>\[])+|>""", selector):
        if part == ">":
            direct = True
            continue
        tests, name = [], None
        for tag, ident, cls, attr, op, value in _SIMPLE.findall(part):
            if tag:
                name = tag
            elif ident:
                tests.append(lambda a, x=ident: a.get("id") == x)
            elif cls:
                tests.append(lambda a, x=cls: x in a.get("class", "").split())
            else:
                tests.append(lambda a, k=attr, o=op, x=value: k in a and (not o or _TESTS[o](a[k], x)))
        steps.append((direct, tests, name))
        direct = False
    return steps


class _Matcher:
    """All selectors at once: one bit for each step of each, set on an element that ends a match of the steps up to it.

    Elements come in page order, parents first. A step is tried where the step before it stands among the element's ancestors
    (or on its parent), which is one test of a bit set, so the time does not depend on how deep elements are nested.
    """

    def __init__(self, selectors: dict[str, list]):
        self.by_tag, self.any_tag, self.last = {}, [], {}
        bit = 1
        for name, steps in selectors.items():
            before = 0
            for direct, tests, tag in steps:
                (self.by_tag.setdefault(tag, []) if tag else self.any_tag).append((bit, before, direct, tests))
                before, bit = bit, bit << 1
            self.last[name] = before

    def find(self, page: _Page) -> dict[str, list[int]]:
        own, above = [], []  # bits of an element, and of it and all its ancestors
        found = {name: [] for name in self.last}
        ends = {bit: found[name] for name, bit in self.last.items()}
        final = sum(ends)
        for i, tag in enumerate(page.tag):
            parent, attrs, bits = page.parent[i], page.attrs[i], 0
            up, higher = (own[parent], above[parent]) if parent >= 0 else (0, 0)
            for bit, before, direct, tests in (*self.by_tag.get(tag, ()), *self.any_tag):
                if (not before or (up if direct else higher) & before) and all(test(attrs) for test in tests):
                    bits |= bit
            own.append(bits)
            above.append(higher | bits)
            if bits & final:
                for bit, indexes in ends.items():
                    if bits & bit:
                        indexes.append(i)
        return found


def _node(page, i):
    return {"text": page.text(i), "href": page.attrs[i].get("href"), "class": page.attrs[i].get("class", "")}


def _row(page, i, tag_index):
    cells = page.inside(i, tag_index.get("td", []))
    links = [[page.text(a) for a in page.inside(c, tag_index.get("a", []))] for c in cells]
    return {"cells": [page.text(c) for c in cells], "links": links}


def _trimmed(page, i):
    begin, end = page.trimmed(i)
    return page.full[begin:end]


def _price_rows(page, found, tag_index, s):
    body = [i for i in found if page.parent[i] < 0 or page.tag[page.parent[i]] not in ("thead", "tfoot")]
    rows = [body[n] if n < len(body) else None for n in s.wanted]
    return [None if i is None else [page.text(c) for c in page.inside(i, tag_index.get("td", []), 5)] for i in rows]


def _places(text: str, word: str) -> list[int]:
    """Every place of ``word`` in ``text``, ascending."""
    places, at = [], text.find(word)
    while at >= 0:
        places.append(at)
        at = text.find(word, at + 1)
    return places


def _labelled(page, found, tag_index, s):
    cells_of, places = tag_index.get("td", []), _places(page.full, s.word) if s.word else [0]
    links = [a for a in tag_index.get("a", ()) if page.n_bytes(*page.trimmed(a)) > s.least_bytes]
    for i in found:
        cells = page.inside(i, cells_of, 2)
        if len(cells) < 2:
            continue
        begin, end = page.range(cells[0])
        at = bisect_left(places, begin)
        if s.word and (at == len(places) or places[at] + len(s.word) > end):
            continue
        begin, end = page.trimmed(cells[1])
        usable = page.inside(cells[1], links, 1) if s.least_bytes else end > begin
        if usable:
            outer, after = [], -1
            for a in page.inside(cells[1], links):
                if a >= after:
                    outer.append(_trimmed(page, a))
                    after = page.span[a][2]
            return {"text": page.full[begin:end], "links": outer}
    return None


def _longest(page, found, s):
    best, most = None, s.least_bytes
    for i in found:
        n = page.n_bytes(*page.trimmed(i))
        if n > most:
            best, most = i, n
    return None if best is None else _trimmed(page, best)


def _last_match(page, found, s):
    pattern = re.compile(s.word)
    # Where a match may begin, overlapping ones included; one that does not end inside the element is no match there.
    starts = [m.start() for m in re.finditer(f"(?={s.word})", page.full)]
    for i in reversed(found):
        begin, end = page.range(i)
        for at in range(bisect_left(starts, begin), bisect_left(starts, end)):
            if m := pattern.match(page.full, starts[at], end):
                return m[0]
    return None


def _flag(page, found, tag_index):
    tel = [i for i in tag_index.get("a", ()) if page.attrs[i].get("href", "").startswith("tel:")]
    first = page.attrs[found[0]].get("href", "") if found else ""
    own = first[4:] if first.startswith("tel:") else page.text(found[0]) if found else ""
    return bool(own.strip()) or bool(tel and page.attrs[tel[0]]["href"][4:].strip())


def read_page(html: str | None, selects: list[Select], matcher: _Matcher) -> dict:
    page = _Page(html or "")
    matches = matcher.find(page)
    tag_index: dict[str, list[int]] = {}
    for i, tag in enumerate(page.tag):
        tag_index.setdefault(tag, []).append(i)
    out = {}
    for s in selects:
        if s.kind == "text":
            out[s.name] = page.full.lower()
            continue
        found = matches[s.name]
        if s.kind in ("first", "last"):
            out[s.name] = page.text(found[0 if s.kind == "first" else -1]) if found else None
        elif s.kind == "nodes":
            out[s.name] = [_node(page, i) for i in found]
        elif s.kind == "rows":
            out[s.name] = [_row(page, i, tag_index) for i in found]
        elif s.kind == "price_rows":
            out[s.name] = _price_rows(page, found, tag_index, s)
        elif s.kind == "labelled":
            out[s.name] = _labelled(page, found, tag_index, s)
        elif s.kind == "longest":
            out[s.name] = _longest(page, found, s)
        elif s.kind == "last_match":
            out[s.name] = _last_match(page, found, s)
        else:
            out[s.name] = _flag(page, found, tag_index)
    return out


def _slices(pages: pa.Array) -> Iterator[pa.Array]:
    """The pages in order, a page or up to SLICE_BYTES of them at a time."""
    ends, begin = np.cumsum(pc.coalesce(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = min(max(begin + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))), begin + SLICE_PAGES)
        yield pages.slice(begin, end - begin)
        begin = end


def select_elements(html: Column, selects: list[Select]) -> Column:
    """Struct column with one field per selector; each page is parsed once.

    Marked non-deterministic so that no filter on a field is pushed below it, which would
    parse every page a second time.
    """
    arrow_type = pa.struct([(s.name, _ARROW[s.kind]) for s in selects])
    ddl = "struct<" + ",".join(f"`{s.name}`:{_DDL[s.kind]}" for s in selects) + ">"

    def run(pages: pa.Array) -> pa.Array:
        pa.default_memory_pool().release_unused()  # what the batch before took
        matcher = _Matcher({s.name: _compile(s.selector) for s in selects if s.kind != "text"})
        # Only a slice of pages is held as Python objects, whatever the batch holds.
        read = (pa.array([read_page(h, selects, matcher) for h in part.to_pylist()], type=arrow_type) for part in _slices(pages))
        return pa.concat_arrays([pa.array([], arrow_type), *read])

    # Explicit types: with postponed annotations the function kind cannot be inferred.
    run.__annotations__ = {"pages": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ddl).asNondeterministic()(html)
