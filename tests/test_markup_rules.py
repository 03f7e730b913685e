"""HTML rules on literal pages: references, table sections, anchors without address, nested tables, declarations."""

import gzip
import time
import tracemalloc
from random import Random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.functions import markup
from shelfmark.functions.html import anchors, decode_entities, tag_text
from shelfmark.functions.markup import Select, select_elements
from shelfmark.operators import extract, links
from shelfmark.sources import pages

PRICES = "<tr><td>{0}</td><td>{1}</td><td>2</td><td>3</td><td>4</td></tr>"


def page(spark, *html):
    return spark.createDataFrame([(i, f"https://h/listing{i}.htm", h) for i, h in enumerate(html)], "page_id long, url string, html string")


def test_references(spark):
    html = '<a href="/l?x=1&region=2&copy=3&amp;y=4&copy" title="&check; &copy">a &check; b &copy c &#x0000000041; &#99999999999;</a>'
    df = page(spark, html)
    a = df.select(anchors("html").alias("a")).first().a[0]
    assert a.href == "/l?x=1&region=2&copy=3&y=4©" and a.title == "✓ ©" and a.text == "a ✓ b © c A �"
    m = df.select(select_elements(F.col("html"), [Select("a", "a")]).alias("m")).first().m.a[0]
    assert m.href == a.href and m.text == a.text
    assert spark.range(1).select(decode_entities("'&amp;lt; &bogus; &lt'")).first()[0] == "&lt; &bogus; <"
    assert page(spark, "<h1>&notit;</h1>").select(tag_text("html", "h1")).first()[0] == "¬it;"


def test_price_rows_of_head_and_foot_do_not_count(spark):
    rows = "".join(PRICES.format(f"r{i}", 1000 * i + 1) for i in range(4))
    table = '<table class="table-price"><tr><td><table class="table-price-inner">{0}</table></td></tr></table>'
    head = "<thead><tr><td>x</td><td>77</td></tr></thead>"
    forms = [rows, head + rows, f"{head}<tbody>{rows}</tbody>", f"<tfoot><tr><td>f</td></tr></tfoot><tbody>{rows}</tbody>"]
    got = extract.extract_listings(page(spark, *(table.format(f) for f in forms))).select("pricing.duration_prices").collect()
    assert len({tuple(sorted(r[0].items())) for r in got}) == 1
    assert sorted(got[0][0].values()) == [2, 2, 3, 3, 4, 4, 2001, 3001]


def test_anchor_without_address_names_no_page(spark):
    df = page(spark, "<a name=n>12</a>", "<a href='/x'>7</a>", "<a href>9</a>")
    got = {r.site: r.pages for r in links.page_counts(df, F.col("page_id").cast("string")).collect()}
    assert got["0"] == 1 and got["1"] == 7


def test_any_number_of_pages(spark):
    counts = spark.createDataFrame([("a", 10**10), ("b", 3), ("c", 1), ("d", (1 << 20) + 2), ("e", 0)], "site string, pages long")
    urls = links.index_urls(counts.where("site <> 'a'"))
    assert {r.site: (r.n, r.lo, r.hi) for r in urls.groupBy("site").agg(F.count("*").alias("n"), F.min("page").alias("lo"), F.max("page").alias("hi")).collect()} == {
        "b": (3, 1, 3), "c": (1, 1, 1), "d": ((1 << 20) + 2, 1, (1 << 20) + 2),
    }
    assert links.index_urls(counts.where("site = 'a'")).limit(5).count() == 5


def test_nested_tables_stay_linear(spark):
    n = 2000
    html = "<table><tr><td>Метро</td><td>" * n + "<a href='/x'>01.02.2024</a>" + "</td></tr></table>" * n
    row = extract.extract_listings(page(spark, html)).first()
    assert row.last_updated == "01.02.2024" and row.location.stations == ["01.02.2024"]


@pytest.mark.parametrize("unit, close", [
    ("<table><tr><td>Метро</td><td>", "</td></tr></table>"),
    ("<table><tr><td>x</td><td>", "</td></tr></table>"),
    ("<table><tr class=noprint><td colspan='2'>Метро</td><td colspan='2'>12.3", "</td></tr></table>"),
    ("<b><table><td><b>", ""),
    ("<td>Метро<a>x", ""),
])
def test_time_grows_with_the_page_alone(unit, close):
    """Deep nesting costs what flat pages of the length cost: 4000 tables in a second, ten times the page in ten times the time."""
    selects = extract.SiteRules().selects()
    matcher = markup._Matcher({s.name: markup._compile(s.selector) for s in selects if s.kind != "text"})
    seconds = []
    for n in (400, 4000):
        html = unit * n + "<a href='/x'>01.02.2024</a>" + close * n
        best = 9.0
        for _ in range(3):
            start = time.process_time()
            markup.read_page(html, selects, matcher)
            best = min(best, time.process_time() - start)
        seconds.append(best)
    assert seconds[1] < 1 and seconds[1] < 30 * max(seconds[0], 0.005)


def matches(page, i, steps):
    """Whether an element matches, by going up from it step by step."""
    direct, tests, tag = steps[-1]
    if (tag and page.tag[i] != tag) or not all(test(page.attrs[i]) for test in tests):
        return False
    if len(steps) == 1:
        return True
    ancestors, i = [], page.parent[i]
    while i >= 0:
        ancestors.append(i)
        i = page.parent[i]
    return any(matches(page, a, steps[:-1]) for a in ancestors[: 1 if direct else None])


def test_matcher_equals_walking_up(small):
    """All selectors at once against one element and one selector at a time, on made-up nests of tags."""
    selectors = ["a", "div a", "div > a", "div.x p > a[href]", "ul li > a.y", "p.x", "#i a", "table tr td[colspan='2']", "div div > p", "[href^='/s']"]
    compiled = {s: markup._compile(s) for s in selectors}
    matcher, random, seen = markup._Matcher(compiled), Random(5), set()
    starts = ["<div>", "<div class=x>", "<p>", "<p class='x y'>", "<a href='/s'>", "<a class=y>", "<ul>", "<li>", "<table>", "<tr>", "<td colspan=2>", "<b id=i>"]
    ends = ["</div>", "</p>", "</a>", "</ul>", "</table>", "</b>", "text"]
    for _ in range(300):
        page = markup._Page("".join(random.choice(starts if random.random() < 0.6 else ends) for _ in range(60)))
        found = matcher.find(page)
        for s, steps in compiled.items():
            assert found[s] == [i for i in range(len(page.tag)) if matches(page, i, steps)]
            seen |= {s} if found[s] else set()
    assert seen == set(selectors)


def test_labelled_longest_and_dated_cells(spark):
    html = (
        "<table><tr><td>Метро</td><td> </td></tr><tr><td>a Метро b</td><td><a> ab </a><a>Дом\u2009</a><a>x</a></td></tr></table>"
        "<table><tr><td colspan=2>\u00a0кратко кратко кратко кратко</td></tr><tr><td colspan=2>" + "w" * 51 + " </td></tr><tr><td>1.1.20 01.02.20233 03.04.2024</td><td>no</td></tr></table>"
    )
    selects = [
        markup.Select("row", "table tr", "labelled", "Метро", 2), markup.Select("any", "table tr", "labelled", "Метро"),
        markup.Select("wide", "td[colspan='2']", "longest", least_bytes=50), markup.Select("wider", "td[colspan='2']", "longest", least_bytes=51),
        markup.Select("date", "td", "last_match", r"\d{2}\.\d{2}\.\d{4}"), markup.Select("none", "p", "last"), markup.Select("first", "td", "first"),
    ]
    got = page(spark, html).select(select_elements(F.col("html"), selects).alias("m")).first().m
    assert got.row.links == ["Дом"] and got.row.text == "ab Дом\u2009x" and got.any.links == ["ab", "Дом", "x"]
    assert got.wide == "кратко кратко кратко кратко" and got.wider is None
    assert got.date == "01.02.2023" and got.none is None and got.first == "Метро"


def test_charset_is_found_anywhere(spark):
    text = "<script>" + "x" * 5000 + "</script><meta charset={0}windows-1251>Привет"
    rows = [(i, b, e) for i, (b, e) in enumerate([
        (text.format('"').encode("cp1251"), None),
        (gzip.compress(text.format("").encode("cp1251")), "gzip"),
        ("about windows-1251, in UTF-8: Привет".encode(), None),
    ])]
    got = pages.decode_pages(spark.createDataFrame(rows, "id int, body binary, enc string"), encoding="enc").orderBy("id").collect()
    assert [r.html[-6:] for r in got] == ["Привет"] * 3


def test_image_window_only_on_request(spark):
    body = "[" + ",".join(f'{{"ID":"{i}"}}' for i in range(250)) + "]"
    df = spark.range(1)
    assert len(df.select(pages.image_records(F.lit(body))).first()[0]) == 250
    assert [x.ID for x in df.select(pages.image_records(F.lit(body), limit=2, offset=248)).first()[0]] == ["248", "249"]


def test_only_a_slice_of_a_batch_is_held_as_objects(spark, monkeypatch):
    """Four times the pages in a batch do not take more memory of Python; nulls, empty pages and pages beyond a slice keep their places."""
    caught = []

    class Marked:
        def asNondeterministic(self):
            return lambda column: None

    monkeypatch.setattr(markup.F, "arrow_udf", lambda run, ddl: caught.append(run) or Marked())
    markup.select_elements(None, [markup.Select("cells", "td"), markup.Select("low", kind="text")])
    (run,) = caught
    pages = [f"<table><tr>{f'<td>cell {i}</td>' * 40}</tr></table>" for i in range(8000)]
    pages[3], pages[5], pages[7] = None, "", "<td>x</td>" * 200_000

    def peak(n):
        batch = pa.array(pages[:n], pa.string())
        tracemalloc.start()
        result = run(batch)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return result, most

    pages[7] = "<td>x</td>" * 1000
    (small, at_small), (large, at_large) = peak(2000), peak(8000)
    assert at_large < 1.5 * at_small
    pages[7] = "<td>x</td>" * 200_000
    large = peak(8000)[0]
    assert len(large) == 8000 and len(run(pa.array([], pa.string()))) == 0
    assert [len(large[i]["cells"]) for i in (0, 3, 5, 7, 7999)] == [40, 0, 0, 200_000, 40]
    assert [large[i]["low"].as_py() for i in (3, 5)] == ["", ""] and large[7999]["cells"][0]["text"].as_py() == "cell 7999"
