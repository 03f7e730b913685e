import gzip
import json

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import html as H
from shelfmark.functions import urls as U
from shelfmark.operators import extract, links
from shelfmark.operators.flatten import flatten
from shelfmark.sources import export, pages, quality

INDEX = """<html><!-- <a href="/listing1">no</a> --><body>
<a href="/listing5">a</a><a href='listing6.htm' title="t"> </a><A HREF=http://o/id7><b>x</b></A>
<a href="//cdn/id8">x</a><a href="/covid19">x</a><a href="/LISTING9">x</a><a href="/listing5">b</a>
<a href=" ">x</a><a href="/about">x</a><a href="mailto:x">x</a><a name="id10">x</a>
<script>var s = '<a href="/id11">x</a>';</script></body></html>"""


def page(spark, html, url="https://h/"):
    return spark.createDataFrame([(1, url, html)], "page_id int, url string, html string")


def test_links(spark):
    found = links.page_links(page(spark, INDEX), F.lit("https://h"), dedup=True).orderBy("pos").collect()
    assert [(r.url, r.title, r.id) for r in found] == [
        ("https://h/listing5", "a", "5"),
        ("https://h/listing6.htm", "t", "6"),
        ("http://o/id7", "x", "7"),
        ("https://h//cdn/id8", "x", "8"),
        ("https://h/covid19", "x", "19"),
        ("https://h/LISTING9", "x", ""),
    ]
    assert links.page_links(page(spark, INDEX), F.lit("https://h")).count() == 7
    assert links.page_links(page(spark, INDEX), F.lit("https://h"), words=None).count() == 9


def test_exclusion_is_off_unless_asked_for(spark):
    df = spark.createDataFrame([("https://h/id5?page=2",), ("https://h/about",)], "u string")
    assert [r[0] for r in df.select(U.is_listing_link("u")).collect()] == [True, False]
    assert [r[0] for r in df.select(U.is_listing_link("u", exclude=U.EXCLUDED_PARTS)).collect()] == [False, False]


def test_keys(spark):
    urls = ["x/user7/id9", "x/77", "x/77/", "x/77.htm", "/ID5", "x/listing12.htm"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(U.key_from_url("u")).collect()] == ["7", "77", "77", "", "", "12"]
    assert [r[0] for r in df.select(U.listing_key("u")).collect()] == ["", "", "", "", "", "12"]


@pytest.mark.parametrize(
    "html, n",
    [
        ('<a href="?page=3">x</a><a href="/">12</a>', 12),
        ('<a href="?PAGE=30">x</a><a href="/">12</a>', 30),
        ('<a href="/?top=5">x</a>', 5),
        ('<a href="?страница=8">x</a>', 8),
        ("<p>1 2 3 4 5 ... 145</p>", 145),
        ('<a href="?page=2">x</a> 1 2 3 4 5 ... 145', 2),
        ("nothing", 1),
    ],
)
def test_page_count(spark, html, n):
    assert links.page_counts(page(spark, html), F.lit("s")).first().pages == n


def test_index_urls(spark):
    df = spark.createDataFrame([("https://h", 2)], "site string, pages bigint")
    got = [tuple(r) for r in links.index_urls(df).orderBy("page").collect()]
    assert got == [("https://h", 1, "https://h", "https://h/p1"), ("https://h", 2, "https://h/?page=2", "https://h/p2")]


def test_unclosed_anchor_ends_at_the_next(spark):
    got = page(spark, '<a href="/id1">one<a href="/id2">two').select(F.explode(H.anchors("html"))).select("col.*")
    assert [(r.href, r.text) for r in got.collect()] == [("/id1", "one"), ("/id2", "two")]


DETAIL = """<html><head><title>t</title></head><body>
<h1 class="breadcrumbs"><span> Lamp </span></h1>
<span id="attr-width"> 17 </span><span id="attr-height">1.5</span><b id="attr-color"> red</b>
<div id="contact"><a href="tel:+1 234">+1 234</a></div>
<table class="table-price"><tr><td><table class="table-price-inner">
<tr><td>h</td></tr><tr><td>h</td></tr>
<tr><td>here</td><td>5\u202f000₽</td><td>9 000 ₽</td><td>6\u2009000</td></tr>
<tr><td>away</td><td>700</td></tr></table></td></tr></table>
<table class="tags"><tr><td><a href="/t1">one</a><a href="/t2" class="big noservice">two</a><a href="/t1">one</a><a href="/t3"> </a></td></tr></table>
<a href="/metro/1">Юг</a><a href="/metro/2">ab</a><a href="/district/1">D1</a><a href="/district/2">D2</a>
<p class="description"></p>
<table><tr><td colspan="2">{long}</td></tr><tr class="noprint"><td>01.02.2023</td><td>upd 03.02.2024</td></tr></table>
Апартаменты</body></html>""".replace("{long}", "z" * 60)


def record(spark, html, rules=extract.SiteRules(), url="https://h/listing12.htm", **options):
    return extract.extract_listings(page(spark, html, url), rules, **options).first()


def test_listing_record(spark):
    r = record(spark, DETAIL)
    assert (r.id, r.title, r.has_contact) == ("12", "Lamp", True)
    assert r.attrs.num == {"width": 17, "height": 0} and r.attrs.str == {"color": "red", "material": ""}
    assert r.pricing.duration_prices == {
        "apartments_day_hour": 5000, "apartments_day_2hour": 0, "apartments_night_hour": 6000, "apartments_night_2hour": 0,
        "outcall_day_hour": 700, "outcall_day_2hour": 0, "outcall_night_hour": 0, "outcall_night_2hour": 0,
    }
    assert r.tags.available == ["one", "one"] and r.tags.meeting_type == "apartment"
    assert r.location.stations == ["Юг"] and r.location.district == "D2" and r.location.city == "Moscow"
    assert (r.location.onsite, r.location.offsite) == (True, False)
    assert r.description == "" and r.last_updated == "03.02.2024"
    assert r.pricing.currency == "RUB" and r.photos == []
    tight = record(spark, DETAIL, extract.SiteRules(strip_price_spaces=True))
    assert tight.pricing.duration_prices["apartments_day_2hour"] == 9000


FALLBACK = """<table><tr><td>Метро:</td><td>none</td></tr><tr><td>Метро</td><td><a href="/x">Парк</a><a>y</a></td></tr>
<tr><td>Метро</td><td><a>Late</a></td></tr><tr><td>Район</td><td> </td></tr><tr><td>Район</td><td> North </td></tr></table>
<table><tr><td colspan=2>{a}</td></tr><tr><td colspan=2>{b}</td></tr><tr><td>10.10.2020</td><td>11.11.2021 12.12.2022</td></tr></table>
<span id="place-city"> </span><a href="tel:"> </a> выезд принимаю""".replace("{a}", "я" * 40).replace("{b}", "z" * 80)


def test_fallbacks(spark):
    r = record(spark, FALLBACK, url="https://h/none")
    assert r.id == "" and r.has_contact is False and r.title == ""
    assert r.location.stations == ["Парк"] and r.location.district == "North" and r.location.city == ""
    # Equal byte lengths: the first of them; a date counts in the last cell that has one.
    assert r.description == "я" * 40 and r.last_updated == "11.11.2021"
    assert (r.location.onsite, r.location.offsite, r.tags.meeting_type) == (True, True, "outcall")
    flat = flatten(extract.extract_listings(page(spark, FALLBACK))).first()
    assert flat.location_city == "Unknown" and flat.price_hour == 0


def test_contact_fallback_and_text_number(spark):
    assert record(spark, '<div id="contact"><a>8 800</a></div>').has_contact is True
    assert record(spark, '<div id="contact"><a> </a></div><a href="tel:1">x</a>').has_contact is True
    assert record(spark, "<p>call me</p>").has_contact is False


def test_implied_end_tags(spark):
    html = "<table><tr><td>a<td>b<tr><td>c</table><ul><li>1<li>2<ul><li>3</ul></ul><p>x<div>y</div>"
    from shelfmark.functions.markup import Select

    selects = [Select("rows", "tr", "rows"), Select("li", "ul > li"), Select("p", "p")]
    m = extract.select_from_pages(page(spark, html), selects).first()._m
    assert [r.cells for r in m.rows] == [["a", "b"], ["c"]]
    assert [n.text for n in m.li] == ["1", "23", "3"] and [n.text for n in m.p] == ["x"]


def test_photos(spark):
    body = json.dumps([{"BIMG": f"/{i}.jpg", "ID": i, "LIKEClASS": "x"} for i in range(120)])
    df = page(spark, "<p>x</p>").withColumn("images", pages.image_records(F.lit(body)))
    r = extract.extract_listings(df, extract.SiteRules(image_prefix="https://i"), images="images").first()
    assert len(r.photos) == 120 and r.photos[:2] == ["https://i/0.jpg", "https://i/1.jpg"]
    for bad in ("not json", "{", None, ""):
        assert spark.range(1).select(pages.image_records(F.lit(bad))).first()[0] == []
    assert [x.ID for x in spark.range(1).select(pages.image_records(F.lit(body), 2, 5)).first()[0]] == ["5", "6"]


def test_decode(spark):
    cp = "Привет".encode("cp1251")
    head = b'<meta charset="windows-1251">'
    late = b"x" * 2000 + "я windows-1251".encode()
    rows = [
        (1, "ok я".encode(), None, 200),
        (2, head + cp, None, 200),
        (3, b"a\xc3b", None, 200),
        (4, gzip.compress(head + cp), "gzip", 200),
        (5, b"not gzip", "gzip", 200),
        (6, b"x", None, 404),
        (7, b"x", None, None),
        (8, late, None, 200),
    ]
    df = spark.createDataFrame(rows, "id int, body binary, enc string, status int")
    got = {r.id: r for r in pages.decode_pages(df, encoding="enc", status="status").collect()}
    assert got[1].html == "ok я" and got[2].html.endswith("Привет") and got[3].html == "ab" and got[4].html.endswith("Привет")
    assert [got[i].error_type for i in range(1, 9)] == [None, None, None, None, "decode", "status", "status", None]
    assert got[6].error_message == "status 404" and got[7].error_message == "status missing" and got[5].html is None
    assert got[8].html == late.decode()
    by_word = pages.decode_pages(df, encoding="enc", status="status", charset="word").filter("id = 8").first()
    assert by_word.html == late.decode("cp1251")


def test_dead_letters(spark, tmp_path):
    df = spark.createDataFrame([(1, "u1"), (2, ""), (3, "u3")], "id int, url string")
    checked = quality.with_outcome(df, {"no_url": F.when(F.col("url") == "", F.lit("empty"))})
    good, failed = quality.write_split(checked, str(tmp_path / "split"))
    assert sorted(r.id for r in good.collect()) == [1, 3] and good.columns == ["id", "url"]
    errors = quality.error_rows(failed, F.col("url"), F.col("id")).collect()
    assert [(r.error_type, r.error_message, r.source) for r in errors] == [("no_url", "empty", "2")]


def test_export(spark, tmp_path):
    found = links.page_links(page(spark, INDEX), F.lit("https://h"), dedup=True)
    export.export_json(found, str(tmp_path / "json"))
    export.export_urls(found, str(tmp_path / "text"))
    rows = [json.loads(line) for p in (tmp_path / "json").glob("part*") for line in p.read_text().splitlines()]
    assert {"URL": "https://h/listing5", "Title": "a", "ID": "5"} in rows and len(rows) == 6
    assert sum(len(p.read_text().splitlines()) for p in (tmp_path / "text").glob("part*")) == 6


def test_detail_pages_join_without_a_broadcast(spark, tmp_path):
    from shelfmark.plans import QUERIES

    parts = [(i, f"lamp {i}", "red", "Парк", 3) for i in range(1, 41)]
    # A part that comes twice meets both of its addresses; one without a key has none.
    parts += [parts[6], (None, "none", "red", "Парк", 3)]
    schema = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"
    spark.createDataFrame(parts, schema).write.parquet(str(tmp_path / "part.parquet"))
    df = QUERIES["detail_pages"](spark, str(tmp_path))
    got = df.collect()
    assert sorted(int(r.id) for r in got) == sorted([*range(1, 41), 7, 7, 7])
    seven = [r for r in got if r.id == "7"]
    assert set(seven) == {
        ("7", "lamp 7", 3, "red", False, 300, 303, 600, "Парк", "red", "17.03.2024", "/l?x=1&region=2&copy=3")
    }
    # Listings grow with the table and are far larger than its files: no size may send them through the driver.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
