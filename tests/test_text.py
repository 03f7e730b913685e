"""Text and number helpers: values worked out by hand."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import collections as C
from shelfmark.functions import html as H
from shelfmark.functions import text as T


def one(spark, value, fn, dtype="string"):
    return spark.createDataFrame([(value,)], f"c {dtype}").select(fn(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "value, plain, tight",
    [
        ("5\u202f000₽", 5000, 5000),
        ("5\u2009000\u202f₽", 5000, 5000),
        ("5 000₽", 0, 5000),
        (" 700", 0, 700),
        ("+700", 700, 700),
        ("-5", -5, -5),
        ("12.5", 0, 0),
        ("—", 0, 0),
        ("", 0, 0),
        ("700\n", 0, 0),
        ("1e3", 0, 0),
        ("5000000000", 705032704, 705032704),
    ],
)
def test_price_keeps_the_plain_space(spark, value, plain, tight):
    assert one(spark, value, T.parse_price) == plain
    assert one(spark, value, lambda c: T.parse_price(c, strip_spaces=True)) == tight


@pytest.mark.parametrize(
    "value, bits, wrapped, checked",
    [(300, 8, 44, None), (-1, 8, 255, None), (-1, 16, 65535, None), (70000, 16, 4464, None), (-1, 32, 4294967295, None), (7, 8, 7, 7)],
)
def test_unsigned_wraps_or_is_null(spark, value, bits, wrapped, checked):
    assert one(spark, value, lambda c: T.checked_unsigned(c, bits, "wrap"), "bigint") == wrapped
    assert one(spark, value, lambda c: T.checked_unsigned(c, bits), "bigint") == checked


# Every character with the White_Space property, and some that only look like it.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=SPACES + "ax\u200b\u180e", max_size=8), min_size=30, max_size=30))
def test_trim_matches_unicode_white_space(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    got = {r.i: r.t for r in df.select("i", T.trim_space("c").alias("t")).collect()}
    assert got == {i: v.strip(SPACES) for i, v in enumerate(values)}


def test_byte_lengths_not_characters(spark):
    assert one(spark, "Юг", lambda c: T.longer_than(c, 2)) is True
    assert one(spark, "ab", lambda c: T.longer_than(c, 2)) is False


def test_dates(spark):
    assert one(spark, "seen 03.02.2024 and 04.02.2024", T.date_from_text) == "03.02.2024"
    assert one(spark, "none", T.date_from_text) == ""
    assert one(spark, "03.02.2024", T.parse_date) == dt.date(2024, 2, 3)
    assert one(spark, "99.99.2024", T.parse_date) is None


def test_keyword_class(spark):
    def pick(c):
        return T.keyword_class(c, "on", "off", ("a", "b", "both"))

    assert [one(spark, v, pick) for v in ("ON", "off", "on off", "x")] == ["a", "b", "both", ""]


def test_contacts_are_masked(spark):
    assert one(spark, "call +7 (900) 123-45-67 now", T.mask_contacts) == "call [contact] now"
    assert one(spark, "room 12 floor 3", T.mask_contacts) == "room 12 floor 3"
    assert one(spark, None, T.has_contact) is False


def test_missing_means_zero(spark):
    df = spark.createDataFrame([({"a": 1}, [None]), (None, None)], "m map<string,int>, a array<string>")
    got = df.select(C.map_get("m", "b", 0), C.has_key("m", "a"), C.has_element("a", "x"), C.size_of("a")).collect()
    assert [tuple(r) for r in got] == [(0, True, False, 1), (0, False, False, 0)]


def test_bands(spark):
    df = spark.createDataFrame([(None,), (1,), (5,), (9,), (10,)], "v int")
    got = [r[0] for r in df.select(C.bucketize("v", (5, 10), ("low", "mid", "high"))).collect()]
    assert got == [None, "low", "mid", "mid", "high"]
    with pytest.raises(ValueError):
        C.bucketize("v", (5, 5), ("a", "b", "c"))


def test_longest_takes_the_first_on_a_tie(spark):
    assert one(spark, ["aa", "я", "b"], C.longest, "array<string>") == "aa"
    assert one(spark, [], C.longest, "array<string>") is None


def test_mean_of_nothing_is_null(spark):
    assert spark.createDataFrame([], "v int").agg(C.mean("v")).first()[0] is None


@pytest.mark.parametrize(
    "value, text",
    [
        ("a &amp; b", "a & b"),
        ("&amp;lt;", "&lt;"),
        ("&eacute;&#233;&#xE9;&#x1F600; &bogus; &", "ééé😀 &bogus; &"),
        ("a &lt b &ampc", "a < b &c"),
        ("&#0;&apos;", "�'"),
        ("", ""),
    ],
)
def test_character_references(spark, value, text):
    assert one(spark, value, lambda _: H.decode_entities("c")) == text


def test_broken_pages_take_linear_time(spark):
    """Patterns that rescan would need minutes on these."""
    pages = ['<a title="' * 20000, "<" * 200000, "<a " * 60000, "<script>" * 20000, "<div>" * 20000, " " * 200000 + "x"]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    from shelfmark.functions.markup import Select, select_elements

    found = select_elements(F.col("html"), [Select("a", "a[href]"), Select("p", "div p")])
    assert df.select(F.size(H.anchors("html")), H.page_text("html"), F.size(H.paragraphs("html")), found).count() == len(pages)
    assert len(df.select(H.anchors("html").alias("a"), T.trim_space("html"), found.alias("m")).collect()) == len(pages)
