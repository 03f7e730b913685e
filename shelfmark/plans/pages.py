"""Queries over the page table: links, keys, page counts, text, elements, decoding."""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import functions as F

from shelfmark.functions.collections import longest, size_of
from shelfmark.functions.html import anchors, page_text, paragraphs, tag_attr, tag_text
from shelfmark.functions.markup import Select
from shelfmark.functions.text import keyword_class, longer_than, trim_space
from shelfmark.functions.urls import is_listing_link, key_from_url, listing_key, site_base
from shelfmark.operators import analytics, extract, links
from shelfmark.operators.flatten import flatten
from shelfmark.plans.registry import query, read
from shelfmark.schemas import PRICE_KEYS
from shelfmark.session import shared_folder
from shelfmark.sources import export, quality
from shelfmark.sources import pages as page_source

# SQL twins of the HTML column helpers.
SPACE = r"[\s\p{Z}]"


def sql_entities(x: str) -> str:
    names = (("&copy;", "©"), ("&middot;", "·"), ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&amp;?", "&"))
    for name, char in names:
        x = f"regexp_replace({x}, '{name}', '{char}', 'g')"
    return x


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_inner(x: str) -> str:
    return sql_trim(sql_entities(f"regexp_replace({x}, '<!--.*?-->|<[a-zA-Z/!?][^>]*>', '', 'gs')"))


def sql_tag(tag: str, of: str = "html") -> str:
    return sql_inner(rf"regexp_extract({of}, '<{tag}(?:\s[^>]*)?>(.*?)</{tag}>', 1, 'is')")


VISIBLE_SQL = r"regexp_replace(html, '<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'gis')"
BASE_SQL = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"

ANCHOR_SQL = rf"""
a AS (SELECT page_id, page_url, base, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS a
      FROM (SELECT page_id, url AS page_url, {BASE_SQL} AS base,
                   regexp_extract_all({VISIBLE_SQL}, '<a(?:\s[^>]*)?>.*?</a>', 0, 'is') AS l FROM pages)),
h AS (SELECT page_id, page_url, base, pos,
             {sql_trim(sql_entities(r"regexp_extract(a, '^<a[^>]*?\shref\s*=\s*\"([^\"]*)\"', 1, 'is')"))} AS href,
             {sql_entities(r"regexp_extract(a, '^<a[^>]*?\stitle\s*=\s*\"([^\"]*)\"', 1, 'is')")} AS title_attr,
             {sql_inner("a")} AS text FROM a),
links AS (SELECT page_id, page_url, base, pos, text, href,
                 CASE WHEN starts_with(href, '/') THEN base || href WHEN starts_with(href, 'http') THEN href
                      ELSE base || '/' || href END AS url,
                 CASE WHEN text = '' THEN title_attr ELSE text END AS title
          FROM h WHERE href <> '')
"""


def _links(spark, sf_dir, **options):
    return links.page_links(read(spark, sf_dir, "pages"), site_base("url"), words=None, **options)


@query(f"WITH {ANCHOR_SQL} SELECT page_id, pos, url, title FROM links")
def link_extract(spark, sf_dir):
    return _links(spark, sf_dir).drop("id")


@query(f"""
WITH {ANCHOR_SQL}
SELECT page_id, pos, url, title FROM links QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY pos) = 1
""")
def link_dedup(spark, sf_dir):
    return _links(spark, sf_dir, dedup=True).drop("id")


@query("""
SELECT page_id, url, regexp_matches(lower(url), '(en/|fr/|page=)[0-9]+') AS is_link,
       regexp_matches(lower(url), '(en/|fr/|page=)[0-9]+') AND NOT contains(lower(url), 'page=') AND NOT contains(lower(url), '#')
         AS is_kept
FROM pages
""")
def link_filter(spark, sf_dir):
    words = ("en/", "fr/", "page=")
    return read(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        is_listing_link("url", words).alias("is_link"),
        is_listing_link("url", words, exclude=("page=", "#")).alias("is_kept"),
    )


@query(r"""
SELECT page_id, url,
       coalesce(nullif(regexp_extract(url, '/(\d+)\.html', 1), ''), nullif(regexp_extract(url, 'page=(\d+)', 1), ''),
                nullif(regexp_extract(url, '/(\d+)/?$', 1), ''), '') AS key,
       regexp_extract(url, '(\d+)\.htm', 1) AS listing_key, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS site
FROM pages
""")
def url_key(spark, sf_dir):
    patterns = [r"/(\d+)\.html", r"page=(\d+)", r"/(\d+)/?\z"]
    return read(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        key_from_url("url", patterns).alias("key"),
        listing_key("url", r"(\d+)\.htm").alias("listing_key"),
        site_base("url").alias("site"),
    )


PAGE_COUNT_SQL = rf"""
WITH {ANCHOR_SQL},
n AS (SELECT page_id, max(greatest(try_cast(nullif(regexp_extract(href, '(?i)(?:page=|p=|страница=)(\d+)', 1), '') AS BIGINT),
                                   CASE WHEN regexp_full_match(text, '\d+') THEN try_cast(text AS BIGINT) END)) AS n
      FROM links GROUP BY page_id),
p AS (SELECT {BASE_SQL} AS site, page_id,
             try_cast(nullif(regexp_extract(url, '(?i)(?:page=|p=|страница=)(\d+)', 1), '') AS BIGINT) AS own,
             try_cast(nullif(regexp_extract(regexp_replace(html, '<!--.*?-->|<[a-zA-Z/!?][^>]*>', '', 'gs'),
               '\d+\s+\d+\s+\d+\s+\d+\s+\d+\s*\.\.\.\s*(\d+)', 1), '') AS BIGINT) AS line FROM pages),
c AS (SELECT site, coalesce(max(CASE WHEN greatest(own, n) > 0 THEN greatest(own, n) ELSE line END), 1) AS pages
      FROM p LEFT JOIN n USING (page_id) GROUP BY site)
"""


def _counts(spark, sf_dir):
    return links.page_counts(read(spark, sf_dir, "pages"), site_base("url"), own_url="url")


@query(PAGE_COUNT_SQL + "SELECT site, pages FROM c")
def page_count(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(PAGE_COUNT_SQL + """
SELECT site, page, CASE WHEN page = 1 THEN site ELSE site || '/?page=' || page END AS url, site || '/p' || page AS alternate_url
FROM (SELECT site, unnest(range(1, pages + 1)) AS page FROM c)
""")
def page_urls(spark, sf_dir):
    return links.index_urls(_counts(spark, sf_dir))


@query(rf"""
SELECT page_id, {sql_tag("title")} AS title, {sql_tag("h1")} AS heading,
       regexp_extract(html, '<html\s[^>]*?\blang\s*=\s*["'']([^"''>]*)', 1, 'is') AS lang FROM pages
""")
def page_title(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(
        "page_id",
        tag_text("html", "title").alias("title"),
        tag_text("html", "h1").alias("heading"),
        tag_attr("html", "html", "lang").alias("lang"),
    )


PARAGRAPH_SQL = rf"""
raw AS (SELECT page_id, generate_subscripts(l, 1) AS pos, unnest(l) AS piece
        FROM (SELECT page_id, string_split_regex({VISIBLE_SQL}, '(?i)<p(?:\s[^>]*)?>')[2:] AS l FROM pages)),
para AS (SELECT page_id, pos,
         {sql_inner(r"regexp_extract(piece, '^(.*?)(?:</p>|</?(?:article|div|ul|ol|table|h[1-6]|footer|section)\b|$)', 1, 'is')")} AS text
         FROM raw)
"""


@query(f"""
WITH {PARAGRAPH_SQL},
best AS (SELECT page_id, text FROM para WHERE strlen(text) > 50
         QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY strlen(text) DESC, pos) = 1)
SELECT page_id, coalesce(text, '') AS description, (SELECT count(*) FROM para WHERE para.page_id = pages.page_id) AS paragraphs
FROM pages LEFT JOIN best USING (page_id)
""")
def longest_paragraph(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", paragraphs("html").alias("p"))
    best = longest(F.filter("p", lambda x: longer_than(x, 50)))
    return pages.select(
        "page_id", F.coalesce(best, F.lit("")).alias("description"), size_of("p").cast("bigint").alias("paragraphs")
    )


TEXT_SQL = sql_entities("regexp_replace(html, '<!--.*?-->|<[a-zA-Z/!?][^>]*>', '', 'gs')")


@query(f"""
WITH t AS (SELECT page_id, lower({TEXT_SQL}) AS t FROM pages)
SELECT page_id, CASE WHEN contains(t, 'blog.') AND contains(t, 'eater') THEN 'both' WHEN contains(t, 'blog.') THEN 'apartment'
                     WHEN contains(t, 'eater') THEN 'outcall' ELSE '' END AS meeting_type,
       contains(t, 'eater') AS offsite, contains(t, 'blog.') OR contains(t, 'www.') AS onsite
FROM t
""")
def page_keyword_class(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", page_text("html").alias("t"))
    low = F.lower("t")
    return pages.select(
        "page_id",
        keyword_class(F.col("t"), "blog.", "eater").alias("meeting_type"),
        low.contains("eater").alias("offsite"),
        (low.contains("blog.") | low.contains("www.")).alias("onsite"),
    )


@query(f"""
WITH {ANCHOR_SQL}
SELECT text AS tag, count(*) AS n, CAST(sum(strlen(html)) AS DOUBLE) / count(*) AS avg_value
FROM links JOIN pages USING (page_id) WHERE text <> '' GROUP BY ALL ORDER BY n DESC, tag LIMIT 20
""")
def explode_popularity(spark, sf_dir):
    """The twenty most frequent link texts."""
    texts = F.transform(anchors("html"), lambda a: a["text"])
    size = F.octet_length("html").cast("bigint")
    return analytics.element_popularity(read(spark, sf_dir, "pages"), texts, size, "tag", limit=20)


@query(f"""
WITH {ANCHOR_SQL}
SELECT url FROM links UNION ALL SELECT url FROM pages
""")
def link_union(spark, sf_dir):
    """Addresses from links and of the pages themselves, all kept."""
    return links.link_urls(_links(spark, sf_dir)).unionByName(read(spark, sf_dir, "pages").select("url"))


@query(f"""
WITH {ANCHOR_SQL}
SELECT url AS "URL", title AS "Title", coalesce(nullif(regexp_extract(url, 'profile(\\d+)', 1), ''),
  nullif(regexp_extract(url, 'user(\\d+)', 1), ''), nullif(regexp_extract(url, 'id(\\d+)', 1), ''),
  nullif(regexp_extract(url, 'listing(\\d+)', 1), ''), nullif(regexp_extract(url, '/(\\d+)/?$', 1), ''), '') AS "ID"
FROM links
""")
def link_export(spark, sf_dir):
    """Links written as JSON records and read back."""
    path = shared_folder(spark, "links-json")
    export.export_json(_links(spark, sf_dir), path)
    return spark.read.schema("URL STRING, Title STRING, ID STRING").json(path)


@query(f"WITH {ANCHOR_SQL} SELECT url FROM links")
def url_export(spark, sf_dir):
    """Link addresses written as plain text and read back."""
    path = shared_folder(spark, "links-text")
    export.export_urls(_links(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "url")


@query(f"""
WITH {ANCHOR_SQL}
SELECT page_id, pos + 1 AS num, 'https://img.example' || href AS photo FROM h
""")
def image_list(spark, sf_dir):
    """Image records in JSON, one array per page, parsed into photo addresses."""
    body = F.to_json(
        F.transform(
            anchors("html"),
            lambda a: F.struct(F.coalesce(a["href"], F.lit("")).alias("BIMG"), (a["pos"] + 1).cast("string").alias("NUM"), F.lit("x").alias("OTHER")),
        )
    )
    pages = read(spark, sf_dir, "pages").select("page_id", page_source.image_records(body).alias("images"))
    pages = pages.select("page_id", F.explode("images").alias("i"))
    return pages.select(
        "page_id", F.col("i.NUM").cast("bigint").alias("num"), F.concat(F.lit("https://img.example"), "i.BIMG").alias("photo")
    )


# ---------------------------------------------------------------- outcomes


@query(rf"""
WITH k AS (SELECT page_id, regexp_extract(html, '<html\s[^>]*?\blang\s*=\s*["'']([^"''>]*)', 1, 'is') AS lang,
                  regexp_matches(url, '/(\d+)/?$') AS ok FROM pages)
SELECT lang, count(*) AS processed, count(*) FILTER (WHERE ok) AS succeeded, count(*) FILTER (WHERE NOT ok) AS failed,
       CAST(count(*) FILTER (WHERE ok) AS DOUBLE) * 100 / count(*) AS success_rate
FROM k GROUP BY lang
""")
def run_counters(spark, sf_dir):
    """Pages whose address holds a key, per page language."""
    pages = read(spark, sf_dir, "pages").select(tag_attr("html", "html", "lang").alias("lang"), "url")
    return analytics.run_counters(pages, key_from_url("url", [r"/(\d+)/?\z"]) != "", by=["lang"])


@query(r"""
SELECT CASE WHEN NOT regexp_matches(url, '/(\d+)') THEN 'no_key' ELSE 'tracked' END AS error_type,
       CASE WHEN NOT regexp_matches(url, '/(\d+)') THEN 'no key in address' ELSE 'address has a query' END AS error_message,
       url AS input_data, CAST(page_id AS VARCHAR) AS source
FROM pages WHERE NOT regexp_matches(url, '/(\d+)') OR contains(url, '?')
""")
def dead_letters(spark, sf_dir):
    """Failed pages from the one-pass split."""
    checks = {
        "no_key": F.when(key_from_url("url", [r"/(\d+)"]) == "", F.lit("no key in address")),
        "tracked": F.when(F.col("url").contains("?"), F.lit("address has a query")),
    }
    checked = quality.with_outcome(read(spark, sf_dir, "pages").select("page_id", "url"), checks)
    _, failed = quality.write_split(checked, shared_folder(spark, "outcome"))
    return quality.error_rows(failed, F.col("url"), F.col("page_id")).select(
        "error_type", "error_message", "input_data", "source"
    )


@query("""
SELECT page_id, md5(html) AS digest, CAST(strlen(html) AS BIGINT) AS n_bytes, CAST(NULL AS VARCHAR) AS error_type
FROM pages WHERE page_id % 10 <> 9
UNION ALL
SELECT page_id, NULL, NULL, 'status' FROM pages WHERE page_id % 10 = 9
""")
def page_decode(spark, sf_dir):
    """Every page as raw bytes: some with bad bytes appended, some with an error status."""
    kind = F.col("page_id") % 10
    fetched = read(spark, sf_dir, "pages").select(
        "page_id",
        F.when(kind % 2 == 1, F.concat(F.encode("html", "UTF-8"), F.lit(b"\xc3")))
        .otherwise(F.encode("html", "UTF-8"))
        .alias("body"),
        F.when(kind == 9, F.lit(404)).otherwise(F.lit(200)).alias("status"),
    )
    decoded = page_source.decode_pages(fetched, status="status")
    return decoded.select(
        "page_id", F.md5("html").alias("digest"), F.octet_length("html").cast("bigint").alias("n_bytes"), "error_type"
    )


ELEMENTS = [
    Select("title", "head title"),
    Select("heading", "article > h1"),
    Select("nav", "nav a[href]"),
    Select("slash", "a[href^='/s']"),
    Select("ad", "div.ad"),
    Select("footer", "footer"),
    Select("contact", "#contact a", "flag"),
]


@query(rf"""
WITH {ANCHOR_SQL},
l AS (SELECT page_id, count(*) AS nav_links, string_agg(text, '|' ORDER BY pos) AS nav_text,
             count(*) FILTER (WHERE starts_with(href, '/s')) AS slash_links FROM links GROUP BY page_id)
SELECT page_id, {sql_tag("title")} AS title, {sql_tag("h1")} AS heading, nav_links, nav_text, slash_links,
       {sql_inner(r"regexp_extract(html, '<div class=\"ad\">(.*?)</div>', 1, 'is')")} AS ad,
       {sql_tag("footer")} AS footer, false AS has_contact
FROM pages JOIN l USING (page_id)
""")
def page_elements(spark, sf_dir):
    """Elements found by nested selectors, each page parsed once."""
    pages = read(spark, sf_dir, "pages").select("page_id", "html")
    parsed = extract.select_from_pages(pages, ELEMENTS, partitions=spark.sparkContext.defaultParallelism)
    m = F.col("_m")
    text = {n: trim_space(F.get(m[n], F.lit(0))["text"]) for n in ("title", "heading", "ad", "footer")}
    return parsed.select(
        "page_id",
        text["title"].alias("title"),
        text["heading"].alias("heading"),
        F.size(m["nav"]).cast("bigint").alias("nav_links"),
        F.array_join(F.transform(m["nav"], lambda n: trim_space(n["text"])), "|").alias("nav_text"),
        F.size(m["slash"]).cast("bigint").alias("slash_links"),
        text["ad"].alias("ad"),
        text["footer"].alias("footer"),
        m["contact"].alias("has_contact"),
    )


# Where the page table keeps what a listing needs.
PAGE_RULES = extract.SiteRules(
    key_pattern=r"/(\d+)\.htm",
    title="article > h1",
    numbers={},
    strings={"label": "nav li"},
    tag_links="nav a[href]",
    city="div.place",
    description="div.ad",
    station_links="a[href*='st']",
    district_links="a[href*='th']",
    onsite_word="blog.",
    offsite_word="eater",
    visit_word="www.",
)

LISTING_SQL = rf"""
WITH {ANCHOR_SQL},
l AS (SELECT page_id, string_agg(text, '|' ORDER BY pos) FILTER (WHERE text <> '') AS tags,
             string_agg(text, '' ORDER BY pos) AS label,
             coalesce(string_agg(text, '|' ORDER BY pos) FILTER (WHERE contains(href, 'st') AND strlen(text) > 2), '') AS stations,
             coalesce(arg_max(text, pos) FILTER (WHERE contains(href, 'th') AND text <> ''), '') AS district
      FROM links GROUP BY page_id),
t AS (SELECT page_id, url, html, lower({TEXT_SQL}) AS t FROM pages)
SELECT regexp_extract(url, '/(\d+)\.htm', 1) AS id, url AS source_url, {sql_tag("h1")} AS title, tags AS tags_available, label,
       CASE WHEN contains(t, 'blog.') AND contains(t, 'eater') THEN 'both' WHEN contains(t, 'blog.') THEN 'apartment'
            WHEN contains(t, 'eater') THEN 'outcall' ELSE '' END AS tags_meeting_type,
       stations, district AS location_district, 'Moscow' AS location_city,
       contains(t, 'eater') AS location_offsite, contains(t, 'blog.') OR contains(t, 'www.') AS location_onsite,
       {sql_inner(r"regexp_extract(html, '<div class=\"ad\">(.*?)</div>', 1, 'is')")} AS description,
       CAST(0 AS BIGINT) AS price_hour, 'RUB' AS pricing_currency
FROM t JOIN l USING (page_id)
"""


def listing_output(flat):
    return flat.select(
        "id", "source_url", "title", F.array_join("tags_available", "|").alias("tags_available"),
        F.element_at("attr_str", "label").alias("label"), "tags_meeting_type",
        F.array_join("location_stations", "|").alias("stations"), "location_district", "location_city",
        "location_offsite", "location_onsite", "description", "price_hour", "pricing_currency",
    )


@query(LISTING_SQL)
def page_listings(spark, sf_dir):
    """Pages to nested records to flat rows."""
    pages = read(spark, sf_dir, "pages")
    return listing_output(flatten(extract.extract_listings(pages, PAGE_RULES, partitions=spark.sparkContext.defaultParallelism)))


# ---------------------------------------------------------------- pages made from the tables

CYRILLIC = "Привет"


@query(f"""
SELECT page_id, md5(regexp_replace(html, '[^\\x00-\\x7F]', '?', 'g') || repeat(' ', 2000) || '<meta charset="windows-1251">{CYRILLIC}') AS digest,
       CAST(NULL AS VARCHAR) AS error_type
FROM pages
""")
def page_charset(spark, sf_dir):
    """Every page in the old code page, declared at its end; every third one zipped."""

    def zipped(bodies: pa.Array) -> pa.Array:
        return pa.array([gzip.compress(b, mtime=0) for b in bodies.to_pylist()], pa.binary())

    zipped.__annotations__ = {"bodies": pa.Array, "return": pa.Array}
    plain = F.concat(F.regexp_replace("html", r"[^\x00-\x7F]", "?"), F.repeat(F.lit(" "), F.lit(2000)), F.lit('<meta charset="windows-1251">'))
    body = F.concat(F.encode(plain, "UTF-8"), F.lit(CYRILLIC.encode("cp1251")))
    gz = F.col("page_id") % 3 == 0
    fetched = read(spark, sf_dir, "pages").select("page_id", body.alias("_b"), F.when(gz, F.lit("gzip")).alias("encoding"))
    fetched = fetched.withColumn("body", F.when(F.col("encoding") == "gzip", F.arrow_udf(zipped, "binary")("_b")).otherwise(F.col("_b")))
    decoded = page_source.decode_pages(fetched.drop("_b"), encoding="encoding")
    return decoded.select("page_id", F.md5("html").alias("digest"), "error_type")


def _price_row(base):
    """SQL for a row of five cells: a label and base to base + 3."""
    return f"concat('<tr><td>r</td><td>', {base}, '</td><td>', {base} + 1, '</td><td>', {base} + 2, '</td><td>', {base} + 3, '</td></tr>')"


DETAIL_SQL = f"""
concat('<h1 class="breadcrumbs"><span>', p_name, '</span></h1><div id="attr-width"> ', p_size, ' </div><div id="attr-color">', p_brand, '</div>',
  CASE WHEN p_partkey % 5 = 0 THEN '<div id="contact"><a href="tel:+1">call</a></div>' ELSE '<div id="contact"></div>' END,
  '<table class="table-price"><tr><td><table class="table-price-inner">',
  CASE WHEN p_partkey % 2 = 0 THEN '<thead><tr><td>head</td><td>9</td></tr></thead>' ELSE '' END,
  {_price_row("p_size")}, {_price_row("p_size * 10")}, {_price_row("p_size * 100")}, {_price_row("p_size * 200")},
  '</table></td></tr></table><table><tr><td>Метро</td><td><a href="/l?x=1&region=2&copy=3">', p_type, '</a></td></tr>',
  '<tr><td>Район</td><td> ', p_brand, ' </td></tr><tr><td>01.01.2020</td><td>', 10 + p_partkey % 10, '.03.2024</td></tr></table>')
"""


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, CAST(p_size AS INTEGER) AS width, p_brand AS color, p_partkey % 5 = 0 AS has_contact,
       CAST(p_size * 100 AS INTEGER) AS onsite_first, CAST(p_size * 100 + 3 AS INTEGER) AS onsite_last,
       CAST(p_size * 200 AS INTEGER) AS offsite_first, p_type AS stations, p_brand AS district,
       CAST(10 + p_partkey % 10 AS VARCHAR) || '.03.2024' AS last_updated, '/l?x=1&region=2&copy=3' AS href
FROM part
""")
def detail_pages(spark, sf_dir):
    """Parts as detail pages, and what is read back from them: attributes, prices below a table head, labelled rows, dates."""
    key = F.col("p_partkey").cast("string")
    pages = read(spark, sf_dir, "part").select(F.concat(F.lit("https://h/listing"), key, F.lit(".htm")).alias("url"), F.expr(DETAIL_SQL).alias("html"))
    listings = extract.extract_listings(pages, partitions=spark.sparkContext.defaultParallelism)
    addresses = pages.select(F.regexp_extract("url", r"(\d+)\.htm", 1).alias("_id"), F.filter(anchors("html"), lambda a: a["href"].startswith("/l"))[0]["href"].alias("href"))
    price = {n: F.element_at("pricing.duration_prices", F.lit(PRICE_KEYS[i])) for n, i in (("onsite_first", 0), ("onsite_last", 3), ("offsite_first", 4))}
    flat = listings.select(
        "id",
        "title",
        F.element_at("attrs.num", "width").alias("width"),
        F.element_at("attrs.str", "color").alias("color"),
        "has_contact",
        *(c.alias(n) for n, c in price.items()),
        F.array_join("location.stations", "|").alias("stations"),
        F.col("location.district").alias("district"),
        "last_updated",
    )
    # Both sides are as long as the table but look small by its packed files: without the hint one is broadcast through the driver.
    return flat.hint("merge").join(addresses, F.col("id") == F.col("_id")).drop("_id")
