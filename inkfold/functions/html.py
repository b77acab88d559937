"""Columns from the HTML of list and article pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkfold.functions.text import absolute_url, collapse, strip, url_id

# How pages mark an article's title, time, content and its end; fixed values.
TITLE = r'<h2[^>]+class="titName[^"]*"[^>]*>([^<]+)</h2>'
DATE = r'class="time[^"]*">\(([^<]+)\)</span>'
CONTENT = r'(?s)<div[^>]+class="articalContent[^"]*"[^>]*>(.*?)<!-- 正文结束 -->'


def plain(html: Column) -> Column:
    """Text of HTML: tags out, ``&nbsp; &lt; &gt;`` decoded, numeric entities out, ``&amp;`` kept, white space collapsed."""
    t = F.regexp_replace(html, r"<[^>]+>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return collapse(F.regexp_replace(t, r"&#\d+;", ""))


def title(html: Column) -> Column:
    return plain(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def links(html: Column) -> Column:
    """``array<struct<url, title>>`` of all links in order; titles are plain text."""
    whole = F.regexp_extract_all(html, F.lit(r'(?is)<a\b[^>]*\bhref="[^"]*"[^>]*>.*?</a>'), F.lit(0))
    return F.transform(whole, lambda a: F.struct(F.regexp_extract(a, r'(?is)\bhref="([^"]*)"', 1).alias("url"), plain(a).alias("title")))


def article_links(html: Column, host: str, *, min_title: int = 3) -> Column:
    """``array<struct<id, title, url>>`` of links to articles: an id in the address and a longer title; the first of an id counts."""
    found = F.transform(links(html), lambda x: F.struct(url_id(x["url"]).alias("id"), x["title"].alias("title"), absolute_url(x["url"], host).alias("url")))
    good = F.filter(found, lambda x: (x["id"] != "") & (F.length(x["title"]) > min_title) & ~x["title"].contains("..."))
    ids = F.transform(good, lambda x: x["id"])
    return F.filter(good, lambda x, i: F.array_position(ids, x["id"]) == i + 1)


def images(html: Column, *, without_host: str | None = None) -> Column:
    """Sources of all images that have one, without those on ``without_host`` where it is given."""
    whole = F.regexp_extract_all(html, F.lit(r'(?i)<img[^>]+src="([^"]+)"'), F.lit(1))
    return F.filter(whole, lambda x: ~x.contains(without_host)) if without_host else whole


def stated_time(html: Column) -> Column:
    """The first ``(YYYY-MM-DD HH:MM:SS)``, '' without one."""
    return F.regexp_extract(html, r"\((\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\)", 1)


def script_tags(html: Column, *, drop_blank: bool = True, commas: str = ",，") -> Column:
    """Tags from ``var $tag='a,b'``, split at any of ``commas``, trimmed."""
    raw = F.regexp_extract(html, r"var \$tag='([^']+)'", 1)
    tags = F.transform(F.split(raw, f"[{commas}]"), strip)
    return F.filter(tags, lambda t: t != "") if drop_blank else F.when(raw != "", tags).otherwise(F.array().cast("array<string>"))


def page_numbers(html: Column, *, bound: int = 10_000) -> Column:
    """The highest page number in the pagination below ``bound``, 1 without any."""
    found = F.transform(F.regexp_extract_all(html, F.lit(r"_(\d{1,9})\.html"), F.lit(1)), lambda n: n.cast("bigint"))
    return F.coalesce(F.array_max(F.filter(found, lambda n: (n > 0) & (n < bound))), F.lit(1).cast("bigint"))


def matching_lines(html: Column, pattern: str) -> Column:
    """Number of lines in which ``pattern`` matches."""
    return F.size(F.filter(F.split(html, "\n"), lambda line: line.rlike(pattern)))


def article_content(html: Column) -> Column:
    """What an article's page has between the opening of its content and the mark of its end, as plain text; '' without both.

    Elements within the content may be nested to any depth.
    """
    return plain(F.regexp_extract(html, CONTENT, 1))


def article(html: Column, url: Column) -> Column:
    """``struct<id, title, url, date, tags, content, images>`` of an article page."""
    return F.struct(
        url_id(url).alias("id"),
        strip(F.regexp_extract(html, TITLE, 1)).alias("title"),
        url.alias("url"),
        strip(F.regexp_extract(html, DATE, 1)).alias("date"),
        script_tags(html, drop_blank=False, commas=",").alias("tags"),
        article_content(html).alias("content"),
        images(html).alias("images"),
    )


def noisy_json(text: Column, schema: str) -> Column:
    """JSON that begins at the first ``[`` of some program's output; null if there is none."""
    at = F.instr(text, "[")
    return F.when(at > 0, F.from_json(F.substring(text, at, F.length(text)), schema))
