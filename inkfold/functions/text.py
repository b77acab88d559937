"""String functions: tokens, white space, slugs, list literals, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkfold.functions.terms import SPACE

HAN = "一-鿿"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(text: Column) -> Column:
    """Text without Unicode white space at its ends."""
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def collapse(text: Column) -> Column:
    """Every run of Unicode white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def tokens_cased(text: Column) -> Column:
    """Runs of Han and runs of Latin letters of at least two characters in text order, case kept."""
    return F.filter(F.regexp_extract_all(text, F.lit(rf"[{HAN}]+|[a-zA-Z]+"), F.lit(0)), lambda w: F.length(w) >= 2)


def tokens_folded(text: Column) -> Column:
    """Runs of Han of at least two characters, then runs of at least three Latin letters in lower case."""
    han = F.filter(F.regexp_extract_all(text, F.lit(rf"[{HAN}]+"), F.lit(0)), lambda w: F.length(w) >= 2)
    return F.concat(han, F.regexp_extract_all(F.lower(text), F.lit(r"[a-z]{3,}"), F.lit(0)))


def tag_literal(text: Column) -> Column:
    """Tags of ``[a, b]``: split at commas, trimmed, quotes kept; ``[]`` gives one empty tag, other text no tags."""
    t = strip(text)
    inside = F.split(F.substring(t, F.lit(2), F.length(t) - 2), ",", -1)
    return F.when(t.startswith("[") & t.endswith("]") & (F.length(t) >= 2), F.transform(inside, strip)).otherwise(F.array().cast("array<string>"))


def json_list(text: Column) -> Column:
    """A JSON list of strings; anything else gives an empty list."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def without_marks(text: Column) -> Column:
    """Text without Markdown heading marks, links replaced by their words."""
    return F.regexp_replace(F.regexp_replace(text, "#+ ", ""), r"\[([^\]]+)\]\([^)]+\)", "$1")


def first_heading(text: Column) -> Column:
    """The first Markdown heading of level one, '' without one. Only a line feed ends a line; blanks are those of ASCII."""
    return F.regexp_extract(text, r"(?md)^#[\t\n\f\r ]+(.+?)[\t\n\f\r ]*$", 1)


def without_controls(text: Column) -> Column:
    """Text without control characters; tab, line feed and carriage return stay."""
    return F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def valid_utf8(data: Column) -> Column:
    """Bytes as text, what is not UTF-8 left out (with it any U+FFFD that the bytes really have)."""
    return F.replace(F.make_valid_utf8(data.cast("string")), F.lit("�"), F.lit(""))


def slug(title: Column, *, limit: int | None = None, empty: str = "untitled") -> Column:
    """Lower-case words joined by ``-``: letters, digits and ``_`` of any script stay."""
    s = F.regexp_replace(title, rf"[^\p{{L}}\p{{N}}\p{{M}}_{SPACE}-]", "")
    s = F.lower(F.regexp_replace(F.regexp_replace(s, rf"[-{SPACE}]+", "-"), "^-+|-+$", ""))
    s = s if limit is None else F.regexp_replace(F.substring(s, 1, limit), "-+$", "")
    return F.when(s == "", empty).otherwise(s)


def safe_title(title: Column, limit: int = 50) -> Column:
    """Title for a file name: anything but letters, digits and ``_`` becomes ``_``."""
    return F.substring(F.regexp_replace(title, r"[^\p{L}\p{N}_]", "_"), 1, limit)


def cjk_slug(title: Column, limit: int = 80) -> Column:
    """Title for a file name: marks and white space, also full-width ones, become ``_``."""
    return F.substring(F.regexp_replace(F.regexp_replace(strip(title), rf"[{SPACE}\p{{P}}\p{{S}}]+", "_"), "^_+|_+$", ""), 1, limit)


def md5_name(url: Column, other_id: Column) -> Column:
    """File name of a post: the address's MD5, the id's where there is no address."""
    return F.concat(F.md5(F.coalesce(F.nullif(url, F.lit("")), other_id).cast("binary")), F.lit(".md"))


def rolling_hash_name(url: Column) -> Column:
    """File name from a 32-bit rolling hash over UTF-16 units (31 h + c), its absolute value in hex."""
    units = F.transform(F.split(F.hex(F.encode(url, "UTF-16BE")), "(?<=\\G.{4})"), lambda h: F.conv(h, 16, 10).cast("bigint"))
    known = F.filter(units, lambda u: u.isNotNull())
    wrapped = F.aggregate(known, F.lit(0).cast("bigint"), lambda h, c: F.pmod(h * 31 + c, F.lit(1 << 32)))
    signed = F.when(wrapped >= (1 << 31), wrapped - (1 << 32)).otherwise(wrapped)
    return F.concat(F.lower(F.hex(F.abs(signed))), F.lit(".md"))


def url_id(url: Column) -> Column:
    """The id in an address ``.../blog_<id>``, '' without one."""
    return F.regexp_extract(url, r"blog_([0-9a-z]+)", 1)


def absolute_url(href: Column, host: str) -> Column:
    """An address with scheme and host: ``//x`` gets the scheme, ``/x`` the host, others stay."""
    return F.when(href.startswith("//"), F.concat(F.lit("http:"), href)).when(href.startswith("/"), F.concat(F.lit(f"http://{host}"), href)).otherwise(href)


def summary_line(text: Column, limit: int = 200) -> Column:
    """The first characters in one line, without white space at its ends."""
    return strip(F.replace(F.substring(text, 1, limit), F.lit("\n"), F.lit(" ")))


def bar(count: Column, per: int, mark: str = "█") -> Column:
    """A bar with one mark for every ``per``."""
    return F.repeat(F.lit(mark), F.floor(count / per).cast("int"))


def escaped(text: Column) -> Column:
    """Text for a double-quoted value."""
    return F.replace(text, F.lit('"'), F.lit('\\"'))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, 0 of nothing."""
    return F.coalesce(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), F.lit(0.0))


def round1(number: Column) -> Column:
    """A number from 0 to below 1024 rounded to one decimal by its exact binary value, ties to the even digit.

    ``round`` and ``bround`` look at the shortest decimal text instead, and make 0.4 of 0.35, which is a little less.
    Scaled by 2**52 a number is whole but for a rest below 1, which only numbers below 1 have, and whose 20-fold is exact.
    """
    scale, tens = 1 << 52, "decimal(20,0)"
    scaled = number * F.lit(float(scale))
    whole = F.floor(scaled)
    digit = F.floor(whole.cast(tens) * F.lit(10).cast("decimal(2,0)") / F.lit(scale).cast("decimal(17,0)")).cast("bigint")
    left = whole.cast(tens) * F.lit(10).cast("decimal(2,0)") - digit.cast(tens) * F.lit(scale).cast("decimal(17,0)")
    to_half = F.lit(float(scale)) - (left * F.lit(2).cast("decimal(2,0)")).cast("double")
    rest = (scaled - whole) * 20
    return (digit + F.when(rest > to_half, 1).when(rest < to_half, 0).otherwise(digit % 2)) / F.lit(10.0)


def first_line_title(text: Column, fallback: Column, limit: int = 100) -> Column:
    """The first line of a text without ``#`` and white space around it, at most ``limit`` characters; ``fallback`` without one."""
    line = strip(F.regexp_replace(F.substring_index(strip(text), "\n", 1), "^#+", ""))
    return F.coalesce(F.nullif(F.substring(line, 1, limit), F.lit("")), fallback)


def entry_summary(text: Column, file_name: Column) -> Column:
    """``[title]: summary`` of an entry whose text states a quoted summary, else null; without a title the file's name stands."""
    title, summary = (F.regexp_extract(text, rf'{key}: "(.*?)"', 1) for key in ("title", "summary"))
    named = F.when(text.rlike(r'title: ".*?"'), title).otherwise(F.regexp_replace(file_name, r"\.md$", ""))
    return F.when(text.rlike(r'summary: ".*?"'), F.concat(F.lit("["), named, F.lit("]: "), summary))
