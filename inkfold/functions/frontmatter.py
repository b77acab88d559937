"""The front-matter grammars that stored posts are read by.

``split_fences``: the text is cut at every ``---`` line end; needs three parts; what follows the second is the body,
further cuts replaced by a line feed. ``anchored``: the block must start the text. ``limited``: the text is cut at
the first two ``---`` anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkfold.functions.terms import SPACE
from inkfold.functions.text import strip


def _entries(block: Column, *, quotes: bool) -> Column:
    """``key: value`` lines as a map; the last of equal keys counts. ``quotes``: quotes around values are dropped."""
    lines = F.filter(F.split(block, "\n", -1), lambda x: x.contains(":"))
    value = lambda x: strip(F.substring(x, F.instr(x, ":") + 1, F.length(x)))
    bare = (lambda v: F.regexp_replace(F.regexp_replace(v, '^"+|"+$', ""), "^'+|'+$", "")) if quotes else (lambda v: v)
    pairs = F.transform(lines, lambda x: F.struct(strip(F.substring_index(x, ":", 1)).alias("k"), bare(value(x)).alias("v")))

    def last(pairs: Column) -> Column:
        keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
        found = F.transform(keys, lambda k: F.struct(k.alias("k"), F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"].alias("v")))
        return F.map_from_entries(F.when(F.size(keys) == F.size(pairs), pairs).otherwise(found))

    return F.transform(F.array(pairs), last)[0]  # a lambda's argument: the lines are cut once, not again for each key


def split_fences(text: Column) -> Column:
    """``struct<meta, body>``; null where there are fewer than three parts."""
    parts = F.split(text, "---\n", -1)
    body = F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(1))), "\n")
    return F.when(F.size(parts) >= 3, F.struct(_entries(parts[1], quotes=False).alias("meta"), body.alias("body")))


def anchored(text: Column) -> Column:
    """``struct<meta, body>``; without a block the map is empty and the whole text is the body."""
    block = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1)
    has = text.rlike(r"(?s)\A---\n.*?\n---")
    body = F.when(has, F.regexp_replace(text, r"(?s)\A---\n.*?\n---", "")).otherwise(text)
    return F.struct(F.when(has, _entries(block, quotes=True)).otherwise(F.create_map().cast("map<string,string>")).alias("meta"), strip(body).alias("body"))


def limited(text: Column) -> Column:
    """``struct<meta, body>`` from the first two ``---``; without them the map is empty and the whole text is the body."""
    parts = F.split(text, "---", 3)
    has = text.startswith("---") & (F.size(parts) >= 3)
    return F.when(has, F.struct(_entries(parts[1], quotes=True).alias("meta"), strip(parts[2]).alias("body"))).otherwise(
        F.struct(F.create_map().cast("map<string,string>").alias("meta"), strip(text).alias("body"))
    )


def title_of(text: Column, file_name: Column) -> Column:
    """Title by the front matter, else by a heading in the first ten lines of the body, else by the file name."""
    part = limited(text)
    heading = F.regexp_extract(F.array_join(F.slice(F.split(part["body"], "\n"), 1, 10), "\n"), r"(?m)^\s*#+\s+(.+?)\s*$", 1)
    return F.coalesce(
        F.nullif(F.try_element_at(part["meta"], F.lit("title")), F.lit("")),
        F.nullif(heading, F.lit("")),
        F.regexp_replace(file_name, r"\.md$", ""),
    )


#: Keys of a stored post in their order.
POST_KEYS = (
    "id",
    "author_uid",
    "author_name",
    "published_at",
    "fetched_at",
    "type",
    "category",
    "tags",
    "source_url",
    "likes",
    "comments",
    "images_count",
    "images",
)


def render_post(fields: dict[str, Column], title: Column, content: Column) -> Column:
    """A post as text: front matter with ``fields`` in their order, the title as heading, the content. Null values are ''."""
    lines = [F.concat(F.lit(f"{key}: "), F.coalesce(value.cast("string"), F.lit(""))) for key, value in fields.items()]
    return F.concat(
        F.lit("---\n"),
        F.concat_ws("\n", *lines),
        F.lit("\n---\n\n# "),
        F.coalesce(title, F.lit("")),
        F.lit("\n\n"),
        F.coalesce(content, F.lit("")),
        F.lit("\n"),
    )


def render_wiki(title: Column, summary: Column, tags: Column, related: Column, created: Column) -> Column:
    """The front matter of an entry: quoted title and summary, bare lists, ``related`` only if it has items."""
    some = F.when(F.size(related) > 0, F.concat(F.lit("related: ["), F.array_join(related, ", "), F.lit("]")))
    return F.concat_ws(
        "\n",
        F.lit("---"),
        F.concat(F.lit('title: "'), title, F.lit('"')),
        F.concat(F.lit('summary: "'), summary, F.lit('"')),
        F.concat(F.lit("tags: ["), F.array_join(tags, ", "), F.lit("]")),
        F.concat(F.lit('created: "'), created, F.lit('"')),
        some,
        F.lit("---"),
        F.lit(""),
    )


def with_section(text: Column, marker: str, section: Column) -> Column:
    """Text whose part from ``marker`` on is replaced by marker and ``section``; a null section only drops the old one."""
    before = F.regexp_replace(F.substring_index(text, marker, 1), rf"[{SPACE}]+\z", "")
    return F.when(section.isNull(), before).otherwise(F.concat(before, F.lit(f"\n\n{marker}\n\n"), section, F.lit("\n")))
