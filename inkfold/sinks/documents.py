"""Posts, indexes, graphs and reports as documents; each document is a column, and a file only where it is asked for."""

from __future__ import annotations

import json
import time

from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.frontmatter import POST_KEYS, render_post
from inkfold.functions.terms import SPACE
from inkfold.functions.text import escaped, md5_name, safe_title, slug
from inkfold.operators.ranks import running_before


def post_documents(posts: DataFrame, keys: tuple[str, ...] = POST_KEYS, *, keywords: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep..., file_name, content`` of posts: front matter with ``keys``, lists as JSON, the name from the address.

    ``keywords``, an array, becomes one key more, the last.
    """
    listed = lambda c: F.to_json(F.coalesce(c, F.array().cast("array<string>")))
    fields = {k: listed(F.col(k)) if dict(posts.dtypes)[k].startswith("array") else F.col(k) for k in keys}
    if keywords is not None:
        fields["keywords"] = listed(keywords)
    content = render_post(fields, F.col("title"), F.col("body"))
    return posts.select(*keep, md5_name(F.col("source_url"), F.col("id")).alias("file_name"), content.alias("content"))


def collector_documents(posts: DataFrame, *keep: str) -> DataFrame:
    """``keep..., file_name, content`` with four keys, values quoted and escaped."""
    quoted = lambda c: F.concat(F.lit('"'), escaped(F.coalesce(F.col(c), F.lit(""))), F.lit('"'))
    fields = {
        "title": quoted("title"),
        "date": quoted("published_at"),
        "source": quoted("source_url"),
        "tags": F.to_json(F.coalesce("tags", F.array().cast("array<string>"))),
    }
    return posts.select(
        *keep,
        md5_name(F.col("source_url"), F.col("id")).alias("file_name"),
        render_post(fields, F.col("title"), F.col("body")).alias("content"),
    )


def short_documents(posts: DataFrame, *keep: str) -> DataFrame:
    """``keep..., file_name, content`` with six keys; an empty time is ``unknown``, the name is the id and the safe title."""
    fields = {k: F.col(k) for k in ("id", "author_uid", "author_name")}
    fields["published_at"] = F.coalesce(F.nullif("published_at", F.lit("")), F.lit("unknown"))
    fields |= {k: F.col(k) for k in ("fetched_at", "source_url")}
    name = F.concat("id", F.lit("_"), safe_title(F.coalesce("title", F.lit(""))), F.lit(".md"))
    return posts.select(*keep, name.alias("file_name"), render_post(fields, F.col("title"), F.col("body")).alias("content"))


def staged_documents(ranked: DataFrame, owner: str, rank: str, *keep: str) -> DataFrame:
    """``keep..., file_name, content``: texts under their title, with owner, slug (60 characters) and rank in the name.

    A text that begins with a heading mark loses it, having a title already.
    """
    title = F.coalesce("title", F.lit(""))
    name = F.concat_ws("_", owner, slug(title, limit=60), F.format_string("%04d.md", F.col(rank)))
    body = F.coalesce("body", F.lit(""))
    bare = F.when(body.startswith("# "), F.regexp_replace(body, rf"^[# ]+[{SPACE}]*", "")).otherwise(body)
    return ranked.select(*keep, name.alias("file_name"), F.concat(F.lit("# "), title, F.lit("\n\n"), bare).alias("content"))


def blogger_documents(bloggers: DataFrame, host: str) -> DataFrame:
    """``uid, content``: a profile as JSON; nulls are '' and 0, the address is made of ``host`` and the uid."""
    text = lambda c, n: F.coalesce(c, F.lit("")).alias(n)
    profile = F.struct(text("profile.description", "description"), text("profile.category", "category")).alias("profile")
    domain = F.concat(F.lit(f"https://{host}/u/"), F.coalesce("uid", F.lit(""))).alias("domain")
    content = F.to_json(
        F.struct(
            text("uid", "uid"),
            text("name", "name"),
            domain,
            F.coalesce("total_articles", F.lit(0)).alias("total_articles"),
            profile,
            text("created_at", "created_at"),
        )
    )
    return bloggers.select("uid", content.alias("content"))


def write_files(documents: DataFrame, folder: str) -> None:
    """One file per row of ``file_name, content`` in a folder of any file system that pyarrow knows by its address.

    A file is written beside its name and then renamed, so a task that runs again leaves no half of one.
    """
    at = folder if "://" in folder else f"file://{folder}"

    def write(rows) -> None:
        system, base = FileSystem.from_uri(at)
        system.create_dir(base)
        for row in rows:
            part = f"{base}/.{row['file_name']}.{time.time_ns()}"
            with system.open_output_stream(part) as out:
                out.write(row["content"].encode())
            system.move(part, f"{base}/{row['file_name']}")

    documents.select("file_name", "content").foreachPartition(write)


def index_lines(index: DataFrame, by: str, order: list[str]) -> DataFrame:
    """``by, line_no, line``: the lines of each owner's index ``{"total", "posts": [...]}``, one entry a line, in ``order``.

    An owner's index is never in one row or task: lines are numbered by range partitions, however many entries it has.
    """
    entry = F.to_json(F.struct(*[c for c in index.columns if c != by]))
    numbered = running_before(index.select(by, *order, entry.alias("entry")), [by], order, F.lit(1), "n")
    totals = index.groupBy(F.col(by).alias("owner")).agg(F.count(F.lit(1)).alias("total"))
    own = numbered.join(totals, F.col(by).eqNullSafe(F.col("owner")))
    lines = own.select(by, (F.col("n") + 1).alias("line_no"), F.concat("entry", F.when(F.col("n") + 1 < F.col("total"), ",").otherwise("")).alias("line"))
    ends = F.array(
        F.struct(
            F.lit(0).cast("bigint").alias("line_no"),
            F.concat(F.lit('{"total": '), F.col("total").cast("string"), F.lit(', "posts": [')).alias("line"),
        ),
        F.struct((F.col("total") + 1).alias("line_no"), F.lit("]}").alias("line")),
    )
    return lines.unionByName(
        totals.select(F.col("owner").alias(by), F.explode(ends).alias("e")).select(by, F.col("e.line_no").cast("bigint").alias("line_no"), "e.line")
    )


def write_index(index: DataFrame, by: str, folder: str) -> None:
    """Entries as JSON lines, a folder per owner."""
    index.write.mode("overwrite").partitionBy(by).json(folder)


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    """Nodes and links as JSON lines."""
    nodes.write.mode("overwrite").json(f"{folder}/nodes")
    edges.withColumnsRenamed({"src": "source", "dst": "target"}).write.mode("overwrite").json(f"{folder}/links")


def write_report(report: DataFrame, folder: str) -> None:
    report.write.mode("overwrite").json(folder)


class Session:
    """Counters and failures of one run, kept by the driver and written as JSON."""

    def __init__(self, uid: str, expected: int = 0) -> None:
        now = time.gmtime()
        self.state = {
            "uid": uid, "session_id": time.strftime("%Y%m%d_%H%M%S", now), "started_at": time.strftime(
                "%Y-%m-%dT%H:%M:%S",
                now,
            ), "completed_at": None, "status": "running",
            "total_expected": expected, "total_downloaded": 0, "total_failed": 0, "pages_completed": 0, "last_page": 0, "last_article_index": -1, "total_images": 0, "failed_urls": [],
        }

    def add(self, downloaded: int = 0, pages: int = 0, *, page: int | None = None, article: int | None = None, images: int = 0) -> None:
        self.state["total_downloaded"] += downloaded
        self.state["pages_completed"] += pages
        self.state["total_images"] += images
        self.state["last_page"] = self.state["last_page"] if page is None else page
        self.state["last_article_index"] = self.state["last_article_index"] if article is None else article

    def fail(self, url: str, error: str) -> None:
        """An address fails once, whatever the number of tries."""
        if all(f["url"] != url for f in self.state["failed_urls"]):
            self.state["failed_urls"].append({"url": url, "error": error, "time": time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime())})
            self.state["total_failed"] += 1

    def complete(self) -> None:
        self.state["status"] = "completed" if not self.state["failed_urls"] else "completed_with_errors"
        self.state["completed_at"] = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime())

    def save(self, path: str) -> None:
        system, name = FileSystem.from_uri(path if "://" in path else f"file://{path}")
        with system.open_output_stream(name + ".part") as out:
            out.write(json.dumps(self.state, ensure_ascii=False).encode())
        system.move(name + ".part", name)
