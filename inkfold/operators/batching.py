"""Batches for a function that takes several records at once, and the repair of what it returns."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.text import collapse, let, strip, without_controls
from inkfold.operators.ranks import global_rank, running_before

ENTRY = "array<struct<title: string, summary: string, tags: array<string>, related: array<string>, content: string, body: string>>"


def batches(df: DataFrame, order: list[str], size: int, *, within: str | None = None) -> DataFrame:
    """``df`` with ``batch_id`` and ``idx`` (from 1): consecutive rows in ``order``, ``size`` to a batch.

    With ``within``, batches are numbered per value of that column. Either way rows are numbered by range partitions,
    which writes ``df`` once: give it the keys only and join wide columns to the result.
    """
    numbered = global_rank(df, order, "__n") if within is None else running_before(df, [within], order, F.lit(1), "__n")
    batch_id = F.floor(F.col("__n") / size).cast("bigint")
    return numbered.select(*df.columns, batch_id.alias("batch_id"), (F.pmod("__n", F.lit(size)) + 1).cast("int").alias("idx"))


def prompt_of(batch: DataFrame, title: str, text: str, *, intro: str, limit: int = 2500) -> DataFrame:
    """``batch_id, n, prompt``: the records of each batch in order under a heading with their number."""
    block = F.concat(
        F.lit("=== "),
        F.col("idx").cast("string"),
        F.lit(" ===\n"),
        F.coalesce(title, F.lit("")),
        F.lit("\n"),
        F.substring(F.coalesce(text, F.lit("")), 1, limit),
    )
    rows = F.array_sort(F.collect_list(F.struct("idx", block.alias("block"))))  # at most a batch
    return batch.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.concat(F.lit(intro), F.array_join(F.transform(rows, lambda r: r["block"]), "\n\n")).alias("prompt"),
    )


def json_window(text: Column) -> Column:
    """The part from the first ``[`` to the last ``]`` of a text without code fences and control characters; null if there is none."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(without_controls(text)), r"\A```[^\n]*\n?", ""), r"\s*```\s*\z", "")

    def window(t: Column) -> Column:
        start, end = F.instr(t, "["), F.length(t) - F.instr(F.reverse(t), "]") + 1
        return F.when((start > 0) & (F.instr(t, "]") > 0) & (end > start), F.substring(t, start, end - start + 1))

    return let(bare, window)


def _some(items: Column, most: int) -> Column:
    return F.coalesce(F.slice(F.filter(items, lambda x: F.coalesce(x, F.lit("")) != ""), 1, most), F.array().cast("array<string>"))


def entries(text: Column) -> Column:
    """``array<struct<title, summary, tags, related, body>>`` from a reply: JSON where it is some, else sections between ``---`` lines.

    At most 5 tags and 3 related; objects without a title are left out; a section's title is its first heading, its
    summary and tags have defaults; of sections of one title but for white space the first counts.
    """
    item = lambda x: F.struct(
        x["title"].alias("title"), F.coalesce(x["summary"], F.lit("")).alias("summary"), _some(x["tags"], 5).alias("tags"), _some(x["related"], 3).alias("related"), F.coalesce(
            F.nullif(x["content"], F.lit("")),
            x["body"],
            F.lit(""),
        ).alias("body")
    )
    parsed = F.transform(F.filter(F.from_json(json_window(text), ENTRY), lambda x: x["title"].isNotNull()), item)
    sections = F.filter(F.transform(F.split(F.regexp_replace(F.trim(text), r"\A---", ""), "\n---"), F.trim), lambda s: s != "")
    none = F.array().cast("array<string>")

    def section(s: Column) -> Column:
        title = F.trim(F.regexp_extract(s, r"(?m)^\s*#+\s+(.+)$", 1))
        return F.struct(
            title.alias("title"),
            F.concat(F.lit("about "), title).alias("summary"),
            F.array(F.lit("unsorted")).alias("tags"),
            none.alias("related"),
            s.alias("body"),
        )

    def first_of_title(found: Column) -> Column:
        names = F.transform(found, lambda e: F.regexp_replace(e["title"], r"\s+", ""))
        return let(names, lambda n: F.filter(found, lambda e, i: F.array_position(n, F.element_at(n, i + 1)) == i + 1))

    split = let(F.filter(F.transform(sections, section), lambda e: e["title"] != ""), first_of_title)
    return let(parsed, lambda p: F.when(F.size(p) > 0, p).otherwise(split))


def match_titles(entry_rows: DataFrame, batch: DataFrame) -> DataFrame:
    """``entry_rows(batch_id, pos, title, ...)`` with ``idx`` of the first record of the batch whose title equals or holds theirs, or is held by it."""
    norm = lambda c: F.regexp_replace(c, r"\s+", "")
    own = batch.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("idx", norm(F.col("title")).alias("t")))).alias("__own"))  # at most a batch
    name = norm(F.col("title"))
    hit = F.filter("__own", lambda r: (r["t"] != "") & (F.contains(name, r["t"]) | F.contains(r["t"], name)))
    return entry_rows.join(own, "batch_id", "left").withColumn("idx", F.try_element_at(hit, F.lit(1))["idx"]).drop("__own")


def _tried(fn: Callable, attempts: int, wait: float) -> Callable:
    """``fn`` with an error tried again after ``wait`` seconds, twice as long each time, and then null."""

    def call(given):
        for n in range(attempts):
            try:
                return fn(given)
            except Exception:  # noqa: BLE001  the function is foreign; its failure is a null reply
                if wait and n + 1 < attempts:
                    time.sleep(wait * 2**n)
        return None

    return call


def map_batches(batch: DataFrame, fn: Callable[[list[dict]], str], *, attempts: int = 3, wait: float = 0.0, at_once: int | None = None) -> DataFrame:
    """``batch_id, reply``: ``fn`` gets the records of each batch in order; an error is tried again, then gives a null reply.

    ``wait`` is the time before the second try in seconds, doubled for each more. ``at_once`` bounds the calls at one
    time: there are so many tasks, and a task makes one call after the other.
    """
    reply = _tried(fn, attempts, wait)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for part in parts for row in part.to_pylist())
        for key, records in groupby(rows, key=lambda r: r["batch_id"]):
            yield pa.RecordBatch.from_pydict({"batch_id": pa.array([key], pa.int64()), "reply": pa.array([reply(list(records))], pa.string())})

    spread = batch.repartition("batch_id") if at_once is None else batch.repartition(at_once, "batch_id")
    return spread.sortWithinPartitions("batch_id", "idx").mapInArrow(run, "batch_id bigint, reply string")


def map_records(df: DataFrame, fn: Callable[[str], str], key: str, text: str, *, attempts: int = 3, wait: float = 0.0, at_once: int | None = None) -> DataFrame:
    """``key, reply``: ``fn`` of one text at a time, tried as in ``map_batches``; a null text has a null reply.

    No shuffle, unless ``at_once`` asks for so many tasks. ``fn`` takes one text, so rows are looped over.
    """
    reply = _tried(fn, attempts, wait)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            replies = [None if t is None else reply(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(replies, pa.string())], names=["key", "reply"])

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return (rows if at_once is None else rows.repartition(at_once)).mapInArrow(run, "key string, reply string").withColumnRenamed("key", key)


def attach(results: DataFrame, batch: DataFrame, keep: list[str]) -> DataFrame:
    """Results with the columns ``keep`` of their batch's record by ``idx``; a null or wrong ``idx`` keeps the result without them."""
    return results.join(batch.select("batch_id", "idx", *keep), ["batch_id", "idx"], "left")


def numbered_names(df: DataFrame, slug: str, order: list[str], *, pattern: str = "%s_%d") -> DataFrame:
    """``df`` with ``file_name``: the slug, for the second and later rows of a slug with a number in ``pattern``."""
    at = F.col("__n")
    name = F.when(at == 0, F.col(slug)).otherwise(F.format_string(pattern, F.col(slug), at))
    return running_before(df, [slug], order, F.lit(1), "__n").select(*df.columns, F.concat(name, F.lit(".md")).alias("file_name"))


def within_budget(df: DataFrame, by: str, order: list[str], size: str, budget: int) -> DataFrame:
    """Rows of each ``by`` in ``order`` as long as what came before stays within ``budget``."""
    return running_before(df, [by], order, F.col(size), "__before").where(F.col("__before") <= budget).drop("__before")


def reply_text(reply: Column, which: str = "all") -> Column:
    """Text of a reply ``{"content": [{"type", "text"}]}``: of its blocks of type ``text`` ``all`` joined by line feeds,
    the ``first``, or the first that is ``filled``, without white space at its ends; '' where there is none."""
    blocks = F.filter(F.from_json(reply, "struct<content: array<struct<type: string, text: string>>>")["content"], lambda b: b["type"] == "text")
    texts = F.transform(blocks, lambda b: F.coalesce(b["text"], F.lit("")))
    if which == "all":
        return F.array_join(texts, "\n")
    found = texts if which == "first" else F.filter(F.transform(texts, strip), lambda t: t != "")
    return F.when(reply.isNotNull(), F.coalesce(F.get(found, F.lit(0)), F.lit("")))


def normal_title(title: Column) -> Column:
    return F.regexp_replace(collapse(title), " ", "")
