"""What is listed against what is stored: differences, merges, first-of duplicates, page counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.text import round1
from inkfold.operators.quality import band, completeness


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in ``order``; null keys are one key.

    Rows of a key are combined before the shuffle by a minimum over the order and the row, so a key with a third of
    all rows costs one row a task. Rows that tie in ``order`` are told apart by their other columns; columns of map
    type are not supported.
    """
    rest = [c for c in df.columns if c not in key]
    first = df.groupBy(*key).agg(F.min(F.struct(*order, F.struct(*rest).alias("__row"))).alias("__first"))
    return first.select(*key, "__first.__row.*").select(*df.columns)


def missing(listed: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``listed`` whose key isn't stored; a null key is missing."""
    return listed.join(stored.select(key).distinct(), key, "left_anti")


def matched(listed: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``listed`` whose key is stored."""
    return listed.join(stored.select(key).distinct(), key, "left_semi")


def reconcile(listed: DataFrame, stored: DataFrame, key: str, *, sample: int = 50) -> DataFrame:
    """One row: distinct keys listed, stored, matched, missing, extra; completeness, status, first missing and extra keys."""
    keys = listed.select(key, F.lit(1).alias("l"), F.lit(0).alias("s")).unionByName(stored.select(key, F.lit(0).alias("l"), F.lit(1).alias("s")))
    each = keys.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("l").alias("l"), F.max("s").alias("s"))
    only = lambda side, other: F.when((F.col(side) == 1) & (F.col(other) == 0), F.col(key))
    total = each.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("n_listed"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("n_stored"),
        F.coalesce(F.sum(F.col("l") * F.col("s")), F.lit(0)).alias("n_matched"),
    )
    firsts = [
        each.select(only(a, b).alias("k")).where(F.col("k").isNotNull()).orderBy("k").limit(sample).agg(
            F.array_sort(F.collect_list("k")).alias(n)
        ) for a, b, n in (("l", "s", "missing"), ("s", "l", "extra"))
    ]
    out = total.withColumn("n_missing", F.col("n_listed") - F.col("n_matched")).withColumn("n_extra", F.col("n_stored") - F.col("n_matched"))
    share = F.coalesce(F.col("n_matched") * F.lit(100.0) / F.nullif(F.col("n_listed"), F.lit(0)), F.lit(0.0))
    out = out.select("*", share.alias("completeness_percent"), F.when(F.col("n_missing") == 0, "ok").otherwise("incomplete").alias("status"))
    for one in firsts:  # one row each
        out = out.join(one)
    return out


def count_check(got: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row: rows of both tables, difference, completeness to one decimal, band and status."""
    both = got.agg(F.count(F.lit(1)).alias("n_got")).join(wanted.agg(F.count(F.lit(1)).alias("n_wanted")))  # one row each
    share = completeness(F.col("n_got"), F.col("n_wanted"))
    return both.select(
        "n_got",
        "n_wanted",
        F.abs(F.col("n_got") - F.col("n_wanted")).alias("difference"),
        round1(share).alias("completeness_percent"),
        band(share).alias("band"),
        F.when(share >= 99, "ok").otherwise("incomplete").alias("status"),
    )


def merge_new(known: DataFrame, found: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``known`` with the rows of ``found`` whose key is new, the first of each; known rows stay as they are."""
    new = keep_first(found.where(F.col(key).isNotNull()), [key], order).join(known.select(key).distinct(), key, "left_anti")
    return known.unionByName(new.select(*known.columns))


def with_text(scored: DataFrame, posts: DataFrame, key: str, text: str, preview: str) -> DataFrame:
    """``scored`` with the text of its post, its own preview where there is none."""
    return scored.join(posts.select(key, F.col(text).alias("__text")), key, "left").withColumn("text", F.coalesce("__text", preview)).drop("__text")


def estimated_total(pages: DataFrame, *, page_size: int = 50) -> DataFrame:
    """One row from ``page, n``: last page that has posts, its count, and full pages before it plus that count."""
    some = pages.where(F.col("n") > 0)
    last = some.agg(F.max("page").alias("last_page"), F.max_by("n", "page").alias("last_count"))
    return last.select("last_page", "last_count", ((F.col("last_page") - 1) * page_size + F.col("last_count")).alias("estimated_total"))


def page_counts(rows: DataFrame, by: list[str], *, page_size: int = 50) -> DataFrame:
    """``by, page, n``: the pages that the rows of each ``by`` fill, from 1; rows are counted, not numbered."""
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    paged = counts.select(*by, "__n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.ceil(F.col("__n") / page_size))).alias("page"))
    return paged.select(*by, "page", F.least(F.lit(page_size).cast("bigint"), F.col("__n") - (F.col("page") - 1) * page_size).alias("n"))


def stop_page(pages: DataFrame, by: list[str], *, empties: int = 3) -> DataFrame:
    """Per ``by``: the last page that a reader sees who stops after ``empties`` empty pages in a row.

    Pages that are not there count as empty; the first page is 1. A page is beyond a gap if none of the ``empties``
    pages before it has posts; the reader stops before the first such. A null ``by`` has no
    row. All steps combine before they shuffle.
    """
    some = pages.where(F.col("n") > 0).select(*by, F.col("page").cast("bigint").alias("page")).distinct()
    reached = some.select(*by, F.explode(F.sequence(F.col("page") + 1, F.col("page") + empties)).alias("page")).distinct()
    beyond = some.where(F.col("page") > empties).join(reached, [*by, "page"], "left_anti").groupBy(*by).agg(F.min("page").alias("__gap"))
    kept = some.join(beyond, by, "left").where(F.col("__gap").isNull() | (F.col("page") < F.col("__gap")))
    return kept.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in by])).groupBy(*by).agg(F.max("page").alias("last_page"))


def first_open(batches: DataFrame, done: DataFrame, key: str, position: str) -> DataFrame:
    """One row: the first position that is not done; the end if all are done."""
    flagged = batches.join(done.select(key).distinct().withColumn("__done", F.lit(True)), key, "left")
    return flagged.agg(F.coalesce(F.min(F.when(F.col("__done").isNull(), F.col(position))), F.max(position) + 1).cast("bigint").alias("resume_at"))


def failed_once(known: DataFrame, failed: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Dead letters: known failures and the first new one of each key."""
    return merge_new(known, failed, key, order)


def index_row(df: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Posts as rows of an index: date cut from the time, number of images, '' and empty lists for nulls."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    published = F.coalesce("published_at", F.lit(""))
    base = df.select(
        text("id"),
        text("title"),
        published.alias("published_at"),
        F.substring(published, 1, 10).alias("published_date"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        F.greatest(F.coalesce(F.size("images"), F.lit(0)), F.lit(0)).cast("bigint").alias("images_count"),
        text("filename"),
        text("source_url"),
        *(c.alias(n) for n, c in (extra or {}).items()),
    )
    return base
