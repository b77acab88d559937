"""Quality and integrity of stored posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.text import percent, strip

MIN_BODY, MIN_TITLE = 100, 3
# Files that are no posts, by parts of their names; fixed values.
NOT_POSTS = (".checkpoint", "index.json", "index.md", "MISSING_ARTICLES", "DELETED_ARTICLES", "STATISTICS")
# Keys that a stored post must mention; fixed values.
REQUIRED = ("id:", "author_uid:", "author_name:", "published_at:", "source_url:")
# What stands in place of content; fixed values.
PLACEHOLDERS = r"\A(?:#+\s*\z|无内容\z|待补充\z|内容加载中|请稍后)"


def is_post_file(name: Column, parts: tuple[str, ...] = NOT_POSTS) -> Column:
    """Whether a file name has none of ``parts``."""
    return ~F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(name, p))


def is_placeholder(body: Column) -> Column:
    return strip(body).rlike(PLACEHOLDERS)


def _short(text: Column, least: int) -> Column:
    return F.coalesce(F.length(text), F.lit(0)) < least


def _none(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def check_first_title(title: Column, date: Column, body: Column) -> Column:
    """Quality by title, date, length and place-holder, in this order; null counts as ''."""
    return (
        F.when(_short(title, MIN_TITLE), "missing_title")
        .when(_none(date), "missing_date")
        .when(_short(body, MIN_BODY), "short_content")
        .when(is_placeholder(F.coalesce(body, F.lit(""))), "placeholder")
        .otherwise("valid")
    )


def check_first_body(title: Column, date: Column, body: Column) -> Column:
    """Quality by length, title and date, in this order; null counts as ''."""
    return F.when(_short(body, MIN_BODY), "short_content").when(_short(title, MIN_TITLE), "missing_title").when(_none(date), "missing_date").otherwise("valid")


def integrity_issue(content: Column) -> Column:
    """The first issue of a file's text (missing keys, then tags that are no list), null without one."""
    missing = F.filter(F.array(*map(F.lit, REQUIRED)), lambda k: ~F.contains(content, k))
    tags = strip(F.regexp_extract(content, r"tags:[ \t]*(.+)", 1))
    return F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, " "))).when((tags != "") & ~tags.startswith("["), "tags")


def counts_of(df: DataFrame, label: str, labels: tuple[str, ...]) -> DataFrame:
    """One row: ``total_files``, a count per label, the valid share in percent and a status."""
    valid = F.count_if(F.col(label) == "valid")
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_files"),
        *(F.count_if(F.col(label) == x).alias(f"{x}_count") for x in labels),
        percent(valid, total).alias("quality_percent"),
        F.when(valid == total, "ok").otherwise("degraded").alias("status"),
    )


def integrity_counts(df: DataFrame, issue: str) -> DataFrame:
    """One row: files, those without and with an issue, the share without in percent, a status."""
    total, bad = F.count(F.lit(1)), F.count_if(F.col(issue).isNotNull())
    return df.agg(
        total.alias("total_files"),
        (total - bad).alias("valid_count"),
        bad.alias("corrupted_count"),
        percent(total - bad, total).alias("integrity_percent"),
        F.when(bad == 0, "ok").otherwise("corrupted").alias("status"),
    )


def full_report(quantity: DataFrame, content: DataFrame, integrity: DataFrame) -> DataFrame:
    """One row: the three reports as structs, whether all are ok, and what to do.

    ``quantity`` is a row of ``reconcile``, ``content`` of ``counts_of``, ``integrity`` of ``integrity_counts``.
    """
    whole = lambda df, name: df.select(F.struct(*df.columns).alias(name))
    parts = whole(quantity, "quantity").join(whole(content, "content_quality")).join(whole(integrity, "file_integrity"))  # one row each
    ok = (F.col("quantity.status") == "ok") & (F.col("content_quality.status") == "ok") & (F.col("file_integrity.status") == "ok")
    todo = advice(
        *map(
            F.col,
            (
                "quantity.n_missing",
                "quantity.n_extra",
                "quantity.completeness_percent",
                "content_quality.short_content_count",
                "content_quality.missing_title_count",
                "file_integrity.corrupted_count",
            ),
        )
    )
    return parts.select("*", F.when(ok, "ok").otherwise("issues_found").alias("overall_status"), todo.alias("recommendations"))


def length_stats(df: DataFrame, length: str) -> DataFrame:
    """One row: floor of the mean, least and most of the lengths above 0; 0 where there are none."""
    some = df.where(F.col(length) > 0)
    return some.agg(
        *(
            F.coalesce(x.cast("bigint"), F.lit(0)).alias(n) for n, x in (
                ("avg_length", F.floor(F.sum(length) / F.count(length))),
                ("min_length", F.min(length)),
                ("max_length", F.max(length)),
            )
        )
    )


def band(completeness: Column) -> Column:
    """Status of a completeness in percent."""
    return F.when(completeness >= 100, "complete").when(
        completeness >= 99,
        "nearly complete",
    ).when(completeness >= 90, "incomplete").otherwise("badly incomplete")


def completeness(got: Column, wanted: Column) -> Column:
    """Smaller by larger number in percent; 0 if nothing is wanted."""
    return F.when(wanted > 0, F.least(got, wanted) * F.lit(100.0) / F.greatest(got, wanted)).otherwise(F.lit(0.0))


def advice(missing: Column, extra: Column, complete: Column, short: Column, untitled: Column, corrupted: Column) -> Column:
    """What to do, as an array: a line per problem, one line if there is none."""
    lines = F.array(
        F.when(missing > 0, F.concat(F.lit("missing: "), missing.cast("string"))),
        F.when(extra > 0, F.concat(F.lit("not listed: "), extra.cast("string"))),
        F.when((missing > 0) & (complete < 99), F.concat(F.lit("completeness: "), F.format_number(complete, 1), F.lit("%"))),
        F.when(short > 0, F.concat(F.lit("short: "), short.cast("string"))),
        F.when(untitled > 0, F.concat(F.lit("untitled: "), untitled.cast("string"))),
        F.when(corrupted > 0, F.concat(F.lit("corrupted: "), corrupted.cast("string"))),
    )
    found = F.filter(lines, lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("all checks passed")))
