"""Aggregation per key when a few keys hold most rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.terms import normal_terms
from inkfold.functions.times import instant
from inkfold.session import durable


class Measure(NamedTuple):
    """``kind`` of count, sum, min or max of ``value`` (for count: rows with a non-null value)."""

    name: str
    kind: str
    value: Column


_FIRST = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def heavy_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys with at least ``share`` of all rows, and two: one pass counts keys (combined before the shuffle) and, from these, rows."""
    sizes = durable(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")))
    rows = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    return sizes.where(F.col("__n") >= max(2, int(rows * share))).select(*keys)


def salted_aggregate(
    df: DataFrame,
    keys: list[str],
    measures: list[Measure],
    spread: list[Column],
    *,
    heavy_share: float = 0.001,
    salts: int = 64,
) -> DataFrame:
    """One row per key with every measure, in two stages.

    Keys holding at least ``heavy_share`` of all rows get one of ``salts`` salts each row, partial results are taken
    per (key, salt), and the partials are merged by key. At most 1/heavy_share keys can be heavy, which bounds the
    broadcast. The salt is a hash of ``spread`` rather than a random number: a task that runs again after a lost
    executor gives each row the same salt, so no row is lost or counted twice.

    Null keys form a key of their own. An empty input gives no rows. Other columns of ``df`` are not read, and may
    carry any name that doesn't begin with ``__``.
    """
    work = df.select(
        *keys,
        *(m.value.alias(f"__m{i}") for i, m in enumerate(measures)),
        F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int").alias("__spread"),
    )
    heavy = heavy_keys(df.select(*keys), keys, heavy_share)
    marks = heavy.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.lit(True).alias("__heavy"))
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    joined = work.join(F.broadcast(marks), same, "left")  # at most 1/heavy_share rows
    salted = joined.withColumn("__salt", F.when(F.col("__heavy"), F.col("__spread")).otherwise(F.lit(-1)))
    partial = salted.groupBy(*keys, "__salt").agg(*(_FIRST[m.kind](f"__m{i}").alias(f"__m{i}") for i, m in enumerate(measures)))
    return partial.groupBy(*keys).agg(*(_MERGE[m.kind](f"__m{i}").alias(m.name) for i, m in enumerate(measures)))


def post_key_profiles(posts: DataFrame, *, heavy_share: float = 0.001, salts: int = 64) -> DataFrame:
    """Of every author_uid and every tag term of ``posts``: rows, first and last time published, total body length.

    Columns ``field_name, key_value, n_rows, first_published, last_published, body_chars``. A term counts once a row;
    null authors and empty terms are no keys; a time that can't be read and a null body are left out of the dates and
    the lengths, so the dates may be null and the length is 0 where no row has one.
    """
    base = posts.select(
        "post_row",
        "author_uid",
        "tags",
        instant(F.col("published_at")).alias("__at"),
        F.coalesce(F.length("body"), F.lit(0)).cast("bigint").alias("__chars"),
    )
    key = "struct<field_name: string, key_value: string>"
    author = F.array(F.struct(F.lit("author_uid").alias("field_name"), F.col("author_uid").alias("key_value")).cast(key))
    terms = F.transform(F.array_distinct(normal_terms(F.col("tags"))), lambda t: F.struct(F.lit("tags").alias("field_name"), t.alias("key_value")).cast(key))
    both = F.concat(author, F.coalesce(terms, F.array().cast(f"array<{key}>")))
    keyed = base.select(
        "post_row",
        "__at",
        "__chars",
        F.explode(both).alias("k"),
    ).select("post_row", "__at", "__chars", "k.*").where(F.col("key_value").isNotNull())
    return salted_aggregate(
        keyed,
        ["field_name", "key_value"],
        [
            Measure("n_rows", "count", F.lit(1)),
            Measure("first_published", "min", F.col("__at")),
            Measure("last_published", "max", F.col("__at")),
            Measure("body_chars", "sum", F.col("__chars")),
        ],
        [F.col("post_row")],
        heavy_share=heavy_share,
        salts=salts,
    )
