"""Counts over dates, tags, keywords and lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.functions.text import bar, let


def by_prefix(df: DataFrame, date: str, length: int, name: str) -> DataFrame:
    """Rows per first ``length`` characters of a date string; null and empty dates are left out."""
    return df.where(F.col(date) != "").groupBy(F.substring(date, 1, length).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def date_report(df: DataFrame, date: str, length: str) -> DataFrame:
    """One row: total, first and last date, counts by year, and by month with the floor of the mean length.

    The months are counted first and the report is put together from them, so one row a month meets in one task.
    An empty table gives a total of 0, null dates and empty maps.
    """
    dated = df.where(F.col(date) != "")
    months = dated.groupBy(F.substring(date, 1, 4).alias("y"), F.substring(date, 1, 7).alias("m")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(length).alias("chars"),
        F.min(date).alias("lo"),
        F.max(date).alias("hi"),
    )
    month = F.struct(
        F.col("m").alias("month"),
        F.col("n").alias("n"),
        F.coalesce(F.floor(F.col("chars") / F.col("n")), F.lit(0)).cast("bigint").alias("avg_length"),
    )
    years = F.array_sort(F.collect_list(F.struct("y", "n")))
    rolled = F.aggregate(
        years,
        F.create_map().cast("map<string,bigint>"),
        lambda m, x: F.map_concat(
            F.map_filter(m, lambda k, _: k != x["y"]),
            F.create_map(x["y"], F.coalesce(F.try_element_at(m, x["y"]), F.lit(0)) + x["n"]),
        ),
    )
    return months.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.min("lo").alias("earliest"),
        F.max("hi").alias("latest"),
        rolled.alias("years"),
        F.array_sort(F.collect_list(month)).alias("months"),
    )


def latest(counts: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the last keys, the last first."""
    return counts.orderBy(F.desc(key)).limit(n)


def last_in_order(counts: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the last keys, in order of the key."""
    return latest(counts, key, n).orderBy(key)


def tag_maps(counts: DataFrame, *, top: int = 20, most: int = 50) -> DataFrame:
    """One row from ``item, n, first_at``: distinct items, the ``top`` as a list and the ``most`` frequent as a map; ties by first place."""
    total = counts.agg(F.count(F.lit(1)).alias("total_tags"))
    first = counts.orderBy(F.desc("n"), "first_at").limit(most)
    pair = F.struct((-F.col("n")).alias("k"), "first_at", F.struct("item", "n").alias("p"))
    listed = first.agg(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["p"]).alias("__all"))  # at most ``most``
    return total.join(listed).select(
        "total_tags",
        F.slice("__all", 1, top).alias("top_tags"),
        F.map_from_entries("__all").alias("tags_distribution"),
    )  # one row each


def list_counts(df: DataFrame, items: str, order: list[str], *, top: int | None = None, name: str = "item") -> DataFrame:
    """``item, n, first_at``: occurrences in an array column and where an item is first seen; equal counts go by that.

    ``order`` are the columns in which rows are seen; they and the place in the array make a total order. Null items
    are left out, '' is an item.
    """
    seen = df.select(*order, F.posexplode(items).alias("at", name)).where(F.col(name).isNotNull())
    counted = seen.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order, "at")).alias("first_at"))
    return counted if top is None else counted.orderBy(F.desc("n"), "first_at").limit(top)


def token_counts(tokens: Column) -> Column:
    """``array<struct<most, at, keyword>>`` of the distinct tokens of an array: minus the count, the first place, the token.

    Sorted, equal tokens are neighbours: a token begins where its left neighbour is another, and its count is the
    distance to the next beginning. Nothing leaves the row.
    """
    placed = F.array_sort(F.transform(tokens, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def counted(own: Column) -> Column:
        places = F.when(F.size(own) > 0, F.sequence(F.lit(1), F.size(own))).otherwise(F.array().cast("array<int>"))
        begins = F.filter(places, lambda k: (k == 1) | (F.get(own, k - 1)["w"] != F.get(own, k - 2)["w"]))
        of = lambda b: F.transform(
            b,
            lambda k, j: F.struct(
                (k - F.coalesce(F.get(b, j + 1), F.size(own) + 1)).alias("most"),
                F.get(own, k - 1)["i"].alias("at"),
                F.get(own, k - 1)["w"].alias("keyword"),
            ),
        )
        return let(begins, of)

    return let(placed, counted)


def keywords(df: DataFrame, keep: list[str], tokens: Column, top: int = 10) -> DataFrame:
    """The ``top`` most frequent tokens of each row, ties in order of first place: ``keep..., keyword, n, rank``. No shuffle."""
    best = F.slice(F.array_sort(token_counts(tokens)), 1, top)
    ranked = df.select(*keep, F.posexplode(best).alias("__at", "__best"))
    return ranked.select(
        *keep,
        F.col("__best.keyword").alias("keyword"),
        (-F.col("__best.most")).cast("bigint").alias("n"),
        (F.col("__at") + 1).cast("bigint").alias("rank"),
    )


def chart(counts: DataFrame, key: str, per: int, width: int) -> DataFrame:
    """A text line per count, in order of the key: key, count right-aligned, a bar."""
    line = F.concat(F.col(key), F.lit(": "), F.lpad(F.col("n").cast("string"), width, " "), F.lit(" "), bar(F.col("n"), per))
    return counts.select(key, F.rtrim(line).alias("line"))
