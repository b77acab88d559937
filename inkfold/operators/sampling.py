"""Bounded samples that do not depend on how a table is cut into files."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.session import durable


def hash_sample(df: DataFrame, text: str, n: int, chars: int, rows: int, name: str = "__h") -> DataFrame:
    """At most ``n`` distinct rows of ``df`` with at most ``chars`` characters of ``text`` in all: those that hash lowest.

    ``rows`` is the number of rows that ``df`` is drawn from. Rows above twice the wanted share of hashes are dropped
    where they are read, so about 2 ``n`` rows are written at any size of the table; if fewer than half of ``rows`` are
    left in ``df``, the sample may be smaller than ``n``. Only hashes and lengths are sorted and reach the driver, which
    finds the last hash within both bounds; no task sorts or holds the texts. A row whose text alone is longer than
    ``chars`` ends the sample before it. A null text has no characters.
    """
    kept = df.withColumn(name, F.xxhash64(*df.columns))
    share = min(1.0, 2.0 * n / max(rows, 1))
    if share < 1.0:
        kept = kept.where(F.col(name) < int(-(1 << 63) + share * (1 << 64)))
    kept = durable(kept)
    lengths = kept.groupBy(name).agg(F.max(F.coalesce(F.length(text), F.lit(0))).alias("size"))
    first = lengths.orderBy(name).limit(n).collect()  # at most n pairs of numbers
    within = [r[name] for r, so_far in zip(first, accumulate(r["size"] for r in first)) if so_far <= chars]
    return kept.where(F.col(name) <= (within[-1] if within else -(1 << 63))).drop(name).distinct()
