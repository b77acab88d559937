"""Pairs of items that share records, and how much more often than chance.

Items get dense 32-bit ids in code-point order; a pair is one 64-bit code. Tasks sort full buffers of codes and pass
on runs of (code, count); Spark's external sort spills and merges the runs by code, and a run-length pass adds up
neighbours. Items below the wanted support are dropped first: no pair can have more rows than its rarer item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.operators.ranks import global_rank
from inkfold.session import durable

_RUNS = "code bigint, n bigint"
#: Codes that a task sorts at once: 32 MB.
BUFFER = 4_000_000


def _batch(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], names=["code", "n"])


def _pair_codes(rows: np.ndarray, ids: np.ndarray) -> Iterator[np.ndarray]:
    """Codes of all pairs within a row, by distance in the row's sorted ids. Rows and ids are sorted and distinct."""
    d = 1
    while d < len(ids):
        left = np.flatnonzero(rows[:-d] == rows[d:])
        if not len(left):
            return
        yield (ids[left] << 32) | ids[left + d]
        d += 1


def _runs(lookup):
    """Lists of items (or of ids, without ``lookup``) to sorted runs of pair codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush():
            nonlocal size
            codes, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            size = 0
            return _batch(codes, counts)

        for batch in batches:
            lists = batch.column(0)
            rows = lists.value_parent_indices().to_numpy()
            if lookup is None:
                ids = lists.flatten().to_numpy().astype(np.int64)
            else:
                index = lookup.value
                ids = np.fromiter((index.get(x, -1) for x in lists.flatten().to_pylist()), np.int64)
            keep = ids >= 0
            rows, ids = rows[keep], ids[keep]
            order = np.lexsort((ids, rows))
            for codes in _pair_codes(rows[order], ids[order]):
                held.append(codes)
                size += len(codes)
                if size >= BUFFER:
                    yield flush()
        if held:
            yield flush()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run-length sums over codes in order; the last code of a batch waits for the next batch."""
    code, n = None, 0
    for batch in batches:
        codes, counts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(codes):
            continue
        if code is not None:
            codes, counts = np.concatenate([[code], codes]), np.concatenate([[n], counts])
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        sums = np.add.reduceat(counts, starts)
        code, n = codes[-1], sums[-1]
        yield _batch(codes[starts[:-1]], sums[:-1])
    if code is not None:
        yield _batch(np.array([code]), np.array([n]))


def pair_counts(baskets: DataFrame, items: str, min_rows: int, *, max_broadcast_items: int = 200_000) -> DataFrame:
    """``item_a, item_b, rows_a, rows_b, rows_both`` of all pairs that at least ``min_rows`` rows hold, item_a < item_b.

    ``items`` is an array column without repeats or nulls; null and empty arrays hold no pairs. Items with fewer than
    ``min_rows`` rows are left out before pairs are made, which loses none. The dictionary of the other items goes to
    the tasks whole if it has at most ``max_broadcast_items``; a larger one is joined instead.
    """
    spark = baskets.sparkSession
    lists = baskets.select(F.col(items).alias("items"))
    support = lists.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") >= min_rows)
    dictionary = durable(global_rank(support, ["item"], "id"))
    if dictionary.count() <= max_broadcast_items:
        index = {r["item"]: r["id"] for r in dictionary.select("item", "id").toLocalIterator()}
        runs = lists.mapInArrow(_runs(spark.sparkContext.broadcast(index)), _RUNS)
        small = F.broadcast(dictionary)
    else:
        rows = lists.withColumn("__row", F.monotonically_increasing_id())
        numbered = durable(rows.select("__row", F.explode("items").alias("item"))).join(dictionary.select("item", "id"), "item")
        runs = numbered.groupBy("__row").agg(F.collect_list("id").alias("ids")).select("ids").mapInArrow(_runs(None), _RUNS)
        small = dictionary
    sorted_runs = runs.repartition("code").sortWithinPartitions("code")
    counts = sorted_runs.mapInArrow(_merge, _RUNS).where(F.col("n") >= min_rows)
    pairs = counts.select(F.shiftright("code", 32).alias("a"), F.col("code").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), F.col("n").alias("rows_both"))
    named = pairs.join(small.select(F.col("id").alias("a"), F.col("item").alias("item_a"), F.col("n_rows").alias("rows_a")), "a")
    named = named.join(small.select(F.col("id").alias("b"), F.col("item").alias("item_b"), F.col("n_rows").alias("rows_b")), "b")
    return named.select("item_a", "item_b", "rows_a", "rows_b", "rows_both")


def association(pairs: DataFrame, n_rows: int) -> DataFrame:
    """Pairs with ``lift`` (observed by expected rows) and ``log_odds``, its odds ratio's logarithm with 0.5 added to each cell."""
    both, a, b = F.col("rows_both"), F.col("rows_a"), F.col("rows_b")
    odds = ((both + 0.5) * (F.lit(n_rows) - a - b + both + 0.5)) / ((a - both + 0.5) * (b - both + 0.5))
    lift = both.cast("double") * n_rows / (a.cast("double") * b)
    return pairs.withColumn("lift", lift).withColumn("log_odds", F.log(odds))


def at_least_lift(pairs: DataFrame, n_rows: int, lift: int) -> DataFrame:
    """Pairs with rows_both * n_rows >= lift * rows_a * rows_b, in exact whole numbers."""
    whole = "decimal(19,0)"
    left = F.col("rows_both").cast(whole) * F.lit(n_rows).cast(whole)
    right = F.col("rows_a").cast(whole) * F.col("rows_b").cast(whole)
    return pairs.where(left >= right * F.lit(lift).cast("decimal(9,0)"))
