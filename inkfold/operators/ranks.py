"""Dense numbering of a whole table in a total order, without one task that sees it all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.session import durable


def global_rank(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2... in ``order``, which should be total (ties are numbered in no fixed order).

    The table is range-partitioned, sorted within partitions and written once, so the numbers cannot change when a
    task runs again; only one count per partition goes through the driver. An empty table stays empty.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = durable(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__place", F.monotonically_increasing_id()))
    part, local = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row per partition
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, "__part bigint, __start bigint")
    return placed.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn(name, F.col("__start") + local).select(*df.columns, name)


def running_before(df: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows that come before a row in ``order``, among those of its ``by``.

    ``order`` should be total within ``by``; nulls in ``by`` are one value, null ``value`` counts 0. The table is
    range-partitioned by both and written once, so a value of ``by`` that a third of all rows have is spread over many
    tasks: each adds up its own block, and a sum per value and block, of which a value has at most one a task, tells
    what the blocks before hold.
    """
    cols = [*by, *order]
    placed = durable(
        df.withColumn(
            "__value",
            F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint")),
        ).repartitionByRange(*map(F.col, cols)).withColumn("__part", F.spark_partition_id())
    )
    blocks = placed.groupBy(*by, "__part").agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    marks = [F.col(c).alias(f"__by{i}") for i, c in enumerate(by)]
    starts = blocks.select(*marks, F.col("__part").alias("__own"), F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*by, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = placed.withColumn("__inside", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    same = (F.col("__part") == F.col("__own")) & reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__by{i}")) for i, c in enumerate(by)])
    return counted.join(starts, same).select(*df.columns, (F.col("__start") + F.col("__inside")).cast("bigint").alias(name))
