"""Incremental ingest: what was read is never read again, what was merged is never merged twice."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from inkfold.operators import orphans


def new_files(spark: SparkSession, path: str, schema: str | StructType, *, files_per_batch: int = 1_000, kind: str = "parquet") -> DataFrame:
    """A stream of the files that come into a folder."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def merge_into(stream: DataFrame, key: str, target: str, state: str) -> StreamingQuery:
    """Writes the first row of every key to ``target`` and ends when all there is has been read.

    ``state`` holds the offsets and the keys seen; a second run goes on from there. Null keys are one key. Keys stay in
    the state for ever; ``merge_by_target`` has none.
    """
    return stream.dropDuplicates([key]).writeStream.format("parquet").option("path", target).option(
        "checkpointLocation",
        state,
    ).outputMode("append").trigger(availableNow=True).start()


def merge_by_target(stream: DataFrame, key: str, target: str, state: str) -> StreamingQuery:
    """As ``merge_into`` without keys in the state: each micro-batch leaves out the keys that ``target`` has.

    A batch is one folder of ``target`` and is compared with the others, so one that comes again replaces itself.
    """

    def run(batch: DataFrame, number: int) -> None:
        new = batch.dropDuplicates([key])
        spark = batch.sparkSession
        with suppress(AnalysisException):  # there is no target yet
            there = spark.read.option("basePath", target).parquet(f"{target}/batch=*").where(F.col("batch") != number).select(
                F.col(key).alias("__key")
            ).distinct()
            new = new.join(there, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
        new.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", state).trigger(availableNow=True).start()


def save_results(stream: DataFrame, folder: str, state: str) -> StreamingQuery:
    """Results as JSON lines, saved with every micro-batch; a batch that comes again replaces itself."""

    def run(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").json(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", state).trigger(availableNow=True).start()


class Progress(StreamingQueryListener):
    """Keeps a row per micro-batch of every stream of the session; ``spark.streams.addListener(Progress())`` starts it."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, int, int]] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.rows.append((str(event.progress.runId), event.progress.batchId, event.progress.numInputRows))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "run_id string, batch_id bigint, n_rows bigint")


def each_batch(stream: DataFrame, state: str, good: Callable[[DataFrame, int], None], bad: Callable[[DataFrame, int], None], is_bad) -> StreamingQuery:
    """Hands every micro-batch to ``good`` and its broken rows to ``bad``."""

    def run(batch: DataFrame, number: int) -> None:
        good(batch.where(~F.coalesce(is_bad, F.lit(False))), number)
        bad(batch.where(F.coalesce(is_bad, F.lit(False))), number)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", state).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, by: str, *, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Rows per window of event time and ``by``; rows later than ``late`` are dropped. Not in the reference's range of features."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count(F.lit(1)).alias("n"))


def track_orphans(stream: DataFrame, store: orphans.OrphanStore, state: str, cut: Callable[[DataFrame], orphans.Increment]) -> StreamingQuery:
    """Applies every micro-batch, as ``cut`` makes an increment of it, to ``store``; one that comes again changes nothing."""

    def run(batch: DataFrame, number: int) -> None:
        store.step(cut(batch), number)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", state).trigger(availableNow=True).start()
