"""Posts stored as Markdown files, one file a row."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.functions.frontmatter import split_fences
from inkfold.functions.text import first_heading, json_list, strip, valid_utf8
from inkfold.operators.quality import NOT_POSTS, is_post_file

#: Names and bytes that a task hands on at a time; a longer file makes a batch of its own.
NAMES, BYTES = 10_000, 8 << 20


@lru_cache
def _system(host: str) -> tuple[FileSystem, str]:
    """pyarrow's file system of ``scheme://host``, and what its paths begin with."""
    system, base = FileSystem.from_uri(re.sub("^s3[an]:", "s3:", host) + "/")
    return system, base.rstrip("/")


def _place(address: str) -> tuple[FileSystem, str]:
    """The file system of an address as Hadoop writes it, and the path in it."""
    host, path = re.fullmatch(r"(file:(?://(?=/))?|[^/:]+://[^/]*)(.*)", address, re.DOTALL).groups()
    if host.startswith("file:"):
        return LocalFileSystem(), path
    system, base = _system(host)
    return system, base + path


def _children(address: str) -> Iterator[tuple[str, bool]]:
    """``name, whether it is a folder`` of what is in a folder; a local one is never held as a whole."""
    system, path = _place(address)
    if isinstance(system, LocalFileSystem):
        with os.scandir(path) as found:
            yield from ((e.name, e.is_dir()) for e in found)
    else:
        yield from ((i.base_name, i.type == FileType.Directory) for i in system.get_file_info(FileSelector(path)))


def _hidden(name: str) -> bool:
    """Names that Spark's own readers leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def names(spark: SparkSession, path: str, *, recursive: bool = False, prefix: str = "", suffix: str = ".md", skip: tuple[str, ...] = NOT_POSTS) -> DataFrame:
    """``file_path, file_name`` of the files of a folder, or of the folders and files that a pattern of Hadoop's matches.

    A task lists a folder and hands its names on in batches, so neither the driver nor a task holds them, however many
    there are; the driver has what the pattern matches. The file system is one that pyarrow knows, as in ``write_files``.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    roots = [(s.getPath().toString(), s.isFile()) for s in where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or ()]
    if not roots:
        raise AnalysisException(f"Path does not exist: {path}")

    def walk(address: str, is_file: bool) -> Iterator[tuple[str, str]]:
        folders = [] if is_file else [address]
        if is_file:
            yield address, address.rpartition("/")[2]
        while folders:
            at = folders.pop()
            for name, is_folder in _children(at):
                if _hidden(name):
                    continue
                if not is_folder:
                    yield f"{at.rstrip('/')}/{name}", name
                elif recursive:
                    folders.append(f"{at.rstrip('/')}/{name}")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root in batch.to_pylist():
                kept = (x for x in walk(**root) if x[1].startswith(prefix) and x[1].endswith(suffix, len(prefix)))
                while held := list(islice(kept, NAMES)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], ["file_path", "file_name"])

    found = spark.createDataFrame(roots, "address string, is_file boolean").mapInArrow(listed, "file_path string, file_name string")
    return found.where(is_post_file(F.col("file_name"), skip))


def _bytes(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in paths:
        held, size = [], 0
        for address in batch.to_pylist():
            system, path = _place(address)
            with system.open_input_stream(path) as file:
                held.append(file.read())
            size += len(held[-1])
            if size >= BYTES:
                yield pa.array(held, pa.binary())
                held, size = [], 0
        if held:
            yield pa.array(held, pa.binary())


def with_content(named: DataFrame) -> DataFrame:
    """``named`` and its files' ``content``, read where that is used; bytes that are no UTF-8 are left out."""
    read = F.arrow_udf(_bytes, "binary").asNondeterministic()  # else a condition on the content would read each file a second time
    return named.withColumn("__bytes", read("file_path")).withColumn("content", valid_utf8(F.col("__bytes"))).drop("__bytes")


def files(spark: SparkSession, path: str, *, recursive: bool = False, prefix: str = "", suffix: str = ".md", skip: tuple[str, ...] = NOT_POSTS) -> DataFrame:
    """``file_path, file_name, content``: ``names``, spread over the tasks that read them. Names are filtered before files are read."""
    found = names(spark, path, recursive=recursive, prefix=prefix, suffix=suffix, skip=skip)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return with_content(found.repartition(tasks, "file_path"))


def first_files(found: DataFrame, n: int = 50) -> DataFrame:
    """The first ``n`` files by name; no other is read."""
    return with_content(found.select("file_path", "file_name").orderBy("file_name", "file_path").limit(n))


def stored_ids(found: DataFrame) -> DataFrame:
    """``id``: what stands before the first ``_`` of each name."""
    return found.select(F.substring_index(F.regexp_replace("file_name", r"\.md$", ""), "_", 1).alias("id")).distinct()


def articles(found: DataFrame) -> DataFrame:
    """Files as typed articles. Files without three parts between fences are left out; a number that isn't one gives null.

    The title is the first heading, the body begins with it; dates stay strings and are cut by place.
    """
    part = found.select("file_name", split_fences(F.col("content")).alias("p")).where(F.col("p").isNotNull())
    meta = lambda k: F.coalesce(F.try_element_at("p.meta", F.lit(k)), F.lit(""))
    date = meta("published_at")
    body = F.regexp_replace(F.col("p.body"), r"\A\n", "")
    return part.select(
        F.col("file_name").alias("filename"),
        meta("id").alias("id"),
        first_heading(body).alias("title"),
        date.alias("published_at"),
        F.substring(date, 1, 10).alias("published_date"),
        F.substring(date, 1, 4).alias("published_year"),
        F.substring(date, 1, 7).alias("published_month"),
        meta("source_url").alias("source_url"),
        json_list(meta("tags")).alias("tags"),
        strip(meta("images_count")).try_cast("int").alias("images_count"),
        F.length(body).alias("body_length"),
        body.alias("body"),
    )


def by_keywords(found: DataFrame, words: list[str], *, per_word: int = 2, budget: int | None = None) -> DataFrame:
    """``word, file_name, content`` of the first files whose names hold each word, cut off when the budget of characters is used up.

    Only the files that are kept are read.
    """
    from pyspark.sql import Window

    hits = found.select("file_path", "file_name", F.explode(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains("file_name", w))).alias("word"))
    at = F.row_number().over(Window.partitionBy("word").orderBy("file_name", "file_path"))
    best = with_content(hits.withColumn("__at", at).where(F.col("__at") <= per_word))
    if budget is not None:
        used = F.coalesce(
            F.sum(F.length("content")).over(Window.orderBy("word", "__at").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        )  # per_word rows of each word
        best = best.withColumn("__used", used).where(F.col("__used") <= budget)
    return best.select("word", "file_name", "content")
