"""JSON indexes and lists, settings, line files."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.functions.text import strip
from inkfold.operators.ranks import global_rank

POST = "struct<id: string, title: string, published_at: string, published_date: string, tags: array<string>, images_count: bigint, filename: string, source_url: string, indexed_at: string>"
INDEX = f"total bigint, updated_at string, posts array<{POST}>, articles array<{POST}>, _bad string"


def index_rows(spark: SparkSession, path: str) -> DataFrame:
    """A row per post of index files; the list may be called ``posts`` or ``articles``; files that are no JSON give none."""
    raw = spark.read.schema(INDEX).option("columnNameOfCorruptRecord", "_bad").json(path, multiLine=True, mode="PERMISSIVE")
    return raw.select(F.input_file_name().alias("file_path"), F.explode(F.coalesce("posts", "articles")).alias("p")).select("file_path", "p.*")


def bad_indexes(spark: SparkSession, path: str) -> DataFrame:
    """Index files that could not be read: the dead letters of ``index_rows``."""
    raw = spark.read.schema(INDEX).option("columnNameOfCorruptRecord", "_bad").json(path, multiLine=True, mode="PERMISSIVE")
    return raw.select(
        F.input_file_name().alias("file_path"),
        "posts",
        "articles",
        "_bad",
    ).where(F.col("posts").isNull() & F.col("articles").isNull()).select("file_path")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A row per object of JSON arrays."""
    return spark.read.schema(schema).json(path, multiLine=True)


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """``keyword, words`` of JSON objects from keywords to lists."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string, array<string>>")).alias("keyword", "words"))


def checkpoint(path: str, default: dict | None = None) -> dict:
    """A small state file of one reader on the driver, with defaults for what is missing or unreadable."""
    start = {"lastPage": 0, "lastArticleIndex": -1, "downloaded": 0, "failedUrls": []} | (default or {})
    try:
        return start | json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return start


def _entries(text: str, root: str) -> list[dict]:
    """The flat maps of a YAML list under ``root``, read without a library."""
    rows: list[dict] = []
    inside = False
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        if not bare.strip() or bare.lstrip().startswith("#"):
            continue
        if not line[0].isspace() and not bare.startswith("-"):
            inside = bare.rstrip(":") == root
        elif inside:
            entry = bare.strip()
            if entry.startswith("- "):
                rows.append({})
                entry = entry[2:]
            key, sep, value = entry.partition(":")
            if rows and sep and value.strip() and key not in rows[-1]:
                rows[-1][key] = value.strip().strip("\"'")
    return rows


def settings(spark: SparkSession, path: str, root: str = "bloggers", *, keys: tuple[str, ...] = ("name", "uid")) -> DataFrame:
    """``keys`` as strings of the entries under ``root`` of a YAML file: settings, read on the driver; what is missing is null.

    PyYAML reads them where it is installed; without it only lists of flat maps are understood.
    """
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml

        rows = (yaml.load(text, yaml.BaseLoader) or {}).get(root) or []  # BaseLoader leaves numbers as they are written
    except ImportError:
        rows = _entries(text, root)
    return spark.createDataFrame([tuple(r.get(k) for k in keys) for r in rows if isinstance(r, dict)], ", ".join(f"{k} string" for k in keys))


def chosen(bloggers: DataFrame, uid: str | None) -> DataFrame:
    """Settings of one uid, all without one."""
    return bloggers if uid is None else bloggers.where(F.col("uid") == uid)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` of every line with other than white space, without it at its ends."""
    return spark.read.text(path).select(strip(F.col("value")).alias("line")).where(F.col("line") != "")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``pos, line`` of one text file of any size: its blocks are read by many tasks and numbered by their place."""
    read = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    return global_rank(read, ["block", "place"], "pos").select("pos", "line")


def zipped(left: DataFrame, right: DataFrame) -> DataFrame:
    """``pos, id, title`` of two frames of ``pos, line``, paired by place; a missing or empty title is the id, an empty id is none."""
    ids = left.select("pos", F.col("line").alias("id")).where(F.col("id") != "")
    titles = right.select("pos", F.col("line").alias("title"))
    return ids.join(titles, "pos", "left").select("pos", "id", F.coalesce(F.nullif("title", F.lit("")), "id").alias("title"))
