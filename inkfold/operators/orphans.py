"""References to records that do not exist, kept up to date increment by increment.

State is two tables, both cut into buckets by a hash of the key. ``parents`` has a row per key: the earliest time its
target was stored (null: not stored) and whether a removal is known. ``references`` has a row per reference with its
present kind: ``deleted``, ``missing``, ``late`` or ``ok``. An increment reads and writes only the buckets of the keys
it mentions: its references probe the parent index, parents that arrive resolve the orphans that wait for them,
removals and withdrawals reopen what had been resolved.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.functions.terms import SPACE
from inkfold.functions.times import instant, month_of
from inkfold.session import children, durable, new_path, release

PARENTS = "key_kind string, ref_key string, first_seen timestamp, removed boolean"
REFERENCES = "table_name string, row_id bigint, field_name string, key_kind string, ref_key string, ref_at timestamp, kind string"
_KEY = ["key_kind", "ref_key"]


def _bare(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", ""))


def file_key(name: Column) -> Column:
    """Last path segment (either slash) in lower case without white space around it; '' where there is none."""
    return _bare(F.regexp_extract(_bare(name), r"([^/\\]*)[/\\]*$", 1))


def address_key(url: Column) -> Column:
    """Address in lower case without white space around it, scheme, query, fragment and closing slashes."""
    no_scheme = F.regexp_replace(_bare(url), r"^([a-z][a-z0-9+.-]*:)?//", "")
    return _bare(F.regexp_replace(F.regexp_replace(no_scheme, r"[?#][\s\S]*$", ""), r"/+$", ""))


class Increment(NamedTuple):
    """What one step brings; any part may be None.

    ``stored(key_kind, ref_key, seen_at)``: targets stored; a null time counts as from the start. ``removed(key_kind,
    ref_key)``: targets known to be taken down; they stay in the index if they are stored. ``withdrawn(key_kind,
    ref_key, gone_at)``: targets no longer stored; what was stored after ``gone_at`` is, also within one increment; a
    null ``gone_at`` is after everything. ``references(table_name, row_id, field_name, key_kind, ref_key, ref_at)``:
    new references; those with a null or empty key are none.
    """

    stored: DataFrame | None = None
    removed: DataFrame | None = None
    withdrawn: DataFrame | None = None
    references: DataFrame | None = None


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*_KEY), F.lit(buckets)).cast("int")


def _changes(step: Increment, buckets: int) -> DataFrame | None:
    """``bucket, key, first_seen, removed, gone_at``: one row per key that the step's parents change, combined before the shuffle."""
    never, start, end = (F.lit(x).cast("timestamp") for x in (None, "0001-01-01 00:00:00", "9999-12-31 00:00:00"))
    parts = [
        df.where(F.col("ref_key") != "").select(*_KEY, seen.alias("first_seen"), F.lit(removed).alias("removed"), gone.alias("gone_at"))
        for df, seen, removed, gone in (
            (step.stored, F.coalesce("seen_at", start), False, never),
            (step.removed, never, True, never),
            (step.withdrawn, never, True, F.coalesce("gone_at", end)),
        )
        if df is not None
    ]
    if not parts:
        return None
    rows = reduce(DataFrame.unionByName, parts)
    if step.withdrawn is not None:  # what was stored before the last withdrawal is not stored
        gone = parts[-1].groupBy(*_KEY).agg(F.max("gone_at").alias("__gone"))
        rows = rows.join(gone, _KEY, "left").withColumn(
            "first_seen",
            F.when(F.col("__gone").isNull() | (F.col("first_seen") > F.col("__gone")), F.col("first_seen")),
        ).drop("__gone")
    merged = rows.groupBy(*_KEY).agg(F.min("first_seen").alias("first_seen"), F.max("removed").alias("removed"), F.max("gone_at").alias("gone_at"))
    return merged.withColumn("bucket", _bucket(buckets))


def _judge(references: DataFrame, parents: DataFrame) -> DataFrame:
    """References with their kind. Parents are unique by key, so a hot key only lengthens the reference side, which AQE splits."""
    kind = (
        F.when(F.col("first_seen").isNotNull(), F.when(F.col("first_seen") > F.col("ref_at"), "late").otherwise("ok"))
        .when(F.coalesce(F.col("removed"), F.lit(False)), "deleted")
        .otherwise("missing")
    )
    return references.join(parents, _KEY, "left").select("table_name", "row_id", "field_name", *_KEY, "ref_at", kind.alias("kind"))


class OrphanStore:
    """The state in the shared folder, by bucket, and the steps that change it.

    Each bucket of a table is one folder; a step writes new folders for the buckets that it touches, then deletes those
    they replace, so an executor or a step that is lost leaves the state before it. Frames of the state are good until
    the next step. ``buckets`` should be many times the number of keys in a usual increment for steps to be cheap.

    Steps may come in any order and cut: the final kinds depend only on what all steps brought, withdrawals apart, which
    undo what was stored before them. References that are repeated stay repeated. An empty store has no references.
    """

    def __init__(self, spark: SparkSession, buckets: int = 64) -> None:
        self.spark, self.buckets = spark, buckets
        self.folders: dict[str, dict[int, str]] = {"parents": {}, "references": {}}
        self.last_step: int | None = None

    def _read(self, table: str, schema: str, touched: list[int] | None = None) -> DataFrame:
        own = self.folders[table]
        paths = [own[b] for b in (own if touched is None else touched) if b in own]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    @property
    def parents(self) -> DataFrame:
        return self._read("parents", PARENTS)

    @property
    def references(self) -> DataFrame:
        return self._read("references", REFERENCES)

    def _write(self, df: DataFrame) -> str:
        """Writes rows by bucket to a new folder; a bucket of many rows is written by several tasks."""
        folder = new_path(self.spark)
        df.withColumn("bucket", _bucket(self.buckets)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
        return folder

    def step(self, increment: Increment, number: int | None = None) -> OrphanStore:
        """Applies an increment. One whose ``number`` isn't above that of the last is known and changes nothing."""
        if number is not None and self.last_step is not None and number <= self.last_step:
            return self
        changed = _changes(increment, self.buckets)
        fresh = None if increment.references is None else increment.references.where(F.col("ref_key") != "")
        keys = [df.select("bucket") for df in (changed, None if fresh is None else fresh.withColumn("bucket", _bucket(self.buckets))) if df is not None]
        touched = sorted(r["bucket"] for r in reduce(DataFrame.union, keys).distinct().collect()) if keys else []  # at most the buckets
        moved = sorted(r["bucket"] for r in changed.select("bucket").distinct().collect()) if changed is not None else []
        replaced = []
        if moved:
            old = self._read("parents", PARENTS, moved)
            if increment.withdrawn is not None:
                old = old.join(changed.where(F.col("gone_at").isNotNull()).select(*_KEY, "gone_at"), _KEY, "left")
                old = old.select(
                    *_KEY,
                    F.when(F.col("gone_at").isNull() | (F.col("first_seen") > F.col("gone_at")), F.col("first_seen")).alias("first_seen"),
                    "removed",
                )
            every = old.unionByName(changed.select(*_KEY, "first_seen", "removed"))
            folder = self._write(every.groupBy(*_KEY).agg(F.min("first_seen").alias("first_seen"), F.max("removed").alias("removed")))
            replaced += self._replace("parents", folder, moved)
        if touched:
            known = self._read("references", REFERENCES, touched).drop("kind")
            probing = known if fresh is None else known.unionByName(fresh)
            folder = self._write(_judge(probing, self._read("parents", PARENTS, touched)))
            replaced += self._replace("references", folder, touched)
        for path in replaced:
            release(self.spark, path)
        self.last_step = number if number is not None else self.last_step
        return self

    def _replace(self, table: str, folder: str, buckets: list[int]) -> list[str]:
        own, there = self.folders[table], {p.rpartition("=")[2] for p in children(self.spark, folder) if "bucket=" in p}
        old = [own.pop(b) for b in buckets if b in own]
        own.update({b: f"{folder}/bucket={b}" for b in buckets if str(b) in there})
        return old

    def snapshot(self) -> DataFrame:
        """Orphans per table, field, month of the referring row (UTC+8; null without a time) and kind."""
        orphans = self.references.where(F.col("kind") != "ok")
        return orphans.groupBy("table_name", "field_name", month_of(F.col("ref_at")).alias("ref_month"), "kind").agg(F.count(F.lit(1)).alias("n_refs"))


_FIELDS = (("filename", "file", file_key), ("source_url", "address", address_key))


def _targets(df: DataFrame, at: str, name: str) -> DataFrame:
    """Both keys of every row of a table with filename and source_url."""
    pairs = F.array(*(F.struct(F.lit(kind).alias("key_kind"), key(F.col(field)).alias("ref_key")) for field, kind, key in _FIELDS))
    return df.select(instant(F.col(at)).alias(name), F.explode(pairs).alias("p")).select("p.key_kind", "p.ref_key", name)


def post_increment(posts: DataFrame, removed_posts: DataFrame, post_index: DataFrame, analysis_results: DataFrame) -> Increment:
    """The four tables as one increment; slices of them make smaller ones. Columns beyond those used are ignored."""
    listed = F.array(
        *(
            F.struct(
                F.lit(field).alias("field_name"),
                F.lit(kind).alias("key_kind"),
                key(F.col(field)).alias("ref_key"),
            ) for field, kind, key in _FIELDS
        )
    )
    index = post_index.select(
        F.lit("post_index").alias("table_name"),
        F.col("index_row").alias("row_id"),
        instant(F.col("indexed_at")).alias("ref_at"),
        F.explode(listed).alias("p"),
    )
    index = index.select("table_name", "row_id", "p.*", "ref_at")
    results = analysis_results.select(
        F.lit("analysis_results").alias("table_name"),
        F.col("result_id").alias("row_id"),
        F.lit("_source_file").alias("field_name"),
        F.lit("file").alias("key_kind"),
        file_key(F.col("_source_file")).alias("ref_key"),
        instant(F.col("analyzed_at")).alias("ref_at"),
    )
    return Increment(_targets(posts, "fetched_at", "seen_at"), _targets(removed_posts, "removed_at", "removed_at"), None, index.unionByName(results))


def in_periods(whole: Increment, periods: int) -> list[Increment]:
    """An increment cut by its times (``seen_at``, ``removed_at``, ``ref_at``) into as many of equal span, in order.

    Rows without a time come first. Keys are made once and written; each increment reads its own of them. The span is
    that of the rows with a key.
    """
    empty = F.lit(None)
    kinds = (
        (whole.stored, "stored", F.col("seen_at"), {}),
        (whole.removed, "removed", F.col("removed_at"), {}),
        (whole.references, "reference", F.col("ref_at"), {c: F.col(c) for c in ("table_name", "row_id", "field_name")}),
    )
    rows = reduce(
        DataFrame.unionByName,
        (
            df.select(
                F.lit(what).alias("what"),
                *_KEY,
                at.cast("timestamp").alias("at"),
                *(more.get(c, empty).cast(t).alias(c) for c, t in (("table_name", "string"), ("row_id", "bigint"), ("field_name", "string"))),
            )
            for df, what, at, more in kinds
        ),
    )
    staged = durable(rows.where(F.col("ref_key") != "").withColumn("second", F.unix_timestamp("at")))
    low, high = staged.agg(F.min("second"), F.max("second")).first()
    ends = [(low or 0) + ((high or 0) - (low or 0)) * k // periods for k in range(1, periods)]
    out = []
    for k in range(periods):
        after = F.col("second") > ends[k - 1] if k else F.lit(True)
        upto = F.col("second") <= ends[k] if k < periods - 1 else F.lit(True)
        own = staged.where((after & upto) if k else (F.col("second").isNull() | upto))
        part = lambda what: own.where(F.col("what") == what)  # noqa: B023, E731
        out.append(
            Increment(
                part("stored").select(*_KEY, F.col("at").alias("seen_at")),
                part("removed").select(*_KEY),
                None,
                part("reference").select("table_name", "row_id", "field_name", *_KEY, F.col("at").alias("ref_at")),
            )
        )
    return out
