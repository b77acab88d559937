"""Queries p4 and p5 on the landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.operators import orphans, salted
from inkfold.session import durable
from inkfold.sources.tables import table


#: Increments in which the tables are taken in, and buckets of the state; a quarter of the rows touches all buckets.
PERIODS, BUCKETS = 4, 16


def _increments(spark: SparkSession, folder: str) -> list[orphans.Increment]:
    whole = orphans.post_increment(*(table(spark, folder, n) for n in ("posts", "removed_posts", "post_index", "analysis_results")))
    return orphans.in_periods(whole, PERIODS)


def _orphan_state(spark: SparkSession, folder: str) -> orphans.OrphanStore:
    """The state after all increments: references wait for parents of later periods, removals change those that wait."""
    store = orphans.OrphanStore(spark, BUCKETS)
    for step in _increments(spark, folder):
        store.step(step)
    return store


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _orphan_state(spark, folder).references.where(F.col("kind") != "ok").select("table_name", "row_id", "field_name", "kind")


def p4_orphans_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return _orphan_state(spark, folder).snapshot()


def p4_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """``period, table_name, field_name, kind, n_refs``: the orphans there are after each increment."""
    store, told = orphans.OrphanStore(spark, BUCKETS), None
    for k, step in enumerate(_increments(spark, folder)):
        counts = durable(
            store.step(step).snapshot().groupBy(
                "table_name",
                "field_name",
                "kind",
            ).agg(F.sum("n_refs").alias("n_refs")).withColumn("period", F.lit(k))
        )
        told = counts if told is None else told.unionByName(counts)
    return told


def p5_key_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return salted.post_key_profiles(table(spark, folder, "posts"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    posts = table(spark, folder, "posts")
    least = posts.count() * 0.05
    return salted.post_key_profiles(posts).where(F.col("n_rows") >= least).select("field_name", "key_value")


QUERIES = {
    "p4_found": p4_found,
    "p4_orphans_by_month": p4_orphans_by_month,
    "p4_snapshots": p4_snapshots,
    "p5_key_profiles": p5_key_profiles,
    "p5_found": p5_found,
}

# White space as Python sees it, in RE2.
_WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def sql_term(x: str) -> str:
    """A term's normal form where the only characters that NFKC changes are the full-width forms and U+3000."""
    narrow = f"array_to_string(list_transform(string_split({x}, ''), lambda c: CASE WHEN c BETWEEN '！' AND '～' THEN chr(ord(c) - 65248) WHEN c = chr(12288) THEN ' ' ELSE c END), '')"
    marks = "#\"''“”‘’「」"
    ends = _WS[:-1] + marks + "]"
    return f"lower(regexp_replace({narrow}, '^{ends}+|{ends}+$', '', 'g'))"


def sql_instant(x: str) -> str:
    t = f"trim({x})"
    return f"CASE WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}[T ]') THEN TRY_CAST(CASE WHEN regexp_matches({t}, '(Z|[+-]\\d{{2}}:\\d{{2}})$') THEN {t} ELSE {t} || '+08:00' END AS TIMESTAMPTZ) END"


def sql_file(x: str) -> str:
    return _strip(f"regexp_extract(lower({_strip(x)}), '([^/\\\\]*)[/\\\\]*$', 1)")


def sql_address(x: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(lower({_strip(x)}), '^([a-z][a-z0-9+.-]*:)?//', ''), '(?s)[?#].*$', ''), '/+$', '')"


_ORPHANS = f"""
WITH stored AS (
  SELECT 'file' AS k, {sql_file("filename")} AS key, {sql_instant("fetched_at")} AS moment FROM posts
  UNION ALL SELECT 'address', {sql_address("source_url")}, {sql_instant("fetched_at")} FROM posts),
seen AS (SELECT k, key, min(moment) AS moment FROM stored WHERE key <> '' GROUP BY 1, 2),
gone AS (
  SELECT DISTINCT 'file' AS k, {sql_file("filename")} AS key FROM removed_posts
  UNION SELECT 'address', {sql_address("source_url")} FROM removed_posts),
refs AS (
  SELECT 'post_index' AS table_name, index_row AS row_id, 'filename' AS field_name, 'file' AS k, {sql_file("filename")} AS key, {sql_instant("indexed_at")} AS moment
  FROM post_index
  UNION ALL SELECT 'post_index', index_row, 'source_url', 'address', {sql_address("source_url")}, {sql_instant("indexed_at")} FROM post_index
  UNION ALL SELECT 'analysis_results', result_id, '_source_file', 'file', {sql_file("_source_file")}, {sql_instant("analyzed_at")} FROM analysis_results),
judged AS (
  SELECT r.*, CASE WHEN s.key IS NOT NULL THEN CASE WHEN s.moment > r.moment THEN 'late' ELSE 'ok' END WHEN g.key IS NOT NULL THEN 'deleted' ELSE 'missing' END AS kind
  FROM refs r LEFT JOIN seen s ON r.k = s.k AND r.key = s.key LEFT JOIN gone g ON r.k = g.k AND r.key = g.key WHERE r.key <> '')
"""
_SNAPSHOTS = f"""
WITH stored AS (
  SELECT 'file' AS k, {sql_file("filename")} AS key, {sql_instant("fetched_at")} AS moment FROM posts
  UNION ALL SELECT 'address', {sql_address("source_url")}, {sql_instant("fetched_at")} FROM posts),
gone AS (
  SELECT 'file' AS k, {sql_file("filename")} AS key, {sql_instant("removed_at")} AS moment FROM removed_posts
  UNION ALL SELECT 'address', {sql_address("source_url")}, {sql_instant("removed_at")} FROM removed_posts),
refs AS (
  SELECT 'post_index' AS table_name, 'filename' AS field_name, 'file' AS k, {sql_file("filename")} AS key, {sql_instant("indexed_at")} AS moment FROM post_index
  UNION ALL SELECT 'post_index', 'source_url', 'address', {sql_address("source_url")}, {sql_instant("indexed_at")} FROM post_index
  UNION ALL SELECT 'analysis_results', '_source_file', 'file', {sql_file("_source_file")}, {sql_instant("analyzed_at")} FROM analysis_results),
every AS (SELECT CAST(floor(epoch(moment)) AS BIGINT) AS s FROM (SELECT key, moment FROM stored
  UNION ALL SELECT key, moment FROM gone UNION ALL SELECT key, moment FROM refs) WHERE key <> ''),
ends AS (SELECT period, CASE WHEN period = 3 THEN hi ELSE lo + (hi - lo) * (period + 1) // 4 END AS upto
  FROM (SELECT min(s) AS lo, max(s) AS hi FROM every), (VALUES (0), (1), (2), (3)) v(period)),
seen AS (SELECT period, k, key, min(coalesce(moment, TIMESTAMPTZ '0001-01-01')) AS moment FROM stored, ends
  WHERE key <> '' AND coalesce(floor(epoch(moment)) <= upto, true) GROUP BY 1, 2, 3),
taken AS (SELECT DISTINCT period, k, key FROM gone, ends WHERE coalesce(floor(epoch(moment)) <= upto, true)),
judged AS (
  SELECT e.period, table_name, field_name, CASE WHEN s.key IS NOT NULL THEN CASE WHEN s.moment > r.moment THEN 'late' ELSE 'ok' END WHEN g.key IS NOT NULL THEN 'deleted' ELSE 'missing' END AS kind
  FROM refs r JOIN ends e ON coalesce(floor(epoch(r.moment)) <= e.upto, true) LEFT JOIN seen s ON s.period = e.period AND r.k = s.k AND r.key = s.key
  LEFT JOIN taken g ON g.period = e.period AND r.k = g.k AND r.key = g.key WHERE r.key <> '')
SELECT CAST(period AS INTEGER) AS period, table_name, field_name, kind, count(*) AS n_refs FROM judged WHERE kind <> 'ok' GROUP BY ALL"""
_KEYED = f"""
WITH base AS (SELECT post_row, author_uid, tags, {sql_instant("published_at")} AS moment, coalesce(length(body), 0) AS chars FROM posts),
terms AS (SELECT DISTINCT post_row, {sql_term("t")} AS term FROM (SELECT post_row, unnest(tags) AS t FROM base)),
keyed AS (
  SELECT 'author_uid' AS field_name, author_uid AS key_value, moment, chars FROM base WHERE author_uid IS NOT NULL
  UNION ALL SELECT 'tags', term, moment, chars FROM terms JOIN base USING (post_row) WHERE term <> '')
"""
ORACLE = {
    "p4_found": _ORPHANS + "SELECT table_name, row_id, field_name, kind FROM judged WHERE kind <> 'ok'",
    "p4_orphans_by_month": _ORPHANS + "SELECT table_name, field_name, strftime((moment AT TIME ZONE 'UTC') + INTERVAL 8 HOUR, '%Y-%m') AS ref_month, kind, count(*) AS n_refs FROM judged WHERE kind <> 'ok' GROUP BY ALL",
    "p4_snapshots": _SNAPSHOTS,
    "p5_key_profiles": _KEYED + "SELECT field_name, key_value, count(*) AS n_rows, min(moment) AS first_published, max(moment) AS last_published, CAST(sum(chars) AS BIGINT) AS body_chars FROM keyed GROUP BY ALL",
    "p5_found": _KEYED + "SELECT field_name, key_value FROM keyed GROUP BY ALL HAVING count(*) >= 0.05 * (SELECT count(*) FROM posts)",
}
