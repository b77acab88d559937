"""Queries p1, p2, p3, p6, p7, p8 and p9 on the landed tables, with SQL where SQL can say it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.functions.terms import normal_terms
from inkfold.llm import answers, cooccurrence, language, ngrams, packing, residue, tokens
from inkfold.plans.training import sql_term
from inkfold.sources.tables import table


def p1_defects(spark: SparkSession, folder: str) -> DataFrame:
    """Defective answers with their defect and what shows it."""
    profiles = language.learn_profiles(table(spark, folder, "documents"))
    return answers.answer_defects(table(spark, folder, "analysis_results"), table(spark, folder, "analysis_prompts"), profiles)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_defects(spark, folder).drop("evidence")


def _fields(spark: SparkSession, folder: str) -> dict[str, tuple[DataFrame, str]]:
    return {"tags": (table(spark, folder, "posts"), "tags"), "concepts": (table(spark, folder, "analysis_results"), "concepts")}


def p2_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.term_usefulness(_fields(spark, folder)).select("field_name", "terms", "n_terms", "n_occurrences", "n_records")


def p2_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Of the n-grams those of one term, whose counts are the sums that the stack makes of all suffixes beginning with it."""
    single = ngrams.term_usefulness(_fields(spark, folder)).where(F.col("n_terms") == 1)
    return single.select("field_name", F.col("terms")[0].alias("term"), "n_occurrences", "n_records", "mark")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_terms(spark, folder).where(F.col("mark").isNotNull()).select("field_name", "term", "mark")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    posts = table(spark, folder, "posts")
    scores = residue.residue_scores(posts, residue.learn_model(posts))
    return scores.where(residue.is_residue()).select("post_row", "field_name")


def p3_clean_posts(spark: SparkSession, folder: str) -> DataFrame:
    """The posts, their titles and bodies that are residue left out."""
    posts = table(spark, folder, "posts")
    return residue.without_residue(posts, residue.learn_model(posts))


def _tag_pairs(spark: SparkSession, folder: str, floor: int, share: float) -> tuple[DataFrame, int]:
    posts = table(spark, folder, "posts")
    n_rows = posts.count()
    baskets = posts.select(F.array_distinct(normal_terms(F.col("tags"))).alias("terms"))
    pairs = cooccurrence.pair_counts(baskets, "terms", max(floor, math.ceil(n_rows * share)))
    return pairs.withColumnsRenamed({"item_a": "tag_a", "item_b": "tag_b"}), n_rows


def p6_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Every two terms that share a row."""
    return cooccurrence.association(*_tag_pairs(spark, folder, 1, 0))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs, n_rows = _tag_pairs(spark, folder, 3, 0.002)
    return cooccurrence.at_least_lift(pairs, n_rows, 4).select("tag_a", "tag_b")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_ids(table(spark, folder, "documents"), "doc_id", "text")


def p8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), table(spark, folder, "pack_capacities"))


def p8_violations(spark: SparkSession, folder: str) -> DataFrame:
    """What no packing may have, counted: nothing."""
    documents = table(spark, folder, "documents")
    return packing.violations(p8_packing(spark, folder), tokens.token_counts(documents, "doc_id", "text"), table(spark, folder, "pack_capacities"))


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.container_fill(p8_packing(spark, folder), table(spark, folder, "pack_capacities"))


def _identified(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return language.identify(documents, language.learn_profiles(documents))


def p9_segments(spark: SparkSession, folder: str) -> DataFrame:
    segments = _identified(spark, folder).select("doc_id", F.posexplode("segments").alias("segment_no", "s"))
    return segments.select("doc_id", "segment_no", "s.*")


def p9_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its main language and a confidence; null for texts without words."""
    return language.main_languages(_identified(spark, folder))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return language.mislabelled(_identified(spark, folder)).distinct()


QUERIES = {
    f.__name__: f
    for f in (
        *(p1_found, p1_defects, p2_terms, p2_phrases, p2_found, p3_found, p3_clean_posts, p6_pairs, p6_found),
        *(p7_ids, p8_packing, p8_fill, p8_violations, p9_documents, p9_segments, p9_found),
    )
}

_TERMS = f"""
WITH raw AS (
  SELECT 'tags' AS field_name, post_row AS row_id, unnest(tags) AS t FROM posts
  UNION ALL SELECT 'concepts', result_id, unnest(concepts) FROM analysis_results),
terms AS (SELECT * FROM (SELECT field_name, row_id, {sql_term("t")} AS term FROM raw) WHERE term <> ''),
counted AS (
  SELECT field_name, term, count(*) AS n_occurrences, count(DISTINCT row_id) AS n_records,
    CASE WHEN count(DISTINCT row_id) < 3 THEN 'rare'
         WHEN count(DISTINCT row_id) > 0.2 * CASE field_name WHEN 'tags' THEN (SELECT count(*) FROM posts) ELSE (SELECT count(*) FROM analysis_results) END THEN 'common' END AS mark
  FROM terms GROUP BY 1, 2)
"""
_PAIRS = f"""
WITH held AS (SELECT DISTINCT post_row, term FROM (SELECT post_row, {sql_term("t")} AS term FROM (SELECT post_row, unnest(tags) AS t FROM posts)) WHERE term <> ''),
support AS (SELECT term, count(*) AS n FROM held GROUP BY 1),
total AS (SELECT count(*) AS n FROM posts),
pairs AS (
  SELECT a.term AS tag_a, b.term AS tag_b, count(*) AS rows_both FROM held a JOIN held b ON a.post_row = b.post_row AND a.term < b.term
  GROUP BY 1, 2),
named AS (
  SELECT p.tag_a, p.tag_b, x.n AS rows_a, y.n AS rows_b, p.rows_both, t.n AS n
  FROM pairs p JOIN support x ON p.tag_a = x.term JOIN support y ON p.tag_b = y.term, total t)
"""
_ASSOCIATION = """SELECT tag_a, tag_b, rows_a, rows_b, rows_both, rows_both::DOUBLE * n / (rows_a::DOUBLE * rows_b) AS lift,
  ln(((rows_both + 0.5::DOUBLE) * (n - rows_a - rows_b + rows_both + 0.5::DOUBLE)) / ((rows_a - rows_both + 0.5::DOUBLE) * (rows_b - rows_both + 0.5::DOUBLE))) AS log_odds FROM named"""
ORACLE = {
    "p2_terms": _TERMS + "SELECT * FROM counted",
    "p2_found": _TERMS + "SELECT field_name, term, mark FROM counted WHERE mark IS NOT NULL",
    "p2_phrases": f"""
WITH seqs AS (
  SELECT 'tags' AS field_name, post_row AS row_id, list_filter(list_transform(tags, lambda t: {sql_term("t")}), lambda t: t <> '') AS seq FROM posts
  UNION ALL SELECT 'concepts', result_id, list_filter(list_transform(concepts, lambda t: {sql_term("t")}), lambda t: t <> '') FROM analysis_results),
starts AS (SELECT field_name, row_id, seq, unnest(range(1, len(seq) + 1)) AS i FROM seqs),
grams AS (SELECT field_name, row_id, list_slice(seq, i, i + l - 1) AS g, l FROM starts, (VALUES (1), (2), (3)) v(l) WHERE i + l - 1 <= len(seq))
SELECT field_name, g AS terms, l AS n_terms, count(*) AS n_occurrences, count(DISTINCT row_id) AS n_records FROM grams GROUP BY field_name, g, l""",
    "p8_violations": "SELECT capacity_id, 0::BIGINT AS n_over, 0::BIGINT AS n_uneven, 0::BIGINT AS n_divided FROM pack_capacities",
    "p6_pairs": _PAIRS + _ASSOCIATION,
    "p6_found": _PAIRS + "SELECT tag_a, tag_b FROM named WHERE rows_both >= 3 AND rows_both >= 0.002 * n AND rows_both * n >= 4 * rows_a * rows_b",
}
