"""Queries over stored posts, their indexes and their analyses, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.functions import frontmatter, html, text
from inkfold.operators import batching, graph, quality, reconcile, stats
from inkfold.plans.registry import Registry
from inkfold.plans.training import _WS, _strip
from inkfold.session import new_path, widened
from inkfold.sinks.documents import collector_documents, index_lines, post_documents
from inkfold.sources.tables import table

query = Registry()
QUERIES, ORACLE = query.queries, query.oracle


# Dates, tags, lengths


@query("SELECT substr(published_date, 1, 4) AS year, count(*) AS n FROM post_index WHERE published_date <> '' GROUP BY 1")
def year_distribution(spark: SparkSession, d: str) -> DataFrame:
    return stats.by_prefix(table(spark, d, "post_index"), "published_date", 4, "year")


@query("SELECT substr(published_date, 1, 7) AS month, count(*) AS n FROM post_index WHERE published_date <> '' GROUP BY 1")
def month_distribution(spark: SparkSession, d: str) -> DataFrame:
    return stats.by_prefix(table(spark, d, "post_index"), "published_date", 7, "month")


@query("SELECT substr(published_date, 1, 7) AS month, count(*) AS n FROM post_index WHERE published_date <> '' GROUP BY 1 ORDER BY 1 DESC LIMIT 24")
def latest_periods(spark: SparkSession, d: str) -> DataFrame:
    return stats.latest(month_distribution(spark, d), "month", 24)


def _report(spark: SparkSession, d: str) -> DataFrame:
    return stats.date_report(table(spark, d, "posts").withColumn("chars", F.coalesce(F.length("body"), F.lit(0))), "published_at", "chars")


@query("SELECT count(*) AS total, min(published_at) AS earliest, max(published_at) AS latest FROM posts WHERE published_at <> ''")
def date_range(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d).select("total", "earliest", "latest")


@query(
    "SELECT substr(published_at, 1, 7) AS month, count(*) AS n, CAST(sum(coalesce(length(body), 0)) // count(*) AS BIGINT) AS avg_length FROM posts WHERE published_at <> '' GROUP BY 1"
)
def date_months(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d).select(F.explode("months").alias("m")).select("m.*")


@query("SELECT substr(published_at, 1, 4) AS year, count(*) AS n FROM posts WHERE published_at <> '' GROUP BY 1")
def date_years(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d).select(F.explode("years").alias("year", "n"))


@query("""SELECT year || ': ' || lpad(n::VARCHAR, 5, ' ') || CASE WHEN n >= 20 THEN ' ' || repeat('█', CAST(n // 20 AS INTEGER)) ELSE '' END AS line, year
FROM (SELECT substr(published_date, 1, 4) AS year, count(*) AS n FROM post_index WHERE published_date <> '' GROUP BY 1)""")
def year_chart(spark: SparkSession, d: str) -> DataFrame:
    return stats.chart(year_distribution(spark, d), "year", 20, 5)


_TAGS = "SELECT post_row, unnest(tags) AS item, generate_subscripts(tags, 1) AS pos FROM posts"


@query(
    f"SELECT item, n FROM (SELECT item, count(*) AS n, min((post_row, pos)) AS f FROM ({_TAGS}) WHERE item IS NOT NULL GROUP BY 1) ORDER BY n DESC, f LIMIT 20"
)
def tag_top20(spark: SparkSession, d: str) -> DataFrame:
    return stats.list_counts(table(spark, d, "posts"), "tags", ["post_row"], top=20).select("item", "n")


@query(
    "SELECT count(DISTINCT item) AS n_tags, count(*) AS n_uses, (SELECT CAST(sum(images_count) AS BIGINT) FROM posts) AS n_images FROM (SELECT unnest(tags) AS item FROM posts) WHERE item IS NOT NULL"
)
def tag_stats(spark: SparkSession, d: str) -> DataFrame:
    posts = table(spark, d, "posts")
    tags = posts.select(F.explode("tags").alias("item")).where(F.col("item").isNotNull()).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return tags.agg(F.count(F.lit(1)).alias("n_tags"), F.sum("n").alias("n_uses")).join(posts.agg(F.sum("images_count").alias("n_images")))  # one row each


@query(
    "SELECT concept, n FROM (SELECT concept, count(*) AS n, min((result_id, pos)) AS f FROM (SELECT result_id, unnest(concepts) AS concept, generate_subscripts(concepts, 1) AS pos FROM analysis_results) WHERE concept IS NOT NULL GROUP BY 1) ORDER BY n DESC, f LIMIT 10"
)
def concept_top10(spark: SparkSession, d: str) -> DataFrame:
    return stats.list_counts(table(spark, d, "analysis_results"), "concepts", ["result_id"], top=10, name="concept").select("concept", "n")


@query(
    "SELECT CAST(sum(l) // count(l) AS BIGINT) AS avg_length, CAST(min(l) AS BIGINT) AS min_length, CAST(max(l) AS BIGINT) AS max_length FROM (SELECT length(body) AS l FROM posts WHERE length(body) > 0)"
)
def length_stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.length_stats(table(spark, d, "posts").select(F.length("body").alias("l")), "l")


# Keywords

_FOLDED = r"""
WITH words AS (
  SELECT doc_id, list_concat(list_filter(regexp_extract_all(text, '[\x{4e00}-\x{9fff}]+'), lambda w: length(w) >= 2), regexp_extract_all(lower(text), '[a-z]{3,}')) AS ws
  FROM documents),
seen AS (SELECT doc_id, unnest(ws) AS keyword, generate_subscripts(ws, 1) AS pos FROM words),
counted AS (SELECT doc_id, keyword, count(*) AS n, min(pos) AS f FROM seen GROUP BY 1, 2)
"""
_CASED = r"""
WITH words AS (SELECT doc_id, list_filter(regexp_extract_all(text, '[\x{4e00}-\x{9fff}]+|[a-zA-Z]+'), lambda w: length(w) >= 2) AS ws FROM documents),
seen AS (SELECT doc_id, unnest(ws) AS keyword, generate_subscripts(ws, 1) AS pos FROM words),
counted AS (SELECT doc_id, keyword, count(*) AS n, min(pos) AS f FROM seen GROUP BY 1, 2)
"""
_BEST = "SELECT doc_id, keyword, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rank FROM counted) WHERE rank <= 10"


@query(_FOLDED + _BEST)
def keyword_topn_folded(spark: SparkSession, d: str) -> DataFrame:
    return stats.keywords(widened(table(spark, d, "documents").select("doc_id", "text")), ["doc_id"], text.tokens_folded(F.col("text")))


@query(_CASED + _BEST)
def keyword_topn_cased(spark: SparkSession, d: str) -> DataFrame:
    return stats.keywords(widened(table(spark, d, "documents").select("doc_id", "text")), ["doc_id"], text.tokens_cased(F.col("text")))


@query(_FOLDED + "SELECT keyword, CAST(sum(n) AS BIGINT) AS n FROM counted GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def keyword_global_top20(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select(F.explode(text.tokens_folded(F.col("text"))).alias("keyword"))
    return words.groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "keyword").limit(20)


# Quality and integrity

_HOLDER = rf"regexp_matches({_strip('coalesce(body, chr(10))')}, '^(#+{_WS}*$|无内容$|待补充$|内容加载中|请稍后)')"
_LADDER_A = f"CASE WHEN coalesce(length(title), 0) < 3 THEN 'missing_title' WHEN coalesce(published_at, '') = '' THEN 'missing_date' WHEN coalesce(length(body), 0) < 100 THEN 'short_content' WHEN {_HOLDER} THEN 'placeholder' ELSE 'valid' END"
_LADDER_B = "CASE WHEN coalesce(length(body), 0) < 100 THEN 'short_content' WHEN coalesce(length(title), 0) < 3 THEN 'missing_title' WHEN coalesce(published_at, '') = '' THEN 'missing_date' ELSE 'valid' END"


def _graded(spark: SparkSession, d: str, rule) -> DataFrame:
    return table(spark, d, "posts").select("post_row", rule(F.col("title"), F.col("published_at"), F.col("body")).alias("label"))


@query(f"SELECT post_row, {_LADDER_A} AS label FROM posts")
def quality_title_first(spark: SparkSession, d: str) -> DataFrame:
    return _graded(spark, d, quality.check_first_title)


@query(f"SELECT post_row, {_LADDER_B} AS label FROM posts")
def quality_body_first(spark: SparkSession, d: str) -> DataFrame:
    return _graded(spark, d, quality.check_first_body)


_LABELS = ("valid", "short_content", "missing_title", "missing_date", "placeholder")


@query(
    f"SELECT count(*) AS total_files, {', '.join(f"count(*) FILTER (label = '{x}') AS {x}_count" for x in _LABELS)}, count(*) FILTER (label = 'valid') * 100.0::DOUBLE / count(*) AS quality_percent, CASE WHEN count(*) FILTER (label = 'valid') = count(*) THEN 'ok' ELSE 'degraded' END AS status FROM (SELECT {_LADDER_A} AS label FROM posts)"
)
def quality_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.counts_of(quality_title_first(spark, d), "label", _LABELS)


@query(f"SELECT post_row, {_HOLDER} AS placeholder FROM posts WHERE body IS NOT NULL")
def placeholder_flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "posts").where(F.col("body").isNotNull()).select("post_row", quality.is_placeholder(F.col("body")).alias("placeholder"))


_CONTENT = "'id: ' || id || coalesce(chr(10) || 'author_uid: ' || author_uid, '') || coalesce(chr(10) || 'author_name: ' || author_name, '') || coalesce(chr(10) || 'published_at: ' || published_at, '') || chr(10) || 'source_url: ' || source_url || coalesce(chr(10) || 'tags: ' || array_to_string(tags, ','), '')"


@query(
    f"""WITH files AS (SELECT post_row, {_CONTENT} AS c FROM posts),
missed AS (SELECT *, list_filter(['id:', 'author_uid:', 'author_name:', 'published_at:', 'source_url:'], lambda k: NOT contains(c, k)) AS m, {_strip("regexp_extract(c, 'tags:[ \\t]*(.+)', 1)")} AS t
  FROM files)
SELECT post_row, CASE WHEN len(m) > 0 THEN 'missing ' || array_to_string(m, ' ') WHEN t <> '' AND NOT starts_with(t, '[') THEN 'tags' END AS issue FROM missed"""
)
def integrity_issues(spark: SparkSession, d: str) -> DataFrame:
    keys = ("author_uid", "author_name", "published_at")
    lines = [
        F.concat(F.lit("id: "), "id"),
        *(F.concat(F.lit(f"{k}: "), k) for k in keys),
        F.concat(F.lit("source_url: "), "source_url"),
        F.when(F.col("tags").isNotNull(), F.concat(F.lit("tags: "), F.array_join("tags", ","))),
    ]
    return table(spark, d, "posts").select("post_row", quality.integrity_issue(F.concat_ws("\n", *lines)).alias("issue"))


# Listed against stored


def _urls(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    listed = table(spark, d, "post_index").select("index_row", "id", "source_url")
    return listed, table(spark, d, "posts").select("post_row", "id", "source_url")


@query("SELECT index_row, id FROM post_index i WHERE NOT EXISTS (SELECT 1 FROM posts p WHERE p.source_url = i.source_url)")
def missing_posts(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.missing(*_urls(spark, d), "source_url").select("index_row", "id")


@query("SELECT post_row, id FROM posts p WHERE NOT EXISTS (SELECT 1 FROM post_index i WHERE p.source_url = i.source_url)")
def extra_posts(spark: SparkSession, d: str) -> DataFrame:
    listed, stored = _urls(spark, d)
    return reconcile.missing(stored, listed, "source_url").select("post_row", "id")


@query("SELECT index_row, id FROM post_index i WHERE EXISTS (SELECT 1 FROM posts p WHERE p.source_url = i.source_url)")
def matched_posts(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.matched(*_urls(spark, d), "source_url").select("index_row", "id")


@query("""WITH l AS (SELECT DISTINCT source_url u FROM post_index WHERE source_url IS NOT NULL), s AS (SELECT DISTINCT source_url u
  FROM posts WHERE source_url IS NOT NULL),
n AS (SELECT (SELECT count(*) FROM l) AS n_listed, (SELECT count(*) FROM s) AS n_stored, (SELECT count(*) FROM l JOIN s USING (u)) AS n_matched)
SELECT *, n_listed - n_matched AS n_missing, n_stored - n_matched AS n_extra, n_matched * 100.0::DOUBLE / n_listed AS completeness_percent,
  CASE WHEN n_listed = n_matched THEN 'ok' ELSE 'incomplete' END AS status,
(SELECT list_slice(list_sort(list(u)), 1, 50) FROM l ANTI JOIN s USING (u)) AS missing, (SELECT list_slice(list_sort(list(u)), 1, 50)
  FROM s ANTI JOIN l USING (u)) AS extra FROM n""")
def reconcile_report(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.reconcile(*_urls(spark, d), "source_url")


def sql_round1(x: str) -> str:
    """``x`` to one decimal by its exact binary value, ties to even, in whole numbers of 128 bits."""
    scaled, h = f"({x} * 4503599627370496.0::DOUBLE)", "4503599627370496::HUGEINT"
    m = f"CAST(floor({scaled}) AS HUGEINT)"
    t, gap = f"({m} * 10 // {h})", f"CAST({h} - {m} * 10 % {h} * 2 AS DOUBLE)"
    rest = f"(({scaled} - floor({scaled})) * 20)"
    return f"(CAST({t} + CASE WHEN {rest} > {gap} THEN 1 WHEN {rest} < {gap} THEN 0 ELSE {t} % 2 END AS BIGINT) / 10.0::DOUBLE)"


@query(f"""SELECT n_got, n_wanted, abs(n_got - n_wanted) AS difference, {sql_round1("c")} AS completeness_percent,
  CASE WHEN c >= 100 THEN 'complete' WHEN c >= 99 THEN 'nearly complete' WHEN c >= 90 THEN 'incomplete' ELSE 'badly incomplete' END AS band,
  CASE WHEN c >= 99 THEN 'ok' ELSE 'incomplete' END AS status
FROM (SELECT *, least(n_got, n_wanted) * 100.0::DOUBLE / greatest(n_got, n_wanted) AS c FROM (SELECT (SELECT count(*)
  FROM posts) AS n_got, (SELECT count(*) FROM post_index) AS n_wanted))""")
def count_check(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.count_check(table(spark, d, "posts").select("post_row"), table(spark, d, "post_index").select("index_row"))


@query("SELECT post_row, id, source_url FROM posts QUALIFY row_number() OVER (PARTITION BY id ORDER BY post_row) = 1")
def keep_first_posts(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.keep_first(_urls(spark, d)[1], ["id"], ["post_row"])


@query("""WITH first AS (SELECT index_row AS row_id, id, source_url FROM post_index WHERE source_url IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY index_row) = 1)
SELECT post_row AS row_id, id, source_url FROM posts UNION ALL SELECT * FROM first f WHERE NOT EXISTS (SELECT 1 FROM posts p WHERE p.source_url = f.source_url)""")
def incremental_merge(spark: SparkSession, d: str) -> DataFrame:
    listed, stored = _urls(spark, d)
    return reconcile.merge_new(stored.withColumnRenamed("post_row", "row_id"), listed.withColumnRenamed("index_row", "row_id"), "source_url", ["row_id"])


@query("SELECT p.post_row FROM posts p WHERE NOT EXISTS (SELECT 1 FROM analysis_results a WHERE a._source_file = p.filename)")
def posts_not_analysed(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "analysis_results").select(F.col("_source_file").alias("filename"))
    return reconcile.missing(table(spark, d, "posts").select("post_row", "filename"), done, "filename").select("post_row")


@query(
    "SELECT result_id, _source_file FROM analysis_results WHERE ends_with(_source_file, '.md') QUALIFY row_number() OVER (PARTITION BY _source_file ORDER BY result_id) = 1"
)
def keep_first_results(spark: SparkSession, d: str) -> DataFrame:
    results = table(spark, d, "analysis_results").select("result_id", "_source_file").where(F.col("_source_file").endswith(".md"))
    return reconcile.keep_first(results, ["_source_file"], ["result_id"])


@query(
    """SELECT i.index_row, coalesce(p.body, i.title) AS text FROM post_index i LEFT JOIN (SELECT id, body
  FROM posts QUALIFY row_number() OVER (PARTITION BY id ORDER BY post_row) = 1) p USING (id)"""
)
def index_with_text(spark: SparkSession, d: str) -> DataFrame:
    posts = reconcile.keep_first(table(spark, d, "posts").select("post_row", "id", "body"), ["id"], ["post_row"])
    return reconcile.with_text(table(spark, d, "post_index").select("index_row", "id", "title"), posts, "id", "body", "title").select("index_row", "text")


_PAGES = "WITH numbered AS (SELECT author_uid, 1 + (row_number() OVER (PARTITION BY author_uid ORDER BY index_row) - 1) // 50 AS page FROM post_index WHERE author_uid IS NOT NULL), pages AS (SELECT author_uid, page, count(*) AS n FROM numbered GROUP BY 1, 2)"


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.page_counts(table(spark, d, "post_index").where(F.col("author_uid").isNotNull()), ["author_uid"])


@query(
    _PAGES + " SELECT max(page) AS last_page, arg_max(n, page) AS last_count, (max(page) - 1) * 50 + arg_max(n, page) AS estimated_total FROM (SELECT page, CAST(sum(n) AS BIGINT) AS n FROM pages GROUP BY 1)"
)
def estimated_total(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.estimated_total(_pages(spark, d).groupBy("page").agg(F.sum("n").alias("n")))


@query(_PAGES + " SELECT author_uid, max(page) AS last_page FROM pages GROUP BY 1")
def stop_pages(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.stop_page(_pages(spark, d), ["author_uid"])


@query(
    """SELECT coalesce(id, '') AS id, coalesce(title, '') AS title, coalesce(published_at, '') AS published_at,
  substr(coalesce(published_at, ''), 1, 10) AS published_date, coalesce(tags, []) AS tags, CAST(coalesce(len(images), 0) AS BIGINT) AS images_count,
  coalesce(filename, '') AS filename, coalesce(source_url, '') AS source_url, post_row FROM posts"""
)
def index_rows(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.index_row(table(spark, d, "posts"), {"post_row": F.col("post_row")})


@query("SELECT uid, name, domain FROM bloggers WHERE uid IN (SELECT uid FROM bloggers WHERE profile.category IS NOT NULL)")
def bloggers_of_category(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bloggers").where(F.col("profile.category").isNotNull() & F.col("uid").isNotNull()).select("uid", "name", "domain")


# Text functions

_URL = "regexp_extract(coalesce(source_url, ''), 'blog_([0-9a-z]+)', 1)"


@query(
    f"""SELECT post_row, {_URL} AS url_id, md5(coalesce(nullif(source_url, ''), id)) || '.md' AS file_name,
trim(regexp_replace(coalesce(title, ''), '{_WS}+', ' ', 'g')) AS title, substr(regexp_replace(coalesce(title, ''), '[^\\pL\\pN_]', '_', 'g'), 1, 50) AS safe_title,
CASE WHEN starts_with(source_url, '//') THEN 'http:' || source_url WHEN starts_with(source_url, '/') THEN 'http://host.example' || source_url ELSE source_url END AS url
  FROM posts"""
)
def post_names(spark: SparkSession, d: str) -> DataFrame:
    title = F.coalesce("title", F.lit(""))
    url = F.col("source_url")
    return table(spark, d, "posts").select(
        "post_row",
        text.url_id(F.coalesce(url, F.lit(""))).alias("url_id"),
        text.md5_name(url, F.col("id")).alias("file_name"),
        text.collapse(title).alias("title"),
        text.safe_title(title).alias("safe_title"),
        text.absolute_url(url, "host.example").alias("url"),
    )


@query(
    f"""WITH s AS (SELECT index_row, regexp_replace(regexp_replace(coalesce(title, ''), '[^\\pL\\pN\\pM_\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}-]', '', 'g'), '(-|{_WS})+', '-', 'g') AS x
  FROM post_index),
t AS (SELECT index_row, lower(regexp_replace(x, '^-+|-+$', '', 'g')) AS slug FROM s)
SELECT index_row, CASE WHEN slug = '' THEN 'untitled' ELSE slug END AS slug FROM t"""
)
def title_slugs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "post_index").select("index_row", text.slug(F.coalesce("title", F.lit(""))).alias("slug"))


@query(
    """WITH named AS (SELECT index_row, coalesce(title, '') AS t FROM post_index)
SELECT index_row, CASE WHEN k = 0 THEN t ELSE t || '_' || k END || '.md' AS file_name FROM (SELECT *, row_number() OVER (PARTITION BY t
  ORDER BY index_row) - 1 AS k FROM named)"""
)
def numbered_names(spark: SparkSession, d: str) -> DataFrame:
    return batching.numbered_names(
        table(spark, d, "post_index").select("index_row", F.coalesce("title", F.lit("")).alias("t")),
        "t",
        ["index_row"],
    ).select("index_row", "file_name")


@query(
    r"SELECT post_row, regexp_replace(regexp_replace(body, '#+ ', '', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g') AS bare, "
    + _strip("replace(substr(body, 1, 200), chr(10), ' ')")
    + r" AS line, regexp_extract(body, '(?m)^#\s+(.+?)\s*$', 1) AS heading FROM posts WHERE body IS NOT NULL"
)
def body_texts(spark: SparkSession, d: str) -> DataFrame:
    body = F.col("body")
    return table(spark, d, "posts").where(body.isNotNull()).select(
        "post_row",
        text.without_marks(body).alias("bare"),
        text.summary_line(body).alias("line"),
        text.first_heading(body).alias("heading"),
    )


# Front matter

_PARTS = "SELECT doc_id, string_split(text, '---' || chr(10)) AS p FROM documents"


@query(
    f"""SELECT doc_id, array_to_string(list_slice(p, 3, len(p)), chr(10)) AS body, {_strip("regexp_extract(p[2], '(?m)^author_uid\\s*:(.*)$', 1)")} AS author_uid
  FROM ({_PARTS}) WHERE len(p) >= 3"""
)
def front_matter_fences(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "documents").select("doc_id", frontmatter.split_fences(F.col("text")).alias("p")).where(F.col("p").isNotNull())
    return part.select("doc_id", "p.body", F.coalesce(F.try_element_at("p.meta", F.lit("author_uid")), F.lit("")).alias("author_uid"))


@query(
    f"""SELECT doc_id, {_strip("CASE WHEN regexp_matches(text, '(?s)^---\\n.*?\\n---') THEN regexp_replace(text, '(?s)^---\\n.*?\\n---', '') ELSE text END")} AS body, regexp_matches(text, '(?s)^---\\n.*?\\n---') AS has_block
  FROM documents WHERE text IS NOT NULL"""
)
def front_matter_anchored(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.col("text").isNotNull())
    return docs.select("doc_id", frontmatter.anchored(F.col("text"))["body"].alias("body"), F.col("text").rlike(r"(?s)\A---\n.*?\n---").alias("has_block"))


_LIMITED = "SELECT doc_id, text, text LIKE '---%---%' AS has, regexp_extract(text, '(?s)^---(.*?)---', 1) AS block, regexp_replace(text, '(?s)^---.*?---', '') AS rest FROM documents WHERE text IS NOT NULL"
_BODY = f"CASE WHEN has THEN {_strip('rest')} ELSE {_strip('text')} END"


@query(
    f"SELECT doc_id, {_BODY} AS body, coalesce({_strip("regexp_extract(block, '(?m)^author_uid\\s*:(.*)$', 1)")}, '') AS author_uid, substr({_BODY}, 1, 2000) AS start FROM ({_LIMITED}) WHERE has"
)
def front_matter_limited(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.col("text").isNotNull())
    part = docs.select(
        "doc_id",
        frontmatter.limited(F.col("text")).alias("p"),
        (F.col("text").startswith("---") & (F.size(F.split("text", "---", 3)) >= 3)).alias("has"),
    ).where("has")
    return part.select(
        "doc_id",
        "p.body",
        F.coalesce(F.try_element_at("p.meta", F.lit("author_uid")), F.lit("")).alias("author_uid"),
        F.substring("p.body", 1, 2000).alias("start"),
    )


@query(
    f"""WITH t AS (SELECT doc_id, nullif(CASE WHEN has THEN {_strip("regexp_extract(block, '(?m)^title\\s*:(.*)$', 1)")} ELSE '' END, '') AS stated,
  nullif(regexp_extract(array_to_string(list_slice(string_split({_BODY}, chr(10)), 1, 10), chr(10)), '(?m)^\\s*#+\\s+(.+?)\\s*$', 1), '') AS heading FROM ({_LIMITED}))
SELECT doc_id, coalesce(stated, heading, CAST(doc_id AS VARCHAR)) AS title FROM t"""
)
def document_titles(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.col("text").isNotNull())
    return docs.select("doc_id", frontmatter.title_of(F.col("text"), F.concat(F.col("doc_id").cast("string"), F.lit(".md"))).alias("title"))


# Pages: each post as the page it came from

_HTML = """'<html><title> ' || coalesce(title, '') || ' </title><a href="' || coalesce(source_url, '') || '"><b>' || coalesce(title, '') || '</b></a><div class="article">' || replace(coalesce(body, ''), '<', '&lt;') || '&nbsp;&#39;</div></html>'"""


def _html() -> Column:
    none = lambda c: F.coalesce(F.col(c), F.lit(""))
    return F.concat(
        F.lit("<html><title> "),
        none("title"),
        F.lit(' </title><a href="'),
        none("source_url"),
        F.lit('"><b>'),
        none("title"),
        F.lit('</b></a><div class="article">'),
        F.replace(none("body"), F.lit("<"), F.lit("&lt;")),
        F.lit("&nbsp;&#39;</div></html>"),
    )


def _sql_plain(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace({x}, '<[^>]+>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&#[0-9]+;', '', 'g'), '{_WS}+', ' ', 'g'))"


@query(
    f"SELECT post_row, {_sql_plain('h')} AS plain, regexp_extract(h, '(?s)<a\\b[^>]*\\bhref=\"([^\"]*)\"', 1) AS link FROM (SELECT post_row, {_HTML} AS h FROM posts)"
)
def page_texts(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "posts").select("post_row", _html().alias("h"))
    return pages.select(
        "post_row",
        html.plain(F.col("h")).alias("plain"),
        F.coalesce(F.try_element_at(html.links(F.col("h")), F.lit(1))["url"], F.lit("")).alias("link"),
    )


@query(f"""SELECT post_row, regexp_extract(u, 'blog_([0-9a-z]+)', 1) AS id, {_sql_plain("coalesce(title, '')")} AS title
  FROM (SELECT post_row, title, coalesce(source_url, '') AS u FROM posts)
WHERE regexp_extract(u, 'blog_([0-9a-z]+)', 1) <> '' AND length({_sql_plain("coalesce(title, '')")}) > 3 AND NOT contains({_sql_plain("coalesce(title, '')")}, '...')""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "posts").select("post_row", _html().alias("h"))
    return pages.select("post_row", F.explode(html.article_links(F.col("h"), "host.example")).alias("l")).select("post_row", "l.id", "l.title")


# Documents

_JSON = "coalesce(to_json(tags)::VARCHAR, '[]')"


@query(
    f"""SELECT post_row, md5(coalesce(nullif(source_url, ''), id)) || '.md' AS file_name, '---' || chr(10) || 'title: "' || replace(coalesce(title, ''), '"', '\\"') || '"' || chr(10) || 'date: "' || coalesce(published_at, '') || '"' || chr(10) || 'source: "' || coalesce(source_url, '') || '"' || chr(10) || 'tags: ' || {_JSON} || chr(10) || '---' || chr(10) || chr(10) || '# ' || coalesce(title, '') || chr(10) || chr(10) || coalesce(body, '') || chr(10) AS content
  FROM posts"""
)
def collector_files(spark: SparkSession, d: str) -> DataFrame:
    return collector_documents(table(spark, d, "posts"), "post_row")


_FIELD = "coalesce(CAST({0} AS VARCHAR), '')"


def _sql_file(fields: dict[str, str]) -> str:
    """The text of a stored post as SQL."""
    lines = " || chr(10) || ".join(f"'{k}: ' || {v}" for k, v in fields.items())
    return f"'---' || chr(10) || {lines} || chr(10) || '---' || chr(10) || chr(10) || '# ' || coalesce(title, '') || chr(10) || chr(10) || coalesce(body, '') || chr(10)"


_POST_FIELDS = {k: f"coalesce(to_json({k})::VARCHAR, '[]')" if k in ("tags", "images") else _FIELD.format(k) for k in frontmatter.POST_KEYS}
_POST_FILE = _sql_file(_POST_FIELDS)


@query(f"SELECT post_row, md5(coalesce(nullif(source_url, ''), id)) || '.md' AS file_name, {_POST_FILE} AS content FROM posts")
def post_files(spark: SparkSession, d: str) -> DataFrame:
    return post_documents(table(spark, d, "posts"), keep=("post_row",))


# text of a JSON string
_QUOTE = "to_json(coalesce({}, ''))::VARCHAR"


@query(
    f"""WITH e AS (SELECT author_uid, row_number() OVER w AS line_no, count(*) OVER (PARTITION BY author_uid) AS total, '{{"index_row":' || index_row || ',"id":' || {_QUOTE.format('id')} || ',"title":' || {_QUOTE.format('title')} || ',"filename":' || {_QUOTE.format('filename')} || '}}' AS entry
  FROM post_index WINDOW w AS (PARTITION BY author_uid ORDER BY index_row))
SELECT author_uid, line_no, entry || CASE WHEN line_no < total THEN ',' ELSE '' END AS line FROM e
UNION ALL SELECT author_uid, 0, '{{"total": ' || count(*) || ', "posts": [' FROM post_index GROUP BY 1 UNION ALL SELECT author_uid, count(*) + 1, ']}}'
  FROM post_index GROUP BY 1"""
)
def index_json(spark: SparkSession, d: str) -> DataFrame:
    none = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return index_lines(
        table(spark, d, "post_index").select("author_uid", "index_row", none("id"), none("title"), none("filename")),
        "author_uid",
        ["index_row"],
    )


# Graph


def _posts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "posts").select(
        "post_row",
        F.col("post_row").cast("string").alias("post"),
        "author_name",
        "published_at",
        "tags",
        "title",
        "category",
        "body",
    )


_KEYWORDS = _FOLDED.replace("doc_id", "post_row").replace("FROM documents", "FROM posts").replace("(text", "(body").replace("lower(text)", "lower(body)")
_KW_EDGES = "SELECT CAST(post_row AS VARCHAR) AS src, keyword AS dst, 'contains_keyword' AS relation FROM (SELECT *, row_number() OVER (PARTITION BY post_row ORDER BY n DESC, f) AS rank FROM counted) WHERE rank <= 10"


def _post_keywords(spark: SparkSession, d: str) -> DataFrame:
    return stats.keywords(_posts(spark, d).select("post", "body"), ["post"], text.tokens_folded(F.col("body")))


@query(_KEYWORDS + _KW_EDGES)
def keyword_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.keyword_edges(_post_keywords(spark, d), "post")


_AUTHORS = "SELECT author_name AS src, CAST(post_row AS VARCHAR) AS dst, 'wrote' AS relation FROM posts WHERE author_name <> ''"


@query(_AUTHORS)
def author_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.author_edges(_posts(spark, d), "post", "author_name")


_NEXT = "SELECT src, dst, 'next_post' AS relation FROM (SELECT CAST(post_row AS VARCHAR) AS src, lead(CAST(post_row AS VARCHAR)) OVER (ORDER BY coalesce(published_at, ''), post_row) AS dst FROM posts) WHERE dst IS NOT NULL"


def _dated(spark: SparkSession, d: str) -> DataFrame:
    return _posts(spark, d).withColumn("at", F.coalesce("published_at", F.lit("")))


@query(_NEXT)
def next_post_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.next_edges(_dated(spark, d).select("post", "at", "post_row"), "post", ["at", "post_row"])


@query(
    "SELECT src, dst, 'next_post' AS relation FROM (SELECT CAST(event_id AS VARCHAR) AS src, lead(CAST(event_id AS VARCHAR)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst FROM events) WHERE dst IS NOT NULL"
)
def next_event_edges(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select(F.col("event_id").cast("string").alias("event"), "event_id", "user_id", "ts")
    return graph.next_edges(events, "event", ["ts", "event_id"], within="user_id").select("src", "dst", "relation")


_TAG_EDGES = "SELECT DISTINCT CAST(post_row AS VARCHAR) AS src, 'tag:' || tag AS dst, 'has_tag' AS relation FROM (SELECT post_row, unnest(tags) AS tag FROM posts) WHERE tag IS NOT NULL"


@query(_TAG_EDGES)
def tag_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.tag_edges(_posts(spark, d), "post", "tags")


# all pairs of posts that share a tag, written out
_PAIRS = """
held AS (SELECT post_row, unnest(tags) AS tag, generate_subscripts(tags, 1) AS k FROM posts),
linked AS (SELECT DISTINCT a.tag, a.post_row AS p, b.post_row AS q FROM held a JOIN held b ON a.tag = b.tag AND (a.post_row, a.k) < (b.post_row, b.k)),
shared AS (SELECT DISTINCT CAST(p AS VARCHAR) AS src, CAST(q AS VARCHAR) AS dst, 'shares_tag' AS relation FROM linked)
"""


@query(
    "WITH" + _PAIRS + ", links AS (SELECT tag, count(*) AS n FROM linked GROUP BY 1), sizes AS (SELECT tag, count(DISTINCT post_row) AS n_posts FROM held WHERE tag IS NOT NULL GROUP BY 1) SELECT 'tag:' || tag AS id, tag, n_posts, coalesce(n, 0) AS n_links FROM sizes LEFT JOIN links USING (tag)"
)
def tag_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each tag with its posts and the links among them that it stands for."""
    return graph.tag_classes(_posts(spark, d), "post", "tags")


_COLLAPSED = """SELECT src, dst, relation FROM (SELECT *, CASE relation WHEN 'wrote' THEN 4 WHEN 'next_post' THEN 3 WHEN 'contains_keyword' THEN 2 WHEN 'shares_tag' THEN 1 ELSE 0 END AS p
  FROM every) QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY p DESC, relation DESC) = 1"""
_OTHERS = f"{_KW_EDGES} UNION ALL {_NEXT} UNION ALL {_AUTHORS}"
_EDGES = _KEYWORDS.rstrip() + f", every AS ({_TAG_EDGES} UNION ALL {_OTHERS}), edges AS ({_COLLAPSED})"
# the graph in which every link by a tag is an edge
_FULL = _KEYWORDS.rstrip() + "," + _PAIRS.rstrip() + f", every AS (SELECT * FROM shared UNION ALL {_OTHERS}), edges AS ({_COLLAPSED})"
_IDS = f"""ids AS (
  SELECT CAST(post_row AS VARCHAR) AS id, 'post' AS type, 3 AS r FROM posts UNION ALL SELECT dst, 'keyword', 2
  FROM ({_KW_EDGES}) UNION ALL SELECT src, 'author', 1 FROM ({_AUTHORS})
  UNION ALL SELECT dst, 'tag', 0 FROM ({_TAG_EDGES})), typed AS (SELECT id, arg_max(type, r) AS type FROM ids GROUP BY 1)"""


def _other_edges(spark: SparkSession, d: str) -> DataFrame:
    return keyword_edges(spark, d).unionByName(next_post_edges(spark, d)).unionByName(author_edges(spark, d))


@query(_EDGES + " SELECT * FROM edges")
def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.collapse(tag_edges(spark, d).unionByName(_other_edges(spark, d)))


@query(
    _KEYWORDS.rstrip() + f", {_IDS} SELECT t.*, title, author_name AS author, published_at, category, tags FROM typed t LEFT JOIN posts p ON CAST(p.post_row AS VARCHAR) = t.id"
)
def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    posts = _posts(spark, d).select(F.col("post").alias("id"), "title", F.col("author_name").alias("author"), "published_at", "category", "tags")
    return graph.nodes(posts, keyword_edges(spark, d).select("dst"), author_edges(spark, d).select("src"), tag_edges(spark, d).select("dst"))


@query(
    _EDGES + f", {_IDS} SELECT 'node' AS part, type AS kind, count(*) AS n FROM typed GROUP BY 2 UNION ALL SELECT 'edge', relation, count(*) FROM edges GROUP BY 2"
)
def graph_counts(spark: SparkSession, d: str) -> DataFrame:
    return graph.graph_counts(graph_nodes(spark, d), graph_edges(spark, d))


@query(_EDGES + f", {_IDS} SELECT count(*) AS n FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges) e ANTI JOIN typed USING (id)")
def dangling_ends(spark: SparkSession, d: str) -> DataFrame:
    """How many ends of edges are no node: none."""
    return graph.dangling(graph_edges(spark, d), graph_nodes(spark, d)).agg(F.count(F.lit(1)).alias("n"))


@query(
    _FULL
    + f""", {_IDS}, ends AS (SELECT src AS id, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0
  FROM edges), tallied AS (SELECT id, sum(i) AS n_in, sum(o) AS n_out FROM ends GROUP BY 1)
SELECT id, CAST(coalesce(n_in, 0) AS BIGINT) AS n_in, CAST(coalesce(n_out, 0) AS BIGINT) AS n_out,
  CAST(coalesce(n_in + n_out, 0) AS BIGINT) AS degree FROM typed LEFT JOIN tallied USING (id)
  WHERE type <> 'tag'"""
)
def node_degrees(spark: SparkSession, d: str) -> DataFrame:
    """Edges of every post, keyword and author in the graph that has the links of every tag, whatever its size."""
    degrees = graph.exact_degrees(_posts(spark, d), "post", "tags", "post_row", _other_edges(spark, d))
    return graph.with_isolated(degrees, _posts(spark, d).select(F.col("post").alias("id")))  # keywords and authors have edges


# Settings of the example: documents with keywords, and rules from words to documents.
_DOCS = {"trend.md": ["趋势", "均线", "量能", "仓位"], "risk.md": ["仓位", "止盈", "风险", "现金"], "volume.md": ["量能", "成交", "换手", "均线"], "mind.md": ["心态", "现金", "耐心"]}
_RULES = [(["均线", "布林带"], "trend.md"), (["仓位", "轻仓"], "risk.md"), (["换手率", "量比", "成交"], "volume.md"), (["耐心", "心态"], "mind.md"), (["现金"], "risk.md")]
_DOC_ROWS = [(doc, i, kw) for i, (doc, kws) in enumerate(_DOCS.items()) for kw in kws]


@query(
    f"""WITH k(doc, pos, kw) AS (VALUES {', '.join(f"('{d}', {p}, '{k}')" for d, p, k in _DOC_ROWS)}),
s AS (SELECT a.doc, b.doc AS other, count(*) AS score, list_sort(list(a.kw)) AS common, min(b.pos) AS pos
  FROM k a JOIN k b ON a.kw = b.kw AND a.doc <> b.doc GROUP BY 1, 2)
SELECT doc, other, score, array_to_string(common, ' ') AS common, rank FROM (SELECT *, row_number() OVER (PARTITION BY doc
  ORDER BY score DESC, pos) AS rank FROM s) WHERE rank <= 4"""
)
def related_docs(spark: SparkSession, d: str) -> DataFrame:
    return graph.related(spark.createDataFrame(_DOC_ROWS, "doc string, pos int, kw string")).withColumn("common", F.array_join("common", " "))


_HITS = ", ".join(
    "struct_pack(concept := CASE " + " ".join(
        f"WHEN contains(body, '{w}') THEN '{w}'" for w in words
    ) + f" END, doc := '{doc}')" for words, doc in _RULES
)


@query(
    f"""WITH f AS (SELECT post_row, list_filter([{_HITS}], lambda x: x.concept IS NOT NULL) AS l FROM posts WHERE body IS NOT NULL),
e AS (SELECT post_row, unnest(l) AS x, generate_subscripts(l, 1) AS pos FROM f),
o AS (SELECT post_row, x.concept AS concept, x.doc AS doc, pos FROM e QUALIFY row_number() OVER (PARTITION BY post_row, x.doc ORDER BY pos) = 1)
SELECT post_row, concept, doc, rank FROM (SELECT *, row_number() OVER (PARTITION BY post_row ORDER BY pos) AS rank FROM o) WHERE rank <= 5"""
)
def concept_links(spark: SparkSession, d: str) -> DataFrame:
    return graph.concept_links(table(spark, d, "posts"), "post_row", "body", _RULES)


# Batches

_BATCHED = "SELECT post_row, title, body, (row_number() OVER (ORDER BY filename, post_row) - 1) // 10 AS batch_id, CAST((row_number() OVER (ORDER BY filename, post_row) - 1) % 10 + 1 AS INTEGER) AS idx FROM posts"


def _numbers(spark: SparkSession, d: str) -> DataFrame:
    return batching.batches(table(spark, d, "posts").select("post_row", "filename"), ["filename", "post_row"], 10)


def _batched(spark: SparkSession, d: str) -> DataFrame:
    """Only keys are numbered; the texts are joined to them."""
    return _numbers(spark, d).join(table(spark, d, "posts").select("post_row", "title", "body"), "post_row")


@query(f"SELECT post_row, batch_id, idx FROM ({_BATCHED})")
def batch_numbers(spark: SparkSession, d: str) -> DataFrame:
    return _numbers(spark, d).select("post_row", "batch_id", "idx")


@query(
    f"""SELECT batch_id, count(*) AS n, '' || string_agg('=== ' || idx || ' ===' || chr(10) || coalesce(title, '') || chr(10) || substr(coalesce(body, ''), 1, 2500), chr(10) || chr(10)
  ORDER BY idx) AS prompt FROM ({_BATCHED}) GROUP BY 1"""
)
def batch_prompts(spark: SparkSession, d: str) -> DataFrame:
    return batching.prompt_of(_batched(spark, d), "title", "body", intro="")


@query(f"SELECT batch_id, 'records ' || count(*) AS reply FROM ({_BATCHED}) GROUP BY 1")
def batch_replies(spark: SparkSession, d: str) -> DataFrame:
    return batching.map_batches(_numbers(spark, d).select("batch_id", "idx", "post_row"), lambda rows: f"records {len(rows)}")


@query("SELECT r.result_id, p.batch_id, p.idx FROM analysis_results r LEFT JOIN analysis_prompts p ON p.batch_id = r.prompt_id // 10 AND p.idx = r.idx")
def results_by_position(spark: SparkSession, d: str) -> DataFrame:
    results = table(spark, d, "analysis_results").select("result_id", F.floor(F.col("prompt_id") / 10).alias("b"), "idx").withColumnRenamed("b", "batch_id")
    prompts = table(spark, d, "analysis_prompts").select("batch_id", "idx", F.struct("batch_id", "idx").alias("p"))
    return batching.attach(results, prompts, ["p"]).select("result_id", "p.batch_id", "p.idx")


@query(
    "SELECT post_row FROM (SELECT post_row, coalesce(sum(coalesce(length(body), 0)) OVER (PARTITION BY author_uid ORDER BY post_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM posts) WHERE b <= 3000"
)
def within_budget(spark: SparkSession, d: str) -> DataFrame:
    posts = table(spark, d, "posts").select("post_row", "author_uid", F.coalesce(F.length("body"), F.lit(0)).alias("size"))
    return batching.within_budget(posts, "author_uid", ["post_row"], "size", 3000).select("post_row")


@query(
    "SELECT coalesce(min(CASE WHEN a._source_file IS NULL THEN p.post_row END), max(p.post_row) + 1) AS resume_at FROM posts p LEFT JOIN (SELECT DISTINCT _source_file FROM analysis_results) a ON a._source_file = p.filename"
)
def resume_position(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "analysis_results").select(F.col("_source_file").alias("filename"))
    return reconcile.first_open(table(spark, d, "posts").select("post_row", "filename"), done, "filename", "post_row")


@query(
    "SELECT post_row, title, list_slice(list_filter(coalesce(tags, []), lambda t: t IS NOT NULL AND t <> ''), 1, 5) AS tags, coalesce(body, '') AS body FROM posts WHERE title IS NOT NULL"
)
def reply_entries(spark: SparkSession, d: str) -> DataFrame:
    posts = table(spark, d, "posts").where(F.col("title").isNotNull())
    reply = F.concat(
        F.lit("```json\nHere: "),
        F.to_json(F.array(F.struct("title", F.col("tags"), F.coalesce("body", F.lit("")).alias("content")))),
        F.lit("\n```"),
    )
    first = posts.select("post_row", F.explode(F.slice(batching.entries(reply), 1, 1)).alias("e"))
    return first.select("post_row", "e.title", "e.tags", "e.body")


# Streaming


@query("SELECT source_url, 1::BIGINT AS n FROM posts GROUP BY 1")
def stream_merge(spark: SparkSession, d: str) -> DataFrame:
    """Every address once, over two runs of which the second goes on where the first ended and brings all posts again."""
    from inkfold.streaming.ingest import merge_into, new_files

    posts = table(spark, d, "posts").select("post_row", "id", "source_url")
    landed = new_path(spark)
    for _ in range(2):
        posts.write.mode("append").parquet(f"{landed}/in")
        merge_into(new_files(spark, f"{landed}/in", posts.schema), "source_url", f"{landed}/out", f"{landed}/state").awaitTermination()
    return spark.read.schema(posts.schema).parquet(f"{landed}/out").groupBy("source_url").agg(F.count(F.lit(1)).alias("n"))


# Relational surface on the other tables


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1")
def order_months(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("o_totalprice").alias("total"),
    )


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def orders_without_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return reconcile.missing(table(spark, d, "orders").select("o_orderkey"), lines, "o_orderkey")


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(
        F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("day"),
        "event_type",
    ).agg(F.count(F.lit(1)).alias("n"))
