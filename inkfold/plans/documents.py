"""Queries over files and pages: tables are written as the files a collection is kept in, in the shared folder, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkfold.functions import frontmatter, html, text
from inkfold.operators import batching, graph, quality, reconcile, stats
from inkfold.plans.corpus import _LABELS, _POST_FIELDS, _POST_FILE, _sql_file, integrity_issues, quality_title_first, reconcile_report, sql_round1
from inkfold.plans.corpus import ORACLE as CORPUS_SQL
from inkfold.plans.registry import Registry
from inkfold.plans.training import _WS, _strip
from inkfold.session import new_path
from inkfold.sinks import documents as sinks
from inkfold.sources import documents as sources
from inkfold.sources import markdown
from inkfold.sources.pages import read_pages
from inkfold.sources.tables import table
from inkfold.streaming import ingest

query = Registry()
QUERIES, ORACLE = query.queries, query.oracle

# Posts as Markdown files: one file a post, named by its row


def _post_folder(spark: SparkSession, d: str) -> str:
    folder = new_path(spark)
    posts = sinks.post_documents(table(spark, d, "posts"), keep=("post_row",))
    sinks.write_files(posts.select(F.concat(F.col("post_row").cast("string"), F.lit("_"), "file_name").alias("file_name"), "content"), folder)
    return folder


_NAME = "CAST(post_row AS VARCHAR) || '_' || md5(coalesce(nullif(source_url, ''), id)) || '.md'"
_FILES = f"WITH files AS (SELECT *, {_NAME} AS filename_, {_POST_FILE} AS content FROM posts), parts AS (SELECT *, string_split(content, '---' || chr(10)) AS p FROM files), bodies AS (SELECT *, substr(array_to_string(list_slice(p, 3, len(p)), chr(10)), 2) AS rest FROM parts)"


@query(
    _FILES
    + r""" SELECT filename_ AS filename, id, regexp_extract(rest, '(?m)^#\s+(.+?)\s*$', 1) AS title,
  coalesce(published_at, '') AS published_at, substr(coalesce(published_at, ''), 1, 10) AS published_date,
substr(coalesce(published_at, ''), 1, 4) AS published_year, substr(coalesce(published_at, ''), 1, 7) AS published_month, """ + _strip("coalesce(source_url, '')") + r""" AS source_url,
  coalesce(tags, []) AS tags,
CAST(images_count AS INTEGER) AS images_count, CAST(length(rest) AS INTEGER) AS body_length, rest AS body FROM bodies"""
)
def stored_articles(spark: SparkSession, d: str) -> DataFrame:
    """Every post written as a file and read as a typed article."""
    return markdown.articles(markdown.files(spark, _post_folder(spark, d), recursive=True))


@query("SELECT CAST(post_row AS VARCHAR) AS id FROM posts")
def stored_ids(spark: SparkSession, d: str) -> DataFrame:
    return markdown.stored_ids(markdown.files(spark, _post_folder(spark, d)))


@query(f"SELECT {_NAME} AS file_name FROM posts ORDER BY 1 LIMIT 50")
def first_files(spark: SparkSession, d: str) -> DataFrame:
    return markdown.first_files(markdown.files(spark, _post_folder(spark, d))).select("file_name")


@query(f"SELECT {_NAME} AS file_name FROM posts WHERE starts_with(CAST(post_row AS VARCHAR), '1') AND ends_with({_NAME}, 'a.md')")
def files_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Files whose names begin and end as asked; the others are not read."""
    return markdown.files(spark, _post_folder(spark, d), prefix="1", suffix="a.md").select("file_name")


_WORDS = ["abc", "42", "9f"]


@query(
    _FILES
    + f""", hits AS (SELECT w AS word, filename_ AS file_name, content, row_number() OVER (PARTITION BY w
  ORDER BY filename_) AS k FROM files, (VALUES {', '.join(f"('{w}')" for w in _WORDS)}) v(w)
  WHERE contains(filename_, w)),
used AS (SELECT *, coalesce(sum(length(content)) OVER (ORDER BY word, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS u FROM hits WHERE k <= 2)
SELECT word, file_name FROM used WHERE u <= 1500"""
)
def files_by_keyword(spark: SparkSession, d: str) -> DataFrame:
    return markdown.by_keywords(markdown.files(spark, _post_folder(spark, d)), _WORDS, budget=1500).select("word", "file_name")


# JSON files: pages of 50 entries


def _paged(spark: SparkSession, d: str, name: str, key: str, *columns: str) -> DataFrame:
    """``batch_id, total, rows``: the rows of a table, 50 to a page, as arrays."""
    numbers = batching.batches(table(spark, d, name).select(key), [key], 50)
    rows = numbers.join(table(spark, d, name).select(key, *columns), key)
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("total"), F.array_sort(F.collect_list(F.struct(key, *columns))).alias("rows"))  # 50 at most


_ENTRY = ("id", "title", "published_at", "published_date", "tags", "images_count", "filename", "source_url", "indexed_at")


def _index_folder(spark: SparkSession, d: str) -> str:
    """Index files; every third calls its list ``articles``, every seventh is cut off."""
    folder = new_path(spark)
    pages = _paged(spark, d, "post_index", "index_row", *_ENTRY)
    entries = F.transform("rows", lambda r: F.struct(*(r[c].alias(c) for c in _ENTRY)))
    content = F.when(
        F.col("batch_id") % 3 == 2,
        F.to_json(F.struct("total", entries.alias("articles"))),
    ).otherwise(F.to_json(F.struct("total", entries.alias("posts"))))
    cut = F.when(F.col("batch_id") % 7 == 6, F.substring(content, 1, 40)).otherwise(content)
    sinks.write_files(pages.select(F.format_string("page_%06d.json", "batch_id").alias("file_name"), cut.alias("content")), folder)
    return folder


_PAGED = "SELECT *, (row_number() OVER (ORDER BY index_row) - 1) // 50 AS page FROM post_index"


@query(f"SELECT coalesce(id, '') AS id, {', '.join(c for c in _ENTRY[1:])} FROM ({_PAGED}) WHERE page % 7 <> 6")
def index_files(spark: SparkSession, d: str) -> DataFrame:
    return sources.index_rows(spark, _index_folder(spark, d)).select(F.coalesce("id", F.lit("")).alias("id"), *_ENTRY[1:])


@query(f"SELECT DISTINCT 'page_' || lpad(CAST(page AS VARCHAR), 6, '0') || '.json' AS file_name FROM ({_PAGED}) WHERE page % 7 = 6")
def broken_index_files(spark: SparkSession, d: str) -> DataFrame:
    return sources.bad_indexes(spark, _index_folder(spark, d)).select(F.element_at(F.split("file_path", "/"), -1).alias("file_name"))


@query("SELECT result_id, prompt_id, concepts, market_view FROM analysis_results")
def result_files(spark: SparkSession, d: str) -> DataFrame:
    """Results written as JSON arrays and read back."""
    folder = new_path(spark)
    pages = _paged(spark, d, "analysis_results", "result_id", "prompt_id", "concepts", "market_view")
    sinks.write_files(pages.select(F.format_string("%06d.json", "batch_id").alias("file_name"), F.to_json("rows").alias("content")), folder)
    return sources.json_array(spark, folder, "result_id bigint, prompt_id bigint, concepts array<string>, market_view string")


@query("SELECT DISTINCT uid AS keyword, [coalesce(name, ''), coalesce(domain, '')] AS words FROM bloggers WHERE uid IS NOT NULL")
def keyword_maps(spark: SparkSession, d: str) -> DataFrame:
    folder = new_path(spark)
    named = table(spark, d, "bloggers").where(F.col("uid").isNotNull()).select(
        "uid",
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("domain", F.lit("")).alias("domain"),
    )
    content = F.to_json(F.create_map("uid", F.array("name", "domain")))
    sinks.write_files(named.select(F.concat("uid", F.lit(".json")).alias("file_name"), content.alias("content")), folder)
    return sources.json_map(spark, folder)


@query("SELECT name, uid FROM bloggers WHERE name <> '' AND uid <> ''")
def settings_rows(spark: SparkSession, d: str) -> DataFrame:
    """Bloggers as a YAML list of settings, which the driver reads."""
    entry = F.concat(F.lit('  - name: "'), "name", F.lit('"\n    uid: "'), "uid", F.lit('"\n    enabled: true'))
    rows = table(spark, d, "bloggers").where((F.col("name") != "") & (F.col("uid") != "")).select(entry.alias("e")).collect()  # settings
    path = new_path(spark)
    sinks.write_files(
        spark.createDataFrame(
            [("s.yaml", "bloggers:\n" + "\n".join(r["e"] for r in rows) + "\nstorage:\n  - name: x\n")],
            "file_name string, content string",
        ),
        path,
    )
    return sources.settings(spark, f"{path.removeprefix('file://')}/s.yaml")


@query("SELECT uid, name FROM bloggers WHERE uid = (SELECT min(uid) FROM bloggers)")
def chosen_blogger(spark: SparkSession, d: str) -> DataFrame:
    bloggers = table(spark, d, "bloggers")
    return sources.chosen(bloggers, bloggers.agg(F.min("uid")).first()[0]).select("uid", "name")


# Line files


def _line_file(spark: SparkSession, df: DataFrame) -> str:
    """``at, line`` as one text file, in order."""
    path = new_path(spark)
    df.repartition(1).sortWithinPartitions("at").select("line").write.text(path)  # a fixture of one file
    return path


@query(f"SELECT {_strip('source_url')} AS line FROM post_index WHERE {_strip('source_url')} <> ''")
def url_lines(spark: SparkSession, d: str) -> DataFrame:
    index = table(spark, d, "post_index").select(F.col("index_row").alias("at"), F.coalesce("source_url", F.lit("")).alias("line"))
    path = new_path(spark)
    index.select("line").write.text(path)
    return sources.lines(spark, path)


@query("SELECT row_number() OVER (ORDER BY removal_id) - 1 AS pos, id, coalesce(nullif(reason, ''), id) AS title FROM removed_posts WHERE id <> ''")
def paired_lines(spark: SparkSession, d: str) -> DataFrame:
    removed = table(spark, d, "removed_posts").where(F.col("id") != "")
    files = (_line_file(spark, removed.select(F.col("removal_id").alias("at"), F.coalesce(c, F.lit("")).alias("line"))) for c in ("id", "reason"))
    return sources.zipped(*(sources.numbered_lines(spark, f) for f in files))


@query("SELECT post_row, id, title FROM posts")
def noisy_output(spark: SparkSession, d: str) -> DataFrame:
    """Rows from the output of a program that logs before its JSON."""
    posts = table(spark, d, "posts").select("post_row", F.concat(F.lit("fetching page\n"), F.to_json(F.array(F.struct("id", "title")))).alias("out"))
    rows = posts.select("post_row", F.explode(html.noisy_json(F.col("out"), "array<struct<id: string, title: string>>")).alias("r"))
    return rows.select("post_row", "r.id", "r.title")


# Pages

_PLAIN = lambda x: f"trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace({x}, '<[^>]+>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&#[0-9]+;', '', 'g'), '{_WS}+', ' ', 'g'))"


def _article_pages(spark: SparkSession, d: str) -> DataFrame:
    """Each post as the page it came from: nested elements, an end mark, images within and without."""
    none = lambda c: F.coalesce(F.col(c), F.lit(""))
    safe = lambda c: F.regexp_replace(none(c), "[<>]", " ")
    images = F.array_join(
        F.transform(
            F.coalesce("images", F.array().cast("array<string>")),
            lambda i: F.concat(F.lit('<img class="x" src="'), F.coalesce(i, F.lit("-")), F.lit('"/>')),
        ),
        "",
    )
    page = F.concat(
        F.lit(
            '<html><h2 id="t" class="titName SG_txta"> '
        ), safe("title"), F.lit(' </h2><span class="time SG_txtc">('), none("published_at"), F.lit(")</span><script>var $tag='"),
        F.regexp_replace(F.array_join(F.coalesce("tags", F.array().cast("array<string>")), ",", ""), "'", ""), F.lit("';</script>"),
        F.lit('<div id="c" class="articalContent   newfont">'), safe("body"), F.lit("<div>&nbsp;<div>"), images, F.lit(
            '</div>in &amp; <b>out</b></div>&#39;<!-- 正文结束 --></div><div>after<img src="http://cdn.example/foot.png"></div></html>'
        ),
    )
    return table(spark, d, "posts").select("post_row", none("source_url").alias("url"), page.alias("page"))


_SAFE = "regexp_replace(coalesce({}, ''), '[<>]', ' ', 'g')"
_RAW_TAGS = "replace(array_to_string(list_transform(coalesce(tags, []), lambda t: coalesce(t, '')), ','), '''', '')"


@query(
    f"""SELECT post_row, regexp_extract(coalesce(source_url, ''), 'blog_([0-9a-z]+)', 1) AS id, {_strip(_SAFE.format('title'))} AS title, {_strip("coalesce(published_at, '')")} AS date,
CASE WHEN {_RAW_TAGS} = '' THEN [] ELSE list_transform(string_split({_RAW_TAGS}, ','), lambda t: {_strip('t')}) END AS tags, {_PLAIN(_SAFE.format('body') + " || ' in &amp; out'")} AS content,
list_concat(list_transform(coalesce(images, []), lambda i: coalesce(i, '-')), ['http://cdn.example/foot.png']) AS images,
  list_filter(list_transform(coalesce(images, []), lambda i: coalesce(i, '-')), lambda i: NOT contains(i, 'cdn.example')) AS own_images
  FROM posts"""
)
def article_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = _article_pages(spark, d).select(
        "post_row",
        html.article(F.col("page"), F.col("url")).alias("a"),
        html.images(F.col("page"), without_host="cdn.example").alias("own_images"),
    )
    return pages.select("post_row", "a.id", "a.title", "a.date", "a.tags", "a.content", "a.images", "own_images")


def _list_pages(spark: SparkSession, d: str) -> DataFrame:
    """Posts, 50 to a page of links with a pagination."""
    pages = _paged(spark, d, "posts", "post_row", "id", "title", "published_at")
    none = lambda c: F.coalesce(c, F.lit(""))
    link = lambda r: F.concat(
        F.lit('<li><a class="x" href="//host.example/s/blog_'),
        r["id"],
        F.lit('.html"><b>'),
        F.regexp_replace(none(r["title"]), "[<>\\n\\r]", " "),
        F.lit("</b></a> ("),
        none(r["published_at"]),
        F.lit(")</li>\n"),
    )
    page = F.concat(
        F.array_join(F.transform("rows", link), ""),
        F.lit('<a href="list_0_'),
        (F.col("batch_id") + 1).cast("string"),
        F.lit('.html">next</a> list_0_99999.html'),
    )
    return pages.select("batch_id", page.alias("page"))


_LISTED = f"""WITH l AS (SELECT post_row, (row_number() OVER (ORDER BY post_row) - 1) // 50 AS batch_id,
  regexp_extract('blog_' || id, 'blog_([0-9a-z]+)', 1) AS id, {_PLAIN("regexp_replace(coalesce(title, ''), '[<>' || chr(10) || chr(13) || ']', ' ', 'g')")} AS title,
  coalesce(published_at, '') AS moment FROM posts)"""


@query(
    _LISTED + " SELECT batch_id, id, arg_min(title, post_row) AS title FROM l WHERE id <> '' AND length(title) > 3 AND NOT contains(title, '...') GROUP BY 1, 2"
)
def listed_links(spark: SparkSession, d: str) -> DataFrame:
    links = _list_pages(spark, d).select("batch_id", F.explode(html.article_links(F.col("page"), "host.example")).alias("l"))
    return links.select("batch_id", "l.id", "l.title")


@query(
    _LISTED + r" SELECT batch_id, batch_id + 1 AS last_page, CAST(count(*) AS INTEGER) AS n_lines, coalesce(regexp_extract(string_agg('(' || moment || ')', '' ORDER BY post_row), '\((\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\)', 1), '') AS first_time FROM l GROUP BY 1"
)
def list_page_facts(spark: SparkSession, d: str) -> DataFrame:
    page = F.col("page")
    return _list_pages(spark, d).select(
        "batch_id",
        html.page_numbers(page).alias("last_page"),
        html.matching_lines(page, r"/s/blog_").alias("n_lines"),
        html.stated_time(page).alias("first_time"),
    )


@query(
    "SELECT row_number() OVER (ORDER BY uid, name) AS page, coalesce(uid, '') AS id, coalesce(name, '') AS title FROM bloggers QUALIFY length(regexp_extract('blog_' || coalesce(uid, ''), 'blog_([0-9a-z]+)', 1)) > 0 AND length(coalesce(name, '')) > 1"
)
def fetched_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages from a function that is asked for one after the other, here for the bloggers, which are settings."""
    rows = sorted((r["uid"] or "", r["name"] or "") for r in table(spark, d, "bloggers").select("uid", "name").collect())

    def fetch(page: int) -> str | None:
        return None if page > len(rows) else '<a href="/s/blog_{}.html">{}</a>'.format(*rows[page - 1])

    links = read_pages(spark, fetch, len(rows) + 30, pages_per_task=50).select(
        "page",
        F.explode(html.article_links(F.col("html"), "host.example", min_title=1)).alias("l"),
    )
    return links.select("page", "l.id", "l.title")


# Names and literals


@query(
    f"""SELECT post_row, CASE WHEN source_url IS NULL THEN NULL ELSE lower(hex(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END))) || '.md' END AS hashed,
  substr(regexp_replace(regexp_replace({_strip("coalesce(title, '')")}, '[\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ\\pP\\pS]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 80) AS slug
FROM (SELECT *, list_reduce(list_concat([0::BIGINT], list_transform(string_split(source_url, ''), lambda c: ord(c)::BIGINT)), lambda a, c: (a * 31 + c) % 4294967296) AS h
  FROM posts)"""
)
def other_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "posts").select(
        "post_row",
        text.rolling_hash_name(F.col("source_url")).alias("hashed"),
        text.cjk_slug(F.coalesce("title", F.lit(""))).alias("slug"),
    )


_JOINED = "array_to_string(list_filter(coalesce(tags, []), lambda t: t IS NOT NULL), ', ')"


@query(
    f"SELECT post_row, CASE WHEN {_JOINED} = '' THEN [''] ELSE list_transform(string_split({_JOINED}, ','), lambda t: {_strip('t')}) END AS literal, coalesce(list_transform(tags, lambda t: t), []) AS parsed FROM posts"
)
def tag_lists(spark: SparkSession, d: str) -> DataFrame:
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    literal = F.concat(F.lit(" ["), F.array_join(tags, ", "), F.lit("]\n"))
    return table(spark, d, "posts").select(
        "post_row",
        text.tag_literal(literal).alias("literal"),
        text.json_list(F.when(F.col("tags").isNull(), F.lit("{bad")).otherwise(F.to_json(tags))).alias("parsed"),
    )


@query(rf"""WITH t AS (SELECT doc_id, {_strip('text')} AS t FROM documents WHERE text IS NOT NULL), l AS (SELECT doc_id, {_strip("regexp_replace(string_split(t, chr(10))[1], '^#+', '')")} AS l
  FROM t)
SELECT doc_id, coalesce(nullif(substr(l, 1, 100), ''), 'untitled') AS title FROM l""")
def first_line_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.col("text").isNotNull()).select(
        "doc_id",
        text.first_line_title(F.col("text"), F.lit("untitled")).alias("title"),
    )


@query(
    "SELECT index_row, CASE WHEN contains(title, '\"') THEN '[' || regexp_extract(title, '^([^\"]*)', 1) ELSE '[' || title END || ']: ' || coalesce(published_date, '') AS line FROM post_index WHERE title IS NOT NULL AND NOT contains(title, chr(10))"
)
def entry_summaries(spark: SparkSession, d: str) -> DataFrame:
    index = table(spark, d, "post_index").where(F.col("title").isNotNull() & ~F.col("title").contains("\n"))
    entry = frontmatter.render_wiki(
        F.col("title"),
        F.coalesce("published_date", F.lit("")),
        F.array(F.lit("a"), F.lit("b")),
        F.array().cast("array<string>"),
        F.lit("2020-01-01"),
    )
    return index.select("index_row", text.entry_summary(entry, F.lit("x.md")).alias("line"))


@query(f"SELECT post_row, {sql_round1('coalesce(likes, 0) * 100.0::DOUBLE / (coalesce(likes, 0) + coalesce(comments, 0) + 7)')} AS share FROM posts")
def rounded_shares(spark: SparkSession, d: str) -> DataFrame:
    likes, comments = F.coalesce("likes", F.lit(0)), F.coalesce("comments", F.lit(0))
    return table(spark, d, "posts").select("post_row", text.round1(likes * F.lit(100.0) / (likes + comments + 7)).alias("share"))


# Other documents

_HEAD = lambda fields: "'---' || chr(10) || " + " || chr(10) || ".join(
    f"'{k}: ' || {v}" for k, v in fields.items()
) + " || chr(10) || '---' || chr(10) || chr(10) || '# ' || coalesce(title, '') || chr(10) || chr(10) || coalesce(body, '') || chr(10)"
_SIX = {
    k: f"coalesce({k}, '')" for k in ("id", "author_uid", "author_name")
} | {"published_at": "coalesce(nullif(published_at, ''), 'unknown')"} | {k: f"coalesce({k}, '')" for k in ("fetched_at", "source_url")}


@query(
    f"SELECT post_row, id || '_' || substr(regexp_replace(coalesce(title, ''), '[^\\pL\\pN_]', '_', 'g'), 1, 50) || '.md' AS file_name, {_HEAD(_SIX)} AS content FROM posts"
)
def short_files(spark: SparkSession, d: str) -> DataFrame:
    return sinks.short_documents(table(spark, d, "posts"), "post_row")


@query(f"SELECT post_row, {_sql_file(_POST_FIELDS | {'keywords': _POST_FIELDS['tags']})} AS content FROM posts")
def keyword_files(spark: SparkSession, d: str) -> DataFrame:
    """Files with the keywords, here the tags, as the fourteenth key."""
    return sinks.post_documents(table(spark, d, "posts"), keywords=F.col("tags"), keep=("post_row",)).select("post_row", "content")


@query(
    """SELECT uid, to_json({'uid': coalesce(uid, ''), 'name': coalesce(name, ''), 'domain': 'https://host.example/u/' || coalesce(uid, ''), 'total_articles': coalesce(total_articles, 0), 'profile': {'description': coalesce(profile.description, ''), 'category': coalesce(profile.category, '')}, 'created_at': coalesce(created_at, '')})::VARCHAR AS content
  FROM bloggers"""
)
def blogger_files(spark: SparkSession, d: str) -> DataFrame:
    return sinks.blogger_documents(table(spark, d, "bloggers"), "host.example")


_RANKED = "SELECT *, row_number() OVER (ORDER BY filename, post_row) AS rank FROM posts"


@query(
    f"""WITH r AS ({_RANKED}), s AS (SELECT post_row, rank, author_uid, title, body, regexp_replace(regexp_replace(coalesce(title, ''), '[^\\pL\\pN\\pM_\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}-]', '', 'g'), '(-|{_WS})+', '-', 'g') AS x
  FROM r),
t AS (SELECT *, regexp_replace(substr(lower(regexp_replace(x, '^-+|-+$', '', 'g')), 1, 60), '-+$', '') AS slug FROM s)
SELECT post_row, concat_ws('_', author_uid, CASE WHEN slug = '' THEN 'untitled' ELSE slug END,
  CASE WHEN rank < 10000 THEN lpad(CAST(rank AS VARCHAR), 4, '0') ELSE CAST(rank AS VARCHAR) END || '.md') AS file_name,
'# ' || coalesce(title, '') || chr(10) || chr(10) || CASE WHEN starts_with(body, '# ') THEN regexp_replace(body, '^[# ]+{_WS}*', '') ELSE coalesce(body, '') END AS content
  FROM t"""
)
def staged_files(spark: SparkSession, d: str) -> DataFrame:
    """Posts that are there, in order, under their titles and with their ranks in the names."""
    numbers = batching.batches(table(spark, d, "posts").select("post_row", "filename"), ["filename", "post_row"], 1)
    ranked = numbers.select("post_row", (F.col("batch_id") + 1).alias("rank")).join(
        table(spark, d, "posts").select("post_row", "author_uid", "title", "body"),
        "post_row",
    )
    return sinks.staged_documents(ranked, "author_uid", "rank", "post_row")


# Reports

_ISSUES = CORPUS_SQL["integrity_issues"]
_INTEGRITY = f"SELECT count(*) AS total_files, count(*) FILTER (issue IS NULL) AS valid_count, count(issue) AS corrupted_count, count(*) FILTER (issue IS NULL) * 100.0::DOUBLE / count(*) AS integrity_percent, CASE WHEN count(issue) = 0 THEN 'ok' ELSE 'corrupted' END AS status FROM ({_ISSUES})"


@query(_INTEGRITY)
def integrity_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.integrity_counts(integrity_issues(spark, d), "issue")


_ADVICE = """list_filter([CASE WHEN n_missing > 0 THEN 'missing: ' || n_missing END, CASE WHEN n_extra > 0 THEN 'not listed: ' || n_extra END, CASE WHEN n_missing > 0 AND completeness_percent < 99 THEN 'completeness: ' || printf('%.1f', completeness_percent) || '%' END,
CASE WHEN short_content_count > 0 THEN 'short: ' || short_content_count END, CASE WHEN missing_title_count > 0 THEN 'untitled: ' || missing_title_count END, CASE WHEN corrupted_count > 0 THEN 'corrupted: ' || corrupted_count END], lambda x: x IS NOT NULL)"""


@query(
    f"""WITH q AS ({CORPUS_SQL['reconcile_report']}), c AS ({CORPUS_SQL['quality_counts']}), i AS ({_INTEGRITY})
SELECT q.n_missing, q.n_extra, c.valid_count AS content_valid, i.valid_count AS intact, CASE WHEN q.status = 'ok' AND c.status = 'ok' AND i.status = 'ok' THEN 'ok' ELSE 'issues_found' END AS overall_status,
CASE WHEN len({_ADVICE}) > 0 THEN {_ADVICE} ELSE ['all checks passed'] END AS recommendations FROM q, c, i"""
)
def integrity_report(spark: SparkSession, d: str) -> DataFrame:
    """Quantity, content and files of a collection in one report, with its overall status and what to do."""
    report = quality.full_report(reconcile_report(spark, d), quality.counts_of(quality_title_first(spark, d), "label", _LABELS), integrity_counts(spark, d))
    return report.select(
        "quantity.n_missing",
        "quantity.n_extra",
        F.col("content_quality.valid_count").alias("content_valid"),
        F.col("file_integrity.valid_count").alias("intact"),
        "overall_status",
        "recommendations",
    )


_COUNTED = "SELECT item, count(*) AS n, min((post_row, pos)) AS f FROM (SELECT post_row, unnest(tags) AS item, generate_subscripts(tags, 1) AS pos FROM posts) WHERE item IS NOT NULL GROUP BY 1"


@query(f"""WITH c AS ({_COUNTED}), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, f) AS k FROM c)
SELECT (SELECT count(*) FROM c) AS total_tags, list(item ORDER BY k) FILTER (k <= 20) AS top_items, list(n
  ORDER BY k) FILTER (k <= 20) AS top_counts, CAST(sum(n) FILTER (k <= 50) AS BIGINT) AS map_uses,
  CAST(count(*) FILTER (k <= 50) AS INTEGER) AS map_size FROM r""")
def tag_maps(spark: SparkSession, d: str) -> DataFrame:
    maps = stats.tag_maps(stats.list_counts(table(spark, d, "posts"), "tags", ["post_row"]))
    uses = F.aggregate(F.map_values("tags_distribution"), F.lit(0).cast("bigint"), lambda a, n: a + n)
    return maps.select(
        "total_tags",
        F.transform("top_tags", lambda t: t["item"]).alias("top_items"),
        F.transform("top_tags", lambda t: t["n"]).alias("top_counts"),
        uses.alias("map_uses"),
        F.size("tags_distribution").alias("map_size"),
    )


@query(
    "SELECT month, n, row_number() OVER (ORDER BY month) AS place FROM (SELECT substr(published_date, 1, 7) AS month, count(*) AS n FROM post_index WHERE published_date <> '' GROUP BY 1 ORDER BY 1 DESC LIMIT 12)"
)
def last_months(spark: SparkSession, d: str) -> DataFrame:
    """The last twelve months in order; the place is that in the result."""
    months = stats.last_in_order(stats.by_prefix(table(spark, d, "post_index"), "published_date", 7, "month"), "month", 12)
    return months.select("month", "n", (F.monotonically_increasing_id() + 1).alias("place"))


@query(
    "SELECT p.post_row FROM posts p WHERE title IS NOT NULL AND NOT EXISTS (SELECT 1 FROM post_index i WHERE substr(i.title, 1, 60) = substr(p.title, 1, 60))"
)
def posts_not_compiled(spark: SparkSession, d: str) -> DataFrame:
    """Posts of whose titles' first 60 characters no entry is made."""
    start = F.substring("title", 1, 60).alias("start")
    posts = table(spark, d, "posts").where(F.col("title").isNotNull()).select("post_row", start)
    return reconcile.missing(posts, table(spark, d, "post_index").select(start), "start").select("post_row")


@query(
    "SELECT i.index_row, p.body FROM post_index i JOIN (SELECT id, body FROM posts QUALIFY row_number() OVER (PARTITION BY id ORDER BY post_row) = 1) p USING (id)"
)
def staged_texts(spark: SparkSession, d: str) -> DataFrame:
    """Entries with the text of their post; those without a post are dropped."""
    posts = reconcile.keep_first(table(spark, d, "posts").select("post_row", "id", "body"), ["id"], ["post_row"])
    return table(spark, d, "post_index").select("index_row", "id").join(posts.select("id", "body"), "id").select("index_row", "body")


@query("""WITH f AS (SELECT index_row, source_url FROM post_index WHERE index_row % 2 = 1 AND source_url IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY index_row) = 1)
SELECT index_row AS row_id, source_url FROM post_index WHERE index_row % 2 = 0 UNION ALL SELECT *
  FROM f WHERE NOT EXISTS (SELECT 1 FROM post_index k WHERE k.index_row % 2 = 0 AND k.source_url = f.source_url)""")
def failed_once(spark: SparkSession, d: str) -> DataFrame:
    """Known failures, and the first new one of each address."""
    index = table(spark, d, "post_index").select(F.col("index_row").alias("row_id"), "source_url")
    return reconcile.failed_once(index.where(F.col("row_id") % 2 == 0), index.where(F.col("row_id") % 2 == 1), "source_url", ["row_id"])


_HOLES = """WITH numbered AS (SELECT author_uid, 1 + (row_number() OVER (PARTITION BY author_uid ORDER BY index_row) - 1) // 5 AS page, images_count
  FROM post_index WHERE author_uid IS NOT NULL),
shown AS (SELECT author_uid, page FROM numbered WHERE images_count >= 3 GROUP BY 1, 2),
gaps AS (SELECT *, page - lag(page, 1, 0) OVER (PARTITION BY author_uid ORDER BY page) > 3 AS beyond FROM shown),
seen AS (SELECT *, bool_or(beyond) OVER (PARTITION BY author_uid ORDER BY page) AS lost FROM gaps)
SELECT author_uid, max(page) AS last_page FROM seen WHERE NOT lost GROUP BY 1"""


@query(_HOLES)
def stop_pages_with_holes(spark: SparkSession, d: str) -> DataFrame:
    """Pages of five entries that show only those with three images: many are empty, and a reader gives up after three."""
    index = table(spark, d, "post_index").where(F.col("author_uid").isNotNull()).select("author_uid", "index_row", "images_count")
    rows = batching.batches(index, ["index_row"], 5, within="author_uid")
    shown = rows.groupBy("author_uid", (F.col("batch_id") + 1).alias("page")).agg(F.count_if(F.col("images_count") >= 3).alias("n"))
    return reconcile.stop_page(shown, ["author_uid"])


# Replies


@query(
    f"SELECT post_row, trim(regexp_replace(coalesce(title, ''), '{_WS}+', ' ', 'g')) AS title, 'about ' || trim(regexp_replace(coalesce(title, ''), '{_WS}+', ' ', 'g')) AS summary FROM posts WHERE trim(regexp_replace(coalesce(title, ''), '{_WS}+', ' ', 'g')) <> ''"
)
def reply_sections(spark: SparkSession, d: str) -> DataFrame:
    """Replies that are no JSON: sections between lines of ``---``, of equal titles the first."""
    title = text.collapse(F.coalesce("title", F.lit("")))
    posts = table(spark, d, "posts").select("post_row", title.alias("t")).where(F.col("t") != "")
    reply = F.concat(F.lit("---\n# "), "t", F.lit("\nsome text\n---\n## "), F.regexp_replace("t", " ", ""), F.lit("\nagain\n---\nno title here"))
    return posts.select("post_row", F.explode(batching.entries(reply)).alias("e")).select("post_row", "e.title", "e.summary")


@query(f"""WITH b AS (SELECT post_row, title, (row_number() OVER (ORDER BY filename, post_row) - 1) // 10 AS batch_id,
  CAST((row_number() OVER (ORDER BY filename, post_row) - 1) % 10 + 1 AS INTEGER) AS idx FROM posts),
n AS (SELECT *, regexp_replace(title, '\\s+', '', 'g') AS t FROM b), e AS (SELECT batch_id, idx AS pos,
  substr(title, 1, 12) AS title, regexp_replace(substr(title, 1, 12), '\\s+', '', 'g') AS t FROM b
  WHERE title IS NOT NULL)
SELECT e.batch_id, e.pos, (SELECT min(n.idx) FROM n WHERE n.batch_id = e.batch_id AND n.t <> '' AND (contains(e.t, n.t) OR contains(n.t, e.t))) AS idx FROM e""")
def matched_titles(spark: SparkSession, d: str) -> DataFrame:
    """Entries with the number of the first record of their batch whose title holds theirs or is held by it."""
    numbers = batching.batches(table(spark, d, "posts").select("post_row", "filename"), ["filename", "post_row"], 10)
    batch = numbers.join(table(spark, d, "posts").select("post_row", "title"), "post_row")
    rows = batch.where(F.col("title").isNotNull()).select("batch_id", F.col("idx").alias("pos"), F.substring("title", 1, 12).alias("title"))
    return batching.match_titles(rows, batch).select("batch_id", "pos", "idx")


@query(
    "SELECT post_row, coalesce(title, '') || chr(10) || coalesce(body, '') AS joined, coalesce(title, '') AS first, CASE WHEN " + _strip(
        "coalesce(title, '')"
    ) + " <> '' THEN " + _strip("coalesce(title, '')") + " ELSE " + _strip("coalesce(body, '')") + " END AS filled FROM posts"
)
def reply_texts(spark: SparkSession, d: str) -> DataFrame:
    none = lambda c: F.coalesce(F.col(c), F.lit(""))
    block = lambda kind, c: F.struct(F.lit(kind).alias("type"), c.alias("text"))
    reply = F.to_json(F.struct(F.array(block("thinking", F.lit("hm")), block("text", none("title")), block("text", none("body"))).alias("content")))
    return table(spark, d, "posts").select(
        "post_row",
        *(batching.reply_text(reply, w).alias(n) for w, n in (("all", "joined"), ("first", "first"), ("filled", "filled"))),
    )


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(length(text) AS VARCHAR) AS reply FROM documents")
def record_replies(spark: SparkSession, d: str) -> DataFrame:
    """A function of one text at a time, four calls at once."""
    return batching.map_records(table(spark, d, "documents"), lambda t: str(len(t)), "doc_id", "text", at_once=4)


# Texts with links


@query(
    f"SELECT post_row, regexp_replace(b, '{_WS}+$', '') || chr(10) || chr(10) || '## See also' || chr(10) || chr(10) || '- [x](x.md)' || chr(10) AS content FROM (SELECT post_row, coalesce(body, '') AS b FROM posts) WHERE NOT contains(b, '## See also')"
)
def see_also(spark: SparkSession, d: str) -> DataFrame:
    """A section that is there is replaced."""
    body = F.concat(F.coalesce("body", F.lit("")), F.lit("\n\n## See also\n\nold"))
    return table(spark, d, "posts").where(~F.coalesce(F.col("body").contains("## See also"), F.lit(False))).select(
        "post_row",
        frontmatter.with_section(body, "## See also", F.lit("- [x](x.md)")).alias("content"),
    )


@query("SELECT post_row, '均线' AS concept, 'trend.md' AS doc, 1::BIGINT AS rank FROM posts WHERE contains(body, '均线') AND NOT contains(body, '仓位')")
def unlinked_concepts(spark: SparkSession, d: str) -> DataFrame:
    """Links only for texts without the marker of links made before."""
    return graph.concept_links(table(spark, d, "posts"), "post_row", "body", [(["均线"], "trend.md")], marker="仓位")


# Streams


@query("SELECT source_url, 1::BIGINT AS n FROM posts GROUP BY 1")
def stream_merge_by_target(spark: SparkSession, d: str) -> DataFrame:
    """Every address once, over two runs that both bring all posts."""
    at = new_path(spark)
    posts = table(spark, d, "posts").select("post_row", "id", "source_url")
    for run in ("a", "b"):
        posts.write.mode("append").parquet(f"{at}/in")
        ingest.merge_by_target(
            ingest.new_files(spark, f"{at}/in", posts.schema, files_per_batch=1),
            "source_url",
            f"{at}/out",
            f"{at}/state",
        ).awaitTermination()
    return spark.read.parquet(f"{at}/out").groupBy("source_url").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT result_id, coalesce(concepts, []) AS concepts FROM analysis_results")
def saved_results(spark: SparkSession, d: str) -> DataFrame:
    at = new_path(spark)
    results = table(spark, d, "analysis_results").select("result_id", F.coalesce("concepts", F.array().cast("array<string>")).alias("concepts"))
    results.repartition(3, "result_id").write.parquet(f"{at}/in")
    ingest.save_results(ingest.new_files(spark, f"{at}/in", results.schema, files_per_batch=1), f"{at}/out", f"{at}/state").awaitTermination()
    return spark.read.schema("result_id bigint, concepts array<string>").json(f"{at}/out/batch=*")


@query("SELECT count(*) FILTER (title IS NOT NULL) AS n_good, count(*) FILTER (title IS NULL) AS n_bad FROM posts")
def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """Micro-batches with their broken rows apart; files are read in no fixed order."""
    at = new_path(spark)
    posts = table(spark, d, "posts").select("post_row", "title")
    posts.repartition(3, "post_row").write.parquet(f"{at}/in")
    write = lambda kind: lambda df, n: df.write.mode("overwrite").parquet(f"{at}/{kind}/n={n}")
    ingest.each_batch(
        ingest.new_files(spark, f"{at}/in", posts.schema, files_per_batch=1),
        f"{at}/state",
        write("good"),
        write("bad"),
        F.col("title").isNull(),
    ).awaitTermination()
    count = lambda kind: spark.read.parquet(f"{at}/{kind}").agg(F.count(F.lit(1)).alias(f"n_{kind}"))
    return count("good").join(count("bad"))  # one row each


@query("SELECT count(*) AS n_nodes, 0::BIGINT AS n_links FROM bloggers")
def graph_files(spark: SparkSession, d: str) -> DataFrame:
    """Nodes and links written as JSON lines and read back."""
    at = new_path(spark)
    nodes = table(spark, d, "bloggers").select(F.coalesce("uid", F.lit("")).alias("id"), F.lit("author").alias("type"))
    sinks.write_graph(nodes, nodes.limit(0).select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit("wrote").alias("relation")), at)
    count = lambda part, name: spark.read.schema("id string").json(f"{at}/{part}").agg(F.count(F.lit(1)).alias(name))
    return count("nodes", "n_nodes").join(count("links", "n_links"))  # one row each
