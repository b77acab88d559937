import json
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkfold.functions import frontmatter, html, text
from inkfold.functions.terms import normal_term, normal_terms
from inkfold.functions.times import instant, month_of

EDGES = " \t\n\x1c\x85\xa0　"


def column(spark, values, expr, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}").select("i", expr(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


def python_term(t):
    t = unicodedata.normalize("NFKC", t)
    marks = "#\"'“”‘’「」"
    while t and (t[0] in marks or t[0].isspace()):
        t = t[1:]
    while t and (t[-1] in marks or t[-1].isspace()):
        t = t[:-1]
    return t.lower()


def test_terms_as_python_has_them(spark):
    values = ["#ＣＰＩ#", " 股票　", "“白酒周记”", '" 水泥"', "", "  ", "ﬁn①", "ｶﾅ", "x y", "「a」b", None, "'#'", "Ａ　"]
    assert column(spark, values, normal_term) == [None if v is None else python_term(v) for v in values]
    assert column(spark, [["#a", None, "", "A", "b"], None, []], normal_terms, "array<string>") == [["a", "a", "b"], None, []]


def test_times(spark):
    values = [
        "2011-12-30T15:46:27+08:00",
        "2011-12-30 15:46:27",
        "2011-12-30T15:46:27Z",
        "2011-12-31",
        "unknown",
        "",
        None,
        "2011-13-40T00:00:00",
        " 2011-12-30T15:46:27.5 ",
    ]
    seconds = column(spark, values, lambda x: F.unix_micros(instant(x)))
    base = 1325231187000000
    assert seconds[:4] == [base, base, base + 8 * 3600 * 10**6, 1325260800000000]
    assert seconds[4:] == [None, None, None, None, base + 500000]
    assert column(spark, ["2011-12-31T17:00:00Z", None], lambda x: month_of(instant(x))) == ["2012-01", None]


@pytest.mark.parametrize(
    ("value", "wanted"),
    [("[徐小明, 股票, 交易师]", ["徐小明", "股票", "交易师"]), ("", []), ('["tag1", "tag2"]', ['"tag1"', '"tag2"']), ("[]", [""]), ("a, b", []), ("[", [])],
)
def test_tag_literals(spark, value, wanted):
    assert column(spark, [value], text.tag_literal) == [wanted]


def test_tokens(spark):
    values = ["股票 市场 投资 股票 投资 风险 股票", "a bc 中 中文AB文字 ETF the MACD", "", None]
    assert column(spark, values, text.tokens_cased)[:3] == [[w for w in re.findall(r"[一-鿿]+|[a-zA-Z]+", v) if len(w) > 1] for v in values[:3]]
    assert column(spark, values, text.tokens_folded)[:3] == [
        [w for w in re.findall(r"[一-鿿]+", v) if len(w) > 1] + re.findall(r"[a-z]{3,}", v.lower()) for v in values[:3]
    ]
    assert column(spark, values, text.tokens_folded)[3] is None


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.text(alphabet="ab文 \t\n\x1c\x85\xa0 　-_", max_size=12), min_size=1, max_size=40))
def test_white_space_as_python_has_it(spark, values):
    assert column(spark, values, text.strip) == [v.strip() for v in values]
    assert column(spark, values, text.collapse) == [" ".join(v.split()) for v in values]


def test_names(spark):
    assert column(spark, ["Hello, World! ", "缠 中--枢?", "!!!", ""], text.slug) == ["hello-world", "缠-中-枢", "untitled", "untitled"]
    assert column(spark, ["a b/中", "x" * 60], text.safe_title) == ["a_b_中", "x" * 50]
    assert column(spark, ["http://x/s/blog_0a1b2c.html", "http://x/"], text.url_id) == ["0a1b2c", ""]
    assert column(spark, ["//h/a", "/a", "http://h/a"], lambda x: text.absolute_url(x, "h.example")) == ["http://h/a", "http://h.example/a", "http://h/a"]

    def rolling(url):
        h = 0
        for b in range(0, len(url.encode("utf-16-be")), 2):
            h = (h * 31 + int.from_bytes(url.encode("utf-16-be")[b : b + 2])) & 0xFFFFFFFF
        h = h - (1 << 32) if h >= 1 << 31 else h
        return f"{abs(h):x}.md"

    urls = ["http://example.org/a?b=1", "中文😀", "a"]
    assert column(spark, urls, text.rolling_hash_name) == [rolling(u) for u in urls]


def test_repairs(spark):
    assert column(spark, ["a\x00b\tc\x1f\n"], text.without_controls) == ["ab\tc\n"]
    assert column(spark, ['["a"]', "x", "", None], text.json_list) == [["a"], [], [], []]
    assert column(spark, [b"ab\xffc\xc3"], text.valid_utf8, "binary") == ["abc"]
    assert column(spark, ["## a [b](c) d"], text.without_marks) == ["a b d"]
    assert column(spark, ["x\n# Title \ny", "none"], text.first_heading) == ["Title", ""]


def fences(content):
    parts = content.split("---\n")
    if len(parts) < 3:
        return None
    meta = {}
    for line in parts[1].split("\n"):
        if ":" in line:
            k, v = line.split(":", 1)
            meta[k.strip()] = v.strip()
    return meta, "\n".join(parts[2:])


CASES = [
    "---\nid: 1\ntags: [a]\n---\n\n# t\n\nbody",
    "---\nid: 1\nid: 2\nu: a:b\n---\nx\n---\ny---\nz",
    "no front matter",
    "---\nid: 1\n",
    "",
    "---\n---\n",
    "---\nk: \"q\"\n---\n",
]


def test_front_matter(spark):
    got = column(spark, CASES, frontmatter.split_fences)
    assert [(dict(g["meta"]), g["body"]) if g else None for g in got] == [fences(c) for c in CASES]
    assert column(spark, [CASES[6]], lambda x: frontmatter.anchored(x)["meta"]) == [{"k": "q"}]
    assert column(spark, ["plain"], lambda x: frontmatter.limited(x)["body"]) == ["plain"]
    assert column(spark, ["---\ntitle: 'a'\n---\n# b", "# b\nc", "c"], lambda x: frontmatter.title_of(x, F.lit("f.md"))) == ["a", "b", "f"]
    assert column(spark, ["a\n\n## See also\n\nold"], lambda x: frontmatter.with_section(x, "## See also", F.lit("new"))) == ["a\n\n## See also\n\nnew\n"]


def test_lines_of_front_matter_are_cut_once(spark):
    part = spark.range(1).select(frontmatter.split_fences(F.concat(F.lit("---\na: 1\na: 2\nb: 3\n---\n"), F.col("id").cast("string"))).alias("p"))
    assert part._jdf.queryExecution().optimizedPlan().toString().count("instr(") == 1  # not once more within each key
    assert dict(part.first()["p"]["meta"]) == {"a": "2", "b": "3"}


def test_only_line_feeds_end_a_heading(spark):
    import duckdb

    cases = ["# a\x85", "# a\x85\u2028b \r\nc", "x\x85# no", "x\r# no", "#\x0bno", "#\u3000no", "# a\x0b\n", "#\n\nnext\x0c", "# "]
    sql = r"SELECT regexp_extract(?, '(?m)^#\s+(.+?)\s*$', 1)"
    assert column(spark, cases, text.first_heading) == [duckdb.execute(sql, [c]).fetchone()[0] for c in cases]


PAGE = """<html><title> A&nbsp;B </title><body><a href="//h/s/blog_0a.html"><b>First  post</b></a><a href="/s/blog_0a.html">again here</a>
<a href="http://h/s/blog_1b.html">ab</a><a href="javascript:">xxxx</a><script>var $tag='a, b，,c'</script>(2012-01-02 03:04:05)
<h2 id="t" class="titName SG_txta"> A  title </h2><span class="time SG_txtc">(2013-04-05 06:07:08)</span>
<div class="articalContent x">a &lt;b&gt; &amp; c&#39;s<br/> d<img src="http://i/1.jpg"><div>in <div>the</div></div> inner</div>
rest<!-- 正文结束 --></div><div>after</div><img src="http://cdn.example/2.jpg"><a href="list_12.html">12</a> article_3_7.html</body></html>"""


def test_pages(spark):
    got = column(spark, [PAGE, ""], lambda x: html.article(x, F.lit("http://h/s/blog_9z.html")))
    assert got[0].asDict() == {
        "id": "9z",
        "title": "A  title",
        "url": "http://h/s/blog_9z.html",
        "date": "2013-04-05 06:07:08",
        "tags": ["a", "b，", "c"],
        "content": "a <b> &amp; cs din the inner rest",
        "images": ["http://i/1.jpg", "http://cdn.example/2.jpg"],
    }
    assert got[1]["content"] == "" and got[1]["images"] == []
    assert column(spark, ['<div class="articalContent">no end</div>'], html.article_content) == [""]
    assert column(spark, [PAGE], lambda x: html.images(x, without_host="cdn.example")) == [["http://i/1.jpg"]]
    assert column(
        spark,
        [PAGE],
        html.script_tags,
    ) == [["a", "b", "c"]] and column(spark, [PAGE], html.title) == ["A B"] and column(spark, [PAGE], html.stated_time) == ["2012-01-02 03:04:05"]
    links = column(spark, [PAGE], lambda x: html.article_links(x, "h"))[0]
    assert [tuple(x) for x in links] == [("0a", "First post", "http://h/s/blog_0a.html")]
    assert column(spark, [PAGE, ""], html.page_numbers) == [12, 1]
    assert column(spark, [PAGE], lambda x: html.matching_lines(x, "href")) == [3]
    assert column(spark, ['log line\n[{"a": 1}]', "none"], lambda x: html.noisy_json(x, "array<struct<a: int>>"))[1] is None
    assert json.loads(json.dumps([r.asDict() for r in column(spark, ['x [{"a": 1}]'], lambda x: html.noisy_json(x, "array<struct<a: int>>"))[0]])) == [{"a": 1}]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(
            st.floats(0, 1000, allow_nan=False),
            st.integers(0, 20000).map(lambda n: n / 20),
            st.integers(1, 999).map(lambda n: n * 100.0 / 1000),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_round1_as_python_rounds(spark, numbers):
    numbers += [0.35, 0.25, 0.75, 0.45, 2.5, 0.05, 99.95, 0.0]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    assert [r[0] for r in df.select(text.round1(F.col("x"))).collect()] == [round(x, 1) for x in numbers]


def test_titles_and_summaries(spark):
    assert column(
        spark,
        ["## A title #\nrest", "\n\n plain", "#", "", "x" * 200],
        lambda x: text.first_line_title(x, F.lit("f")),
    ) == ["A title #", "plain", "f", "f", "x" * 100]
    entry = ['title: "T"\nsummary: "S"', 'summary: "S"', 'title: "T"', None]
    assert column(spark, entry, lambda x: text.entry_summary(x, F.lit("n.md"))) == ["[T]: S", "[n]: S", None, None]
