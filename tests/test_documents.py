import json
import sys
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from inkfold.sinks import documents as sinks
from inkfold.sources import documents, markdown

POST = "id string, author_uid string, author_name string, published_at string, fetched_at string, type string, category string, tags array<string>, source_url string, likes bigint, comments bigint, images_count bigint, images array<string>, title string, body string"


def test_posts_there_and_back(spark, tmp_path):
    posts = spark.createDataFrame(
        [
            (
                "test123",
                "1300871220",
                "人",
                "2024-12-21T10:30:00+08:00",
                "2024-12-22T10:30:00",
                "article",
                None,
                ["股票", "分析"],
                "http://h/s/blog_1.html",
                1,
                2,
                1,
                ["img1.jpg"],
                "测试文章",
                "正文内容\n---\nrest",
            ),
            ("x", None, None, None, None, None, None, None, "", 0, 0, None, None, None, None),
        ],
        POST,
    )
    sinks.write_files(sinks.post_documents(posts), str(tmp_path / "posts"))
    (tmp_path / "posts" / "index.md").write_text("skipped")
    (tmp_path / "posts" / "bad.md").write_bytes(b"no fences \xff here")
    found = markdown.files(spark, str(tmp_path / "posts"))
    assert found.count() == 3
    back = {r["id"]: r for r in markdown.articles(found).collect()}
    assert set(back) == {"test123", "x"}
    r = back["test123"]
    assert (r["title"], r["published_year"], r["published_month"], r["tags"], r["images_count"]) == ("测试文章", "2024", "2024-12", ["股票", "分析"], 1)
    assert "正文内容" in r["body"] and r["body_length"] == len(r["body"])
    assert back["x"]["tags"] == [] and back["x"]["images_count"] is None
    assert markdown.first_files(found, 1).collect()[0]["file_name"] == min(x["file_name"] for x in found.collect())
    assert markdown.by_keywords(found, ["bad", "none"]).count() == 1
    assert {x["id"] for x in markdown.stored_ids(found).collect()} >= {"bad"}
    assert markdown.files(spark, str(tmp_path / "posts"), prefix="bad").count() == 1


def test_indexes(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"total": 1, "posts": [{"id": "p1", "title": "t", "tags": ["x"], "images_count": 2}]}))
    (tmp_path / "b.json").write_text(json.dumps({"articles": [{"id": "p2"}]}))
    (tmp_path / "c.json").write_text("{broken")
    assert {r["id"] for r in documents.index_rows(spark, str(tmp_path)).collect()} == {"p1", "p2"}
    assert documents.bad_indexes(spark, str(tmp_path)).count() == 1
    index = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("v", 3, None)], "author_uid string, i int, id string")
    made = defaultdict(list)
    for r in sinks.index_lines(index, "author_uid", ["i"]).orderBy("line_no").collect():
        made[r["author_uid"]].append(r["line"])
    assert json.loads("\n".join(made["u"])) == {
        "total": 2,
        "posts": [{"i": 1, "id": "a"}, {"i": 2, "id": "b"}],
    } and json.loads("".join(made["v"]))["total"] == 1
    assert sinks.index_lines(index.limit(0), "author_uid", ["i"]).count() == 0
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "map.json").write_text('{"k": ["a", "b"]}')
    assert [tuple(r) for r in documents.json_map(spark, str(tmp_path / "m")).collect()] == [("k", ["a", "b"])]
    (tmp_path / "l.json").write_text('[{"filename": "a.md"}, {"filename": "b.md", "title": "t"}]')
    assert documents.json_array(spark, str(tmp_path / "l.json"), "filename string, title string").count() == 2


def test_settings_and_lines(spark, tmp_path):
    (tmp_path / "s.yaml").write_text("# c\nbloggers:\n  - name: \"A\"\n    uid: '12'\n    filters:\n      min: 1\n  - uid: 13 # x\nstorage:\n  - name: no\n")
    assert [tuple(r) for r in documents.settings(spark, str(tmp_path / "s.yaml")).collect()] == [("A", "12"), (None, "13")]
    (tmp_path / "u.txt").write_text("http://a\n\n  \nhttp://b \n")
    assert [r[0] for r in documents.lines(spark, str(tmp_path / "u.txt")).collect()] == ["http://a", "http://b"]
    (tmp_path / "ids.txt").write_text("1\n2\n3\n")
    (tmp_path / "titles.txt").write_text("a\n\n")
    pairs = documents.zipped(*(documents.numbered_lines(spark, str(tmp_path / f)) for f in ("ids.txt", "titles.txt")))
    assert sorted(tuple(r) for r in pairs.collect()) == [(0, "1", "a"), (1, "2", "2"), (2, "3", "3")]
    with pytest.MonkeyPatch.context() as m:
        m.setitem(sys.modules, "yaml", None)
        assert [tuple(r) for r in documents.settings(spark, str(tmp_path / "s.yaml")).collect()] == [("A", "12"), (None, "13")]
    assert [tuple(r) for r in documents.settings(spark, str(tmp_path / "s.yaml"), "storage", keys=("name", "none")).collect()] == [("no", None)]
    own = documents.settings(spark, str(tmp_path / "s.yaml"))
    assert documents.chosen(own, "13").count() == 1 and documents.chosen(own, None).count() == 2
    assert documents.checkpoint(str(tmp_path / "none.json")) == {"lastPage": 0, "lastArticleIndex": -1, "downloaded": 0, "failedUrls": []}
    (tmp_path / "cp.json").write_text('{"lastPage": 4}')
    assert documents.checkpoint(str(tmp_path / "cp.json"))["lastPage"] == 4


def test_session_graph_report(spark, tmp_path):
    s = sinks.Session("1", 3)
    s.add(downloaded=2, pages=1)
    s.fail("u", "e")
    s.fail("u", "again")
    s.complete()
    s.save(str(tmp_path / "s.json"))
    state = json.loads((tmp_path / "s.json").read_text())
    assert (state["total_failed"], state["status"], state["total_downloaded"]) == (1, "completed_with_errors", 2)
    nodes, edges = spark.createDataFrame([("a", "post")], "id string, type string"), spark.createDataFrame(
        [("a", "b", "wrote")],
        "src string, dst string, relation string",
    )
    sinks.write_graph(nodes, edges, str(tmp_path / "g"))
    assert spark.read.json(str(tmp_path / "g" / "links")).select("source", "target").collect()[0][:] == ("a", "b")
    sinks.write_report(nodes.agg(F.count(F.lit(1)).alias("n")), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).collect()[0]["n"] == 1
    sinks.write_index(spark.createDataFrame([("u", "a")], "author_uid string, id string"), "author_uid", str(tmp_path / "i"))
    assert spark.read.json(str(tmp_path / "i")).count() == 1


def test_other_documents(spark):
    posts = spark.createDataFrame(
        [("1", "u", None, "", "2020", "//h/1", "# A / B", "# old\nbody", 7), (None, None, None, None, None, None, None, None, None)],
        "id string, author_uid string, author_name string, published_at string, fetched_at string, source_url string, title string, body string, rank int",
    )
    short = sinks.short_documents(posts, "id").orderBy("id").collect()[1]
    assert short["file_name"] == "1___A___B.md" and "author_name: \npublished_at: unknown\nfetched_at: 2020\nsource_url: //h/1\n---" in short["content"]
    staged = sinks.staged_documents(posts.where("id = '1'"), "author_uid", "rank").collect()[0]
    assert tuple(staged) == ("u_a-b_0007.md", "# # A / B\n\nold\nbody")
    bloggers = spark.createDataFrame(
        [("1", None, None, None, None), (None, "n", 3, ("d", None), "c")],
        "uid string, name string, total_articles bigint, profile struct<description: string, category: string>, created_at string",
    )
    made = [json.loads(r["content"]) for r in sinks.blogger_documents(bloggers, "h.example").orderBy("uid").collect()]
    assert made[1] == {
        "uid": "1",
        "name": "",
        "domain": "https://h.example/u/1",
        "total_articles": 0,
        "profile": {"description": "", "category": ""},
        "created_at": "",
    }
    assert made[0]["profile"] == {"description": "d", "category": ""}


def test_pages_from_a_function(spark):
    from inkfold.sources.pages import read_pages

    fetch = lambda n: {7: "", 8: None, 9: ""}.get(n, f"<p>{n}</p>") if n <= 12 else None
    got = read_pages(spark, fetch, 30, pages_per_task=5)
    assert sorted((r["page"], r["html"]) for r in got.collect()) == [(n, fetch(n)) for n in range(1, 13) if n != 8]
    assert sorted(r["page"] for r in read_pages(spark, fetch, 30, pages_per_task=30, empties=3).collect()) == [1, 2, 3, 4, 5, 6, 7, 9]
    assert read_pages(spark, fetch, 0).count() == 0


def test_ship(spark):
    from inkfold.session import ship

    ship(spark)
    assert any("inkfold.zip" in f for f in spark.sparkContext.listFiles)


def test_files_are_listed_by_tasks_and_only_kept_ones_are_read(spark, tmp_path):
    for name in ("abc_1.md", "abc_2.md", "a+b%20c.md", "_hidden.md", ".abc_0.md"):
        (tmp_path / name).write_text(name)
    (tmp_path / "abc_3.md").symlink_to(tmp_path / "gone")  # can't be read
    found = markdown.files(spark, str(tmp_path))
    assert found.inputFiles() == []  # the driver has no list of them
    assert {r["file_name"] for r in found.select("file_name").collect()} == {"abc_1.md", "abc_2.md", "abc_3.md", "a+b%20c.md"}
    assert [r["content"] for r in markdown.by_keywords(found, ["abc"]).orderBy("file_name").collect()] == ["abc_1.md", "abc_2.md"]
    assert [r["content"] for r in markdown.files(spark, str(tmp_path), prefix="a+").collect()] == ["a+b%20c.md"]


def test_first_files_read_no_others(spark, tmp_path):
    for name in "cab":
        (tmp_path / f"{name}.md").write_text(name)
    (tmp_path / "d.md").symlink_to(tmp_path / "gone")  # can't be read
    assert [(r["file_name"], r["content"]) for r in markdown.first_files(markdown.files(spark, str(tmp_path)), 2).collect()] == [("a.md", "a"), ("b.md", "b")]


def test_ids_come_from_names_alone(spark, tmp_path):
    for name in ("1_a.md", "1_b.md", "2_.md", "3.md"):
        (tmp_path / name).symlink_to(tmp_path / "gone")  # can't be read
    ids = markdown.stored_ids(markdown.files(spark, str(tmp_path)))
    assert sorted(r["id"] for r in ids.collect()) == ["1", "2", "3"]
    assert ids.inputFiles() == []  # the driver has no list of them


def test_names_begin_and_end_as_asked(spark, tmp_path):
    for name in ("1_a.md", "1a.md", "a.md", "1_b.md", "2_a.md"):
        (tmp_path / name).symlink_to(tmp_path / "gone")  # can't be read
    found = markdown.files(spark, str(tmp_path), prefix="1", suffix="a.md").select("file_name")
    assert sorted(r["file_name"] for r in found.collect()) == ["1_a.md", "1a.md"]
    assert markdown.files(spark, str(tmp_path), prefix="a.md").select("file_name").count() == 0  # the beginning isn't the end too
    assert found.inputFiles() == []  # the driver has no list of them


def test_articles_are_read_by_tasks_once(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for at in ("a.md", "sub/b+c.md"):
        (tmp_path / at).write_text("---\nid: 1\n---\n# T\n")
    read = markdown.articles(markdown.files(spark, str(tmp_path), recursive=True))
    assert sorted((r["filename"], r["title"]) for r in read.collect()) == [("a.md", "T"), ("b+c.md", "T")]
    assert read.inputFiles() == []  # the driver has no list of them
    assert read._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1  # each file is opened once


def test_local_files_are_released_without_a_list_of_them(tmp_path, monkeypatch):
    from inkfold import session

    (tmp_path / "run" / "sub").mkdir(parents=True)
    (tmp_path / "kept").mkdir()
    (tmp_path / "kept" / "x.md").write_text("x")
    (tmp_path / "run" / "away").symlink_to(tmp_path / "kept")
    for at in ("a b%20+.md", "sub/b.md", ".b.md.crc"):
        (tmp_path / "run" / at).write_text("")
    left = []
    remove = session.shutil.rmtree
    monkeypatch.setattr(session.shutil, "rmtree", lambda at: (left.extend(session.os.listdir(at)), remove(at)))
    session.release(None, f"file://{tmp_path}/run")  # the driver's JVM, which would list all names, isn't asked
    assert not (tmp_path / "run").exists() and left == [] and (tmp_path / "kept" / "x.md").exists()
    session.release(None, f"file://{tmp_path}/run")  # what is gone is no error
