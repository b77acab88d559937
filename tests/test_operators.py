import random
import time
from collections import Counter, defaultdict
from pathlib import Path

from pyspark.sql import functions as F

from inkfold.operators import batching, graph, orphans, quality, reconcile, salted, stats
from inkfold.operators.ranks import global_rank, running_before
from inkfold.operators.sampling import hash_sample
from inkfold.streaming.ingest import Progress, merge_by_target, merge_into, new_files, save_results, track_orphans


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# Salted aggregation

POST = "post_row bigint, author_uid string, tags array<string>, published_at string, body string, field_name string, n_rows int"


def test_profiles_of_keys(spark):
    r = random.Random(1)
    posts = []
    for i in range(900):
        tags = r.choice([None, [], ["#A", "a", None, ""], ["a", "b"], ["ｃ"]])
        posts.append(
            (
                i,
                "hot" if i % 3 == 0 else r.choice([None, "", "x", f"u{i % 40}"]),
                tags,
                r.choice(["2012-01-01T00:00:00Z", "2013-05-05 01:02:03", "unknown", None]),
                r.choice([None, "", "abc", "y" * 50_000 if i == 5 else "de"]),
                "clash",
                7,
            )
        )
    want = defaultdict(lambda: [0, 0])
    for _, author, tags, _, body, *_ in posts:
        keys = {("tags", t) for t in ((x or "").replace("#", "").replace("ｃ", "c").lower() for x in tags or []) if t}
        for k in keys | ({("author_uid", author)} if author is not None else set()):
            want[k][0] += 1
            want[k][1] += len(body or "")
    got = salted.post_key_profiles(spark.createDataFrame(posts, POST), heavy_share=0.1, salts=5)
    assert {(x["field_name"], x["key_value"]): [x["n_rows"], x["body_chars"]] for x in got.collect()} == want
    assert got.columns == ["field_name", "key_value", "n_rows", "first_published", "last_published", "body_chars"]


def test_profiles_of_nothing(spark):
    assert salted.post_key_profiles(spark.createDataFrame([], POST)).count() == 0


def test_salts_change_nothing(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 < 2, None).otherwise(F.col("id") % 5).alias("k"))
    measures = [
        salted.Measure("n", "count", F.lit(1)),
        salted.Measure("lo", "min", F.col("id")),
        salted.Measure("hi", "max", F.col("id")),
        salted.Measure("s", "sum", F.col("id")),
    ]
    plain = df.groupBy("k").agg(F.count(F.lit(1)), F.min("id"), F.max("id"), F.sum("id"))
    assert rows(salted.salted_aggregate(df, ["k"], measures, [F.col("id")], heavy_share=0.05, salts=7)) == rows(plain)


# Orphans


def test_reference_keys(spark):
    names = ["a/b/X.md", "posts\\x.MD\n", " x.md", "./x.md", "", " ", None, "dir/"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(orphans.file_key(F.col("n"))).collect()] == ["x.md", "x.md", "x.md", "x.md", "", "", None, "dir"]
    urls = ["HTTP://H.example/S/a.html/?q=1#x", "//h.example/s/a.html", "　https://h.example/s/a.html// ", "h.example/s/a.html#c", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "n string")
    assert [r[0] for r in df.select(orphans.address_key(F.col("n"))).collect()] == ["h.example/s/a.html"] * 4 + ["", None]


STORED, GONE, REFS = "key_kind string, ref_key string, seen_at timestamp", "key_kind string, ref_key string", "table_name string, row_id bigint, field_name string, key_kind string, ref_key string, ref_at timestamp"


def _orphan_data(r):
    from datetime import datetime, timedelta, timezone

    at = lambda: None if r.random() < 0.1 else datetime(2020, 1, 1, tzinfo=timezone.utc) + timedelta(hours=r.randrange(500))
    key = lambda: r.choice(["", None, "hot", "hot", *(f"k{i}" for i in range(30))])
    stored = [("file", key(), at()) for _ in range(40)]
    gone = [("file", key()) for _ in range(20)]
    refs = [(r.choice("tu"), i, "f", "file", key(), at()) for i in range(300)]
    refs += refs[:5]
    return stored, gone, refs


def _kinds(stored, gone, refs):
    out = Counter()
    known = defaultdict(list)
    for _, k, t in stored:
        if k:
            known[k].append(t)
    for table, i, field, _, k, t in refs:
        if not k:
            continue
        if k in known:
            first = None if None in known[k] else min(known[k])
            kind = "late" if first is not None and t is not None and first > t else "ok"
        else:
            kind = "deleted" if ("file", k) in gone else "missing"
        out[(table, i, kind)] += 1
    return out


def test_orphans_in_one_step_and_in_many(spark):
    r = random.Random(3)
    stored, gone, refs = _orphan_data(r)
    make = lambda s, g, f: orphans.Increment(
        spark.createDataFrame(s, STORED),
        spark.createDataFrame(g, GONE),
        None,
        spark.createDataFrame(f, REFS),
    )
    want = _kinds(stored, gone, refs)
    once = orphans.OrphanStore(spark, 3).step(make(stored, gone, refs))
    assert rows(once.references.select("table_name", "row_id", "kind")) == want
    store = orphans.OrphanStore(spark, 7)
    for part in (slice(0, 10), slice(10, 25), slice(25, None)):
        store.step(make(stored[part], gone[part], refs[part.start * 8 : None if part.stop is None else part.stop * 8]))
    assert rows(store.references.select("table_name", "row_id", "kind")) == want
    assert sum(x["n_refs"] for x in store.snapshot().collect()) == sum(n for (_, _, k), n in want.items() if k != "ok")


def test_withdrawals_reopen(spark):
    from datetime import datetime

    store = orphans.OrphanStore(spark)
    refs = spark.createDataFrame([("t", 1, "f", "file", "a", None), ("t", 2, "f", "file", "b", None)], REFS)
    store.step(orphans.Increment(references=refs))
    kinds = lambda: {x["row_id"]: x["kind"] for x in store.references.collect()}
    assert kinds() == {1: "missing", 2: "missing"}
    stored = lambda at: orphans.Increment(stored=spark.createDataFrame([("file", "a", at)], STORED))
    gone = lambda at: spark.createDataFrame([("file", "a", at)], GONE + ", gone_at timestamp")
    store.step(stored(None))
    assert kinds() == {1: "ok", 2: "missing"}
    store.step(orphans.Increment(withdrawn=gone(None)))
    assert kinds() == {1: "deleted", 2: "missing"}
    store.step(stored(datetime(2020, 5, 1)))
    assert kinds() == {1: "ok", 2: "missing"}
    both = stored(datetime(2020, 7, 1))._replace(withdrawn=gone(datetime(2020, 6, 1)))
    assert {x["first_seen"] for x in store.step(both).parents.where("ref_key = 'a'").collect()} == {datetime(2020, 7, 1)} and kinds()[1] == "ok"
    store.step(both._replace(withdrawn=gone(datetime(2020, 8, 1))))
    assert kinds() == {1: "deleted", 2: "missing"}


def test_untouched_buckets_are_not_rewritten(spark):
    store = orphans.OrphanStore(spark, 16)
    key = lambda i: f"k{i}"
    store.step(orphans.Increment(references=spark.createDataFrame([("t", i, "f", "file", key(i), None) for i in range(200)], REFS)), 1)
    before = {t: dict(f) for t, f in store.folders.items()}
    assert len(before["references"]) == 16 and not before["parents"]
    step = orphans.Increment(stored=spark.createDataFrame([("file", key(7), None)], STORED))
    store.step(step, 2)
    changed = [b for b, path in store.folders["references"].items() if before["references"].get(b) != path]
    assert len(changed) == 1 and list(store.folders["parents"]) == changed
    assert not Path(before["references"][changed[0]].removeprefix("file://")).exists()
    after = {t: dict(f) for t, f in store.folders.items()}
    assert store.step(step, 2).folders == after
    assert rows(store.references.groupBy("kind").count()) == {("missing", 199): 1, ("ok", 1): 1}


def test_periods(spark):
    r = random.Random(4)
    stored, gone, refs = _orphan_data(r)
    whole = orphans.Increment(
        spark.createDataFrame(stored, STORED),
        spark.createDataFrame([(*g, None) for g in gone], GONE + ", removed_at timestamp"),
        None,
        spark.createDataFrame(refs, REFS),
    )
    steps = orphans.in_periods(whole, 4)
    assert sum(s.references.count() for s in steps) == sum(1 for x in refs if x[4]) and all(s.references.count() for s in steps)
    store = orphans.OrphanStore(spark, 5)
    for step in steps:
        store.step(step)
    assert rows(store.references.select("table_name", "row_id", "kind")) == _kinds(stored, gone, refs)


def test_orphans_of_nothing(spark):
    posts = spark.createDataFrame([], "post_row bigint, filename string, source_url string, fetched_at string, kind string")
    gone = spark.createDataFrame([], "filename string, source_url string, removed_at string")
    index = spark.createDataFrame([], "index_row bigint, filename string, source_url string, indexed_at string")
    results = spark.createDataFrame([(1, None, None), (2, "x.md", "2012-01-01T00:00:00Z")], "result_id bigint, _source_file string, analyzed_at string")
    for cut in (lambda x: [x], lambda x: orphans.in_periods(x, 3)):
        store = orphans.OrphanStore(spark)
        for step in cut(orphans.post_increment(posts, gone, index, results)):
            store.step(step)
        assert rows(store.references.select("row_id", "kind")) == {(2, "missing"): 1}
        assert [tuple(r) for r in store.snapshot().collect()] == [("analysis_results", "_source_file", "2012-01", "missing", 1)]
    nothing = orphans.OrphanStore(spark).step(orphans.Increment())
    assert nothing.references.count() == 0 and nothing.snapshot().count() == 0


def test_orphans_of_a_stream(spark, tmp_path):
    refs = [("t", i, "f", "file", f"k{i % 3}", None) for i in range(9)]
    spark.createDataFrame(refs, REFS).repartition(3, "row_id").write.parquet(str(tmp_path / "in"))
    store = orphans.OrphanStore(spark, 4)
    store.step(orphans.Increment(stored=spark.createDataFrame([("file", "k1", None)], STORED)))
    for _ in range(2):
        stream = new_files(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files_per_batch=1)
        track_orphans(stream, store, str(tmp_path / "state"), lambda batch: orphans.Increment(references=batch)).awaitTermination()
    assert rows(store.references.groupBy("kind").count()) == {("missing", 6): 1, ("ok", 3): 1}


# Ranks, samples


def test_ranks(spark):
    df = spark.range(997).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("a"), "id")
    got = sorted((r["n"], r["a"], r["id"]) for r in global_rank(df, ["a", "id"], "n").collect())
    assert [g[0] for g in got] == list(range(997)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
    assert global_rank(df.limit(0), ["a"], "n").count() == 0


def test_samples(spark):
    df = spark.range(5000).select("id", F.lit("four").alias("text"))
    one, two = (sorted(r[0] for r in hash_sample(df.repartition(n), "text", 100, 10**9, 5000).collect()) for n in (1, 7))
    assert one == two and len(one) == 100
    assert {r[0] for r in hash_sample(df, "text", 100, 83, 5000).collect()} < set(one)
    assert [hash_sample(df, "text", 100, c, 5000).count() for c in (83, 4, 3)] == [20, 1, 0]
    assert hash_sample(df.limit(3).union(df.limit(3)), "text", 100, 10**9, 6).count() == 3
    assert hash_sample(df.limit(0), "text", 100, 10**9, 0).count() == 0


def test_shared_folder(spark):
    from inkfold.session import durable, release, run_dir

    at = run_dir(spark).removeprefix("file://")
    durable(spark.range(3))
    assert any(Path(at).iterdir())
    release(spark)
    assert not Path(at).exists()


def test_running_sums_as_brute_force_has_them(spark):
    r = random.Random(12)
    data = [(i, r.choice(["hot", "hot", "hot", "a", "b", None]), r.choice([None, 0, 1, 5])) for i in range(700)]
    df = spark.createDataFrame(data, "i int, k string, v int").repartition(5).withColumn("n", F.lit("clash"))
    seen, want = defaultdict(int), {}
    for i, k, v in data:
        want[i] = seen[k]
        seen[k] += v or 0
    assert {x["i"]: x["before"] for x in running_before(df, ["k"], ["i"], F.col("v"), "before").collect()} == want
    assert running_before(df.limit(0), ["k"], ["i"], F.col("v"), "before").count() == 0


def test_numbers_within_a_value(spark):
    df = spark.createDataFrame([(i, "x" if i % 3 else None) for i in range(40)], "i int, k string")
    got = batching.batches(df, ["i"], 10, within="k")
    assert rows(got.groupBy("k", "batch_id").count()) == {("x", 0, 10): 1, ("x", 1, 10): 1, ("x", 2, 6): 1, (None, 0, 10): 1, (None, 1, 4): 1}
    names = batching.numbered_names(df, "k", ["i"], pattern="%s_%04d").where("k = 'x'").orderBy("i").collect()
    assert [n["file_name"] for n in names[:3]] == ["x.md", "x_0001.md", "x_0002.md"]


# Reports


def test_tag_maps_and_last_months(spark):
    counts = spark.createDataFrame([("a", 3, 9), ("b", 3, 2), ("c", 1, 1)], "item string, n bigint, first_at int")
    one = stats.tag_maps(counts, top=2, most=3).collect()[0]
    assert (one["total_tags"], [tuple(t) for t in one["top_tags"]], one["tags_distribution"]) == (3, [("b", 3), ("a", 3)], {"a": 3, "b": 3, "c": 1})
    months = spark.createDataFrame([(f"2020-{m:02}", m) for m in range(1, 8)], "month string, n int")
    assert [x["month"] for x in stats.last_in_order(months, "month", 3).collect()] == ["2020-05", "2020-06", "2020-07"]


def test_whole_report(spark):
    listed, stored = spark.createDataFrame([("a",), ("b",)], "u string"), spark.createDataFrame([("a",), ("c",)], "u string")
    labels = ("valid", "short_content", "missing_title")
    content = lambda *x: quality.counts_of(spark.createDataFrame([(v,) for v in x], "label string"), "label", labels)
    files = lambda *x: quality.integrity_counts(spark.createDataFrame([(v,) for v in x], "issue string"), "issue")
    bad = quality.full_report(reconcile.reconcile(listed, stored, "u"), content("valid", "short_content"), files(None, "tags")).collect()[0]
    assert bad["overall_status"] == "issues_found" and bad["recommendations"] == [
        "missing: 1",
        "not listed: 1",
        "completeness: 50.0%",
        "short: 1",
        "corrupted: 1",
    ]
    assert (bad["quantity"]["missing"], bad["quantity"]["extra"]) == (["b"], ["c"])
    good = quality.full_report(reconcile.reconcile(listed, listed, "u"), content("valid"), files(None)).collect()[0]
    assert good["overall_status"] == "ok" and good["recommendations"] == ["all checks passed"]
    assert files().collect()[0]["integrity_percent"] == 0


# Reconciliation


def test_keep_first_and_merge(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, None, "w"), (5, "b", None)], "i int, k string, v string")
    assert rows(reconcile.keep_first(df, ["k"], ["i"])) == {(1, "a", "x"): 1, (3, None, "z"): 1, (5, "b", None): 1}
    known = spark.createDataFrame([(9, "a", "old")], "i int, k string, v string")
    assert rows(reconcile.merge_new(known, df, "k", ["i"])) == {(9, "a", "old"): 1, (5, "b", None): 1}


def test_reconcile(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "u string")
    stored = spark.createDataFrame([("b",), ("c",)], "u string")
    r = reconcile.reconcile(listed, stored, "u").collect()[0].asDict()
    assert r == {
        "n_listed": 2,
        "n_stored": 2,
        "n_matched": 1,
        "n_missing": 1,
        "n_extra": 1,
        "completeness_percent": 50.0,
        "status": "incomplete",
        "missing": ["a"],
        "extra": ["c"],
    }
    r = reconcile.reconcile(listed.limit(0), stored.limit(0), "u").collect()[0]
    assert r["n_listed"] == 0 and r["completeness_percent"] == 0.0 and r["missing"] == []
    assert reconcile.missing(listed, stored, "u").count() == 2


def test_pages_with_a_hole(spark):
    pages = spark.createDataFrame([("x", p, 50) for p in (1, 2, 3, 7, 12)] + [("y", 5, 1)], "by string, page int, n int")
    assert rows(reconcile.stop_page(pages, ["by"])) == {("x", 3): 1}
    assert rows(reconcile.stop_page(pages, ["by"], empties=4)) == {("x", 7): 1}
    assert tuple(reconcile.estimated_total(pages.where("by = 'x'")).collect()[0]) == (12, 50, 600)


# Quality


def test_ladders_differ(spark):
    df = spark.createDataFrame(
        [("ab", "2012", "x"), ("abc", None, "y" * 200), ("abc", "2012", "待补充" + " " * 120), (None, None, None), ("abcd", "2012", "z" * 100)],
        "t string, d string, b string",
    )
    got = [
        tuple(r) for r in df.select(
            quality.check_first_title(F.col("t"), F.col("d"), F.col("b")),
            quality.check_first_body(F.col("t"), F.col("d"), F.col("b")),
        ).collect()
    ]
    assert got == [
        ("missing_title", "short_content"),
        ("missing_date", "missing_date"),
        ("placeholder", "valid"),
        ("missing_title", "short_content"),
        ("valid", "valid"),
    ]


def test_advice(spark):
    one = spark.range(1)
    say = lambda *x: one.select(quality.advice(*map(F.lit, x))).collect()[0][0]
    assert say(0, 0, 100.0, 0, 0, 0) == ["all checks passed"]
    assert say(2, 1, 90.0, 3, 0, 1) == ["missing: 2", "not listed: 1", "completeness: 90.0%", "short: 3", "corrupted: 1"]
    assert one.select(quality.is_post_file(F.lit("a.md")), quality.is_post_file(F.lit("x.checkpoint.md"))).collect()[0][:] == (True, False)


# Statistics


def test_reports_of_nothing(spark):
    empty = spark.createDataFrame([], "d string, l int, tags array<string>, i int")
    r = stats.date_report(empty, "d", "l").collect()[0]
    assert (r["total"], r["earliest"], r["years"], r["months"]) == (0, None, {}, [])
    assert stats.list_counts(empty, "tags", ["i"], top=3).count() == 0
    assert tuple(quality.length_stats(empty, "l").collect()[0]) == (0, 0, 0)


def test_ties_go_by_first_place(spark):
    df = spark.createDataFrame([(1, ["b", None, "a"]), (2, ["a", "b", ""]), (3, None)], "i int, tags array<string>")
    assert [(r["item"], r["n"]) for r in stats.list_counts(df, "tags", ["i"], top=3).collect()] == [("b", 2), ("a", 2), ("", 1)]


# Graph


def test_graph_as_a_dict_has_it(spark):
    r = random.Random(5)
    posts = [(str(i), i, [r.choice("abc") for _ in range(r.randrange(4))], r.choice(["ann", "bob", None, "", "kw1"])) for i in range(14)]
    words = [(p[0], f"kw{r.randrange(4)}") for p in posts for _ in range(2)]
    edges = {}
    for p, w in words:
        edges[(p, w)] = "contains_keyword"
    by_tag = defaultdict(list)
    for p in posts:
        for t in p[2]:
            by_tag[t].append(p[0])
    for ids in by_tag.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                edges.setdefault((a, b), "shares_tag")
    for a, b in zip(posts, posts[1:]):
        edges[(a[0], b[0])] = "next_post"
    for p in posts:
        if p[3]:
            edges[(p[3], p[0])] = "wrote"
    df = spark.createDataFrame(posts, "post string, at int, tags array<string>, author string")
    kw = spark.createDataFrame(words, "post string, keyword string")
    others = graph.keyword_edges(kw, "post").unionByName(graph.next_edges(df, "post", ["at"])).unionByName(graph.author_edges(df, "post", "author"))
    assert {(e["src"], e["dst"]): e["relation"] for e in graph.collapse(_pair_edges(spark, posts).unionByName(others)).collect()} == edges
    tagged = graph.tag_edges(df, "post", "tags")
    assert {(e["src"], e["dst"]) for e in tagged.collect()} == {(p[0], f"tag:{t}") for p in posts for t in p[2]}
    named = df.select(
        F.col("post").alias("id"),
        F.lit("t").alias("title"),
        "author",
        F.lit(None).cast("string").alias("published_at"),
        F.lit("c").alias("category"),
        "tags",
    )
    nodes = graph.nodes(named, kw.select("keyword"), df.where("author <> ''").select("author"), tagged.select("dst"))
    types = {n["id"]: n["type"] for n in nodes.collect()}
    assert types["kw1"] == "keyword" and types["0"] == "post" and types["ann"] == "author" and types["tag:a"] == "tag"
    assert [(n["title"], n["tags"]) for n in nodes.where("id in ('3', 'ann')").orderBy("id").collect()] == [("t", posts[3][2]), (None, None)]
    assert graph.dangling(graph.collapse(tagged.unionByName(others)), nodes).count() == 0
    assert {r["id"] for r in graph.dangling(tagged, nodes.where("type <> 'tag'")).collect()} == {f"tag:{t}" for t in by_tag}
    assert rows(graph.graph_counts(nodes.limit(0), others.limit(0))) == {}


def _pair_edges(spark, posts):
    """Every link by a tag of posts ``(post, at, tags, ...)`` in order, written out."""
    held = [(p[1], k, p[0], t) for p in posts for k, t in enumerate(p[2] or []) if t is not None]
    pairs = {(a[2], b[2], "shares_tag") for a in held for b in held if a[3] == b[3] and a[:2] < b[:2]}
    return spark.createDataFrame(sorted(pairs), "src string, dst string, relation string")


def test_classes_stand_for_all_links(spark):
    r = random.Random(9)
    posts = [(str(i), i, r.choice([None, [], [r.choice(["hot", "hot", "a", "b", None, ""]) for _ in range(r.randrange(5))]])) for i in range(60)]
    df = spark.createDataFrame(posts, "post string, at int, tags array<string>").withColumn("tag", F.lit("clash"))
    held = [(p[1], k, t) for p in posts for k, t in enumerate(p[2] or []) if t is not None]
    want = {
        t: (
            len({a[0] for a in held if a[2] == t}),
            len({(a[0], b[0]) for a in held for b in held if a[2] == b[2] == t and a[:2] < b[:2]}),
        ) for _, _, t in held
    }
    assert {x["tag"]: (x["n_posts"], x["n_links"]) for x in graph.tag_classes(df, "post", "tags").collect()} == want
    assert graph.tag_classes(df.limit(0), "post", "tags").count() == 0 and graph.tag_edges(df.limit(0), "post", "tags").count() == 0


def test_next_within_a_value(spark):
    r = random.Random(6)
    data = [(str(i), r.choice(["x", "x", "x", "y", None]), r.randrange(9)) for i in range(80)]
    df = spark.createDataFrame(data, "post string, by string, at int")
    want = set()
    for value in ("x", "y", None):
        own = sorted((at, p) for p, by, at in data if by == value)
        want |= {(a[1], b[1]) for a, b in zip(own, own[1:])}
    assert {(e["src"], e["dst"]) for e in graph.next_edges(df, "post", ["at"], within="by").collect()} == want


def test_exact_degrees_as_brute_force_has_them(spark):
    r = random.Random(8)
    posts = [
        (
            str(i),
            i,
            r.choice([None, [], [r.choice(["hot", "hot", None, "a", "b", "c", "d", "e", f"own{i}"]) for _ in range(r.randrange(9))]]),
        ) for i in range(120)
    ]
    df = spark.createDataFrame(posts, "post string, at int, tags array<string>")
    others = spark.createDataFrame(
        [(str(i), str(i + 1), "next_post") for i in range(119)] + [
            ("3", "3", "contains_keyword"),
            ("4", "hot", "contains_keyword"),
            ("ann", "5", "wrote"),
        ],
        "src string, dst string, relation string",
    )
    every = _pair_edges(spark, posts).unionByName(others)
    want = rows(graph.degrees(graph.collapse(every)))
    for most in (12, 2, 0):
        assert rows(graph.exact_degrees(df, "post", "tags", "at", others, subsets_up_to=most).select("id", "n_in", "n_out", "degree")) == want


def test_degrees_with_hot_sets(spark):
    posts = [(str(i), i, ["hot", "other"] if i % 4 else ["hot", "hot"]) for i in range(1500)]
    df = spark.createDataFrame(posts, "post string, at int, tags array<string>")
    none = spark.createDataFrame([("0", "1", "next_post")], "src string, dst string, relation string")
    got = {r["id"]: (r["n_in"], r["n_out"]) for r in graph.exact_degrees(df, "post", "tags", "at", none).collect()}
    assert got == {str(i): (i + (i % 4 == 0), 1499 - i + (i % 4 == 0)) for i in range(1500)}


# Batches


def test_batches(spark):
    df = spark.range(23).select("id", F.lit("t").alias("title"))
    got = batching.batches(df, ["id"], 10)
    assert rows(got.groupBy("batch_id").count()) == {(0, 10): 1, (1, 10): 1, (2, 3): 1}
    assert sorted(r["idx"] for r in got.where("batch_id = 2").collect()) == [1, 2, 3]
    calls = batching.map_batches(got, lambda recs: (_ for _ in ()).throw(ValueError()) if recs[0]["id"] == 10 else str(len(recs)))
    assert rows(calls) == {(0, "10"): 1, (1, None): 1, (2, "3"): 1}


def test_retries_and_calls_at_once(spark, tmp_path):
    def flaky(text):
        mark = tmp_path / text
        if not mark.exists():
            mark.touch()
            raise ValueError
        return text.upper()

    df = spark.createDataFrame([(i, f"t{i}") for i in range(6)] + [(9, None)], "i int, text string")
    start = time.time()
    got = batching.map_records(df, flaky, "i", "text", wait=0.2, at_once=2)
    assert got.rdd.getNumPartitions() == 2
    assert rows(got) == {**{(str(i), f"T{i}"): 1 for i in range(6)}, ("9", None): 1} and time.time() - start > 0.5
    one = batching.map_batches(batching.batches(df.select("i"), ["i"], 3), lambda recs: str(len(recs)), at_once=1)
    assert one.rdd.getNumPartitions() == 1 and rows(one) == {(0, "3"): 1, (1, "3"): 1, (2, "1"): 1}


REPLIES = [
    '```json\nSure: [{"title": "A", "tags": ["x", "", "y", "z", "u", "v", "w"], "related": null, "content": "", "body": "b"}, {"summary": "no title"}]\n```',
    "---\n# One\ntext\n---\n# O ne\nagain\n---\n\n---\n## Two\nx",
    "nothing",
    '[{"broken": ',
    None,
]


def test_replies(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(REPLIES)], "i int, x string")
    got = [r["e"] for r in df.select("i", batching.entries(F.col("x")).alias("e")).orderBy("i").collect()]
    assert got[0][0].asDict() == {"title": "A", "summary": "", "tags": ["x", "y", "z", "u", "v"], "related": [], "body": "b"} and len(got[0]) == 1
    assert [e["title"] for e in got[1]] == ["One", "Two"] and got[1][0]["tags"] == ["unsorted"]
    assert not got[2] and not got[3] and not got[4]
    batch = spark.createDataFrame([(0, 1, "On e"), (0, 2, "Two!")], "batch_id bigint, idx int, title string")
    named = spark.createDataFrame([(0, 0, "One"), (0, 1, "Two"), (0, 2, "Three"), (1, 0, "One")], "batch_id bigint, pos int, title string")
    assert {
        (r["batch_id"], r["title"]): r["idx"] for r in batching.match_titles(named, batch).collect()
    } == {(0, "One"): 1, (0, "Two"): 2, (0, "Three"): None, (1, "One"): None}
    api = spark.createDataFrame([('{"content": [{"type": "text", "text": "a"}, {"type": "x"}, {"type": "text", "text": "b"}]}',), ("x",)], "r string")
    assert [r[0] for r in api.select(batching.reply_text(F.col("r"))).collect()] == ["a\nb", None]


# Streaming


def test_merging_twice_adds_nothing(spark, tmp_path):
    for n in range(2):
        spark.range(50).select((F.col("id") % 20).cast("string").alias("url"), "id").write.mode("append").parquet(str(tmp_path / "in"))
        merge_into(new_files(spark, str(tmp_path / "in"), "url string, id bigint"), "url", str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_merge_without_keys_in_the_state(spark, tmp_path):
    at = lambda x: str(tmp_path / x)
    watch = Progress()
    spark.streams.addListener(watch)
    for part in ([(1, "a"), (2, "a"), (3, None)], [(4, "b"), (5, "a"), (6, None)]):
        spark.createDataFrame(part, "i int, k string").coalesce(1).write.mode("append").parquet(at("in"))
        for _ in range(2):
            merge_by_target(new_files(spark, at("in"), "i int, k string"), "k", at("out"), at("state")).awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    for _ in range(50):
        if sum(n for *_, n in watch.rows) >= 6:
            break
        time.sleep(0.1)
    spark.streams.removeListener(watch)
    assert Counter(r["k"] for r in spark.read.parquet(at("out")).collect()) == {"a": 1, "b": 1, None: 1}
    assert watch.table(spark).agg(F.sum("n_rows")).first()[0] == 6
    save_results(new_files(spark, at("in"), "i int, k string"), at("json"), at("state2")).awaitTermination()
    assert spark.read.schema("i int, k string").json(at("json") + "/batch=*").count() == 6
