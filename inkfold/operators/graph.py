"""A directed property graph over posts, keywords, tags and authors: one edge per ordered pair.

Posts that share a tag are linked with each other. A tag of ``n`` posts stands for n(n-1)/2 such links, so they are not
written out: a tag is a node of its own, every post has an edge to each of its tags, and two posts are linked exactly if
both have an edge to the same tag. ``tag_classes`` tells how many links each tag stands for, and ``exact_degrees`` counts
a node's links in the graph in which all are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfold.operators.ranks import global_rank, running_before
from inkfold.session import durable

#: Later relations overwrite earlier ones on the same pair; ``shares_tag`` gives way to any edge there is. ``has_tag`` edges
#: end in tags, whose ids no other node has.
PRIORITY = {"wrote": 4, "next_post": 3, "contains_keyword": 2, "shares_tag": 1, "has_tag": 0}
#: What the id of a tag begins with.
TAG = "tag:"
#: Columns of a post's node besides its id and type.
ATTRIBUTES = ("title", "author", "published_at", "category", "tags")


def keyword_edges(keywords: DataFrame, post: str) -> DataFrame:
    return keywords.select(F.col(post).alias("src"), F.col("keyword").alias("dst"), F.lit("contains_keyword").alias("relation"))


def author_edges(posts: DataFrame, post: str, author: str) -> DataFrame:
    return posts.where(F.col(author) != "").select(F.col(author).alias("src"), F.col(post).alias("dst"), F.lit("wrote").alias("relation")).distinct()


def next_edges(posts: DataFrame, post: str, order: list[str], within: str | None = None) -> DataFrame:
    """Edges to the next post in ``order``, of the whole table or within one column's values.

    The table is numbered by range partitions and joined to itself on the number, so that no task sees it all, nor all
    of a value that a third of the rows have.
    """
    by = [] if within is None else [within]
    numbered = global_rank(posts.select(*dict.fromkeys([*by, *order, post])), list(dict.fromkeys([*by, *order, post])), "__n")
    left = numbered.select(F.col(post).alias("src"), (F.col("__n") + 1).alias("__n"), *(F.col(c).alias("__by") for c in by))
    out = left.join(numbered.select(F.col(post).alias("dst"), "__n", *by), "__n")
    out = out.where(F.col("__by").eqNullSafe(F.col(by[0])) if by else F.lit(True)).select("src", "dst")
    return out.withColumn("relation", F.lit("next_post"))


def tag_edges(posts: DataFrame, post: str, tags: str) -> DataFrame:
    """A ``has_tag`` edge from every post to each of its tags, whatever the tag's size; null tags are none."""
    held = posts.select(F.col(post).alias("src"), F.explode(F.array_distinct(tags)).alias("tag")).where(F.col("tag").isNotNull())
    return held.select("src", F.concat(F.lit(TAG), "tag").alias("dst"), F.lit("has_tag").alias("relation"))


def tag_classes(posts: DataFrame, post: str, tags: str) -> DataFrame:
    """``id, tag, n_posts, n_links``: per tag its posts and the links among them, from the earlier post to the later.

    A post in which the tag is repeated has a link to itself. ``post`` is unique. Combined before the shuffle, so a tag
    that a third of the posts hold costs a row a task.
    """
    counted = F.transform(F.array_distinct(tags), lambda t: F.struct(t.alias("tag"), F.size(F.filter(F.col(tags), lambda x: x == t)).alias("times")))
    held = posts.select(F.explode(counted).alias("t")).select("t.*").where(F.col("tag").isNotNull())
    sizes = held.groupBy("tag").agg(F.count(F.lit(1)).alias("n_posts"), F.count_if(F.col("times") > 1).alias("selves"))
    pairs = (F.col("n_posts") * (F.col("n_posts") - 1) / 2).cast("bigint")
    return sizes.select(F.concat(F.lit(TAG), "tag").alias("id"), "tag", "n_posts", (pairs + F.col("selves")).alias("n_links"))


def collapse(edges: DataFrame) -> DataFrame:
    """One edge per ordered pair, that of the highest priority; combined before the shuffle."""
    rank = F.coalesce(F.try_element_at(F.create_map(*(x for r, p in PRIORITY.items() for x in (F.lit(r), F.lit(p)))), F.col("relation")), F.lit(-1))
    return edges.groupBy("src", "dst").agg(F.max_by("relation", F.struct(rank, "relation")).alias("relation"))


def nodes(posts: DataFrame, keywords: DataFrame, authors: DataFrame, tags: DataFrame) -> DataFrame:
    """``id, type`` and ATTRIBUTES, which only posts have: an id that is a post is one, else a keyword, else an author, else a tag.

    ``posts`` has ``id`` and ATTRIBUTES, the others one column of ids. Of repeated ids one row is kept.
    """
    none = [F.lit(None).cast(t).alias(c) for c, t in posts.select(*ATTRIBUTES).dtypes]
    every = posts.select(F.col("id").cast("string").alias("id"), F.lit("post").alias("type"), F.lit(3).alias("rank"), *ATTRIBUTES)
    for df, kind, rank in ((keywords, "keyword", 2), (authors, "author", 1), (tags, "tag", 0)):
        every = every.unionByName(df.select(F.col(df.columns[0]).cast("string").alias("id"), F.lit(kind).alias("type"), F.lit(rank).alias("rank"), *none))
    best = every.where(F.col("id").isNotNull()).groupBy("id").agg(F.max(F.struct("rank", "type", *ATTRIBUTES)).alias("n"))
    return best.select("id", "n.type", *(f"n.{c}" for c in ATTRIBUTES))


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``id``: ends of edges that are no node."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return ends.join(nodes.select("id"), "id", "left_anti")


def with_isolated(degrees: DataFrame, nodes: DataFrame) -> DataFrame:
    """``id, n_in, n_out, degree`` of ``degrees`` and of those ``nodes`` that have no edge."""
    count = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_in", "n_out", "degree")]
    return degrees.join(nodes.select("id"), "id", "full").select("id", *count)


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``part, kind, n``: nodes by type and edges by relation."""
    return nodes.groupBy(F.lit("node").alias("part"), F.col("type").alias("kind")).agg(F.count(F.lit(1)).alias("n")).unionByName(
        edges.groupBy(F.lit("edge").alias("part"), F.col("relation").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    )


def degrees(edges: DataFrame) -> DataFrame:
    """``id, n_in, n_out, degree``."""
    ends = edges.select(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(
        edges.select(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o"))
    )
    return ends.groupBy("id").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"), F.count(F.lit(1)).alias("degree"))


def exact_degrees(posts: DataFrame, post: str, tags: str, position: str, others: DataFrame, *, subsets_up_to: int = 12, hot_share: float = 0.001) -> DataFrame:
    """``degrees`` of the graph in which every tag, whatever its size, has its ``shares_tag`` pairs, without writing them.

    ``others`` are the edges besides those pairs; ``post`` and ``position`` are unique. The later posts that share a tag
    with one are counted by inclusion and exclusion over the sets of its tags: of the holders of a set, a post's place
    among them says how many come before and after. Tags of one post and sets of one post are left out, having no pairs.
    Sets that a share ``hot_share`` of the posts hold are numbered by range partitions, the others by windows. Posts
    with more than ``subsets_up_to`` other tags have their neighbours counted one by one. A pair of posts that
    ``others`` join too counts once. Tags and sets are compared by hashes of 64 and 128 bits.
    """
    named = F.filter(F.coalesce(F.col(tags), F.array().cast("array<string>")), lambda t: t.isNotNull())
    distinct = F.transform(F.array_distinct(named), lambda t: F.xxhash64(t))
    held = posts.select(
        F.col(post).alias("p"),
        F.col(position).alias("at"),
        distinct.alias("own"),
        (F.size(F.array_distinct(named)) < F.size(named)).alias("twice"),
    )
    each = held.select("p", "at", F.explode("own").alias("tag"))
    shared = each.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("tag")
    sets = durable(each.join(shared, "tag").groupBy("p", "at").agg(F.array_sort(F.collect_list("tag")).alias("own")))

    few = F.size("own") <= subsets_up_to
    sets_of = lambda own: F.filter(
        F.aggregate(own, F.array(F.array().cast("array<bigint>")), lambda acc, t: F.concat(acc, F.transform(acc, lambda s: F.concat(s, F.array(t))))),
        lambda s: F.size(s) > 0,
    )
    key = lambda s: F.struct(
        F.xxhash64(s).alias("a"),
        F.xxhash64(F.lit(1), s).alias("b"),
        F.when(F.size(s) % 2 == 1, 1).otherwise(-1).alias("sign"),
    )
    ask = lambda own: sets.where(few).select("p", "at", F.explode(F.transform(sets_of(own), key)).alias("s")).select("p", "at", "s.*")
    asked = ask("own")
    sizes = durable(asked.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    least = max(1000, int(sets.count() * hot_share))
    hot = sizes.where(F.col("n") >= least)
    cold = asked.join(F.broadcast(hot.select("a", "b")), ["a", "b"], "left_anti").join(sizes, ["a", "b"])  # hot: at most the sets of a post by hot_share
    cold = cold.withColumn("before", F.row_number().over(Window.partitionBy("a", "b").orderBy("at")) - 1)
    # the tags of a hot set are hot themselves: at most the tags of a post by hot_share
    hot_tags = [r["tag"] for r in each.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("tag").collect()]
    warm = ask(F.array_intersect("own", F.array(*map(F.lit, hot_tags)).cast("array<bigint>"))).join(F.broadcast(hot), ["a", "b"])
    warm = running_before(warm, ["a", "b"], ["at"], F.lit(1), "before")
    by_sets = cold.unionByName(warm).select(
        F.col("p").alias("id"),
        (F.col("sign") * F.col("before")).alias("i"),
        (F.col("sign") * (F.col("n") - 1 - F.col("before"))).alias("o"),
    )

    many = sets.where(~few).select("p", "at", F.explode("own").alias("tag"))
    met = many.join(
        each.join(sets.where(few).select("p"), "p", "left_semi").select(F.col("p").alias("q"), F.col("at").alias("q_at"), "tag"),
        "tag",
    ).select("p", "at", "q", "q_at").distinct()
    among = many.join(
        many.select(F.col("p").alias("q"), F.col("at").alias("q_at"), "tag"),
        "tag",
    ).where(F.col("at") < F.col("q_at")).select("p", "at", "q", "q_at").distinct()
    met = met.select(
        F.when(F.col("at") < F.col("q_at"), F.col("p")).otherwise(F.col("q")).alias("src"),
        F.when(F.col("at") < F.col("q_at"), F.col("q")).otherwise(F.col("p")).alias("dst"),
    )
    met = met.unionByName(among.select(F.col("p").alias("src"), F.col("q").alias("dst")))

    selves = held.where("twice").select(F.col("p").alias("id"), F.lit(1).alias("i"), F.lit(1).alias("o"))
    pairs = durable(others.select("src", "dst").distinct())
    # only edges between posts can also be links by a tag
    between = durable(pairs.join(held.select(F.col("p").alias("dst")), "dst", "left_semi").join(held.select(F.col("p").alias("src")), "src", "left_semi"))
    left, right = (held.select(F.col("p").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("at", "own", "twice"))) for c in ("src", "dst"))
    twofold = between.join(left, "src").join(right, "dst").where(
        F.when(F.col("src") == F.col("dst"), F.col("src_twice")).otherwise(
            (F.col("src_at") < F.col("dst_at")) & F.arrays_overlap("src_own", "dst_own")
        )
    )

    def ends_of(df: DataFrame, n: int) -> DataFrame:
        return df.select(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(n).alias("o")).unionByName(
            df.select(F.col("dst").alias("id"), F.lit(n).alias("i"), F.lit(0).alias("o"))
        )

    every = by_sets.unionByName(selves).unionByName(ends_of(met, 1)).unionByName(ends_of(pairs, 1)).unionByName(ends_of(twofold, -1))
    summed = every.groupBy("id").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))
    return summed.withColumn("degree", F.col("n_in") + F.col("n_out")).where(F.col("degree") > 0)


def related(doc_keywords: DataFrame, *, top: int = 4) -> DataFrame:
    """``doc, other, score, common, rank``: the ``top`` documents that share most keywords with each.

    ``doc_keywords(doc, pos, kw)`` are settings, a few keywords of a few documents; ties go by ``pos`` of the other.
    """
    a, b = doc_keywords.select("doc", "kw").distinct(), doc_keywords.select(F.col("doc").alias("other"), F.col("pos").alias("other_pos"), "kw").distinct()
    shared = a.join(b, "kw").where(F.col("doc") != F.col("other")).groupBy("doc", "other").agg(
        F.count(F.lit(1)).alias("score"),
        F.array_sort(F.collect_set("kw")).alias("common"),
        F.min("other_pos").alias("other_pos"),
    )
    place = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("score"), "other_pos"))
    return shared.withColumn("rank", place.cast("bigint")).where(F.col("rank") <= top).select("doc", "other", "score", "common", "rank")


def concept_links(texts: DataFrame, key: str, text: str, rules: list[tuple[list[str], str]], *, top: int = 5, marker: str | None = None) -> DataFrame:
    """``key, concept, doc, rank``: of each rule the first alternative that a text contains; one link per doc, at most ``top``.

    Rules are settings and become one expression over the text: no join, one pass. Texts that already have ``marker``
    are left out.
    """
    source = texts if marker is None else texts.where(~F.coalesce(F.contains(F.col(text), F.lit(marker)), F.lit(False)))
    hit = [F.coalesce(*(F.when(F.contains(F.col(text), F.lit(w)), F.lit(w)) for w in words), F.lit(None).cast("string")) for words, _ in rules]
    found = F.filter(F.array(*(F.struct(h.alias("concept"), F.lit(doc).alias("doc")) for h, (_, doc) in zip(hit, rules))), lambda x: x["concept"].isNotNull())
    docs = F.transform(F.col("__found"), lambda x: x["doc"])
    once = F.filter(F.col("__found"), lambda x, i: F.array_position(docs, x["doc"]) == i + 1)
    links = source.select(key, found.alias("__found")).select(key, F.posexplode(F.slice(once, 1, top)).alias("at", "l"))
    return links.select(key, "l.concept", "l.doc", (F.col("at") + 1).cast("bigint").alias("rank"))
