import random
from collections import Counter, defaultdict
from itertools import combinations
from math import log

from pyspark.sql import functions as F

from inkfold.llm import cooccurrence, ngrams


def brute(records, sigma):
    n, held = Counter(), defaultdict(set)
    for i, (grp, seq) in enumerate(records):
        for a in range(len(seq or [])):
            for size in range(1, min(sigma, len(seq) - a) + 1):
                n[(grp, tuple(seq[a : a + size]))] += 1
                held[(grp, tuple(seq[a : a + size]))].add(i)
    return {k: (v, len(held[k])) for k, v in n.items()}


def test_ngrams_as_brute_force_has_them(spark):
    r = random.Random(2)
    records = [(r.choice("xy"), r.choice([None, [], [r.choice(["hot", "hot", "hot", "a", "b", "c"]) for _ in range(r.randrange(9))]])) for _ in range(300)]
    records += [("x", ["hot"] * 3000)]
    df = spark.createDataFrame(records, "g string, s array<string>")
    for sigma in (1, 3):
        got = {
            (x["grp"], tuple(x["ngram"])): (x["n_occurrences"], x["n_records"]) for x in ngrams.ngram_counts(
                df,
                F.col("g"),
                F.col("s"),
                sigma,
                fan=3,
            ).collect()
        }
        assert got == brute(records, sigma)


def test_full_buffers_change_nothing(spark, monkeypatch):
    seqs = [[f"t{i % 17}", f"t{i % 5}", "hot"] for i in range(200)]
    from inkfold.llm.ngrams import _emit, _stack

    import pyarrow as pa

    monkeypatch.setattr(ngrams, "FLUSH", 7)
    batch = pa.RecordBatch.from_arrays([pa.array(["g"] * len(seqs)), pa.array(seqs)], names=["grp", "seq"])
    parts = [row for out in _emit(2)(iter([batch])) for row in out.to_pylist()]
    assert len(parts) > 20
    ordered = sorted(parts, key=lambda p: (p["grp"], p["suffix"]), reverse=True)
    again = pa.RecordBatch.from_pylist(ordered, schema=ngrams._COUNTED_ARROW)
    got = {(x["grp"], tuple(x["ngram"])): (x["n_occurrences"], x["n_records"]) for out in _stack(iter([again])) for x in out.to_pylist()}
    assert got == brute([("g", s) for s in seqs], 2)


def test_marks(spark):
    tags = [["#股票", "股票"], ["股票"], ["股票", None, ""], None, [], ["ｃｐｉ"], ["CPI "], ["cpi"], ["x" * 10_000]] * 1
    df = spark.createDataFrame([(t,) for t in tags], "tags array<string>").withColumn("term", F.lit("clash"))
    got = {
        r["terms"][0]: (
            r["n_occurrences"],
            r["n_records"],
            r["mark"],
        ) for r in ngrams.term_usefulness({"tags": (df, "tags")}).where("n_terms = 1").collect()
    }
    assert got == {"股票": (4, 3, "common"), "cpi": (3, 3, "common"), "x" * 10_000: (1, 1, "rare")}
    assert ngrams.term_usefulness({"tags": (df.limit(0), "tags")}).count() == 0


def pairs(baskets, least):
    rows, both = Counter(), Counter()
    for b in baskets:
        rows.update(b or [])
        both.update(combinations(sorted(b or []), 2))
    return {(*p, rows[p[0]], rows[p[1]], n) for p, n in both.items() if n >= least}


def test_pairs_as_brute_force_has_them(spark, monkeypatch):
    r = random.Random(4)
    baskets = [r.choice([None, [], sorted({r.choice(["hot", "é", "股", "a", "b", "c", "\U0001f600"]) for _ in range(r.randrange(7))})]) for _ in range(400)]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>").withColumn("item", F.lit(1))
    monkeypatch.setattr(cooccurrence, "BUFFER", 10)
    for whole in (200_000, 0):
        got = {tuple(x) for x in cooccurrence.pair_counts(df, "items", 3, max_broadcast_items=whole).collect()}
        assert got == pairs(baskets, 3)
    assert cooccurrence.pair_counts(df.limit(0), "items", 1).count() == 0


def test_measures(spark):
    df = spark.createDataFrame([("a", "b", 10, 8, 8), ("c", "d", 5, 5, 1)], "item_a string, item_b string, rows_a bigint, rows_b bigint, rows_both bigint")
    got = {r["item_a"]: (r["lift"], r["log_odds"]) for r in cooccurrence.association(df, 100).collect()}
    assert abs(got["a"][0] - 10) < 1e-12 and abs(got["a"][1] - log(8.5 * 90.5 / (2.5 * 0.5))) < 1e-9
    assert [r["item_a"] for r in cooccurrence.at_least_lift(df, 100, 4).collect()] == ["a", "c"]
    assert [r["item_a"] for r in cooccurrence.at_least_lift(df, 100, 5).collect()] == ["a"]


def test_a_long_basket(spark):
    df = spark.range(3).select(F.transform(F.sequence(F.lit(0), F.lit(299)), lambda i: i.cast("string")).alias("items"))
    assert cooccurrence.pair_counts(df, "items", 3).count() == 300 * 299 // 2
