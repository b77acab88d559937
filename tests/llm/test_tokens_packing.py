import base64
import random
from collections import defaultdict
from pathlib import Path

import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkfold.llm import packing, tokens

FILE = f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not Path(FILE).exists(), reason="no vocabulary")


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(FILE).read_bytes().splitlines())}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@settings(max_examples=300, deadline=None)
@given(t=st.text(st.one_of(st.sampled_from("abcdeehilnorst THE'll0123456789é中国日本の\n\t!?.,😀"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_encodes_as_the_library_does(plain, t):
    assert list(tokens.encoder(FILE).encode([t], regex.compile(tokens.PATTERN))) == [plain(t)]


def test_forgetting_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(tokens, "WORD_BYTES", 40)
    monkeypatch.setattr(tokens, "PAIRS", 3)
    one, cut = tokens.PrefixEncoder(FILE), regex.compile(tokens.PATTERN)
    for t in ["the prefix prefixes prefixed", "unbelievably long words aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "中文分词很难中文", "the prefix"]:
        assert list(one.encode([t, t], cut)) == [plain(t)] * 2


def test_ids_of_a_table(spark, plain):
    texts = ["a <|endoftext|> b", "", None, " \n\n ", "x" * 30_000 + " 中" * 9_000, "same", "same"]
    df = spark.createDataFrame([(i if i != 5 else None, t) for i, t in enumerate(texts)], "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    got = sorted((r["doc_id"] is None, r["doc_id"], r["ids"]) for r in tokens.token_ids(df, "doc_id", "text").collect())
    assert [g[2] for g in got] == [plain(t) if t else [] for t in [texts[0], texts[1], texts[2], texts[3], texts[4], texts[6], texts[5]]]
    sizes = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(df, "doc_id", "text").collect()}
    assert sizes[4] == len(plain(texts[4])) and sizes[2] == 0
    assert tokens.token_ids(df.limit(0), "doc_id", "text").count() == 0


@settings(max_examples=200, deadline=None)
@given(h=st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_patterns_place_everything(h):
    placed = defaultdict(int)
    for containers, content in packing.shortest_pack_first(h, 64):
        assert containers > 0 and 0 < sum(n * k for n, k in content) <= 64
        for length, k in content:
            placed[length] += containers * k
    assert dict(placed) == h


def test_little_is_wasted():
    r = random.Random(1)
    h = defaultdict(int)
    for _ in range(50_000):
        h[min(512, int(r.lognormvariate(4.5, 0.9)) + 1)] += 1
    used = sum(c for c, _ in packing.shortest_pack_first(h, 512))
    assert used <= 1.01 * -(-sum(n * c for n, c in h.items()) // 512)
    assert packing.shortest_pack_first({10: 1_000_000}, 512) == [(19607, [(10, 51)]), (1, [(10, 43)])]


def check(rows, sizes, capacities):
    for cap_id, cap in capacities.items():
        used, parts = defaultdict(int), defaultdict(list)
        for r in rows:
            if r["capacity_id"] == cap_id:
                used[r["container_id"]] += r["n_tokens"]
                parts[r["doc_id"]].append((r["token_start"], r["n_tokens"]))
        assert max(used.values()) <= cap and set(used) == set(range(len(used)))
        for key, n in sizes.items():
            at = 0
            for start, k in sorted(parts[key]):
                assert start == at
                at += k
            assert at == n and len(parts[key]) == max(1, -(-n // cap))


def test_packs_a_table(spark):
    r = random.Random(3)
    sizes = {i: 7 if i % 3 == 0 else r.choice([0, 1, 5, 30, 31, 32, 33, 64, 65, 200, r.randrange(40)]) for i in range(900)}
    df = spark.createDataFrame(list(sizes.items()), "doc_id bigint, n_tokens bigint").withColumn("shard", F.lit("clash"))
    rows = packing.pack(df, "doc_id", "n_tokens", {1: 32, 2: 100}).collect()
    check(rows, sizes, {1: 32, 2: 100})
    again = packing.pack(df.repartition(3), "doc_id", "n_tokens", {1: 32, 2: 100}).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    caps = spark.createDataFrame([(1, 32), (2, 100)], "capacity_id int, capacity_tokens int")
    kinds = "capacity_id int, container_id bigint, doc_id bigint, part_no int, token_start bigint, n_tokens bigint"
    told = lambda rs: sorted(tuple(x) for x in packing.violations(spark.createDataFrame(rs, kinds), df, caps).collect())
    assert told(rows) == [(1, 0, 0, 0), (2, 0, 0, 0)]
    worse = [(1, 0, *r[2:]) if r["capacity_id"] == 1 else tuple(r) for r in rows if tuple(r)[:3] != (2, *tuple(rows[-1])[1:3])]
    assert told(worse)[0][1] == 1 and (rows[-1]["capacity_id"] != 2 or told(worse)[1][2] == 1)


def test_edges_of_packing(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (None, 3), (4, 3), (4, 3)], "doc_id bigint, n_tokens bigint")
    rows = packing.pack(df, "doc_id", "n_tokens", {1: 4}).collect()
    assert sorted((r["container_id"], r["n_tokens"]) for r in rows) == [(0, 0), (0, 0), (0, 3), (1, 3), (2, 3)]
    assert packing.pack(df.limit(0), "doc_id", "n_tokens", {1: 4}).count() == 0
    docs = spark.createDataFrame([(1, "hello world", "clash"), (2, None, None)], "doc_id bigint, text string, capacity_id string")
    caps = spark.createDataFrame([(1, 512, None), (2, 1, "byte_bpe_50k")], "capacity_id int, capacity_tokens int, tokenizer string")
    packed = packing.pack_documents(docs, caps)
    assert packed.count() == 2 + 3
    assert {r["capacity_id"]: (r["n_containers"], r["unused"]) for r in packing.container_fill(packed, caps).collect()} == {1: (1, 510), 2: (2, 0)}
