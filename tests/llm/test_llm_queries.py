"""The subpackage's registered queries, against their SQL where they have one."""

import sys
from collections import Counter
from itertools import combinations
from pathlib import Path
from unicodedata import normalize

import duckdb
import pytest

from inkfold.llm import queries

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))
from tools.compare import plain  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
COLUMNS = {
    "p1_found": ["result_id", "field_name", "defect"],
    "p2_found": ["field_name", "term", "mark"],
    "p3_found": ["post_row", "field_name"],
    "p6_found": ["tag_a", "tag_b"],
    "p7_ids": ["doc_id", "ids"],
    "p9_found": ["doc_id", "lang_code"],
}


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", queries.QUERIES)
def test_rows(spark, name):
    df = queries.QUERIES[name](spark, str(FOLDER))
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = df.collect()
    if name in COLUMNS and name != "p7_ids":
        assert len(set(rows)) == len(rows)
    if name in queries.ORACLE:
        con = duckdb.connect()
        for p in FOLDER.glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        rel = con.execute(queries.ORACLE[name])
        names = [c[0] for c in rel.description]
        cols = sorted(df.columns)
        assert sorted(names) == cols
        assert Counter(tuple(plain(r[c]) for c in cols) for r in rows) == Counter(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
def test_pairs_of_one_row_come_out(spark):
    held = duckdb.sql(f"SELECT tags FROM '{FOLDER}/posts.parquet' WHERE len(tags) > 1").fetchall()
    terms = [{normalize("NFKC", t).strip(" \u3000\t\n#\"'“”‘’「」").lower() for t in tags if t} - {""} for (tags,) in held]
    want = Counter(p for own in terms for p in combinations(sorted(own), 2))
    got = {(r["tag_a"], r["tag_b"]): r["rows_both"] for r in queries.QUERIES["p6_pairs"](spark, str(FOLDER)).collect()}
    assert got == want
    assert min(want.values()) == 1
