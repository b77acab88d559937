"""Every registered query of the core against its SQL on the smallest tables."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from inkfold.plans import corpus, documents, training

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from tools.compare import plain  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
PLANS = {**training.QUERIES, **corpus.QUERIES, **documents.QUERIES}
SQL = {**training.ORACLE, **corpus.ORACLE, **documents.ORACLE}


@pytest.fixture(scope="module")
def con():
    if not FOLDER.exists():
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", PLANS)
def test_same_rows(spark, con, name):
    df = PLANS[name](spark, str(FOLDER))
    cols = sorted(df.columns)
    assert len(set(cols)) == len(cols)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in SQL:
        assert got
        return
    rel = con.execute(SQL[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == cols
    assert got == Counter(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())


def test_entry_without_the_subpackage():
    import __spark_entry__ as entry

    assert set(PLANS) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
