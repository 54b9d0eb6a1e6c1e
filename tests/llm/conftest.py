import duckdb
import pytest

from wellspring.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture
def same(spark, duck):
    """Compares a registered query with its SQL on the smallest tables."""

    def check(name):
        df = QUERIES[name](spark, SF)
        columns = sorted(df.columns)
        got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
        want = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
        assert got == sorted(map(repr, want))

    return check
