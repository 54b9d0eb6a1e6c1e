"""Run queries beside their SQL and compare rows as multisets.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from wellspring.session import local_session

from .oracles import ORACLES
from .queries import QUERIES
from .views import TABLES


def oracle(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark, con, name: str, sf_dir: str) -> tuple[int, str]:
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, (tuple(r) for r in df.collect()))
    if name not in ORACLES:
        return sum(got.values()), ""
    relation = con.sql(ORACLES[name])
    want = rows_of(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return sum(got.values()), f"columns {sorted(df.columns)} / {sorted(relation.columns)}"
    if got == want:
        return sum(got.values()), ""
    extra, missing = got - want, want - got
    return sum(got.values()), (
        f"rows {sum(got.values())} / {sum(want.values())}, {sum(extra.values())} extra e.g. "
        f"{sorted(extra, key=str)[:2]}, {sum(missing.values())} missing e.g. {sorted(missing, key=str)[:2]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            n, problem = differences(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            n, problem = -1, f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {n:8d} rows {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
