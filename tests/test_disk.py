"""What a job leaves on disk besides the rows it stores."""

import gzip
import os
import shutil
import time

import pytest
from test_loads import AS_OF, RESULT_HEADER, result_lines, root, write  # noqa: F401

import wellspring as w
from wellspring import ledger, session
from wellspring.session import staged, temporary
from wellspring.sources import wqp


@pytest.fixture
def stages(monkeypatch, tmp_path):
    """The folder that stages go to."""
    made = iter(range(1000))
    monkeypatch.setattr(session, "scratch_dir", lambda spark, purpose: f"{tmp_path}/stages/{purpose}-{next(made)}")
    os.makedirs(f"{tmp_path}/stages")
    yield f"{tmp_path}/stages"
    assert next(made) > 0  # there was one


def test_a_load_leaves_no_stage(spark, root, stages, monkeypatch):  # noqa: F811
    db = "wq_stages"
    w.create_tables(spark, db)
    with monkeypatch.context() as m:
        m.setattr(ledger, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("late")))
        with pytest.raises(RuntimeError, match="late"):
            w.seed(spark, db, "WQP", root, as_of=AS_OF)
    assert os.listdir(stages) == []
    assert w.seed(spark, db, "WQP", root, as_of=AS_OF) == {"WQP": {"stations": 2, "results": 14}}
    write(f"{root}/WQP/Results/c.csv", RESULT_HEADER, result_lines("S3", "ORG-1", "2011-02-01", [("Calcium", 1)]))
    assert w.update(spark, db, "WQP", root, as_of=AS_OF, today=AS_OF.date()) == {"WQP": {"stations": 0, "results": 1}}
    assert os.listdir(stages) == []


def test_stages_outside_a_job_stay(spark, stages):
    kept = staged(spark.range(3), "kept")
    with temporary(spark):
        assert staged(spark.range(4), "own").count() == 4
    assert kept.count() == 3 and [name.split("-")[0] for name in os.listdir(stages)] == ["kept"]


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_a_shuffle_ends_with_its_query(spark, tmp_path):
    before = spark.conf.get(session._FREE_SHUFFLES)
    held = shuffle_files(spark)
    dealt = spark.range(0, 1000, 1, 4).repartition(3, "id")
    with temporary(spark):
        dealt.write.parquet(f"{tmp_path}/one")
        for _ in range(100):  # deleted in the background
            if shuffle_files(spark) <= held:
                break
            time.sleep(0.1)
        assert shuffle_files(spark) <= held
    assert spark.conf.get(session._FREE_SHUFFLES) == before
    assert spark.read.parquet(f"{tmp_path}/one").count() == 1000


def test_compressed_extracts(spark, root):  # noqa: F811
    plain = sorted(map(tuple, wqp.read_results(spark, root).drop("source_file").collect()))
    name = f"{root}/WQP/Results/a.csv"
    with open(name, "rb") as f, gzip.open(f"{name}.gz", "wb") as out:
        shutil.copyfileobj(f, out)
    os.remove(name)
    rows = wqp.read_results(spark, root)
    assert sorted(map(tuple, rows.drop("source_file").collect())) == plain
    assert {r[0].rsplit("/", 1)[1] for r in rows.select("source_file").distinct().collect()} == {"a.csv.gz", "b.csv"}
