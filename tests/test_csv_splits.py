"""CSV files with line breaks inside quotes, read by several tasks."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from wellspring.sources import csvfiles
from wellspring.sources.csvfiles import read_text_csv


@pytest.fixture
def small_splits(spark):
    """Text is split every few bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def to(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield to
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def made(path, rows, seed, end="\n"):
    rng = random.Random(seed)
    cell = lambda: "".join(rng.choice(["a", "é", " ", ",", '"', '""', "\n", "\r\n", "\n\n", "x" * 9]) for _ in range(rng.randint(0, 7))) or "0"
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["n", "b/c", "odd.name"])
        for i in range(rows):
            w.writerow([i, cell(), cell()])
    return path


def whole(spark, path):
    """Spark's own reader, which takes such a file as one."""
    rows = spark.read.schema("n string, b string, c string").option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize("seed,size,end", [(1, 16, "\n"), (2, 37, "\r\n"), (3, 300, "\n"), (4, 5000, "\r\n")])
def test_equals_the_unsplit_reader(spark, tmp_path, small_splits, seed, size, end):
    """Splits shorter than a record and longer, through quotes, doubled quotes and line
    ends of both kinds."""
    path = made(f"{tmp_path}/a.csv", 300, seed, end)
    want = whole(spark, path)
    small_splits(size)
    assert list(csvfiles._ways(spark, path)) == [(("n", "b/c", "odd.name"), csvfiles.CUT)]
    got = read_text_csv(spark, path, with_file=True)
    assert got.columns == ["n", "b/c", "odd.name", "source_file"]
    assert sorted(tuple(r)[:3] for r in got.collect()) == want
    assert got.select("source_file").distinct().count() == 1


def test_several_files_and_ways(spark, tmp_path, small_splits):
    for name, rows in (("a", 200), ("b", 1), ("d", 150)):
        made(f"{tmp_path}/{name}.csv", rows, rows)
    with open(f"{tmp_path}/c.csv", "w") as f:
        f.write("n,b/c\n7,plain\n")
    want = sum((whole(spark, f"{tmp_path}/{n}.csv") for n in "abd"), [])
    small_splits(400)
    got = read_text_csv(spark, f"{tmp_path}/*.csv")
    assert sorted(tuple(r) for r in got.where("n <> '7' OR `b/c` <> 'plain'").collect()) == sorted(want)
    assert got.where("`b/c` = 'plain'").count() == 1


def test_odd_names(spark, tmp_path):
    """Blanks, percent signs, letters beyond ASCII and pattern characters in a name."""
    for i, name in enumerate(("a b", "c%20d", "é", "x[1]", "y{2}")):
        with open(f"{tmp_path}/{name}.csv", "w") as f:
            f.write(f'n,t\n{i},"two\nlines"\n')
    assert sorted(r.n for r in read_text_csv(spark, f"{tmp_path}/*.csv").collect()) == list("01234")


def test_read_by_several_tasks(spark, tmp_path, small_splits):
    path = made(f"{tmp_path}/a.csv", 4000, 5)
    small_splits(20_000)
    found = csvfiles._pieces(spark, [path]).where("edge = 0")
    rows = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(rows) >= 5 and max(rows) < 3 * sorted(rows)[len(rows) // 2]
    # Only the pieces at the edges are put together again.
    cut = csvfiles._pieces(spark, [path], only_cut=True)
    assert 0 < cut.count() <= 2 * found.rdd.getNumPartitions()


def test_blank_lines_and_an_open_end(spark, tmp_path, small_splits):
    path = f"{tmp_path}/a.csv"
    with open(path, "w", newline="") as f:
        f.write('\nn,b,c\n\n1,"x\n\ny",2\n\n3\n4,"""",5,6\n"7')
    want = whole(spark, path)
    for size in (4, 9, 15):
        small_splits(size)
        assert sorted(map(tuple, read_text_csv(spark, path).collect())) == want
