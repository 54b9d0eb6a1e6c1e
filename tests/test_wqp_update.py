"""An update from landed text: what is read once, and which records tasks take apart."""

import datetime
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_csv_splits import small_splits  # noqa: F401

from checks import queries, views
from wellspring.plans import loads
from wellspring.session import staged
from wellspring.sources import csvfiles
from wellspring.sources.csvfiles import FILE, read_text_csv

SF = "/root/testdata/sf0.001"
CELLS = ["a", "é", " b ", "", '""', '"c"', '"d,e"', '"f\ng"', '"h""i"', 'j"k', '"l"m', ' "n"', "o\tp", '"q\rr"', "\x00s", '" "', '""""', "'t'", "\\", '"\\"']


def test_cells_taken_apart_are_those_of_the_parser(spark):
    """Of two to four cells in any writing; what is not plain is left to the parser."""
    rng = random.Random(7)
    texts = [",".join(rng.choice(CELLS) for _ in range(rng.choice([2, 3, 3, 3, 3, 4]))) for _ in range(3000)]
    plain, columns = csvfiles._cells_of(3)(pa.array(texts))
    plain = plain.to_pylist()
    assert 500 < sum(plain) < 2500
    kept = [t for t, is_plain in zip(texts, plain, strict=True) if is_plain]
    options = {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "lineSep": "\n"}
    rows = spark.createDataFrame(list(enumerate(kept)), "i int, record string")
    parsed = rows.select("i", F.from_csv("record", "a string, b string, c string", options).alias("r")).orderBy("i").select("r.*").collect()
    assert [tuple(r) for r in parsed] == list(zip(*(c.to_pylist() for c in columns), strict=True))
    # Other counts of cells, text outside quotes, returns and zero bytes are not plain.
    odd = ["a,b", "a,b,c,d", 'a,"b"x,c', 'a, "b",c', 'a,b"b,c', "a,b\rb,c", "a,\x00b,c", 'a,"b,c', "", "   "]
    assert not any(csvfiles._cells_of(3)(pa.array([*odd, "x,y,z"]))[0].to_pylist()[:-1])


def test_no_text_in_utf8(spark):
    broken = pa.Array.from_buffers(pa.string(), 1, [None, pa.array([0, 3], pa.int32()).buffers()[1], pa.py_buffer(b"\xff,b")])
    assert csvfiles._cells_of(2)(broken)[0].to_pylist() == [False]


@pytest.mark.parametrize("size", [64, 900])
def test_plain_records_of_split_files_are_taken_apart(spark, tmp_path, small_splits, size):  # noqa: F811
    path = f"{tmp_path}/a.csv"
    with open(path, "w") as f:
        f.write("n,t\n" + "".join(f'{i},"line\nof ""{i}"""\n' for i in range(400)) + "400,x,y\n401\n")
    small_splits(size)
    found = csvfiles._Scan(spark, [path]).pieces(2)
    left = sorted(r.record for r in found.where("cells IS NULL").collect())
    assert left and set(left) <= {"400,x,y", "401"}
    rows = {r.n: r.t for r in read_text_csv(spark, path).collect()}
    assert len(rows) == 402 and rows["400"] == "x" and rows["401"] is None
    assert all(rows[str(i)] == f'line\nof "{i}"' for i in range(400))


def test_the_window_is_told_once(spark):
    """Rows are stored once their day is known to be in the window, without their file's
    name, and the results meet the box's stations that they name, not all of them."""
    results, stations = queries.raw_results(spark, SF), queries.raw_stations(spark, SF)
    stored, old = views.view(spark, SF, views.STORED_RESULTS), views.view(spark, SF, views.STORED_STATIONS)
    made = []

    def stage(rows):
        made.append(staged(rows, "stage"))
        return made[-1]

    run = lambda **options: loads.wqp_update(stations, results, old, stored, datetime.date(2024, 1, 1), views.as_of(), **options)
    load, plain = run(stage=stage), run()
    window, boxed, fresh = made
    assert FILE not in window.columns and 0 < window.count() < results.count()
    named = {r.StationId for r in window.select("StationId").distinct().collect()}
    assert boxed.columns == ["StationId"] and {r.StationId for r in boxed.collect()} < named
    assert 0 < fresh.count() < window.count()
    for one, other in zip(load, plain, strict=True):
        assert one.count() > 0
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_files_are_scanned_once_before_they_are_read(spark, tmp_path, small_splits, monkeypatch):  # noqa: F811
    """Unless a line feed does not end every line, or files of other ways lie beside."""
    scans = []
    real = csvfiles._told
    monkeypatch.setattr(csvfiles, "_told", lambda lines: scans.append(1) or real(lines))
    small_splits(50)

    def rows(name, text):
        scans.clear()
        with open(f"{tmp_path}/{name}.csv", "w", newline="") as f:
            f.write(text)
        found = sorted(tuple(r) for r in read_text_csv(spark, f"{tmp_path}/{name}.csv").collect())
        return found, len(scans)

    lines = [(str(i), f"two\nlines {i}") for i in range(30)]
    text = "n,t\n" + "".join(f'{n},"{t}"\n' for n, t in lines)
    assert rows("feeds", text) == (sorted(lines), 1)
    assert rows("no_last_feed", text[:-1]) == (sorted(lines), 1)
    assert rows("both", text.replace("\n", "\r\n")) == (sorted(lines), 1)
    lone = [(n, t.replace(" ", "\r")) for n, t in lines]
    assert rows("lone", "n,t\n" + "".join(f'{n},"{t}"\n' for n, t in lone)) == (sorted(lone), 3)
    monkeypatch.setattr(csvfiles, "_LONGEST", {"mapreduce.input.linerecordreader.line.maxlength": 9})
    assert rows("long", text) == (sorted(lines), 3)
