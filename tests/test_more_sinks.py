"""Typed CSV, CSV queries that ignore case, elevation tiles, early key joins."""

import csv
import io
import os
import re

import pytest
from pyspark.sql import functions as F
from test_loads import plan, write

import wellspring as w
from wellspring.operators import spatial
from wellspring.plans import jobs
from wellspring.sources import sdwis
from wellspring.sources.csvfiles import read_text_csv, write_typed_csv


def test_typed_csv_is_what_the_csv_module_writes(spark, tmp_path):
    rows = [(1, 2.5, "plain"), (-7, 0.125, 'said "x", y'), (3, 40.0, "two\nlines"), (4, 1.0, ""), (5, 2.0, None)]
    df = spark.createDataFrame(rows, "n int, `v w` double, t string").coalesce(1)
    write_typed_csv(df, f"{tmp_path}/out.csv")
    part = next(f for f in os.listdir(f"{tmp_path}/out.csv") if f.startswith("part"))
    want = io.StringIO()
    csv.writer(want, quoting=csv.QUOTE_NONNUMERIC).writerows([("n", "v w", "t"), *rows])
    assert open(f"{tmp_path}/out.csv/{part}", newline="").read() == want.getvalue()
    back = read_text_csv(spark, f"{tmp_path}/out.csv")
    assert sorted(back.select("n", "t").collect())[0] == ("-7", 'said "x", y')
    # A header per file, and one for an empty result.
    write_typed_csv(df.repartition(3), f"{tmp_path}/parts.csv")
    assert read_text_csv(spark, f"{tmp_path}/parts.csv").count() == 5
    write_typed_csv(df.limit(0), f"{tmp_path}/none.csv")
    assert [r.value for r in spark.read.text(f"{tmp_path}/none.csv").collect()] == ['"n","v w","t"']
    assert read_text_csv(spark, f"{tmp_path}/none.csv").columns == ["n", "v w", "t"]


def test_query_that_ignores_case(spark, tmp_path):
    write(f"{tmp_path}/a.csv", ["id", "name"], [["1", "Sodium"], ["2", "SULFATE"], ["3", "iron"]])
    ask = "SELECT id FROM a WHERE name LIKE 's%'"
    assert w.query_csv(spark, ask, [f"{tmp_path}/a.csv"]).count() == 0
    assert w.query_csv(spark, ask, [f"{tmp_path}/a.csv"], ignore_case=True).count() == 2
    assert w.query_csv(spark, "SELECT id FROM a WHERE try_cast(name AS int) > 1 OR id > 2", [f"{tmp_path}/a.csv"]).count() == 1


def test_elevation_between_samples(spark):
    """Across tiles, on samples, on the last row of a grid, beside missing samples."""
    grid = [(x, y, 100.0 * x + 10 * y + x * y) for x in range(-6, 5) for y in range(-3, 6) if (x, y) != (2, 2)]
    grid = spark.createDataFrame([*grid, (0, 0, 999.0), (4, 4, None)], "cell_x long, cell_y long, elevation double")
    tiles = spatial.elevation_tiles(grid, 4)
    assert tiles.selectExpr("max(size(samples))").first()[0] == 25
    points = {1: (-5.25, -2.5), 2: (-4.0, 4.0), 3: (-0.5, 3.75), 4: (-6.0, 5.0), 5: (-6.5, 0.0), 6: (-1.0, 0.0), 7: (0.0, 0.0), 8: (-4.0, 0.5)}
    rows = [(i, x / 2, y / 2, None) for i, (x, y) in points.items()] + [(9, -1.0, 1.0, 77.0), (10, None, 1.0, None)]
    stations = spark.createDataFrame(rows, "Id int, Lon_X double, Lat_Y double, Elev double").withColumns(
        {"ElevUnit": F.lit(None).cast("string"), "ElevMeth": F.lit(None).cast("string")}
    )
    got = {r.Id: (r.Elev, r.ElevUnit) for r in spatial.fill_elevation_from_tiles(stations, tiles, 0.5, 4).collect()}
    want = {i: (100.0 * x + 10 * y + x * y, "meters") for i, (x, y) in points.items()}
    want |= {5: (None, None), 9: (77.0, None), 10: (None, None)}
    assert {i: v and (v[0] if v[0] is None else round(v[0], 9), v[1]) for i, v in got.items()} == want
    beside = spark.createDataFrame([(1, -1.5, 1.0, None, None, None)], stations.schema)
    assert spatial.fill_elevation_from_tiles(beside, spatial.elevation_tiles(grid.where("cell_x <> -3"), 4), 0.5, 4).first().Elev is None


def test_post_process_takes_tiles(spark):
    box = spark.createDataFrame([(49, 1, [[(-112.0, 39.0), (-109.0, 39.0), (-109.0, 42.0), (-112.0, 42.0)]])], "state_code int, county_code int, rings array<array<struct<x: double, y: double>>>")
    grid = spark.createDataFrame([(x, y, 5.0 * x) for x in range(-113, -108) for y in range(38, 43)], "cell_x long, cell_y long, elevation double")
    stations = spark.createDataFrame([(1, -110.5, 40.5, None, None, None, None, None)], "Id int, Lon_X double, Lat_Y double, StateCode int, CountyCode int, Elev double, ElevUnit string, ElevMeth string")
    r = jobs.processed_stations(stations, box, spatial.elevation_tiles(grid), cell=1.0).first()
    assert (r.CountyCode, r.Elev) == (1, -552.5)


@pytest.mark.parametrize("by", ["keys", "ids"])
def test_keys_meet_the_samples_first(spark, by):
    """The table of samples is cut before it meets the measurements."""
    from checks import views as V

    sf = "/root/testdata/sf0.001"
    stored = V.view(spark, sf, V.STORED_SDWIS)
    text = sdwis.results(V.sdwis_tables(spark, sf), **{by: stored})._jdf.queryExecution().optimizedPlan().toString()
    semi = [m.start() for m in re.finditer("LeftSemi", text)]
    inner = [m.start() for m in re.finditer(r"Join Inner", text)]
    # Deeper in the plan than every inner join but those of its own keys.
    assert semi and semi[-1] > inner[2]
    assert "LeftSemi" in plan(sdwis.results(V.sdwis_tables(spark, sf), **{by: stored}))
