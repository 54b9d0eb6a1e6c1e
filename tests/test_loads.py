"""Sources, sinks and whole jobs on small files the tests write, and plan shapes."""

import csv
import datetime
import os
import re

import pytest

import wellspring as w
from wellspring import sinks
from wellspring.model import schema as S
from wellspring.plans.tails import transform_results, transform_stations
from wellspring.sources import wqp
from wellspring.sources.csvfiles import layouts, read_text_csv, write_csv
from wellspring.streaming import ingest

AS_OF = datetime.datetime(2024, 1, 1)


def write(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *lines])


def result_lines(sample, station, day, values):
    return [[sample, station, p, v, "mg/l", day, "Water"] for p, v in values]


RESULT_HEADER = ["ActivityIdentifier", "MonitoringLocationIdentifier", "CharacteristicName", "ResultMeasureValue",
                 "ResultMeasure/MeasureUnitCode", "ActivityStartDate", "ActivityMediaName"]
STATION_HEADER = ["MonitoringLocationIdentifier", "MonitoringLocationTypeName", "LongitudeMeasure", "LatitudeMeasure", "ConstructionDateText"]
IONS = [("Bicarbonate", 188), ("Calcium", 66), ("Chloride", 57), ("Magnesium", 27), ("Nitrate", 0.8), ("Potassium", 7.4), ("Sodium", 109), ("Sulfate", 273)]


@pytest.fixture
def root(tmp_path):
    write(f"{tmp_path}/WQP/Stations/a.csv", STATION_HEADER, [
        ["ORG-1", "Cave", "-114", "42", "01/01/11"], ["ORG_WQX-2", "Well", "-111", "40", ""], ["ORG-2", "Well", "-111", "40", ""]])
    write(f"{tmp_path}/WQP/Results/a.csv", RESULT_HEADER, result_lines("S1", "ORG-1", "2011-01-02", IONS))
    write(f"{tmp_path}/WQP/Results/b.csv", RESULT_HEADER, result_lines("S2", "ORG_WQX-2", "1/3/2011", IONS[:3]))
    open(f"{tmp_path}/WQP/Results/not.acsv", "w").write("decoy\n1\n")
    return str(tmp_path)


def test_missing_folder_and_bad_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        wqp.read_results(spark, str(tmp_path))
    with pytest.raises(ValueError):
        w.parse_sources("nope")
    assert w.parse_sources(" wqp , bad, Ugs") == ["WQP", "UGS"]
    assert w.parse_sources(None) == ["WQP", "SDWIS", "DOGM", "UDWR", "UGS"]


def test_csv_rules(spark, tmp_path):
    path = f"{tmp_path}/q.csv"
    with open(path, "w") as f:
        f.write('a,b/c,d\n1,"said ""x"", y",3\n2\n3,4,5,6\n')
    got = [tuple(r) for r in read_text_csv(spark, path).orderBy("a").collect()]
    assert got == [("1", 'said "x", y', "3"), ("2", None, None), ("3", "4", "5")]
    multi = f"{tmp_path}/m.csv"
    write(multi, ["b/c", "a"], [["two\nlines", "9"]])
    found = layouts(spark, [path, multi])
    assert {(names, is_open) for names, is_open, _ in found} == {(("a", "b/c", "d"), False), (("b/c", "a"), True)}
    both = read_text_csv(spark, [path, multi])
    assert both.count() == 4
    assert both.where("a = '9'").first()["b/c"] == "two\nlines"


def test_seed_update_and_post_process(spark, root):
    db = "wq_test"
    w.create_tables(spark, db)
    stations = lambda: spark.table(sinks.table(db, "Stations"))
    results = lambda: spark.table(sinks.table(db, "Results"))
    assert [c for c in stations().columns if c != "DataSource"] == ["Id"] + [n for n in S.names(S.STATION) if n != "DataSource"]

    assert w.seed(spark, db, "wqp", root, as_of=AS_OF) == {"WQP": {"stations": 2, "results": 14}}
    assert sorted(r.StationId for r in stations().collect()) == ["ORG-1", "ORG-2"]
    one = stations().where("StationId = 'ORG-1'").first()
    assert (one.StationType, one.ConstDate, one.DataSource) == ("Other Groundwater", datetime.date(2011, 1, 1), "WQP")
    assert one.Shape.startswith("POINT (251535.07928")
    assert results().count() == 8 + 3 + 3
    assert results().select("Id").distinct().count() == 14
    derived = {r.Param: r.ResultValue for r in results().where("DataSource IS NULL").collect()}
    assert derived == {"Charge Balance": 0.27, "Cation Total": 10.45, "Anions Total": 10.39}

    write(f"{root}/WQP/Results/c.csv", RESULT_HEADER, result_lines("S3", "ORG-3", "2011-02-01", IONS) + result_lines("S0", "ORG-1", "2010-01-01", IONS))
    write(f"{root}/WQP/Stations/c.csv", STATION_HEADER, [["ORG-3", "Lake", "-110", "41", ""], ["ORG-4", "Lake", "-110", "41", ""]])
    for counted in ({"stations": 1, "results": 11}, {"stations": 0, "results": 0}):  # a second update finds nothing new
        assert w.update(spark, db, "WQP", root, today=datetime.date(2012, 1, 1), as_of=AS_OF) == {"WQP": counted}
        assert sorted(r.StationId for r in stations().collect()) == ["ORG-1", "ORG-2", "ORG-3"]
        assert results().count() == 14 + 8 + 3
    params = [r.Param for r in spark.table(sinks.table(db, "Params")).collect()]
    assert len(params) == len(set(params)) == 11 and "Charge Balance" in params

    counties = spark.createDataFrame(
        [(49, 49001, [[{"x": -112.0, "y": 39.0}, {"x": -109.0, "y": 39.0}, {"x": -109.0, "y": 42.0}, {"x": -112.0, "y": 42.0}]])],
        "state_code int, county_code int, rings array<array<struct<x: double, y: double>>>")
    grid = spark.createDataFrame([(-11100, 4000, 1234.0)], "cell_x bigint, cell_y bigint, elevation double")
    w.post_process(spark, db, counties, grid)
    got = {r.StationId: (r.StateCode, r.CountyCode, r.Elev, r.ElevUnit, r.ElevMeth) for r in stations().collect()}
    assert got == {
        "ORG-1": (None, None, None, None, None),
        "ORG-2": (49, 49001, 1234.0, "meters", "Other"),
        "ORG-3": (49, 49001, None, None, None),
    }
    # the same from within an update, with cells of another size
    grid = spark.createDataFrame([(-110, 41, 99.0)], "cell_x bigint, cell_y bigint, elevation double")
    w.update(spark, db, "WQP", root, today=datetime.date(2012, 1, 1), as_of=AS_OF, post={"counties": counties, "elevation": grid, "cell": 1.0})
    assert stations().where("StationId = 'ORG-3'").first().Elev == 99.0
    n = w.query_tables(spark, ["SELECT 1", f"SELECT count(*) FROM {sinks.table(db, 'Stations')}"])
    assert n.first()[0] == 3


def test_seed_exported(spark, tmp_path):
    folder = f"{tmp_path}/DOGM"
    spark.createDataFrame([("s1", -114.0, 40.0, 1), ("s2", None, None, 2)], "StationId string, point_x double, point_y double, junk int").write.parquet(f"{folder}/DOGM_STATION.parquet")
    write(f"{folder}/DOGM_RESULT.csv", ["SampleId", "Param", "ResultValue", "Unit"], [["e1", "Calcium", "5", "ug/l"], ["", "Calcium", "5", "ug/l"]])
    db = "wq_export"
    w.create_tables(spark, db)
    w.seed(spark, db, "DOGM", str(tmp_path), as_of=AS_OF)
    assert [(r.StationId, r.DataSource) for r in spark.table(sinks.table(db, "Stations")).collect()] == [("s1", "UDOGM")]
    assert [(r.SampleId, r.ResultValue, r.Unit) for r in spark.table(sinks.table(db, "Results")).collect()] == [("e1", 0.005, "mg/l")]


def test_query_csv(spark, tmp_path):
    write(f"{tmp_path}/left.csv", ["id", "v"], [["1", "x"], ["2", "y"]])
    write(f"{tmp_path}/right.csv", ["id", "z"], [["1", "q"]])
    files = [f"{tmp_path}/left.csv", f"{tmp_path}/right.csv"]
    got = w.query_csv(spark, ["SELECT 1", "SELECT v, z FROM left JOIN right ON left.id = right.id"], files)
    assert [tuple(r) for r in got.collect()] == [("x", "q")]
    assert not spark.catalog.tableExists("left")
    # a view of the caller's stays what it is
    spark.range(3).createOrReplaceTempView("left")
    assert w.query_csv(spark, "SELECT count(*) FROM left", files[:1]).first()[0] == 2
    assert spark.table("left").count() == 3
    spark.catalog.dropTempView("left")
    os.makedirs(f"{tmp_path}/other")
    write(f"{tmp_path}/other/left.csv", ["id"], [["1"]])
    with pytest.raises(ValueError, match="equal names"):
        w.query_csv(spark, "SELECT 1", [files[0], f"{tmp_path}/other/left.csv"])
    write_csv(got, f"{tmp_path}/out")
    part = next(f for f in os.listdir(f"{tmp_path}/out") if f.endswith(".csv"))
    assert open(f"{tmp_path}/out/{part}").read() == '"v","z"\n"x","q"\n'


def test_stream_takes_each_file_once(spark, tmp_path):
    landing, target = f"{tmp_path}/landing", f"{tmp_path}/results"
    read, append = ingest.parquet_target(spark, target)

    def run():
        ingest.ingest(ingest.result_stream(spark, landing, RESULT_HEADER), f"{tmp_path}/cp", "WQP", read, append, AS_OF)
        return read().count()

    write(f"{landing}/a.csv", RESULT_HEADER, result_lines("S1", "ORG-1", "2011-01-02", IONS))
    assert run() == 11
    assert run() == 11
    # A sample already stored is not appended again, a new one is.
    write(f"{landing}/b.csv", RESULT_HEADER, result_lines("S1", "ORG-1", "2011-01-02", IONS) + result_lines("S2", "ORG-1", "2011-01-02", IONS[:2]))
    assert run() == 13


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, root):
    raw = wqp.read_results(spark, root)
    text = plan(transform_results(raw, "WQP", AS_OF, scope=("source_file",)))
    # Three lookup joins per use of the detail rows, all broadcast; one shuffle,
    # that of the partial averages.
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text and "CartesianProduct" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "partial_avg" in text and "Python" not in text
    text = plan(transform_stations(wqp.read_stations(spark, root), "WQP", AS_OF))
    assert "Exchange hashpartitioning" not in text


def test_update_reads_its_rows_few_times(spark):
    """Scans of the rows and of what is stored: one each for details and balances."""
    from checks import queries

    scans = lambda df: len(re.findall(r"FileScan parquet.*lineitem", plan(df)))
    sf = "/root/testdata/sf0.001"
    assert scans(queries.QUERIES["new_results_by_sample"](spark, sf)) == 2
    assert scans(queries.QUERIES["update_wqp"](spark, sf)) <= 4


def test_balance_scan_is_narrow(spark):
    from checks import queries, views as V

    df = V.view(spark, "/root/testdata/sf0.001", V.EXPORTED_RESULTS)
    text = plan(queries.balance.charge_balance(queries.detail_results(df, "UDOGM", AS_OF)))
    read = re.search(r"ReadSchema: (struct<l_[^>]*>)", text).group(1)
    assert "l_shipdate" not in read and "l_extendedprice" not in read
