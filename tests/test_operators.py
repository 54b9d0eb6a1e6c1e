"""Golden values and edge cases of the operators."""

import datetime
import math
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from wellspring.functions import casting
from wellspring.functions.rounding import round2
from wellspring.functions.text import strip_twin_mark, trimmed
from wellspring.model import lookups, schema as S
from wellspring.operators import balance, columns, dedupe, incremental, normalize, skew, spatial
from wellspring.plans import jobs
from wellspring.sources import wqp

AS_OF = datetime.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def cast(spark, field, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    fields = [S.Field("x", *field)]
    out = columns.cast_to_schema(df, fields, AS_OF).orderBy("i").collect()
    return [r.x for r in out]


def test_declared_sizes():
    assert (len(S.STATION), len(S.RESULT), len(lookups.STATION_TYPES)) == (33, 42, 61)
    kinds = [f.kind for f in S.RESULT]
    assert kinds.count("string") == 32 and kinds.count("double") == 5 and kinds.count("date") == 2


def test_strings_are_trimmed_then_cut(spark):
    assert cast(spark, ("string", 4), ["  ab cdef ", "\t x \n", "   ", "", None, "naïveté"]) == [
        "ab c", "x", None, None, None, "naïv"]


def test_numbers(spark):
    assert cast(spark, ("short",), ["7", "+7", "-3", "3.5", "1_000", "x", "99999999999"]) == [7, 7, -3, None, None, None, None]
    got = cast(spark, ("double",), ["1e3", ".5", "5.", "+7", "1d", "2F", "0x1p3", "1_000", "inf", "-Infinity", "", "nan"])
    assert got[:-1] == [1000, 0.5, 5, 7, None, None, None, None, math.inf, -math.inf, None]
    assert math.isnan(got[-1])
    assert cast(spark, ("float",), ["1.0"]) == [None]


def test_dates(spark):
    texts = {
        "2011-01-02": (2011, 1, 2), "2011-1-2 5:30": (2011, 1, 2), "1/2/2011": (2011, 1, 2), "01/01/11": (2011, 1, 1),
        "20110102": (2011, 1, 2), "2011/01/02": (2011, 1, 2), "13/02/2011": (2011, 2, 13), "Jan 2, 2011": (2011, 1, 2),
        "2-DEC-2011": (2011, 12, 2), "5/6/85": (1985, 5, 6), "20110102T101112": (2011, 1, 2),
        "1/2/2011 11:05 PM": (2011, 1, 2), "2060-02-24": None, "1799-02-24": None, "2011": None, "2011-01": None,
        "2011-02-30": None, "unknown": None, "2011-01-02T10:00:00Z": None,
    }
    got = cast(spark, ("date",), list(texts))
    assert [g and (g.year, g.month, g.day) for g in got] == list(texts.values())


def test_times(spark):
    assert cast(spark, ("time",), ["12:00:00", "9:5", "12", "24:00", "7:61", "", "23:59:59", "24:00:00"]) == [
        "12:00:00", "09:05:00", "12:00:00", None, None, None, "23:59:59", None]


def test_cast_keeps_unknown_and_adds_missing(spark):
    df = spark.createDataFrame([("kept", 12345)], "other string, OrgId int")
    out = columns.cast_to_schema(df, [S.Field("OrgId", "string", 2), S.Field("Missing", "double")], AS_OF)
    assert out.columns == ["OrgId", "Missing", "other"]
    assert rows(out) == [("12", None, "kept")]


def test_storage_types(spark):
    df = spark.createDataFrame([("a", -114.12345678, datetime.datetime(2011, 1, 1, 5))], "StationId string, Lon_X double, ConstDate timestamp_ntz")
    out = columns.to_storage(df, S.STATION)
    assert out.columns == S.names(S.STATION)
    r = out.first()
    assert (r.Lon_X, r.ConstDate) == (Decimal("-114.123457"), datetime.date(2011, 1, 1))


def test_rounding_matches_exact_half_even(spark):
    large = [2.0**k + d for k in (42, 43, 44, 45, 46, 50, 60) for d in (0, 0.0078125, 0.125, 0.375, 0.625, 0.015625, -0.0078125)]
    large += [(2**45 * 128 + m) / 128.0 for m in range(0, 400, 7)] + [(2**46 * 128 - m) / 128.0 for m in range(16, 800, 16)]
    values = large + [-x for x in large] + [2.675, 0.125, 0.375, 1.005, -2.675, -0.125, 0.115, 1e6 + 0.005, 0.0, 10.4449999, -0.004] + [i / 1000 + 0.0005 for i in range(-300, 300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for x, got in df.select("x", round2(F.col("x"))).collect():
        assert got == float(Decimal(x).quantize(Decimal("0.01"), ROUND_HALF_EVEN)), x


def test_strip_is_idempotent(spark):
    df = spark.createDataFrame([("A_WQX-1_WQX-2",), ("a_wqx-1",), (None,)], "s string")
    once = strip_twin_mark(F.col("s"))
    assert [tuple(r) for r in df.select(once, strip_twin_mark(once)).collect()] == [("A-1-2", "A-1-2"), ("a_wqx-1", "a_wqx-1"), (None, None)]


RESULT_INPUT = "StationId string, SampMedia string, Param string, Unit string, ResultValue double, ParamGroup string"


@pytest.mark.parametrize("source", [None, "SDWIS"])
def test_every_unit_rule(spark, source):
    rules = lookups.unit_rule_rows(source=source)
    data = [("s", None, param.upper(), unit, 2.0, "prior") for param, unit in rules]
    out = normalize.apply_unit_rules(spark.createDataFrame(data, RESULT_INPUT), source=source)
    want = sorted(
        (new_param or param, new_unit or unit, 2.0 * (1 if factor is None else factor))
        for (param, unit), (factor, new_unit, new_param) in rules.items()
    )
    assert sorted((r.Param, r.Unit, r.ResultValue) for r in out.collect()) == want


def test_unit_rules_as_published():
    rules = lookups.unit_rule_rows()
    assert rules["perchlorate", "ug/l"][0] == 0.001 and rules["perchlorate", "mg/l"][0] == 1000
    assert rules["nitrate-nitrogen", "mg/l"] == (4.426802887, "mg/l", "nitrite")
    assert rules["nitrate-nitrogen", "mg/l as n"] == (4.426802887, "mg/l", "nitrate")
    assert rules["specific conductance", "umho/cm"] == (None, "uS/cm", None)
    assert ("nitrate", "mg/l") not in rules and ("nitrate", "mg/l") in lookups.unit_rule_rows(source="SDWIS")
    assert ("nitrate", "mg/l as N") not in rules


def test_normalize_results_edges(spark):
    data = [
        ("ABC_WQX-abc", "WL", None, "unit", 0.0, None),
        ("x", "test", "Calcium", "ug/l", None, None),
        ("x", None, "Nitrate As N", "mg/l", 0.0, None),
        ("x", " IN ", "Unheard", "mg/l", 1.0, "kept"),
    ]
    out = normalize.normalize_results(spark.createDataFrame(data, RESULT_INPUT))
    got = sorted(((r.StationId, r.SampMedia, r.Param, r.Unit, r.ResultValue, r.ParamGroup) for r in out.collect()), key=str)
    assert got == sorted([
        ("ABC-abc", "Groundwater", None, "unit", 0.0, None),
        ("x", "test", "calcium", "mg/l", None, "inorganics, major, metals"),
        ("x", None, "nitrate", "mg/l", 0.0, "nutrient"),
        ("x", "Surface Water", "unheard", "mg/l", 1.0, "kept"),
    ], key=str)


def test_user_rules_first_priority_wins(spark):
    rules = spark.createDataFrame(
        [("a", "u", 2.0, "v", None, 1), ("a", "u", 3.0, "w", None, 2)],
        "param string, unit string, factor double, new_unit string, new_param string, prio int")
    out = normalize.apply_unit_rules(spark.createDataFrame([("s", None, "A", "u", 5.0, None)], RESULT_INPUT), rules)
    r = out.first()
    assert out.count() == 1 and (r.ResultValue, r.Unit) == (10.0, "v")


BALANCE = "SampleId string, Param string, ResultValue double, DetectCond string"


def samples(spark, **by_sample):
    data = [(s, p, float(v) if v is not None else None, None) for s, ps in by_sample.items() for p, v in ps]
    return spark.createDataFrame(data, BALANCE)


GOLDEN = [("Bicarbonate", 188), ("Calcium", 66), ("Chloride", 57), ("Magnesium", 27), ("Nitrate", 0.8), ("Potassium", 7.4), ("Sodium", 109), ("Sulfate", 273)]
GOLDEN_SUM = [("Bicarbonate", 139), ("Calcium", 46), ("Chloride", 12), ("Magnesium", 10), ("Nitrate", 0.5), ("Sodium plus potassium", 25), ("Sulfate", 76)]


def test_balance_goldens(spark):
    df = samples(spark, one=GOLDEN, two=GOLDEN_SUM, short=GOLDEN[1:])
    got = {(r.SampleId, r.Param): (r.ResultValue, r.Unit) for r in balance.charge_balance(df).collect()}
    assert got == {
        ("one", "Charge Balance"): (0.27, "%"), ("one", "Cation Total"): (10.45, "meq/l"), ("one", "Anions Total"): (10.39, "meq/l"),
        ("two", "Charge Balance"): (-0.02, "%"), ("two", "Cation Total"): (4.21, "meq/l"), ("two", "Anions Total"): (4.21, "meq/l"),
    }


def test_balance_ignores_detection_conditions_and_codes_name_themselves(spark):
    data = [("s", ion, 1.0, "") for ion in ("CA", "mg", "cl", "hco3", "so4", "na+k")] + [("s", "ca", 99.0, "Not Detected"), ("s", "ca", None, None)]
    values = balance.ion_values(spark.createDataFrame(data, BALANCE))
    wide = balance.concentrations(values).first()
    assert (wide.ca, wide.na_k, wide.na) == (1.0, 1.0, None)
    assert balance.charge_balance(spark.createDataFrame(data, BALANCE)).count() == 3


def test_mean_of_duplicates_and_derived_alkalis(spark):
    df = samples(spark, a=[("ca", 0), ("ca", 1), ("ca", 2)], b=[("na", 2), ("na+k", 5)], c=[("k", 2), ("na+k", 5)], d=[("k", 2)], e=[("na+k", 5)])
    out = {r.SampleId: r for r in balance.derive_alkalis(balance.concentrations(balance.ion_values(df))).collect()}
    assert out["a"].ca == 1
    alkalis = {s: (out[s].sodium, out[s].potassium, out[s].alkali_sum) for s in "bcde"}
    assert alkalis == {"b": (2, 3, 0), "c": (3, 2, 0), "d": (None, 2, 0), "e": (None, None, 5)}


def test_balance_of_zero_sum(spark):
    zero = [(p, 0) for p in ("ca", "mg", "cl", "hco3", "so4", "na")]
    got = {r.Param: r.ResultValue for r in balance.charge_balance(samples(spark, z=zero)).collect()}
    assert got == {"Charge Balance": 0.0, "Cation Total": 0.0, "Anions Total": 0.0}


def test_projection_goldens(spark):
    df = spark.createDataFrame([(1, -114.0, 40.0), (2, -114.0, 42.0), (3, 114.0, 40.0), (4, None, 40.0)], "i int, lon double, lat double")
    got = {r.i: (r.utm_x, r.utm_y) for r in spatial.reproject_points(df, "lon", "lat").collect()}
    assert got[1] == pytest.approx((243900.35202798274, 4432069.056784666), abs=1e-5)
    assert got[2] == pytest.approx((251535.07928578724, 4654130.8912068475), abs=1e-5)
    assert got[3] == got[1] and got[4] == (None, None)


def test_shape_rules(spark):
    df = spark.createDataFrame([(1, -114.0, 40.0), (2, 0.0, 40.0), (3, None, 40.0), (4, -114.0, 0.0)], "i int, Lon_X double, Lat_Y double")
    got = {r.i: r.Shape for r in spatial.add_shape(df).collect()}
    assert got[1].startswith("POINT (243900.35") and [got[i] for i in (2, 3, 4)] == [None] * 3
    xy = df.withColumns({"point_x": F.lit(-114.0), "point_y": F.lit(40.0)})
    out = spatial.add_shape(xy)
    assert "point_x" not in out.columns and {r.Shape for r in out.collect()} == {got[1]}


def test_county_with_hole_and_neighbour(spark):
    def ring(*points):
        return [{"x": float(x), "y": float(y)} for x, y in points]

    counties = spark.createDataFrame(
        [
            (49, 1, [ring((-112, 39), (-110, 39), (-110, 41), (-112, 41)), ring((-111.5, 39.5), (-110.5, 39.5), (-110.5, 40.5), (-111.5, 40.5))]),
            (49, 2, [ring((-110, 39), (-109, 39.3), (-109, 41), (-110, 41))]),
        ],
        "state_code int, county_code int, rings array<array<struct<x: double, y: double>>>")
    points = [(1, -111.9, 39.1, None, None), (2, -111.0, 40.0, None, 7), (3, -110.0, 40.0, 4, None), (4, -109.5, 40.0, 8, 9), (5, 109.5, 40.0, None, None), (6, None, 40.0, None, 3)]
    stations = spark.createDataFrame(points, "Id int, Lon_X double, Lat_Y double, StateCode int, CountyCode int")
    out = spatial.fill_county(stations, counties)
    got = {r.Id: (r.StateCode, r.CountyCode) for r in out.collect()}
    assert got == {1: (49, 1), 2: (None, None), 3: (49, 2), 4: (8, 9), 5: (49, 2), 6: (None, None)}


TWINS = ["UTAHDWQ_WQX-4904410", "UTAHDWQ-4904640", "UTAHDWQ_WQX-4904640", "UTAHDWQ-4904610", "UTAHDWQ_WQX-4904610", "UTAHDWQ-4904490", "UTAHDWQ-4904410"]


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "StationId string")


def test_twins(spark):
    stations = ids(spark, *TWINS)
    assert rows(dedupe.twin_ids(stations)) == [("UTAHDWQ-4904410",), ("UTAHDWQ-4904610",), ("UTAHDWQ-4904640",)]
    assert rows(dedupe.drop_twins(stations)) == sorted([(s,) for s in TWINS if "_WQX" in s] + [("UTAHDWQ-4904490",)])


@pytest.mark.parametrize(
    "new, stored, want",
    [
        (["123_WQX-ABC", "1234"], [], ["123_WQX-ABC"]),
        (["123", "1234"], ["1234"], ["123", "1234"]),
        (["123_WQX-ABC", "123-ABC"], [], ["123-ABC", "123_WQX-ABC"]),
        (["123_WQX-ABC", "1234"], ["123-ABC"], []),
    ],
)
def test_remove_stored_twins(spark, new, stored, want):
    assert rows(dedupe.remove_stored_twins(ids(spark, *new), ids(spark, *stored))) == [(w,) for w in want]


@pytest.mark.parametrize("share", [3, 300])
def test_hot_keys_are_split_while_joined(spark, share):
    """Also a key that holds a small share of the rows, and the rows without a key."""
    n = 400_000
    left = spark.range(n).select(
        F.when(F.col("id") % share == 0, "hot").when(F.col("id") % share == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.repeat(F.col("id").cast("string"), 8).alias("filler"),
    )
    keys = spark.createDataFrame([("hot", 1), ("hot", 2), ("k5", 2), ("other", 4), (None, 5)], "k string, v int")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "199",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = -(-n // share)
        for got, want in ((skew.keep_known(left, keys, "k"), hot + 1), (skew.keep_new(left, keys, "k"), n - hot - 1)):
            assert got.columns == left.columns
            assert got.groupBy().agg(F.count(F.lit(1))).first()[0] == want
            counts = got.groupBy("k").agg(F.max("filler"))  # reuses the join's partitioning, so a split needs a shuffle more
            counts.collect()
            assert "skew=true" in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("sep", ["/", "-", "."])
@pytest.mark.parametrize("month", ["1", "01", "12"])
@pytest.mark.parametrize("day", ["2", "02", "13", "31"])
def test_dates_in_every_layout(spark, sep, month, day):
    want = datetime.date(2011, int(month), int(day))
    texts = [f"2011{sep}{month}{sep}{day}", f"{month}{sep}{day}{sep}2011", f"{month}{sep}{day}{sep}11"]
    if int(day) > 12:
        texts.append(f"{day}{sep}{month}{sep}2011")
    texts += [f"{t}{clock}" for t in texts for clock in (" 5:30", " 05:30:10", "T05:30:10.5", " 5:30 PM")]
    texts.append(f"2011{int(month):02}{int(day):02}")
    cells = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = cells.select("t", casting.to_timestamp(F.col("t"), F.lit("2020-01-01").cast("timestamp_ntz")).cast("date").alias("d"))
    wrong = {r.t: r.d for r in parsed.collect() if r.d != want}
    # a clock with T before am / pm, or after two digits of year, is no layout of ISO text
    assert not wrong


def test_instants_are_read_in_utc(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Denver")
        df = spark.sql("SELECT timestamp'2011-01-02 03:00:00 UTC' AS ConstDate")
        out = columns.cast_to_schema(df, [S.Field("ConstDate", "date")], AS_OF)
        assert out.select(F.col("ConstDate").cast("date")).first()[0] == datetime.date(2011, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_windows_of_typed_dates_reach_the_scan(spark, tmp_path):
    day = datetime.date(2011, 1, 2)
    df = spark.createDataFrame([("a", day), ("b", datetime.date(2012, 1, 1)), ("c", None)], "SampleId string, SampleDate date")
    df.write.parquet(f"{tmp_path}/d")
    got = wqp.results_window(spark.read.parquet(f"{tmp_path}/d"), day, day)
    assert [r.SampleId for r in got.collect()] == ["a"]
    assert "GreaterThanOrEqual(SampleDate,2011-01-02)" in got._jdf.queryExecution().executedPlan().toString()
    for kind in ("timestamp_ntz", "timestamp", "string"):
        cast = spark.read.parquet(f"{tmp_path}/d").withColumn("SampleDate", F.col("SampleDate").cast(kind))
        assert [r.SampleId for r in wqp.results_window(cast, day, day).collect()] == ["a"]


def test_both_fills_use_one_longitude(spark):
    fields = "Id int, Lon_X double, Lat_Y double, StateCode int, CountyCode int, Elev double, ElevUnit string, ElevMeth string"
    stations = spark.createDataFrame([(1, 110.5, 40.5, None, None, None, None, None)], fields)
    county = spark.createDataFrame(
        [(49, 7, [[{"x": -111.0, "y": 40.0}, {"x": -110.0, "y": 40.0}, {"x": -110.0, "y": 41.0}, {"x": -111.0, "y": 41.0}]])],
        "state_code int, county_code int, rings array<array<struct<x: double, y: double>>>")
    grid = spark.createDataFrame([(-111, 40, 5.0)], "cell_x bigint, cell_y bigint, elevation double")
    r = jobs.processed_stations(stations, county, grid, cell=1.0).first()
    assert (r.CountyCode, r.Elev) == (7, 5.0)


def test_new_rows_are_stable(spark):
    results = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "SampleId string, n int")
    stored = spark.createDataFrame([("a",)], "SampleId string")
    fresh = dedupe.new_results_by_sample(results, stored)
    assert rows(fresh) == [("b", 2), (None, 3)] == rows(dedupe.new_results_by_sample(fresh, stored))


def test_watermark(spark):
    stored = spark.createDataFrame([("WQP", datetime.date(2020, 1, 2)), ("WQP", datetime.date(2019, 1, 2))], "DataSource string, SampleDate date")
    assert incremental.watermark(stored, "WQP") == datetime.date(2020, 1, 2)
    with pytest.raises(ValueError, match="seed"):
        incremental.watermark(stored, "SDWIS")


def test_trim_and_casting_have_no_python_worker(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("s"))
    plan = df.select(trimmed(F.col("s")), casting.to_time(F.col("s")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
