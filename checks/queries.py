"""One query per operator, over whole tables.

Results are made comparable across engines at the very end: dates become ISO
text and doubles that are not rounded by the operator itself are rounded.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring import keyindex, ledger, sinks, sqlcsv
from wellspring.functions.text import strip_twin_mark
from wellspring.model import schema as S
from wellspring.operators import balance, columns, dedupe, incremental, normalize, spatial
from wellspring.plans import jobs, loads
from wellspring.plans.tails import detail_results, transform_results, transform_stations
from wellspring.session import scratch_dir, temporary
from wellspring.sources import exported, sdwis, wqp
from wellspring.sources.csvfiles import read_text_csv, write_csv, write_typed_csv
from wellspring.streaming import ingest as streaming

from . import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WINDOW = ("1996-01-01", "1998-12-31")
SINCE = "1998-06-30"
DIGITS = 6


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def flat(df: DataFrame, digits: int | None = DIGITS) -> DataFrame:
    """Dates as text, decimals as doubles, doubles rounded."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("date").cast("string")
        elif isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            c = c.cast("double")
            c = F.round(c, digits) + 0.0 if digits is not None else c
        out.append(c.alias(f.name))
    return df.select(*out)


def raw_results(spark, sf):
    return V.view(spark, sf, V.RAW_RESULTS)


def raw_stations(spark, sf):
    return V.view(spark, sf, V.RAW_STATIONS)


def typed_stations(spark, sf):
    return columns.cast_to_schema(raw_stations(spark, sf), S.STATION, V.as_of())


def cast_results(spark, sf):
    return columns.cast_to_schema(raw_results(spark, sf), S.RESULT, V.as_of())


def detail(spark, sf):
    return detail_results(raw_results(spark, sf), "WQP", V.as_of())


# --- charge balance -----------------------------------------------------------


@query
def charge_balance(spark, sf):
    return balance.charge_balance(detail(spark, sf))


@query
def charge_balance_by_file(spark, sf):
    return balance.charge_balance(detail(spark, sf), ("source_file", "SampleId"))


@query
def charge_balance_unrounded(spark, sf):
    return flat(balance.sample_totals(detail(spark, sf)), 9)


@query
def ion_values(spark, sf):
    return flat(balance.ion_values(detail(spark, sf)))


@query
def analyte_pivot(spark, sf):
    return flat(balance.concentrations(balance.ion_values(detail(spark, sf))))


@query
def duplicate_mean(spark, sf):
    return flat(balance.mean_values(balance.ion_values(detail(spark, sf))))


@query
def nak_derivation(spark, sf):
    wide = balance.derive_alkalis(balance.concentrations(balance.ion_values(detail(spark, sf))))
    return flat(wide.select("SampleId", "sodium", "potassium", "alkali_sum"))


@query
def merge_concentrations(spark, sf):
    """Lab results and the drinking-water measurements of one key space."""
    own = balance.ion_values(detail(spark, sf))
    other = detail_results(V.view(spark, sf, V.EXPORTED_RESULTS), "UDOGM", V.as_of())
    other = balance.ion_values(other).withColumn("SampleId", F.replace("SampleId", F.lit("E-"), F.lit("S-")))
    return flat(balance.concentrations(balance.merge_concentrations(own, other)))


# --- casts and projections ------------------------------------------------------


@query
def cast_strings(spark, sf):
    return cast_results(spark, sf).select("SampleId", "StationId", "LabName", "ProjectId", "DetectCond")


@query
def cast_numbers(spark, sf):
    return flat(cast_results(spark, sf).select("SampleId", "ResultValue", "MDL", "IdNum", "Chrg"))


@query
def cast_dates(spark, sf):
    return flat(cast_results(spark, sf).select("SampleId", "SampleDate"))


@query
def cast_times(spark, sf):
    return cast_results(spark, sf).select("SampleId", "SampleTime")


@query
def rename_columns(spark, sf):
    source_names = {new: old for old, new in S.WQP_RESULT_COLUMNS.items()}
    landed = raw_results(spark, sf).withColumnsRenamed(source_names)
    return columns.rename_columns(landed, S.WQP_RESULT_COLUMNS)


@query
def reorder_filter(spark, sf):
    return flat(columns.reorder_to_schema(V.view(spark, sf, V.EXPORTED_RESULTS), S.RESULT))


@query
def field_intersection(spark, sf):
    return flat(exported.shared(V.view(spark, sf, V.EXPORTED_RESULTS), S.RESULT))


@query
def typed_write(spark, sf):
    stations = columns.cast_to_schema(raw_stations(spark, sf), S.STATION, V.as_of())
    stored = columns.to_storage(stations, S.STATION)
    return flat(stored.select("StationId", "Lon_X", "Lat_Y", "ConstDate", "StateCode", "CountyCode", "Elev"))


# --- harmonisation ----------------------------------------------------------------


@query
def strip_wqx(spark, sf):
    stations = raw_stations(spark, sf)
    return stations.select(F.col("StationId").alias("raw_id"), normalize.strip_twin_mark(F.col("StationId")).alias("StationId"))


@query
def station_type(spark, sf):
    cast = columns.cast_to_schema(raw_stations(spark, sf), S.STATION, V.as_of())
    return normalize.normalize_station(cast).select("StationId", "StationType")


@query
def sample_media(spark, sf):
    return normalize.normalize_media(raw_results(spark, sf)).select("SampleId", "SampMedia")


@query
def unit_rules(spark, sf):
    ruled = normalize.apply_unit_rules(cast_results(spark, sf))
    return flat(ruled.select("SampleId", "Param", "Unit", "ResultValue"))


@query
def param_group(spark, sf):
    ruled = normalize.apply_unit_rules(cast_results(spark, sf))
    return normalize.add_param_group(ruled).select("SampleId", "Param", "ParamGroup")


@query
def param_group_from_table(spark, sf):
    """Groups the user supplies: here the type of the part named like them."""
    types = V.view(spark, sf, f"SELECT lower({V._ION}) AS param, p_type AS param_group FROM {{part}}")
    ruled = normalize.apply_unit_rules(cast_results(spark, sf))
    return normalize.add_param_group(ruled, types).select("SampleId", "Param", "ParamGroup")


@query
def normalize_results(spark, sf):
    keep = ["SampleId", "StationId", "Param", "ParamGroup", "Unit", "ResultValue", "SampMedia", "DetectCond"]
    return flat(normalize.normalize_results(cast_results(spark, sf)).select(*keep))


# --- drinking-water database ------------------------------------------------------


@query
def sdwis_results(spark, sf):
    return flat(sdwis.results(V.sdwis_tables(spark, sf)))


@query
def sdwis_results_since(spark, sf):
    return flat(sdwis.results(V.sdwis_tables(spark, sf), SINCE))


@query
def sdwis_results_by_key(spark, sf):
    keys = V.view(spark, sf, V.STORED_SDWIS)
    return flat(sdwis.results_by_key(V.sdwis_tables(spark, sf), keys))


@query
def sdwis_results_by_sample(spark, sf):
    ids = V.view(spark, sf, V.STORED_SDWIS)
    return flat(sdwis.results_by_sample(V.sdwis_tables(spark, sf), ids))


@query
def sdwis_sample_ids(spark, sf):
    return sdwis.sample_ids(V.sdwis_tables(spark, sf))


@query
def sdwis_stations(spark, sf):
    return flat(sdwis.stations(V.sdwis_tables(spark, sf)))


@query
def sdwis_stations_by_id(spark, sf):
    return flat(sdwis.stations(V.sdwis_tables(spark, sf), V.view(spark, sf, V.STORED_SDWIS_STATIONS)))


# --- exported tables ----------------------------------------------------------------


@query
def exported_sample_ids(spark, sf):
    return exported.sample_ids(V.view(spark, sf, V.EXPORTED_RESULTS))


@query
def exported_results_by_sample(spark, sf):
    results = exported.shared(V.view(spark, sf, V.EXPORTED_RESULTS), S.RESULT)
    ids = V.view(spark, sf, "SELECT 'E-' || CAST(c_custkey AS STRING) AS SampleId FROM {customer} WHERE c_acctbal < 0")
    return flat(exported.results_by_sample(results, ids))


# --- new and duplicate rows -----------------------------------------------------------


@query
def distinct_sample_ids(spark, sf):
    return dedupe.distinct_ids(raw_results(spark, sf), "SampleId")


@query
def distinct_station_ids(spark, sf):
    return dedupe.distinct_ids(raw_results(spark, sf), "StationId")


@query
def new_stations(spark, sf):
    return dedupe.new_station_ids(raw_stations(spark, sf), V.view(spark, sf, V.STORED_STATIONS))


@query
def new_results_by_sample(spark, sf):
    fresh = dedupe.new_results_by_sample(raw_results(spark, sf), V.view(spark, sf, V.STORED_RESULTS))
    return fresh.select("SampleId", "StationId", "Param", "ResultValue", "SampleDate")


@query
def new_results_by_key(spark, sf):
    results = sdwis.results(V.sdwis_tables(spark, sf))
    fresh = dedupe.new_results_by_key(results, V.view(spark, sf, V.STORED_SDWIS))
    return flat(fresh.select("SampleDate", "SampleId", "Param", "StationId", "IdNum", "ResultValue"))


@query
def drop_wqx_twins(spark, sf):
    return dedupe.drop_twins(raw_stations(spark, sf), ("source_file",)).select("StationId", "Id", "source_file")


@query
def wqx_twin_ids(spark, sf):
    return dedupe.twin_ids(raw_stations(spark, sf))


@query
def remove_stored_wqx(spark, sf):
    ids = dedupe.distinct_ids(raw_stations(spark, sf), "StationId")
    return dedupe.remove_stored_twins(ids, V.view(spark, sf, V.STORED_STATIONS))


@query
def stations_by_id(spark, sf):
    found = dedupe.stations_by_id(raw_stations(spark, sf), V.view(spark, sf, V.STORED_STATIONS))
    return found.select("StationId", "Id", "StationName")


# --- incremental load --------------------------------------------------------------


@query
def watermark(spark, sf):
    stored = V.view(spark, sf, V.STORED_RESULTS).select("DataSource", "SampleDate")
    other = V.view(spark, sf, V.STORED_SDWIS).select("DataSource", "SampleDate")
    return flat(incremental.watermarks(stored.unionByName(other)))


@query
def group_by_sample(spark, sf):
    return incremental.sample_index(raw_results(spark, sf))


@query
def group_by_key(spark, sf):
    return flat(incremental.key_index(sdwis.results(V.sdwis_tables(spark, sf))))


@query
def distinct_params(spark, sf):
    return incremental.distinct_params(detail(spark, sf))


@query
def window_bbox(spark, sf):
    """Results of a span of days at stations inside the service's box."""
    window = wqp.results_window(raw_results(spark, sf), *WINDOW)
    inside = wqp.stations_in_box(raw_stations(spark, sf))
    return dedupe.keep_known(window, inside, "StationId").select("SampleId", "StationId", "SampleDate", "Param")


# --- spatial -----------------------------------------------------------------------


@query
def reproject(spark, sf):
    stations = columns.cast_to_schema(raw_stations(spark, sf), S.STATION, V.as_of())
    placed = spatial.reproject_points(stations, "Lon_X", "Lat_Y").where("Lat_Y IS NOT NULL AND Lon_X <> 0")
    return flat(placed.select("StationId", "utm_x", "utm_y"), 3)


@query
def station_shape(spark, sf):
    """Shape from Lon_X / Lat_Y, or no shape; the text is taken apart again."""
    stations = columns.cast_to_schema(raw_stations(spark, sf), S.STATION, V.as_of())
    return _shape_numbers(spatial.add_shape(stations).select("StationId", "Shape"))


@query
def exported_shape(spark, sf):
    """Shape from the explicit point of an export."""
    stations = exported.shared(V.view(spark, sf, V.EXPORTED_STATIONS), S.STATION, point=True)
    return _shape_numbers(spatial.add_shape(stations).select("StationId", "Shape"))


def _shape_numbers(df: DataFrame) -> DataFrame:
    number = r"POINT \((-?[0-9.E]+) (-?[0-9.E]+)\)"
    df = df.withColumns({f"shape_{n}": F.regexp_extract("Shape", number, i).try_cast("double") for i, n in ((1, "x"), (2, "y"))})
    return flat(df.drop("Shape"), 3)


@query
def utm_box(spark, sf):
    stations = columns.cast_to_schema(raw_stations(spark, sf), S.STATION, V.as_of())
    placed = spatial.add_shape(stations, keep_xy=True)
    return spatial.within_metres(placed, (138131.8383, 3955431.5674, 832275.2803, 4750305.616)).select("StationId")


@query
def county_fill(spark, sf):
    stations = typed_stations(spark, sf)
    filled = spatial.fill_county(stations, V.counties(spark, sf))
    return filled.select("Id", "StationId", "StateCode", "CountyCode")


@query
def elevation_fill(spark, sf):
    stations = typed_stations(spark, sf)
    filled = spatial.fill_elevation(stations, V.view(spark, sf, V.ELEVATION), 0.5)
    return flat(filled.select("Id", "StationId", "Elev", "ElevUnit", "ElevMeth"))


@query
def elevation_tiles(spark, sf):
    """Elevations between the samples of a grid packed into tiles."""
    tiles = spatial.elevation_tiles(V.view(spark, sf, V.ELEVATION), 4)
    filled = spatial.fill_elevation_from_tiles(typed_stations(spark, sf), tiles, 0.5, 4)
    return flat(filled.select("Id", "StationId", "Elev", "ElevUnit", "ElevMeth"))


# --- whole loads ---------------------------------------------------------------------

RESULT_COLUMNS = [f.name for f in S.RESULT]
STATION_COLUMNS = [f.name for f in S.STATION if f.name != "Shape"]


def _results(df: DataFrame) -> DataFrame:
    return flat(df.select(*RESULT_COLUMNS), 4)


def _stations(df: DataFrame) -> DataFrame:
    return _shape_numbers(df.select(*STATION_COLUMNS, "Shape"))


@query
def transform_results_tail(spark, sf):
    return _results(transform_results(raw_results(spark, sf), "WQP", V.as_of()))


@query
def transform_stations_tail(spark, sf):
    return _stations(transform_stations(raw_stations(spark, sf), "WQP", V.as_of()))


def wqp_load(spark, sf):
    return loads.wqp_seed(raw_stations(spark, sf), raw_results(spark, sf), V.as_of())


@query
def seed_wqp(spark, sf):
    return _results(wqp_load(spark, sf).results)


@query
def seed_wqp_stations(spark, sf):
    return _stations(wqp_load(spark, sf).stations)


def sdwis_load(spark, sf):
    return loads.sdwis_seed(V.sdwis_tables(spark, sf), V.as_of())


@query
def seed_sdwis(spark, sf):
    return _results(sdwis_load(spark, sf).results)


@query
def seed_sdwis_stations(spark, sf):
    return _stations(sdwis_load(spark, sf).stations)


def exported_load(spark, sf, name="DOGM"):
    program = exported.PROGRAMS[name]
    return loads.exported_seed(
        exported.shared(V.view(spark, sf, V.EXPORTED_STATIONS), S.STATION, point=True),
        exported.shared(V.view(spark, sf, V.EXPORTED_RESULTS), S.RESULT),
        program,
        V.as_of(),
    )


@query
def seed_exported(spark, sf):
    return _results(exported_load(spark, sf).results)


@query
def seed_exported_stations(spark, sf):
    return _stations(exported_load(spark, sf).stations)


@query
def seed_all(spark, sf):
    """Rows, samples and balance rows every source would append."""
    parts = [wqp_load(spark, sf), sdwis_load(spark, sf), *(exported_load(spark, sf, name) for name in exported.PROGRAMS)]
    everything = reduce(DataFrame.unionByName, (part.results for part in parts))
    return everything.groupBy("DataSource").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("ResultValue").alias("n_values"),
        F.countDistinct("SampleId").alias("n_samples"),
    )


def wqp_updates(spark, sf):
    import datetime

    return loads.wqp_update(
        raw_stations(spark, sf),
        raw_results(spark, sf),
        V.view(spark, sf, V.STORED_STATIONS),
        V.view(spark, sf, V.STORED_RESULTS),
        today=datetime.date(2024, 1, 1),
        as_of=V.as_of(),
    )


@query
def update_wqp(spark, sf):
    return _results(wqp_updates(spark, sf).results)


@query
def update_wqp_stations(spark, sf):
    return _stations(wqp_updates(spark, sf).stations)


def sdwis_updates(spark, sf):
    return loads.sdwis_update(
        V.sdwis_tables(spark, sf), V.view(spark, sf, V.STORED_SDWIS_STATIONS), V.view(spark, sf, V.STORED_SDWIS), V.as_of()
    )


@query
def update_sdwis(spark, sf):
    return _results(sdwis_updates(spark, sf).results)


@query
def update_sdwis_stations(spark, sf):
    return _stations(sdwis_updates(spark, sf).stations)


@query
def update_exported_deduped(spark, sf):
    stored = V.view(spark, sf, "SELECT 'E-' || CAST(c_custkey AS STRING) AS SampleId FROM {customer} WHERE c_acctbal < 5000")
    stations = V.view(spark, sf, "SELECT 'DOGM-' || CAST(s_suppkey AS STRING) AS StationId FROM {supplier} WHERE s_acctbal < 0")
    return _results(loads.only_new(exported_load(spark, sf), stations, stored).results)


@query
def post_process(spark, sf):
    grid = V.view(spark, sf, V.ELEVATION)
    filled = jobs.processed_stations(typed_stations(spark, sf), V.counties(spark, sf), grid, cell=0.5)
    return flat(filled.select("Id", "StationId", "StateCode", "CountyCode", "Elev", "ElevUnit", "ElevMeth"))


# --- landed files and stored tables --------------------------------------------------


def _as_landed(df, mapping, path: str) -> None:
    """A view written as the CSV extract a source would deliver."""
    write_csv(df.withColumnsRenamed({new: old for old, new in mapping.items()}), path)


def _no_blanks(df: DataFrame) -> DataFrame:
    """CSV does not tell an empty text from a missing one."""
    return df.select(*(F.nullif(F.col(c), F.lit("")).alias(c) for c in df.columns))


@query
def read_wqp_results(spark, sf):
    """The landed result extract, read from its folder."""
    root = scratch_dir(spark, "landed")
    _as_landed(V.view(spark, sf, V.LANDED), S.WQP_RESULT_COLUMNS, f"{root}/WQP/Results")
    return _no_blanks(wqp.read_results(spark, root).drop("source_file"))


@query
def read_wqp_stations(spark, sf):
    """The landed station extract, read from its folder."""
    root = scratch_dir(spark, "landed")
    _as_landed(raw_stations(spark, sf).drop("Id", "source_file"), S.WQP_STATION_COLUMNS, f"{root}/WQP/Stations")
    return _no_blanks(wqp.read_stations(spark, root).drop("source_file"))


def _database(spark) -> str:
    """A new database with the three empty tables."""
    db = f"wellspring_{uuid.uuid4().hex}"
    sinks.create_tables(spark, db)
    return db


@query
def stored_results(spark, sf):
    """Result rows appended in two parts and read from the table."""
    db = _database(spark)
    raw = raw_results(spark, sf)
    for part in ("file-f", "file-o"):
        sinks.append_results(detail_results(raw.where(F.col("source_file") == part), "WQP", V.as_of()), db)
    rows = spark.table(sinks.table(db, sinks.RESULTS)).where("Id IS NOT NULL")
    # Brought together by Id first: the wide rows are then sorted once and not, in vain,
    # before the shuffle as well.
    return _results(rows.repartition("Id").dropDuplicates(["Id"]))


@query
def stored_params(spark, sf):
    """Parameters rebuilt from the stored results, by SQL over the tables."""
    db = _database(spark)
    sinks.append_results(detail(spark, sf), db)
    sinks.refresh_params(spark, db)
    sinks.refresh_params(spark, db)  # a rebuild, not an addition
    params, results = sinks.table(db, sinks.PARAMS), sinks.table(db, sinks.RESULTS)
    return sqlcsv.query_tables(
        spark, [f"SELECT count(*) FROM {params}", f"SELECT Param, count(*) AS n FROM {params} JOIN {results} USING (Param) GROUP BY Param"]
    )


@query
def stored_stations(spark, sf):
    """Stations appended, then rewritten in place by the post-processing job."""
    db = _database(spark)
    sinks.append_stations(transform_stations(raw_stations(spark, sf), "WQP", V.as_of()), db)
    jobs.post_process(spark, db, V.counties(spark, sf), V.view(spark, sf, V.ELEVATION), cell=0.5)
    return _stations(spark.table(sinks.table(db, sinks.STATIONS)))


# --- SQL over CSV and streams --------------------------------------------------------


@query
def query_csv(spark, sf):
    """Join two CSV tables written from the event log and the customers."""
    base = scratch_dir(spark, "csv")
    write_csv(V.view(spark, sf, V.LANDED), f"{base}/landed.csv")
    people = V.view(spark, sf, "SELECT 'E-' || CAST(c_custkey AS STRING) AS id, c_name, c_mktsegment FROM {customer}")
    write_csv(people, f"{base}/people.csv")
    return sqlcsv.query_csv(
        spark,
        """SELECT p.c_mktsegment, l.Param, l.ResultComment, count(*) AS n, max(l.ResultValue) AS largest_text
           FROM landed AS l JOIN people AS p ON l.SampleId = p.id GROUP BY p.c_mktsegment, l.Param, l.ResultComment""",
        [f"{base}/landed.csv", f"{base}/people.csv"],
    )


@query
def query_csv_statements(spark, sf):
    """Several statements in order; the last one's result counts."""
    base = scratch_dir(spark, "csv")
    write_csv(V.view(spark, sf, V.LANDED), f"{base}/landed.csv")
    return sqlcsv.query_csv(
        spark,
        [
            "SELECT count(*) FROM landed",
            "SELECT StationId, min(SampleId) AS first_id, count(DISTINCT SampleId) AS n FROM landed "
            "WHERE Param LIKE 'S%' GROUP BY StationId",
        ],
        [f"{base}/landed.csv"],
    )


@query
def query_csv_any_case(spark, sf):
    """LIKE in another case than the data's."""
    base = scratch_dir(spark, "csv")
    write_csv(V.view(spark, sf, V.LANDED), f"{base}/landed.csv")
    return sqlcsv.query_csv(
        spark, "SELECT StationId, count(*) AS n FROM landed WHERE Param LIKE 's%M' GROUP BY StationId", [f"{base}/landed.csv"], ignore_case=True
    )


@query
def typed_csv(spark, sf):
    """A result with numbers, texts and dates written as CSV and read back, and how many
    of its cells are bare."""
    base = scratch_dir(spark, "csv")
    rows = columns.to_storage(cast_results(spark, sf), S.RESULT).select("SampleId", "Param", "ResultValue", "SampleDate", "IdNum")
    write_typed_csv(rows, f"{base}/results.csv")
    lines = spark.read.text(f"{base}/results.csv").where(~F.startswith("value", F.lit('"SampleId"')))
    bare = lines.select(F.regexp_count("value", F.lit(r'(^|,)-?[0-9][0-9.E]*(?=,|$)')).alias("n")).agg(F.sum("n")).scalar()
    back = _no_blanks(read_text_csv(spark, f"{base}/results.csv"))
    back = back.withColumns({"ResultValue": F.col("ResultValue").cast("double"), "IdNum": F.col("IdNum").cast("bigint")})
    return flat(back.groupBy("Param").agg(F.count(F.lit(1)).alias("n"), F.sum("ResultValue").alias("total"), F.min("SampleDate").alias("first"), F.sum("IdNum").alias("ids")).withColumn("bare", bare))


@query
def stream_ingest(spark, sf):
    """The landed extract taken as a file stream, less the stored samples. The files
    differ in the order of their columns."""
    base = scratch_dir(spark, "stream")
    source_names = {new: old for old, new in S.WQP_RESULT_COLUMNS.items()}
    landed = V.view(spark, sf, V.LANDED).withColumnsRenamed(source_names)
    # A sample's rows must arrive together for its balance.
    landed = landed.repartition("ActivityIdentifier")
    other = F.crc32("ActivityIdentifier") % 2 == 0
    write_csv(landed.where(other), f"{base}/landing")
    write_csv(landed.where(~other).select(*reversed(landed.columns)), f"{base}/landing", "append")
    read, append = streaming.parquet_target(spark, f"{base}/results")
    stored = V.view(spark, sf, V.STORED_LANDED)
    streaming.ingest(
        streaming.result_stream(spark, f"{base}/landing", landed.columns),
        f"{base}/checkpoint",
        "WQP",
        lambda: read().select("SampleId").unionByName(stored),
        append,
        V.as_of(),
    )
    return flat(read().select("DataSource", "SampleId", "StationId", "Param", "ResultValue", "Unit", "SampleDate", "ResultComment"), 4)


# --- the jobs over stored tables -------------------------------------------------------


def _land(df: DataFrame, mapping, folder: str, by: str | None = None, together: Column | None = None, compression: str = "none") -> None:
    """An extract as CSV files, each written by a task of its own; with ``by`` the files
    hold rows of one of its values, and their names replace it. Rows that agree in
    ``together`` are in one file then, since twins and balances are judged per file."""
    source_names = {new: old for old, new in mapping.items()}
    with temporary(df.sparkSession):
        if by is None:
            write_csv(df.withColumnsRenamed(source_names), folder, "append", compression)
            return
        landed = df.withColumn("_together", together).withColumnsRenamed(source_names)
        for r in landed.select(by).distinct().collect():
            part = landed.where(F.col(by) == r[0]).drop(by)
            write_csv(part.repartition("_together").drop("_together"), folder, "append", compression)


@query
def read_split_csv(spark, sf):
    """Large files whose fields hold line breaks, each read by several tasks."""
    root = scratch_dir(spark, "landed")
    _land(raw_results(spark, sf).drop("source_file"), S.WQP_RESULT_COLUMNS, f"{root}/WQP/Results")
    return _no_blanks(wqp.read_results(spark, root).drop("source_file"))


@query
def stored_keys(spark, sf):
    """Stored keys of the given samples, found by the index over two loads."""
    db = _database(spark)
    stored = V.view(spark, sf, V.STORED_SDWIS)
    early = F.col("SampleDate") < F.lit("1994-01-01").cast("date")
    for part in (stored.where(early), stored.where(~early)):
        sinks.append_results(part, db)
    asked = sdwis.sample_ids(V.sdwis_tables(spark, sf), SINCE).where("SampleId IS NOT NULL")
    return flat(keyindex.stored_keys(spark, db, asked))


@query
def stored_after_failure(spark, sf):
    """A load that ends before it is entered in the ledger, and its repetition."""
    db = _database(spark)
    rows = detail(spark, sf)
    sinks._write(sinks._numbered(rows, db, sinks.RESULTS), db, sinks.RESULTS, "lost")
    for _ in range(2):  # the second is known to be done
        sinks.append(spark, db, results=rows, task="seed")
    return _results(spark.table(sinks.table(db, sinks.RESULTS)))


@query
def seed_job(spark, sf):
    """All five sources seeded by the job from landed files, exports and the database. The
    text extracts are compressed: as plain text they would take most of the disk."""
    db, root = _database(spark), scratch_dir(spark, "landed")
    _land(raw_results(spark, sf), S.WQP_RESULT_COLUMNS, f"{root}/WQP/Results", "source_file", F.col("SampleId"), "gzip")
    plain = strip_twin_mark(F.col("StationId"))
    _land(raw_stations(spark, sf).drop("Id"), S.WQP_STATION_COLUMNS, f"{root}/WQP/Stations", "source_file", plain, "gzip")
    for program in exported.PROGRAMS.values():
        V.view(spark, sf, V.EXPORTED_STATIONS).write.parquet(f"{root}/{program.name}/{program.station_table}.parquet")
        V.view(spark, sf, V.EXPORTED_RESULTS).write.parquet(f"{root}/{program.name}/{program.result_table}.parquet")
    jobs.seed(spark, db, None, root, V.sdwis_tables(spark, sf), V.as_of())
    return spark.table(sinks.table(db, sinks.RESULTS)).groupBy("DataSource").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("ResultValue").alias("n_values"), F.countDistinct("SampleId").alias("n_samples")
    )


def _updated(spark, db: str, **options) -> tuple[DataFrame, DataFrame]:
    """Stations and results that an update brings; a second one brings none."""
    import datetime

    first = [ledger.next_id(spark, db, name) for name in (sinks.STATIONS, sinks.RESULTS)]
    for _ in range(2):
        jobs.update(spark, db, today=datetime.date(2024, 1, 1), as_of=V.as_of(), **options)
    tables = (spark.table(sinks.table(db, name)) for name in (sinks.STATIONS, sinks.RESULTS))
    return tuple(t.where(F.col("Id") >= n) for t, n in zip(tables, first, strict=True))


def _wqp_job(spark, sf):
    db, root = _database(spark), scratch_dir(spark, "landed")
    sinks.append_stations(V.view(spark, sf, V.STORED_STATIONS), db)
    sinks.append_results(V.view(spark, sf, V.STORED_RESULTS), db)
    _land(raw_results(spark, sf).drop("source_file"), S.WQP_RESULT_COLUMNS, f"{root}/WQP/Results")
    _land(raw_stations(spark, sf).drop("Id", "source_file"), S.WQP_STATION_COLUMNS, f"{root}/WQP/Stations")
    return _updated(spark, db, sources="WQP", root=root)


@query
def update_job_wqp(spark, sf):
    """The update of stored tables from landed files, by ledger and key index."""
    return _results(_wqp_job(spark, sf)[1])


@query
def update_job_sdwis(spark, sf):
    """The same from the database."""
    db = _database(spark)
    sinks.append_stations(V.view(spark, sf, V.STORED_SDWIS_STATIONS), db)
    sinks.append_results(V.view(spark, sf, V.STORED_SDWIS), db)
    return _results(_updated(spark, db, sources="SDWIS", sdwis_tables=V.sdwis_tables(spark, sf))[1])
