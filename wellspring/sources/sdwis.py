"""The drinking-water database: nine tables joined into results and stations.

Tables come as a mapping from their lower-case name to a DataFrame, read by JDBC
or from Parquet exports. All joins are plain equi joins without hints: Spark
pushes the filters and columns into the scans, broadcasts the tables whose size
allows it, and splits skewed partitions of the others.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import few_copies, keep_known

TAG = "SDWIS"
TABLES = ("tinwsf", "tinwsys", "tinloc", "tsasmppt", "tsasampl", "tsasar", "tsaanlyt", "tsalab", "tinwlcas")
# Facility types that count as stations (spring, well, intake, ...).
STATION_TYPE_CODES = ("SP", "WL", "IN", "SS")

# Target field -> table column of the result extract.
RESULT_COLUMNS = {
    "SampleDate": "tsasampl.COLLLECTION_END_DT",
    "SampleId": "tsasampl.LAB_ASGND_ID_NUM",
    "Param": "tsaanlyt.NAME",
    "StationId": "tinwsf.TINWSF_IS_NUMBER",
    "AnalysisDate": "tsasar.ANALYSIS_START_DT",
    "LabName": "tsalab.LAB_ID_NUMBER",
    "MDL": "tsasar.DETECTN_LIMIT_NUM",
    "MDLUnit": "tsasar.DETECTN_LIM_UOM_CD",
    "OrgId": "tinwsys.TINWSYS_IS_NUMBER",
    "OrgName": "tinwsys.NAME",
    "ResultValue": "tsasar.CONCENTRATION_MSR",
    "SampleTime": "tsasampl.COLLCTN_END_TIME",
    "SampMedia": "tinwsf.TYPE_CODE",
    "Unit": "tsasar.UOM_CODE",
    "Lat_Y": "tinloc.LATITUDE_MEASURE",
    "Lon_X": "tinloc.LONGITUDE_MEASURE",
    "CAS_Reg": "tsaanlyt.CAS_REGISTRY_NUM",
    "IdNum": "tsasar.TSASAR_IS_NUMBER",
}
# What a located sample and a measurement bring along.
LOCATED = (
    "tsasampl.TSASAMPL_IS_NUMBER",
    "tsasampl.TSALAB_IS_NUMBER",
    "tsasampl.LAB_ASGND_ID_NUM",
    "tsasampl.COLLLECTION_END_DT",
    "tsasampl.COLLCTN_END_TIME",
    "tinwsf.TINWSF_IS_NUMBER",
    "tinwsf.TINWSYS_IS_NUMBER",
    "tinwsf.TYPE_CODE",
)
MEASUREMENT = (
    "tsasar.TSAANLYT_IS_NUMBER",
    "tsasar.TSASAR_IS_NUMBER",
    "tsasar.ANALYSIS_START_DT",
    "tsasar.DETECTN_LIMIT_NUM",
    "tsasar.DETECTN_LIM_UOM_CD",
    "tsasar.CONCENTRATION_MSR",
    "tsasar.UOM_CODE",
)
# Target field -> table column of the station extract.
STATION_COLUMNS = {
    "OrgId": "tinwsys.TINWSYS_IS_NUMBER",
    "OrgName": "tinwsys.NAME",
    "StationId": "tinwsf.TINWSF_IS_NUMBER",
    "StationName": "tinwsf.NAME",
    "StationType": "tinwsf.TYPE_CODE",
    "Lon_X": "tinloc.LONGITUDE_MEASURE",
    "Lat_Y": "tinloc.LATITUDE_MEASURE",
    "HorAcc": "tinloc.HORIZ_ACCURACY_MSR",
    "HorCollMeth": "tinloc.HZ_COLLECT_METH_CD",
    "HorRef": "tinloc.HORIZ_REF_DATUM_CD",
    "Elev": "tinloc.VERTICAL_MEASURE",
    "ElevAcc": "tinloc.VERT_ACCURACY_MSR",
    "ElevMeth": "tinloc.VER_COL_METH_CD",
    "ElevRef": "tinloc.VERT_REF_DATUM_CD",
    "DepthUnit": "tinwlcas.BOTTOM_DP_MSR_UOM",
}


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Parquet exports, one folder or file per table."""
    return {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet") for name in TABLES}


def read_tables_jdbc(
    spark: SparkSession, url: str, owner: str, partitioning: Mapping[str, Mapping[str, str]] | None = None, **options
) -> dict[str, DataFrame]:
    """The same tables straight from the database, of the schema ``owner``.

    ``partitioning`` has the ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` of each table that shall be read in parallel; other options hold
    for all tables.
    """
    partitioning = partitioning or {}
    return {
        name: spark.read.format("jdbc")
        .options(url=url, dbtable=f"{owner}.{name.upper()}", **options, **partitioning.get(name, {}))
        .load()
        for name in TABLES
    }


def _equals(left: str, right: str):
    return F.col(left) == F.col(right)


def located_samples(tables: Mapping[str, DataFrame], since=None, ids: DataFrame | None = None) -> DataFrame:
    """Samples with their facility, of the wanted types; with ``since``, those collected
    strictly later, and with ``ids`` (SampleId) those of them, which leave before anything
    is joined. A sample has many measurements, so it meets its facility before them."""
    t = {name: tables[name].alias(name) for name in ("tinwsf", "tsasmppt")}
    samples = tables["tsasampl"]
    if ids is not None:
        samples = keep_known(samples, ids.select(F.col("SampleId").alias("LAB_ASGND_ID_NUM")), "LAB_ASGND_ID_NUM")
    if since is not None:
        # Compared as a moment of the column's own type, so the scan can skip files.
        samples = samples.where(F.col("COLLLECTION_END_DT") > F.lit(since).cast("date"))
    joined = (
        samples.alias("tsasampl")
        .join(t["tsasmppt"], _equals("tsasampl.TSASMPPT_IS_NUMBER", "tsasmppt.TSASMPPT_IS_NUMBER"))
        .join(
            t["tinwsf"].where(F.col("TYPE_CODE").isin(*STATION_TYPE_CODES)),
            _equals("tsasmppt.TINWSF0IS_NUMBER", "tinwsf.TINWSF_IS_NUMBER"),
        )
    )
    return joined.select(*LOCATED)


def measured_samples(tables: Mapping[str, DataFrame], located: DataFrame) -> DataFrame:
    """Measurements of located samples, with what is known of these."""
    measurements = tables["tsasar"].where(F.col("CONCENTRATION_MSR").isNotNull())
    joined = measurements.alias("tsasar").join(
        located.alias("located"), _equals("tsasar.TSASAMPL_IS_NUMBER", "located.TSASAMPL_IS_NUMBER")
    )
    return joined.select(*MEASUREMENT, *(f"located.{column.split('.')[1]}" for column in LOCATED))


def results(
    tables: Mapping[str, DataFrame],
    since=None,
    known: DataFrame | None = None,
    ids: DataFrame | None = None,
    keys: DataFrame | None = None,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Result extract; with ``since``, only samples collected strictly later, with
    ``known``, only results whose (SampleDate as a day, SampleId, Param) it lacks, with
    ``keys`` only those it has, and with ``ids`` only those of its samples. ``measured``
    are the measured samples where a caller has them already, cut by ``since`` and
    ``ids``.

    Rows leave before the columns that only widen them are joined.
    """
    t = {name: tables[name].alias(name) for name in ("tinwsys", "tinloc", "tsaanlyt", "tsalab")}
    if measured is None:
        measured = measured_samples(tables, located_samples(tables, since, ids if keys is None else keys))
    joined = measured.alias("measured").join(
        t["tsaanlyt"], _equals("measured.TSAANLYT_IS_NUMBER", "tsaanlyt.TSAANLYT_IS_NUMBER")
    )
    for wanted, how in ((known, "left_anti"), (keys, "left_semi")):
        if wanted is None:
            continue
        day = F.col("SampleDate").cast("date")
        wanted = wanted.select(day.alias("_day"), F.col("SampleId").alias("_sample"), F.col("Param").alias("_param"))
        if since is not None:
            # No result is of an earlier day, so what is left to meet is little.
            wanted = wanted.where(F.col("_day") >= F.lit(since).cast("date"))
        same = (
            (F.col("measured.COLLLECTION_END_DT").cast("date") == F.col("_day"))
            & (F.col("measured.LAB_ASGND_ID_NUM") == F.col("_sample"))
            & (F.col("tsaanlyt.NAME") == F.col("_param"))
        )
        joined = joined.join(few_copies(wanted, wanted.columns), same, how)
    joined = (
        joined.join(t["tinwsys"], _equals("measured.TINWSYS_IS_NUMBER", "tinwsys.TINWSYS_IS_NUMBER"))
        .join(t["tinloc"], _equals("measured.TINWSF_IS_NUMBER", "tinloc.TINWSF_IS_NUMBER"))
        .join(t["tsalab"], _equals("measured.TSALAB_IS_NUMBER", "tsalab.TSALAB_IS_NUMBER"))
    )
    carried = {*LOCATED, *MEASUREMENT}
    return joined.select(
        *(F.col(f"measured.{c.split('.')[1]}" if c in carried else c).alias(field) for field, c in RESULT_COLUMNS.items())
    )


def results_by_key(tables: Mapping[str, DataFrame], keys: DataFrame) -> DataFrame:
    """Results of the given (SampleDate, SampleId, Param) keys, in one job."""
    return results(tables, keys=keys)


def results_by_sample(tables: Mapping[str, DataFrame], sample_ids: DataFrame) -> DataFrame:
    """Results of the given samples; a NULL id never matches."""
    return results(tables, ids=sample_ids)


def sample_ids(tables: Mapping[str, DataFrame], since=None, measured: DataFrame | None = None) -> DataFrame:
    """Distinct sample ids with a measurement at a station of the wanted types; with
    ``since``, of samples collected strictly later. ``measured`` as in :func:`results`."""
    if measured is None:
        measured = measured_samples(tables, located_samples(tables, since))
    return measured.select(F.col("LAB_ASGND_ID_NUM").alias("SampleId")).distinct()


def stations(tables: Mapping[str, DataFrame], ids: DataFrame | None = None) -> DataFrame:
    """Station extract, optionally for the stations in ``ids`` only.

    The casing depth is itself one of the grouping columns, so a well with
    several casing depths yields one row per depth.
    """
    facilities = tables["tinwsf"].where(F.col("TYPE_CODE").isin(*STATION_TYPE_CODES))
    casings = tables["tinwlcas"].select("TINWSF_IS_NUMBER", "BOTTOM_DEPTH_MSR", "BOTTOM_DP_MSR_UOM")
    if ids is not None:
        wanted = ids.select(F.col("StationId").cast("string").alias("_wanted")).distinct()
        own = F.col("TINWSF_IS_NUMBER").cast("string") == F.col("_wanted")
        facilities, casings = (rows.join(wanted, own, "left_semi") for rows in (facilities, casings))
    t = {name: tables[name].alias(name) for name in ("tinwsys", "tinloc")}
    # A well has many casing rows of few depths.
    casings = casings.distinct()
    joined = (
        facilities.alias("tinwsf")
        .join(t["tinwsys"], _equals("tinwsf.TINWSYS_IS_NUMBER", "tinwsys.TINWSYS_IS_NUMBER"))
        .join(
            t["tinloc"].where(F.col("LATITUDE_MEASURE") != 0),
            _equals("tinwsf.TINWSF_IS_NUMBER", "tinloc.TINWSF_IS_NUMBER"),
        )
        .join(casings.alias("tinwlcas"), _equals("tinwsf.TINWSF_IS_NUMBER", "tinwlcas.TINWSF_IS_NUMBER"), "left")
    )
    by = [F.col(column).alias(field) for field, column in STATION_COLUMNS.items()]
    by += [
        F.col("tinloc.SRC_MAP_SCALE_NUM").alias("_scale"),
        F.col("tinwlcas.BOTTOM_DEPTH_MSR").alias("_depth"),
    ]
    grouped = joined.groupBy(*by).agg(F.max("tinwlcas.BOTTOM_DEPTH_MSR").alias("Depth"))
    order = [c for c in STATION_COLUMNS if c != "DepthUnit"]
    return grouped.select(*order, "Depth", "DepthUnit")
