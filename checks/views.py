"""The generated tables in the shape of the domain.

Each view is one SELECT over the given tables, written so that Spark and DuckDB
both run it; ``{name}`` stands for a table. It only dresses columns up as the
text or numbers a source would deliver: every row of the table is there, and no
operator of the library is anticipated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.session import SETTINGS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

#: The moment that counts as now in all checks.
AS_OF = "2025-01-01 00:00:00"
#: Day of the last stored WQP and SDWIS result in the update checks.
STORED_UNTIL = "1996-06-01"

HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"

_DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
_MDY = (
    "CAST(EXTRACT(MONTH FROM l_shipdate) AS STRING) || '/' || CAST(EXTRACT(DAY FROM l_shipdate) AS STRING) || '/'"
)

RAW_RESULTS = f"""
SELECT
  'S-' || CAST(CAST(FLOOR(l_orderkey / 8) AS BIGINT) AS STRING) AS SampleId,
  CASE WHEN l_suppkey % 5 = 0 THEN 'ORG_WQX-' ELSE 'ORG-' END || CAST(l_suppkey AS STRING) AS StationId,
  CASE l_partkey % 14
    WHEN 0 THEN CASE WHEN l_linenumber = 2 THEN 'Total Calcium' ELSE 'Calcium' END
    WHEN 1 THEN 'Magnesium'
    WHEN 2 THEN 'Sodium'
    WHEN 3 THEN 'Potassium'
    WHEN 4 THEN 'Chloride'
    WHEN 5 THEN CASE l_linenumber WHEN 3 THEN 'Bicarbonate as CaCO3' WHEN 4 THEN 'Alkalinity, bicarbonate as CaCO3'
                                  WHEN 5 THEN 'Alkalinity' ELSE 'Bicarbonate' END
    WHEN 6 THEN CASE WHEN l_linenumber = 3 THEN 'Sulfate as S' ELSE 'Sulfate' END
    WHEN 7 THEN CASE l_linenumber WHEN 1 THEN 'Carbonate as CaCO3' WHEN 3 THEN 'Carbonate (CO3)' ELSE 'Carbonate' END
    WHEN 8 THEN CASE l_linenumber WHEN 1 THEN 'Nitrate-nitrogen' WHEN 3 THEN 'NO2+NO3 as N' ELSE 'Nitrate' END
    WHEN 9 THEN CASE WHEN l_linenumber = 1 THEN 'Nitrite as N' ELSE 'Nitrite' END
    WHEN 10 THEN 'Sodium plus potassium'
    WHEN 11 THEN 'Arsenic'
    WHEN 12 THEN 'Specific conductance'
    ELSE CASE l_linenumber WHEN 7 THEN NULL WHEN 1 THEN 'Orthophosphate as P' ELSE 'Perchlorate' END
  END AS Param,
  CASE WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN 'ND'
       WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN ''
       WHEN l_linenumber = 1 THEN '  ' || CAST(l_quantity AS STRING) || ' '
       ELSE CAST(l_quantity AS STRING) END AS ResultValue,
  CASE WHEN l_partkey % 14 = 12 THEN CASE WHEN l_linenumber = 7 THEN 'ms/cm' ELSE 'umho/cm' END
       WHEN l_linenumber = 2 THEN 'ug/l'
       WHEN l_linenumber = 4 AND l_partkey % 14 IN (8, 9) THEN 'mg/l as n'
       WHEN l_linenumber = 5 THEN 'mg/l as caco3'
       WHEN l_linenumber = 6 THEN 'ueq/l'
       ELSE 'mg/l' END AS Unit,
  CASE WHEN l_returnflag = 'R' AND l_linenumber >= 6 THEN 'Not Detected'
       WHEN l_returnflag = 'R' THEN '  ' ELSE NULL END AS DetectCond,
  CASE WHEN l_linenumber = 2 AND l_discount = 0.0 THEN '2160' || substr({_DAY}, 5, 6)
       WHEN l_linenumber = 2 AND l_discount = 0.01 THEN '1750' || substr({_DAY}, 5, 6)
       WHEN l_linenumber = 4 THEN {_MDY} || substr({_DAY}, 1, 4)
       WHEN l_linenumber = 5 THEN replace({_DAY}, '-', '')
       WHEN l_linenumber = 6 THEN {_DAY} || ' 13:45:00'
       WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'unknown'
       WHEN l_linenumber = 7 THEN {_MDY} || substr({_DAY}, 3, 2)
       WHEN l_linenumber = 3 AND l_partkey % 3 = 0 THEN replace({_MDY}, '/', '-') || substr({_DAY}, 1, 4)
       WHEN l_linenumber = 3 AND l_partkey % 3 = 1 AND EXTRACT(DAY FROM l_shipdate) > 12
         THEN CAST(EXTRACT(DAY FROM l_shipdate) AS STRING) || '-' || CAST(EXTRACT(MONTH FROM l_shipdate) AS STRING) || '-' || substr({_DAY}, 1, 4)
       WHEN l_linenumber = 3 AND l_partkey % 3 = 2 THEN replace({_MDY}, '/', '.') || substr({_DAY}, 1, 4)
       ELSE {_DAY} END AS SampleDate,
  CASE l_linenumber WHEN 1 THEN '9:5' WHEN 2 THEN '12' WHEN 3 THEN '23:59:59' WHEN 4 THEN '24:00'
                    WHEN 5 THEN '' WHEN 6 THEN '7:61' ELSE ' 08:30' END AS SampleTime,
  CASE l_suppkey % 6 WHEN 0 THEN 'WL' WHEN 1 THEN 'SP' WHEN 2 THEN ' SS ' WHEN 3 THEN 'IN' WHEN 4 THEN 'Water'
                     ELSE NULL END AS SampMedia,
  CASE l_linenumber WHEN 1 THEN '1e3' WHEN 2 THEN '1d' WHEN 3 THEN '.5' WHEN 4 THEN '5.' WHEN 5 THEN '+7'
                    WHEN 6 THEN '1_000' ELSE 'n/a' END AS MDL,
  chr(9) || 'Lab ' || CAST(l_suppkey AS STRING) || ' ' || chr(10) AS LabName,
  'Project ' || repeat('x', 50) || CAST(l_linenumber AS STRING) AS ProjectId,
  CASE l_linenumber WHEN 1 THEN '3.5' WHEN 2 THEN '-12' WHEN 3 THEN 'seven' ELSE CAST(l_orderkey AS STRING) END AS IdNum,
  'file-' || lower(l_linestatus) AS source_file
FROM {{lineitem}}
"""

_STATION = """
  CASE CAST(k % 9 AS INT) WHEN 0 THEN 'Well' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Lake' WHEN 3 THEN 'River/Stream'
    WHEN 4 THEN 'Cave' WHEN 5 THEN ' Stream: Canal ' WHEN 6 THEN 'Wetland Riverine-Emergent' WHEN 7 THEN 'Unheard of'
    ELSE NULL END AS StationType,
  CASE WHEN k % 41 = 0 THEN NULL WHEN k % 37 = 0 THEN '0'
       ELSE CASE WHEN k % 43 = 0 THEN '' ELSE '-' END || CAST(106 + k % 10 AS STRING) || '.'
            || lpad(CAST(k * 7 % 1000 AS STRING), 3, '0') END AS Lon_X,
  CASE WHEN k % 53 = 0 THEN 'north' ELSE CAST(35 + k % 8 AS STRING) || '.'
       || lpad(CAST(k * 13 % 1000 AS STRING), 3, '0') END AS Lat_Y,
  CASE WHEN k % 3 = 0 THEN NULL ELSE '49' END AS StateCode,
  CASE WHEN k % 4 = 0 THEN '' ELSE CAST(49000 + k % 29 AS STRING) END AS CountyCode,
  CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '25000' ELSE '1500.5' END AS Elev,
  CASE WHEN k % 5 > 2 THEN 'feet' ELSE NULL END AS ElevUnit,
  CASE WHEN k % 2 = 0 THEN '01/02/95' ELSE '1999-07-04' END AS ConstDate,
  'file-' || CAST(k % 2 AS STRING) AS source_file
"""

RAW_STATIONS = f"""
SELECT 'ORG-' || CAST(k AS STRING) AS StationId, k AS Id, name AS StationName, {_STATION}
FROM (SELECT c_custkey AS k, c_name AS name FROM {{customer}}) AS c
UNION ALL
SELECT 'ORG_WQX-' || CAST(k AS STRING) AS StationId, -1 - k AS Id, name AS StationName, {_STATION}
FROM (SELECT 3 * s_suppkey AS k, s_name AS name FROM {{supplier}}) AS s
"""

# Results already stored: the samples of every full-quantity line before a day.
STORED_RESULTS = f"""
SELECT 'S-' || CAST(CAST(FLOOR(l_orderkey / 8) AS BIGINT) AS STRING) AS SampleId,
       CAST(l_shipdate AS DATE) AS SampleDate, 'WQP' AS DataSource
FROM {{lineitem}} WHERE l_quantity = 50 AND l_shipdate < DATE '{STORED_UNTIL}'
"""

# Stations already stored, by their stripped id: those with a positive balance.
STORED_STATIONS = """
SELECT 'ORG-' || CAST(c_custkey AS STRING) AS StationId FROM {customer} WHERE c_acctbal > 5000
UNION ALL
SELECT 'ORG-' || CAST(s_suppkey AS STRING) AS StationId FROM {supplier} WHERE s_acctbal > 8000
"""

COUNTIES = """
SELECT 49 AS state_code, 49000 + n_nationkey AS county_code, n_nationkey % 2 AS kind,
       -115 + 1.4E0 * (n_nationkey % 5) AS x0, 35.5E0 + 1.4E0 * FLOOR(n_nationkey / 5) AS y0,
       -115 + 1.4E0 * (n_nationkey % 5 + 1) AS x1, 35.5E0 + 1.4E0 * (FLOOR(n_nationkey / 5) + 1) AS y1
FROM {nation}
"""

# Half-degree elevation cells; several parts may describe one cell.
ELEVATION = """
SELECT CAST(-230 + p_partkey % 14 AS BIGINT) AS cell_x,
       CAST(70 + FLOOR(p_partkey / 14) % 12 AS BIGINT) AS cell_y,
       CAST(1000 + 10 * p_size AS DOUBLE) AS elevation
FROM {part}
"""

_ION = """CASE CAST(p_partkey % 14 AS INT) WHEN 0 THEN 'CALCIUM' WHEN 1 THEN 'MAGNESIUM' WHEN 2 THEN 'SODIUM' WHEN 3 THEN 'POTASSIUM'
  WHEN 4 THEN 'CHLORIDE' WHEN 5 THEN 'BICARBONATE AS HCO3' WHEN 6 THEN 'SULFATE' WHEN 7 THEN 'CARBONATE' WHEN 8 THEN 'NITRATE'
  WHEN 9 THEN 'NITRITE' WHEN 10 THEN 'SODIUM PLUS POTASSIUM' WHEN 11 THEN 'ARSENIC' WHEN 12 THEN 'LEAD' ELSE 'PH' END"""

SDWIS = {
    "tinwsf": """
      SELECT s_suppkey AS TINWSF_IS_NUMBER, s_nationkey AS TINWSYS_IS_NUMBER, s_name AS NAME,
             CASE s_suppkey % 5 WHEN 0 THEN 'SP' WHEN 1 THEN 'WL' WHEN 2 THEN 'IN' WHEN 3 THEN 'SS' ELSE 'XX' END AS TYPE_CODE
      FROM {supplier}""",
    "tinwsys": "SELECT n_nationkey AS TINWSYS_IS_NUMBER, n_name AS NAME FROM {nation}",
    "tinloc": """
      SELECT s_suppkey AS TINWSF_IS_NUMBER, -114 + s_suppkey % 50 / 10.0E0 AS LONGITUDE_MEASURE,
             CASE WHEN s_suppkey % 11 = 0 THEN 0.0E0 ELSE 37 + s_suppkey % 40 / 10.0E0 END AS LATITUDE_MEASURE,
             24000 AS SRC_MAP_SCALE_NUM, 5.0E0 AS HORIZ_ACCURACY_MSR, 'GPS' AS HZ_COLLECT_METH_CD, 'NAD83' AS HORIZ_REF_DATUM_CD,
             s_acctbal AS VERTICAL_MEASURE, 1.0E0 AS VERT_ACCURACY_MSR, 'MAP' AS VER_COL_METH_CD, 'NAVD88' AS VERT_REF_DATUM_CD
      FROM {supplier}""",
    "tsasmppt": """
      SELECT l_orderkey AS TSASMPPT_IS_NUMBER, min(l_suppkey) AS TINWSF0IS_NUMBER FROM {lineitem} GROUP BY l_orderkey""",
    "tsasampl": """
      SELECT o_orderkey AS TSASAMPL_IS_NUMBER, o_orderkey AS TSASMPPT_IS_NUMBER, o_custkey AS TSALAB_IS_NUMBER,
             CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
                  ELSE 'L-' || CAST(o_custkey AS STRING) END AS LAB_ASGND_ID_NUM,
             o_orderdate AS COLLLECTION_END_DT, '10:30' AS COLLCTN_END_TIME
      FROM {orders}""",
    "tsasar": """
      SELECT l_orderkey AS TSASAMPL_IS_NUMBER, l_partkey AS TSAANLYT_IS_NUMBER, l_orderkey * 10 + l_linenumber AS TSASAR_IS_NUMBER,
             CASE WHEN l_returnflag = 'N' AND l_linenumber > 5 THEN NULL ELSE l_quantity END AS CONCENTRATION_MSR,
             CASE WHEN l_linenumber = 2 THEN 'ug/l' ELSE 'mg/l' END AS UOM_CODE,
             l_shipdate AS ANALYSIS_START_DT, l_discount AS DETECTN_LIMIT_NUM, 'mg/l' AS DETECTN_LIM_UOM_CD
      FROM {lineitem}""",
    "tsaanlyt": f"""
      SELECT p_partkey AS TSAANLYT_IS_NUMBER, {_ION} AS NAME, 'CAS-' || CAST(p_partkey AS STRING) AS CAS_REGISTRY_NUM FROM {{part}}""",
    "tsalab": "SELECT c_custkey AS TSALAB_IS_NUMBER, c_name AS LAB_ID_NUMBER FROM {customer}",
    "tinwlcas": """
      SELECT 2 * l_suppkey AS TINWSF_IS_NUMBER, l_quantity AS BOTTOM_DEPTH_MSR, 'FT' AS BOTTOM_DP_MSR_UOM FROM {lineitem}""",
}

# SDWIS results already stored: every full-quantity measurement before a day.
STORED_SDWIS = f"""
SELECT 'L-' || CAST(o_custkey AS STRING) AS SampleId, CAST(o_orderdate AS DATE) AS SampleDate,
       {_ION.replace('p_partkey', 'l_partkey')} AS Param, 'SDWIS' AS DataSource
FROM {{lineitem}} AS l JOIN {{orders}} AS o ON l_orderkey = o_orderkey
WHERE l_quantity > 45 AND (o_orderdate < DATE '{STORED_UNTIL}')
"""

# SDWIS stations already stored.
STORED_SDWIS_STATIONS = """
SELECT CAST(s_suppkey AS STRING) AS StationId FROM {supplier} WHERE s_acctbal > 4000
"""

# Exported geodatabase tables: typed columns, a point per station.
EXPORTED_RESULTS = """
SELECT 'E-' || CAST(o_custkey AS STRING) AS SampleId, 'DOGM-' || CAST(l_suppkey AS STRING) AS StationId,
       CASE CAST(l_partkey % 14 AS INT) WHEN 0 THEN 'Calcium' WHEN 1 THEN 'Magnesium' WHEN 2 THEN 'Sodium' WHEN 3 THEN 'Potassium'
         WHEN 4 THEN 'Chloride' WHEN 5 THEN 'Bicarbonate' WHEN 6 THEN 'Sulfate' WHEN 7 THEN 'Iron' ELSE 'pH' END AS Param,
       l_quantity AS ResultValue, 'mg/l' AS Unit, o_orderdate AS SampleDate, l_linestatus AS NotInSchema
FROM {lineitem} AS l JOIN {orders} AS o ON l_orderkey = o_orderkey
"""
EXPORTED_STATIONS = """
SELECT 'DOGM-' || CAST(s_suppkey AS STRING) AS StationId, s_name AS StationName, 'MD' AS StationType, 1 AS OBJECTID,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE -112 + s_suppkey % 20 / 10.0E0 END AS point_x,
       CASE WHEN s_suppkey % 9 = 0 THEN 0.0E0 ELSE 38 + s_suppkey % 30 / 10.0E0 END AS point_y
FROM {supplier}
"""

# A landed extract made of the event log.
LANDED = """
SELECT 'E-' || CAST(user_id AS STRING) AS SampleId, 'U-' || CAST(user_id % 50 AS STRING) AS StationId,
       CASE event_type WHEN 'error' THEN 'Calcium' WHEN 'click' THEN 'Magnesium' WHEN 'view' THEN 'Chloride'
         WHEN 'purchase' THEN 'Bicarbonate' ELSE CASE WHEN event_id % 2 = 0 THEN 'Sulfate' ELSE 'Sodium' END END AS Param,
       CAST(value AS STRING) AS ResultValue, 'mg/l' AS Unit, CAST(CAST(ts AS DATE) AS STRING) AS SampleDate,
       CASE WHEN event_id % 10 = 0 THEN 'said "twice", then left' ELSE 'plain' END AS ResultComment
FROM {events}
"""
STORED_LANDED = "SELECT DISTINCT 'E-' || CAST(user_id AS STRING) AS SampleId FROM {events} WHERE value > 250"


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view's SELECT over the Parquet tables of a folder.

    The widest of them exceed what the JVM compiles as one method, so the queries run
    with the setting that the library's own jobs have for that."""
    spark.conf.set(HUGE_METHOD, SETTINGS[HUGE_METHOD])
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **tables)


def duck(sql: str) -> str:
    """The same SELECT with the table names DuckDB knows."""
    return sql.format(**{t: t for t in TABLES})


def with_views(query: str, **views: str) -> str:
    """``query`` preceded by the views it reads."""
    ctes = ",\n".join(f"{name} AS ({duck(sql)})" for name, sql in views.items())
    return f"WITH {ctes}\n{query}"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def sdwis_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: view(spark, sf_dir, sql) for name, sql in SDWIS.items()}


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares and triangles: an even county is a box, an odd one its lower left half."""
    base = view(spark, sf_dir, COUNTIES)

    def point(x: str, y: str):
        return F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))

    box = F.array(point("x0", "y0"), point("x1", "y0"), point("x1", "y1"), point("x0", "y1"), point("x0", "y0"))
    half = F.array(point("x0", "y0"), point("x1", "y0"), point("x0", "y1"))
    ring = F.when(F.col("kind") == 0, box).otherwise(half)
    return base.select("state_code", "county_code", F.array(ring).alias("rings"))
