"""SQL for DuckDB that must return what the queries return.

Expected values are stated from the original columns wherever possible: the
typed rows below come straight from the numbers the text views were made of, and
rules appear as the finite cases the views contain.
"""

from __future__ import annotations

from wellspring.model import schema as S

from . import views as V
from .queries import DIGITS, RESULT_COLUMNS, SINCE, STATION_COLUMNS, WINDOW

ORACLES: dict[str, str] = {}


def rounded(expr: str, digits: int = DIGITS) -> str:
    return f"round({expr}, {digits}) + 0.0"


# Raw rows beside the columns they were made of.
RAW = V.RAW_RESULTS.replace(
    "FROM {lineitem}", ", l_quantity, l_linenumber, l_returnflag, l_shipdate, l_discount, l_suppkey, l_orderkey FROM {lineitem}"
)

TYPED = """
SELECT SampleId, StationId, Param, Unit, source_file,
  CASE WHEN l_linenumber = 6 AND l_returnflag = 'N' OR l_linenumber = 7 AND l_returnflag = 'A' THEN NULL
       ELSE l_quantity END AS ResultValue,
  CASE WHEN l_returnflag = 'R' AND l_linenumber >= 6 THEN 'Not Detected' END AS DetectCond,
  CASE WHEN l_linenumber = 2 AND l_discount IN (0.0, 0.01) OR l_linenumber = 7 AND l_returnflag = 'R' THEN NULL
       ELSE strftime(l_shipdate, '%Y-%m-%d') END AS SampleDate,
  CASE l_linenumber WHEN 1 THEN '09:05:00' WHEN 2 THEN '12:00:00' WHEN 3 THEN '23:59:59' WHEN 7 THEN '08:30:00' END AS SampleTime,
  CASE l_suppkey % 6 WHEN 0 THEN 'Groundwater' WHEN 1 THEN 'Groundwater' WHEN 2 THEN 'Surface Water'
                     WHEN 3 THEN 'Surface Water' WHEN 4 THEN 'Water' END AS SampMedia,
  CASE l_linenumber WHEN 1 THEN 1000.0 WHEN 3 THEN 0.5 WHEN 4 THEN 5.0 WHEN 5 THEN 7.0 END::DOUBLE AS MDL,
  'Lab ' || l_suppkey AS LabName, 'Project ' || repeat('x', 42) AS ProjectId,
  CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN -12 WHEN 3 THEN NULL ELSE l_orderkey END::BIGINT AS IdNum
FROM raw"""


def ruled(source: str) -> str:
    """Rows after the unit rules: the cases that occur in the views."""
    return f"""
SELECT * EXCLUDE (Param, Unit, ResultValue, p),
  CASE WHEN p IN ('carbonate as caco3', 'carbonate (co3)') AND Unit = 'mg/l' THEN 'carbonate'
       WHEN p IN ('bicarbonate as caco3', 'alkalinity, bicarbonate as caco3', 'bicarbonate as hco3') AND Unit = 'mg/l' THEN 'bicarbonate'
       WHEN p = 'alkalinity' AND Unit = 'mg/l as caco3' THEN 'bicarbonate based on alkalinity'
       WHEN p = 'sulfate as s' AND Unit = 'mg/l' THEN 'sulfate'
       WHEN p = 'nitrate-nitrogen' AND Unit = 'mg/l' THEN 'nitrite'
       WHEN p = 'no2+no3 as n' AND Unit = 'mg/l' THEN 'nitrate and nitrite as no3'
       WHEN p = 'nitrite as n' AND Unit = 'mg/l' THEN 'nitrite'
       WHEN p = 'orthophosphate as p' AND Unit = 'mg/l' THEN 'phosphate'
       ELSE p END AS Param,
  CASE WHEN p = 'specific conductance' AND Unit IN ('umho/cm', 'ms/cm') THEN 'uS/cm'
       WHEN p IN ('arsenic', 'perchlorate', 'iron') AND Unit = 'mg/l' THEN 'ug/l'
       WHEN Unit = 'ug/l' AND p NOT IN ('arsenic', 'lead', 'ph') THEN 'mg/l'
       WHEN Unit = 'mg/l as n' AND p IN ('nitrate', 'nitrite') THEN 'mg/l'
       WHEN Unit = 'mg/l as caco3' AND p = 'alkalinity' THEN 'mg/l'
       WHEN Unit = 'ueq/l' AND p IN ('calcium', 'magnesium', 'sodium', 'potassium', 'chloride', 'nitrate', 'sulfate') THEN 'mg/l'
       WHEN Unit = 'mg/l' AND p = 'lead' THEN 'ug/l'
       ELSE Unit END AS Unit,
  ResultValue * CASE
       WHEN p = 'specific conductance' AND Unit = 'ms/cm' THEN 1000
       WHEN Unit = 'ug/l' AND p NOT IN ('arsenic', 'lead', 'ph') THEN 0.001::DOUBLE
       WHEN Unit = 'mg/l' THEN CASE p
         WHEN 'arsenic' THEN 1000 WHEN 'perchlorate' THEN 1000 WHEN 'lead' THEN 1000 WHEN 'iron' THEN 1000
         WHEN 'carbonate as caco3' THEN 0.6::DOUBLE
         WHEN 'bicarbonate as caco3' THEN 1.22::DOUBLE WHEN 'alkalinity, bicarbonate as caco3' THEN 1.22::DOUBLE
         WHEN 'sulfate as s' THEN 0.333792756::DOUBLE
         WHEN 'nitrate-nitrogen' THEN 4.426802887::DOUBLE WHEN 'no2+no3 as n' THEN 4.426802887::DOUBLE
         WHEN 'nitrite as n' THEN 3.284535258::DOUBLE WHEN 'orthophosphate as p' THEN 3.131265779::DOUBLE
         ELSE 1 END
       WHEN Unit = 'mg/l as n' THEN CASE p WHEN 'nitrate' THEN 4.426802887::DOUBLE WHEN 'nitrite' THEN 3.284535258::DOUBLE ELSE 1 END
       WHEN Unit = 'mg/l as caco3' AND p = 'alkalinity' THEN 1.22::DOUBLE
       WHEN Unit = 'ueq/l' THEN CASE p
         WHEN 'calcium' THEN 20.039::DOUBLE WHEN 'magnesium' THEN 12.1525::DOUBLE WHEN 'potassium' THEN 39.0983::DOUBLE
         WHEN 'sodium' THEN 22.9897::DOUBLE WHEN 'nitrate' THEN 62.0049::DOUBLE WHEN 'chloride' THEN 35.453::DOUBLE
         WHEN 'sulfate' THEN 24.01565::DOUBLE ELSE 1 END
       ELSE 1 END AS ResultValue
FROM (SELECT *, lower(Param) AS p FROM {source}) AS lowered"""


GROUP = """CASE
  WHEN Param IN ('calcium', 'total calcium', 'magnesium', 'sodium', 'potassium', 'sodium plus potassium')
    THEN 'inorganics, major, metals'
  WHEN Param IN ('chloride', 'bicarbonate', 'bicarbonate as caco3', 'bicarbonate as hco3', 'alkalinity',
                 'alkalinity, bicarbonate as caco3', 'sulfate', 'carbonate', 'carbonate as caco3', 'carbonate (co3)')
    THEN 'inorganics, major, non-metals'
  WHEN Param IN ('arsenic', 'perchlorate') THEN 'inorganics, minor, non-metals'
  WHEN Param IN ('lead', 'iron') THEN 'inorganics, minor, metals'
  WHEN Param IN ('nitrate', 'nitrite', 'nitrate-nitrogen', 'no2+no3 as n', 'nitrite as n', 'orthophosphate as p',
                 'phosphate', 'nitrate and nitrite as no3') THEN 'nutrient'
  END"""


def ions(source: str, keys: str = "SampleId") -> str:
    return f"""
SELECT {keys}, ion, ResultValue AS value FROM (
  SELECT *, CASE
    WHEN Param IN ('calcium', 'total calcium') THEN 'ca' WHEN Param = 'magnesium' THEN 'mg' WHEN Param = 'sodium' THEN 'na'
    WHEN Param = 'potassium' THEN 'k' WHEN Param = 'sodium plus potassium' THEN 'na+k' WHEN Param = 'chloride' THEN 'cl'
    WHEN Param IN ('bicarbonate', 'bicarbonate as hco3', 'bicarbonate based on alkalinity') THEN 'hco3'
    WHEN Param IN ('carbonate', 'carbonate (co3)') THEN 'co3' WHEN Param = 'sulfate' THEN 'so4'
    WHEN Param = 'nitrite' THEN 'no2' WHEN Param IN ('nitrate', 'nitrate and nitrite as no3') THEN 'no3' END AS ion
  FROM {source}) AS coded
WHERE ion IS NOT NULL AND ResultValue IS NOT NULL AND DetectCond IS NULL"""


IONS = ("ca", "mg", "na", "na+k", "k", "cl", "hco3", "co3", "so4", "no2", "no3")


def pivot(source: str, keys: str = "SampleId") -> str:
    columns = ", ".join(f"avg(value) FILTER (ion = '{i}') AS {i.replace('+', '_')}" for i in IONS)
    return f"SELECT {keys}, {columns} FROM {source} GROUP BY {keys}"


def totals(source: str, keys: str = "SampleId") -> str:
    return f"""
SELECT {keys}, CASE WHEN cation_total + anion_total = 0 THEN 0
               ELSE (cation_total - anion_total) / (cation_total + anion_total) * 100 END AS balance, cation_total, anion_total
FROM (
  SELECT {keys},
    0.04990269::DOUBLE * ca + 0.082287595::DOUBLE * mg + 0.043497608::DOUBLE * coalesce(sodium, 0)
      + 0.02557656::DOUBLE * coalesce(potassium, 0) + 0.043497608::DOUBLE * coalesce(alkali_sum, 0) AS cation_total,
    0.028206596::DOUBLE * cl + 0.016388838::DOUBLE * hco3 + 0.033328223::DOUBLE * coalesce(co3, 0)
      + 0.020833333::DOUBLE * so4 + 0.016129032::DOUBLE * coalesce(no3, 0) + 0.021736513::DOUBLE * coalesce(no2, 0) AS anion_total
  FROM {source}
  WHERE ca IS NOT NULL AND mg IS NOT NULL AND cl IS NOT NULL AND hco3 IS NOT NULL AND so4 IS NOT NULL
    AND (sodium IS NOT NULL OR alkali_sum IS NOT NULL)) AS summed"""


ALKALIS = """
SELECT *, CASE WHEN na IS NULL AND k IS NOT NULL AND na_k IS NOT NULL THEN na_k - k ELSE na END AS sodium,
  CASE WHEN k IS NULL AND na IS NOT NULL AND na_k IS NOT NULL THEN na_k - na ELSE k END AS potassium,
  CASE WHEN k IS NOT NULL THEN 0 WHEN na_k IS NOT NULL AND na IS NOT NULL THEN 0 ELSE na_k END::DOUBLE AS alkali_sum
FROM wide"""


def two_decimals(x: str) -> str:
    return f"CAST(printf('%.2f', {x}) AS DOUBLE) + 0.0"


def balance_rows(source: str, keys: str = "SampleId") -> str:
    return f"""
SELECT {keys}, 'Charge Balance' AS Param, {two_decimals('balance')} AS ResultValue, '%' AS Unit FROM {source} UNION ALL
SELECT {keys}, 'Cation Total', {two_decimals('cation_total')}, 'meq/l' FROM {source} UNION ALL
SELECT {keys}, 'Anions Total', {two_decimals('anion_total')}, 'meq/l' FROM {source}"""


class Sql:
    """Named SELECTs in order, ending in a query."""

    def __init__(self, **views: str):
        self.views = dict(views)

    def plus(self, **views: str) -> Sql:
        return Sql(**{**self.views, **views})

    def end(self, query: str) -> str:
        return V.with_views(V.duck(query), **self.views)


raw = Sql(raw=RAW)
typed = raw.plus(typed=TYPED)
ruled_rows = typed.plus(ruled=ruled("typed"))


def chain(base: Sql, rows: str, keys: str = "SampleId") -> Sql:
    return base.plus(
        ions=ions(rows, keys), wide=pivot("ions", keys), alkalis=ALKALIS, totals=totals("alkalis", keys)
    )


by_sample = chain(ruled_rows, "ruled")
by_file = chain(ruled_rows, "ruled", "source_file, SampleId")

ORACLES["charge_balance"] = by_sample.end(balance_rows("totals"))
ORACLES["charge_balance_by_file"] = by_file.end(balance_rows("totals", "source_file, SampleId"))
ORACLES["charge_balance_unrounded"] = by_sample.end(
    f"SELECT SampleId, {rounded('balance', 9)} AS balance, {rounded('cation_total', 9)} AS cation_total, "
    f"{rounded('anion_total', 9)} AS anion_total FROM totals"
)
ORACLES["ion_values"] = by_sample.end(f"SELECT SampleId, ion, {rounded('value')} AS value FROM ions")
WIDE = ", ".join(f"{rounded(i.replace('+', '_'))} AS {i.replace('+', '_')}" for i in IONS)
ORACLES["analyte_pivot"] = by_sample.end(f"SELECT SampleId, {WIDE} FROM wide")
ORACLES["duplicate_mean"] = by_sample.end(
    f"SELECT SampleId, ion, {rounded('avg(value)')} AS value, count(*) AS n_values FROM ions GROUP BY SampleId, ion"
)
ORACLES["nak_derivation"] = by_sample.end(
    f"SELECT SampleId, {rounded('sodium')} AS sodium, {rounded('potassium')} AS potassium, "
    f"{rounded('alkali_sum')} AS alkali_sum FROM alkalis"
)

# Typed exports pass the same rules; they have no detection condition.
EXPORT_TYPED = "SELECT *, NULL::VARCHAR AS DetectCond FROM exported"
export = Sql(exported=V.EXPORTED_RESULTS, export_typed=EXPORT_TYPED, export_ruled=ruled("export_typed"))
ORACLES["merge_concentrations"] = (
    by_sample.plus(**export.views)
    .plus(
        other=ions("export_ruled"),
        merged="SELECT * FROM ions UNION ALL SELECT replace(SampleId, 'E-', 'S-'), ion, value FROM other",
        wide_all=pivot("merged"),
    )
    .end(f"SELECT SampleId, {WIDE} FROM wide_all")
)

# --- casts and projections

ORACLES["cast_strings"] = typed.end("SELECT SampleId, StationId, LabName, ProjectId, DetectCond FROM typed")
ORACLES["cast_numbers"] = typed.end(
    "SELECT SampleId, ResultValue + 0.0 AS ResultValue, MDL + 0.0 AS MDL, IdNum, NULL::DOUBLE AS Chrg FROM typed"
)
ORACLES["cast_dates"] = typed.end("SELECT SampleId, SampleDate FROM typed")
ORACLES["cast_times"] = typed.end("SELECT SampleId, SampleTime FROM typed")
ORACLES["rename_columns"] = V.duck(V.RAW_RESULTS)

NULL_OF = {"double": "DOUBLE", "float": "DOUBLE", "long": "BIGINT"}
EXPORT_FIELDS = {
    "SampleId": "SampleId",
    "StationId": "StationId",
    "Param": "Param",
    "ResultValue": rounded("ResultValue"),
    "Unit": "Unit",
    "SampleDate": "strftime(SampleDate, '%Y-%m-%d')",
}
ORACLES["reorder_filter"] = export.end(
    "SELECT "
    + ", ".join(f"{EXPORT_FIELDS.get(f.name, 'NULL::' + NULL_OF.get(f.kind, 'VARCHAR'))} AS {f.name}" for f in S.RESULT)
    + " FROM exported"
)
ORACLES["field_intersection"] = export.end(
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in EXPORT_FIELDS.items()) + " FROM exported"
)

# Stations: typed values stated from the key.
STATION_KEYS = """
SELECT c_custkey AS k, c_custkey AS Id, c_name AS StationName, 'ORG-' || c_custkey AS raw_id, 'ORG-' || c_custkey AS StationId FROM {customer}
UNION ALL
SELECT 3 * s_suppkey, -1 - 3 * s_suppkey, s_name, 'ORG_WQX-' || 3 * s_suppkey, 'ORG-' || 3 * s_suppkey FROM {supplier}"""
STATIONS = """
SELECT Id, raw_id, StationId, StationName, 'file-' || k % 2 AS source_file,
  CASE k % 9 WHEN 0 THEN 'Well' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Lake, Reservoir,  Impoundment' WHEN 3 THEN 'Stream'
    WHEN 4 THEN 'Other Groundwater' WHEN 5 THEN 'Stream' WHEN 6 THEN 'Wetland' WHEN 7 THEN 'Unheard of' END AS StationType,
  CASE WHEN k % 41 = 0 THEN NULL WHEN k % 37 = 0 THEN 0
    ELSE CASE WHEN k % 43 = 0 THEN 1 ELSE -1 END * ((106 + k % 10) * 1000 + k * 7 % 1000) / 1000 END AS Lon_X,
  CASE WHEN k % 53 = 0 THEN NULL ELSE ((35 + k % 8) * 1000 + k * 13 % 1000) / 1000 END AS Lat_Y,
  CASE WHEN k % 3 = 0 THEN NULL ELSE 49 END::INTEGER AS StateCode,
  CASE WHEN k % 4 = 0 THEN NULL ELSE 49000 + k % 29 END::INTEGER AS CountyCode,
  CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 0.0 WHEN 2 THEN 25000.0 ELSE 1500.5 END::DOUBLE AS Elev,
  CASE WHEN k % 5 > 2 THEN 'feet' END AS ElevUnit,
  CASE WHEN k % 2 = 0 THEN '1995-01-02' ELSE '1999-07-04' END AS ConstDate
FROM station_keys"""
stations = Sql(station_keys=STATION_KEYS, stations=STATIONS)

ORACLES["typed_write"] = stations.end(
    f"SELECT raw_id AS StationId, {rounded('Lon_X')} AS Lon_X, {rounded('Lat_Y')} AS Lat_Y, ConstDate, StateCode, CountyCode, "
    "Elev + 0.0 AS Elev FROM stations"
)
ORACLES["strip_wqx"] = stations.end("SELECT raw_id, StationId FROM stations")
ORACLES["station_type"] = stations.end("SELECT StationId, StationType FROM stations")
ORACLES["sample_media"] = typed.end("SELECT SampleId, SampMedia FROM typed")
ORACLES["unit_rules"] = ruled_rows.end(
    f"SELECT SampleId, Param, Unit, {rounded('ResultValue')} AS ResultValue FROM ruled"
)
ORACLES["param_group"] = ruled_rows.end(f"SELECT SampleId, Param, {GROUP} AS ParamGroup FROM ruled")
ORACLES["param_group_from_table"] = ruled_rows.plus(
    named=f"SELECT lower({V._ION}) AS name, min(p_type) AS grp FROM {{part}} GROUP BY ALL"
).end("SELECT SampleId, Param, grp AS ParamGroup FROM ruled LEFT JOIN named ON Param = name")
ORACLES["normalize_results"] = ruled_rows.end(
    f"SELECT SampleId, replace(StationId, '_WQX-', '-') AS StationId, Param, {GROUP} AS ParamGroup, Unit, "
    f"{rounded('ResultValue')} AS ResultValue, SampMedia, DetectCond FROM ruled"
)

# --- drinking-water database

SDWIS_FIELDS = """
  strftime(sa.COLLLECTION_END_DT, '%Y-%m-%d') AS SampleDate, sa.LAB_ASGND_ID_NUM AS SampleId, an.NAME AS Param,
  f.TINWSF_IS_NUMBER AS StationId, strftime(r.ANALYSIS_START_DT, '%Y-%m-%d') AS AnalysisDate, lab.LAB_ID_NUMBER AS LabName,
  r.DETECTN_LIMIT_NUM + 0.0 AS MDL, r.DETECTN_LIM_UOM_CD AS MDLUnit, s.TINWSYS_IS_NUMBER AS OrgId, s.NAME AS OrgName,
  r.CONCENTRATION_MSR + 0.0 AS ResultValue, sa.COLLCTN_END_TIME AS SampleTime, f.TYPE_CODE AS SampMedia, r.UOM_CODE AS Unit,
  loc.LATITUDE_MEASURE + 0.0 AS Lat_Y, loc.LONGITUDE_MEASURE + 0.0 AS Lon_X, an.CAS_REGISTRY_NUM AS CAS_Reg, r.TSASAR_IS_NUMBER AS IdNum"""
SDWIS_JOIN = f"""
SELECT {SDWIS_FIELDS}
FROM tinwsf f JOIN tinwsys s USING (TINWSYS_IS_NUMBER) JOIN tinloc loc USING (TINWSF_IS_NUMBER)
JOIN tsasmppt pt ON f.TINWSF_IS_NUMBER = pt.TINWSF0IS_NUMBER JOIN tsasampl sa USING (TSASMPPT_IS_NUMBER)
JOIN tsasar r USING (TSASAMPL_IS_NUMBER) JOIN tsaanlyt an USING (TSAANLYT_IS_NUMBER) JOIN tsalab lab USING (TSALAB_IS_NUMBER)
WHERE f.TYPE_CODE IN ('SP', 'WL', 'IN', 'SS') AND r.CONCENTRATION_MSR IS NOT NULL"""
SDWIS_STATIONS = """
SELECT s.TINWSYS_IS_NUMBER AS OrgId, s.NAME AS OrgName, f.TINWSF_IS_NUMBER AS StationId, f.NAME AS StationName,
  f.TYPE_CODE AS StationType, loc.LONGITUDE_MEASURE + 0.0 AS Lon_X, loc.LATITUDE_MEASURE + 0.0 AS Lat_Y,
  loc.HORIZ_ACCURACY_MSR + 0.0 AS HorAcc, loc.HZ_COLLECT_METH_CD AS HorCollMeth, loc.HORIZ_REF_DATUM_CD AS HorRef,
  loc.VERTICAL_MEASURE + 0.0 AS Elev, loc.VERT_ACCURACY_MSR + 0.0 AS ElevAcc, loc.VER_COL_METH_CD AS ElevMeth,
  loc.VERT_REF_DATUM_CD AS ElevRef, max(cas.BOTTOM_DEPTH_MSR) + 0.0 AS Depth, cas.BOTTOM_DP_MSR_UOM AS DepthUnit
FROM tinwsf f JOIN tinwsys s USING (TINWSYS_IS_NUMBER) JOIN tinloc loc USING (TINWSF_IS_NUMBER)
LEFT JOIN tinwlcas cas ON f.TINWSF_IS_NUMBER = cas.TINWSF_IS_NUMBER
WHERE f.TYPE_CODE IN ('SP', 'WL', 'IN', 'SS') AND loc.LATITUDE_MEASURE <> 0
GROUP BY f.TINWSF_IS_NUMBER, f.NAME, f.TYPE_CODE, s.TINWSYS_IS_NUMBER, s.NAME, loc.LATITUDE_MEASURE, loc.LONGITUDE_MEASURE,
  loc.SRC_MAP_SCALE_NUM, loc.HORIZ_ACCURACY_MSR, loc.HZ_COLLECT_METH_CD, loc.HORIZ_REF_DATUM_CD, loc.VERTICAL_MEASURE,
  loc.VERT_ACCURACY_MSR, loc.VER_COL_METH_CD, loc.VERT_REF_DATUM_CD, cas.BOTTOM_DEPTH_MSR, cas.BOTTOM_DP_MSR_UOM"""
db = Sql(**V.SDWIS).plus(extract=SDWIS_JOIN, stored=V.STORED_SDWIS)
db_stations = Sql(**V.SDWIS).plus(extract=SDWIS_STATIONS, stored=V.STORED_SDWIS_STATIONS)
SAME_KEY = "s.SampleId = e.SampleId AND strftime(s.SampleDate, '%Y-%m-%d') = e.SampleDate AND s.Param = e.Param"

ORACLES["sdwis_results"] = db.end("SELECT * FROM extract")
ORACLES["sdwis_results_since"] = db.end(f"SELECT * FROM extract WHERE SampleDate > '{SINCE}'")
ORACLES["sdwis_results_by_key"] = db.end(f"SELECT * FROM extract e WHERE EXISTS (SELECT 1 FROM stored s WHERE {SAME_KEY})")
ORACLES["sdwis_results_by_sample"] = db.end("SELECT * FROM extract WHERE SampleId IN (SELECT SampleId FROM stored)")
ORACLES["sdwis_sample_ids"] = db.end(
    """SELECT DISTINCT sa.LAB_ASGND_ID_NUM AS SampleId FROM tinwsf f
JOIN tsasmppt pt ON f.TINWSF_IS_NUMBER = pt.TINWSF0IS_NUMBER JOIN tsasampl sa USING (TSASMPPT_IS_NUMBER)
JOIN tsasar r USING (TSASAMPL_IS_NUMBER)
WHERE f.TYPE_CODE IN ('SP', 'WL', 'IN', 'SS') AND r.CONCENTRATION_MSR IS NOT NULL"""
)
ORACLES["sdwis_stations"] = db_stations.end("SELECT * FROM extract")
ORACLES["sdwis_stations_by_id"] = db_stations.end(
    "SELECT * FROM extract WHERE CAST(StationId AS VARCHAR) IN (SELECT StationId FROM stored)"
)

# --- exported tables

ORACLES["exported_sample_ids"] = export.end("SELECT DISTINCT SampleId FROM exported")
ORACLES["exported_results_by_sample"] = export.end(
    "SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in EXPORT_FIELDS.items())
    + " FROM exported WHERE SampleId IN (SELECT 'E-' || c_custkey FROM {customer} WHERE c_acctbal < 0)"
)

# --- new and duplicate rows

ORACLES["distinct_sample_ids"] = raw.end("SELECT DISTINCT SampleId FROM raw")
ORACLES["distinct_station_ids"] = raw.end("SELECT DISTINCT StationId FROM raw")
stored_stations = stations.plus(stored=V.STORED_STATIONS)
ORACLES["new_stations"] = stored_stations.end(
    "SELECT DISTINCT raw_id AS StationId FROM stations WHERE raw_id NOT IN (SELECT StationId FROM stored)"
)
stored_results = raw.plus(stored=V.STORED_RESULTS)
ORACLES["new_results_by_sample"] = stored_results.end(
    "SELECT SampleId, StationId, Param, ResultValue, SampleDate FROM raw WHERE SampleId NOT IN (SELECT SampleId FROM stored)"
)
ORACLES["new_results_by_key"] = db.end(
    f"SELECT SampleDate, SampleId, Param, StationId, IdNum, ResultValue FROM extract e WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE {SAME_KEY})"
)
TWINS = "SELECT DISTINCT source_file, StationId FROM stations WHERE raw_id LIKE '%\\_WQX-%' ESCAPE '\\'"
twins = stations.plus(twins=TWINS)
KEEP = "raw_id LIKE '%\\_WQX-%' ESCAPE '\\' OR (source_file, StationId) NOT IN (SELECT (source_file, StationId) FROM twins)"
ORACLES["drop_wqx_twins"] = twins.end(f"SELECT raw_id AS StationId, Id, source_file FROM stations WHERE {KEEP}")
ORACLES["wqx_twin_ids"] = twins.end("SELECT DISTINCT StationId FROM twins")
ORACLES["remove_stored_wqx"] = twins.plus(stored=V.STORED_STATIONS).end(
    """SELECT DISTINCT raw_id AS StationId FROM stations
WHERE (SELECT count(*) FROM twins) = 0
   OR StationId IN (SELECT StationId FROM twins WHERE StationId NOT IN (SELECT StationId FROM stored))"""
)
ORACLES["stations_by_id"] = stored_stations.end(
    "SELECT raw_id AS StationId, Id, StationName FROM stations WHERE raw_id IN (SELECT StationId FROM stored)"
)

# --- incremental load

ORACLES["watermark"] = Sql(a=V.STORED_RESULTS, b=V.STORED_SDWIS).end(
    """SELECT DataSource, strftime(max(SampleDate), '%Y-%m-%d') AS SampleDate FROM
(SELECT DataSource, SampleDate FROM a UNION ALL SELECT DataSource, SampleDate FROM b) AS ab GROUP BY DataSource"""
)
ORACLES["group_by_sample"] = raw.end("SELECT SampleId, count(*) AS n_rows FROM raw GROUP BY SampleId")
ORACLES["group_by_key"] = db.end("SELECT SampleDate, SampleId, Param, StationId, count(*) AS n_rows FROM extract GROUP BY ALL")
ORACLES["distinct_params"] = ruled_rows.end("SELECT DISTINCT Param FROM ruled WHERE Param IS NOT NULL")
ORACLES["window_bbox"] = (
    raw.plus(**stations.views)
    # Dates that a source wrote for another century are outside any window.
    .end(
        f"""SELECT SampleId, StationId, SampleDate, Param FROM raw
WHERE CAST(l_shipdate AS DATE) BETWEEN '{WINDOW[0]}' AND '{WINDOW[1]}'
  AND NOT (l_linenumber = 2 AND l_discount IN (0.0, 0.01)) AND NOT (l_linenumber = 7 AND l_returnflag = 'R')
  AND StationId IN (SELECT raw_id FROM stations WHERE Lon_X BETWEEN -115 AND -108 AND Lat_Y BETWEEN 35.5 AND 42.5)"""
    )
)

# --- spatial


# Fixed values of the published sixth-order series on the GRS 80 ellipsoid: its
# coefficients, the scaled radius of the rectified meridian, and the eccentricity.
SERIES = (
    0.0008377318247285513,
    7.608527848149476e-07,
    1.1976455209422675e-09,
    2.4291706548410134e-12,
    5.711757817902035e-15,
    1.4911177751870803e-17,
)
RADIUS = 6364902.1661127405
ECCENTRICITY = 0.08181919104281579


def utm_sql(lon: str, lat: str, source: str) -> str:
    """Rows of ``source`` with utm_x, utm_y, by the published series."""
    xi = " + ".join(f"({a!r})::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(SERIES, 1))
    eta = " + ".join(f"({a!r})::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(SERIES, 1))
    radius = f"({RADIUS!r})::DOUBLE"
    e = f"({ECCENTRICITY!r})::DOUBLE"
    return f"""
SELECT * EXCLUDE (xi, eta), 500000 + {radius} * (eta + {eta}) AS utm_x, {radius} * (xi + {xi}) AS utm_y
FROM (SELECT * EXCLUDE (t, d), atan2(t, cos(d)) AS xi, asinh(sin(d) / sqrt(t * t + cos(d) * cos(d))) AS eta
FROM (SELECT *, radians(-abs({lon}) + 111) AS d,
  sinh(atanh(sin(radians({lat}))) - {e} * atanh({e} * sin(radians({lat})))) AS t FROM {source}) AS step1) AS step2"""


placed = stations.plus(placed=utm_sql("Lon_X", "Lat_Y", "stations"))
HAS_SHAPE = "Lon_X <> 0 AND Lat_Y <> 0"
SHAPES = (
    f"CASE WHEN {HAS_SHAPE} THEN {rounded('utm_x', 3)} END AS shape_x, CASE WHEN {HAS_SHAPE} THEN {rounded('utm_y', 3)} END AS shape_y"
)
ORACLES["reproject"] = placed.end(
    f"SELECT raw_id AS StationId, {rounded('utm_x', 3)} AS utm_x, {rounded('utm_y', 3)} AS utm_y FROM placed WHERE Lat_Y IS NOT NULL AND Lon_X <> 0"
)
ORACLES["station_shape"] = placed.end(f"SELECT raw_id AS StationId, {SHAPES} FROM placed")
points = Sql(points=V.EXPORTED_STATIONS).plus(
    used="SELECT * EXCLUDE (point_x, point_y), point_x AS Lon_X, point_y AS Lat_Y FROM points",
    placed=utm_sql("Lon_X", "Lat_Y", "used"),
)
ORACLES["exported_shape"] = points.end(f"SELECT StationId, {SHAPES} FROM placed")
ORACLES["utm_box"] = placed.end(
    f"""SELECT raw_id AS StationId FROM placed WHERE {HAS_SHAPE}
AND utm_x BETWEEN 138131.8383 AND 832275.2803 AND utm_y BETWEEN 3955431.5674 AND 4750305.616"""
)

COUNTY_OF = """
SELECT s.Id, min(state_code) AS state_code, min(county_code) AS county_code
FROM (SELECT *, -abs(Lon_X) AS lon, Lat_Y AS lat FROM stations) s JOIN counties c
  ON lat >= y0 AND lat < y1 AND lon >= x0
 AND lon < CASE WHEN kind = 0 THEN x1 ELSE x1 + (x0 - x1) * (lat - y0) / (y1 - y0) END
GROUP BY s.Id"""
COUNTIED = """
SELECT s.* EXCLUDE (StateCode, CountyCode),
  CASE WHEN StateCode IS NULL OR CountyCode IS NULL THEN f.state_code ELSE StateCode END AS StateCode,
  CASE WHEN StateCode IS NULL OR CountyCode IS NULL THEN f.county_code ELSE CountyCode END AS CountyCode
FROM stations s LEFT JOIN found f USING (Id)"""
countied = stations.plus(counties=V.COUNTIES, found=COUNTY_OF, countied=COUNTIED)
ORACLES["county_fill"] = countied.end("SELECT Id, raw_id AS StationId, StateCode, CountyCode FROM countied")


def elevated(source: str) -> str:
    return f"""
SELECT s.* EXCLUDE (Elev, ElevUnit),
  CASE WHEN lacks AND m IS NOT NULL THEN m ELSE Elev END AS Elev,
  CASE WHEN lacks AND m IS NOT NULL THEN 'meters' ELSE ElevUnit END AS ElevUnit,
  CASE WHEN lacks AND m IS NOT NULL THEN 'Other' END AS ElevMeth
FROM (SELECT *, Elev IS NULL OR Elev = 0 OR Elev > 20000 AS lacks FROM {source}) s
LEFT JOIN (SELECT cell_x, cell_y, min(elevation) AS m FROM grid GROUP BY ALL) g
  ON floor(-abs(Lon_X) / 0.5) = g.cell_x AND floor(Lat_Y / 0.5) = g.cell_y"""


ELEVATIONS = "Elev + 0.0 AS Elev, ElevUnit, ElevMeth"
ORACLES["elevation_fill"] = stations.plus(grid=V.ELEVATION, filled=elevated("stations")).end(
    f"SELECT Id, raw_id AS StationId, {ELEVATIONS} FROM filled"
)
ORACLES["post_process"] = countied.plus(grid=V.ELEVATION, filled=elevated("countied")).end(
    f"SELECT Id, raw_id AS StationId, StateCode, CountyCode, {ELEVATIONS} FROM filled"
)

# --- whole loads


def result_rows(tag: str, rows: str, derived: str, values: dict[str, str]) -> str:
    """Detail rows and balance rows in the shape the loads are compared in."""
    kinds = {f.name: NULL_OF.get(f.kind, "INTEGER" if f.kind == "short" else "VARCHAR") for f in S.RESULT}

    def line(source: str, columns: dict[str, str]) -> str:
        return f"SELECT {', '.join(columns.get(c, 'NULL::' + kinds[c]) + ' AS ' + c for c in RESULT_COLUMNS)} FROM {source}"

    details = line(rows, {"DataSource": f"'{tag}'", **values})
    if not derived:
        return details
    return details + " UNION ALL " + line(derived, {c: c for c in ("SampleId", "Param", "ResultValue", "Unit")})


WQP_VALUES = {
    **{c: c for c in ("DetectCond", "IdNum", "LabName", "Param", "ProjectId", "SampleDate", "SampleTime", "SampleId", "SampMedia", "Unit")},
    "MDL": "MDL + 0.0",
    "ParamGroup": GROUP,
    "ResultValue": rounded("ResultValue", 4),
    "StationId": "replace(StationId, '_WQX-', '-')",
}
ORACLES["transform_results_tail"] = by_sample.plus(derived=balance_rows("totals")).end(
    result_rows("WQP", "ruled", "derived", WQP_VALUES)
)
seeded = by_file.plus(derived=balance_rows("totals", "source_file, SampleId"))
ORACLES["seed_wqp"] = seeded.end(result_rows("WQP", "ruled", "derived", WQP_VALUES))

# The database's typed rows under the rules.
DB_TYPED = "SELECT *, NULL::VARCHAR AS DetectCond FROM extract WHERE SampleId IS NOT NULL"
DB_VALUES = {
    **{c: c for c in ("AnalysisDate", "CAS_Reg", "IdNum", "LabName", "MDLUnit", "OrgName", "Param", "SampleDate", "SampleId", "Unit")},
    **{c: rounded(c, 4) for c in ("Lat_Y", "Lon_X", "MDL")},
    "OrgId": "CAST(OrgId AS VARCHAR)",
    "ParamGroup": GROUP,
    "ResultValue": rounded("ResultValue", 4),
    "SampleTime": "'10:30:00'",
    "SampMedia": "CASE WHEN SampMedia IN ('WL', 'SP') THEN 'Groundwater' ELSE 'Surface Water' END",
    "StationId": "CAST(StationId AS VARCHAR)",
}
db_ruled = db.plus(db_typed=DB_TYPED, ruled=ruled("db_typed"))
db_chain = chain(db_ruled, "ruled").plus(derived=balance_rows("totals"))
ORACLES["seed_sdwis"] = db_chain.end(result_rows("SDWIS", "ruled", "derived", DB_VALUES))
STATION_KINDS = {f.name: NULL_OF.get(f.kind, "INTEGER" if f.kind == "short" else "VARCHAR") for f in S.STATION}


def station_rows(values: dict[str, str], source: str = "placed") -> str:
    """Stations in the shape the loads are compared in; what ``values`` lacks is NULL."""
    return f"SELECT {', '.join(values.get(c, 'NULL::' + STATION_KINDS[c]) + ' AS ' + c for c in STATION_COLUMNS)}, {SHAPES} FROM {source}"


STATION_VALUES = {
    **{c: c for c in ("StationId", "StationName", "StationType", "StateCode", "CountyCode", "ElevUnit", "ConstDate", "Id")},
    **{c: rounded(c, 3) for c in ("Lon_X", "Lat_Y")},
    "Elev": "Elev + 0.0",
    "DataSource": "'WQP'",
}
ORACLES["transform_stations_tail"] = placed.end(station_rows(STATION_VALUES))
ORACLES["seed_wqp_stations"] = placed.plus(twins=TWINS).end(station_rows(STATION_VALUES) + f" WHERE {KEEP}")

DB_STATION = {
    **{c: c for c in ("StationName", "OrgName", "DepthUnit", "HorCollMeth", "HorRef", "ElevMeth", "ElevRef")},
    **{c: rounded(c, 3) for c in ("Lon_X", "Lat_Y", "HorAcc", "Elev", "ElevAcc", "Depth")},
    "OrgId": "CAST(OrgId AS VARCHAR)",
    "StationId": "CAST(StationId AS VARCHAR)",
    "StationType": "CASE StationType WHEN 'SP' THEN 'Spring' WHEN 'WL' THEN 'Well' WHEN 'IN' THEN 'Stream' WHEN 'SS' THEN 'Facility' END",
    "DataSource": "'SDWIS'",
}
db_placed = db_stations.plus(placed=utm_sql("Lon_X", "Lat_Y", "extract"))
ORACLES["seed_sdwis_stations"] = db_placed.end(station_rows(DB_STATION))

EXPORT_VALUES = {
    **{c: c for c in ("Param", "SampleId", "StationId", "Unit")},
    "ParamGroup": GROUP,
    "ResultValue": rounded("ResultValue", 4),
    "SampleDate": "strftime(SampleDate, '%Y-%m-%d')",
}
export_chain = chain(export, "export_ruled").plus(derived=balance_rows("totals"))
ORACLES["seed_exported"] = export_chain.end(result_rows("UDOGM", "export_ruled", "derived", EXPORT_VALUES))
EXPORT_STATION = {
    "StationId": "StationId",
    "StationName": "StationName",
    "StationType": "'Other Groundwater'",
    "DataSource": "'UDOGM'",
}
ORACLES["seed_exported_stations"] = points.end(station_rows(EXPORT_STATION) + f" WHERE {HAS_SHAPE}")


def counted(sql: Sql, tag: str, rows: str) -> str:
    body = f"SELECT '{tag}' AS DataSource, ResultValue, SampleId FROM {rows} UNION ALL SELECT NULL, ResultValue, SampleId FROM derived"
    return f"SELECT * FROM ({sql.end(body)}) AS {tag.lower()}_load"


ORACLES["seed_all"] = (
    "SELECT DataSource, count(*) AS n_rows, count(ResultValue) AS n_values, count(DISTINCT SampleId) AS n_samples FROM ("
    + " UNION ALL ".join(
        [counted(seeded, "WQP", "ruled"), counted(db_chain, "SDWIS", "ruled")]
        + [counted(export_chain, tag, "export_ruled") for tag in ("UDOGM", "UDWR", "UGS")]
    )
    + ") AS everything GROUP BY DataSource"
)

# WQP update: from the last stored day on, samples not stored.
BOX = "Lon_X BETWEEN -115 AND -108 AND Lat_Y BETWEEN 35.5 AND 42.5"
FRESH = f"""
SELECT * FROM ruled WHERE SampleDate >= (SELECT strftime(max(SampleDate), '%Y-%m-%d') FROM stored)
  AND SampleId NOT IN (SELECT SampleId FROM stored) AND StationId IN (SELECT raw_id FROM stations WHERE {BOX})"""
fresh = ruled_rows.plus(**stations.views).plus(stored=V.STORED_RESULTS, fresh=FRESH)
fresh_chain = chain(fresh, "fresh").plus(derived=balance_rows("totals"))
ORACLES["update_wqp"] = fresh_chain.end(result_rows("WQP", "fresh", "derived", WQP_VALUES))
ORACLES["update_wqp_stations"] = (
    fresh.plus(**placed.views)
    .plus(
        stored_stations=V.STORED_STATIONS,
        new_ids="SELECT DISTINCT StationId AS id, replace(StationId, '_WQX-', '-') AS plain FROM fresh "
        "WHERE StationId NOT IN (SELECT StationId FROM stored_stations)",
        fresh_twins="SELECT DISTINCT plain FROM new_ids WHERE id <> plain AND plain NOT IN (SELECT StationId FROM stored_stations)",
        wanted="SELECT id FROM new_ids WHERE (SELECT count(*) FROM new_ids WHERE id <> plain) = 0 OR plain IN (SELECT plain FROM fresh_twins)",
        batch=f"SELECT * FROM placed WHERE raw_id IN (SELECT id FROM wanted) AND {BOX}",
    )
    .end(
        station_rows(STATION_VALUES, "batch") + " WHERE raw_id <> StationId "
        "OR StationId NOT IN (SELECT StationId FROM batch WHERE raw_id <> StationId)"
    )
)

DB_FRESH = f"""
SELECT * FROM db_typed e WHERE SampleDate > (SELECT strftime(max(SampleDate), '%Y-%m-%d') FROM stored)
  AND NOT EXISTS (SELECT 1 FROM stored s WHERE {SAME_KEY})"""
db_fresh = db.plus(db_typed=DB_TYPED, db_fresh=DB_FRESH, ruled=ruled("db_fresh"))
ORACLES["update_sdwis"] = db_fresh.end(result_rows("SDWIS", "ruled", "", DB_VALUES))
ORACLES["update_sdwis_stations"] = db_fresh.plus(
    results_extract="SELECT DISTINCT StationId FROM ruled",
    station_extract=SDWIS_STATIONS,
    stored_stations=V.STORED_SDWIS_STATIONS,
    placed=utm_sql("Lon_X", "Lat_Y", "station_extract"),
).end(
    station_rows(DB_STATION)
    + " WHERE StationId IN (SELECT StationId FROM results_extract)"
    " AND CAST(StationId AS VARCHAR) NOT IN (SELECT StationId FROM stored_stations)"
)
ORACLES["update_exported_deduped"] = (
    export_chain.plus(loaded=result_rows("UDOGM", "export_ruled", "derived", EXPORT_VALUES))
    .end("SELECT * FROM loaded WHERE SampleId NOT IN (SELECT 'E-' || c_custkey FROM {customer} WHERE c_acctbal < 5000)")
)

# --- landed files and stored tables

WQP_STATION_FIELDS = ("StationId", "StationName", "StationType", "Lon_X", "Lat_Y", "StateCode", "CountyCode", "Elev", "ElevUnit", "ConstDate")
ORACLES["read_wqp_results"] = Sql(landed=V.LANDED).end("SELECT * FROM landed")
ORACLES["read_wqp_stations"] = Sql(raw=V.RAW_STATIONS).end(
    f"SELECT {', '.join(f'nullif({c}, {chr(39) * 2}) AS {c}' for c in WQP_STATION_FIELDS)} FROM raw"
)
ORACLES["stored_results"] = ruled_rows.end(result_rows("WQP", "ruled", "", WQP_VALUES))
ORACLES["stored_params"] = ruled_rows.end("SELECT Param, count(*) AS n FROM ruled WHERE Param IS NOT NULL GROUP BY Param")
ORACLES["stored_stations"] = (
    placed.plus(counties=V.COUNTIES, found=COUNTY_OF, countied=COUNTIED.replace("FROM stations s", "FROM placed s"))
    .plus(grid=V.ELEVATION, filled=elevated("countied"))
    .end(station_rows({**STATION_VALUES, "ElevMeth": "ElevMeth"}, "filled"))
)

# --- SQL over CSV and streams

landed = Sql(landed=V.LANDED)
ORACLES["query_csv"] = landed.plus(
    people="SELECT 'E-' || CAST(c_custkey AS STRING) AS id, c_name, c_mktsegment FROM {customer}"
).end(
    """SELECT p.c_mktsegment, l.Param, l.ResultComment, count(*) AS n, max(l.ResultValue) AS largest_text
FROM landed AS l JOIN people AS p ON l.SampleId = p.id GROUP BY p.c_mktsegment, l.Param, l.ResultComment"""
)
ORACLES["query_csv_statements"] = landed.end(
    "SELECT StationId, min(SampleId) AS first_id, count(DISTINCT SampleId) AS n FROM landed WHERE Param LIKE 'S%' GROUP BY StationId"
)
LANDED_TYPED = """
SELECT * EXCLUDE (ResultValue), CAST(ResultValue AS DOUBLE) AS ResultValue, NULL::VARCHAR AS DetectCond FROM landed
WHERE SampleId NOT IN (SELECT SampleId FROM stored)"""
landed_chain = chain(
    landed.plus(stored=V.STORED_LANDED, landed_typed=LANDED_TYPED, ruled=ruled("landed_typed")), "ruled"
).plus(derived=balance_rows("totals"))
ORACLES["stream_ingest"] = landed_chain.end(
    f"""SELECT 'WQP' AS DataSource, SampleId, StationId, Param, {rounded('ResultValue', 4)} AS ResultValue, Unit, SampleDate, ResultComment FROM ruled
UNION ALL SELECT NULL, SampleId, NULL, Param, ResultValue, Unit, NULL, NULL FROM derived"""
)

# --- the jobs over stored tables -------------------------------------------------------

SPLIT_FIELDS = (
    "SampleId", "StationId", "Param", "ResultValue", "Unit", "DetectCond", "SampleDate", "SampleTime", "SampMedia", "MDL", "LabName", "ProjectId", "IdNum",
)
ORACLES["read_split_csv"] = Sql(raw=V.RAW_RESULTS).end("SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in SPLIT_FIELDS) + " FROM raw")
ORACLES["stored_keys"] = db.end(
    f"""SELECT DISTINCT SampleId, strftime(SampleDate, '%Y-%m-%d') AS SampleDate, Param FROM stored
WHERE SampleId IN (SELECT SampleId FROM extract WHERE SampleDate > '{SINCE}')"""
)
ORACLES["stored_after_failure"] = ORACLES["stored_results"]
ORACLES["seed_job"] = ORACLES["seed_all"]
ORACLES["update_job_wqp"] = ORACLES["update_wqp"]
ORACLES["update_job_sdwis"] = ORACLES["update_sdwis"]

# Samples at the four corners of the half-degree cell a station is in.
CORNERS = """SELECT cell_x, cell_y, min(elevation) AS m FROM grid GROUP BY ALL"""
BETWEEN = """
SELECT s.Id, sum(w * m) AS v FROM (
  SELECT Id, i + dx AS cx, j + dy AS cy, CASE WHEN dx = 1 THEN fx ELSE 1 - fx END * CASE WHEN dy = 1 THEN fy ELSE 1 - fy END AS w
  FROM (SELECT Id, floor(-abs(Lon_X) / 0.5) AS i, floor(Lat_Y / 0.5) AS j, -abs(Lon_X) / 0.5 - floor(-abs(Lon_X) / 0.5) AS fx,
      Lat_Y / 0.5 - floor(Lat_Y / 0.5) AS fy
    FROM stations WHERE Elev IS NULL OR Elev = 0 OR Elev > 20000), (VALUES (0), (1)) AS a(dx), (VALUES (0), (1)) AS b(dy)) s
LEFT JOIN corners c ON c.cell_x = cx AND c.cell_y = cy
WHERE w <> 0 GROUP BY s.Id HAVING count(*) = count(m)"""
ORACLES["elevation_tiles"] = stations.plus(grid=V.ELEVATION, corners=CORNERS, between_=BETWEEN).end(
    f"""SELECT Id, raw_id AS StationId, {rounded('coalesce(v, Elev)')} AS Elev, CASE WHEN v IS NOT NULL THEN 'meters' ELSE ElevUnit END AS ElevUnit,
  CASE WHEN v IS NOT NULL THEN 'Other' END AS ElevMeth FROM stations LEFT JOIN between_ USING (Id)"""
)
ORACLES["query_csv_any_case"] = landed.end("SELECT StationId, count(*) AS n FROM landed WHERE Param ILIKE 's%M' GROUP BY StationId")
ORACLES["typed_csv"] = typed.end(
    f"""SELECT Param, count(*) AS n, {rounded('sum(ResultValue)')} AS total, min(SampleDate) AS "first", sum(IdNum)::BIGINT AS ids,
  (SELECT count(ResultValue) + count(IdNum) FROM typed)::BIGINT AS bare FROM typed GROUP BY Param"""
)
