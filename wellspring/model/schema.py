"""The three target tables and the column maps of the source programs.

Field kinds and how they are stored:

=========  ====================================================
string     text, cut to ``length`` when one is declared
short      32-bit integer
long       64-bit integer
double     double
float      declared by the model but has no cast rule, always NULL
date       timestamp while casting, day when stored
time       ``HH:mm:ss`` text
geometry   WKT text, filled by :mod:`wellspring.operators.spatial`
=========  ====================================================
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    length: int | None = None
    label: str = ""


# Names, order, kinds and lengths of the station table (33 fields).
STATION = (
    Field("OrgId", "string", 20, "Organization Id"),
    Field("OrgName", "string", 100, "Organization Name"),
    Field("StationId", "string", 100, "Monitoring Location Id"),
    Field("StationName", "string", 100, "Monitoring Location Name"),
    Field("StationType", "string", 100, "Monitoring Location Type"),
    Field("StationComment", "string", 1500, "Monitoring Location Description"),
    Field("HUC8", "string", 8, "HUC 8 Digit Code"),
    Field("Lon_X", "double", None, "Longitude"),
    Field("Lat_Y", "double", None, "Latitude"),
    Field("HorAcc", "double", None, "Horizontal Accuracy"),
    Field("HorAccUnit", "string", 10, "Horizontal Accuracy Unit"),
    Field("HorCollMeth", "string", 100, "Horizontal Collection Method"),
    Field("HorRef", "string", 10, "Horizontal Reference Datum"),
    Field("Elev", "double", None, "Elevation"),
    Field("ElevUnit", "string", 15, "Elevation Unit"),
    Field("ElevAcc", "double", None, "Elevation Accuracy"),
    Field("ElevAccUnit", "string", 4, "Elevation Accuracy Units"),
    Field("ElevMeth", "string", 100, "Elevation Collection Method"),
    Field("ElevRef", "string", 12, "Elevation Reference Datum"),
    Field("StateCode", "short", None, "State Code"),
    Field("CountyCode", "short", None, "County Code"),
    Field("Aquifer", "string", 100, "Aquifer"),
    Field("FmType", "string", 100, "Formation Type"),
    Field("AquiferType", "string", 100, "Aquifer Type"),
    Field("ConstDate", "date", None, "Construction Date"),
    Field("Depth", "double", None, "Well Depth"),
    Field("DepthUnit", "string", 10, "Well Depth Units"),
    Field("HoleDepth", "double", None, "Hole Depth"),
    Field("HoleDUnit", "string", 10, "Hole Depth Units"),
    Field("demELEVm", "double", None, "DEM Elevation m"),
    Field("DataSource", "string", 20, "Database Source"),
    Field("WIN", "long", None, "WR Well Id"),
    Field("Shape", "geometry", None, "Shape"),
)

# Names, order, kinds and lengths of the result table (42 fields).
RESULT = (
    Field("AnalysisDate", "date", None, "Analysis Start Date"),
    Field("AnalytMeth", "string", 150, "Analytical Method Name"),
    Field("AnalytMethId", "string", 50, "Analytical Method Id"),
    Field("AutoQual", "string", None, "Auto Quality Check"),
    Field("CAS_Reg", "string", 50, "CAS Registry"),
    Field("Chrg", "float", None, "Charge"),
    Field("DataSource", "string", None, "Database Source"),
    Field("DetectCond", "string", 50, "Result Detection Condition"),
    Field("IdNum", "long", None, "Unique Id"),
    Field("LabComments", "string", 500, "Laboratory Comment"),
    Field("LabName", "string", 100, "Laboratory Name"),
    Field("Lat_Y", "double", None, "Latitude"),
    Field("LimitType", "string", 250, "Detection Limit Type"),
    Field("Lon_X", "double", None, "Longitude"),
    Field("MDL", "double", None, "Detection Quantitation Limit"),
    Field("MDLUnit", "string", 50, "Detection Quantitation Limit Unit"),
    Field("MethodDescript", "string", 100, "Method Description"),
    Field("OrgId", "string", 50, "Organization Id"),
    Field("OrgName", "string", 150, "Organization Name"),
    Field("Param", "string", 500, "Parameter"),
    Field("ParamGroup", "string", None, "Parameter Group"),
    Field("ProjectId", "string", 50, "Project Id"),
    Field("QualCode", "string", 50, "Measure Qualifier Code"),
    Field("ResultComment", "string", 1500, "Result Comment"),
    Field("ResultStatus", "string", 50, "Result Status"),
    Field("ResultValue", "double", None, "Result Measure Value"),
    Field("SampComment", "string", 50, "Sample Comment"),
    Field("SampDepth", "double", None, "Sample Depth"),
    Field("SampDepthRef", "string", 50, "Sample Depth Reference"),
    Field("SampDepthU", "string", 50, "Sample Depth Units"),
    Field("SampEquip", "string", 75, "Collection Equipment"),
    Field("SampFrac", "string", 50, "Result Sample Fraction"),
    Field("SampleDate", "date", None, "Sample Date"),
    Field("SampleTime", "time", None, "Sample Time"),
    Field("SampleId", "string", 100, "Sample Id"),
    Field("SampMedia", "string", 50, "Sample Media"),
    Field("SampMeth", "string", 50, "Collection Method"),
    Field("SampMethName", "string", 75, "Collection Method Name"),
    Field("SampType", "string", 75, "Sample Type"),
    Field("StationId", "string", 50, "Station Id"),
    Field("Unit", "string", 50, "Result Measure Unit"),
    Field("USGSPCode", "string", 50, "USGS P Code"),
)

# Source column -> target column of the station CSV extract.
WQP_STATION_COLUMNS = {
    "OrganizationIdentifier": "OrgId",
    "OrganizationFormalName": "OrgName",
    "MonitoringLocationIdentifier": "StationId",
    "MonitoringLocationName": "StationName",
    "MonitoringLocationTypeName": "StationType",
    "MonitoringLocationDescriptionText": "StationComment",
    "HUCEightDigitCode": "HUC8",
    "LongitudeMeasure": "Lon_X",
    "LatitudeMeasure": "Lat_Y",
    "HorizontalAccuracyMeasure/MeasureValue": "HorAcc",
    "HorizontalAccuracyMeasure/MeasureUnitCode": "HorAccUnit",
    "HorizontalCollectionMethodName": "HorCollMeth",
    "HorizontalCoordinateReferenceSystemDatumName": "HorRef",
    "VerticalMeasure/MeasureValue": "Elev",
    "VerticalMeasure/MeasureUnitCode": "ElevUnit",
    "VerticalAccuracyMeasure/MeasureValue": "ElevAcc",
    "VerticalAccuracyMeasure/MeasureUnitCode": "ElevAccUnit",
    "VerticalCollectionMethodName": "ElevMeth",
    "VerticalCoordinateReferenceSystemDatumName": "ElevRef",
    "StateCode": "StateCode",
    "CountyCode": "CountyCode",
    "AquiferName": "Aquifer",
    "FormationTypeText": "FmType",
    "AquiferTypeName": "AquiferType",
    "ConstructionDateText": "ConstDate",
    "WellDepthMeasure/MeasureValue": "Depth",
    "WellDepthMeasure/MeasureUnitCode": "DepthUnit",
    "WellHoleDepthMeasure/MeasureValue": "HoleDepth",
    "WellHoleDepthMeasure/MeasureUnitCode": "HoleDUnit",
}

# Source column -> target column of the result CSV extract.
WQP_RESULT_COLUMNS = {
    "AnalysisStartDate": "AnalysisDate",
    "ResultAnalyticalMethod/MethodName": "AnalytMeth",
    "ResultAnalyticalMethod/MethodIdentifier": "AnalytMethId",
    "ResultDetectionConditionText": "DetectCond",
    "ResultLaboratoryCommentText": "LabComments",
    "LaboratoryName": "LabName",
    "DetectionQuantitationLimitTypeName": "LimitType",
    "DetectionQuantitationLimitMeasure/MeasureValue": "MDL",
    "DetectionQuantitationLimitMeasure/MeasureUnitCode": "MDLUnit",
    "MethodDescriptionText": "MethodDescript",
    "OrganizationIdentifier": "OrgId",
    "OrganizationFormalName": "OrgName",
    "CharacteristicName": "Param",
    "ProjectIdentifier": "ProjectId",
    "MeasureQualifierCode": "QualCode",
    "ResultCommentText": "ResultComment",
    "ResultStatusIdentifier": "ResultStatus",
    "ResultMeasureValue": "ResultValue",
    "ActivityCommentText": "SampComment",
    "ActivityDepthHeightMeasure/MeasureValue": "SampDepth",
    "ActivityDepthAltitudeReferencePointText": "SampDepthRef",
    "ActivityDepthHeightMeasure/MeasureUnitCode": "SampDepthU",
    "SampleCollectionEquipmentName": "SampEquip",
    "ResultSampleFractionText": "SampFrac",
    "ActivityStartDate": "SampleDate",
    "ActivityStartTime/Time": "SampleTime",
    "ActivityIdentifier": "SampleId",
    "ActivityMediaSubdivisionName": "SampMedia",
    "SampleCollectionMethod/MethodIdentifier": "SampMeth",
    "SampleCollectionMethod/MethodName": "SampMethName",
    "ActivityTypeCode": "SampType",
    "MonitoringLocationIdentifier": "StationId",
    "ResultMeasure/MeasureUnitCode": "Unit",
    "USGSPCode": "USGSPCode",
}

_STORED = {
    "string": T.StringType(),
    "short": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.DoubleType(),
    "date": T.DateType(),
    "time": T.StringType(),
    "geometry": T.StringType(),
}

_COORDINATES = ("Lon_X", "Lat_Y")


def names(fields) -> list[str]:
    return [f.name for f in fields]


def working_type(field: Field) -> T.DataType:
    """Type of a field between cast and write."""
    return T.TimestampNTZType() if field.kind == "date" else _STORED[field.kind]


def stored_type(field: Field) -> T.DataType:
    """Type of a field in the target table."""
    return T.DecimalType(9, 6) if field.name in _COORDINATES else _STORED[field.kind]


def stored_schema(fields) -> T.StructType:
    """Table layout: a surrogate ``Id`` followed by the declared fields."""
    return T.StructType(
        [T.StructField("Id", T.LongType())]
        + [T.StructField(f.name, stored_type(f)) for f in fields]
    )


PARAMS_SCHEMA = T.StructType([T.StructField("Param", T.StringType())])
