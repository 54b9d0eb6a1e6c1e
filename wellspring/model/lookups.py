"""Lookup and rule tables, stated as data.

Every table here is a fixed list, so its size does not depend on the input and
:func:`small_table` may hand it out with a broadcast hint. The callers that
accept a user's own table instead never hint it: Spark then chooses between a
broadcast and a shuffled join from the table's size.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sample media codes.
SAMPLE_MEDIA = {
    "WL": "Groundwater",
    "SP": "Groundwater",
    "SS": "Surface Water",
    "IN": "Surface Water",
}

# Station type -> harmonised class (the two blanks after
# "Reservoir," belong to the target value).
STATION_TYPES = {
    "Atmosphere": "Atmosphere",
    "CERCLA Superfund Site": "Other",
    "CG-2": "Other",
    "Canal Drainage": "Surface Water",
    "Canal Irrigation": "Surface Water",
    "Canal Transport": "Surface Water",
    "Cave": "Other Groundwater",
    "Combined Sewer": "Other",
    "Facility Industrial": "Other",
    "Facility Municipal Sewage (POTW)": "Other",
    "Facility Other": "Other",
    "Facility Privately Owned Non-industrial": "Facility",
    "Facility Public Water Supply (PWS)": "Facility",
    "Facility: Cistern": "Other",
    "Facility: Diversion": "Facility",
    "Facility: Laboratory or sample-preparation area": "Other",
    "Facility: Outfall": "Other",
    "Facility: Storm sewer": "Facility",
    "Facility: Waste injection well": "Other",
    "Facility: Wastewater land application": "Other",
    "Facility: Wastewater sewer": "Other",
    "Facility: Water-distribution system": "Facility",
    "GW": "Other Groundwater",
    "Lake": "Lake, Reservoir,  Impoundment",
    "Lake, Reservoir, Impoundment": "Lake, Reservoir,  Impoundment",
    "Lake; Sediment Pond; Stagnant water": "Lake, Reservoir,  Impoundment",
    "Land": "Land",
    "Land Runoff": "Land",
    "Land: Excavation": "Land",
    "Land: Outcrop": "Land",
    "Land: Sinkhole": "Land",
    "MD": "Other Groundwater",
    "Mine/Mine Discharge Adit (Mine Entrance)": "Other Groundwater",
    "Other": "Other",
    "Other-Ground Water": "Other Groundwater",
    "Reservoir": "Lake, Reservoir,  Impoundment",
    "River/Stream": "Stream",
    "River/Stream Ephemeral": "Stream",
    "River/Stream Perennial": "Stream",
    "SP": "Spring",
    "SW": "Surface Water",
    "IN": "Stream",
    "SS": "Facility",
    "Seep": "Spring",
    "Spring": "Spring",
    "Storm Sewer": "Other",
    "Stream": "Stream",
    "Stream: Canal": "Stream",
    "Stream: Ditch": "Stream",
    "Subsurface: Cave": "Other Groundwater",
    "Subsurface: Groundwater drain": "Other Groundwater",
    "Subsurface: Tunnel, shaft, or mine": "Other Groundwater",
    "UPDES Permit discharge point": "Other Groundwater",
    "WL": "Well",
    "Well": "Well",
    "Well: Collector or Ranney type well": "Well",
    "Well: Hyporheic-zone well": "Well",
    "Well: Multiple wells": "Well",
    "Well: Test hole not completed as a well": "Well",
    "Wetland": "Wetland",
    "Wetland Riverine-Emergent": "Wetland",
}


# Parameter names by analyte class.
MAJOR_METALS = (
    "calcium",
    "dissolved calcium",
    "dissolved magnesium",
    "dissolved potassium",
    "dissolved sodium",
    "magnesium",
    "potassium",
    "sodium",
    "sodium adsorption ratio",
    "sodium adsorption ratio [(na)/(sq root of 1/2 ca + mg)]",
    "sodium plus potassium",
    "sodium, percent total cations",
    "total calcium",
    "total magnesium",
    "total potassium",
    "total sodium",
    "percent sodium",
    "hypochlorite ion",
)
MAJOR_NONMETALS = (
    "acidity as caco3",
    "alkalinity",
    "alkalinity, bicarbonate as caco3",
    "alkalinity, carbonate as caco3",
    "alkalinity, hydroxide as caco3",
    "alkalinity, phenolphthalein (total hydroxide+1/2 carbonate)",
    "alkalinity, total",
    "alkalinity, total as caco3",
    "bicarbonate",
    "bicarbonate as caco3",
    "bicarbonate as hco3",
    "bromide",
    "carbon dioxide",
    "carbonate",
    "carbonate (co3)",
    "carbonate as caco3",
    "carbonate as co3",
    "chloride",
    "chlorine",
    "dissolved oxygen (do)",
    "dissolved oxygen (field)",
    "dissolved oxygen saturation",
    "fluoride",
    "fluorine",
    "gran acid neutralizing capacity",
    "hydrogen",
    "hydrogen ion",
    "hydroxide",
    "inorganic carbon",
    "oxygen",
    "silica",
    "silicon",
    "sulfate",
    "sulfide",
    "sulfur",
    "total alkalinity as caco3",
    "total carbon",
    "silica d/sio2",
    "t. alk/caco3",
    "alkalinity as cac03",
    "silica, dis. si02",
    "carbon, total",
    "chlorine dioxide",
    "chlorite",
    "residual chlorine",
    "hydroxide as calcium carbonate",
    "hydrogen sulfide",
    "alkalinity, caco3 stability",
    "acidity, total (caco3)",
    "acidity, m.o. (caco3)",
    "alkalinity, bicarbonate",
    "alkalinity, carbonate",
    "alkalinity, phenolphthalein",
    "total chlorine",
    "combined chlorine",
    "perchlorate",
    "free residual chlorine",
)
MINOR_NONMETALS = (
    "antimony",
    "argon",
    "arsenate (aso43-)",
    "arsenic",
    "arsenite",
    "boron",
    "bromine",
    "cyanide",
    "cyanides amenable to chlorination (hcn & cn)",
    "dissolved arsenic",
    "dissolved boron",
    "dissolved selenium",
    "germanium",
    "helium",
    "iodide",
    "krypton",
    "neon",
    "perchlorate",
    "selenium",
    "sulfur hexafluoride",
    "tellurium",
    "total arsenic",
    "total boron",
    "total selenium",
    "xenon",
    "chlorate",
    "antimony, total",
    "boron, total",
    "asbestos",
)
MINOR_METALS = (
    "aluminum",
    "barium",
    "beryllium",
    "bismuth",
    "cadmium",
    "cerium",
    "cesium",
    "chromium",
    "chromium(iii)",
    "chromium(vi)",
    "cobalt",
    "copper",
    "dissolved aluminum",
    "dissolved barium",
    "dissolved cadmium",
    "dissolved chromium",
    "dissolved copper",
    "dissolved iron",
    "dissolved lead",
    "dissolved manganese",
    "dissolved mercury",
    "dissolved molybdenum",
    "dissolved nickel",
    "dissolved zinc",
    "dysprosium",
    "erbium",
    "europium",
    "gadolinium",
    "gallium",
    "holmium",
    "iron",
    "iron, ion (fe2+)",
    "lanthanum",
    "lead",
    "lithium",
    "lutetium",
    "manganese",
    "mercury",
    "molybdenum",
    "neodymium",
    "nickel",
    "niobium",
    "praseodymium",
    "rhenium",
    "rubidium",
    "samarium",
    "scandium",
    "silver",
    "strontium",
    "terbium",
    "thallium",
    "thulium",
    "tin",
    "titanium",
    "total aluminum",
    "total barium",
    "total cadmium",
    "total chromium",
    "total copper",
    "total iron",
    "total iron-d max, dmr",
    "total lead",
    "total manganese",
    "total mercury",
    "total molybdenum",
    "total nickel",
    "total zinc",
    "tungsten",
    "vanadium",
    "ytterbium",
    "yttrium",
    "zinc",
    "zirconium",
    "iron, dissolved",
    "chromium, hex, as cr",
    "copper, free",
    "iron, suspended",
    "manganese, suspended",
    "beryllium, total",
    "bismuth, total",
    "chromium, hex",
    "cobalt, total",
    "lithium, total",
    "molybdenum, total",
    "thallium, total",
    "tin, total",
    "titanium, total",
    "vanadium, total",
    "lead summary",
    "copper summary",
    "manganese, dissolved",
)
NUTRIENTS = (
    "ammonia",
    "ammonia and ammonium",
    "ammonia as n",
    "ammonia as nh3",
    "ammonia-nitrogen",
    "ammonia-nitrogen as n",
    "ammonium",
    "ammonium as n",
    "dissolved nitrate: no3",
    "inorganic nitrogen (nitrate and nitrite)",
    "inorganic nitrogen (nitrate and nitrite) as n",
    "kjeldahl nitrogen",
    "nitrate",
    "nitrate as n",
    "nitrate-nitrogen",
    "nitrite",
    "nitrite as n",
    "nitrogen",
    "orthophosphate",
    "nitrogen, ammonium/ammonia ratio",
    "dissolved nitrite: no2",
    "nitrogen, mixed forms (nh3), (nh4), organic, (no2) and (no3)",
    "no2+no3 as n",
    "organic nitrogen",
    "ortho. phosphate",
    "orthophosphate as p",
    "phosphate",
    "phosphate-phosphorus",
    "phosphate-phosphorus as p",
    "phosphate-phosphorus as po4",
    "phosphorus",
    "total phosphorus",
    "nitrate + nitrite as n",
    "phosphate, tot. dig. (as p)",
    "t.k.n.",
    "phosphorus 0 as p",
    "nitrogen-ammonia as (n)",
    "nitrate-nitrite",
    "phosphate, total",
    "total kjeldahl nitrogen (in water mg/l)",
    "phosphorus, soluble",
    "phosphate, reactive",
    "phosphorus, total",
)

# Parameter group of each analyte class. The first class that
# lists a name wins ("perchlorate" is in two).
CLASS_GROUPS = (
    ("inorganics, minor, non-metals", MINOR_NONMETALS),
    ("inorganics, minor, metals", MINOR_METALS),
    ("inorganics, major, metals", MAJOR_METALS),
    ("inorganics, major, non-metals", MAJOR_NONMETALS),
    ("nutrient", NUTRIENTS + ("nitrate and nitrite as no3",)),
)

# Conversion factors between reporting bases.
N_TO_NO3 = 4.426802887
N_TO_NO2 = 3.284535258
P_TO_PO4 = 3.131265779
CACO3_TO_CO3 = 0.60
CACO3_TO_HCO3 = 1.22
S_TO_SO4 = 0.333792756
NH4_TO_NH3 = 1.05918619
N_TO_NH3 = 1.21587526

MG, UG, AS_N, AS_P, AS_CACO3 = "mg/l", "ug/l", "mg/l as n", "mg/l as p", "mg/l as caco3"

# Unit rules, first match wins. Each rule is
# (parameters, units, factor, new unit, new parameter); None leaves a field alone.
UNIT_RULES = (
    (MAJOR_METALS + MAJOR_NONMETALS, (UG,), 0.001, MG, None),
    (MINOR_METALS + MINOR_NONMETALS, (MG,), 1000.0, UG, None),
    (NUTRIENTS, (UG,), 0.001, MG, None),
    (("nitrate",), (AS_N,), N_TO_NO3, MG, None),
    (("nitrite",), (AS_N,), N_TO_NO2, MG, None),
    (("phosphate",), (AS_P,), P_TO_PO4, MG, None),
    (("carbonate as caco3",), (MG,), CACO3_TO_CO3, MG, "carbonate"),
    (("bicarbonate as caco3",), (MG, AS_CACO3), CACO3_TO_HCO3, MG, "bicarbonate"),
    (("alkalinity, bicarbonate as caco3",), (MG,), CACO3_TO_HCO3, MG, "bicarbonate"),
    (("alkalinity, carbonate",), (AS_CACO3,), CACO3_TO_CO3, MG, "carbonate"),
    (("carbonate as co3", "carbonate (co3)"), (MG,), None, None, "carbonate"),
    (("bicarbonate as hco3",), (MG,), None, None, "bicarbonate"),
    (("alkalinity, carbonate as caco3",), (AS_CACO3,), CACO3_TO_CO3, MG, "carbonate based on alkalinity"),
    (("alkalinity, bicarbonate", "alkalinity"), (AS_CACO3,), CACO3_TO_HCO3, MG, "bicarbonate based on alkalinity"),
    (("t.alk/caco3", "total alkalinity as caco3"), (MG,), CACO3_TO_HCO3, MG, "bicarbonate based on alkalinity"),
    (("bicarbonate",), (AS_CACO3,), CACO3_TO_HCO3, MG, None),
    (("phosphate-phosphorus",), (AS_P, MG), P_TO_PO4, MG, "phosphate"),
    (("sulfate as s",), (MG,), S_TO_SO4, MG, "sulfate"),
    (("nitrate-nitrogen",), (AS_N,), N_TO_NO3, MG, "nitrate"),
    (("nitrate as n",), (AS_N, MG), N_TO_NO3, MG, "nitrate"),
    (("nitrate-nitrogen",), (MG,), N_TO_NO3, MG, "nitrite"),
    (("nitrite as n",), (AS_N, MG), N_TO_NO2, MG, "nitrite"),
    (
        (
            "nitrate-nitrite",
            "inorganic nitrogen (nitrate and nitrite) as n",
            "nitrate + nitrate as n",
            "no2+no3 as n",
        ),
        (AS_N, MG),
        N_TO_NO3,
        MG,
        "nitrate and nitrite as no3",
    ),
    (("phosphate-phosphorus as p", "orthophosphate as p"), (AS_P, MG), P_TO_PO4, MG, "phosphate"),
    (("orthophosphate",), (AS_P,), P_TO_PO4, MG, "phosphate"),
    (("ammonia and ammonium",), ("mg/l nh4",), NH4_TO_NH3, MG, "ammonia"),
    (("ammonia-nitrogen as n", "ammonia-nitrogen"), (AS_N, MG), N_TO_NH3, MG, "ammonia"),
    (("ammonia",), (AS_N,), N_TO_NH3, MG, "ammonia"),
    (("specific conductance",), ("ms/cm",), 1000.0, "uS/cm", None),
    (("specific conductance",), ("umho/cm",), None, "uS/cm", None),
    (("calcium",), ("ueq/l",), 20.039, MG, None),
    (("magnesium",), ("ueq/l",), 12.1525, MG, None),
    (("potassium",), ("ueq/l",), 39.0983, MG, None),
    (("sodium",), ("ueq/l",), 22.9897, MG, None),
    (("nitrate",), ("ueq/l",), 62.0049, MG, None),
    (("chloride",), ("ueq/l",), 35.453, MG, None),
    (("hydroxide",), ("ueq/l",), 17.0073, MG, None),
    (("sulfate",), ("ueq/l",), 24.01565, MG, None),
)

# Fixed value: an extra rule some users want for nitrate reported as nitrogen by
# the drinking-water source. Off unless asked for by its source tag.
SOURCE_RULES = {"SDWIS": ((("nitrate",), (MG,), N_TO_NO3, MG, "nitrate"),)}

# The eleven ions of the charge balance, the parameter names that
# report each of them, and their meq/l per mg/l.
ION_PARAMETERS = {
    "ca": ("calcium", "dissolved calcium", "total calcium"),
    "mg": ("magnesium", "dissolved magnesium", "total magnesium"),
    "na": ("sodium", "dissolved sodium", "total sodium"),
    "k": ("potassium", "dissolved potassium", "total potassium"),
    "na+k": ("sodium plus potassium",),
    "cl": ("chloride",),
    "hco3": ("bicarbonate", "bicarbonate as hco3", "bicarbonate based on alkalinity"),
    "co3": ("carbonate", "carbonate (co3)", "carbonate as co3", "carbonate based on alkalinity"),
    "so4": ("sulfate", "sulfate as so4", "sulphate"),
    "no2": ("nitrite", "dissolved nitrite: no2"),
    "no3": ("nitrate", "dissolved nitrate: no3", "nitrate and nitrite as no3"),
}
MEQ_FACTORS = {
    "ca": 0.04990269,
    "mg": 0.082287595,
    "na": 0.043497608,
    "na+k": 0.043497608,
    "k": 0.02557656,
    "cl": 0.028206596,
    "hco3": 0.016388838,
    "co3": 0.033328223,
    "so4": 0.020833333,
    "no2": 0.021736513,
    "no3": 0.016129032,
}

# Source names as a user types them, and the tag they store.
SOURCE_TAGS = {"WQP": "WQP", "SDWIS": "SDWIS", "DOGM": "UDOGM", "UDWR": "UDWR", "UGS": "UGS"}


def small_table(spark: SparkSession, columns: dict[str, list], types: dict[str, pa.DataType] | None = None) -> DataFrame:
    """A fixed table as a local relation, hinted for broadcast.

    Arrow input below Spark's local-relation threshold becomes a
    ``LocalRelation``, so the optimizer knows its exact size and no Python
    worker takes part in the job.
    """
    types = types or {}
    table = pa.table({name: pa.array(values, types.get(name, pa.string())) for name, values in columns.items()})
    return F.broadcast(spark.createDataFrame(table))


def unit_rule_rows(rules=UNIT_RULES, source: str | None = None) -> dict[tuple[str, str], tuple]:
    """Rules expanded to one entry per (parameter, unit); the first rule wins."""
    expanded: dict[tuple[str, str], tuple] = {}
    for params, units, *effect in tuple(rules) + SOURCE_RULES.get(source or "", ()):
        for param in params:
            for unit in units:
                expanded.setdefault((param, unit), tuple(effect))
    return expanded


def unit_rules(spark: SparkSession, source: str | None = None) -> DataFrame:
    """Built-in unit rules as a table: param, unit, factor, new_unit, new_param."""
    rows = unit_rule_rows(source=source)
    return small_table(
        spark,
        {
            "param": [param for param, _ in rows],
            "unit": [unit for _, unit in rows],
            "factor": [effect[0] for effect in rows.values()],
            "new_unit": [effect[1] for effect in rows.values()],
            "new_param": [effect[2] for effect in rows.values()],
        },
        {"factor": pa.float64()},
    )


def station_types(spark: SparkSession) -> DataFrame:
    return small_table(spark, {"type": list(STATION_TYPES), "new_type": list(STATION_TYPES.values())})


def param_groups(spark: SparkSession) -> DataFrame:
    """Default parameter groups: every name of an analyte class gets its group."""
    groups: dict[str, str] = {}
    for group, members in CLASS_GROUPS:
        for name in members:
            groups.setdefault(name, group)
    return small_table(spark, {"param": list(groups), "param_group": list(groups.values())})


def ions(spark: SparkSession) -> DataFrame:
    """Parameter name -> ion code; a bare code names itself."""
    pairs = [(name, ion) for ion, members in ION_PARAMETERS.items() for name in (*members, ion)]
    return small_table(spark, {"param": [p for p, _ in pairs], "ion": [i for _, i in pairs]})
