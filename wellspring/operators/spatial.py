"""Station shapes, county codes and elevations.

Points and polygons meet in an equi join on grid cells. A cell keeps only the edges that
touch it, and whether one of its corners is inside; a cell with many edges is cut into
smaller ones. So a point is tested against a few edges however many a polygon has, and
in a cell without edges against none.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.utm import with_utm
from ..session import staged

#: Cell edge of the county index in degrees, a power of two.
COUNTY_CELL = 0.25
#: Edges from which on a cell is cut into four, and how often at most.
MOST_EDGES = 32
DEEPEST = 16
#: Cell edge of the elevation grid in degrees.
ELEVATION_CELL = 0.01
#: Cells along the side of an elevation tile.
TILE = 64


def add_shape(df: DataFrame, keep_xy: bool = False) -> DataFrame:
    """WKT point in UTM 12N.

    An explicit point (columns point_x, point_y) is used when the table has
    one, otherwise Lon_X / Lat_Y. A missing or zero coordinate gives no shape.
    """
    own_point = {"point_x", "point_y"} <= set(df.columns)
    lon, lat = (F.col("point_x"), F.col("point_y")) if own_point else (F.col("Lon_X"), F.col("Lat_Y"))
    usable = (lon != 0) & (lat != 0)
    df = with_utm(df, F.when(usable, lon), F.when(usable, lat))
    wkt = F.concat(F.lit("POINT ("), F.col("utm_x").cast("string"), F.lit(" "), F.col("utm_y").cast("string"), F.lit(")"))
    df = df.withColumn("Shape", wkt)
    spent = ["point_x", "point_y"] if own_point else []
    return df.drop(*spent) if keep_xy else df.drop("utm_x", "utm_y", *spent)


def reproject_points(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Add utm_x and utm_y for a longitude / latitude pair."""
    return with_utm(df, F.col(lon), F.col(lat))


def cell_of(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size))


def western(lon: Column) -> Column:
    """A longitude as a number; a positive one lacks its sign."""
    return F.when(lon > 0, -lon).otherwise(lon).cast("double")


def county_edges(counties: DataFrame) -> DataFrame:
    """(state_code, county_code, x1, y1, x2, y2): the edges of all rings, lower end
    first, so that two neighbours compute a shared edge alike.

    Input: state_code, county_code and ``rings``, an array of closed or open rings of
    struct(x, y); the even-odd rule makes inner rings holes.
    """
    def edges_of(ring: Column) -> Column:
        last = F.size(ring)
        return F.transform(
            F.sequence(F.lit(1), last),
            lambda i: F.struct(
                F.element_at(ring, i).alias("a"),
                F.element_at(ring, F.when(i == last, F.lit(1)).otherwise(i + 1)).alias("b"),
            ),
        )

    rings = counties.select("state_code", "county_code", F.explode("rings").alias("ring")).where(F.size("ring") >= 3)
    edges = rings.select("state_code", "county_code", F.explode(edges_of(F.col("ring"))).alias("e"))
    flip = F.col("e.a.y") > F.col("e.b.y")
    low, high = F.when(flip, F.col("e.b")).otherwise(F.col("e.a")), F.when(flip, F.col("e.a")).otherwise(F.col("e.b"))
    return edges.select("state_code", "county_code", low.alias("low"), high.alias("high")).select(
        "state_code", "county_code", *(F.col(f"{end}.{c}").cast("double").alias(f"{c}{n}") for n, end in ((1, "low"), (2, "high")) for c in ("x", "y"))
    )


def x_at(e, y: Column) -> Column:
    """Where an edge that is not level meets the latitude ``y``; exact at its ends."""
    return F.when(y == e["y2"], e["x2"]).otherwise(e["x1"] + (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]))


def _edge() -> dict[str, Column]:
    """The columns of an edge by name, as :func:`x_at` takes them."""
    return {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}


def _touching(edges: DataFrame) -> DataFrame:
    """Of pairs of an edge and a cell (cell_x, cell_y, size) those that touch."""
    e, size = _edge(), F.col("size")
    slack = size * 1e-6
    west, south = F.col("cell_x") * size - slack, F.col("cell_y") * size - slack
    east, north = (F.col("cell_x") + 1) * size + slack, (F.col("cell_y") + 1) * size + slack
    level = e["y1"] == e["y2"]
    # The part of the edge within the cell's band of latitude.
    xs = [F.when(level, x).otherwise(x_at(e, y)) for x, y in ((e["x1"], F.greatest(e["y1"], south)), (e["x2"], F.least(e["y2"], north)))]
    return edges.where((e["y1"] <= north) & (e["y2"] >= south)).where((F.least(*xs) <= east) & (F.greatest(*xs) >= west))


CELL = ("state_code", "county_code", "level", "size", "cell_x", "cell_y")


def county_index(counties: DataFrame, size: float = COUNTY_CELL, most: int = MOST_EDGES) -> tuple[DataFrame, list[int]]:
    """(cells of all counties, their levels): state_code, county_code, level, cell_x,
    cell_y, the cell's ``east`` and ``south`` side, ``corner`` (whether its corner there
    is inside the county) and ``edges``, those that touch the cell.

    Cells of level 0 have the edge ``size``, a power of two. A cell that more than
    ``most`` edges touch is cut into four of the next level, down to ``DEEPEST``. Cells
    that no edge touches are wholly inside, as those outside are left out.

    This runs a few small jobs over the counties, one per level.
    """
    if math.frexp(size)[0] != 0.5:
        raise ValueError(f"the size of cells must be a power of two: {size}")
    all_edges = staged(county_edges(counties), "edges")
    e = _edge()
    spans = {"cell_x": (F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])), "cell_y": (e["y1"], e["y2"])}
    pairs = all_edges.withColumns({"level": F.lit(0), "size": F.lit(size)})
    slack = size * 1e-6  # an edge on a cell's side touches the cells on both sides
    for name, (low, high) in spans.items():
        pairs = pairs.withColumn(name, F.explode(F.sequence(cell_of(low - slack, size), cell_of(high + slack, size))))
    pairs = staged(_touching(pairs), "edges")
    box = all_edges.groupBy("state_code", "county_code").agg(
        *(f(cell_of(v, size)).alias(f"{name}_{n}") for name, span in spans.items() for v, f, n in zip(span, (F.min, F.max), ("lo", "hi"), strict=True))
    )
    cells = box.withColumns({"level": F.lit(0), "size": F.lit(size)})
    for name in spans:
        cells = cells.withColumn(name, F.explode(F.sequence(f"{name}_lo", f"{name}_hi")))
    parts, levels = [], []
    for level in range(DEEPEST + 1):
        held = pairs.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))
        heavy = staged(held.where(F.col("n") > (most if level < DEEPEST else 1 << 62)).select(*CELL), "heavy")
        levels.append(level)
        if heavy.isEmpty():
            parts.append((cells.select(*CELL), pairs))
            break
        parts.append((cells.select(*CELL).join(heavy, list(CELL), "left_anti"), pairs.join(heavy, list(CELL), "left_anti")))

        def quartered(df: DataFrame) -> DataFrame:
            df = df.withColumns({"level": F.col("level") + 1, "size": F.col("size") / 2})
            for name in spans:
                df = df.withColumn(name, F.explode(F.array(F.col(name) * 2, F.col(name) * 2 + 1)))
            return df

        pairs = staged(_touching(quartered(pairs.join(heavy, list(CELL), "left_semi"))), "edges")
        cells = quartered(heavy)
    leaves, touched = (reduce(DataFrame.unionByName, p) for p in zip(*parts, strict=True))
    # A corner is inside if an odd number of edges lies east of it on its parallel:
    # corners and edges of a parallel in order from the east.
    south = F.col("cell_y") * F.col("size")
    corners = leaves.withColumns({"at": (F.col("cell_x") + 1) * F.col("size"), "crossing": F.lit(0)})
    lines = leaves.select("state_code", "county_code", "level", "size", "cell_y").distinct()
    steep = all_edges.where(e["y1"] < e["y2"]).withColumn("size", F.explode(F.array(*(F.lit(size / 2**level) for level in levels))))
    steep = steep.withColumn("cell_y", F.explode(F.sequence(F.ceil(e["y1"] / F.col("size")), F.ceil(e["y2"] / F.col("size")))))
    meets = (south >= e["y1"]) & (south < e["y2"])
    steep = steep.where(meets).withColumn("at", x_at(e, south)).join(lines, ["state_code", "county_code", "size", "cell_y"])
    steep = steep.select(*corners.drop("cell_x", "crossing").columns, F.lit(None).cast("bigint").alias("cell_x"), F.lit(1).alias("crossing"))
    # Of equal places corners come first, as an edge counts only beyond them.
    east_first = W.partitionBy("state_code", "county_code", "level", "cell_y").orderBy(F.desc("at"), "crossing")
    beyond = F.sum("crossing").over(east_first.rowsBetween(W.unboundedPreceding, 0)) - F.col("crossing")
    corners = corners.unionByName(steep).withColumn("corner", beyond % 2 == 1).where("crossing = 0")
    edges = touched.groupBy(*CELL).agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    index = corners.join(edges, list(CELL), "left").select(
        *(c for c in CELL if c != "size"), F.col("at").alias("east"), south.alias("south"), "corner",
        F.coalesce("edges", F.array().cast("array<struct<x1: double, y1: double, x2: double, y2: double>>")).alias("edges"),
    )
    return staged(index.where(F.col("corner") | (F.size("edges") > 0)), "counties"), levels


def inside(corner: Column, east: Column, south: Column, edges: Column, x: Column, y: Column) -> Column:
    """Even-odd test of a point in a cell, on the way east to the cell's side and then
    south to its corner; as a ray to the east would have it, to the last bit."""
    def crossed(e: Column) -> Column:
        beyond = lambda at: east < x_at(e, at)
        steep = e["y1"] < e["y2"]
        eastward = (e["y1"] <= y) & (y < e["y2"]) & (x < x_at(e, y)) & ~beyond(y)
        low, high = F.greatest(e["y1"], south), F.least(e["y2"], y)
        southward = (low < high) & (beyond(low) != beyond(high))
        level = (south < e["y1"]) & (e["y1"] <= y) & ((east < e["x1"]) != (east < e["x2"]))
        return F.when(steep, eastward != southward).otherwise(level)

    return (F.size(F.filter(edges, crossed)) % 2 == 1) != corner


def locate_counties(points: DataFrame, counties: DataFrame, key: str = "Id", size: float = COUNTY_CELL) -> DataFrame:
    """County of each point: key, state_code, county_code. Points have lon, lat.

    A point in several polygons takes the lowest codes.
    """
    index, levels = county_index(counties, size)
    # A county has one cell for a point, at one of the levels.
    level = F.explode(F.array(*map(F.lit, levels))) if len(levels) > 1 else F.lit(levels[0])
    placed = points.select(key, "lon", "lat", level.alias("level"))
    finer = F.lit(size) / F.pow(F.lit(2.0), F.col("level"))
    placed = placed.withColumns({"cell_x": F.floor(F.col("lon") / finer), "cell_y": F.floor(F.col("lat") / finer)})
    candidates = placed.join(index, ["level", "cell_x", "cell_y"])
    hit = inside(*(F.col(c) for c in ("corner", "east", "south", "edges", "lon", "lat")))
    return (
        candidates.where(hit)
        .groupBy(key)
        .agg(F.min(F.struct("state_code", "county_code")).alias("code"))
        .select(key, "code.*")
    )


def lacks_county() -> Column:
    return F.col("StateCode").isNull() | F.col("CountyCode").isNull()


def fill_county(stations: DataFrame, counties: DataFrame, key: str = "Id", size: float = COUNTY_CELL) -> DataFrame:
    """Set StateCode and CountyCode of stations that lack either one.

    Both codes are replaced, by NULL when no county holds the point. Other
    stations stay as they are.
    """
    lacking = lacks_county()
    # Stored, so that whatever derives the points is not repeated in the conditions and
    # keys of the join, which would not compile for a wide cast.
    points = stations.select(
        key,
        western(F.col("Lon_X")).alias("lon"),
        F.col("Lat_Y").cast("double").alias("lat"),
        lacking.alias("lacking"),
    )
    points = staged(points, "points").where(F.col("lacking") & F.col("lon").isNotNull() & F.col("lat").isNotNull())
    found = locate_counties(points, counties, key, size)
    return (
        stations.join(found, key, "left")
        .withColumns(
            {
                "StateCode": F.when(lacking, F.col("state_code")).otherwise(F.col("StateCode")),
                "CountyCode": F.when(lacking, F.col("county_code")).otherwise(F.col("CountyCode")),
            }
        )
        .select(*stations.columns)
    )


def lacks_elevation() -> Column:
    """Elevation missing, zero or beyond any mountain."""
    return F.col("Elev").isNull() | (F.col("Elev") == 0) | (F.col("Elev") > 20000)


def fill_elevation(stations: DataFrame, grid: DataFrame, size: float = ELEVATION_CELL) -> DataFrame:
    """Set Elev, ElevUnit and ElevMeth of stations without a usable elevation.

    ``grid`` holds cell_x, cell_y (see :func:`cell_of`) and elevation in metres;
    ``size`` is the edge of its cells in degrees. Stations outside the grid stay as
    they are.
    """
    lacking = lacks_elevation()
    grid = grid.groupBy("cell_x", "cell_y").agg(F.min("elevation").alias("_elevation"))
    # Only stations in need get a cell; for the others the key is NULL.
    keyed = stations.withColumns(
        {
            "cell_x": F.when(lacking, cell_of(western(F.col("Lon_X")), size)),
            "cell_y": F.when(lacking, cell_of(F.col("Lat_Y").cast("double"), size)),
        }
    )
    hit = F.col("_elevation").isNotNull()
    # Unit and method of a filled elevation.
    return (
        keyed.join(grid, ["cell_x", "cell_y"], "left")
        .withColumns(
            {
                "Elev": F.coalesce("_elevation", "Elev"),
                "ElevUnit": F.when(hit, "meters").otherwise(F.col("ElevUnit")),
                "ElevMeth": F.when(hit, "Other").otherwise(F.col("ElevMeth")),
            }
        )
        .select(*stations.columns)
    )


def elevation_tiles(grid: DataFrame, edge: int = TILE) -> DataFrame:
    """A grid packed into tiles: tile_x, tile_y and ``samples``.

    ``grid`` holds cell_x, cell_y and elevation in metres, a sample per lattice point
    (cell_x, cell_y) times the grid's spacing; of several the lowest counts. A tile has
    ``edge`` cells a side and the samples at all their corners, row by row from the
    south-west, NULL where there is none; neighbours share the samples between them.
    """
    side = edge + 1

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = int(rows["tile_x"].iloc[0]), int(rows["tile_y"].iloc[0])
        samples = np.full(side * side, np.nan)
        samples[((rows["cell_y"] - y * edge) * side + rows["cell_x"] - x * edge).to_numpy(np.int64)] = rows["elevation"].to_numpy(float)
        return pd.DataFrame({"tile_x": [x], "tile_y": [y], "samples": [samples]})

    samples = grid.where(F.col("elevation").isNotNull()).groupBy("cell_x", "cell_y").agg(F.min("elevation").cast("double").alias("elevation"))
    for axis in ("x", "y"):  # a sample on a tile's western or southern side is the last of its neighbour
        own = F.floor(F.col(f"cell_{axis}") / edge)
        shared = F.col(f"cell_{axis}") % edge == 0
        samples = samples.withColumn(f"tile_{axis}", F.explode(F.when(shared, F.array(own, own - 1)).otherwise(F.array(own))))
    packed = samples.groupBy("tile_x", "tile_y").applyInPandas(pack, "tile_x bigint, tile_y bigint, samples array<double>")
    return packed.withColumn("samples", F.transform("samples", lambda v: F.when(~F.isnan(v), v)))


def fill_elevation_from_tiles(stations: DataFrame, tiles: DataFrame, spacing: float, edge: int = TILE) -> DataFrame:
    """Set Elev, ElevUnit and ElevMeth of stations without a usable elevation by
    bilinear interpolation between the samples around them.

    ``tiles`` come from :func:`elevation_tiles`, ``spacing`` is the distance of samples
    in degrees. A station stays as it is if a sample that counts for it is missing.
    """
    lacking = lacks_elevation()
    x, y = western(F.col("Lon_X")) / F.lit(spacing), F.col("Lat_Y").cast("double") / F.lit(spacing)
    # Stored in one projection: where the station is in units of samples.
    keyed = stations.withColumns({"_gx": F.when(lacking, x), "_gy": F.when(lacking, y)}).withColumns(
        {"_tx": F.floor(F.floor("_gx") / edge), "_ty": F.floor(F.floor("_gy") / edge)}
    )
    i, j = F.floor("_gx"), F.floor("_gy")
    at = ((j - F.col("_ty") * edge) * (edge + 1) + i - F.col("_tx") * edge).cast("int")
    fx, fy = F.col("_gx") - i, F.col("_gy") - j
    weights = ((0, (1 - fx) * (1 - fy)), (1, fx * (1 - fy)), (edge + 1, (1 - fx) * fy), (edge + 2, fx * fy))
    parts = [F.when(w == 0, 0.0).otherwise(F.get("samples", at + step) * w) for step, w in weights]
    found = keyed.join(tiles, (F.col("_tx") == F.col("tile_x")) & (F.col("_ty") == F.col("tile_y")), "left")
    # Only the samples' sum leaves the join, not the tile.
    found = found.withColumn("_elevation", reduce(Column.__add__, parts)).drop("samples")
    hit = F.col("_elevation").isNotNull()
    # Unit and method of a filled elevation.
    return found.withColumns(
        {
            "Elev": F.coalesce("_elevation", "Elev"),
            "ElevUnit": F.when(hit, "meters").otherwise(F.col("ElevUnit")),
            "ElevMeth": F.when(hit, "Other").otherwise(F.col("ElevMeth")),
        }
    ).select(*stations.columns)


def within_metres(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose utm_x, utm_y lie in a box given in metres (x1, y1, x2, y2)."""
    return df.where(F.col("utm_x").between(box[0], box[2]) & F.col("utm_y").between(box[1], box[3]))
