"""The county index against an even-odd test over all edges."""

import math
import random

import pytest

from wellspring.operators import spatial

COUNTIES = "state_code int, county_code int, rings array<array<struct<x: double, y: double>>>"


def even_odd(rings, x, y):
    """A ray to the east, over every edge."""
    crossed = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if ay > by:
                ax, ay, bx, by = bx, by, ax, ay
            crossed += ay <= y < by and x < ax + (bx - ax) * (y - ay) / (by - ay)
    return crossed % 2 == 1


def star(rng, x, y, radius, n):
    """A ragged ring around a point."""
    out = []
    for i in range(n):
        r = radius * (0.6 + 0.4 * rng.random())
        out.append((x + r * math.cos(2 * math.pi * i / n), y + r * math.sin(2 * math.pi * i / n)))
    return out


def located(spark, counties, points, **options):
    counties = spark.createDataFrame([(49, code, rings) for code, rings in counties], COUNTIES)
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "Id int, lon double, lat double")
    return {r.Id: r.county_code for r in spatial.locate_counties(points, counties, **options).collect()}


def test_many_shapes(spark, monkeypatch):
    """Rings with holes, level and upright edges, borders along cell sides, shared
    borders; points at vertices, on edges, on cell sides and corners."""
    monkeypatch.setattr(spatial, "MOST_EDGES", 6)
    monkeypatch.setattr(spatial.county_index, "__defaults__", (0.25, 6))
    rng = random.Random(1)
    box = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    steps = [(i / 8, (i % 2) / 8) for i in range(17)]
    comb = [(0.0, 0.0)] + [p for i in range(16) for p in ((i / 16, 1.0 if i % 2 else 0.1), ((i + 1) / 16, 1.0 if i % 2 else 0.1))] + [(1.0, 0.0)]
    counties = {
        1: [box(-3.0, 0.0, 1.0, 1.0), box(-2.75, 0.25, 0.5, 0.5)],
        2: [box(-2.0, 0.0, 1.0, 1.0)],
        3: [star(rng, -0.5, 2.0, 0.7, 200)],
        4: [[(x + 1.0, y + 1.0) for x, y in steps] + [(3.0, 2.0), (1.0, 2.0)]],
        5: [comb],
        6: [star(rng, 2.0, -1.0, 0.9, 60), star(rng, 2.0, -1.0, 0.3, 40)],
        7: [[(0.0, 0.0), (1.0, 1.0)]],  # no area
    }
    vertices = [p for rings in counties.values() for ring in rings for p in ring]
    points = vertices + [(x + dx, y) for x, y in vertices[:60] for dx in (-0.03125, 0.03125)]
    points += [(i / 16 - 3.5, j / 16 - 2) for i in range(110) for j in range(0, 80, 3)]
    points += [(rng.uniform(-3.5, 3.5), rng.uniform(-2, 3)) for _ in range(1500)]
    want = {}
    for i, (x, y) in enumerate(points):
        hit = [code for code, rings in counties.items() if even_odd([r for r in rings if len(r) >= 3], x, y)]
        if hit:
            want[i] = min(hit)
    assert len(want) > 900
    assert located(spark, counties.items(), points) == want


def test_edges_per_point_are_bounded(spark):
    """A county of 100,000 vertices."""
    rng = random.Random(2)
    ring = star(rng, -111.0, 40.0, 1.0, 100_000)
    counties = spark.createDataFrame([(49, 1, [ring])], COUNTIES)
    index, levels = spatial.county_index(counties)
    cells = index.selectExpr("max(size(edges))", "count_if(size(edges) = 0)", "count(*)").first()
    assert cells[0] <= spatial.MOST_EDGES and cells[1] > 5 and len(levels) > 4
    points = [(rng.uniform(-112.1, -109.9), rng.uniform(38.9, 41.1)) for _ in range(150)]
    got = located(spark, [(1, [ring])], points)
    assert {i for i, (x, y) in enumerate(points) if even_odd([ring], x, y)} == set(got)


def test_cells_must_be_halves(spark):
    with pytest.raises(ValueError, match="power of two"):
        spatial.county_index(spark.createDataFrame([], COUNTIES), 0.3)
    assert located(spark, [], [(0.0, 0.0)]) == {}
