"""Planar geometry as columns.

A geometry is a multipolygon: an array of polygons, a polygon an array of rings (the shell
first, then its holes), a ring a closed array of points.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"
POLYGON = f"array<{RING}>"
MULTIPOLYGON = f"array<{POLYGON}>"

# Rijksdriehoek, planar metres.
SRID = 28992


def _zero() -> Column:
    return F.lit(0.0)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def as_multi(polygon: Column) -> Column:
    """A polygon as a multipolygon of one."""
    return F.array(polygon)


def tag_srid(geom: Column, name: str, srid: int = SRID) -> Column:
    """Record the reference system in the column's metadata; coordinates stay as they are."""
    return geom.alias(name, metadata={"srid": srid})


def _first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def _from_second(array: Column) -> Column:
    return F.slice(array, F.lit(2), F.greatest(F.size(array) - 1, F.lit(0)))


def ring_moments(ring: Column, origin: Column) -> Column:
    """Signed area and first moments of a ring, counterclockwise positive.

    Taken around ``origin``, so that large coordinates do not cancel.
    """
    x0, y0 = origin["x"], origin["y"]
    start = F.struct(
        (_first(ring)["x"] - x0).alias("x"),
        (_first(ring)["y"] - y0).alias("y"),
        _zero().alias("a"),
        _zero().alias("mx"),
        _zero().alias("my"),
    )

    def step(acc: Column, p: Column) -> Column:
        x, y = p["x"] - x0, p["y"] - y0
        cross = acc["x"] * y - x * acc["y"]
        return F.struct(
            x.alias("x"),
            y.alias("y"),
            (acc["a"] + cross).alias("a"),
            (acc["mx"] + (acc["x"] + x) * cross).alias("mx"),
            (acc["my"] + (acc["y"] + y) * cross).alias("my"),
        )

    return F.aggregate(
        _from_second(ring),
        start,
        step,
        lambda acc: F.struct(
            (acc["a"] / 2).alias("a"), (acc["mx"] / 6).alias("mx"), (acc["my"] / 6).alias("my")
        ),
    )


def ring_area(ring: Column) -> Column:
    """Signed area, counterclockwise positive."""
    return ring_moments(ring, _first(ring))["a"]


def _moments(geom: Column, origin: Column) -> Column:
    """Moments of a multipolygon: shells count positive and holes negative however they turn."""
    # Rings are measured once each and only then summed; a lambda would repeat an expression
    # at every use.
    measured = F.flatten(
        F.transform(
            geom,
            lambda polygon: F.transform(
                polygon,
                lambda ring, i: F.struct(
                    ring_moments(ring, origin).alias("m"),
                    F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("weight"),
                ),
            ),
        )
    )
    nothing = F.struct(_zero().alias("a"), _zero().alias("mx"), _zero().alias("my"))

    def plus(acc: Column, ring: Column) -> Column:
        m = ring["m"]
        weight = F.when(m["a"] < 0, -ring["weight"]).otherwise(ring["weight"])
        return F.struct(*[(acc[c] + weight * m[c]).alias(c) for c in ("a", "mx", "my")])

    return F.aggregate(measured, nothing, plus)


def origin_of(geom: Column) -> Column:
    return _first(_first(_first(geom)))


def area(geom: Column) -> Column:
    return _moments(geom, origin_of(geom))["a"]


def centroid(geom: Column) -> Column:
    """Area-weighted centre of a multipolygon as a point."""
    origin = origin_of(geom)
    # A one-element transform names the moments, so they are folded once and not per use.
    centre = F.transform(
        F.array(_moments(geom, origin)),
        lambda m: point(
            origin["x"] + F.try_divide(m["mx"], m["a"]), origin["y"] + F.try_divide(m["my"], m["a"])
        ),
    )
    return _first(centre)


def geo_id(centre: Column) -> Column:
    """Both rounded coordinates glued together; ties go to the even number.

    Rounding to 6 decimals first keeps ties ties.
    """

    def whole(c: Column) -> Column:
        return F.rint(F.round(c, 6)).cast("int").cast("string")

    return F.concat_ws("", whole(centre["x"]), whole(centre["y"]))


def rings_of(geom: Column) -> Column:
    return F.flatten(geom)


def bounding_box(geom: Column) -> Column:
    """Least and greatest coordinates over the shells; infinite the wrong way round when empty."""
    points = F.flatten(F.transform(geom, lambda polygon: _first(polygon)))
    far = F.lit(float("inf"))
    return F.aggregate(
        points,
        F.struct(far.alias("x0"), far.alias("y0"), (-far).alias("x1"), (-far).alias("y1")),
        lambda box, p: F.struct(
            F.least(box["x0"], p["x"]).alias("x0"),
            F.least(box["y0"], p["y"]).alias("y0"),
            F.greatest(box["x1"], p["x"]).alias("x1"),
            F.greatest(box["y1"], p["y"]).alias("y1"),
        ),
    )


def contains_point(rings: Column, x: Column, y: Column, tolerance: float = 0.0) -> Column:
    """Whether a point lies strictly inside the rings, counted even-odd.

    A point on an edge, or within ``tolerance`` of one, is outside.
    """

    def edge(acc: Column, p: Column) -> Column:
        x1, y1 = acc["x"] - x, acc["y"] - y
        x2, y2 = p["x"] - x, p["y"] - y
        cross = x1 * y2 - x2 * y1
        crossed = ((y1 > 0) != (y2 > 0)) & ((cross > 0) == (y2 > y1))
        if tolerance:
            dx, dy = x2 - x1, y2 - y1
            length2 = dx * dx + dy * dy
            along = F.least(F.greatest(-(x1 * dx + y1 * dy), _zero()), length2)
            share = F.when(length2 > 0, along / length2).otherwise(_zero())
            fx, fy = x1 + share * dx, y1 + share * dy
            on_edge = fx * fx + fy * fy <= tolerance * tolerance
        else:
            on_edge = (cross == 0) & (x1 * x2 + y1 * y2 <= 0)
        return F.struct(
            p["x"].alias("x"),
            p["y"].alias("y"),
            (acc["inside"] != crossed).alias("inside"),
            (acc["edge"] | on_edge).alias("edge"),
        )

    def ring(acc: Column, points: Column) -> Column:
        start = F.struct(
            _first(points)["x"].alias("x"),
            _first(points)["y"].alias("y"),
            acc["inside"].alias("inside"),
            acc["edge"].alias("edge"),
        )
        return F.aggregate(
            _from_second(points),
            start,
            edge,
            lambda end: F.struct(end["inside"].alias("inside"), end["edge"].alias("edge")),
        )

    outside = F.struct(F.lit(False).alias("inside"), F.lit(False).alias("edge"))
    return F.aggregate(rings, outside, ring, lambda acc: acc["inside"] & ~acc["edge"])


def geojson(geom: Column) -> Column:
    """The multipolygon as GeoJSON text."""
    coordinates = F.transform(
        geom,
        lambda polygon: F.transform(
            polygon, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))
        ),
    )
    return F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates")))
