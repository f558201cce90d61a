"""Ring geometry as Spark Columns.

A geometry is ``rings``: closed rings of (x, y), read under the even-odd rule. In canonical
order every shell runs counter-clockwise and its holes, clockwise, follow it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RING_TYPE = "array<struct<x:double,y:double>>"
RINGS_TYPE = f"array<{RING_TYPE}>"
SRID = 4269  # fixed value: the declared coordinate system, EPSG:4269
EARTH_RADIUS_KM = 6371.0072  # authalic radius

# fixed values: the GRS80 ellipsoid
SEMI_MAJOR_KM = 6378.137
FLATTENING = 1 / 298.257222101

# a boundary hit adds this to the crossing count, far above any real count
_ON_EDGE = 1 << 40


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, whatever the number of mentions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def point(x, y) -> Column:
    """A position."""
    return F.struct(F.col(x).alias("x") if isinstance(x, str) else x.alias("x"),
                    F.col(y).alias("y") if isinstance(y, str) else y.alias("y"))


def ring_edges(ring: Column) -> Column:
    """Edges of one closed ring."""
    return F.transform(
        F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))),
        lambda p, i: F.struct(
            p["x"].alias("x1"),
            p["y"].alias("y1"),
            F.get(ring, i + 1)["x"].alias("x2"),
            F.get(ring, i + 1)["y"].alias("y2"),
        ),
    )


def edges(rings: Column) -> Column:
    """All edges, as one array of (x1, y1, x2, y2)."""
    return F.flatten(F.transform(rings, ring_edges))


def vertex_count(rings: Column) -> Column:
    """Coordinates stored, ring-closing points and holes included."""
    return F.aggregate(rings, F.lit(0), lambda n, r: n + F.size(r))


def bbox(rings: Column) -> Column:
    """Bounding box; NULL for an empty geometry."""
    xs = F.transform(F.flatten(rings), lambda p: p["x"])
    ys = F.transform(F.flatten(rings), lambda p: p["y"])
    box = F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )
    return F.when(F.size(F.flatten(rings)) > 0, box)


def envelope(xmin, ymin, xmax, ymax) -> Column:
    """A bounding box from four columns or numbers."""
    named = zip(("xmin", "ymin", "xmax", "ymax"), (xmin, ymin, xmax, ymax), strict=True)
    return F.struct(*[(v if isinstance(v, Column) else F.lit(float(v))).alias(n) for n, v in named])


def boxes_meet(a: Column, b: Column) -> Column:
    """Two boxes share at least a point."""
    return (
        (a["xmin"] <= b["xmax"])
        & (a["xmax"] >= b["xmin"])
        & (a["ymin"] <= b["ymax"])
        & (a["ymax"] >= b["ymin"])
    )


def box_has_point(box: Column, x: Column, y: Column) -> Column:
    """The box, borders included, holds the position."""
    return (box["xmin"] <= x) & (box["xmax"] >= x) & (box["ymin"] <= y) & (box["ymax"] >= y)


def _side(e: Column, x: Column, y: Column) -> Column:
    """Sign tells on which side of the edge the position lies, 0 on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def edge_crosses_ray(e: Column, x: Column, y: Column) -> Column:
    """The edge meets the ray from the position towards +x. No division, so dyadic input is exact."""
    return ((e["y1"] > y) != (e["y2"] > y)) & ((_side(e, x, y) > 0) == (e["y2"] > e["y1"])) & (
        _side(e, x, y) != 0
    )


def edge_has_point(e: Column, x: Column, y: Column) -> Column:
    """The position lies on the edge."""
    return (
        x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        & (_side(e, x, y) == 0)
    )


def _ray_count(es: Column, x: Column, y: Column, finish) -> Column:
    def step(n, e):
        near = ((e["y1"] <= y) | (e["y2"] <= y)) & ((e["y1"] >= y) | (e["y2"] >= y))
        hit = (
            F.when(edge_has_point(e, x, y), n + F.lit(_ON_EDGE))
            .when(edge_crosses_ray(e, x, y), n + F.lit(1).cast("bigint"))
            .otherwise(n)
        )
        return F.when(near, hit).otherwise(n)

    return F.aggregate(es, F.lit(0).cast("bigint"), step, finish)


def intersects_point(es: Column, x: Column, y: Column) -> Column:
    """Inside or on the boundary."""
    return _ray_count(es, x, y, lambda n: (n >= _ON_EDGE) | (n % 2 == 1))


def contains_point(es: Column, x: Column, y: Column) -> Column:
    """Strictly inside."""
    return _ray_count(es, x, y, lambda n: (n < _ON_EDGE) & (n % 2 == 1))


def edge_meets_box(e: Column, box: Column) -> Column:
    """Closed segment against closed box: extents overlap and the corners straddle the line."""
    corners = [
        _side(e, box["xmin"], box["ymin"]),
        _side(e, box["xmin"], box["ymax"]),
        _side(e, box["xmax"], box["ymin"]),
        _side(e, box["xmax"], box["ymax"]),
    ]
    return (
        (F.least(e["x1"], e["x2"]) <= box["xmax"])
        & (F.greatest(e["x1"], e["x2"]) >= box["xmin"])
        & (F.least(e["y1"], e["y2"]) <= box["ymax"])
        & (F.greatest(e["y1"], e["y2"]) >= box["ymin"])
        & (F.least(*corners) <= 0)
        & (F.greatest(*corners) >= 0)
    )


def intersects_box(es: Column, box: Column) -> Column:
    """An edge meets the box, or the box lies inside the polygon."""
    return F.exists(es, lambda e: edge_meets_box(e, box)) | intersects_point(
        es, box["xmin"], box["ymin"]
    )


def ring_area(ring: Column) -> Column:
    """Signed shoelace area, positive for counter-clockwise rings."""
    return F.aggregate(
        ring_edges(ring),
        F.lit(0.0),
        lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"]),
        lambda s: s / 2,
    )


def area(rings: Column) -> Column:
    """Planar area of a canonical geometry: shells minus holes."""
    return F.aggregate(rings, F.lit(0.0), lambda s, r: s + ring_area(r))


def area_spheroid_km2(rings: Column) -> Column:
    """Area on the authalic sphere from lon/lat degrees, an approximation of the geodesic one.

    x is longitude and y latitude; the integral of (1 - sin lat) dlon is taken per edge with the
    mean of its end sines.
    """
    def step(s, e):
        return s + F.radians(e["x2"] - e["x1"]) * (
            2 + F.sin(F.radians(e["y1"])) + F.sin(F.radians(e["y2"]))
        )

    signed = F.aggregate(edges(rings), F.lit(0.0), step)
    return F.abs(signed) * (EARTH_RADIUS_KM * EARTH_RADIUS_KM / 2)


def _authalic_q(sine):
    """Area of the ellipsoid from the equator to a latitude, by its sine, up to a constant factor."""
    e = math.sqrt(FLATTENING * (2 - FLATTENING))
    log = F.log((1 + e * sine) / (1 - e * sine)) if isinstance(sine, Column) else math.log((1 + e * sine) / (1 - e * sine))
    return (1 - e * e) * (sine / (1 - e * e * sine * sine) + log / (2 * e))


def area_geodesic_km2(rings: Column) -> Column:
    """Area on the ellipsoid from lon/lat degrees, edges as great circles of the authalic sphere.

    Latitudes are carried to the sphere of the same area, where the area between an edge and the equator
    has a closed form. Edges of up to a degree follow the geodesics of the ellipsoid closely enough for an
    area to six digits. Rings that go round a pole are not meant.
    """
    pole = _authalic_q(1.0)

    def latitude(y):
        return F.asin(_authalic_q(F.sin(F.radians(y))) / pole)

    def step(s, e):
        a, b = latitude(e["y1"]), latitude(e["y2"])
        lean = F.tan(F.radians(e["x2"] - e["x1"]) / 2) * F.sin((a + b) / 2) / F.cos((a - b) / 2)
        return s + 2 * F.atan(lean)

    signed = F.aggregate(edges(rings), F.lit(0.0), step)
    return F.abs(signed) * (SEMI_MAJOR_KM * SEMI_MAJOR_KM * pole / 2)


def close_ring(ring: Column) -> Column:
    """Repeat the first point at the end unless it is there already."""
    first, last = F.get(ring, F.lit(0)), F.get(ring, F.size(ring) - 1)
    return F.when((F.size(ring) > 0) & (first != last), F.concat(ring, F.array(first))).otherwise(
        ring
    )


def polygonal(rings: Column) -> Column:
    """Rings that bound an area: at least four points and not flat."""
    return F.filter(rings, lambda r: (F.size(r) >= 4) & (ring_area(r) != 0))


def parts(rings: Column) -> Column:
    """Canonical rings cut into polygons, each a shell with the holes that follow it."""
    def cut(rs):
        shells = F.filter(
            F.sequence(F.lit(0), F.greatest(F.size(rs) - 1, F.lit(0))),
            lambda i: ring_area(F.get(rs, i)) > 0,
        )
        return let(
            shells,
            lambda at_all: F.transform(
                at_all,
                lambda at, n: F.slice(
                    rs, at + 1, F.coalesce(F.get(at_all, n + 1), F.size(rs)) - at
                ),
            ),
        )

    return F.when(rings.isNotNull(), let(rings, cut))


def dump_parts(df, geometry: str = "rings"):
    """One row per polygon of a multi-geometry, with its 1-based ``path``."""
    return df.select(
        *[c for c in df.columns if c != geometry],
        F.posexplode(parts(F.col(geometry))).alias("pos", geometry),
    ).select("*", (F.col("pos") + 1).alias("path")).drop("pos")


def geometry_type(rings: Column) -> Column:
    """POLYGON, MULTIPOLYGON or EMPTY; NULL stays NULL."""
    shells = F.size(F.filter(rings, lambda r: ring_area(r) > 0))
    return (
        F.when(rings.isNull(), F.lit(None).cast("string"))
        .when(shells == 0, F.lit("EMPTY"))
        .when(shells == 1, F.lit("POLYGON"))
        .otherwise(F.lit("MULTIPOLYGON"))
    )


def with_measures(df, geometry: str = "rings", srid: int = SRID):
    """The stored form: rings plus ``bbox``, ``srid`` and ``nverts``."""
    g = F.col(geometry)
    return df.withColumns(
        {"bbox": bbox(g), "srid": F.lit(srid), "nverts": vertex_count(g)}
    )


def _ring_text(ring: Column, between: str, start: str, end: str) -> Column:
    pairs = F.transform(
        ring,
        lambda p: F.concat(
            F.lit(start), p["x"].cast("string"), F.lit(between), p["y"].cast("string"), F.lit(end)
        ),
    )
    return F.array_join(pairs, "," if start else ", ")


def _nested(polys: Column, opening: str, closing: str, sep: str, ring_text) -> Column:
    def polygon(poly):
        inner = F.transform(poly, lambda r: F.concat(F.lit(opening), ring_text(r), F.lit(closing)))
        return F.concat(F.lit(opening), F.array_join(inner, sep), F.lit(closing))

    return F.transform(polys, polygon)


def to_wkt(rings: Column) -> Column:
    """Well-known text."""
    polys = _nested(parts(rings), "(", ")", ", ", lambda r: _ring_text(r, " ", "", ""))

    def text(ps):
        return (
            F.when(F.size(ps) == 0, F.lit("POLYGON EMPTY"))
            .when(F.size(ps) == 1, F.concat(F.lit("POLYGON "), F.get(ps, F.lit(0))))
            .otherwise(F.concat(F.lit("MULTIPOLYGON ("), F.array_join(ps, ", "), F.lit(")")))
        )

    return F.when(rings.isNotNull(), let(polys, text))


def to_geojson(rings: Column) -> Column:
    """GeoJSON geometry object."""
    polys = _nested(parts(rings), "[", "]", ",", lambda r: _ring_text(r, ",", "[", "]"))

    def text(ps):
        one = F.concat(
            F.lit('{"type":"Polygon","coordinates":'),
            F.coalesce(F.get(ps, F.lit(0)), F.lit("[]")),
            F.lit("}"),
        )
        many = F.concat(
            F.lit('{"type":"MultiPolygon","coordinates":['), F.array_join(ps, ","), F.lit("]}")
        )
        return F.when(F.size(ps) > 1, many).otherwise(one)

    return F.when(rings.isNotNull(), let(polys, text))


def to_feature(rings: Column, **properties: Column) -> Column:
    """GeoJSON feature ``{type, properties, geometry}``."""
    props = F.to_json(F.struct(*[c.alias(n) for n, c in properties.items()]))
    return F.concat(
        F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'),
        F.coalesce(to_geojson(rings), F.lit("null")), F.lit("}"),
    )


def from_wkt(text: Column) -> Column:
    """Rings of POLYGON and MULTIPOLYGON text, in the order written."""
    rings = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))
    return F.transform(
        rings,
        lambda r: F.transform(
            F.split(r, r"\s*,\s*"),
            lambda xy: F.struct(
                F.split(F.trim(xy), r"\s+")[0].cast("double").alias("x"),
                F.split(F.trim(xy), r"\s+")[1].cast("double").alias("y"),
            ),
        ),
    )
