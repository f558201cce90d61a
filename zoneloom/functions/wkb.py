"""Well-known binary both ways, for exchange with other tools."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneloom.functions.arrow_rings import read_rings, write_rings
from zoneloom.operators.clip import signed_area, to_parts

_POLYGON, _MULTI = 3, 6  # fixed values of the format
_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
_RINGS = T.ArrayType(T.ArrayType(_POINT))


def _encode(rings) -> bytes:
    polygons = []
    for ring in rings:
        if not polygons or signed_area(ring) > 0:
            polygons.append([])
        polygons[-1].append(ring)

    def polygon(poly):
        body = b"".join(
            struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in poly
        )
        return struct.pack("<BII", 1, _POLYGON, len(poly)) + body

    if len(polygons) == 1:
        return polygon(polygons[0])
    if not polygons:
        return struct.pack("<BII", 1, _POLYGON, 0)
    return struct.pack("<BII", 1, _MULTI, len(polygons)) + b"".join(map(polygon, polygons))


def _decode(data: bytes):
    rings, at, expected = [], 0, 1
    while expected:
        order = "<" if data[at] == 1 else ">"
        kind, n = struct.unpack_from(order + "II", data, at + 1)
        at += 9
        expected -= 1
        if kind == _MULTI:
            expected += n
            continue
        if kind != _POLYGON:
            raise ValueError(f"geometry type {kind} is not polygonal")
        for _ in range(n):
            (points,) = struct.unpack_from(order + "I", data, at)
            xy = np.frombuffer(data, order + "f8", points * 2, at + 4).reshape(-1, 2)
            rings.append(xy.astype("f8"))
            at += 4 + points * 16
    return [r for part in to_parts(rings) for r in part]


@F.arrow_udf(T.BinaryType())
def to_wkb(rings: pa.Array) -> pa.Array:
    """Canonical rings as POLYGON or MULTIPOLYGON, little endian."""
    return pa.array([None if r is None else _encode(r) for r in read_rings(rings)], pa.binary())


@F.arrow_udf(_RINGS)
def from_wkb(data: pa.Array) -> pa.Array:
    """Polygonal geometry of either byte order as canonical rings."""
    return write_rings([None if b is None else _decode(b) for b in data.to_pylist()])
