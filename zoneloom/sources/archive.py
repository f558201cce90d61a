"""Zipped shapefile deliveries into bronze rows.

An archive is inflated as a stream in one task and leaves it as ranges of records, a few megabytes each, which
are stored; many tasks then decode the ranges of one archive. It is gone through once before, so that it comes
whole or, with an error, not at all.
"""

from __future__ import annotations

import codecs
import io
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneloom.functions.arrow_rings import write_rings
from zoneloom.functions.rings import RINGS_TYPE
from zoneloom.operators.clip import to_parts
from zoneloom.session import settle, ship_kernels

LAYER = "S_FLD_HAZ_AR"  # fixed value: name of the zone layer in a delivery
CRS = "EPSG:4269"  # fixed value: the declared coordinate system
# fixed values: names that coordinate system goes by in a .prj file
CRS_NAMES = {"GCS_North_American_1983": CRS, "NAD83": CRS, "GCS_WGS_1984": "EPSG:4326"}
POLYGONS = (5, 15, 25)  # fixed values: shape types polygon, with z, with m
RANGE_BYTES = 2 << 20
RANGE_ROWS = 5_000
RANGES = (
    "path string, source string, error string, encoding string, crs string, codec string, first_row bigint, "
    "starts binary, shapes binary, records binary, width int, places array<int>"
)


def landed_archives(spark: SparkSession, root: str, source: str = "cache") -> DataFrame:
    """``path, content, source`` of a folder of ZIP files."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "content", F.lit(source).alias("source"))
    )


def _members(archive: zipfile.ZipFile, layer: str) -> dict[str, str]:
    found = {}
    for name in archive.namelist():
        stem, _, ext = name.rpartition(".")
        if stem.upper().endswith(layer.upper()):
            found[ext.lower()] = name
    return found


def _crs(prj: bytes | None) -> str:
    text = (prj or b"").decode("latin1")
    return next((code for name, code in CRS_NAMES.items() if name in text), text[:80])


def _bounds(archive: zipfile.ZipFile, members: dict[str, str]) -> np.ndarray:
    """Where each shape record starts and ends: from the ``.shx``, or from the records' own heads without one."""
    if "shx" in members:
        index = archive.read(members["shx"])[100:]
        at = np.frombuffer(index, ">i4", len(index) // 8 * 2).reshape(-1, 2).astype(np.int64) * 2
        return np.column_stack([at[:, 0], at[:, 0] + 8 + at[:, 1]])
    found, at = [], 100
    with archive.open(members["shp"]) as shapes:
        shapes.seek(at)
        while len(head := shapes.read(8)) == 8:
            end = at + 8 + 2 * struct.unpack_from(">i", head, 4)[0]
            found.append((at, end))
            at = end
            shapes.seek(at)
    return np.array(found, np.int64).reshape(-1, 2)


def _runs(bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of records that lie in order and within ``most`` bytes; a longer record is alone."""
    starts, ends = bounds[:, 0].tolist(), bounds[:, 1].tolist()
    low = 0
    for i in range(1, len(starts) + 1):
        if i == len(starts) or starts[i] < ends[i - 1] or ends[i] - starts[low] > most or i - low == RANGE_ROWS:
            yield low, i
            low = i


def _exactly(stream, size: int, what: str) -> bytes:
    data = stream.read(size)
    if len(data) < size:
        raise ValueError(f"{what} ends early")
    return data


def _sizes(shapes: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Type of each record; parts and points of the polygons, which come in the records' order."""
    raw = np.frombuffer(shapes, np.uint8)
    kinds = raw[starts[:, None] + np.arange(8, 12)].view("<i4")[:, 0]
    polygons = starts[np.isin(kinds, POLYGONS)]
    if len(polygons) and polygons[-1] + 52 > len(raw):
        raise ValueError("a polygon is cut off")
    counts = raw[polygons[:, None] + np.arange(44, 52)].view("<i4").astype(np.int64)
    return kinds, counts[:, 0], counts[:, 1]


@dataclass
class _Layer:
    """One layer of an open archive."""

    archive: zipfile.ZipFile
    members: dict[str, str]
    codec: str
    note: str
    crs: str

    @classmethod
    def open(cls, content: bytes, layer: str) -> _Layer:
        archive = zipfile.ZipFile(io.BytesIO(content))
        members = _members(archive, layer)
        if "shp" not in members:
            raise FileNotFoundError(f"{layer}.shp not in archive")
        codec, note = "latin1", "latin1-fallback"
        if "cpg" in members:
            named = archive.read(members["cpg"]).decode("ascii").strip()
            codec, note = named or "latin1", f"cpg:{named or 'unknown'}"
        codecs.lookup(codec)
        return cls(archive, members, codec, note, _crs(archive.read(members["prj"]) if "prj" in members else None))

    def ranges(self, fields: list[str], most: int) -> Iterator[tuple[int, np.ndarray, bytes, bytes, int, list[int]]]:
        """First row, starts within the bytes, shape bytes, table bytes, bytes a table row, and for each field its
        place and width (or -1, -1) of one range after another. Fails on what does not fit together."""
        bounds = _bounds(self.archive, self.members)
        with self.archive.open(self.members["shp"]) as shapes, self.archive.open(self.members["dbf"]) as table:
            n, head, width = struct.unpack_from("<IHH", _exactly(table, 32, "the table"), 4)
            if n != len(bounds):
                raise ValueError(f"{len(bounds)} shapes but {n} table rows")
            described, found, at = _exactly(table, head - 32, "the table"), {}, 1
            for k in range(0, len(described) - 31, 32):
                if described[k] == 0x0D:
                    break
                found[described[k : k + 11].split(b"\0")[0].decode("ascii")] = (at, described[k + 16])
                at += described[k + 16]
            if at > width:
                raise ValueError("fields reach beyond the table row")
            places = [x for f in fields for x in found.get(f, (-1, -1))]
            for low, high in _runs(bounds, most):
                first, last = int(bounds[low, 0]), int(bounds[high - 1, 1])
                shapes.seek(first)
                own = bounds[low:high] - first
                data = _exactly(shapes, last - first, "the layer")
                if (own[:, 1] - own[:, 0] < 12).any():
                    raise ValueError("a shape record is too short")
                kinds, parts, points = _sizes(data, own[:, 0])
                length = (own[:, 1] - own[:, 0])[np.isin(kinds, POLYGONS)]
                if (parts < 0).any() or (points < 0).any() or (52 + 4 * parts + 16 * points > length).any():
                    raise ValueError("a polygon is longer than its record")
                yield low, own[:, 0], data, _exactly(table, (high - low) * width, "the table"), width, places
            for rest in (shapes, table):  # the sums of a member are compared at its end
                while rest.read(1 << 20):
                    pass


def _landing_kernel(layer: str, fields: list[str], most: int):
    kinds = [
        ("path", pa.string()), ("source", pa.string()), ("error", pa.string()), ("encoding", pa.string()),
        ("crs", pa.string()), ("codec", pa.string()), ("first_row", pa.int64()), ("starts", pa.binary()),
        ("shapes", pa.binary()), ("records", pa.binary()), ("width", pa.int32()), ("places", pa.list_(pa.int32())),
    ]

    def emit(**values):
        return pa.RecordBatch.from_pydict({k: pa.array([values.get(k)], t) for k, t in kinds})

    def kernel(batches):
        for batch in batches:
            for path, content, source in zip(
                *(batch.column(c) for c in ("path", "content", "source")), strict=True
            ):
                path, source = path.as_py(), source.as_py()
                try:
                    opened = _Layer.open(content.as_py(), layer)
                    for _ in opened.ranges(fields, most):
                        pass
                except Exception as e:  # noqa: BLE001  one bad archive must not stop the others
                    yield emit(path=path, source=source, error=f"{type(e).__name__}: {e}")
                    continue
                for first, starts, shapes, records, width, places in opened.ranges(fields, most):
                    yield emit(
                        path=path, source=source, encoding=f"{opened.note} zip:{source}", crs=opened.crs,
                        codec=opened.codec, first_row=first, starts=starts.astype("<i8").tobytes(),
                        shapes=shapes, records=records, width=width, places=places,
                    )

    return kernel


def land_archives(
    archives: DataFrame, fields: list[str], layer: str = LAYER, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Ranges of records of one layer out of ``path, content, source``, stored; or a row with an ``error``."""
    ship_kernels()
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = archives.select("path", "content", "source").repartition(n, "path")
    return settle(dealt.mapInArrow(_landing_kernel(layer, fields, range_bytes), RANGES))


def _shapes(shapes: bytes, starts: np.ndarray) -> list:
    """The rings of each record, shells before their holes; None for what is no polygon."""
    kinds, parts, points = _sizes(shapes, starts)
    out: list = [None] * len(starts)
    for i, n_parts, n_points in zip(np.flatnonzero(np.isin(kinds, POLYGONS)).tolist(), parts.tolist(), points.tolist(), strict=True):
        at = int(starts[i]) + 52
        xy = np.frombuffer(shapes, "<f8", n_points * 2, at + 4 * n_parts).reshape(-1, 2).astype("f8")
        rings = np.split(xy, np.frombuffer(shapes, "<i4", n_parts, at)[1:])
        try:
            out[i] = [ring for part in to_parts(rings) for ring in part]
        except ValueError:  # rings that cross have no order yet: repair finds one
            out[i] = rings
    return out


def _texts(records: bytes, width: int, at: int, size: int, codec: str) -> pa.Array:
    """One field of all rows, without trailing blanks; empty is null, bytes that are no text show as U+FFFD."""
    n = len(records) // width
    if at < 0 or size == 0:
        return pa.nulls(n, pa.string())
    raw = np.frombuffer(records, np.dtype({"names": ["f"], "formats": [f"S{size}"], "offsets": [at], "itemsize": width}))["f"]
    texts = np.char.rstrip(np.char.decode(raw, codec, "replace"), " \0")
    return pa.array(texts.astype(object), pa.string(), mask=texts == "")


def _decoding_kernel(fields: list[str]):
    def kernel(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                one = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                texts = {c: one[c] for c in ("path", "error", "encoding", "crs")}
                if one["error"] is not None:
                    n, own, rings, numbers = 1, [pa.nulls(1, pa.string()) for _ in fields], [None], pa.nulls(1, pa.int64())
                else:
                    rings = _shapes(one["shapes"], np.frombuffer(one["starts"], "<i8"))
                    n, at = len(rings), one["places"]
                    own = [_texts(one["records"], one["width"], *at[2 * k : 2 * k + 2], one["codec"]) for k in range(len(fields))]
                    numbers = pa.array(one["first_row"] + np.arange(n))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([v] * n, pa.string()) for v in texts.values()], numbers, *own, write_rings(rings)],
                    names=[*texts, "file_row_number", *fields, "rings"],
                )

    return kernel


def read_archives(
    archives: DataFrame, fields: list[str], layer: str = LAYER, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Rows of one layer out of ``path, content, source``; the ranges of one archive are spread over all tasks.

    An archive that cannot be read gives one row with ``error`` and no geometry.
    """
    landed = land_archives(archives, fields, layer, range_bytes)
    texts = "".join(f"`{f}` string, " for f in fields)
    schema = f"path string, error string, encoding string, crs string, file_row_number bigint, {texts}rings {RINGS_TYPE}"
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return landed.repartition(n, "path", "first_row").mapInArrow(_decoding_kernel(fields), schema)


def crs_gate(rows: DataFrame, expected: str = CRS) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``: rejected units say why in ``error``."""
    text = F.concat(
        F.lit(f"{LAYER} is in '"), F.coalesce("crs", F.lit("")), F.lit(f"', expected {expected}")
    )
    checked = rows.withColumn(
        "error",
        F.coalesce("error", F.when(F.coalesce(F.col("crs") != expected, F.lit(True)), text)),
    )
    return checked.where("error IS NULL").drop("error"), checked.where("error IS NOT NULL")


def enrich_bronze(
    rows: DataFrame, state: Column, county: Column, fema_update_date: Column
) -> DataFrame:
    """Unit keys, delivery date and load time beside the layer's own columns."""
    return rows.withColumns(
        {
            "state": state,
            "county": county,
            "fema_update_date": fema_update_date.cast("date"),
            "ingested_at": F.current_timestamp(),
        }
    )
