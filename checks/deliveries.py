"""ZIP deliveries made from the zones, to have archives to ingest."""

from __future__ import annotations

import io
import struct
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V

NAD83 = 'GEOGCS["GCS_North_American_1983"]'
WGS84 = 'GEOGCS["GCS_WGS_1984"]'


def shapefile(rows: list[tuple[dict, list]], encoding: str, fields: dict[str, int]) -> dict[str, bytes]:
    """``.shp``, ``.shx`` and ``.dbf`` bytes; rings are written clockwise first, as the format has it."""
    records, index = b"", b""
    for n, (_, rings) in enumerate(rows, 1):
        rings = [np.asarray(r, "<f8")[::-1] for r in rings]
        xy = np.vstack(rings)
        starts = np.cumsum([0] + [len(r) for r in rings[:-1]]).astype("<i4")
        body = struct.pack("<i4d2i", 5, *xy.min(0), *xy.max(0), len(rings), len(xy))
        body += starts.tobytes() + xy.tobytes()
        index += struct.pack(">2i", 50 + len(records) // 2, len(body) // 2)
        records += struct.pack(">2i", n, len(body) // 2) + body
    shp = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(records)) // 2)
    shp += struct.pack("<2i8d", 1000, 5, *([0.0] * 8)) + records
    width = 1 + sum(fields.values())
    head = struct.pack("<4BIHH20x", 3, 126, 1, 1, len(rows), 33 + 32 * len(fields), width)
    for name, size in fields.items():
        head += struct.pack("<11sc4xB15x", name.encode(), b"C", size)
    lines = b"".join(
        b" " + b"".join(str(row[f]).encode(encoding).ljust(size)[:size] for f, size in fields.items())
        for row, _ in rows
    )
    return {"shp": shp, "shx": shp[:100] + index, "dbf": head + b"\r" + lines + b"\x1a"}


def zip_bytes(rows, encoding: str, crs: str, layer: str, cpg: bool) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("other.txt", "nothing")
        for ext, data in shapefile(rows, encoding, {"FLD_AR_ID": 12, "COUNTY": 24}).items():
            if ext != "shx" or cpg:  # some deliveries lack the record index
                z.writestr(f"folder/{layer}.{ext}", data)
        z.writestr(f"folder/{layer}.prj", crs)
        if cpg:
            z.writestr(f"folder/{layer}.cpg", "UTF-8")
    return out.getvalue()


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    a = int(pdf["archive"].iloc[0])
    pdf = pdf.sort_values("zone_id")
    rows = [
        ({"FLD_AR_ID": z, "COUNTY": c}, [[(p["x"], p["y"]) for p in r] for r in rings])
        for z, c, rings in zip(pdf["zone_id"], pdf["county"], pdf["rings"], strict=True)
    ]
    cpg = a % 2 == 0
    layer = "s_other_layer" if a % 7 == 6 else "x_S_Fld_Haz_Ar" if a % 3 == 0 else "S_FLD_HAZ_AR"
    data = zip_bytes(rows, "utf-8" if cpg else "latin1", WGS84 if a % 5 == 4 else NAD83, layer, cpg)
    return pd.DataFrame({"path": [f"landed/{a}.zip"], "content": [data], "source": ["cache"]})


def archives(spark: SparkSession, sf: str) -> DataFrame:
    """One archive per 25 zones; some lack the layer, some are in another system."""
    rows = V.zones(spark, sf).withColumn("archive", F.floor(F.col("zone_id") / 25))
    return rows.groupBy("archive").applyInPandas(
        _pack, "path string, content binary, source string"
    )
