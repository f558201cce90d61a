"""Square cells and the Hilbert curve."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneloom.functions import judge
from zoneloom.functions import rings as R
from zoneloom.session import ship_kernels

DEGREE_CELL = 0.125  # about the size of a resolution 5 hexagon; dyadic, so exact in doubles


def cell_index(v: Column, size: float) -> Column:
    """Grid row or column of a coordinate."""
    return F.floor(v / F.lit(float(size))).cast("bigint")


def cell_id(ci: Column, cj: Column) -> Column:
    """Cell name, safe in a path."""
    return F.concat_ws("_", ci.cast("string"), cj.cast("string"))


def with_point_cell(df: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """Add ``ci, cj`` of the position."""
    return df.withColumns({"ci": cell_index(F.col(x), size), "cj": cell_index(F.col(y), size)})


def cell_box(ci: Column, cj: Column, size: float) -> Column:
    """Closed box of a cell."""
    s = float(size)
    return R.envelope(ci * F.lit(s), cj * F.lit(s), (ci + 1) * F.lit(s), (cj + 1) * F.lit(s))


def with_box_cells(df: DataFrame, size: float, box: str = "bbox") -> DataFrame:
    """One row per cell that the box meets."""
    b = F.col(box)
    span = lambda lo, hi: F.explode(F.sequence(cell_index(lo, size), cell_index(hi, size)))
    return df.select("*", span(b["xmin"], b["xmax"]).alias("ci")).select(
        "*", span(b["ymin"], b["ymax"]).alias("cj")
    )


def with_zone_cells(df: DataFrame, size: float, exact: bool = True) -> DataFrame:
    """One row per cell the geometry overlaps, not only the one of its centre.

    ``df`` needs ``bbox``, and ``rings`` or ``edges``. A box inside one cell needs no exact test.
    """
    if not exact:
        return with_box_cells(df, size)
    ship_kernels()
    shape = "rings" if "rings" in df.columns else "edges"
    read = judge.edge_arrays if shape == "rings" else judge.listed_edges

    @F.arrow_udf("array<struct<ci:bigint,cj:bigint>>")
    def cells(geometry: pa.Array, box: pa.Array) -> pa.Array:
        zone, ci, cj = judge.cells_of(judge.box_arrays(box), read(geometry), float(size))
        pairs = pa.StructArray.from_arrays([pa.array(ci), pa.array(cj)], names=["ci", "cj"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(zone, np.arange(len(box) + 1)).astype(np.int32)), pairs)

    found = df.select("*", F.explode(cells(shape, "bbox")).alias("_cell"))
    return found.select(*df.columns, "_cell.ci", "_cell.cj")


NIBBLE = 4  # bits of each axis that one look into the table takes


@lru_cache(maxsize=1)
def _hilbert_table() -> list[int]:
    """Per state (1: axes swapped, 2: both flipped) and four bits of x and y: the next state above eight bits of the curve."""
    out = []
    for state in range(4):
        for x in range(1 << NIBBLE):
            for y in range(1 << NIBBLE):
                now, d = state, 0
                for b in reversed(range(NIBBLE)):
                    rx, ry = (x >> b) & 1, (y >> b) & 1
                    if now & 1:
                        rx, ry = ry, rx
                    if now & 2:
                        rx, ry = 1 - rx, 1 - ry
                    d = d * 4 + ((3 * rx) ^ ry)
                    if ry == 0:
                        now ^= 1 | (rx << 1)
                out.append((now << 2 * NIBBLE) + d)
    return out


def hilbert(ix: Column, iy: Column, bits: int) -> Column:
    """Position on the Hilbert curve of 2^bits by 2^bits, integers only: four bits of each axis a step, from a table."""
    looks = -(-bits // NIBBLE)
    table = F.expr(f"array({', '.join(map(str, _hilbert_table()))})")
    low = (1 << 2 * NIBBLE) - 1
    # a leading zero of both axes swaps them and moves nothing
    state, d = F.lit(((looks * NIBBLE - bits) % 2) << 2 * NIBBLE), F.lit(0).cast("bigint")
    for shift in range((looks - 1) * NIBBLE, -1, -NIBBLE):
        x, y = (F.shiftright(v.cast("bigint"), shift).bitwiseAND(F.lit((1 << NIBBLE) - 1)).cast("int") for v in (ix, iy))
        seen = F.get(table, state + x * (1 << NIBBLE) + y)
        state, d = seen.bitwiseAND(F.lit(~low)), d * (low + 1) + seen.bitwiseAND(F.lit(low))
    return d


def hilbert_in_box(x: Column, y: Column, box: Column, bits: int = 16) -> Column:
    """Hilbert key of a position scaled into a box; outside positions take the border."""
    top = (1 << bits) - 1

    def scaled(v, lo, hi):
        width = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
        at = F.floor((v - lo) / width * F.lit(float(1 << bits)))
        return F.greatest(F.lit(0), F.least(F.lit(top), at)).cast("bigint")

    return hilbert(
        scaled(x, box["xmin"], box["xmax"]), scaled(y, box["ymin"], box["ymax"]), bits
    )


def box_centre(box: Column) -> tuple[Column, Column]:
    """Middle of a box."""
    return (box["xmin"] + box["xmax"]) / 2, (box["ymin"] + box["ymax"]) / 2


def densified_box(df: DataFrame, step: float, box: str = "bbox") -> DataFrame:
    """The border of a box as a closed ring, a point about every ``step`` along each side.

    Adds ``seq`` (0-based along the ring, counter-clockwise from the lower left) and ``x, y``.
    """
    b = F.col(box)
    nx = F.greatest(F.lit(1), F.floor((b["xmax"] - b["xmin"]) / step)).cast("int")
    ny = F.greatest(F.lit(1), F.floor((b["ymax"] - b["ymin"]) / step)).cast("int")
    df = df.withColumns({"_nx": nx, "_ny": ny})
    nx, ny, s = F.col("_nx"), F.col("_ny"), F.col("seq")
    dx, dy = b["xmax"] - b["xmin"], b["ymax"] - b["ymin"]
    out = df.select("*", F.explode(F.sequence(F.lit(0), 2 * (nx + ny))).alias("seq"))
    x = (
        F.when(s <= nx, b["xmin"] + dx * s / nx)
        .when(s <= nx + ny, b["xmax"])
        .when(s <= 2 * nx + ny, b["xmax"] - dx * (s - nx - ny) / nx)
        .otherwise(b["xmin"])
    )
    y = (
        F.when(s <= nx, b["ymin"])
        .when(s <= nx + ny, b["ymin"] + dy * (s - nx) / ny)
        .when(s <= 2 * nx + ny, b["ymax"])
        .otherwise(b["ymax"] - dy * (s - 2 * nx - ny) / ny)
    )
    return out.withColumns({"x": x, "y": y}).drop("_nx", "_ny")
