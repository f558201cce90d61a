"""Polygons cut into pieces of at most N coordinates, attributes repeated, pieces numbered.

Ordinary rows are cut to the end inside one Arrow task. Giants go through rounds first: each
round cuts them a few levels and redistributes the parts, so one polygon spreads over tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zoneloom.functions import rings as R
from zoneloom.functions.arrow_rings import chunks, map_parts, repeat_rows, ring_arrays, ring_list
from zoneloom.operators import clip
from zoneloom.operators import clip_many as many
from zoneloom.session import is_spread, ship_kernels, spread, stored

MAX_DEPTH = 40  # fixed value: no cut below this depth
INLINE_LIMIT = 5_000  # coordinates one task cuts to the end
LEVELS_PER_ROUND = 4


def _cut_rows(xy, point_at, ring_at, rows, depth, limit: int, levels: int | None):
    """The pieces of some rows in order: ``row of each piece, depth, coordinates, Arrow rings``."""
    count = np.diff(ring_at)[rows]
    single = rows[count == 1]
    first = ring_at[single]
    n = point_at[first + 1] - point_at[first]
    p = xy[many.ranges(point_at[first], n)]
    places, n = many.tidy(p, n)
    p, n, unit_row = p[places], n[n > 0], single[n > 0]
    p = many.oriented(p, n)
    unit_nth = np.zeros(len(n), np.int64)
    held = []  # pieces of parts with holes
    lone = [p], [n], [unit_row], [unit_nth]
    for row in rows[count > 1].tolist():
        rings = [xy[point_at[r] : point_at[r + 1]] for r in range(ring_at[row], ring_at[row + 1])]
        for nth, part in enumerate(clip.to_parts(rings)):
            if len(part) > 1:
                cut = clip.split_down(part, limit, int(depth[row]), MAX_DEPTH, levels)
                held += [(row, nth, k, d, piece) for k, (piece, d) in enumerate(cut)]
                continue
            for to, value in zip(lone, (part[0][:-1], [len(part[0]) - 1], [row], [nth]), strict=True):
                to.append(np.asarray(value))
    p, n, unit_row, unit_nth = (np.concatenate(c) for c in lone)
    p, n, of, deep = many.split_many(p, n, depth[unit_row], limit, MAX_DEPTH, levels)
    row, nth, order = unit_row[of], unit_nth[of], np.arange(len(n))
    # close the rings
    place = many.ranges(np.zeros(len(n), np.int64), n + 1)
    p = p[np.repeat(many.starts(n), n + 1) + np.where(place == np.repeat(n, n + 1), 0, place)]
    n, rings_of, size = n + 1, np.ones(len(n), np.int64), n + 1
    if held:
        rings = [ring for h in held for ring in h[4]]
        p = np.concatenate([p, *rings])
        n = np.concatenate([n, [len(r) for r in rings]])
        rings_of = np.concatenate([rings_of, [len(h[4]) for h in held]])
        size = np.concatenate([size, [clip.part_size(h[4]) for h in held]])
        row, nth, order, deep = (
            np.concatenate([have, [h[k] for h in held]]) for k, have in enumerate((row, nth, order, deep))
        )
    sort = np.lexsort((order, nth, row))
    ring = many.ranges(many.starts(rings_of)[sort], rings_of[sort])
    inner = ring_list(p[many.ranges(many.starts(n)[ring], n[ring])], n[ring])
    row_off = np.concatenate([[0], np.cumsum(rings_of[sort])]).astype(np.int32)
    return row[sort], deep[sort], size[sort], pa.ListArray.from_arrays(pa.array(row_off), inner)


def _kernel(geometry: str, limit: int, levels: int | None, extra):
    """Rows of single rings are cut together; ``extra`` makes the columns that tell the pieces of a row apart."""

    def kernel(batches):
        for batch in batches:
            xy, point_at, ring_at, _ = ring_arrays(batch.column(geometry))
            depth = batch.column("_depth").to_numpy(zero_copy_only=False)
            for begin, end in chunks(np.diff(point_at[ring_at])):
                row, deep, size, rings = _cut_rows(
                    xy, point_at, ring_at, np.arange(begin, end), depth, limit, levels
                )
                if len(row):
                    n = np.bincount(row - begin, minlength=end - begin)
                    nth = np.arange(len(row)) - many.starts(n)[row - begin]
                    new = extra(batch, row, nth, n[row - begin], deep, size)
                    yield repeat_rows(batch, row, {**new, geometry: rings})

    return kernel


def _round_kernel(geometry: str, limit: int):
    def parts(batch, row, nth, n, deep, size):
        path = batch.column("_path").to_pylist()
        return {
            # fixed-width steps, so text order is cutting order
            "_path": pa.array([f"{path[i]}{k:08x}" for i, k in zip(row.tolist(), nth.tolist(), strict=True)], pa.string()),
            "_depth": pa.array(deep, pa.int32()),
            "_n": pa.array(size, pa.int32()),
        }

    return _kernel(geometry, limit, LEVELS_PER_ROUND, parts)


def _finish_kernel(geometry: str, cap: int):
    def pieces(batch, row, nth, n, deep, size):
        return {"piece_id": pa.array(nth, pa.int32()), "_n": pa.array(n, pa.int32())}

    return _kernel(geometry, cap, None, pieces)


def subdivide(
    zones: DataFrame,
    keys: list[str],
    cap: int = 100,
    geometry: str = "rings",
    inline_limit: int = INLINE_LIMIT,
) -> DataFrame:
    """One row per piece: the zone's attributes, ``piece_id`` 0..k-1, and fresh measures.

    NULL and empty geometries give no pieces. ``keys`` identify a zone.
    """
    ship_kernels()
    size = F.col("nverts") if "nverts" in zones.columns else R.vertex_count(F.col(geometry))
    measured = [c for c in ("bbox", "srid", "nverts") if c in zones.columns]
    state = zones.withColumns(
        {
            "_path": F.lit(""),
            "_depth": F.lit(0),
            "_n": F.coalesce(size, F.lit(0)).cast("int"),
        }
    ).drop(*measured)
    step = state.withColumn("piece_id", F.lit(0)).schema
    big = (F.col("_n") > inline_limit) & (F.col("_depth") < MAX_DEPTH)
    # counted, not filtered: a filter would sink below a spreading of the rows that the geometry is made of, into few tasks
    left = state.agg(F.count_if(big)).first()[0]
    ready, giants = (state.where(~big), state.where(big)) if left else (state, None)

    dealt = is_spread(state)  # geometry that was just dealt out, or made behind the dealing of its keys, stays where it is

    def finish(rows, dealt=False):
        return (rows if dealt else spread(rows, *keys, "_path")).mapInArrow(_finish_kernel(geometry, cap), step)

    # united behind the kernel: what the planner knows of the rows before it does not outlive their columns
    pieces = finish(ready, dealt)
    rounds = 0
    while left:
        near = giants if dealt and not rounds else spread(giants, *keys, "_path")
        cut = stored(near.mapInArrow(_round_kernel(geometry, inline_limit), state.schema), "round")
        pieces, giants = pieces.unionByName(finish(cut.where(~big))), cut.where(big)
        left = giants.count()
        rounds += 1
    if rounds:
        pieces = _number_giants(pieces, keys)
    return R.with_measures(pieces.drop("_path", "_depth", "_n"), geometry)


def _number_giants(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Shift the numbers of each part of a giant by the pieces before it.

    The running sum goes over parts, thousands of pieces each, not over pieces; zones cut in one
    task are numbered already and skip it. The table of the offsets is hashed, so no geometry is sorted. Spark takes the size of a kernel's rows from its input and would
    broadcast what is not small, so the join names its way.
    """
    pieces = stored(pieces, "pieces")
    whole = F.col("_path") == ""
    before = W.partitionBy(*keys).orderBy("_path").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        pieces.where(~whole & (F.col("piece_id") == 0))
        .select(*keys, "_path", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    shifted = (
        pieces.where(~whole)
        .join(offsets.hint("shuffle_hash"), [*keys, "_path"])
        .withColumn("piece_id", (F.col("piece_id") + F.col("_offset")).cast("int"))
        .drop("_offset")
    )
    return pieces.where(whole).unionByName(shifted)


def piece_estimate(nverts, cap: int):
    """Rough number of pieces to expect."""
    return (F.ceil(nverts / F.lit(cap)) * 2).cast("bigint")


def subdivide_stats(zones: DataFrame, pieces: DataFrame) -> DataFrame:
    """``input_rows, output_rows, max_input_vertices, max_output_vertices, ratio`` in one row."""
    def side(df, tag):
        size = F.col("nverts") if "nverts" in df.columns else R.vertex_count(F.col("rings"))
        return df.select(F.lit(tag).alias("side"), size.alias("nverts"))

    is_in, is_out = F.col("side") == "in", F.col("side") == "out"
    both = side(zones, "in").unionByName(side(pieces, "out"))
    return both.agg(
        F.count_if(is_in).alias("input_rows"),
        F.count_if(is_out).alias("output_rows"),
        F.max(F.when(is_in, F.col("nverts"))).alias("max_input_vertices"),
        F.max(F.when(is_out, F.col("nverts"))).alias("max_output_vertices"),
    ).withColumn(
        "ratio",
        F.coalesce(F.try_divide(F.col("output_rows"), F.col("input_rows")), F.lit(0.0)),
    )


def cap_variants(zones: DataFrame, keys: list[str], caps=(100, 256, 512)) -> DataFrame:
    """The statistics for several caps, one row each."""
    rows = [
        subdivide_stats(zones, subdivide(zones, keys, cap)).select(F.lit(cap).alias("cap"), "*")
        for cap in caps
    ]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def _box_kernel(geometry: str):
    def kernel(batches):
        def work(i, rings, batch):
            if rings is None:
                return
            box = batch.column("clip_box")[i].as_py()
            for part in clip.to_parts(rings):
                for piece in clip.clip_to_box(part, **box):
                    yield piece, {}

        return map_parts(batches, geometry, work)

    return kernel


def clip_rows(df: DataFrame, box, geometry: str = "rings") -> DataFrame:
    """Each geometry clipped to the box of its row; one row per remaining polygon."""
    ship_kernels()
    boxed = df.drop("bbox", "srid", "nverts", "edges").withColumn("clip_box", box)
    clipped = boxed.mapInArrow(_box_kernel(geometry), boxed.schema)
    return R.with_measures(clipped.drop("clip_box"), geometry)


def grid_subdivide(zones: DataFrame, keys: list[str], size: float, geometry="rings") -> DataFrame:
    """Each zone cut along the grid: every piece lies in exactly one cell, ``ci, cj``."""
    from zoneloom.functions import grid as G

    cells = G.with_zone_cells(zones, size)
    box = G.cell_box(F.col("ci"), F.col("cj"), size)
    return clip_rows(spread(cells, *keys, "ci", "cj"), box, geometry)


class CutPieces:
    """One geometry to its pieces, for use in SQL text."""

    def eval(self, rings, cap: int):
        if rings is None:
            return
        whole = [np.array(ring, float).reshape(-1, 2) for ring in rings]
        parts = [p for part in clip.to_parts(whole) for p, _ in clip.split_down(part, cap, 0, MAX_DEPTH)]
        for k, piece in enumerate(parts):
            yield k, clip.part_size(piece), [list(map(tuple, ring.tolist())) for ring in piece]


def register_functions(spark, name: str = "subdivide_pieces") -> None:
    """Make ``name(rings, cap)`` a table function of SQL: ``FROM zones z, LATERAL subdivide_pieces(z.rings, 100) p``
    gives ``piece_id, nverts, rings``, as ``subdivide`` does for zones that one task cuts to the end."""
    ship_kernels()
    returns = f"piece_id int, nverts int, rings {R.RINGS_TYPE}"
    spark.udtf.register(name, F.udtf(CutPieces, returnType=returns))
