"""Points, boxes and zones matched through grid cells.

A spatial predicate alone would plan as a nested loop, so every join here is an equi-join on
cells, a box test, then the exact test. What meets in a cell is judged by one Arrow kernel (``judge.py``).
Keys whose sides make too many pairs are
found by counting and dealt to a grid of tasks, in which each pair still meets once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from zoneloom.functions import grid as G
from zoneloom.functions import judge
from zoneloom.functions import rings as R
from zoneloom.functions.arrow_rings import repeat_rows
from zoneloom.session import settle, ship_kernels, spread, stored

CELL = ["ci", "cj"]
HOT_PAIRS = 20_000_000  # pairs of one key that one task may test
NAMED_CELLS = 4096  # of a viewport, named in its filter
LISTED_KEYS = 100_000  # hot keys that are broadcast; more are joined with salt
SALTS = 64
REFINE = 16
REFINED_COPIES = 4  # of a zone, on average, at most: larger ones fill their cell, and finer cells would copy them
GROUP_ROWS = 250_000  # of one side of a key that one kernel call holds
GIANT_ROWS = 10_000  # the same where a row holds many lines of edges
MOST_LEVELS = 24  # of a zone's tree of edges
SHARES = 4  # groups of pairs a task of the session: a key dealt to more of them makes copies and saves no time
KERNEL_BYTES = 16 << 20  # of zones that are judged together


def hot_keys(
    left: DataFrame, right: DataFrame, on: list[str], hot_pairs: int, most_rows=None, shared: bool = False
) -> tuple[DataFrame, int]:
    """Keys whose two sides make more than ``hot_pairs`` pairs, or that have more than ``most_rows`` rows on a
    side (of the left and the right if it is two numbers), with the ways to deal each side.

    ``shared`` deals no key to groups of fewer pairs than a task's share of all pairs: its ways may be 1.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = left.select(*on, one.alias("a"), none.alias("b")).unionByName(
        right.select(*on, none.alias("a"), one.alias("b"))
    )
    counts = rows.groupBy(*on).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    dealt_pairs = hot_pairs
    if shared:
        counts = settle(counts)
        groups = SHARES * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt_pairs = max(hot_pairs, int((counts.agg(F.sum(a * b)).first()[0] or 0) / groups))
    side = max(1, math.isqrt(dealt_pairs))
    whole = F.ceil(a * b / dealt_pairs)
    ways_a = F.when(b <= side, whole).when(a <= side, 1).otherwise(F.ceil(a / side))
    ways_b = F.when(b <= side, 1).when(a <= side, whole).otherwise(F.ceil(b / side))
    many = a * b > hot_pairs
    if most_rows is not None:
        most_a, most_b = (most_rows, most_rows) if isinstance(most_rows, int) else most_rows
        many = many | (((a > most_a) | (b > most_b)) & (F.least(a, b) > 0))
        ways_a, ways_b = F.greatest(ways_a, F.ceil(a / most_a)), F.greatest(ways_b, F.ceil(b / most_b))
    hot = settle(
        counts.where(many).select(
            *on, ways_a.cast("bigint").alias("ways_a"), ways_b.cast("bigint").alias("ways_b")
        )
    )
    return hot, hot.count()


def _marked(df: DataFrame, hot: DataFrame, n: int, on: list[str], salt: Column) -> DataFrame:
    """Rows with the ways of their key, NULL for a key that is not hot."""
    if n <= LISTED_KEYS:
        return df.join(F.broadcast(hot), on, "left")
    wide = hot.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = df.withColumn("_s", F.pmod(salt, F.lit(SALTS)).cast("int"))
    return own.join(wide, [*on, "_s"], "left").drop("_s")


def _dealt(df, hot, n, on, own, own_ways, other, other_ways, by=None) -> DataFrame:
    # the hash covers the whole row, or what ``by`` names, so a retried task deals the same way
    salt = F.xxhash64(*(by or df.columns))
    rows = _marked(df, hot, n, on, salt)
    mine, theirs = F.coalesce(own_ways, F.lit(1)), F.coalesce(other_ways, F.lit(1))
    return rows.withColumns(
        {own: F.pmod(salt, mine), other: F.explode(F.sequence(F.lit(0).cast("bigint"), theirs - 1))}
    ).drop("ways_a", "ways_b")


def _keyed_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of both sides dealt out by ``on``. The planner takes geometry for as small as the rows it was
    made of: left to itself it broadcasts zones and tests all pairs in as many tasks as the points have splits."""
    return spread(left, *on).join(spread(right, *on).hint("merge"), on)


def dealt_join(
    left: DataFrame, right: DataFrame, on: list[str], hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """Inner join on ``on``; a hot key becomes a grid of tasks, each with its share of both sides."""
    hot = hot_keys(left, right, on, hot_pairs)
    return _join_dealt(left, right, on, hot, _keyed_join).drop("_a", "_b")


def _join_dealt(left, right, on, hot, join, once=(None, None)) -> DataFrame:
    """``join(left, right, keys)`` with the hot keys dealt to a grid; rows that agree in what ``once`` names of their
    side are dealt alike."""
    hot, n = hot
    if n:  # keys that are merely listed need no copies
        hot = hot.where("ways_a > 1 OR ways_b > 1")
        n = hot.count()
    if n == 0:
        return join(left, right, on)
    a, b = F.col("ways_a"), F.col("ways_b")
    left = _dealt(left, hot, n, on, "_a", a, "_b", b, once[0])
    right = _dealt(right, hot, n, on, "_b", b, "_a", a, once[1])
    return join(left, right, [*on, "_a", "_b"])


def _judged(left: DataFrame, right: DataFrame, on: list[str], kernel, leave=(), flags=(), once=None) -> DataFrame:
    """Rows that meet under ``on``: ``kernel`` gets both sides of a key as Arrow tables and tells blocks of pairs.

    The columns are those of ``left``, then of ``right``, without the geometry, the cell and what ``leave`` names,
    then ``flags`` that the kernel tells of each pair. With ``once``, the key columns of each side, pairs of rows that
    agree in them count as one, whose flags (touch, odd) are put together.

    A group is one row of two values on its way from where its sides meet to the kernel, since what is made of a group
    in the first step has to be there as a whole, and pairs are far more than rows.
    """
    ship_kernels()
    drop = {*CELL, "_a", "_b", "bbox", "rings", "edges", *leave}
    keep = [f for f in left.schema if f.name not in drop]
    keep += [f for f in right.schema if f.name not in drop and f.name not in on]
    names = [f.name for f in keep]
    schema = StructType([*keep, *[StructField(flag, BooleanType()) for flag in flags]])

    def meet(mine, theirs):
        both = [mine, theirs] if len(mine) and len(theirs) else None
        return pa.table([pa.array([judge.to_bytes(t)] if both else [], pa.binary()) for t in (mine, theirs)], names=["mine", "theirs"])

    def blocks(mine, theirs):
        step = max(1, int(KERNEL_BYTES * len(theirs) / max(1, theirs.nbytes)))
        for begin in range(0, len(theirs), step):
            for i, j, *more in kernel(mine, theirs.slice(begin, step).combine_chunks()):
                if len(i):
                    yield i, j + begin, *more

    def judge_group(mine, theirs):
        out = judge.schema_of(mine, theirs, names, flags)
        if once is None:
            found = blocks(mine, theirs)
        else:
            point, zone = judge.codes(mine, once[0]), judge.codes(theirs, once[1])
            order = np.argsort(zone, kind="stable")
            theirs, zone = theirs.take(pa.array(order)).combine_chunks(), zone[order]
            found = blocks(mine, theirs)
            if len(np.unique(point)) < len(point) or (np.diff(zone) == 0).any():
                found = (block[: 2 + len(flags)] for block in judge.by_key(found, point, zone))
            else:
                found = (block[: 2 + len(flags)] for block in found)
        for i, j, *more in found:
            yield from judge.paired(mine, theirs, i, j, out, more)

    def judge_groups(batches):
        for batch in batches:
            for mine, theirs in zip(batch.column("mine"), batch.column("theirs"), strict=True):
                yield from judge_group(judge.from_bytes(mine.as_buffer()), judge.from_bytes(theirs.as_buffer()))

    known = lambda df: spread(df.dropna(subset=on), *on).groupBy(*on)
    met = known(left).cogroup(known(right)).applyInArrow(meet, "mine binary, theirs binary")
    return met.mapInArrow(judge_groups, schema)


def with_box(zones: DataFrame, geometry: str = "rings") -> DataFrame:
    """Add ``bbox`` where missing."""
    return zones if "bbox" in zones.columns else zones.withColumn("bbox", R.bbox(F.col(geometry)))


def with_edges(zones: DataFrame, geometry: str = "rings") -> DataFrame:
    """Add ``bbox`` and ``edges`` where missing."""
    zones = with_box(zones, geometry)
    if "edges" in zones.columns:
        return zones
    return zones.withColumn("edges", R.edges(F.col(geometry)))


def _judge_points(boundary: bool, keep=None, once=None):
    """Points (``x, y``) and zones (``bbox, rings``) of one key to a join of those that meet."""

    def kernel(points, zones):
        x, y = judge.numbers(points["x"]), judge.numbers(points["y"])
        pairs = judge.points_in_zones(x, y, judge.box_arrays(zones["bbox"]), judge.edge_arrays(zones["rings"]), boundary)
        # met is met: flags to put pairs of one point and zone together
        return pairs if once is None else ((p, z, np.ones(len(p), bool), np.zeros(len(p), bool)) for p, z in pairs)

    def join(points, zones, on):
        leave = () if keep is None else {*points.columns, *zones.columns} - {*keep}
        return _judged(points, zones, on, kernel, leave, once=once)

    return join


def _finer(points: DataFrame, zones: DataFrame, size: float) -> tuple[DataFrame, DataFrame]:
    """Both sides keyed by cells of ``size``; a zone stays inside its parent cell."""
    b = F.col("bbox")

    def span(lo, hi, parent):
        first, last = _fine_span(lo, hi, parent, size)
        return F.when(first <= last, F.sequence(first, last))

    fine = (
        zones.withColumns({"_pi": F.col("ci"), "_pj": F.col("cj")})
        .withColumn("ci", F.explode(span(b["xmin"], b["xmax"], F.col("_pi"))))
        .withColumn("cj", F.explode(span(b["ymin"], b["ymax"], F.col("_pj"))))
        .drop("_pi", "_pj")
    )
    return G.with_point_cell(points, size), fine


def _fine_span(lo: Column, hi: Column, parent: Column, size: float) -> tuple[Column, Column]:
    """First and last of the finer cells of ``size`` within the cell ``parent``."""
    first = F.greatest(G.cell_index(lo, size), parent * REFINE)
    return first, F.least(G.cell_index(hi, size), parent * REFINE + (REFINE - 1))


def _refined(zones: DataFrame, hot: DataFrame, n: int, size: float) -> tuple[DataFrame, int]:
    """The hot cells whose zones are small beside a finer cell, with their number."""
    b, copies = F.col("bbox"), F.lit(1)
    for lo, hi, parent in ((b["xmin"], b["xmax"], "ci"), (b["ymin"], b["ymax"], "cj")):
        first, last = _fine_span(lo, hi, F.col(parent), size / REFINE)
        copies = copies * F.greatest(last - first + 1, F.lit(0))
    boxes = _marked(zones.select(*CELL, "bbox"), hot, n, CELL, F.xxhash64("bbox")).where("ways_a IS NOT NULL")
    means = boxes.groupBy(*CELL).agg(F.avg(copies).alias("copies"))
    few = settle(means.where(F.col("copies") <= REFINED_COPIES).select(*CELL, F.lit(True).alias("ways_a")))
    return few, few.count()


def _match(points, zones, size, boundary, hot_pairs, keep, once) -> DataFrame:
    if once is not None:
        keep = [*once[0], *once[1]]
    if keep is not None:
        points = points.select(*[c for c in points.columns if c in {"x", "y", *CELL, *keep}])
        zones = zones.select(*[c for c in zones.columns if c in {"bbox", "rings", *CELL, *keep}])
    judged, alike = _judge_points(boundary, keep, once), once or (None, None)
    hot, n = hot_keys(points, zones, CELL, hot_pairs, GROUP_ROWS, shared=True)
    few, n_few = _refined(zones, hot, n, size) if n else (None, 0)
    if n_few == 0:
        return _join_dealt(points, zones, CELL, (hot, n), judged, alike)
    p = _marked(points, few, n_few, CELL, F.xxhash64(*points.columns))
    z = _marked(zones, few, n_few, CELL, F.xxhash64(*zones.columns))
    whole, dense = F.col("ways_a").isNull(), F.col("ways_a").isNotNull()
    coarse = _join_dealt(p.where(whole).drop("ways_a"), z.where(whole).drop("ways_a"), CELL, (hot, n), judged, alike)
    fine = _finer(p.where(dense).drop("ways_a"), z.where(dense).drop("ways_a"), size / REFINE)
    many = _join_dealt(*fine, CELL, hot_keys(*fine, CELL, hot_pairs, GROUP_ROWS, shared=True), judged, alike)
    return coarse.unionByName(many)


def match_points(
    points: DataFrame,
    cell_zones: DataFrame,
    size: float,
    boundary: bool = True,
    hot_pairs: int = HOT_PAIRS,
    keep: list[str] | None = None,
    once: tuple[list[str], list[str]] | None = None,
) -> DataFrame:
    """Points (``x, y``) against zones already filed under cells (``ci, cj, bbox, rings``).

    ``keep`` names the columns of a hit; all by default. ``once``, key columns of points and of zones, tells each pair
    of keys once, in these columns, without a shuffle of the hits: points of one key have to lie at one place.
    """
    zones = with_box(cell_zones).drop("edges")
    return _match(G.with_point_cell(points, size), zones, size, boundary, hot_pairs, keep, once)


def point_in_zone(
    points: DataFrame,
    zones: DataFrame,
    size: float,
    boundary: bool = True,
    hot_pairs: int = HOT_PAIRS,
    keep: list[str] | None = None,
    once: tuple[list[str], list[str]] | None = None,
) -> DataFrame:
    """One row per (point, zone) that meet; ``boundary`` says whether the border counts, ``keep`` and ``once`` are those
    of ``match_points``."""
    filed = G.with_box_cells(with_box(zones).where("bbox IS NOT NULL"), size)
    return match_points(points, filed, size, boundary, hot_pairs, keep, once)


def _shift(op: str, value: Column, by: Column) -> Column:
    return F.call_function(op, value, by.cast("int"))


def tree_nodes(first: Column, last: Column, levels: Column) -> Column:
    """The nodes of a binary tree over ``2^levels`` leaves that together cover leaves ``first..last``, and no
    others: at most two a level. A node is numbered as in a heap, so its parent is half its number."""
    one = F.lit(1).cast("bigint")

    def of_level(up):
        width = _shift("shiftleft", one, up)
        lo = _shift("shiftright", first + width - 1, up)
        hi = _shift("shiftright", last + 1, up) - 1
        base = _shift("shiftleft", one, levels - up)
        # whole blocks whose parent is not whole: an odd one at the start, an even one at the end
        odd, even = (lo <= hi) & (lo % 2 == 1), (lo <= hi) & (hi % 2 == 0)
        return F.array(F.when(odd, base + lo), F.when(even, base + hi))

    return F.filter(
        F.flatten(F.transform(F.sequence(F.lit(0).cast("bigint"), levels), of_level)), lambda n: n.isNotNull()
    )


def tree_path(leaf: Column, levels: Column) -> Column:
    """The nodes above a leaf, itself included: ``levels + 1`` of them."""
    at = _shift("shiftleft", F.lit(1).cast("bigint"), levels) + leaf
    return F.transform(F.sequence(F.lit(0).cast("bigint"), levels), lambda up: _shift("shiftright", at, up))


def _ring_edges(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per edge, read off the exploded points: no array of edges is built."""
    return (
        df.select(*keep, F.explode("rings").alias("r"))
        .select(*keep, "r", F.posexplode("r").alias("i", "a"))
        .select(
            *keep,
            F.struct(
                F.col("a.x").alias("x1"), F.col("a.y").alias("y1"),
                F.get("r", F.col("i") + 1)["x"].alias("x2"), F.get("r", F.col("i") + 1)["y"].alias("y2"),
            ).alias("e"),
        )
        .where("e.x2 IS NOT NULL")
    )


def edge_tree(zones: DataFrame, zone_keys: list[str]) -> DataFrame:
    """Edges of ``zones`` (with ``bbox, levels``) at the nodes of their zone's tree over its height: ``keys.., node, e``."""
    e = F.col("e")
    rows = _ring_edges(zones, [*zone_keys, "bbox", "levels"])
    low, high = _leaf(F.least(e["y1"], e["y2"])), _leaf(F.greatest(e["y1"], e["y2"]))
    at = rows.select(*zone_keys, "e", "levels", low.alias("low"), high.alias("high"))
    leaf = _shift("shiftleft", F.lit(1).cast("bigint"), F.col("levels")) + F.col("low")
    nodes = F.when(F.col("low") == F.col("high"), F.array(leaf)).otherwise(
        tree_nodes(F.col("low"), F.col("high"), F.col("levels"))
    )
    return at.select(*zone_keys, "e", F.explode(nodes).alias("node"))


def _leaf(y: Column) -> Column:
    """The leaf that a height falls on; heights keep their order, so an edge covers the leaf of every height it spans."""
    b = F.col("bbox")
    leaves = _shift("shiftleft", F.lit(1).cast("bigint"), F.col("levels"))
    at = F.floor((y - b["ymin"]) / F.nullif(b["ymax"] - b["ymin"], F.lit(0.0)) * leaves).cast("bigint")
    return F.coalesce(F.greatest(F.lit(0).cast("bigint"), F.least(at, leaves - 1)), F.lit(0).cast("bigint"))


def with_levels(zones: DataFrame) -> DataFrame:
    """Add ``levels``: a tree of about as many leaves as the zone has coordinates."""
    size = F.col("nverts") if "nverts" in zones.columns else R.vertex_count(F.col("rings"))
    levels = F.ceil(F.log2(F.greatest(size, F.lit(2)).cast("double"))).cast("bigint")
    return zones.withColumn("levels", F.least(levels, F.lit(MOST_LEVELS).cast("bigint")))


def point_in_giant_zone(
    points: DataFrame,
    zones: DataFrame,
    point_keys: list[str],
    zone_keys: list[str],
    size: float,
) -> DataFrame:
    """The same match for uncut polygons of any size: edges are filed by cell, in lines of a few.

    A cell gets the lines that reach into it and, of those east of it, the heights of their ends; one that is
    above, below or west of a cell does not matter to its points. Points meet the lines of their cell, and touches
    and parities are put together where they meet; only zones with more than ``GIANT_ROWS`` rows in a cell are dealt
    to several tasks and put together by keys. No row holds a whole polygon after the scan. Points of one key have to
    lie at one place.
    """
    ship_kernels()
    wide = with_box(zones).where("bbox IS NOT NULL").dropna(subset=zone_keys).select(*zone_keys, "bbox", "rings")
    rows = StructType([*wide.schema, StructField("ci", LongType()), StructField("cj", LongType())])

    def file_lines(batches):
        for batch in batches:
            for row, ci, cj, lines in judge.file_edges(batch.column("rings"), judge.box_arrays(batch.column("bbox")), size):
                new = {"rings": lines, "ci": pa.array(ci), "cj": pa.array(cj)}
                yield repeat_rows(batch, row, new)

    def kernel(pts, lines):
        x, y = judge.numbers(pts["x"]), judge.numbers(pts["y"])
        return judge.touches_and_parities(x, y, judge.box_arrays(lines["bbox"]), judge.edge_arrays(lines["rings"]))

    # stored: keys are counted before rows meet
    filed = stored(wide.mapInArrow(file_lines, rows), "filed")
    asked = G.with_point_cell(points.select(*point_keys, "x", "y"), size)
    crowded = filed.groupBy(*CELL, *zone_keys).agg(F.count("*").alias("n")).where(F.col("n") > GIANT_ROWS)
    crowded = settle(crowded.select(*zone_keys).distinct())

    def met(lines, most, once):
        hot = hot_keys(asked, lines, CELL, HOT_PAIRS, most, shared=True)
        judged = lambda a, b, on: _judged(a, b, on, kernel, ["x", "y"], ["touch", "odd"], once)
        return _join_dealt(asked, lines, CELL, hot, judged, once or (None, None))

    keys = point_keys, zone_keys
    if crowded.isEmpty():
        return met(filed, (GROUP_ROWS, GIANT_ROWS), keys).where("touch OR odd").select(*point_keys, *zone_keys)
    few = met(filed.join(crowded, zone_keys, "left_anti"), (GROUP_ROWS, GIANT_ROWS), keys).where("touch OR odd")
    many = (
        met(filed.join(crowded, zone_keys, "left_semi"), GIANT_ROWS, None)
        .groupBy(*point_keys, *zone_keys)
        .agg(F.bool_or("touch").alias("touch"), F.count_if("odd").alias("odd"))
        .where("touch OR odd % 2 = 1")
    )
    return few.select(*point_keys, *zone_keys).unionByName(many.select(*point_keys, *zone_keys))


def box_join(left: DataFrame, right: DataFrame, size: float, left_box="lbox", right_box="rbox"):
    """Pairs of rows whose boxes meet, each once.

    A pair can share many cells; it counts in the cell of the lower left corner of the overlap.
    """
    a, b = F.col(left_box), F.col(right_box)
    own_i = G.cell_index(F.greatest(a["xmin"], b["xmin"]), size)
    own_j = G.cell_index(F.greatest(a["ymin"], b["ymin"]), size)
    return (
        dealt_join(
            G.with_box_cells(left, size, left_box), G.with_box_cells(right, size, right_box), CELL
        )
        .where(R.boxes_meet(a, b) & (F.col("ci") == own_i) & (F.col("cj") == own_j))
        .drop(*CELL)
    )


def zones_in_boxes(boxes: DataFrame, zones: DataFrame, size: float, box: str = "vbox") -> DataFrame:
    """Pairs of box and zone that truly meet, without the geometry of either.

    A pair can share many cells; it counts in the cell of the lower left corner of the overlap.
    """

    def kernel(seen, met):
        cell = seen["ci"][0].as_py(), seen["cj"][0].as_py()
        return judge.boxes_in_zones(
            judge.box_arrays(seen[box]), judge.box_arrays(met["bbox"]), judge.edge_arrays(met["rings"]), cell, size
        )

    left = G.with_box_cells(boxes, size, box)
    right = G.with_box_cells(with_box(zones).where("bbox IS NOT NULL").drop("edges"), size)
    hot = hot_keys(left, right, CELL, HOT_PAIRS, GROUP_ROWS, shared=True)
    return _join_dealt(left, right, CELL, hot, lambda a, b, on: _judged(a, b, on, kernel, [box]))


def lookup_point(layout: DataFrame, x: float, y: float, size: float, boundary: bool = True):
    """Zones at one position, from the cell layout: one cell, box predicate, exact test."""
    cell = f"{math.floor(x / size)}_{math.floor(y / size)}"
    px, py = F.lit(float(x)), F.lit(float(y))
    exact = R.intersects_point if boundary else R.contains_point
    return (
        layout.where(F.col("cell") == cell)
        .where(R.box_has_point(F.col("bbox"), px, py))
        .where(exact(R.edges(F.col("rings")), px, py))
    )


def box_cells(spark, box: tuple[float, float, float, float], size: float) -> DataFrame:
    """Cells a box overlaps."""
    one = spark.range(1).select(R.envelope(*box).alias("bbox"))
    return G.with_box_cells(one, size).select(G.cell_id(F.col("ci"), F.col("cj")).alias("cell"))


def read_viewport(
    layout: DataFrame,
    box: tuple[float, float, float, float],
    size: float,
    hide: str | None = None,
    key=("state", "county", "zone_id", "piece_id"),
) -> DataFrame:
    """Pieces in a viewport, one row per piece although it may sit in several cells.

    Only cells that overlap the box are scanned: their names are literals, up to ``NAMED_CELLS`` of
    them, so that partitions are pruned when the scan is planned; a larger box joins its cells. The
    box predicate prunes row groups. ``hide`` leaves out one risk class. A piece is taken from the
    first of its cells in the view, which its row tells by itself, so nothing is grouped or shuffled.
    """
    view = R.envelope(*box)
    b = F.col("bbox")
    # literal bounds reach the Parquet reader
    near = (b["xmin"] <= box[2]) & (b["xmax"] >= box[0]) & (b["ymin"] <= box[3]) & (
        b["ymax"] >= box[1]
    )
    across = range(math.floor(box[0] / size), math.floor(box[2] / size) + 1)
    along = range(math.floor(box[1] / size), math.floor(box[3] / size) + 1)
    if len(across) * len(along) <= NAMED_CELLS:
        rows = layout.where(near & F.col("cell").isin([f"{i}_{j}" for i in across for j in along]))
    else:
        rows = layout.where(near).join(box_cells(layout.sparkSession, box, size), "cell", "left_semi")
    if hide:
        rows = rows.where(F.col("risk") != hide)
    edges = R.edges(F.col("rings"))
    rows = rows.where(R.intersects_box(edges, view))
    keep = [c for c in rows.columns if c not in (*key, "cell", "ci", "cj")]
    west, east = G.cell_index(b["xmin"], size), G.cell_index(b["xmax"], size)
    south, north = G.cell_index(b["ymin"], size), G.cell_index(b["ymax"], size)
    first_i, first_j = F.greatest(west, F.lit(across[0])), F.greatest(south, F.lit(along[0]))
    last_j = F.least(north, F.lit(along[-1]))
    ci, cj = F.col("ci"), F.col("cj")
    # cells of its box in the view that come before the row's own; few, as a piece is small
    before = F.flatten(
        F.transform(
            F.sequence(first_i, ci),
            lambda i: F.filter(
                F.transform(F.sequence(first_j, last_j), lambda j: F.struct(i.alias("i"), j.alias("j"))),
                lambda c: (c["i"] < ci) | (c["j"] < cj),
            ),
        )
    )
    elsewhere = F.exists(before, lambda c: R.intersects_box(edges, G.cell_box(c["i"], c["j"], size)))
    alone = (west == east) & (south == north)
    return rows.where(F.when(alone, F.lit(True)).otherwise(~elsewhere)).select(*key, *keep)


def files_for_boxes(
    boxes: DataFrame, index: DataFrame, size: float, box_key: str, budget: int | None = None
) -> DataFrame:
    """Per viewport: files whose box meets it, their bytes, and with a budget whether to refuse.

    ``index`` has one row per file: ``bbox, bytes``. Viewports without a file stay, with 0.
    """
    pairs = box_join(
        boxes.select(box_key, "vbox"), index.select("bbox", "bytes"), size, "vbox", "bbox"
    )
    per_box = pairs.groupBy(box_key).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )
    out = boxes.select(box_key).join(per_box, box_key, "left").na.fill(0, ["files", "bytes"])
    return out.withColumn("refused", F.col("files") > budget) if budget is not None else out


def candidate_files(points: DataFrame, index: DataFrame, file_key: str, size: float) -> DataFrame:
    """Every point beside each file whose box holds it."""
    at = R.envelope(F.col("x"), F.col("y"), F.col("x"), F.col("y"))
    pairs = box_join(points.withColumn("at", at), index.select(file_key, "bbox"), size, "at", "bbox")
    return pairs.drop("at", "bbox")


def match_in_files(files: DataFrame, zones: DataFrame, file_key: str, size: float, keep: list[str] | None = None) -> DataFrame:
    """Points beside their candidate files against the zones of those files only; ``keep`` names the columns of a hit."""
    on = [file_key, *CELL]
    points, filed = G.with_point_cell(files, size), G.with_box_cells(with_box(zones).drop("edges"), size)
    return _join_dealt(points, filed, on, hot_keys(points, filed, on, HOT_PAIRS, GROUP_ROWS, shared=True), _judge_points(True, keep))


def two_step_lookup(
    points: DataFrame, index: DataFrame, zones: DataFrame, file_key: str, size: float
) -> DataFrame:
    """Points to candidate files by the index, then to zones within those files only."""
    return match_in_files(candidate_files(points, index, file_key, size), zones, file_key, size)


def spread_points(ids: DataFrame, extents: DataFrame, group: str, id_col: str) -> DataFrame:
    """Reproducible points over the extents: id ``i`` goes to group number ``i % groups``.

    A multiplicative hash of the id replaces a random number, so any partitioning gives the same
    points. ``extents`` holds one row per group, a table of tens of rows.
    """
    from pyspark.sql import Window as W

    groups = extents.agg(F.count("*").alias("n_groups"))
    ranked = extents.withColumn("k", F.dense_rank().over(W.orderBy(group)) - 1)
    numbered = ranked.withColumn("n_groups", groups.scalar())
    unit = lambda factor: F.pmod(F.col(id_col) * factor, F.lit(65536)) / F.lit(65536.0)
    n = groups.scalar()
    return (
        ids.withColumn("k", F.pmod(F.col(id_col), n).cast("int"))
        .join(F.broadcast(numbered), "k")
        .select(
            id_col,
            group,
            (F.col("bbox.xmin") + unit(48271) * (F.col("bbox.xmax") - F.col("bbox.xmin"))).alias(
                "x"
            ),
            (F.col("bbox.ymin") + unit(69621) * (F.col("bbox.ymax") - F.col("bbox.ymin"))).alias(
                "y"
            ),
        )
    )
