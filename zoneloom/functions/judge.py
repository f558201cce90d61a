"""Points, boxes and zones that met in one cell, judged together: numpy kernels of Arrow tasks.

A box is four arrays (xmin, ymin, xmax, ymax). Edges are five: x1, y1, x2, y2 and the number of their zone,
rising. The sums are those of ``functions/rings.py``, in the same order, so that both tell the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from zoneloom.functions.arrow_rings import ring_arrays, ring_list

BLOCK = 400_000  # pairs judged at once
ROWS_OUT = 200_000  # of one batch that leaves a kernel
LINE = 64  # edges filed together
FILED_POINTS = 4_096  # of a zone in one row of a cell, about
RUN = 400  # points that an edge reaches on average, from which edges are judged one by one


def numbers(column) -> np.ndarray:
    """Doubles of an Arrow column, NaN for NULL."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.to_numpy(zero_copy_only=False).astype(float)


def box_arrays(column) -> tuple:
    """The four sides of a column of boxes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return tuple(numbers(pc.struct_field(column, side)) for side in ("xmin", "ymin", "xmax", "ymax"))


def edge_arrays(column) -> tuple:
    """All edges of a column of rings."""
    xy, point_at, ring_at, _ = ring_arrays(column)
    opens = np.ones(len(xy), bool)
    opens[point_at[1:][np.diff(point_at) > 0] - 1] = False  # the last point of a ring opens none
    at = np.flatnonzero(opens)
    zone = np.repeat(np.arange(len(ring_at) - 1), np.diff(point_at[ring_at]))[at]
    return xy[at, 0], xy[at, 1], xy[at + 1, 0], xy[at + 1, 1], zone


def listed_edges(column) -> tuple:
    """The same of a column of lists of (x1, y1, x2, y2)."""
    flat = column.flatten()
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return *(numbers(pc.struct_field(flat, f)) for f in ("x1", "y1", "x2", "y2")), np.repeat(np.arange(len(n)), n)


def cells_of(box, edges, size: float) -> tuple:
    """Cells that zones overlap: ``zone, ci, cj`` by zone. A box inside one cell needs no look at the edges."""
    with np.errstate(invalid="ignore"):
        west, south, east, north = (np.floor(side / size) for side in box)
        wide, tall = east - west + 1, north - south + 1
        n = np.nan_to_num(np.maximum(wide, 0) * np.maximum(tall, 0)).astype(np.int64)
    zone = np.repeat(np.arange(len(n)), n)
    k = _spans(np.zeros(len(n), np.int64), n)
    ci, cj = west[zone] + k // tall[zone], south[zone] + k % tall[zone]
    keep = n[zone] == 1
    rest = np.flatnonzero(~keep)
    i, j = ci[rest], cj[rest]
    keep[rest] = box_meets_zone(zone[rest], (i * size, j * size, (i + 1) * size, (j + 1) * size), edges)
    return zone[keep], ci[keep].astype(np.int64), cj[keep].astype(np.int64)


def _blocks(sizes, most):
    """Runs of items whose sizes add up to about ``most``."""
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, "right")))
        yield begin, end
        begin = end


def _spans(low, n):
    """The numbers low, low + 1 .. of each span, end to end."""
    first = np.cumsum(n) - n
    return np.arange(int(n.sum())) + np.repeat(low - first, n)


def _side(x1, y1, x2, y2, x, y):
    return (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)


def crossings(x, y, box, edges):
    """Runs of zones as ``(first zone, crossings, touch, held)``, each an array of zone by point: edges met by the
    ray from the point towards +x, whether it lies on one, and whether the zone's box holds it.

    Points come by height, so an edge is paired with those it reaches and no others."""
    x1, y1, x2, y2, zone = edges
    low = np.searchsorted(y, np.minimum(y1, y2), "left")
    n = np.maximum(np.searchsorted(y, np.maximum(y1, y2), "right") - low, 0)
    left, right = np.minimum(x1, x2), np.maximum(x1, x2)
    first = np.searchsorted(zone, np.arange(len(box[0]) + 1))
    points = len(x)
    step = max(1, BLOCK // max(1, points))
    for begin in range(0, len(box[0]), step):
        end = min(begin + step, len(box[0]))
        west, south, east, north = (side[begin:end, None] for side in box)
        held = (west <= x) & (east >= x) & (south <= y) & (north >= y)
        flat = held.ravel()
        count, touch = np.zeros(len(flat), np.int64), np.zeros(len(flat), bool)
        e0 = first[begin]
        for a, b in _blocks(n[e0 : first[end]], BLOCK):
            k = np.repeat(np.arange(e0 + a, e0 + b), n[e0 + a : e0 + b])
            p = _spans(low[e0 + a : e0 + b], n[e0 + a : e0 + b])
            key = (zone[k] - begin) * points + p
            # an edge west of the point is neither met by its ray nor touched
            keep = flat[key] & (x[p] <= right[k])
            k, p, key = k[keep], p[keep], key[keep]
            px, py, ay, by = x[p], y[p], y1[k], y2[k]
            side = _side(x1[k], ay, x2[k], by, px, py)
            on = side == 0
            met = ((ay > py) != (by > py)) & ((side > 0) == (by > ay)) & ~on
            count += np.bincount(key[met], minlength=len(flat))
            touch[key[on & (px >= left[k])]] = True
        yield begin, count.reshape(held.shape), touch.reshape(held.shape), held


def _by_edge(x, y, box, edges):
    """What ``met_pairs`` tells, zone by zone and edge by edge: the points that an edge reaches are one run of the
    heights, so nothing is gathered. The sums are those of ``crossings``."""
    x1, y1, x2, y2, zone = edges
    zlo, zhi = np.searchsorted(y, box[1], "left"), np.searchsorted(y, box[3], "right")
    top = np.maximum(y1, y2)
    low = np.maximum(np.searchsorted(y, np.minimum(y1, y2), "left"), zlo[zone]).tolist()
    high = np.minimum(np.searchsorted(y, top, "right"), zhi[zone]).tolist()
    below = np.minimum(np.searchsorted(y, top, "left"), zhi[zone]).tolist()  # the upper end of an edge is not crossed
    left, right = np.minimum(x1, x2).tolist(), np.maximum(x1, x2).tolist()
    dx, dy = (x2 - x1).tolist(), (y2 - y1).tolist()
    x1, y1 = x1.tolist(), y1.tolist()
    first = np.searchsorted(zone, np.arange(len(box[0]) + 1)).tolist()
    west, east, zlo, zhi = box[0].tolist(), box[2].tolist(), zlo.tolist(), zhi.tolist()
    for z in range(len(west)):
        begin, end = zlo[z], zhi[z]
        if begin >= end or first[z] == first[z + 1]:
            continue
        odd, touch = np.zeros(end - begin, bool), np.zeros(end - begin, bool)
        for k in range(first[z], first[z + 1]):
            a, b = low[k], high[k]
            if a >= b:
                continue
            px = x[a:b]
            side = y[a:b] - y1[k]
            side *= dx[k]
            back = px - x1[k]
            back *= dy[k]
            side -= back
            near = px <= right[k]
            if not side.all():
                touch[a - begin : b - begin] |= (side == 0) & near & (px >= left[k])
            c = below[k]
            if c > a:
                near &= (side > 0) if dy[k] > 0 else (side < 0)
                odd[a - begin : c - begin] ^= near[: c - a]
        px = x[begin:end]
        p = np.flatnonzero((odd | touch) & (px >= west[z]) & (px <= east[z]))
        if len(p):
            yield p + begin, np.full(len(p), z), odd[p], touch[p]


def met_pairs(x, y, box, edges):
    """Blocks of ``(point, zone, odd, touch)`` by zone, of the pairs in which the zone's box holds the point and its ray
    meets an odd number of edges or it lies on one."""
    order = np.argsort(y, kind="stable")
    x, y = x[order], y[order]
    reach = np.searchsorted(y, np.maximum(edges[1], edges[3]), "right") - np.searchsorted(y, np.minimum(edges[1], edges[3]), "left")
    if len(reach) and reach.mean() >= RUN:
        for p, z, odd, touch in _gathered(_by_edge(x, y, box, edges)):
            yield order[p], z, odd, touch
        return
    for begin, count, touch, held in crossings(x, y, box, edges):
        odd = count % 2 == 1
        z, p = np.nonzero(held & (odd | touch))
        if len(z):
            yield order[p], z + begin, odd[z, p], touch[z, p]


def _gathered(blocks):
    """Small blocks put together to about ``ROWS_OUT`` pairs."""
    held, n = [], 0
    for block in blocks:
        held.append(block)
        n += len(block[0])
        if n >= ROWS_OUT:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def points_in_zones(x, y, box, edges, boundary: bool):
    """Blocks of the numbers of points and zones that meet, pair by pair."""
    for p, z, odd, touch in met_pairs(x, y, box, edges):
        if boundary:
            yield p, z
        else:
            inside = odd & ~touch
            yield p[inside], z[inside]


def _edges_meet(e, box):
    """Closed segments against closed boxes, one of each a pair."""
    x1, y1, x2, y2 = e
    west, south, east, north = box
    corners = [_side(x1, y1, x2, y2, a, b) for a in (west, east) for b in (south, north)]
    low, high = np.minimum(corners[0], corners[1]), np.maximum(corners[0], corners[1])
    low, high = np.minimum(np.minimum(low, corners[2]), corners[3]), np.maximum(np.maximum(high, corners[2]), corners[3])
    return (low <= 0) & (high >= 0)


def box_meets_zone(zone, box, edges):
    """Whether the box of each pair meets its zone: an edge meets it, or it lies inside. ``zone`` numbers the zones."""
    x1, y1, x2, y2, of = edges
    first = np.searchsorted(of, np.arange(int(of[-1]) + 2 if len(of) else 1))
    first = np.concatenate([first, np.full(max(0, int(zone.max(initial=-1)) + 2 - len(first)), len(of))])
    n = first[zone + 1] - first[zone]
    out = np.zeros(len(zone), bool)
    for a, b in _blocks(n, BLOCK):
        pair = np.repeat(np.arange(a, b), n[a:b])
        k = _spans(first[zone[a:b]], n[a:b])
        west, south, east, north = (side[pair] for side in box)
        ax, ay, bx, by = x1[k], y1[k], x2[k], y2[k]
        near = (np.minimum(ax, bx) <= east) & (np.maximum(ax, bx) >= west) & (np.minimum(ay, by) <= north) & (np.maximum(ay, by) >= south)
        met = np.zeros(len(k), bool)
        met[near] = _edges_meet((ax[near], ay[near], bx[near], by[near]), (west[near], south[near], east[near], north[near]))
        # the lower left corner lies inside; on an edge, that edge meets the box
        cut = (ay > south) != (by > south)
        side = _side(ax[cut], ay[cut], bx[cut], by[cut], west[cut], south[cut])
        cut[cut] = ((side > 0) == (by[cut] > ay[cut])) & (side != 0)
        inside = np.bincount(pair[cut] - a, minlength=b - a) % 2 == 1
        out[a:b] = inside
        out[pair[met]] = True
    return out


def boxes_in_zones(seen, box, edges, cell, size: float):
    """Blocks of the numbers of the boxes ``seen`` and of the zones that meet, each pair in the cell of the lower left corner
    of the overlap of its boxes."""
    edged = np.zeros(len(box[0]), bool)
    edged[edges[4]] = True
    step = max(1, BLOCK // max(1, len(seen[0])))
    for begin in range(0, len(box[0]), step):
        west, south, east, north = (side[begin : begin + step, None] for side in box)
        own = (np.floor(np.maximum(west, seen[0]) / size) == cell[0]) & (np.floor(np.maximum(south, seen[1]) / size) == cell[1])
        z, v = np.nonzero(own & (west <= seen[2]) & (east >= seen[0]) & (south <= seen[3]) & (north >= seen[1]))
        z += begin
        zb, vb = tuple(s[z] for s in box), tuple(s[v] for s in seen)
        # any edge proves a zone that lies whole in the box
        meets = edged[z] & (zb[0] >= vb[0]) & (zb[2] <= vb[2]) & (zb[1] >= vb[1]) & (zb[3] <= vb[3])
        rest = np.flatnonzero(~meets)
        meets[rest] = box_meets_zone(z[rest], tuple(s[rest] for s in vb), edges)
        yield v[meets], z[meets]


def schema_of(left: pa.Table, right: pa.Table, names: list[str], flags) -> pa.Schema:
    """The fields of a join; a column is that of the first table that has it."""
    fields = [(left if n in left.column_names else right).schema.field(n) for n in names]
    return pa.schema([*fields, *[pa.field(flag, pa.bool_()) for flag in flags]])


def touches_and_parities(x, y, box, edges):
    """Blocks of the numbers of points and zones, whether the point lies on an edge and whether its ray meets an odd
    number of them, where either holds: sums for zones whose edges are spread over several rows."""
    for p, z, odd, touch in met_pairs(x, y, box, edges):
        yield p, z, touch, odd


def codes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """A number for each row, equal where all ``keys`` are, from 0."""
    out = np.zeros(len(table), np.int64)
    for key in keys:
        column = table.column(key).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        values = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.unique(out * (values.max(initial=0) + 1) + values, return_inverse=True)[1].reshape(-1)
    return out


def by_key(blocks, point, zone):
    """Blocks of pairs of zones in the order of their code ``zone``, each pair of codes once: the numbers of a point and
    a zone that have them, whether any of them touches and whether the odd ones are odd in number."""
    n, held = int(point.max(initial=-1)) + 1, None
    for block in blocks:
        if held is not None:
            block = tuple(np.concatenate(c) for c in zip(held, block, strict=True))
        last = zone[block[1]] == zone[block[1][-1]]  # the next block may go on with it
        held = tuple(c[last] for c in block)
        yield _summed(*(c[~last] for c in block), point, zone, n)
    if held is not None:
        yield _summed(*held, point, zone, n)


def _summed(p, z, touch, odd, point, zone, n: int):
    code = zone[z] * n + point[p]
    order = np.argsort(code, kind="stable")
    fresh = np.ones(len(code), bool)
    fresh[1:] = code[order][1:] != code[order][:-1]
    first = np.flatnonzero(fresh)
    if not len(first):
        return p, z, touch, odd
    return p[order[first]], z[order[first]], np.logical_or.reduceat(touch[order], first), np.add.reduceat(odd[order].astype(np.int64), first) % 2 == 1


def file_edges(column, box, size: float):
    """Lines of edges filed under the cells whose points they matter to: ``row, ci, cj, Arrow lists of lines``.

    A line of ``LINE`` edges is filed whole under the cells of its box. To the points of the cells west of it, as
    far as the zone's box goes, only the heights of its two ends matter, so one upright edge stands for it there.
    """
    xy, point_at, ring_at, _ = ring_arrays(column)
    ring_row = np.repeat(np.arange(len(ring_at) - 1), np.diff(ring_at))
    edges = np.maximum(np.diff(point_at) - 1, 0)
    lines = -(-edges // LINE)
    of = np.repeat(np.arange(len(edges)), lines)
    nth = _spans(np.zeros(len(lines), np.int64), lines)
    start = point_at[of] + nth * LINE
    n = np.minimum(edges[of] - nth * LINE, LINE) + 1
    row = ring_row[of]
    if not len(n):
        return
    place = _spans(start, n)
    first = np.cumsum(n) - n
    low, high = np.minimum.reduceat(xy[place], first), np.maximum.reduceat(xy[place], first)
    cell = lambda v: np.floor(v / size)
    with np.errstate(invalid="ignore"):
        west, east = cell(box[0][row]), np.minimum(cell(high[:, 0]), cell(box[2][row]))
        south, north = cell(low[:, 1]), cell(high[:, 1])
        wide, tall = np.maximum(east - west + 1, 0), north - south + 1
        cells = np.nan_to_num(wide * tall).astype(np.int64)
    # rows of one zone stay together, so that the lines of a cell are few rows
    per_row = np.bincount(row, cells * 2 + n, minlength=len(ring_at) - 1)
    line_at = np.searchsorted(row, np.arange(len(ring_at)))
    for a, b in _blocks(per_row, BLOCK):
        at = np.arange(line_at[a], line_at[b])
        line = np.repeat(at, cells[at])
        k = _spans(np.zeros(len(at), np.int64), cells[at])
        ci, cj = (west[line] + k // tall[line]).astype(np.int64), (south[line] + k % tall[line]).astype(np.int64)
        sort = np.lexsort((line, cj, ci, row[line]))
        line, ci, cj = line[sort], ci[sort], cj[sort]
        if not len(line):
            continue
        far = low[line, 0] > (ci + 1) * size
        m = np.where(far, 2, n[line])
        ends = np.concatenate([[0], np.cumsum(m)])
        points = xy[_spans(start[line], m)]
        # the upright edge: at the west end of the line, between the heights of its ends
        points[ends[:-1][far], 0] = points[ends[:-1][far] + 1, 0] = low[line[far], 0]
        points[ends[:-1][far] + 1, 1] = xy[start[line[far]] + n[line[far]] - 1, 1]
        # a row begins with its zone and cell, and again after so many points
        same = (np.diff(row[line]) == 0) & (np.diff(ci) == 0) & (np.diff(cj) == 0) & (np.diff(ends[:-1] // FILED_POINTS) == 0)
        heads = np.concatenate([[0], np.flatnonzero(~same) + 1])
        lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(line)).astype(np.int32)), ring_list(points, m))
        yield row[line[heads]], ci[heads], cj[heads], lists


def paired(left: pa.Table, right: pa.Table, i, j, schema: pa.Schema, more=()) -> Iterator[pa.RecordBatch]:
    """Rows ``i`` of one table beside rows ``j`` of the other, in batches; a column is taken from the first that has it.
    ``more`` holds a flag a pair for each of the last fields. The tables are of one chunk."""
    for begin in range(0, len(i), ROWS_OUT):
        a, b = pa.array(i[begin : begin + ROWS_OUT]), pa.array(j[begin : begin + ROWS_OUT])
        columns = [
            (left.column(n).take(a) if n in left.column_names else right.column(n).take(b)).combine_chunks()
            for n in schema.names[: len(schema) - len(more)]
        ]
        columns += [pa.array(flag[begin : begin + ROWS_OUT]) for flag in more]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)


def to_bytes(table: pa.Table) -> bytes:
    """A table as one value of a column."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def from_bytes(value) -> pa.Table:
    """The table again, of one chunk."""
    return pa.ipc.open_stream(value).read_all().combine_chunks()
