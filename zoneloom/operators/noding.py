"""Where the edges of one geometry meet, and even-odd faces of edges that cross: numpy kernels of Arrow tasks.

Edges are an (n, 4) array of x1, y1, x2, y2. Pairs are looked for in cells that halve until they hold few
edges; a cell is cut across an axis, a diagonal or the direction that most of its edges run in, wherever that
leaves fewest pairs, and an edge counts with the stretch of it that lies in the cell. Long parallel edges, crowded
corners and fans therefore all fall apart, and the pairs tested grow with the edges and not with their square.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from zoneloom.operators import clip

LEAF = 48  # edges of a cell that are compared pair by pair
DEPTH = 64
ROUNDS = 8  # of splitting, after which a geometry counts as beyond repair
BLOCK = 1 << 20  # pairs compared at once
SMALL = 16  # edges up to which geometries are noded together
PLACES = 16  # where a cut is tried along each direction: between the ends of so many shares of the edges
LESS_WORK = 0.85  # a cut has to save some of the pairs


@lru_cache(maxsize=64)
def _triangle(n: int):
    return np.triu_indices(n, 1)


def edges_of(rings) -> np.ndarray:
    """All edges of closed rings."""
    parts = [np.hstack([r[:-1], r[1:]]) for r in rings if len(r) > 1]
    return np.concatenate(parts) if parts else np.empty((0, 4))


def _cut(e, ids, t0, t1, slack):
    """Both sides of the best cut of a cell, or None."""
    a = e[ids, :2] + (e[ids, 2:] - e[ids, :2]) * t0[:, None]
    b = e[ids, :2] + (e[ids, 2:] - e[ids, :2]) * t1[:, None]
    way = b - a
    # the mean of doubled angles is the direction most of the length runs in
    length = np.hypot(way[:, 0], way[:, 1])
    twice = 2 * np.arctan2(way[:, 1], way[:, 0])
    along = np.arctan2((length * np.sin(twice)).sum(), (length * np.cos(twice)).sum()) / 2
    n, best = len(ids), None
    steps = np.arange(1, PLACES) * n // PLACES
    for nx, ny in ((1.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, -1.0), (-np.sin(along), np.cos(along))):
        p, q = a[:, 0] * nx + a[:, 1] * ny, b[:, 0] * nx + b[:, 1] * ny
        low, high = np.minimum(p, q), np.maximum(p, q)
        lows, highs = np.sort(low), np.sort(high)
        places = np.concatenate([lows[steps], highs[steps]])
        n_low = np.searchsorted(lows, places + slack, "right").astype(float)
        n_high = n - np.searchsorted(highs, places - slack, "left").astype(float)
        work = n_low * n_low + n_high * n_high
        k = int(work.argmin())
        if best is None or work[k] < best[0]:
            best = work[k], p, q, places[k], low <= places[k] + slack, high >= places[k] - slack
    if best[0] > LESS_WORK * n * n:
        best = None
    if best is None:
        return None
    _, p, q, at, low, high = best
    sides = []
    for keep, limit, sign in ((low, at + slack, 1.0), (high, at - slack, -1.0)):
        u, v, s, t = sign * p[keep], sign * q[keep], t0[keep].copy(), t1[keep].copy()
        edge = sign * limit
        with np.errstate(divide="ignore", invalid="ignore"):
            meet = s + (edge - u) / (v - u) * (t - s)
        s, t = np.where(u > edge, meet, s), np.where(v > edge, meet, t)
        sides.append((ids[keep], s, t))
    return sides


def cells(e: np.ndarray):
    """Sets of edge numbers so that every two edges that meet are together in one of them."""
    if not len(e):
        return
    slack = 1e-12 * max(1.0, float(np.abs(e).max()))
    todo = [(np.arange(len(e)), np.zeros(len(e)), np.ones(len(e)), 0)]
    while todo:
        ids, t0, t1, depth = todo.pop()
        sides = _cut(e, ids, t0, t1, slack) if len(ids) > LEAF and depth < DEPTH else None
        if sides is None:
            yield ids
        else:
            todo += [(*side, depth + 1) for side in sides]


def close_pairs(e: np.ndarray):
    """Pairs (i, j) of edges whose boxes meet, in bounded blocks; a pair can come up more than once."""
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    held, size = [], 0

    def near(i, j):
        keep = ((low[i] <= high[j]) & (low[j] <= high[i])).all(axis=1)
        return i[keep], j[keep]

    for ids in cells(e):
        rows = max(1, BLOCK // len(ids))
        for lo in range(0, len(ids), rows):
            a, b = _triangle(len(ids)) if rows >= len(ids) else np.nonzero(
                np.arange(lo, min(lo + rows, len(ids)))[:, None] < np.arange(len(ids))[None, :])
            held.append((ids[a + lo], ids[b]))
            size += len(a)
            if size >= BLOCK:
                yield near(*map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
    if held:
        yield near(*map(np.concatenate, zip(*held, strict=True)))


def _side(e, p):
    """Sign tells on which side of each edge its point lies."""
    return (e[:, 2] - e[:, 0]) * (p[:, 1] - e[:, 1]) - (p[:, 0] - e[:, 0]) * (e[:, 3] - e[:, 1])


def _sides(e, i, j):
    s, t = e[i], e[j]
    return _side(s, t[:, :2]), _side(s, t[:, 2:]), _side(t, s[:, :2]), _side(t, s[:, 2:])


def _apart(a, b):
    return ((a > 0) & (b < 0)) | ((a < 0) & (b > 0))


def has_crossing(e: np.ndarray) -> bool:
    """Whether two edges properly cross."""
    for i, j in close_pairs(e):
        a, b, c, d = _sides(e, i, j)
        if (_apart(a, b) & _apart(c, d)).any():
            return True
    return False


def _split_points(e: np.ndarray, pairs):
    """(edge, point) wherever an edge has to be split: at crossings, and at ends that lie on it."""
    where, points = [], []
    for i, j in pairs:
        a, b, c, d = _sides(e, i, j)
        cross = _apart(a, b) & _apart(c, d)
        if cross.any():
            s = e[i[cross]]
            part = (c[cross] / (c[cross] - d[cross]))[:, None]
            p = s[:, :2] + part * (s[:, 2:] - s[:, :2])
            where += [i[cross], j[cross]]
            points += [p, p]
        for side, on, end in ((a, i, e[j, :2]), (b, i, e[j, 2:]), (c, j, e[i, :2]), (d, j, e[i, 2:])):
            own = e[on]
            low, high = np.minimum(own[:, :2], own[:, 2:]), np.maximum(own[:, :2], own[:, 2:])
            hit = (side == 0) & (low <= end).all(axis=1) & (end <= high).all(axis=1)
            hit &= (end != own[:, :2]).any(axis=1) & (end != own[:, 2:]).any(axis=1)
            where.append(on[hit])
            points.append(end[hit])
    if not where:
        return np.zeros(0, np.int64), np.zeros((0, 2))
    return np.concatenate(where), np.concatenate(points)


def _odd(e: np.ndarray) -> np.ndarray:
    """Edges that occur an odd number of times, whatever their direction; those without length go."""
    e = e[(e[:, :2] != e[:, 2:]).any(axis=1)]
    turn = (e[:, 0] > e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3]))
    e = np.where(turn[:, None], e[:, [2, 3, 0, 1]], e)
    if not len(e):
        return e
    own, count = np.unique(e, axis=0, return_counts=True)
    return own[count % 2 == 1]


def _split(e: np.ndarray, where, points):
    """The stretches of all edges between the points given for them, and the edge each comes from."""
    own = np.concatenate([np.arange(len(e)), np.arange(len(e)), where])
    xy = np.concatenate([e[:, :2], e[:, 2:], points])
    way = e[own, 2:] - e[own, :2]
    far = ((xy - e[own, :2]) * way).sum(axis=1) / (way * way).sum(axis=1)
    far[len(e) : 2 * len(e)] = np.inf  # the end stays last, whatever rounding says
    far[: len(e)] = -np.inf
    order = np.lexsort((far, own))
    own, xy = own[order], xy[order]
    follows = own[1:] == own[:-1]
    return np.hstack([xy[:-1], xy[1:]])[follows], own[:-1][follows]


def noded(e: np.ndarray) -> np.ndarray | None:
    """The boundary of the even-odd set as edges that meet at their ends only; None if rounding keeps making crossings."""
    e = _odd(e)
    for _ in range(ROUNDS):
        where, points = _split_points(e, close_pairs(e))
        if not len(where):
            return e
        e = _odd(_split(e, where, points)[0])
    return None


def edges_by_row(xy, point_at, ring_at):
    """The edges of many geometries end to end, and the row of each."""
    opens = np.ones(len(xy), bool)
    opens[point_at[1:][np.diff(point_at) > 0] - 1] = False  # the last point of a ring opens none
    at = np.flatnonzero(opens)
    return np.hstack([xy[at], xy[at + 1]]), np.repeat(np.arange(len(ring_at) - 1), np.diff(point_at[ring_at]))[at]


def _row_pairs(e: np.ndarray, row):
    """``close_pairs`` of every row, without a look at cells: for rows of few edges. ``row`` rises."""
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    after = np.searchsorted(row, row, "right") - np.arange(len(e)) - 1
    ends, begin = np.cumsum(after), 0
    while begin < len(e):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
        n = after[begin:end]
        i = np.repeat(np.arange(begin, end), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        keep = ((low[i] <= high[j]) & (low[j] <= high[i])).all(axis=1)
        yield i[keep], j[keep]
        begin = end


def crossing_rows(e: np.ndarray, row, rows: int) -> np.ndarray:
    """``has_crossing`` of every row; rows of few edges are looked at together."""
    found = np.zeros(rows, bool)
    count = np.bincount(row, minlength=rows)
    few = count[row] <= LEAF
    own, at = e[few], row[few]
    for i, j in _row_pairs(own, at):
        a, b, c, d = _sides(own, i, j)
        found[at[i[_apart(a, b) & _apart(c, d)]]] = True
    for r in np.flatnonzero(count > LEAF).tolist():
        found[r] = has_crossing(e[np.searchsorted(row, r) : np.searchsorted(row, r, "right")])
    return found


def spiked_rows(xy, point_at, ring_at) -> np.ndarray:
    """Which rows have a ring that ``is_spiked``."""
    ring = np.repeat(np.arange(len(point_at) - 1), np.diff(point_at))
    row = np.repeat(np.arange(len(ring_at) - 1), np.diff(ring_at))
    found = np.zeros(len(ring_at) - 1, bool)
    for step in (1, 2):
        same = (xy[step:] == xy[:-step]).all(axis=1) & (ring[step:] == ring[:-step])
        found[row[ring[step:][same]]] = True
    return found


def _odd_rows(e: np.ndarray, row):
    """``_odd`` of every row."""
    some = (e[:, :2] != e[:, 2:]).any(axis=1)
    e, row = e[some], row[some]
    turn = (e[:, 0] > e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3]))
    e = np.where(turn[:, None], e[:, [2, 3, 0, 1]], e)
    order = np.lexsort((e[:, 3], e[:, 2], e[:, 1], e[:, 0], row))
    e, row = e[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (e[1:] != e[:-1]).any(axis=1) | (row[1:] != row[:-1])])[: len(e)])
    odd = first[np.diff(np.append(first, len(e))) % 2 == 1]
    return e[odd], row[odd]


def _noded_rows(e: np.ndarray, row):
    """``noded`` of every row, and the rows where rounding keeps making crossings."""
    e, row = _odd_rows(e, row)
    open_rows = row[:0]
    for _ in range(ROUNDS):
        where, points = _split_points(e, _row_pairs(e, row))
        open_rows = np.unique(row[where])
        if not len(where):
            break
        e, own = _split(e, where, points)
        e, row = _odd_rows(e, row[own])
    return e, row, open_rows


def _left_of(e: np.ndarray, x: float, y: float) -> bool:
    """Whether an odd number of edges passes a position on its left."""
    over = (e[:, 1] > y) != (e[:, 3] > y)
    s = e[over]
    at = s[:, 0] + (y - s[:, 1]) / (s[:, 3] - s[:, 1]) * (s[:, 2] - s[:, 0])
    return bool(np.count_nonzero(at < x) % 2)


def faces(e: np.ndarray) -> list[np.ndarray]:
    """Simple closed rings around the inside of noded edges, the inside on their left."""
    n = len(e)
    if not n:
        return []
    nodes, ends = np.unique(np.concatenate([e[:, :2], e[:, 2:]]), axis=0, return_inverse=True)
    ends = ends.ravel()
    tail, head = ends, np.concatenate([ends[n:], ends[:n]])  # half-edge k and its twin (k + n) % 2n
    way = nodes[head] - nodes[tail]
    order = np.lexsort((np.arctan2(way[:, 1], way[:, 0]), tail))
    first = np.searchsorted(tail[order], np.arange(len(nodes) + 1))
    place = np.empty(2 * n, np.int64)
    place[order] = np.arange(2 * n)
    start, stop = first[tail], first[tail + 1]
    before = order[np.where(place == start, stop - 1, place - 1)]  # clockwise neighbour
    # round a node the sectors take turns, and the two sides of an edge differ
    turn = ((place - start) % 2).astype(bool)
    twin = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
    base: list = [None] * len(nodes)  # whether the sector after a node's first half-edge is inside
    turns, twins, heads, sorted_at, firsts = turn.tolist(), twin.tolist(), head.tolist(), order.tolist(), first.tolist()
    for seed in range(len(nodes)):  # in ascending x, so a seed is the leftmost node of its component
        if base[seed] is not None:
            continue
        last = sorted_at[firsts[seed + 1] - 1]
        base[seed] = _left_of(e, *nodes[seed]) != turns[last]
        todo = [seed]
        while todo:
            v = todo.pop()
            for h in sorted_at[firsts[v] : firsts[v + 1]]:
                w = heads[h]
                if base[w] is None:
                    base[w] = (base[v] == turns[h]) != turns[twins[h]]
                    todo.append(w)
    inside = np.array(base, bool)[tail] != turn
    following = before[twin].tolist()
    tails, free = tail.tolist(), inside.tolist()
    rings = []
    for k in np.flatnonzero(inside).tolist():
        path, seen = [], {}
        while free[k]:
            free[k] = False
            v = tails[k]
            at = seen.get(v)
            if at is None:
                seen[v] = len(path)
                path.append(v)
            else:  # the walk touches itself here: what lies between is a ring of its own
                rings.append(nodes[[*path[at:], v]])
                for w in path[at + 1 :]:
                    del seen[w]
                del path[at + 1 :]
            k = following[k]
        if len(path) > 2:
            rings.append(nodes[[*path, path[0]]])
    return rings


def repaired(rings) -> list[np.ndarray] | None:
    """Rings that cross themselves or one another as the polygons of their even-odd set; None where that fails."""
    e = noded(edges_of(rings))
    out = None if e is None else _polygons(e)
    return None if out is None or has_crossing(edges_of(out)) else out


def _polygons(e: np.ndarray) -> list[np.ndarray] | None:
    """The rings of noded edges in canonical order; None where they do not nest."""
    try:
        return [ring for part in clip.to_parts(faces(e)) for ring in part]
    except ValueError:
        return None


def repaired_rows(geometries: list) -> list:
    """``repaired`` of every geometry; those of few edges are noded together."""
    out: list = [None] * len(geometries)
    edges = [edges_of(rings) for rings in geometries]
    few = [k for k, e in enumerate(edges) if len(e) <= SMALL]
    for k in sorted(set(range(len(edges))) - set(few)):
        out[k] = repaired(geometries[k])
    if not few:
        return out
    row = np.repeat(np.arange(len(few)), [len(edges[k]) for k in few])
    e, row, failed = _noded_rows(np.concatenate([edges[k] for k in few]), row)
    at = np.searchsorted(row, np.arange(len(few) + 1))
    for r in sorted(set(range(len(few))) - set(failed.tolist())):
        out[few[r]] = _polygons(e[at[r] : at[r + 1]])
    done = [k for k in few if out[k] is not None]
    made = [edges_of(out[k]) for k in done]
    if made:
        row = np.repeat(np.arange(len(made)), [len(m) for m in made])
        for r in np.flatnonzero(crossing_rows(np.concatenate(made), row, len(made))).tolist():
            out[done[r]] = None
    return out


def fold(ring: np.ndarray) -> np.ndarray:
    """The ring without repeated points and spikes, however deep they nest, in one pass over its points."""
    kept: list = []
    for p in map(tuple, ring.tolist()):
        if kept and kept[-1] == p:
            continue
        if len(kept) > 1 and kept[-2] == p:
            kept.pop()
            continue
        kept.append(p)
    return np.array(kept, float).reshape(-1, 2)


def is_spiked(ring: np.ndarray) -> bool:
    """Whether a point has the same neighbour on both sides, or repeats."""
    same = (ring[1:] == ring[:-1]).all(axis=1).any()
    return bool(same or (len(ring) > 2 and (ring[2:] == ring[:-2]).all(axis=1).any()))
