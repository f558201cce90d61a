"""Half-plane cutting of polygons, the numpy kernel that Arrow tasks call.

A part is a list of closed (n, 2) rings: a counter-clockwise shell, then clockwise holes.
"""

from __future__ import annotations

import numpy as np


def signed_area(ring):
    """Shoelace, measured from the first point to keep the terms small."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return 0.5 * float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1]))


def points_inside(ring, pts):
    """Even-odd test of each point against one closed ring."""
    x1, y1, x2, y2 = ring[:-1, 0], ring[:-1, 1], ring[1:, 0], ring[1:, 1]
    out = np.zeros(len(pts), dtype=bool)
    for n, (px, py) in enumerate(pts):
        straddle = (y1 > py) != (y2 > py)
        side = (x2[straddle] - x1[straddle]) * (py - y1[straddle]) - (px - x1[straddle]) * (
            y2[straddle] - y1[straddle]
        )
        out[n] = np.count_nonzero((side > 0) == (y2[straddle] > y1[straddle])) % 2 == 1
    return out


def ring_in_ring(inner, outer):
    """Whether a ring that does not cross ``outer`` lies in it, by vote of a few edge middles."""
    if (inner.min(0) < outer.min(0)).any() or (inner.max(0) > outer.max(0)).any():
        return False
    step = max(1, (len(inner) - 1) // 5)
    middles = (inner[:-1:step][:5] + inner[1::step][:5]) / 2
    return np.count_nonzero(points_inside(outer, middles)) * 2 > len(middles)


def _tidy(ring, axis=None, at=None):
    """Drop repeated points and, on the cut line, everything between the ends of a run."""
    p = ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring
    while len(p) > 2:
        keep = (p != np.roll(p, 1, axis=0)).any(axis=1)
        if keep.all() and axis is not None:
            on = p[:, axis] == at
            keep = ~(on & np.roll(on, 1) & np.roll(on, -1))
        if keep.all():
            break
        p = p[keep]
    if len(p) < 3:
        return None
    closed = np.vstack([p, p[:1]])
    return closed if signed_area(closed) != 0 else None


def oriented(ring, ccw):
    """The ring in the wanted direction."""
    return ring if (signed_area(ring) > 0) == ccw else ring[::-1]


def _box_holders(rings):
    """For a ring, the numbers of those of ``rings`` whose box holds its box, all compared at once."""
    if not rings:
        return lambda ring: []
    lows = np.array([r.min(0) for r in rings])
    highs = np.array([r.max(0) for r in rings])

    def holders(ring):
        inside = (lows <= ring.min(0)).all(1) & (highs >= ring.max(0)).all(1)
        return np.flatnonzero(inside).tolist()

    return holders


def to_parts(rings):
    """Even-odd rings in any order or direction, grouped into parts."""
    rings = [t for t in map(_tidy, rings) if t is not None]
    if len(rings) == 1:
        return [[oriented(rings[0], True)]]
    holders = _box_holders(rings)
    around = [
        [j for j in holders(r) if j != i and ring_in_ring(r, rings[j])]
        for i, r in enumerate(rings)
    ]
    parts = {
        i: [oriented(r, True)] for i, r in enumerate(rings) if len(around[i]) % 2 == 0
    }
    for i, r in enumerate(rings):
        if i in parts:
            continue
        # the shell one level up
        up = len(around[i]) - 1
        owner = next((j for j in around[i] if j in parts and len(around[j]) == up), None)
        if owner is None:
            raise ValueError("a hole lies in no shell: rings cross, repair the zone first")
        parts[owner].append(oriented(r, False))
    return list(parts.values())


def _assign(shells, holes):
    if len(shells) == 1:
        return [[shells[0], *holes]]
    parts = [[s] for s in shells]
    holders = _box_holders(shells)
    for h in holes:
        owner = next((parts[j] for j in holders(h) if ring_in_ring(h, shells[j])), None)
        if owner is None:
            raise ValueError("a hole lies in no shell: rings cross, repair the zone first")
        owner.append(h)
    return parts


def cut(part, axis, at):
    """Both sides of the line ``coordinate[axis] = at``, as ``(low parts, high parts)``."""
    other = 1 - axis
    whole = {False: [], True: []}
    points, values, upward, chains = [], [], [], []
    for ring in part:
        p = ring[:-1]
        high = p[:, axis] >= at
        crossing = np.flatnonzero(high != np.roll(high, -1))
        if len(crossing) == 0:
            whole[bool(high[0])].append(ring)
            continue
        a, b = p[crossing], p[(crossing + 1) % len(p)]
        t = (at - a[:, axis]) / (b[:, axis] - a[:, axis])
        w = a[:, other] + t * (b[:, other] - a[:, other])
        w = np.where(b[:, axis] == at, b[:, other], np.where(a[:, axis] == at, a[:, other], w))
        first = len(values)
        values.extend(w)
        upward.extend(high[(crossing + 1) % len(p)])
        # the run of vertices after each crossing, up to the next one
        n = len(crossing)
        for k in range(n):
            lo, hi = crossing[k] + 1, crossing[(k + 1) % n] + 1
            run = p[lo:hi] if lo < hi else np.vstack([p[lo:], p[:hi]])
            chains.append((first + k, first + (k + 1) % n, run))
    if not values:
        return _whole_sides(part, whole)
    w = np.array(values)
    points = np.empty((len(w), 2))
    points[:, axis], points[:, other] = at, w
    upward = np.array(upward)
    # the interior lies left of travel, so crossings open and close intervals by direction;
    # sorting the two kinds apart keeps touching points on the line in step
    opens, closes = (upward, ~upward) if axis == 0 else (~upward, upward)
    open_ids, close_ids = np.flatnonzero(opens), np.flatnonzero(closes)
    open_ids = open_ids[np.argsort(w[open_ids], kind="stable")]
    close_ids = close_ids[np.argsort(w[close_ids], kind="stable")]
    partner = np.empty(len(w), dtype=np.int64)
    partner[open_ids], partner[close_ids] = close_ids, open_ids
    begins = {c[0]: c for c in chains}
    sides = {False: [], True: []}
    used = set()
    for start, _, _ in chains:
        if start in used:
            continue
        ring, at_id = [], start
        while at_id not in used:
            used.add(at_id)
            first, last, run = begins[at_id]
            ring += [points[first : first + 1], run, points[last : last + 1]]
            at_id = int(partner[last])
        tidy = _tidy(np.vstack(ring), axis, at)
        if tidy is not None:
            sides[bool(upward[start])].append(tidy)
    out = []
    for side in (False, True):
        shells = sides[side]
        out.append(_assign(shells, whole[side]) if shells else [])
    return out[0], out[1]


def _whole_sides(part, whole):
    on_high = bool(whole[True]) and whole[True][0] is part[0]
    return ([], [part]) if on_high else ([part], [])


def part_size(part):
    """Coordinates of a part."""
    return sum(len(r) for r in part)


def bisect(part):
    """Cut across the longer side of the part's own box, at the middle."""
    lo, hi = part[0].min(0), part[0].max(0)
    axis = 0 if hi[0] - lo[0] >= hi[1] - lo[1] else 1
    return cut(part, axis, (lo[axis] + hi[axis]) / 2)


def clip_to_box(part, xmin, ymin, xmax, ymax):
    """What the box holds of a part."""
    parts = [part]
    for axis, at, high in ((0, xmin, True), (0, xmax, False), (1, ymin, True), (1, ymax, False)):
        parts = [q for p in parts for q in cut(p, axis, at)[high]]
    return parts


def split_down(part, cap, depth, max_depth, levels=None):
    """Pieces of at most ``cap`` coordinates, low half first, with their depth.

    ``levels`` stops after that many cuts, for parts too large for one task.
    """
    todo, out = [(part, depth, 0)], []
    while todo:
        p, d, level = todo.pop()
        if part_size(p) <= cap or d >= max_depth or (levels is not None and level >= levels):
            out.append((p, d))
            continue
        low, high = bisect(p)
        todo += [(q, d + 1, level + 1) for q in reversed(low + high)]
    return out
