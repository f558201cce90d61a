"""The cuts of ``clip`` for many polygons of one ring at once, in the same arithmetic.

Rings are open (the closing point left out) and lie end to end in one (n, 2) array, with their lengths beside
it. All of them are cut once per level; a polygon with holes is cut by ``clip`` itself.
"""

from __future__ import annotations

import numpy as np

from zoneloom.operators import clip


def starts(n):
    """Where each of runs of the given lengths begins."""
    return np.cumsum(n) - n


def ranges(first, n):
    """``first[i], first[i] + 1, ..`` for ``n[i]`` places each, end to end."""
    return np.repeat(first - starts(n), n) + np.arange(n.sum())


def _neighbours(n):
    """For every point the places of the ones before and after it in its ring."""
    at = np.arange(n.sum())
    first = starts(n)
    before, after = at - 1, at + 1
    some = n > 0
    before[first[some]], after[(first + n - 1)[some]] = (first + n - 1)[some], first[some]
    return before, after


def areas(p, n):
    """Signed area of each ring; one too near to 0 for its sign to be sure is taken from ``clip``."""
    if not len(n):
        return np.zeros(0)
    first = starts(n)
    d = p - np.repeat(p[first], n, axis=0)
    _, after = _neighbours(n)
    a, b = d[:, 0] * d[after, 1], d[after, 0] * d[:, 1]
    out = np.add.reduceat(a - b, first) / 2
    unsure = np.abs(out) <= 1e-9 * np.add.reduceat(np.abs(a) + np.abs(b), first)
    for i in np.flatnonzero(unsure):
        ring = p[first[i] : first[i] + n[i]]
        out[i] = clip.signed_area(np.vstack([ring, ring[:1]]))
    return out


def tidy(p, n, axis=None, at=None):
    """``clip._tidy`` of every ring: the places in ``p`` that stay, and the new lengths; 0 for a ring without area."""
    n = n.copy()
    left = np.arange(len(p))
    first = starts(n)
    some = np.flatnonzero(n > 1)
    closed = some[(p[first[some]] == p[first[some] + n[some] - 1]).all(axis=1)]
    if len(closed):
        stays = np.ones(len(p), bool)
        stays[first[closed] + n[closed] - 1] = False
        left = left[stays]
        n[closed] -= 1
    stays = np.zeros(len(p), bool)
    active = np.flatnonzero(n > 2)
    idx = left[np.repeat(n > 2, n)]
    while len(active):
        m = n[active]
        before, after = _neighbours(m)
        q, first = p[idx], starts(m)
        keep = (q != q[before]).any(axis=1)
        if axis is not None:
            distinct = np.logical_and.reduceat(keep, first)
            on = np.where(np.repeat(axis[active], m) == 0, q[:, 0], q[:, 1]) == np.repeat(at[active], m)
            keep = np.where(np.repeat(distinct, m), ~(on & on[before] & on[after]), keep)
        settled = np.logical_and.reduceat(keep, first)
        stays[idx[np.repeat(settled, m)]] = True
        n[active] = np.add.reduceat(keep.astype(np.int64), first)
        again = ~settled & (n[active] > 2)
        idx = idx[keep & np.repeat(again, m)]
        active = active[again]
    n[n < 3] = 0
    # rings that fell to two points while they were thinned were never marked
    flat = np.zeros(len(n), bool)
    flat[n > 0] = areas(p[stays], n[n > 0]) == 0
    places = np.flatnonzero(stays)
    places = places[~np.repeat(flat, n)]
    n[flat] = 0
    return places, n


def oriented(p, n):
    """Every ring counter-clockwise; it keeps its first point."""
    turn = ~(areas(p, n) > 0)
    if not turn.any():
        return p
    place = np.arange(len(p)) - np.repeat(starts(n), n)
    back = np.where(place == 0, 0, np.repeat(n, n) - place)
    return p[np.repeat(starts(n), n) + np.where(np.repeat(turn, n), back, place)]


def _cut(p, n):
    """Every ring cut across the longer side of its box, at the middle: ``points, lengths, ring it came from``, for
    each ring the low ones first. A ring that its line does not cross comes back whole."""
    first = starts(n)
    of = np.repeat(np.arange(len(n)), n)
    lo, hi = np.minimum.reduceat(p, first), np.maximum.reduceat(p, first)
    wide = hi - lo
    axis = np.where(wide[:, 0] >= wide[:, 1], 0, 1)
    rows = np.arange(len(n))
    at = (lo[rows, axis] + hi[rows, axis]) / 2
    across = axis[of] == 0
    c, other = np.where(across, p[:, 0], p[:, 1]), np.where(across, p[:, 1], p[:, 0])
    high = c >= at[of]
    _, after = _neighbours(n)
    crossing = np.flatnonzero(high != high[after])
    ring, to = of[crossing], after[crossing]
    line = at[ring]
    ca, cb, oa, ob = c[crossing], c[to], other[crossing], other[to]
    t = (line - ca) / (cb - ca)
    w = oa + t * (ob - oa)
    w = np.where(cb == line, ob, np.where(ca == line, oa, w))
    upward = high[to]
    x_cut = axis[ring] == 0
    opens = np.where(x_cut, upward, ~upward)
    open_ids, close_ids = np.flatnonzero(opens), np.flatnonzero(~opens)
    open_ids = open_ids[np.lexsort((w[open_ids], ring[open_ids]))]
    close_ids = close_ids[np.lexsort((w[close_ids], ring[close_ids]))]
    partner = np.empty(len(w), np.int64)
    partner[open_ids], partner[close_ids] = close_ids, open_ids
    count = np.bincount(ring, minlength=len(n))
    _, follows = _neighbours(count)
    # a chain runs from its crossing to the next one of the ring, and goes on from the partner of that
    goes_on = partner[follows].tolist()
    used, order, rings_at = bytearray(len(goes_on)), [], []
    for begin in range(len(goes_on)):
        if used[begin]:
            continue
        rings_at.append(len(order))
        k = begin
        while not used[k]:
            used[k] = 1
            order.append(k)
            k = goes_on[k]
    order, rings_at = np.array(order, np.int64), np.array(rings_at, np.int64)
    run = crossing[follows] - crossing
    run += np.where(run <= 0, n[ring], 0)
    points = np.empty((len(w), 2))
    points[:, 0], points[:, 1] = np.where(x_cut, line, w), np.where(x_cut, w, line)
    # per chain: its crossing, the vertices up to the next one, that crossing
    length = (run + 2)[order]
    chain = np.repeat(order, length)
    step = np.arange(length.sum()) - np.repeat(starts(length), length)
    vertex = crossing[chain] + step
    vertex -= np.where(vertex >= (first + n)[ring[chain]], n[ring[chain]], 0)
    src = np.where(step == 0, len(p) + chain, np.where(step == run[chain] + 1, len(p) + follows[chain], vertex))
    q = np.concatenate([p, points])[src]
    if len(rings_at):
        m = np.add.reduceat(length, rings_at)
    else:
        m = np.zeros(0, np.int64)
    begun = order[rings_at]
    parent, side = ring[begun], upward[begun]
    places, m = tidy(q, m, axis[parent], at[parent])
    q = q[places]
    whole = np.flatnonzero(count == 0)
    q = np.concatenate([q, p[np.isin(of, whole)]]) if len(whole) else q
    m, parent = np.concatenate([m, n[whole]]), np.concatenate([parent, whole])
    side = np.concatenate([side, np.zeros(len(whole), bool)])
    sort = np.lexsort((side, parent))
    sort = sort[m[sort] > 0]
    return q[ranges(starts(m)[sort], m[sort])], m[sort], parent[sort]


def split_many(p, n, depth, cap, max_depth, levels=None):
    """``clip.split_down`` of many rings: ``points, lengths, ring it came from, depth`` of the pieces in cutting order."""
    of, depth, pos = np.arange(len(n)), np.asarray(depth, np.int64), np.arange(len(n))
    total, level, done = len(n), 0, []
    while True:
        ends = (n + 1 <= cap) | (depth >= max_depth)
        if levels is not None and level >= levels:
            ends[:] = True
        if ends.any():
            done.append([p[np.repeat(ends, n)], n[ends], of[ends], depth[ends], pos[ends]])
            p, n, of, depth, pos = p[np.repeat(~ends, n)], n[~ends], of[~ends], depth[~ends], pos[~ends]
        if not len(n):
            break
        q, m, parent = _cut(p, n)
        children = np.bincount(parent, minlength=len(n))
        room = np.ones(total, np.int64)
        room[pos] = children
        moved = starts(room)
        for d in done:
            d[4] = moved[d[4]]
        nth = np.arange(len(m)) - np.repeat(starts(children), children)
        p, n, of, depth, pos = q, m, of[parent], depth[parent] + 1, moved[pos[parent]] + nth
        total, level = int(room.sum()), level + 1
    if not done:
        return p, n, of, depth
    p, n, of, depth, pos = (np.concatenate(c) for c in zip(*done, strict=True))
    sort = np.argsort(pos, kind="stable")
    return p[ranges(starts(n)[sort], n[sort])], n[sort], of[sort], depth[sort]
