"""The cutting kernel keeps area, cap, direction and coverage."""

import time

import numpy as np
import pytest

from zoneloom.operators import clip


def blob(n, seed, radius=100.0, noise=8.0):
    """A flower: even steps round the middle, with waves of a random phase."""
    phase = np.random.default_rng(seed).uniform(0, 6, 3)
    turn = np.linspace(0, 2 * np.pi, n, endpoint=False)
    away = radius + noise * sum(np.sin(k * turn + p) for k, p in zip((5, 11, 23), phase, strict=True)) / 2
    ring = np.column_stack([away * np.cos(turn), away * np.sin(turn)])
    return np.concatenate([ring, ring[:1]])


def area(parts):
    return sum(clip.signed_area(r) for p in parts for r in p)


@pytest.mark.parametrize("n,seed", [(300, 1), (3000, 2), (2000, 3)])
def test_pieces_cover_the_polygon(n, seed):
    part = [blob(n, seed), blob(200, seed + 9, 20, 1)[::-1]]
    pieces = [p for p, _ in clip.split_down(part, 100, 0, 40)]
    assert max(map(clip.part_size, pieces)) <= 100
    assert area(pieces) == pytest.approx(area([part]), rel=1e-9)
    assert all(clip.signed_area(p[0]) > 0 for p in pieces)
    assert all(clip.signed_area(h) < 0 for p in pieces for h in p[1:])
    pts = np.random.default_rng(0).uniform(-120, 120, (500, 2))
    inside = clip.points_inside(part[0], pts) ^ clip.points_inside(part[1], pts)
    hits = np.zeros(len(pts), int)
    for p in pieces:
        got = np.zeros(len(pts), bool)
        for ring in p:
            got ^= clip.points_inside(ring, pts)
        hits += got
    assert (hits == inside).all()


def test_small_polygon_is_untouched():
    ring = blob(20, 4)
    (piece, depth), = clip.split_down([ring], 100, 0, 40)
    assert depth == 0 and piece[0] is ring


def test_edges_on_the_cut_line():
    """A plus sign whose arms have edges at the middle of its box."""
    steps = [(3, 0), (0, 3), (3, 0), (0, 3), (-3, 0), (0, 3), (-3, 0), (0, -3), (-3, 0), (0, -3), (3, 0), (0, -3)]
    at, ring = np.array([3.0, 0.0]), []
    for step in steps:
        for k in range(90):
            ring.append(at + np.array(step) * k / 90)
        at = at + step
    ring = np.array([*ring, ring[0]])
    pieces = [p for p, _ in clip.split_down([ring], 100, 0, 40)]
    assert len(pieces) > 1
    assert area(pieces) == pytest.approx(45.0, abs=1e-9)


def test_lattice_shapes_cut_through_their_vertices():
    for seed in range(60):
        rng = np.random.default_rng(seed)
        n = rng.integers(5, 40)
        angle = np.sort(rng.uniform(0, 2 * np.pi, n))
        r = rng.integers(3, 12, n)
        p = np.round(np.c_[r * np.cos(angle), r * np.sin(angle)])
        ring = np.vstack([p, p[:1]])
        if clip.signed_area(ring) <= 0:
            continue
        for axis in (0, 1):
            for at in range(-6, 7, 2):
                low, high = clip.cut([ring], axis, at)
                assert area(low) + area(high) == pytest.approx(clip.signed_area(ring), abs=1e-9)


def test_rings_in_any_order_become_parts():
    outer, hole, island = blob(30, 1), blob(20, 2, 30, 1), blob(10, 3, 5, 0.1)
    far = blob(10, 5, 5, 0.1) + 500
    parts = clip.to_parts([hole, far[::-1], island, outer[::-1]])
    assert sorted(len(p) for p in parts) == [1, 1, 2]
    assert all(clip.signed_area(p[0]) > 0 for p in parts)


def test_box_clip():
    square = np.array([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], float)
    (piece,) = clip.clip_to_box([square], 2, 3, 6, 20)
    assert clip.signed_area(piece[0]) == 28


def test_many_holes_find_their_shell_quickly():
    side = 100
    shell = clip.oriented(np.array([(0, 0), (2, 0), (2, 1), (0, 1), (0, 0)], float) * side, True)
    holes = [
        np.array([(x, y), (x + 0.5, y), (x, y + 0.5), (x, y)]) + 0.25
        for x in range(2 * side) for y in range(side // 4)
    ]
    started = time.perf_counter()
    (part,) = clip.to_parts([*holes, shell])
    assert len(part) == len(holes) + 1 and clip.signed_area(part[0]) == 2 * side * side
    assert sum(map(clip.signed_area, part)) == pytest.approx(2 * side * side - 0.125 * len(holes))
    assert time.perf_counter() - started < 30
