"""Crossings found in near-linear work, and even-odd faces of rings that cross."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from zoneloom.functions import rings as R
from zoneloom.operators import clip, noding
from zoneloom.operators import validity as Q


def closed(points):
    p = np.asarray(points, float)
    return np.vstack([p, p[:1]])


def turned(ring, angle):
    c, s = np.cos(angle), np.sin(angle)
    return ring @ np.array([[c, s], [-s, c]])


def comb(teeth, height=1000.0):
    """Long thin teeth side by side: about four edges each."""
    x = np.arange(teeth, dtype=float)
    up = np.stack([np.c_[x, np.zeros(teeth)], np.c_[x + 0.2, np.full(teeth, height)],
                   np.c_[x + 0.4, np.full(teeth, height)], np.c_[x + 0.6, np.zeros(teeth)]], axis=1).reshape(-1, 2)
    return closed([*up, (teeth, -5.0), (-1.0, -5.0)])


def crowded(n):
    """A wide triangle with nearly all of its points in one corner."""
    turn = np.linspace(0, np.pi / 2, n)
    return closed([*np.c_[1e-3 * np.cos(turn), 1e-3 * np.sin(turn)], (-1000.0, 1000.0), (-1000.0, -1000.0), (1000.0, -1000.0)])


def spikes(n):
    """A star with a far point between any two near ones."""
    turn = np.linspace(0, 2 * np.pi, 2 * n, endpoint=False)
    far = np.where(np.arange(2 * n) % 2 == 0, 1.0, 1000.0)
    return closed(np.c_[far * np.cos(turn), far * np.sin(turn)])


def pairs_compared(e):
    return sum(len(i) for i, _ in noding.close_pairs(e))


@pytest.mark.parametrize("name,ring", [
    ("comb", comb(25_000)), ("leaning comb", turned(comb(25_000), 0.4)), ("crowded", crowded(100_000)),
    ("crowded fan", spikes(50_000)),
])
def test_large_geometries_fall_apart(name, ring):
    e = noding.edges_of([ring])
    assert len(e) >= 100_000
    started = time.perf_counter()
    assert not noding.has_crossing(e)
    assert time.perf_counter() - started < 60
    held = sum(len(ids) for ids in noding.cells(e))
    assert held < 20 * len(e) and pairs_compared(e) < 400 * len(e)
    bad = np.vstack([e, [[*(e[5, :2] - (0.11, 0.31)), *(e[-5, 2:] + (0.17, 0.41))]]]) if name != "crowded" else np.vstack([e, [[-1e-4, 1e-4, 1, 1]]])
    assert noding.has_crossing(bad)


def test_cells_keep_every_meeting_pair():
    rng = np.random.default_rng(3)
    at = rng.uniform(0, 100, (700, 2))
    e = np.hstack([at, at + rng.normal(0, 8, (700, 2))])
    i, j = np.triu_indices(len(e), 1)
    a, b, c, d = noding._sides(e, i, j)
    cross = noding._apart(a, b) & noding._apart(c, d)
    found = {tuple(sorted(p)) for x, y in noding.close_pairs(e) for p in zip(x.tolist(), y.tolist(), strict=True)}
    assert {tuple(p) for p in np.c_[i, j][cross].tolist()} <= found


def even_odd(rings, pts):
    out = np.zeros(len(pts), bool)
    for r in rings:
        out ^= clip.points_inside(r, pts)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_faces_hold_the_even_odd_set(seed):
    rng = np.random.default_rng(seed)
    rings = [closed(rng.uniform(0, 100, (int(rng.integers(4, 14)), 2))) for _ in range(int(rng.integers(1, 4)))]
    if seed % 4 == 0:  # on a lattice: ends on edges, edges on edges, points met often
        rings = [np.round(r / 12) * 12 for r in rings]
    out = noding.repaired(rings)
    assert out is not None and not noding.has_crossing(noding.edges_of(out))
    pts = rng.uniform(0, 100, (600, 2))
    assert (even_odd(rings, pts) == even_odd(out, pts)).all()
    for ring in out:  # simple rings: no point twice
        assert len(np.unique(ring[:-1], axis=0)) == len(ring) - 1
    shells = sum(clip.signed_area(r) for r in out)
    assert shells >= 0 and sum(len(p) for p in clip.to_parts(out)) == len(out)


def test_known_shapes():
    bow = closed([(0, 0), (4, 4), (4, 0), (0, 2)])
    out = noding.repaired([bow])
    assert sorted(round(clip.signed_area(r), 9) for r in out) == [round(4 / 3, 9), round(16 / 3, 9)]
    square = closed([(0, 0), (8, 0), (8, 8), (0, 8)])
    across = closed([(2, 2), (10, 2), (10, 6), (2, 6)])
    assert sum(clip.signed_area(r) for r in noding.repaired([square, across])) == 64 + 32 - 2 * 24
    assert noding.repaired([square, square]) == []
    hole = closed([(0, 0), (4, 2), (2, 4)])  # touches the shell in one point
    out = noding.repaired([square, hole])
    assert len(out) == 2 and sum(clip.signed_area(r) for r in out) == 64 - 6


def test_deep_spikes_fold_in_linear_time():
    out = [(4.0 + i, 5.0 + i) for i in range(1, 100_001)]
    ring = np.array([(0.0, 0.0), (4.0, 0.0), *out, *out[-2::-1], (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)])
    started = time.perf_counter()
    folded = noding.fold(ring)
    assert time.perf_counter() - started < 5
    assert folded.tolist() == [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]


def test_crossing_rows_leave_quarantine(spark):
    shapes = {1: [[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 2.0), (0.0, 0.0)]],
              3: None, 4: []}
    df = spark.createDataFrame([("MA", "u", k, v) for k, v in shapes.items()],
                               f"state string, county string, zone_id bigint, rings {R.RINGS_TYPE}")
    assert [r.zone_id for r in Q.self_crossings(df, ["zone_id"]).collect()] == [1]
    good, bad = Q.repair_zones(df, ["zone_id"], keep=True)
    (r,) = good.select("zone_id", "repaired", F.size("rings").alias("n"), R.area(F.col("rings")).alias("area")).collect()
    assert (r.zone_id, r.repaired, r.n) == (1, True, 2) and r.area == pytest.approx(20 / 3)
    assert {r.zone_id: r.defect for r in bad.collect()} == {3: "null", 4: "empty"}


def test_repair_counts_come_from_the_job_that_stores_it(spark):
    bow = [(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 2.0), (0.0, 0.0)]
    box = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    zones = spark.createDataFrame([(1, [bow]), (2, [box]), (3, None), (4, [box[:2]])], f"zone_id int, rings {R.RINGS_TYPE}")
    counts = Observation("repair")
    good, bad = Q.repair_zones(zones, ["zone_id"], keep=True, counts=counts)
    assert counts.get == {"rows": 4, "repaired": 2, "failed": 2}
    assert (good.count(), bad.count()) == (2, 2)
    none = Observation("none")
    Q.repair_zones(zones.limit(0), ["zone_id"], keep=True, counts=none)
    assert none.get == {"rows": 0, "repaired": 0, "failed": 0}
    with pytest.raises(ValueError, match="keep"):
        Q.repair_zones(zones, ["zone_id"], counts=Observation("late"))


def odd_shapes(rng, n):
    """Small rings on a coarse grid: most cross, touch, repeat or fold back, some are large."""
    out = []
    for k in range(n):
        size = 30 if k % 40 == 0 else int(rng.integers(3, 8))
        out.append([closed(rng.integers(0, 6, (size, 2)).tolist()) for _ in range(int(rng.integers(0, 3)))])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_rows_noded_together_are_those_noded_alone(seed):
    shapes = odd_shapes(np.random.default_rng(seed), 400)
    alone = [noding.repaired(s) for s in shapes]
    for one, other in zip(alone, noding.repaired_rows(shapes), strict=True):
        assert (one is None) == (other is None)
        assert [r.tolist() for r in one or ()] == [r.tolist() for r in other or ()]
    rings = [r for s in shapes for r in s]
    point_at = np.concatenate([[0], np.cumsum([len(r) for r in rings])])
    ring_at = np.concatenate([[0], np.cumsum([len(s) for s in shapes])])
    e, row = noding.edges_by_row(np.concatenate(rings), point_at, ring_at)
    assert noding.crossing_rows(e, row, len(shapes)).tolist() == [noding.has_crossing(noding.edges_of(s)) for s in shapes]
    assert noding.spiked_rows(np.concatenate(rings), point_at, ring_at).tolist() == [
        any(noding.is_spiked(r) for r in s) for s in shapes]


def test_small_rows_are_not_looked_at_one_by_one(monkeypatch):
    """a million small zones are judged and noded by the batch."""
    bow, box = closed([(0, 0), (4, 4), (4, 0), (0, 2)]), closed([(0, 0), (4, 0), (4, 4), (0, 4)])
    spiked = closed([(0, 0), (4, 0), (9, 9), (4, 0), (4, 4), (0, 4)])
    shapes = [[[{"x": x, "y": y} for x, y in r.tolist()] for r in s] if s is not None else None
              for s in ([bow], [box], None, [], [spiked], [box, bow + 9])]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(6)), pa.array(shapes, pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))),
         pa.array([False] * 6), pa.array(["null"] * 6)], names=["k", "rings", "repaired", "defect"])
    monkeypatch.setattr(noding, "noded", None)
    monkeypatch.setattr(noding, "is_spiked", None)
    (out,) = Q._repair_kernel("rings")([batch])
    assert out.column("defect").to_pylist() == ["none", "none", "null", "empty", "none", "none"]
    assert out.column("repaired").to_pylist() == [True, False, False, False, True, True]
    assert [None if r is None else len(r) for r in out.column("rings").to_pylist()] == [2, 1, None, 0, 1, 3]
    assert out.column("rings")[1] == batch.column("rings")[1]
    assert len(out.column("rings")[4].as_py()[0]) == 5
    flagged = batch.set_column(3, "defect", pa.array(["none", "none", "null", "empty", "spike", "none"]))
    (out,) = Q._flag_kernel("rings")([flagged])
    assert out.column("defect").to_pylist() == ["self crossing", "none", "null", "empty", "spike", "self crossing"]
