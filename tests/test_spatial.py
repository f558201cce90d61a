"""Layouts agree with brute force, hot groups included."""

import io
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.deliveries import NAD83, zip_bytes
from zoneloom.functions import rings as R
from zoneloom.functions import wkb as W
from zoneloom.operators import clip
from zoneloom.operators import joins as J
from zoneloom.operators import subdivide as S
from zoneloom.operators import validity as Q
from zoneloom.session import ship_kernels, shared_root, workspace
from zoneloom.sources import archive as A
from zoneloom.sources import layout as L

SCHEMA = f"state string, county string, zone_id bigint, rings {R.RINGS_TYPE}"


def circle(cx, cy, r, n):
    t = np.arange(n) * 2 * np.pi / n
    p = np.c_[cx + r * np.cos(t), cy + r * np.sin(t)]
    return np.vstack([p, p[:1]])


@pytest.fixture(scope="module")
def shapes():
    rng = np.random.default_rng(5)
    # a third of the zones crowd into one cell
    return [
        [circle(*(rng.uniform(0, 64, 2) if i % 3 == 0 else rng.uniform(0, 1000, 2)),
                rng.uniform(5, 60), int(rng.integers(8, 300)))]
        for i in range(90)
    ]


@pytest.fixture(scope="module")
def zones(spark, shapes):
    rows = [
        ("MA", "O'Brien" if i % 2 else "Unit", i, [[tuple(map(float, p)) for p in r] for r in s])
        for i, s in enumerate(shapes)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(6)
    xy = rng.uniform(0, 1000, (600, 2))
    xy[::3] = (31.5, 30.25)  # a third of all points at one place
    return xy, spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xy)],
                                     "pid int, x double, y double")


@pytest.fixture(scope="module")
def brute(shapes, points):
    return {
        (pid, z)
        for z, s in enumerate(shapes)
        for pid in np.flatnonzero(clip.points_inside(s[0], points[0]))
    }


def pairs(df):
    rows = [(r.pid, r.zone_id) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("hot", [10**6, 40, 5])
def test_points_in_zones(points, zones, brute, hot):
    assert pairs(J.point_in_zone(points[1], zones, 128, hot_pairs=hot)) == brute


def test_equal_points_stay_apart(spark, zones, points, brute):
    bare = points[1].select("x", "y")
    assert J.point_in_zone(bare, zones, 128).count() == len(brute)


def test_banded_join(points, zones, brute):
    got = J.point_in_giant_zone(points[1], zones, ["pid"], ["zone_id"], 128)
    assert pairs(got) == brute


@pytest.mark.parametrize("limit", [5000, 60])
def test_pieces_and_cells_agree(spark, zones, points, brute, limit):
    keys = ["state", "county", "zone_id"]
    pieces = S.subdivide(zones, keys, cap=40, inline_limit=limit)
    root = workspace(spark, "cells")
    L.write_cells(pieces, root, 128, rows_per_file=60)
    gold = L.scan(spark, root)
    hits = J.match_points(points[1], gold, 128).select("pid", "zone_id").distinct()
    assert pairs(hits) == brute
    stored = gold.dropDuplicates([*keys, "piece_id"]).groupBy("zone_id").agg(
        F.sum(R.area(F.col("rings"))).alias("area"), F.max("nverts").alias("n"),
        F.max("piece_id").alias("last"), F.count("*").alias("rows"),
    ).collect()
    whole = {r.zone_id: r.a for r in zones.select("zone_id", R.area(F.col("rings")).alias("a")).collect()}
    assert len(stored) == len(whole)
    for r in stored:
        assert r.n <= 40 and r.last + 1 == r.rows
        assert r.area == pytest.approx(whole[r.zone_id], rel=1e-9)
    assert L.extra_files(L.cell_index(spark, root), 60).isEmpty()


def test_lookup_and_viewport(spark, zones, shapes):
    root = workspace(spark, "cells")
    L.write_cells(R.with_measures(zones).withColumn("piece_id", F.lit(0)), root, 128)
    gold = L.scan(spark, root)
    got = {r.zone_id for r in J.lookup_point(gold, 31.5, 30.25, 128).collect()}
    want = {i for i, s in enumerate(shapes) if clip.points_inside(s[0], [(31.5, 30.25)])[0]}
    assert got == want
    assert J.lookup_point(gold, 99999.0, 0.0, 128).isEmpty()
    view = J.read_viewport(gold, (-500.0, -500.0, 1500.0, 1500.0), 128)
    assert sorted(r.zone_id for r in view.collect()) == list(range(len(shapes)))
    assert J.read_viewport(gold, (5000.0, 5000.0, 5100.0, 5100.0), 128).isEmpty()


def test_boundary_counts_only_when_asked(spark):
    square = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]
    zone = spark.createDataFrame([("MA", "u", 1, square)], SCHEMA)
    pts = spark.createDataFrame([(0, 2.0, 2.0), (1, 4.0, 2.0), (2, 0.0, 0.0), (3, 5.0, 2.0)],
                                "pid int, x double, y double")
    assert {p for p, _ in pairs(J.point_in_zone(pts, zone, 8))} == {0, 1, 2}
    assert {p for p, _ in pairs(J.point_in_zone(pts, zone, 8, boundary=False))} == {0}


def test_replaced_unit_leaves_the_others(spark, zones):
    root = workspace(spark, "units")
    L.write_units(R.with_measures(zones), root, rows_per_file=20)
    L.replace_units(R.with_measures(zones.where("county = 'Unit'").limit(3)), root)
    spark.catalog.refreshByPath(root)
    got = {r.county: r.n for r in L.scan(spark, root).groupBy("county").agg(F.count("*").alias("n")).collect()}
    assert got == {"O'Brien": 45, "Unit": 3}


def test_formats_round_trip(spark, zones):
    ship_kernels()
    back = zones.select(
        (W.from_wkb(W.to_wkb("rings")) == F.col("rings")).alias("wkb"),
        (R.from_wkt(R.to_wkt(F.col("rings"))) == F.col("rings")).alias("wkt"),
    ).collect()
    assert all(r.wkb and r.wkt for r in back)


def test_repair_and_quarantine(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    cases = {
        1: [square], 2: [square[:4]], 3: [square[:2] + square[1:]],
        4: [square[:2] + [(9.0, 9.0)] + square[1:]], 5: [square[:2]], 6: [],
        7: [[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 2.0), (0.0, 0.0)]], 8: None,
    }
    out = [(4.0 + i, 5.0 + i * i) for i in range(1, 13)]  # a spike of twelve points, each behind the next
    cases[9] = [square[:2] + out[:3] + out[1::-1] + square[1:]]
    cases[10] = [square[:2] + out + [out[-1]] + out[-2::-1] + square[1:]]
    df = spark.createDataFrame([("MA", "u", k, v) for k, v in cases.items()], SCHEMA)
    good, bad = Q.repair_zones(df, ["zone_id"])
    assert {r.zone_id: round(r.a, 9) for r in good.select("zone_id", R.area(F.col("rings")).alias("a")).collect()} == {
        1: 16.0, 2: 16.0, 3: 16.0, 4: 16.0, 7: round(20 / 3, 9), 9: 16.0, 10: 16.0
    }
    assert {r.zone_id: r.defect for r in bad.collect()} == {5: "empty", 6: "empty", 8: "null"}


def test_archives_from_a_folder(spark, tmp_path):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    row = ({"FLD_AR_ID": "é1", "COUNTY": "x"}, [ring])
    (tmp_path / "a.zip").write_bytes(zip_bytes([row], "utf-8", NAD83, "my_s_fld_haz_ar", True))
    (tmp_path / "b.zip").write_bytes(zip_bytes([row], "latin1", NAD83, "S_FLD_HAZ_AR", False))
    empty = io.BytesIO()
    with zipfile.ZipFile(empty, "w") as z:
        z.writestr("readme.txt", "nothing")
    (tmp_path / "c.zip").write_bytes(empty.getvalue())
    (tmp_path / "d.zip").write_bytes(b"not a zip")
    rows = A.read_archives(A.landed_archives(spark, str(tmp_path)), ["FLD_AR_ID"])
    good, bad = A.crs_gate(rows)
    got = {r.path[-5]: r for r in good.collect()}
    assert {k: (r.FLD_AR_ID, r.encoding) for k, r in got.items()} == {
        "a": ("é1", "cpg:UTF-8 zip:cache"), "b": ("é1", "latin1-fallback zip:cache")
    }
    errors = {r.path[-5]: r.error for r in bad.collect()}
    assert errors["c"].endswith("S_FLD_HAZ_AR.shp not in archive") and "BadZipFile" in errors["d"]


def test_scratch_follows_the_session(spark):
    assert workspace(spark, "x").startswith(shared_root(spark))
