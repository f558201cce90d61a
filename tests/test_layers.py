"""Layers that follow their deliveries, the segment tree, row keys over files, and what reaches the scan."""

import datetime as dt
import math
import pathlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from zoneloom.functions import rings as R
from zoneloom.operators import control as K
from zoneloom.operators import joins as J
from zoneloom.operators import subdivide as S
from zoneloom.plans.layers import Layers
from zoneloom.plans.update import drop_state, update_layers
from zoneloom.session import workspace
from zoneloom.sources import layout as L

MAPPING = {"srid": 4269, "context": ["state", "county"], "derived": [{"name": "risk", "type": "string", "sql": "'minimal'"}],
           "columns": [{"name": "zone_id", "type": "int", "expr": "file_row_number"}]}


def square(x, y, half=10.0):
    return [(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half), (x - half, y - half)]


def delivery(spark, units):
    """``units``: {(state, county): [rings]}."""
    rows = [(s, c, i, rings) for (s, c), shapes in units.items() for i, rings in enumerate(shapes)]
    return spark.createDataFrame(rows, f"state string, county string, file_row_number bigint, rings {R.RINGS_TYPE}")


def contents(layers):
    rows = layers.scan("cells").select("cell", "state", "county", "zone_id").collect()
    return {(r.cell, r.state, r.county, r.zone_id) for r in rows}


def files(layers, layer):
    return {r.path for r in layers.files(layer).collect()}


@pytest.fixture(scope="module")
def loaded(spark):
    root = workspace(spark, "layers")
    layers, store = Layers(spark, root), K.LogStore(spark, f"{root}/control")
    old = {("MA", "O'Brien"): [[square(50, 50)], [square(150, 50)]], ("MA", "b/c"): [[square(50, 55)], [square(250, 50)]],
           ("UT", "d"): [[square(450, 450)], [square(0, 0), square(0, 0, 5.0)[::-1]]]}
    days = {"O'Brien": 1, "b/c": 1, "d": 1, "never": 1}
    rows = [("MA" if c != "d" else "UT", c, dt.date(2020, 1, d), "new", None) for c, d in days.items()]
    log = spark.createDataFrame(rows, "state string, county string, fema_update_date date, status string, bronze_rows bigint")
    log = K.conform(log, K.empty_log(spark)).withColumn("bronze_at", F.expr("CASE WHEN county <> 'never' THEN TIMESTAMP '2020-01-01 00:00:00' END"))
    store.save(log, 1)
    feed = spark.createDataFrame([], "state string, county string, fema_update_date date, url string, dfirm_id string, zip_size_mb double, zip_name string")
    took = delivery(spark, old)
    first = update_layers(layers, store, feed, lambda due: took.join(due.select(*K.KEY), K.KEY, "left_semi"), mapping=MAPPING, gold=False)
    layers.build_cells(100.0, (0.0, 0.0, 512.0, 512.0))
    return layers, store, first


def test_first_load_and_update(spark, loaded):
    layers, store, first = loaded
    status = {r.county: (r.status, r.bronze_rows, r.silver_rows, r.subdivided_rows) for r in first.log.collect()}
    assert status == {"O'Brien": ("subdivided", 2, 2, 2), "b/c": ("subdivided", 2, 2, 2), "d": ("subdivided", 2, 2, 2), "never": ("new", None, None, None)}
    assert {(r.state, r.units) for r in first.never_loaded.collect()} == {("MA", 1)}
    before, cells = contents(layers), files(layers, "cells")
    assert ("0_0", "MA", "b/c", 0) in before and ("2_0", "MA", "b/c", 1) in before

    # b/c moves east, d cannot be read, O'Brien stays
    feed = spark.createDataFrame(
        [("MA", "b/c", dt.date(2021, 1, 1), "u", "1", 1.0, "z"), ("UT", "d", dt.date(2021, 1, 1), "u", "1", 1.0, "z"), ("NY", "x", dt.date(2021, 1, 1), "u", "1", 1.0, "z")],
        "state string, county string, fema_update_date date, url string, dfirm_id string, zip_size_mb double, zip_name string")
    bow = [(350.0, 50.0), (354.0, 54.0), (354.0, 50.0), (350.0, 52.0), (350.0, 50.0)]
    new = delivery(spark, {("MA", "b/c"): [[square(150, 55)], [bow], [square(1, 1)[:2]]]}).withColumn("error", F.lit(None).cast("string"))
    broken = spark.createDataFrame([("UT", "d", "BadZipFile: no")], "state string, county string, error string")
    both = new.unionByName(broken, allowMissingColumns=True)
    pieces_before = files(layers, "pieces")
    done = update_layers(layers, store, feed, lambda due: both, mapping=MAPPING)
    assert [(r.state, r.county) for r in done.units.collect()] == [("MA", "b/c")]
    log = {r.county: r for r in done.log.collect()}
    assert (log["b/c"].bronze_rows, log["b/c"].silver_rows, log["b/c"].silver_invalid_fixed, log["b/c"].status) == (3, 2, 1, "subdivided")
    assert log["d"].status == "new" and log["d"].error.startswith("BadZipFile") and "x" not in log
    assert {r.defect for r in layers.scan("quarantine").collect()} == {"empty"}

    assert {r.cell for r in done.cells.collect()} == {"0_0", "1_0", "2_0", "3_0"}
    after = contents(layers)
    assert after == {x for x in before if x[2] != "b/c"} | {("1_0", "MA", "b/c", 0), ("3_0", "MA", "b/c", 1)}
    touched = {"0_0", "1_0", "2_0", "3_0"}
    name = lambda p: p.split("/cell=")[1].split("/")[0]
    kept = {p for p in cells if name(p) not in touched}
    assert kept <= files(layers, "cells") and not {p for p in cells if name(p) in touched} & files(layers, "cells")
    assert "2_0" not in {name(p) for p in files(layers, "cells")}  # emptied, so its folder is gone
    other = {p for p in pieces_before if "b%2Fc" not in p and "b/c" not in p}
    assert other <= files(layers, "pieces")

    # once more: the same cells, the same rows
    again = layers.refresh_cells(done.units)
    assert {r.cell for r in again.collect()} == {"1_0", "3_0"} and contents(layers) == after


def test_dropped_state(spark, loaded):
    layers, store, _ = loaded
    log, gone = drop_state(layers, store, "UT", gold=True)
    assert {r.state for r in log.collect()} == {"MA"} and {r.layer for r in gone.collect()} >= {"bronze", "silver", "pieces"}
    assert not any("state=UT" in p for layer in ("bronze", "silver", "pieces") for p in files(layers, layer))
    assert {x[1] for x in contents(layers)} == {"MA"}


def test_benchmarks_append(spark):
    store = K.LogStore(spark, workspace(spark, "control"))
    row = spark.createDataFrame([("a", 2.0, 5)], "name string, elapsed_ms double, rows bigint")
    store.append_benchmarks(row)
    store.append_benchmarks(row.withColumn("elapsed_ms", F.lit(4.0)))
    assert sorted(r.elapsed_ms for r in store.benchmarks().collect()) == [2.0, 4.0]
    with pytest.raises(ValueError, match="speed"):
        store.append_benchmarks(row.withColumn("speed", F.lit(1)))


def test_one_writer_sets_codec_and_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    L.write_parquet(spark.range(5_000), path, group_rows=1_000)
    for f in (tmp_path / "t").glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        assert all(g.num_rows <= 1_000 and g.column(0).compression == "ZSTD" for g in groups)


def test_segment_tree(spark):
    """Every edge at few nodes; a leaf's path meets exactly the edges over it."""
    rng = np.random.default_rng(2)
    spans = [(0, 1023), (0, 0), (1023, 1023), (1, 1022), (5, 6)] + [tuple(sorted(map(int, rng.integers(0, 1024, 2)))) for _ in range(200)]
    df = spark.createDataFrame([(i, a, b, 10) for i, (a, b) in enumerate(spans)], "i int, a bigint, b bigint, levels bigint")
    nodes = df.select("i", F.explode(J.tree_nodes(F.col("a"), F.col("b"), F.col("levels"))).alias("node"))
    assert nodes.groupBy("i").count().agg(F.max("count")).first()[0] <= 2 * 10
    leaves = spark.createDataFrame([(v, 10) for v in range(0, 1024, 7)], "leaf bigint, levels bigint")
    asked = leaves.select("leaf", F.explode(J.tree_path(F.col("leaf"), F.col("levels"))).alias("node"))
    got = sorted((r.leaf, r.i) for r in asked.join(nodes, "node").collect())
    assert got == sorted((v, i) for v in range(0, 1024, 7) for i, (a, b) in enumerate(spans) if a <= v <= b)


def test_comb_keeps_few_rows_an_edge(spark):
    teeth = 25_000
    x = np.arange(teeth, dtype=float)
    up = np.stack([np.c_[x, np.zeros(teeth)], np.c_[x + 0.2, 1000 + x % 7], np.c_[x + 0.4, 1000 + x % 5], np.c_[x + 0.6, x % 3]], axis=1).reshape(-1, 2)
    ring = [*map(tuple, up.tolist()), (float(teeth), -5.0), (-1.0, -5.0), (0.0, 0.0)]
    zone = spark.createDataFrame([(1, [ring])], f"zone_id int, rings {R.RINGS_TYPE}")
    wide = J.with_levels(R.with_measures(zone))
    n, rows = len(ring) - 1, J.edge_tree(wide, ["zone_id"])
    assert n >= 100_000
    total = rows.count()
    most = rows.groupBy("e").count().agg(F.max("count")).first()[0]
    assert most <= 2 * 17 and total <= 17 * n
    pts = spark.createDataFrame([(0, 10.3, 500.0), (1, 10.8, 500.0), (2, 24_000.3, 3.0), (3, 5.0, -4.0)], "pid int, x double, y double")
    hits = J.point_in_giant_zone(pts, R.with_measures(zone), ["pid"], ["zone_id"], 4096.0)
    assert {r.pid for r in hits.collect()} == {0, 2, 3}


def test_chosen_partitions_are_pruned_at_run_time(spark):
    root = workspace(spark, "published")
    L.write_parquet(spark.range(200).select("id", (F.col("id") % 20).alias("file")), root, ["file"])
    chosen = spark.createDataFrame([(3,), (4,), (3,)], "file int")
    rows = L.scan_chosen(spark, root, chosen, ["file"])
    assert sorted({r.file for r in rows.collect()}) == [3, 4] and rows.count() == 20
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()


def test_row_keys_run_through_the_files_of_a_unit(spark):
    root = workspace(spark, "units")
    rows = spark.range(100).select(F.lit("MA").alias("state"), F.when(F.col("id") < 70, "a").otherwise("b").alias("county"), "id")
    L.write_units(rows, root, order=["id"], rows_per_file=9)
    got = L.scan_numbered(spark, root).collect()
    for county, n in (("a", 70), ("b", 30)):
        assert sorted(r.file_row_number for r in got if r.county == county) == list(range(n))


def test_table_function_gives_the_pieces(spark):
    turn = np.linspace(0, 2 * np.pi, 400, endpoint=False)
    ring = [(float(a), float(b)) for a, b in zip(90 * np.cos(turn), 70 * np.sin(turn), strict=True)]
    zones = spark.createDataFrame([(1, [[*ring, ring[0]]]), (2, None)], f"zone_id int, rings {R.RINGS_TYPE}")
    S.register_functions(spark, "cut_up")
    got = spark.sql("SELECT z.zone_id, p.piece_id, p.nverts, p.rings FROM {z} z, LATERAL cut_up(z.rings, 50) p", z=zones)
    want = S.subdivide(zones, ["zone_id"], 50).select("zone_id", "piece_id", "nverts", "rings")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_geodesic_area_of_a_box_between_parallels(spark):
    """Against the closed form of the ellipsoid, sides densified so that they follow their parallels."""
    n, (lo, hi, wide) = 2_000, (30.0, 31.0, 2.0)
    east = [(wide * i / n, lo) for i in range(n + 1)]
    west = [(wide - wide * i / n, hi) for i in range(n + 1)]
    ring = [*east, *west, (0.0, lo)]
    df = spark.createDataFrame([([ring],)], f"rings {R.RINGS_TYPE}")
    got = df.select(R.area_geodesic_km2(F.col("rings")).alias("a")).first().a
    a, f = R.SEMI_MAJOR_KM, R.FLATTENING
    b, e = a * (1 - f), math.sqrt(f * (2 - f))
    side = lambda p: math.sin(p) / (1 - (e * math.sin(p)) ** 2) + math.log((1 + e * math.sin(p)) / (1 - e * math.sin(p))) / (2 * e)
    want = math.radians(wide) * b * b / 2 * (side(math.radians(hi)) - side(math.radians(lo)))
    assert got == pytest.approx(want, rel=1e-6)


def test_layers_of_many_files_have_no_checksum_files(spark):
    """On a local disk Hadoop's checksum files double the files and start two processes for each."""
    root = workspace(spark, "many")
    rows = spark.range(40).selectExpr("'MA' AS state", "concat('u', id % 2) AS county", "id AS zone_id").coalesce(1)
    L.write_units(rows, root, order=["zone_id"], rows_per_file=7)
    names = [p.name for p in pathlib.Path(root).rglob("*") if p.is_file()]
    assert sum(n.endswith(".parquet") for n in names) == 6 and not [n for n in names if n.endswith(".parquet.crc")]
    assert sorted(r.zone_id for r in L.scan(spark, root).collect()) == list(range(40))
    L.replace_units(rows.where("county = 'u0' AND zone_id < 10"), root, order=["zone_id"], rows_per_file=7)
    spark.catalog.refreshByPath(root)
    assert sorted(r.zone_id for r in L.scan(spark, root).collect()) == sorted([0, 2, 4, 6, 8, *range(1, 40, 2)])
