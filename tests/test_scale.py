"""Queries over tables of small rows that become large geometry."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import geometry as C
from checks import places as P
from checks import views as V
from zoneloom.operators import clip
from zoneloom.operators import clip_many as many
from zoneloom.sources import folders as D
from zoneloom.sources import layout as L


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Forty zones in one file of one row group."""
    root = str(tmp_path_factory.mktemp("tables"))
    spark.range(40).selectExpr("id AS p_partkey").coalesce(1).write.parquet(f"{root}/part.parquet")
    return root


def test_round_trip_tells_the_header_of_the_first_polygon(spark, folder):
    rows = C.wkb_round_trip(spark, folder).collect()
    assert len(rows) == 40
    # order and type, number of rings, a length for each of the two rings
    assert {(r["header"], r["nverts"], r["bytes"]) for r in rows} == {(17, 19, 343)}


@pytest.mark.parametrize("view", ["zones", "zones512", "fine_squares", "zones_holes", "zones_multi", "broken", "bronze"])
def test_geometry_is_made_by_many_tasks(spark, folder, view):
    rows = getattr(V, view)(spark, folder)
    assert rows.rdd.getNumPartitions() == 4
    assert rows.count() == 40


def ring(n, seed):
    rng = np.random.default_rng(seed)
    turn = np.sort(rng.uniform(0, 6.28, n))
    away = 100 + 40 * rng.random(n)
    points = np.column_stack([away * np.cos(turn), away * np.sin(turn)])
    points = np.round(points / 4) * 4 if seed % 2 else points  # repeated points, edges on the lines
    return np.concatenate([points, points[:1]])


@pytest.mark.parametrize("cap,levels", [(100, None), (9, None), (20, 3)])
def test_rings_cut_together_are_cut_as_one_by_one(cap, levels):
    rings = [ring(n, seed) for n in (5, 60, 300, 900) for seed in range(6)]
    rings += [r[::-1] for r in rings[:9]] + [np.zeros((4, 2)), np.array([[0, 0], [1, 1], [0, 0.0]])]
    want = [
        (i, d, piece[0])
        for i, r in enumerate(rings)
        for part in clip.to_parts([r])
        for piece, d in clip.split_down(part, cap, 0, 40, levels)
    ]
    n = np.array([len(r) for r in rings])
    p = np.concatenate(rings)
    places, n = many.tidy(p, n)
    p, ids, n = p[places], np.flatnonzero(n > 0), n[n > 0]
    p, n, of, depth = many.split_many(many.oriented(p, n), n, np.zeros(len(n), int), cap, 40, levels)
    got = np.split(p, np.cumsum(n)[:-1])
    assert [(i, d) for i, d, _ in want] == list(zip(ids[of], depth, strict=True))
    assert all((a[:-1] == b).all() for (_, _, a), b in zip(want, got, strict=True))


def test_pieces_are_not_broadcast(spark, folder):
    """Kernel rows look as small to the planner as the rows they were made of."""
    for made in (C.piece_boxes(spark, folder), C.subdivide_rounds(spark, folder)):
        assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString()


def test_points_are_matched_by_many_tasks_without_grouping(spark, folder):
    spark.range(50).selectExpr("id AS o_orderkey").coalesce(1).write.parquet(f"{folder}/orders.parquet")
    plan = P.point_in_polygon(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "Aggregate" not in plan


def test_files_of_a_set_length_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(64).selectExpr("id", "struct(id + 0.0D AS xmin, 0.0D AS ymin, id + 1.0D AS xmax, 1.0D AS ymax) AS bbox")
    L.write_global_order(rows, str(tmp_path / "g"), (0.0, 0.0, 64.0, 1.0), 8, files=1, maxRecordsPerFile="5")
    stored = spark.read.parquet(str(tmp_path / "g")).select("id", F.col("_metadata.file_name").alias("file"))
    assert stored.count() == 64
    assert stored.groupBy("file").count().agg(F.max("count")).first()[0] <= 5
    assert stored.select(F.substring("file", 1, 10)).distinct().count() > 1


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    root, key = str(tmp_path / "units"), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    spark.range(60).selectExpr("id", "id AS unit").write.partitionBy("unit").parquet(root)
    before, group = spark.conf.get(key), spark.sparkContext
    group.setJobGroup("listing", "listing")
    try:
        assert L.scan(spark, root).count() == D.partition_files(spark, root, ["unit"]).count() == 60
        tracker = group.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i]
    finally:
        group.setLocalProperty("spark.jobGroup.id", None)
    assert max(tasks) <= 8 and spark.conf.get(key) == before


@pytest.mark.parametrize("query", [P.file_pruning, P.file_budget, P.generated_points, P.point_in_polygon, P.zones_by_state])
def test_no_geometry_is_made_by_the_tasks_of_the_scan(spark, folder, query):
    """A filter on what is made of the keys sank below their spreading: one task made all geometry for it."""
    for table, key in (("orders", "o_orderkey"), ("customer", "c_custkey")):
        spark.range(50).selectExpr(f"id AS {key}").coalesce(1).write.mode("ignore").parquet(f"{folder}/{table}.parquet")
    plan = query(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "p_partkey" in line]
    assert not [line for line in filters if "7919" in line]


def test_fine_rings_are_made_by_the_batch(spark, folder):
    """every edge of the star in 64 equal steps, by one kernel and not point by point."""
    fine = V.zones512(spark, folder)
    plan = fine._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "transform(" not in plan
    stars = {r.zone_id: r.rings for r in V.zones(spark, folder).collect()}
    rows = fine.collect()
    assert len(rows) == len(stars)
    for r in rows:
        (star,), (ring,) = stars[r.zone_id], r.rings
        want = [(a.x + (b.x - a.x) * j / 64, a.y + (b.y - a.y) * j / 64) for a, b in zip(star, star[1:]) for j in range(64)]
        assert [(p.x, p.y) for p in ring] == [*want, want[0]]
