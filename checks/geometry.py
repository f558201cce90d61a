"""Scalars over geometry, cells, curve and subdivision."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query
from checks.sql import contains, crosses, on_edge, touches, with_
from zoneloom.functions import grid as G
from zoneloom.functions import rings as R
from zoneloom.functions import wkb as W
from zoneloom.operators import joins as J
from zoneloom.operators import reports as P
from zoneloom.operators import subdivide as S
from zoneloom.operators import validity as Q
from zoneloom.sources import archive as A

KEYS = ["state", "county", "zone_id"]


def ring_column():
    return F.col("rings")


def measured(df):
    return R.with_measures(df)


# ------------------------------------------------------------------ measures
@query("g1_validity_counts",
       "SELECT ['none', 'unclosed', 'repeated point', 'spike', 'unclosed', 'self crossing', 'empty', 'null'][p_partkey % 8 + 1] AS defect, "
       "count(*) AS zones, CAST(sum(p_partkey) AS BIGINT) AS keys FROM part GROUP BY 1")
def validity_counts(spark, sf):
    checked = Q.with_defect(V.broken(spark, sf), ["zone_id"])
    return checked.groupBy("defect").agg(F.count("*").alias("zones"), F.sum("zone_id").alias("keys"))


@query("g2_repair", with_(
    "za", "SELECT k AS zone_id, CASE WHEN k % 8 < 4 OR k % 8 = 5 THEN 'good' ELSE 'quarantine' END AS outcome, "
    "CASE k % 8 WHEN 4 THEN 'flat or empty' WHEN 6 THEN 'flat or empty' WHEN 7 THEN 'null' END AS defect, "
    "coalesce(k % 8 IN (1, 2, 3, 4, 5), false) AS repaired, CASE WHEN k % 8 = 5 THEN 2 ELSE 1 END AS shells, "
    # the two triangles of the bow-tie meet a third along: 32 * 64 / 3 / 2 and 64 * 128 / 3 / 2
    "round(CASE WHEN k % 8 < 4 THEN area WHEN k % 8 = 5 THEN (32 * 64 + 64 * 128) / 6.0::DOUBLE END, 6) AS area FROM za"))
def repair(spark, sf):
    """Crossing rings come back as the polygons of their even-odd set."""
    good, bad = Q.repair_zones(V.broken(spark, sf), ["zone_id"])
    why = F.when(F.col("defect") == "empty", F.lit("flat or empty")).otherwise(F.col("defect"))
    return good.select(
        "zone_id", F.lit("good").alias("outcome"), F.lit(None).cast("string").alias("defect"),
        "repaired", F.size("rings").alias("shells"), F.round(R.area(ring_column()), 6).alias("area"),
    ).unionByName(
        bad.select(
            "zone_id", F.lit("quarantine").alias("outcome"), why.alias("defect"), "repaired",
            F.lit(1).alias("shells"), F.lit(None).cast("double").alias("area"),
        )
    )


@query("g3_vertex_counts", with_(
    "zk", "SELECT state, county, count(*) AS rows, 513 AS max_vertices FROM zk GROUP BY ALL"))
def vertex_counts(spark, sf):
    return P.vertices_by_unit(measured(V.zones512(spark, sf)))


@query("g4_bbox", with_(
    "z", "SELECT k AS zone_id, xmin, ymin, xmax, ymax FROM z"))
def bbox(spark, sf):
    return measured(V.zones(spark, sf)).select("zone_id", "bbox.*")


@query("g5_points", with_(
    "p", "SELECT o_orderkey, x, y FROM p"))
def points(spark, sf):
    at = R.point("x", "y")
    return V.points(spark, sf).select("o_orderkey", at["x"].alias("x"), at["y"].alias("y"))


_BP = (
    "SELECT k AS of_zone, i, 0 AS kind, x1 AS x, y1 AS y FROM e "
    "UNION ALL SELECT k, i, 1, (x1 + x2) / 2, (y1 + y2) / 2 FROM e"
)


@query("g7_boundary_points", with_(
    "e z", "SELECT k AS zone_id, count(*) FILTER (WHERE t) AS intersecting, count(*) FILTER (WHERE c) AS contained, "
    "count(*) FILTER (WHERE t AND of_zone = k) AS own FROM h GROUP BY k",
    bp=_BP,
    h=f"SELECT of_zone, bp.i, kind, e.k, {touches('bp.x', 'bp.y')} AS t, "
    f"{contains('bp.x', 'bp.y')} AS c FROM bp JOIN z ON bp.x BETWEEN xmin AND xmax AND bp.y BETWEEN ymin AND ymax "
    "JOIN e ON e.k = z.k GROUP BY of_zone, bp.i, kind, e.k, bp.x, bp.y"))
def boundary_points(spark, sf):
    pts, zones = V.boundary_points(spark, sf), V.zones(spark, sf).select("zone_id", "rings")
    touch = J.point_in_zone(pts, zones, V.CELL, boundary=True, keep=["of_zone", "zone_id"])
    inside = J.point_in_zone(pts, zones, V.CELL, boundary=False, keep=["of_zone", "zone_id"])
    both = touch.withColumn("strict", F.lit(False)).unionByName(
        inside.withColumn("strict", F.lit(True))
    )
    return both.groupBy("zone_id").agg(
        F.count_if(~F.col("strict")).alias("intersecting"),
        F.count_if("strict").alias("contained"),
        F.count_if(~F.col("strict") & (F.col("of_zone") == F.col("zone_id"))).alias("own"),
    )


@query("g10_area", with_(
    "za", "SELECT k AS zone_id, area, area - 64 AS with_hole, area - 64 + 1024 AS multi FROM za"))
def area(spark, sf):
    star = V.zones(spark, sf).select("zone_id", R.area(ring_column()).alias("area"))
    hole = V.zones_holes(spark, sf).select("zone_id", R.area(ring_column()).alias("with_hole"))
    multi = V.zones_multi(spark, sf).select("zone_id", R.area(ring_column()).alias("multi"))
    return star.join(hole, "zone_id").join(multi, "zone_id")


@query("g10_area_spheroid", with_(
    "e", "SELECT k AS zone_id, round(abs(sum(radians((x2 - x1) / 1024) * (2 + sin(radians(y1 / 1024)) + sin(radians(y2 / 1024))))) "
    "* (6371.0072 * 6371.0072 / 2), 3) AS km2 FROM e GROUP BY k"))
def area_spheroid(spark, sf):
    degrees = F.transform(
        ring_column(),
        lambda r: F.transform(
            r, lambda p: F.struct((p["x"] / 1024).alias("x"), (p["y"] / 1024).alias("y"))
        ),
    )
    return V.zones(spark, sf).select(
        "zone_id", F.round(R.area_spheroid_km2(degrees), 3).alias("km2")
    )


_E2 = f"{R.FLATTENING * (2 - R.FLATTENING)!r}::DOUBLE"
_Q = f"(1 - {_E2}) * ({{0}} / (1 - {_E2} * {{0}} * {{0}}) + ln((1 + sqrt({_E2}) * {{0}}) / (1 - sqrt({_E2}) * {{0}})) / (2 * sqrt({_E2})))"


@query("g10_area_geodesic", with_(
    "e", "SELECT k AS zone_id, round(abs(sum(2 * atan(tan(radians((x2 - x1) / 1024) / 2) * sin((a + b) / 2) / cos((a - b) / 2)))) "
    f"* 6378.137 * 6378.137 * any_value(pole) / 2, 3) AS km2 FROM lat GROUP BY k",
    lat=f"SELECT *, asin({_Q.format('sin(radians(y1 / 1024))')} / pole) AS a, asin({_Q.format('sin(radians(y2 / 1024))')} / pole) AS b "
    f"FROM e, (SELECT {_Q.format('1.0::DOUBLE')} AS pole)"))
def area_geodesic(spark, sf):
    degrees = F.transform(
        ring_column(),
        lambda r: F.transform(
            r, lambda p: F.struct((p["x"] / 1024).alias("x"), (p["y"] / 1024).alias("y"))
        ),
    )
    return V.zones(spark, sf).select("zone_id", F.round(R.area_geodesic_km2(degrees), 3).alias("km2"))


@query("g11_polygonal_only",
       "SELECT p_partkey AS zone_id, CASE WHEN p_partkey % 8 IN (4, 6) THEN 0 ELSE 1 END AS kept FROM part WHERE p_partkey % 8 <> 7")
def polygonal_only(spark, sf):
    rows = V.broken(spark, sf).where("rings IS NOT NULL")
    return rows.select("zone_id", F.size(R.polygonal(ring_column())).alias("kept"))


@query("g13_types",
       "SELECT p_partkey AS zone_id, CASE WHEN p_partkey % 8 = 7 THEN NULL WHEN p_partkey % 8 IN (4, 6) THEN 'EMPTY' "
       "ELSE 'POLYGON' END AS broken_type, 'MULTIPOLYGON' AS multi_type, 4269 AS srid FROM part")
def types(spark, sf):
    one = V.broken(spark, sf).select(
        "zone_id",
        # the bow-tie runs clockwise overall, so direct it first
        R.geometry_type(F.transform(R.polygonal(ring_column()), lambda r: F.when(R.ring_area(r) < 0, F.reverse(r)).otherwise(r))).alias("broken_type"),
    )
    many = measured(V.zones_multi(spark, sf)).select(
        "zone_id", R.geometry_type(ring_column()).alias("multi_type"), "srid"
    )
    return one.join(many, "zone_id")


@query("g12_wkb_round_trip", with_(
    "za", "SELECT k AS zone_id, area - 64 + 1024 AS area, 5 + 4 * 2 + 4 AS header, 9 + 5 + 5 AS nverts, "
    "1 + 4 + 4 + (1 + 4 + 4 + 4 + 9 * 16 + 4 + 5 * 16) + (1 + 4 + 4 + 4 + 5 * 16) AS bytes FROM za"))
def wkb_round_trip(spark, sf):
    from zoneloom.session import ship_kernels

    ship_kernels()
    packed = V.zones_multi(spark, sf).select("zone_id", W.to_wkb(ring_column()).alias("wkb"))
    # order, type and number of rings of the first polygon, behind the 9 bytes of the collection, and a length for each ring
    count = F.conv(F.hex(F.reverse(F.substring("wkb", 15, 4))), 16, 10).cast("int")
    back = packed.select(
        "zone_id", F.length("wkb").alias("bytes"), (5 + 4 * count + 4).alias("header"), W.from_wkb("wkb").alias("rings")
    )
    return back.select(
        "zone_id", R.area(ring_column()).alias("area"), "header",
        R.vertex_count(ring_column()).alias("nverts"), "bytes",
    )


_PAIRS = (
    "SELECT k, string_agg(concat({0}), {1} ORDER BY i) AS ring FROM "
    "(SELECT k, i, x, y FROM v UNION ALL SELECT k, 8, x, y FROM v WHERE i = 0) GROUP BY k"
)


@query("g12_wkt", with_(
    "v", "SELECT k AS zone_id, concat('POLYGON ((', ring, '))') AS wkt, true AS same FROM t",
    t=_PAIRS.format("x, ' ', y", "', '")))
def wkt(spark, sf):
    text = V.zones(spark, sf).select("zone_id", "rings", R.to_wkt(ring_column()).alias("wkt"))
    return text.select("zone_id", "wkt", (R.from_wkt(F.col("wkt")) == ring_column()).alias("same"))


@query("s12_geojson", with_(
    "v silver", "SELECT concat('{\"type\":\"Feature\",\"properties\":{\"risk\":\"', risk, '\"},\"geometry\":"
    "{\"type\":\"Polygon\",\"coordinates\":[[', ring, ']]}}') AS feature FROM t JOIN silver USING (k)",
    t=_PAIRS.format("'[', x, ',', y, ']'", "','")))
def geojson(spark, sf):
    return V.silver(spark, sf).select(R.to_feature(ring_column(), risk=F.col("risk")).alias("feature"))


@query("g16_dump_parts", with_(
    "za", "SELECT k AS zone_id, 1 AS path, 14 AS nverts, area - 64 AS area FROM za "
    "UNION ALL SELECT k, 2, 5, 1024 FROM za"))
def dump_parts(spark, sf):
    parts = R.dump_parts(V.zones_multi(spark, sf))
    return parts.select(
        "zone_id", "path", R.vertex_count(ring_column()).alias("nverts"), R.area(ring_column()).alias("area")
    )


# ------------------------------------------------------------------ curve, extent, cells
@query("g14_hilbert", with_("hil", "SELECT k AS zone_id, hilbert FROM hil"))
def hilbert(spark, sf):
    zones = measured(V.zones(spark, sf))
    x, y = G.box_centre(F.col("bbox"))
    box = R.envelope(*V.DOMAIN)
    return zones.select("zone_id", G.hilbert_in_box(x, y, box, V.BITS).alias("hilbert"))


@query("g15_extent_by_group", with_(
    "z zk", "SELECT coalesce(state, 'all') AS state, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax "
    "FROM z JOIN zk USING (k) GROUP BY GROUPING SETS ((state), ())"))
def extent_by_group(spark, sf):
    zones = measured(V.zones(spark, sf))
    per_state = P.extent(zones, "state").select("state", "bbox.*")
    return per_state.unionByName(P.extent(zones).select(F.lit("all").alias("state"), "bbox.*"))


@query("j11_share_of_extent", with_(
    "z", "SELECT k AS zone_id, (xmin - (SELECT min(xmin) FROM z)) / ((SELECT max(xmax) FROM z) - (SELECT min(xmin) FROM z)) AS along FROM z"))
def share_of_extent(spark, sf):
    zones = measured(V.zones(spark, sf))
    whole = P.extent(zones).select("bbox")
    b = whole.scalar()
    return zones.withColumn("whole", b).select(
        "zone_id",
        ((F.col("bbox.xmin") - F.col("whole.xmin")) / (F.col("whole.xmax") - F.col("whole.xmin"))).alias("along"),
    )


@query("g23_point_cells", with_(
    "p", "SELECT o_orderkey, CAST(floor(x / 512) AS BIGINT) AS ci, CAST(floor(y / 512) AS BIGINT) AS cj, "
    "concat(CAST(floor(x / 512) AS BIGINT), '_', CAST(floor(y / 512) AS BIGINT)) AS cell FROM p"))
def point_cells(spark, sf):
    keyed = G.with_point_cell(V.points(spark, sf), V.CELL)
    return keyed.select(
        "o_orderkey", "ci", "cj", G.cell_id(F.col("ci"), F.col("cj")).alias("cell")
    )


@query("g24_zone_cells", with_("zc", "SELECT k AS zone_id, ci, cj FROM zc"))
def zone_cells(spark, sf):
    zones = J.with_edges(V.zones(spark, sf).select("zone_id", "rings"))
    return G.with_zone_cells(zones, V.CELL).select("zone_id", "ci", "cj")


@query("g25_densified_ring", with_(
    "b", "SELECT c_custkey, CAST(seq AS INT) AS seq, CASE WHEN seq <= n THEN bx0 + s * seq / n WHEN seq <= 2 * n THEN bx1 "
    "WHEN seq <= 3 * n THEN bx1 - s * (seq - 2 * n) / n ELSE bx0 END AS x, "
    "CASE WHEN seq <= n THEN by0 WHEN seq <= 2 * n THEN by0 + s * (seq - n) / n WHEN seq <= 3 * n THEN by1 "
    "ELSE by1 - s * (seq - 3 * n) / n END AS y FROM (SELECT *, unnest(range(4 * n + 1)) AS seq FROM ("
    "SELECT *, bx1 - bx0 AS s, 4 * (1 + c_custkey % 8) AS n FROM b))"))
def densified_ring(spark, sf):
    ring = G.densified_box(V.boxes(spark, sf), 64, "vbox")
    return ring.select("c_custkey", "seq", "x", "y")


# ------------------------------------------------------------------ subdivision
@query("g17_subdivide_area", with_("za", "SELECT k AS zone_id, round(area, 3) AS area FROM za"))
def subdivide_area(spark, sf):
    pieces = S.subdivide(V.zones512(spark, sf), KEYS)
    return pieces.groupBy("zone_id").agg(F.round(F.sum(R.area(ring_column())), 3).alias("area"))


@query("g17_subdivide_cap",
       "SELECT p_partkey AS zone_id, true AS within_cap, true AS numbered, true AS cut FROM part")
def subdivide_cap(spark, sf):
    pieces = S.subdivide(V.zones512(spark, sf), KEYS)
    return pieces.groupBy("zone_id").agg(
        (F.max("nverts") <= 100).alias("within_cap"),
        ((F.max("piece_id") + 1 == F.count("*")) & (F.min("piece_id") == 0)).alias("numbered"),
        (F.count("*") > 1).alias("cut"),
    )


@query("g17_subdivide_rounds", with_("za", "SELECT k AS zone_id, round(area, 3) AS area, true AS numbered FROM za"))
def subdivide_rounds(spark, sf):
    """The path of giants: parts redistributed between rounds, then numbered across tasks."""
    pieces = S.subdivide(V.zones512(spark, sf), KEYS, inline_limit=200)
    return pieces.groupBy("zone_id").agg(
        F.round(F.sum(R.area(ring_column())), 3).alias("area"),
        (
            (F.max("piece_id") + 1 == F.count("*"))
            & (F.sum("piece_id") == F.count("*") * (F.count("*") - 1) / 2)
        ).alias("numbered"),
    )


@query("g17_subdivide_hits", with_("hits", "SELECT o_orderkey, k AS zone_id FROM hits"))
def subdivide_hits(spark, sf):
    pieces = S.subdivide(V.zones512(spark, sf), KEYS).select("zone_id", "rings", "bbox")
    # distinct where the pieces of a zone meet a point: hits are far too many to shuffle
    hits = J.point_in_zone(V.points(spark, sf), pieces, V.CELL, once=(["o_orderkey"], ["zone_id"]))
    return hits.select("o_orderkey", "zone_id")


@query("g20_subdivide_stats",
       "SELECT count(*) AS input_rows, 513 AS max_input_vertices, true AS within_cap, true AS grew FROM part")
def subdivide_stats(spark, sf):
    zones = V.zones512(spark, sf)
    stats = S.subdivide_stats(zones, S.subdivide(zones, KEYS))
    return stats.select(
        "input_rows", "max_input_vertices", (F.col("max_output_vertices") <= 100).alias("within_cap"),
        (F.col("ratio") > 1).alias("grew"),
    )


# a square of 64 edges a side is cut into halves of 130 coordinates and quarters of 67
@query("g20_subdivide_ratio",
       "SELECT count(*) AS input_rows, 4 * count(*) AS output_rows, 257 AS max_input_vertices, 67 AS max_output_vertices, "
       "CAST(4 AS DOUBLE) AS ratio FROM part")
def subdivide_ratio(spark, sf):
    squares = V.fine_squares(spark, sf)
    return S.subdivide_stats(squares, S.subdivide(squares, KEYS))


@query("g19_table_function", with_(
    "zk", "SELECT k AS zone_id, q AS piece_id, 67 AS nverts, CAST(4096 AS DOUBLE) AS area FROM zk, (VALUES (0), (1), (2), (3)) AS p(q)"))
def table_function(spark, sf):
    """Pieces by a table function called in SQL text."""
    S.register_functions(spark)
    zones = V.fine_squares(spark, sf)
    rows = spark.sql("SELECT z.zone_id, p.* FROM {zones} z, LATERAL subdivide_pieces(z.rings, 100) p", zones=zones)
    return rows.select("zone_id", "piece_id", "nverts", R.area(ring_column()).alias("area"))


@query("g17_piece_boxes",
       f"SELECT p_partkey AS zone_id, q AS piece_id, CAST((p_partkey * 7919) % {V.SIDE} - 64 + 64 * (q // 2) AS DOUBLE) AS xmin, "
       f"CAST((p_partkey * 104729) % {V.SIDE} - 64 + 64 * (q % 2) AS DOUBLE) AS ymin, "
       f"CAST((p_partkey * 7919) % {V.SIDE} + 64 * (q // 2) AS DOUBLE) AS xmax, "
       f"CAST((p_partkey * 104729) % {V.SIDE} + 64 * (q % 2) AS DOUBLE) AS ymax FROM part, (VALUES (0), (1), (2), (3)) AS p(q)")
def piece_boxes(spark, sf):
    """Where every piece lies and how it is numbered, cut through rounds and in one go."""
    squares = V.fine_squares(spark, sf)
    whole = S.subdivide(squares, KEYS)
    rounds = S.subdivide(squares, KEYS, inline_limit=140)
    # the planner takes the pieces for as small as the rows they are made of and would broadcast them
    return whole.join(rounds.hint("merge"), ["zone_id", "piece_id", "bbox"]).select("zone_id", "piece_id", "bbox.*")


@query("g21_estimate", "SELECT p_partkey AS zone_id, CAST(ceil(513 / 100.0) * 2 AS BIGINT) AS estimate FROM part")
def estimate(spark, sf):
    zones = measured(V.zones512(spark, sf))
    return zones.select("zone_id", S.piece_estimate(F.col("nverts"), 100).alias("estimate"))


@query("g22_cap_variants",
       "SELECT cap, n AS input_rows, pieces * n AS output_rows, most AS max_output_vertices, CAST(pieces AS DOUBLE) AS ratio "
       "FROM (SELECT count(*) AS n FROM part), (VALUES (100, 4, 67), (256, 2, 130), (512, 1, 257)) AS c(cap, pieces, most)")
def cap_variants(spark, sf):
    rows = S.cap_variants(V.fine_squares(spark, sf), KEYS)
    return rows.select("cap", "input_rows", "output_rows", "max_output_vertices", "ratio")


@query("g26_grid_subdivide", with_(
    "za", "SELECT k AS zone_id, round(area, 3) AS area, true AS inside FROM za"))
def grid_subdivide(spark, sf):
    zones = J.with_edges(V.zones(spark, sf))
    pieces = S.grid_subdivide(zones, KEYS, V.CELL)
    b, cell = F.col("bbox"), G.cell_box(F.col("ci"), F.col("cj"), V.CELL)
    inside = (
        (b["xmin"] >= cell["xmin"]) & (b["xmax"] <= cell["xmax"])
        & (b["ymin"] >= cell["ymin"]) & (b["ymax"] <= cell["ymax"])
    )
    return pieces.groupBy("zone_id").agg(
        F.round(F.sum(R.area(ring_column())), 3).alias("area"), F.bool_and(inside).alias("inside")
    )


# ------------------------------------------------------------------ archives
@query("s7_archive_ingest", with_(
    "za zk", "SELECT a AS archive, CASE WHEN a % 7 = 6 THEN 'FileNotFoundError: S_FLD_HAZ_AR.shp not in archive' "
    "WHEN a % 5 = 4 THEN concat('S_FLD_HAZ_AR is in ', chr(39), 'EPSG:4326', chr(39), ', expected EPSG:4269') END AS error, "
    "CASE WHEN a % 7 = 6 THEN NULL WHEN a % 2 = 0 THEN 'cpg:UTF-8 zip:cache' ELSE 'latin1-fallback zip:cache' END AS encoding, "
    "CASE WHEN a % 7 <> 6 THEN count(*) ELSE 0 END AS rows, "
    "CASE WHEN a % 7 <> 6 THEN sum(area) END AS area, CASE WHEN a % 7 <> 6 THEN CAST(sum(k) AS BIGINT) ELSE 0 END AS keys, "
    "CASE WHEN a % 7 <> 6 THEN count(DISTINCT county) ELSE 0 END AS counties "
    "FROM (SELECT *, k // 25 AS a FROM za JOIN zk USING (k)) GROUP BY a"))
def archive_ingest(spark, sf):
    from checks.deliveries import archives

    rows = A.read_archives(archives(spark, sf), ["FLD_AR_ID", "COUNTY"])
    good, bad = A.crs_gate(rows)
    both = good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)
    return both.groupBy(
        F.regexp_extract("path", r"(\d+)\.zip$", 1).cast("bigint").alias("archive"), "error", "encoding"
    ).agg(
        F.count("rings").alias("rows"),
        F.sum(R.area(ring_column())).alias("area"),
        F.coalesce(F.sum(F.col("FLD_AR_ID").cast("bigint")), F.lit(0)).alias("keys"),
        F.count_distinct("COUNTY").alias("counties"),
    )
