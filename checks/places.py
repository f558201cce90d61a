"""Spatial joins, lookups, viewports and Parquet layouts."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query
from checks.sql import box_meets, touches, with_
from zoneloom.functions import grid as G
from zoneloom.functions import rings as R
from zoneloom.operators import joins as J
from zoneloom.operators import reports as P
from zoneloom.session import settle, workspace
from zoneloom.sources import layout as L

HITS = with_("hits", "SELECT o_orderkey, k AS zone_id FROM hits")
UNITS = ["state", "county"]


def measured_zones(spark, sf):
    return R.with_measures(V.zones(spark, sf)).withColumn("piece_id", F.lit(0))


def unit_layout(spark, sf):
    root = workspace(spark, "units")
    L.write_units(measured_zones(spark, sf), root)
    return root


def cell_layout(spark, sf):
    root = workspace(spark, "cells")
    L.write_cells(measured_zones(spark, sf), root, V.CELL, V.DOMAIN, V.BITS)
    return root


# ------------------------------------------------------------------ joins
@query("j1_point_in_polygon", HITS)
def point_in_polygon(spark, sf):
    zones = V.zones(spark, sf).select("zone_id", "rings")
    hits = J.point_in_zone(V.points(spark, sf), zones, V.CELL, keep=["o_orderkey", "zone_id"])
    return hits.select("o_orderkey", "zone_id")


@query("j1_hits_per_risk", with_(
    "hits silver", "SELECT risk, count(*) AS hits, count(DISTINCT o_orderkey) AS points FROM hits JOIN silver USING (k) GROUP BY risk"))
def hits_per_risk(spark, sf):
    zones = V.silver(spark, sf).select("risk", "rings", "bbox")
    hits = J.point_in_zone(V.points(spark, sf), zones, V.CELL, keep=["o_orderkey", "risk"])
    return hits.groupBy("risk").agg(
        F.count("*").alias("hits"), F.count_distinct("o_orderkey").alias("points")
    )


@query("j1_hot_cells", HITS)
def hot_cells(spark, sf):
    """The same join with a low limit, so that cells refine and finally split."""
    zones = V.zones(spark, sf).select("zone_id", "rings")
    hits = J.point_in_zone(V.points(spark, sf), zones, 4 * V.CELL, hot_pairs=1024, keep=["o_orderkey", "zone_id"])
    return hits.select("o_orderkey", "zone_id")


@query("j1b_edge_band_join", HITS)
def edge_band_join(spark, sf):
    zones = R.with_measures(V.zones512(spark, sf).select("zone_id", "rings"))
    return J.point_in_giant_zone(
        V.points(spark, sf), zones, ["o_orderkey"], ["zone_id"], V.CELL
    )


@query("j2_batch_lookup", with_(
    "hits zk", "SELECT state, county, count(*) AS hits, CAST(sum(o_orderkey * 31 + k) AS BIGINT) AS checksum FROM hits JOIN zk USING (k) GROUP BY ALL"))
def batch_lookup(spark, sf):
    # the columns of a hit; a kernel hands on all it is given
    gold = L.scan(spark, cell_layout(spark, sf)).select("state", "county", "zone_id", "ci", "cj", "bbox", "rings")
    hits = J.match_points(V.points(spark, sf), gold, V.CELL, keep=["o_orderkey", *UNITS, "zone_id"])
    return hits.groupBy("state", "county").agg(
        F.count("*").alias("hits"),
        F.sum(F.col("o_orderkey") * 31 + F.col("zone_id")).alias("checksum"),
    )


@query("j3_single_lookup", with_(
    "z e zk", "SELECT k AS zone_id, state, county FROM zk JOIN (SELECT e.k FROM q JOIN z ON qx BETWEEN xmin AND xmax AND qy BETWEEN ymin AND ymax "
    f"JOIN e ON e.k = z.k GROUP BY e.k, qx, qy HAVING {touches('qx', 'qy')}) USING (k)",
    q=f"SELECT CAST((m * 7919) % {V.SIDE} AS DOUBLE) AS qx, CAST((m * 104729) % {V.SIDE} AS DOUBLE) AS qy FROM (SELECT max(p_partkey) AS m FROM part)"))
def single_lookup(spark, sf):
    """Zones at the centre of the newest zone."""
    gold = L.scan(spark, cell_layout(spark, sf))
    k = V.table(spark, sf, "part").agg(F.max("p_partkey")).first()[0]
    found = J.lookup_point(gold, k * 7919 % V.SIDE, k * 104729 % V.SIDE, V.CELL)
    return found.select("zone_id", "state", "county")


FRAME = (3000.0, 2500.0, 9000.0, 7000.0)
FRAME_SQL = "3000.0::DOUBLE, 2500.0::DOUBLE, 9000.0::DOUBLE, 7000.0::DOUBLE".split(", ")


@query("j4_viewport_read", with_(
    "e zk", f"SELECT k AS zone_id, state, county FROM zk WHERE k IN (SELECT k FROM e GROUP BY k HAVING {box_meets(*FRAME_SQL)})"))
def viewport_read(spark, sf):
    gold = L.scan(spark, cell_layout(spark, sf))
    return J.read_viewport(gold, FRAME, V.CELL).select("zone_id", "state", "county")


@query("j4_viewport_features", with_(
    "e v silver", "SELECT concat('{\"type\":\"Feature\",\"properties\":{\"risk\":\"', risk, '\"},\"geometry\":"
    "{\"type\":\"Polygon\",\"coordinates\":[[', ring, ']]}}') AS feature FROM t JOIN silver USING (k) "
    f"WHERE risk <> 'minimal' AND k IN (SELECT k FROM e GROUP BY k HAVING {box_meets(*FRAME_SQL)})",
    t="SELECT k, string_agg(concat('[', x, ',', y, ']'), ',' ORDER BY i) AS ring FROM "
    "(SELECT k, i, x, y FROM v UNION ALL SELECT k, 8, x, y FROM v WHERE i = 0) GROUP BY k"))
def viewport_features(spark, sf):
    pieces = V.silver(spark, sf).withColumn("piece_id", F.lit(0))
    root = workspace(spark, "cells")
    L.write_cells(pieces, root, V.CELL, V.DOMAIN, V.BITS)
    drawn = J.read_viewport(L.scan(spark, root), FRAME, V.CELL, hide="minimal")
    return drawn.select(R.to_feature(F.col("rings"), risk=F.col("risk")).alias("feature"))


@query("g8_envelope_hits", with_(
    "z e b", "SELECT c_custkey, z.k AS zone_id FROM b JOIN z ON xmin <= bx1 AND xmax >= bx0 AND ymin <= by1 AND ymax >= by0 "
    f"JOIN e ON e.k = z.k GROUP BY c_custkey, z.k, bx0, by0, bx1, by1 HAVING {box_meets('bx0', 'by0', 'bx1', 'by1')}"))
def envelope_hits(spark, sf):
    zones = V.zones(spark, sf).select("zone_id", "rings")
    return J.zones_in_boxes(V.boxes(spark, sf), zones, V.CELL).select("c_custkey", "zone_id")


@query("p13_bbox_struct_filter", with_(
    "z zk", "SELECT k AS zone_id, xmin, ymax FROM z WHERE xmin <= 9000 AND xmax >= 3000 AND ymin <= 7000 AND ymax >= 2500"))
def bbox_struct_filter(spark, sf):
    stored = L.scan(spark, unit_layout(spark, sf))
    b = F.col("bbox")
    near = (b["xmin"] <= FRAME[2]) & (b["xmax"] >= FRAME[0])
    near = near & (b["ymin"] <= FRAME[3]) & (b["ymax"] >= FRAME[1])
    return stored.where(near).select("zone_id", "bbox.xmin", "bbox.ymax")


# one "file" per 256th of the curve: a published set with boxes that overlap
FILES = "SELECT k, hilbert >> 20 AS file FROM hil"
FILE_INDEX = (
    "SELECT file, count(*) * 100 AS bytes, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, "
    "max(ymax) AS ymax FROM f JOIN z USING (k) GROUP BY file"
)


def published(spark, sf):
    zones = measured_zones(spark, sf)
    x, y = G.box_centre(F.col("bbox"))
    curve = G.hilbert_in_box(x, y, R.envelope(*V.DOMAIN), V.BITS)
    return zones.withColumn("file", F.floor(curve / (1 << 20)))


def published_index(zones):
    # stored: the files are grouped twice, and the join that asks for them looks at them more than once
    zones = settle(zones.select("file", "bbox"))
    return P.extent(zones, "file").join(
        zones.groupBy("file").agg((F.count("*") * 100).alias("bytes")), "file"
    )


@query("j5_file_pruning", with_(
    "hil z b", "SELECT c_custkey, count(file) AS files, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM b LEFT JOIN fi "
    "ON xmin <= bx1 AND xmax >= bx0 AND ymin <= by1 AND ymax >= by0 GROUP BY c_custkey",
    f=FILES, fi=FILE_INDEX))
def file_pruning(spark, sf):
    index = published_index(published(spark, sf))
    return J.files_for_boxes(V.boxes(spark, sf), index, 4 * V.CELL, "c_custkey")


@query("j6_file_budget", with_(
    "hil z b", "SELECT c_custkey, count(file) AS files, count(file) > 6 AS refused FROM b LEFT JOIN fi "
    "ON xmin <= bx1 AND xmax >= bx0 AND ymin <= by1 AND ymax >= by0 GROUP BY c_custkey",
    f=FILES, fi=FILE_INDEX))
def file_budget(spark, sf):
    index = published_index(published(spark, sf))
    out = J.files_for_boxes(V.boxes(spark, sf), index, 4 * V.CELL, "c_custkey", budget=6)
    return out.select("c_custkey", "files", "refused")


@query("j7_two_step", with_(
    "hits hil", "SELECT o_orderkey, k AS zone_id, file FROM hits JOIN f USING (k)", f=FILES))
def two_step(spark, sf):
    """The published set is stored by file; the index says which files a run of points needs to read."""
    root = workspace(spark, "published")
    L.write_units(published(spark, sf), root, ["file"])
    index = P.extent(L.scan(spark, root), "file")
    columns, hit = ["zone_id", "rings", "bbox"], ["o_orderkey", "zone_id", "file"]
    hits = L.two_step_scan(V.points(spark, sf), index, root, "file", V.CELL, columns, hit)
    return hits.select("o_orderkey", "zone_id", F.col("file").cast("bigint").alias("file"))


@query("j8_generated_points", with_(
    "z zk", "SELECT o_orderkey, state, xmin + ((o_orderkey * 48271) % 65536) / 65536.0::DOUBLE * (xmax - xmin) AS x, "
    "ymin + ((o_orderkey * 69621) % 65536) / 65536.0::DOUBLE * (ymax - ymin) AS y "
    "FROM orders JOIN ext ON o_orderkey % n = r",
    ext="SELECT *, dense_rank() OVER (ORDER BY state) - 1 AS r, count(*) OVER () AS n FROM (SELECT state, min(xmin) AS xmin, "
    "min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM z JOIN zk USING (k) GROUP BY state)"))
def generated_points(spark, sf):
    extents = P.extent(R.with_measures(V.zones(spark, sf)), "state")
    ids = V.table(spark, sf, "orders").select("o_orderkey")
    return J.spread_points(ids, extents, "state", "o_orderkey")


@query("t6_sample",
       "SELECT o_orderkey, x, y FROM (SELECT o_orderkey, (o_orderkey * 48271) % 16384 + 0.5::DOUBLE AS x, "
       "(o_orderkey * 69621) % 16384 + 0.25::DOUBLE AS y FROM orders) "
       "ORDER BY (o_orderkey * 48271 + 11) % 2147483647, o_orderkey LIMIT 100")
def sample(spark, sf):
    return P.sample_rows(V.points(spark, sf), 100, "o_orderkey")


@query("t7_probe", "SELECT 'MULTIPOLYGON' AS kind, count(*) > 0 AS present FROM (SELECT 1 FROM part LIMIT 1)")
def probe(spark, sf):
    one = V.zones_multi(spark, sf).limit(1)
    return one.groupBy(R.geometry_type(F.col("rings")).alias("kind")).agg(
        (F.count("*") > 0).alias("present")
    )


# ------------------------------------------------------------------ reports on cells and units
@query("a11_zones_by_state", with_(
    "silver", "SELECT state, risk, count(*) AS zones, count(*) FILTER (WHERE sfha) AS sfha_zones FROM silver GROUP BY ALL"))
def zones_by_state(spark, sf):
    from zoneloom.operators.subdivide import subdivide

    pieces = subdivide(V.silver(spark, sf), [*UNITS, "zone_id"], cap=6)
    return P.zones_by(pieces, "state", "risk")


@query("a14_refresh_footprint", with_(
    "zc zk", "SELECT state, county, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM "
    "(SELECT DISTINCT state, county, ci, cj FROM zc JOIN zk USING (k)) JOIN "
    "(SELECT ci, cj, count(*) * 100 AS bytes FROM zc GROUP BY ci, cj) USING (ci, cj) GROUP BY ALL"))
def refresh_footprint(spark, sf):
    cells = L.file_cells(measured_zones(spark, sf), V.CELL, V.DOMAIN, V.BITS)
    index = cells.groupBy("cell").agg((F.count("*") * 100).alias("bytes"))
    return P.refresh_footprint(cells, index)


@query("a15_cell_overlap", with_(
    "zc", "SELECT count(*) AS pieces, count(*) FILTER (WHERE n > 1) AS in_several, CAST(sum(n) AS BIGINT) AS filed_rows, max(n) AS most_cells, "
    "round(count(*) FILTER (WHERE n > 1) * 100 / count(*)::DOUBLE, 2) AS several_percent, "
    "round((sum(n) - count(*)) * 100 / count(*)::DOUBLE, 2) AS extra_percent FROM (SELECT k, count(*) AS n FROM zc GROUP BY k)"))
def cell_overlap(spark, sf):
    cells = L.file_cells(measured_zones(spark, sf), V.CELL, V.DOMAIN, V.BITS)
    return P.cell_overlap(cells, [*UNITS, "zone_id"])


@query("a18_index_summary", with_(
    "zk", "SELECT count(DISTINCT (state, county)) AS deliveries, count(DISTINCT state) AS states, count(*) AS zones FROM zk"))
def index_summary(spark, sf):
    index = L.file_index(spark, unit_layout(spark, sf))
    return P.index_summary(index).drop("bytes")


@query("a18_classes_in_frame", with_(
    "z silver", "SELECT risk, count(*) AS zones FROM silver JOIN z USING (k) WHERE xmin <= 9000 AND xmax >= 3000 "
    "AND ymin <= 7000 AND ymax >= 2500 GROUP BY risk"))
def classes_in_frame(spark, sf):
    return P.classes_in_frame(V.silver(spark, sf), FRAME)


# ------------------------------------------------------------------ layouts
@query("s1_layered_scan", with_(
    "zk", "SELECT state, county, count(*) AS zones, CAST(sum(k) AS BIGINT) AS keys FROM zk GROUP BY ALL"))
def layered_scan(spark, sf):
    rows = L.scan(spark, unit_layout(spark, sf), "*/*/*.parquet")
    return rows.groupBy(*UNITS).agg(F.count("*").alias("zones"), F.sum("zone_id").alias("keys"))


@query("s2_file_list_scan", with_(
    "zk", "SELECT state, county, count(*) AS zones FROM zk WHERE state IN ('MA', 'UT') GROUP BY ALL"))
def file_list_scan(spark, sf):
    """Only the folders that the index names are read; the list stays on the executors."""
    root = unit_layout(spark, sf)
    chosen = L.file_index(spark, root).where("state IN ('MA', 'UT')")
    return L.scan_chosen(spark, root, chosen, UNITS).groupBy(*UNITS).agg(F.count("*").alias("zones"))


@query("s3_unit_row_keys", with_(
    "zk", "SELECT state, county, count(*) AS rows, count(*) AS keys, CAST(0 AS BIGINT) AS first, count(*) - 1 AS last, "
    "count(*) > 7 AS several_files FROM zk GROUP BY ALL"))
def unit_row_keys(spark, sf):
    """Row keys of units that are spread over several files: gapless within the unit."""
    root = workspace(spark, "units")
    L.write_units(measured_zones(spark, sf), root, order=["zone_id"], rows_per_file=7)
    rows = L.scan_numbered(spark, root)
    files = L.partition_files(spark, root, UNITS).groupBy(*UNITS).agg(F.count("*").alias("files"))
    keys = rows.groupBy(*UNITS).agg(
        F.count("*").alias("rows"), F.count_distinct("file_row_number").alias("keys"),
        F.min("file_row_number").alias("first"), F.max("file_row_number").alias("last"),
    )
    return keys.join(files, UNITS).select(*UNITS, "rows", "keys", "first", "last", (F.col("files") > 1).alias("several_files"))


@query("s4_replace_one_unit", with_(
    "zk", "SELECT state, county, count(*) AS zones, CAST(sum(k) AS BIGINT) AS keys FROM zk "
    "WHERE NOT (state = 'LA' AND county = 'Unit 1' AND k % 4 = 1) GROUP BY ALL"))
def replace_one_unit(spark, sf):
    root = unit_layout(spark, sf)
    one = measured_zones(spark, sf).where("state = 'LA' AND county = 'Unit 1' AND zone_id % 4 <> 1")
    L.replace_units(one, root)
    spark.catalog.refreshByPath(root)
    return L.scan(spark, root).groupBy(*UNITS).agg(
        F.count("*").alias("zones"), F.sum("zone_id").alias("keys")
    )


@query("a17_table_size", "SELECT count(*) AS rows, true AS has_bytes, true AS has_files FROM part")
def table_size(spark, sf):
    size = L.table_size(spark, unit_layout(spark, sf))
    return size.select(
        "rows", (F.col("bytes") > 0).alias("has_bytes"), (F.col("files") > 0).alias("has_files")
    )


@query("s5_cell_layout", with_(
    "zc", "SELECT concat(ci, '_', cj) AS cell, count(*) AS rows, CAST(1 AS BIGINT) AS files, true AS in_order FROM zc GROUP BY ci, cj"))
def cell_layout_query(spark, sf):
    root = cell_layout(spark, sf)
    rows = L.scan(spark, root).select(
        "cell", "hilbert", F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.row_index").alias("row"),
    )
    before = F.lag("hilbert").over(W.partitionBy("path").orderBy("row"))
    stepped = rows.withColumn("falls", F.coalesce(F.col("hilbert") < before, F.lit(False)))
    return stepped.groupBy("cell").agg(
        F.count("*").alias("rows"), F.count_distinct("path").alias("files"),
        (~F.bool_or("falls")).alias("in_order"),
    )


@query("s5_hot_cells_spread", with_(
    "zc", "SELECT concat(ci, '_', cj) AS cell, count(*) AS rows, CAST(ceil(count(*) / 8.0) AS BIGINT) AS files FROM zc GROUP BY ci, cj"))
def hot_cells_spread(spark, sf):
    """Cells above eight rows take several files; the others keep to one."""
    root = workspace(spark, "hot-cells")
    L.write_cells(
        measured_zones(spark, sf), root, 2 * V.CELL // 2, V.DOMAIN, V.BITS, rows_per_file=8
    )
    return L.cell_index(spark, root).select("cell", "rows", "files")


@query("s6_global_hilbert_layout",
       "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS falls, true AS several_files, CAST(0 AS BIGINT) AS overlaps FROM part")
def global_hilbert_layout(spark, sf):
    root = workspace(spark, "global")
    L.write_global_order(measured_zones(spark, sf), root, V.DOMAIN, V.BITS, files=4)
    rows = spark.read.parquet(root).select(
        "hilbert", F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.row_index").alias("row"),
    )
    before = F.lag("hilbert").over(W.partitionBy("path").orderBy("row"))
    per_file = rows.withColumn("falls", (F.col("hilbert") < before).cast("int")).groupBy("path").agg(
        F.count("*").alias("rows"), F.sum("falls").alias("falls"),
        F.min("hilbert").alias("lo"), F.max("hilbert").alias("hi"),
    )
    # a handful of files, one row each
    previous = F.lag("hi").over(W.orderBy("lo", "hi"))
    return per_file.withColumn("overlap", F.col("lo") < previous).agg(
        F.sum("rows").alias("rows"), F.sum("falls").alias("falls"),
        (F.count("*") > 1).alias("several_files"), F.count_if("overlap").alias("overlaps"),
    )


@query("s13_cell_index", with_(
    "zc z", "SELECT concat(ci, '_', cj) AS cell, count(*) AS rows, CAST(1 AS BIGINT) AS files, min(xmin) AS xmin, min(ymin) AS ymin, "
    "max(xmax) AS xmax, max(ymax) AS ymax FROM zc JOIN z USING (k) GROUP BY ci, cj"))
def cell_index(spark, sf):
    index = L.cell_index(spark, cell_layout(spark, sf))
    stored = workspace(spark, "cell-index")
    L.write_cell_index(index, stored, V.CELL)
    return spark.read.schema(index.schema).json(stored).select("cell", "rows", "files", "bbox.*")


@query("s14_file_index", with_(
    "z zk", "SELECT state, county, count(*) AS rows, true AS sized, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax "
    "FROM z JOIN zk USING (k) GROUP BY state, county"))
def file_index(spark, sf):
    index = L.file_index(spark, unit_layout(spark, sf))
    return index.select("state", "county", "rows", (F.col("bytes") > 0).alias("sized"), "bbox.*")


@query("s15_footer_audit",
       "SELECT count(*) AS rows, true AS within_group, true AS zstd, 'v1' AS layout FROM part "
       "UNION ALL SELECT count(*), true, true, 'global' FROM part")
def footer_audit(spark, sf):
    """Rows by file of the written layers against their limit, and the codec that the writer puts in the file names."""
    units, whole = workspace(spark, "units"), workspace(spark, "global")
    L.write_units(measured_zones(spark, sf), units, rows_per_file=50)
    L.write_global_order(measured_zones(spark, sf), whole, V.DOMAIN, V.BITS, files=4, maxRecordsPerFile="500")
    out = None
    for name, root, most in (("v1", units, 50), ("global", whole, 500)):
        path = F.col("_metadata.file_path")
        files = spark.read.parquet(root).groupBy(path.alias("path")).agg(F.count("*").alias("rows"))
        audit = files.agg(
            F.sum("rows").alias("rows"),
            (F.max("rows") <= most).alias("within_group"),
            F.bool_and(F.col("path").contains(".zstd.")).alias("zstd"),
            F.lit(name).alias("layout"),
        )
        out = audit if out is None else out.unionByName(audit)
    return out
