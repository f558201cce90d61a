"""Zones, points, boxes, bronze rows and catalog pages derived from the driver tables.

Coordinates are integers or dyadic fractions, so doubles agree bit for bit between engines.
Attribute expressions are written once, in SQL both engines read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneloom.functions import rings as R
from zoneloom.functions.arrow_rings import ring_arrays
from zoneloom.operators import noding
from zoneloom.operators.normalize import normalize, with_row_number
from zoneloom.operators.validity import repair_rings
from zoneloom.session import ship_kernels, spread
from zoneloom.sources import catalog as C

SIDE = 16384
CELL = 512
BITS = 14
DOMAIN = (0.0, 0.0, float(SIDE), float(SIDE))
DX = [16, 11, 0, -11, -16, -11, 0, 11]
DY = [0, 11, 16, 11, 0, -11, -16, -11]
BASE_URL = "http://portal.example/data/"

# p_partkey AS k is in scope
STATE = (
    "CASE k % 5 WHEN 0 THEN 'MA' WHEN 1 THEN 'LA' WHEN 2 THEN 'UT' WHEN 3 THEN 'PR' ELSE 'NY' END"
)
COUNTY = (
    "CASE WHEN k % 10 = 0 THEN concat('Prince George', chr(39), 's') "
    "ELSE concat('Unit ', k % 10) END"
)
ZONE_CODES = ["A", "AE", "VE", "X", "X", "X", "A1-9", "A1-30", "A12", "AR/AE", "AREA NOT INCLUDED",
              "OPEN WATER", "D", "B", "C", " ae ", "AO", "AR"]
SUBTYPES = ["0.2 PCT ANNUAL CHANCE FLOOD HAZARD", "1 PCT FUTURE CONDITIONS",
            "AREA WITH REDUCED FLOOD RISK DUE TO LEVEE", "AREA OF MINIMAL FLOOD HAZARD",
            "FLOODWAY", "  "]


def _pick(key: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} {whens} END"


BRONZE = {
    "FLD_AR_ID": "concat('FA', k)",
    "DFIRM_ID": "concat(25000 + k % 30, 'C')",
    "FLD_ZONE": f"CASE WHEN k % 19 = 18 THEN NULL ELSE {_pick(f'k % {len(ZONE_CODES)}', ZONE_CODES)} END",
    "ZONE_SUBTY": f"CASE WHEN k % 7 = 6 THEN NULL ELSE {_pick(f'k % {len(SUBTYPES)}', SUBTYPES)} END",
    "SFHA_TF": "CASE k % 5 WHEN 0 THEN 'T' WHEN 1 THEN 'T' WHEN 2 THEN 'F' WHEN 3 THEN 'F' END",
    "STATIC_BFE": "CASE k % 4 WHEN 0 THEN '-9999' WHEN 1 THEN 'n/a' ELSE concat(k, '.125') END",
    "DUAL_ZONE": "CASE k % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' END",
    "state": STATE,
    "county": COUNTY,
    "fema_update_date": "make_date(CAST(2020 + k % 6 AS INT), CAST(1 + k % 12 AS INT), CAST(1 + k % 28 AS INT))",
}

# s_suppkey AS k is in scope
PORTAL = {
    "state_name": "CASE WHEN k % 11 = 10 THEN 'NEW YORK' WHEN k % 5 = 0 THEN 'MASSACHUSETTS' "
    "WHEN k % 5 = 1 THEN 'LOUISIANA' WHEN k % 5 = 2 THEN 'UTAH' WHEN k % 5 = 3 THEN 'PUERTO RICO' "
    "ELSE 'ATLANTIS' END",
    "county_name": "CASE k % 4 WHEN 0 THEN concat('ST. TAMMANY ', k, ' PARISH') "
    "WHEN 1 THEN concat('O', chr(39), 'BRIEN ', k, ' COUNTY') "
    "WHEN 2 THEN 'X-RAY TERRITORY-WIDE' ELSE concat(' TOWN OF N', k) END",
    "id": "CASE WHEN k % 4 = 3 THEN concat('25', 1000 + k) ELSE concat(10000 + k, 'C') END",
    "ymd": "concat('', (2000 + k % 26) * 10000 + (1 + k % 12) * 100 + (1 + k % 28))",
    "size_text": "CASE k % 3 WHEN 0 THEN concat(1 + k % 90, 'MB') WHEN 1 THEN '1.5GB' "
    "ELSE concat(100 + k % 900, 'KB') END",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def zone_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The key ``k`` of every zone, dealt out before geometry is made of it: a row of the table has a
    few bytes, so that its file has few splits, and the rings made of it have thousands."""
    return _behind(spread(table(spark, sf, "part").select(F.col("p_partkey").alias("k")), "k"))


def _behind(rows: DataFrame) -> DataFrame:
    """The same rows, but what is told of the geometry made of ``k`` stays behind their spreading: the planner would
    sink a filter on it (a join or an explode brings its own) into the few tasks of the scan."""
    return rows.withColumn("k", F.when(F.spark_partition_id() >= 0, F.col("k")))


def _vertex(at: int, name_x: str = "x", name_y: str = "y") -> list:
    """Vertex ``at`` of the star of key ``k``; ``at`` may run past the end."""
    at %= 8
    reach = (F.lit(1) + (F.col("k") * 31 + at * 17) % 7) * 4
    west, south = centre()
    return [
        (west + F.lit(DX[at]) * reach).cast("double").alias(name_x),
        (south + F.lit(DY[at]) * reach).cast("double").alias(name_y),
    ]


def star_ring():
    """The 8-vertex star of key ``k``, closed, counter-clockwise; its points are written out, so that they compile."""
    return F.array(*[F.struct(*_vertex(i)) for i in range(9)])


def fine_rings(steps: int = 64):
    """The star with every edge cut into equal steps: same shape, ``8 * steps`` vertices, made by the batch."""
    ship_kernels()

    @F.arrow_udf(R.RINGS_TYPE)
    def cut(rings: pa.Array) -> pa.Array:
        e, _ = noding.edges_by_row(*ring_arrays(rings)[:3])
        n, j, xy = len(rings), np.arange(steps), []
        for begin, end in ((e[:, 0], e[:, 2]), (e[:, 1], e[:, 3])):
            begin, end = begin.reshape(n, 8, 1), end.reshape(n, 8, 1)
            out = np.empty((n, 8 * steps + 1))
            for at in range(0, n, 256):  # few rows at a time stay in the cache
                b = begin[at : at + 256]
                out[at : at + 256, :-1] = (b + (end[at : at + 256] - b) * j / steps).reshape(len(b), 8 * steps)
            out[:, -1] = out[:, 0]  # the last cut is never the first vertex, so every ring is closed
            xy.append(pa.array(out.ravel()))
        points = pa.StructArray.from_arrays(xy, names=["x", "y"])
        each = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (8 * steps + 1)), points)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32)), each)

    return cut(F.array(star_ring()))


def square_ring(cx, cy, half: float, ccw: bool):
    corners = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
    if not ccw:
        corners = corners[::-1]
    return F.array(
        *[
            F.struct(
                (cx + a * half).cast("double").alias("x"), (cy + b * half).cast("double").alias("y")
            )
            for a, b in corners
        ]
    )


def centre():
    return (F.col("k") * 7919) % SIDE, (F.col("k") * 104729) % SIDE


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Raw attribute rows with the star as geometry."""
    rows = with_row_number(table(spark, sf, "part")).select(F.col("p_partkey").alias("k"), "file_row_number")
    rows = _behind(spread(rows, "k", "file_row_number"))
    named = [F.expr(sql).alias(name) for name, sql in BRONZE.items()]
    return rows.select("k", "file_row_number", *named, F.array(star_ring()).alias("rings"))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """Normalized zones with measures."""
    zones = normalize(bronze(spark, sf).withColumn("rings", repair_rings(F.col("rings"))),
                      geometry="rings")
    return R.with_measures(zones)


def zones(spark: SparkSession, sf: str) -> DataFrame:
    """The star zones without normalization: ``zone_id, state, county, rings``."""
    rows = zone_keys(spark, sf)
    return rows.select(
        F.col("k").alias("zone_id"),
        F.expr(STATE).alias("state"),
        F.expr(COUNTY).alias("county"),
        F.array(star_ring()).alias("rings"),
    )


def zones512(spark: SparkSession, sf: str) -> DataFrame:
    rows = zone_keys(spark, sf)
    return (
        rows.select(
            F.col("k").alias("zone_id"),
            F.expr(STATE).alias("state"),
            F.expr(COUNTY).alias("county"),
            fine_rings().alias("rings"),
        )
    )


def fine_squares(spark: SparkSession, sf: str, steps: int = 64) -> DataFrame:
    """Squares of side 128 with ``steps`` edges a side: what is cut from them can be counted by hand."""
    rows = zone_keys(spark, sf)
    cx, cy = centre()
    d = lambda v: v.cast("double")
    at = lambda i: F.least(F.greatest(i, F.lit(0)), F.lit(steps)) * (128 // steps) - 64
    # once round from the lower left: each coordinate rises along one side and falls along the opposite one
    ring = F.transform(
        F.sequence(F.lit(0), F.lit(4 * steps)),
        lambda i: F.struct(
            d(cx + F.when(i <= 2 * steps, at(i)).otherwise(at(3 * steps - i))).alias("x"),
            d(cy + F.when(i <= 2 * steps, at(i - steps)).otherwise(at(4 * steps - i))).alias("y"),
        ),
    )
    return rows.select(F.col("k").alias("zone_id"), F.expr(STATE).alias("state"), F.expr(COUNTY).alias("county"), F.array(ring).alias("rings"))


def zones_holes(spark: SparkSession, sf: str) -> DataFrame:
    """Stars with a square hole of side 8 round the centre."""
    rows = zone_keys(spark, sf)
    hole = square_ring(*centre(), 4, ccw=False)
    return rows.select(F.col("k").alias("zone_id"), F.array(star_ring(), hole).alias("rings"))


def zones_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Stars with a hole, and a second square of side 32 at a distance."""
    rows = zone_keys(spark, sf)
    cx, cy = centre()
    hole = square_ring(cx, cy, 4, ccw=False)
    second = square_ring(cx + 2000, cy, 16, ccw=True)
    return rows.select(
        F.col("k").alias("zone_id"), F.array(star_ring(), hole, second).alias("rings")
    )


def broken(spark: SparkSession, sf: str) -> DataFrame:
    """One defect class per zone, by ``k % 8``."""
    rows = zone_keys(spark, sf)
    ring = star_ring()
    cx, cy = centre()
    at = lambda dx, dy: F.struct(
        (cx + dx).cast("double").alias("x"), (cy + dy).cast("double").alias("y")
    )
    away = F.array(at(4000, 4000))
    bow = F.array(at(0, 0), at(64, 64), at(64, 0), at(0, 32), at(0, 0))
    shape = {
        0: F.array(ring),
        1: F.array(F.slice(ring, 1, 8)),
        2: F.array(F.concat(F.slice(ring, 1, 3), F.slice(ring, 3, 7))),
        3: F.array(F.concat(F.slice(ring, 1, 3), away, F.slice(ring, 3, 7))),
        4: F.array(F.slice(ring, 1, 2)),
        5: F.array(bow),
        6: F.array().cast(R.RINGS_TYPE),
    }
    rings = F
    for n, value in shape.items():
        rings = rings.when(F.col("k") % 8 == n, value)
    return rows.select(F.col("k").alias("zone_id"), rings.alias("rings"))


def points(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k,
        ((k * 48271) % SIDE + F.lit(0.5)).alias("x"),
        ((k * 69621) % SIDE + F.lit(0.25)).alias("y"),
    )


def boundary_points(spark: SparkSession, sf: str) -> DataFrame:
    """Every star vertex and edge middle, as points."""
    e = F.col("e")
    edges = zones(spark, sf).select("zone_id", F.posexplode(R.edges(F.col("rings"))).alias("n", "e"))
    return edges.select(
        F.col("zone_id").alias("of_zone"),
        "n",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("kind"), e["x1"].alias("x"), e["y1"].alias("y")),
                F.struct(
                    F.lit(1).alias("kind"),
                    ((e["x1"] + e["x2"]) / 2).alias("x"),
                    ((e["y1"] + e["y2"]) / 2).alias("y"),
                ),
            )
        ).alias("p"),
    ).select("of_zone", "n", "p.kind", "p.x", "p.y")


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """One viewport per customer."""
    k = F.col("c_custkey")
    x0, y0 = (k * 613) % SIDE, (k * 977) % SIDE
    side = 256 * (1 + k % 8)
    d = lambda c, n: c.cast("double").alias(n)
    return table(spark, sf, "customer").select(
        k,
        F.struct(d(x0, "xmin"), d(y0, "ymin"), d(x0 + side, "xmax"), d(y0 + side, "ymax")).alias(
            "vbox"
        ),
    )


def portal(spark: SparkSession, sf: str) -> DataFrame:
    """The facts that the portal pages print."""
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    return rows.select("k", *[F.expr(sql).alias(n) for n, sql in PORTAL.items()])


def portal_pages(spark: SparkSession, sf: str) -> DataFrame:
    """HTML pages of ten table rows, each row with the same link twice."""
    href = F.concat(
        F.lit("Download/ProductsDownLoadServlet?DFIRMID="), "id", F.lit("&amp;state="),
        "state_name", F.lit("&amp;county="), "county_name", F.lit("&amp;fileName="),
        F.concat("id", F.lit("_"), "ymd", F.lit(".zip")),
    )
    href = F.when(F.col("k") % 2 == 0, href).otherwise(
        F.replace(href, F.lit("&amp;"), F.lit("&"))
    )
    link = lambda body: F.concat(F.lit('<td><a href="'), href, F.lit('">'), body, F.lit("</a></td>"))
    row = F.concat(
        F.lit("<tr>"), link(F.lit('<img src="zip.png"/>')), link(F.col("county_name")),
        F.lit("<td>on file</td><td> "), "size_text", F.lit(" </td></tr>"),
    )
    return (
        portal(spark, sf)
        .select(F.floor(F.col("k") / 10).alias("page_no"), "k", row.alias("row"))
        .groupBy("page_no")
        .agg(F.array_sort(F.collect_list(F.struct("k", "row"))).alias("rows"))
        .select(
            "page_no",
            F.concat(
                F.lit("<html><body><table>"),
                F.array_join(F.transform("rows", lambda r: r["row"]), "\n"),
                F.lit("</table><a href='about.html'>about</a></body></html>"),
            ).alias("html"),
        )
    )


def catalog(spark: SparkSession, sf: str, **options) -> DataFrame:
    """Catalog records read back from the pages."""
    links = C.download_rows(portal_pages(spark, sf))
    position = F.col("page_no") * 1_000_000 + F.col("row_no") * 100 + F.col("link_no")
    return C.catalog_records(links, BASE_URL, position, **options)


ID_TO_K = (
    "CASE WHEN dfirm_id LIKE '%C' THEN CAST(replace(dfirm_id, 'C', '') AS BIGINT) - 10000 "
    "ELSE CAST(substring(dfirm_id, 3) AS BIGINT) - 1000 END"
)
# n = floor(k / 4) and s = stage number are in scope
LOG = {
    "bronze_path": "CASE WHEN s >= 1 THEN concat('bronze/', k) END",
    "bronze_rows": "CASE WHEN s >= 1 THEN 100 + k END",
    "bronze_at": "CASE WHEN s >= 1 OR n % 8 = 0 THEN TIMESTAMP '2026-01-01 06:00:00' END",
    "silver_rows": "CASE WHEN s >= 2 THEN 90 + k END",
    "subdivided_rows": "CASE WHEN s >= 3 THEN 270 + 7 * k END",
    "error": "CASE WHEN n % 9 = 0 THEN concat('boom ', k) END",
    "error_at": "CASE WHEN n % 9 = 0 THEN TIMESTAMP '2026-01-02 07:00:00' END",
    "status": "CASE s WHEN 0 THEN 'new' WHEN 1 THEN 'bronze' WHEN 2 THEN 'silver' ELSE 'subdivided' END",
}
INVENTORY = {
    "bronze": "n % 7 <> 0",
    "silver": "k % 6 <> 0",
    "subdivided": "true",
}
FEED_KEEP = "CASE WHEN county_wide THEN n % 2 = 0 ELSE n % 5 = 0 END"


def _numbered(records: DataFrame) -> DataFrame:
    return records.withColumn("k", F.expr(ID_TO_K)).withColumn(
        "n", F.floor(F.col("k") / 4).cast("bigint")
    ).withColumn("s", F.col("n") % 4)


def import_log(spark: SparkSession, sf: str) -> DataFrame:
    """A control table half-way through its stages."""
    from zoneloom.operators.control import conform, empty_log

    rows = _numbered(catalog(spark, sf))
    rows = rows.select(
        "state", "county", "fema_update_date", F.col("url").alias("source_url"), "dfirm_id",
        "zip_size_mb", "zip_name", *[F.expr(sql).alias(c) for c, sql in LOG.items()],
    )
    return conform(rows, empty_log(spark))


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """A later catalog: older, equal and newer deliveries, and units not known yet."""
    rows = _numbered(catalog(spark, sf, county_wide_only=False)).where(FEED_KEEP)
    shift = ((F.col("k") % 3 - 1) * 12).cast("int")
    return rows.withColumns(
        {
            "fema_update_date": F.add_months("fema_update_date", shift),
            "url": F.concat("url", F.lit("&again")),
            "zip_size_mb": F.col("zip_size_mb") + 1,
        }
    ).drop("k", "n", "s")


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Files that exist, by unit and stage."""
    rows = _numbered(catalog(spark, sf))
    out = None
    for stage, keep in INVENTORY.items():
        part = rows.where(keep).select("state", "county", F.lit(stage).alias("stage"))
        out = part if out is None else out.unionByName(part)
    return out
