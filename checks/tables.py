"""Normalization, catalog, control table and reports."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks import views as V
from checks.registry import query
from checks.sql import with_
from zoneloom.functions import rings as R
from zoneloom.functions import text as X
from zoneloom.operators import control as K
from zoneloom.operators import normalize as N
from zoneloom.operators import reports as P
from zoneloom.operators import validity as Q
from zoneloom.plans.stages import build_silver
from zoneloom.session import workspace
from zoneloom.sources import archive as A
from zoneloom.sources import catalog as C

SILVER = ("state, county, fema_update_date, zone_id, source_feature_id, dfirm_id, flood_zone, "
          "zone_subtype, sfha, static_bfe, dual_zone, risk, floodplain, subzone")


# ------------------------------------------------------------------ normalization
@query("s3_zone_id_from_row_index",
       "SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS zone_id, p_partkey, p_name FROM part")
def zone_id_from_row_index(spark, sf):
    rows = N.with_row_number(V.table(spark, sf, "part"))
    return rows.select(F.col("file_row_number").alias("zone_id"), "p_partkey", "p_name")


@query("s8_bronze_enrich", with_(
    "bronze", "SELECT state, county, fema_update_date, count(*) AS rows, true AS loaded, "
    "CAST(sum(k) AS BIGINT) AS keys FROM bronze GROUP BY ALL"))
def bronze_enrich(spark, sf):
    raw = V.bronze(spark, sf)
    layer = raw.drop("state", "county", "fema_update_date")
    exprs = {n: F.expr(V.BRONZE[n]) for n in ("state", "county", "fema_update_date")}
    rows = A.enrich_bronze(layer, **exprs)
    return rows.groupBy("state", "county", "fema_update_date").agg(
        F.count("*").alias("rows"),
        F.bool_and(F.col("ingested_at").isNotNull()).alias("loaded"),
        F.sum("k").alias("keys"),
    )


@query("p1_normalize_zones", with_("silver", f"SELECT {SILVER} FROM silver"))
def normalize_zones(spark, sf):
    return N.normalize(V.bronze(spark, sf))


@query("p12_show_sql", with_("silver", f"SELECT {SILVER} FROM silver"))
def show_sql(spark, sf):
    """The mapping as text, run as it reads."""
    return spark.sql(N.mapping_sql(N.ZONE_MAPPING, "{bronze}"), bronze=V.bronze(spark, sf))


@query("p3_null_if_default", with_(
    "bronze", "SELECT k, nullif(nullif(k % 6, 2), 4) AS code, "
    "coalesce(nullif(k % 4, 0), 77) AS filled, "
    "coalesce(CASE WHEN trim(ZONE_SUBTY) <> '' THEN trim(ZONE_SUBTY) END, 'it' || chr(39) || 's none') AS subtype "
    "FROM bronze"))
def null_if_default(spark, sf):
    mapping = {
        "srid": 4269, "context": ["k"], "derived": [],
        "columns": [
            {"name": "code", "type": "bigint", "expr": "k % 6", "null_if": [2, 4]},
            {"name": "filled", "type": "bigint", "expr": "k % 4", "null_if": [0], "default": 77},
            {"name": "subtype", "type": "string", "expr": "trim(ZONE_SUBTY)", "null_if": [""],
             "default": "it's none"},
        ],
    }
    return N.normalize(V.bronze(spark, sf), mapping)


@query("p8_risk_counts", with_(
    "silver", "SELECT risk, count(*) AS zones, count(subzone) AS subzones, "
    "count(*) FILTER (WHERE floodplain) AS floodplain_zones FROM silver GROUP BY risk"))
def risk_counts(spark, sf):
    return V.silver(spark, sf).groupBy("risk").agg(
        F.count("*").alias("zones"), F.count("subzone").alias("subzones"),
        F.count_if("floodplain").alias("floodplain_zones"),
    )


@query("p14_hide_minimal", with_(
    "silver", "SELECT k AS zone_id, risk FROM silver WHERE risk <> 'minimal'"))
def hide_minimal(spark, sf):
    return V.silver(spark, sf).where("risk <> 'minimal'").select(
        F.col("zone_id").cast("bigint").alias("zone_id"), "risk"
    )


@query("p11_star_minus", with_(
    "bronze", "SELECT * EXCLUDE (k, file_row_number, state, county, fema_update_date) FROM bronze"))
def star_minus(spark, sf):
    return V.bronze(spark, sf).drop(
        "k", "file_row_number", "state", "county", "fema_update_date", "rings"
    )


@query("p16_extra_derived", with_(
    "silver", "SELECT zone_id, CASE WHEN flood_zone = 'AE' THEN static_bfe END AS bfe_ft FROM silver"))
def extra_derived(spark, sf):
    more = {"name": "bfe_ft", "type": "double", "sql": "CASE WHEN flood_zone = 'AE' THEN static_bfe END"}
    mapping = {**N.ZONE_MAPPING, "derived": [*N.ZONE_MAPPING["derived"], more]}
    return N.normalize(V.bronze(spark, sf), mapping).select("zone_id", "bfe_ft")


@query("p15_stage_counts", with_(
    "zk", "SELECT state, county, count(*) AS silver_rows, "
    "count(*) FILTER (WHERE k % 8 <> 0) AS silver_invalid_fixed FROM zk GROUP BY ALL"))
def stage_counts(spark, sf):
    units = V.zones(spark, sf).select("zone_id", "state", "county")
    raw = units.join(V.broken(spark, sf), "zone_id")
    # a bow-tie shows only through its crossing edges; repair keeps every row, in one of two frames
    good, quarantine = Q.repair_zones(raw, ["zone_id"])
    silver = good.unionByName(quarantine.drop("defect"))
    return P.stage_counts(Q.with_defect(raw, ["zone_id"]), silver, F.col("defect") != "none")


@query("p15_observed_counts", with_(
    "zk", "SELECT count(*) AS rows, count(*) FILTER (WHERE k % 8 IN (1, 2, 3, 4, 5)) AS repaired, "
    "count(*) FILTER (WHERE k % 8 IN (4, 6, 7)) AS failed, count(*) FILTER (WHERE k % 8 NOT IN (4, 6, 7)) AS written FROM zk"))
def observed_counts(spark, sf):
    """Counts taken by the job that repairs, beside the rows of the layer it wrote."""
    shapes = V.broken(spark, sf).withColumnRenamed("zone_id", "k")
    rows = V.bronze(spark, sf).drop("rings").join(shapes, "k").drop("k")
    root, counts = workspace(spark, "silver"), Observation("repair")
    build_silver(rows, root, counts=counts)
    seen = [F.lit(counts.get[n]).cast("bigint").alias(n) for n in ("rows", "repaired", "failed")]
    return spark.read.parquet(root).agg(F.count("*").alias("written")).select(*seen, "written")


# ------------------------------------------------------------------ catalog
@query("s16_catalog_links",
       "SELECT page_id, href, min(pos) - 1 AS first_position, count(*) AS times FROM ("
       "SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) AS pos FROM ("
       "SELECT page_id, regexp_extract_all(html, '<a[^>]+href=\"([^\"]+)\"', 1) AS l FROM pages)) "
       "GROUP BY page_id, href")
def catalog_links(spark, sf):
    links = C.page_links(V.table(spark, sf, "pages").select("page_id", "html"))
    return links.groupBy("page_id", "href").agg(
        F.min("position").cast("bigint").alias("first_position"), F.count("*").alias("times")
    )


@query("w3_first_link_per_target",
       "SELECT href, page_id, url FROM (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_id, pos) AS rn FROM ("
       "SELECT page_id, url, unnest(l) AS href, generate_subscripts(l, 1) AS pos FROM ("
       "SELECT page_id, url, regexp_extract_all(html, '<a[^>]+href=\"([^\"]+)\"', 1) AS l FROM pages))) WHERE rn = 1")
def first_link_per_target(spark, sf):
    links = C.page_links(V.table(spark, sf, "pages"))
    ordered = links.withColumn("at", F.struct("page_id", "position")).drop("position")
    return C.first_per_key(ordered, ["href"], "at").drop("at")


RECORD = ("state, county, county_raw, dfirm_id, county_wide, fema_update_date, zip_size_mb, "
          "zip_name, url")


@query("s16_catalog_records", with_("wide", f"SELECT {RECORD} FROM wide"))
def catalog_records(spark, sf):
    return V.catalog(spark, sf)


@query("f1_url_fields", with_(
    "portal", "SELECT k, id AS dfirm_id, trim(state_name) AS state_name, county_name, "
    "concat(id, '_', ymd, '.zip') AS file_name, "
    "replace(concat('http://h/Download/P?DFIRMID=', id, '&county=', county_name), ' ', '%20') AS encoded, "
    "concat(id, '_', ymd, '.zip') AS base FROM portal"))
def url_fields(spark, sf):
    url = F.concat(
        F.lit("http://h/Download/P?DFIRMID="), "id", F.lit("&state="), "state_name",
        F.lit("&county="), "county_name", F.lit("&fileName="), "id", F.lit("_"), "ymd", F.lit(".zip"),
    )
    short = F.concat(F.lit("http://h/Download/P?DFIRMID="), "id", F.lit("&county="), "county_name")
    path = F.concat(F.lit("some/folder/"), "id", F.lit("_"), "ymd", F.lit(".zip"))
    return V.portal(spark, sf).select(
        "k",
        X.url_param(url, "DFIRMID").alias("dfirm_id"),
        X.url_param(url, "state").alias("state_name"),
        X.url_param(url, "county").alias("county_name"),
        X.url_param(url, "fileName").alias("file_name"),
        X.encode_spaces(short).alias("encoded"),
        X.base_name(path).alias("base"),
    )


@query("f2_delivery_date", with_(
    "portal", "SELECT k, CASE WHEN k % 7 <> 0 THEN CAST(strptime(ymd, '%Y%m%d') AS DATE) END AS delivered FROM portal"))
def delivery_date(spark, sf):
    ending = F.when(F.col("k") % 7 == 0, F.lit(".tar")).otherwise(F.lit(".zip"))
    return V.portal(spark, sf).select(
        "k", X.delivery_date(F.concat("id", F.lit("_"), "ymd", ending)).alias("delivered")
    )


@query("f3_size_mb", with_(
    "portal", "SELECT k, size_text, CASE WHEN k % 3 = 0 THEN CAST(1 + k % 90 AS DOUBLE) "
    "WHEN k % 3 = 1 THEN CAST(1536 AS DOUBLE) ELSE (100 + k % 900) / CAST(1024 AS DOUBLE) END AS mb FROM portal"))
def size_mb(spark, sf):
    mixed = F.when(F.col("k") % 2 == 0, F.lower("size_text")).otherwise(F.col("size_text"))
    return V.portal(spark, sf).select("k", "size_text", X.size_mb(mixed).alias("mb"))


@query("f4_state_code", with_(
    "portal", "SELECT k, CASE state_name WHEN 'MASSACHUSETTS' THEN 'MA' WHEN 'LOUISIANA' THEN 'LA' "
    "WHEN 'UTAH' THEN 'UT' WHEN 'PUERTO RICO' THEN 'PR' ELSE 'NY' END AS state FROM portal "
    "WHERE state_name <> 'ATLANTIS'"))
def state_code(spark, sf):
    codes = F.broadcast(X.state_codes(spark))
    return V.portal(spark, sf).join(codes, "state_name").select("k", "state")


@query("f5_clean_county", with_(
    "portal", "SELECT k, CASE k % 4 WHEN 0 THEN concat('St. Tammany ', k) "
    "WHEN 1 THEN concat('O', chr(39), 'Brien ', k) WHEN 2 THEN 'X-Ray Territory-Wide' "
    "ELSE concat('Town Of N', k) END AS county, k % 4 <> 3 AS county_wide FROM portal"))
def clean_county(spark, sf):
    return V.portal(spark, sf).select(
        "k", X.clean_county(F.col("county_name")).alias("county"),
        X.is_county_wide(F.col("id")).alias("county_wide"),
    )


@query("f10_ci_filter", with_("wide", f"SELECT {RECORD} FROM wide WHERE state = 'LA'"))
def ci_filter(spark, sf):
    return V.catalog(spark, sf, state="la")


@query("a12_catalog_sizing", with_(
    "listed", "SELECT state, count(*) FILTER (WHERE county_wide) AS county_wide, "
    "round(sum(CASE WHEN county_wide THEN zip_size_mb END), 3) AS mb, "
    "count(*) FILTER (WHERE NOT county_wide) AS community, "
    "arg_min(county, rk) AS largest, max(CASE WHEN county_wide THEN zip_size_mb END) AS largest_mb FROM ("
    "SELECT *, CASE WHEN county_wide THEN row_number() OVER (PARTITION BY state, county_wide "
    "ORDER BY zip_size_mb DESC, county) END AS rk FROM listed) GROUP BY state"))
def catalog_sizing(spark, sf):
    return C.catalog_sizing(V.catalog(spark, sf, county_wide_only=False))


@query("a13_deliveries_by_age", with_(
    "wide", "SELECT count(*) AS deliveries, count(DISTINCT state) AS states, "
    "round(sum(zip_size_mb), 3) AS mb, min(fema_update_date) AS oldest, max(fema_update_date) AS newest, "
    "count(*) FILTER (WHERE fema_update_date >= DATE '2020-06-30' - 30) AS last_30, "
    "count(*) FILTER (WHERE fema_update_date >= DATE '2020-06-30' - 90) AS last_90, "
    "count(*) FILTER (WHERE fema_update_date >= DATE '2020-06-30' - 365) AS last_365 FROM wide"))
def deliveries_by_age(spark, sf):
    return C.catalog_facts(V.catalog(spark, sf), F.lit("2020-06-30").cast("date"))


@query("k16_newest", with_(
    "wide", "SELECT fema_update_date, count(*) AS deliveries, min(county) AS first_county FROM wide GROUP BY 1"))
def newest(spark, sf):
    return C.deliveries_by_date(V.catalog(spark, sf))


# ------------------------------------------------------------------ control table
LOG = ("state, county, fema_update_date, source_url, dfirm_id, zip_size_mb, zip_name, bronze_path, "
       "bronze_rows, bronze_at, silver_rows, subdivided_rows, status, error, error_at")
LOG_COLUMNS = LOG.split(", ")


def _upsert(known_only: bool) -> str:
    return with_(
        "log feed",
        "SELECT state, county, greatest(f.fema_update_date, l.fema_update_date) AS fema_update_date, "
        "coalesce(f.url, l.source_url) AS source_url, coalesce(f.dfirm_id, l.dfirm_id) AS dfirm_id, "
        "coalesce(f.zip_size_mb, l.zip_size_mb) AS zip_size_mb, coalesce(f.zip_name, l.zip_name) AS zip_name, "
        "bronze_path, bronze_rows, bronze_at, silver_rows, subdivided_rows, "
        "CASE WHEN l.status IS NULL OR f.fema_update_date > l.fema_update_date THEN 'new' ELSE l.status END AS status, "
        f"error, error_at FROM log l {'LEFT' if known_only else 'FULL'} JOIN feed f USING (state, county)",
    )


@query("k1_upsert", _upsert(False))
def upsert(spark, sf):
    return K.upsert(V.import_log(spark, sf), V.feed(spark, sf)).select(*LOG_COLUMNS)


@query("k3_update_only", _upsert(True))
def update_only(spark, sf):
    return K.upsert(V.import_log(spark, sf), V.feed(spark, sf), update_only=True).select(*LOG_COLUMNS)


@query("k2_counters", with_(
    "log feed", "SELECT count(*) FILTER (WHERE l.state IS NULL) AS inserted, "
    "count(*) FILTER (WHERE l.state IS NOT NULL) AS updated, "
    "count(*) FILTER (WHERE f.fema_update_date > l.fema_update_date) AS newer "
    "FROM feed f LEFT JOIN log l ON f.state = l.state AND f.county = l.county"))
def counters(spark, sf):
    return K.upsert_counters(V.import_log(spark, sf), V.feed(spark, sf))


@query("k4_worklist", with_(
    "log", "SELECT 'next' AS mode, state, county, fema_update_date, source_url FROM log WHERE status = 'bronze' "
    "UNION ALL SELECT 'force', state, county, fema_update_date, source_url FROM log WHERE state = 'LA' "
    "UNION ALL SELECT 'loaded', state, county, fema_update_date, source_url FROM log "
    "WHERE status = 'new' AND bronze_at IS NOT NULL"))
def worklist(spark, sf):
    log = V.import_log(spark, sf)
    tag = lambda mode, df: df.select(F.lit(mode).alias("mode"), "*")
    return (
        tag("next", K.worklist(log, "silver"))
        .unionByName(tag("force", K.worklist(log, "silver", state="LA", force=True)))
        .unionByName(tag("loaded", K.worklist(log, "bronze", loaded_only=True)))
    )


@query("k5_mark_results", with_(
    "log", "SELECT state, county, CASE WHEN hit AND n % 3 <> 0 THEN 500 + k ELSE bronze_rows END AS bronze_rows, "
    "CASE WHEN hit AND n % 3 <> 0 THEN 'bronze' ELSE status END AS status, "
    "CASE WHEN hit THEN CASE WHEN n % 3 = 0 THEN repeat('x', 500) END ELSE error END AS error, "
    "CASE WHEN hit THEN CASE WHEN n % 3 = 0 THEN TIMESTAMP '2026-02-01 00:00:00' END ELSE error_at END AS error_at "
    "FROM (SELECT *, status = 'new' AS hit FROM log)"))
def mark_results(spark, sf):
    def work(units):
        k = F.expr(V.ID_TO_K)
        log = V.import_log(spark, sf).select("state", "county", k.alias("k"))
        failed = F.floor(F.col("k") / 4) % 3 == 0
        return units.join(log, K.KEY).select(
            *K.KEY, (F.col("k") + 500).alias("bronze_rows"),
            F.when(failed, F.repeat(F.lit("x"), 600)).alias("error"),
            F.lit("2026-02-01 00:00:00").cast("timestamp").alias("error_at"),
        )

    done = K.run_stage(V.import_log(spark, sf), "bronze", work)
    return done.select(*K.KEY, "bronze_rows", "status", "error", "error_at")


@query("k7_completed", with_("log", "SELECT state, county FROM log WHERE status = 'subdivided'"))
def completed(spark, sf):
    return K.completed(V.import_log(spark, sf))


_RECONCILED = (
    "SELECT *, CASE WHEN n % 7 = 0 THEN 0 WHEN k % 6 = 0 THEN 1 ELSE 3 END AS have FROM log"
)
_RECONCILE = (
    "SELECT state, county, CASE WHEN have < s THEN ['new', 'bronze', 'silver', 'subdivided'][have + 1] ELSE status END AS status, "
    "CASE WHEN have < s THEN concat('reconcile: files for status ', status, ' missing') ELSE error END AS error, "
    "have < s AS downgraded FROM r"
)


@query("k8_reconcile", with_("log", _RECONCILE, r=_RECONCILED))
def reconcile(spark, sf):
    done = K.reconcile(V.import_log(spark, sf), V.inventory(spark, sf))
    return done.select(*K.KEY, "status", "error", "downgraded")


@query("k10_prune", with_(
    "log", "SELECT state, county, CASE WHEN bronze_at IS NULL AND state = 'MA' THEN 'removed' ELSE 'kept' END AS outcome FROM log"))
def prune(spark, sf):
    kept, removed = K.prune(V.import_log(spark, sf), "MA")
    tag = lambda df, name: df.select(*K.KEY, F.lit(name).alias("outcome"))
    return tag(kept, "kept").unionByName(tag(removed, "removed"))


@query("k13_added_column", with_(
    "log", "SELECT state, county, CAST(NULL AS VARCHAR) AS zip_name, CAST(NULL AS VARCHAR) AS bronze_crs, status FROM log"))
def added_column(spark, sf):
    older = V.import_log(spark, sf).drop("zip_name", "bronze_crs")
    return K.conform(older, K.empty_log(spark)).select(
        *K.KEY, "zip_name", "bronze_crs", "status"
    )


@query("k12_scope", with_(
    "log", "SELECT 'all' AS ask, state, county FROM log "
    "UNION ALL SELECT 'state', state, county FROM log WHERE state = 'PR' "
    "UNION ALL SELECT 'default', state, county FROM log WHERE state = 'UT' AND county = 'X-Ray Territory-Wide' "
    "UNION ALL SELECT 'named', state, county FROM log WHERE county IN ('St. Tammany 0', 'X-Ray Territory-Wide')"))
def scope(spark, sf):
    log = V.import_log(spark, sf)
    tag = lambda ask, df: df.select(F.lit(ask).alias("ask"), *K.KEY)
    return (
        tag("all", K.scope(log, all_states=True))
        .unionByName(tag("state", K.scope(log, "PR", whole_state=True)))
        .unionByName(tag("default", K.scope(log, "UT", defaults={"UT": ["X-Ray Territory-Wide"]})))
        .unionByName(tag("named", K.scope(log, counties=["St. Tammany 0", "X-Ray Territory-Wide"])))
    )


@query("a1_status_table", with_(
    "log", "SELECT state, status, count(*) AS counties, round(sum(zip_size_mb)) AS zip_mb, "
    "CAST(sum(bronze_rows) AS BIGINT) AS bronze_rows, CAST(sum(silver_rows) AS BIGINT) AS silver_rows, "
    "CAST(sum(subdivided_rows) AS BIGINT) AS subdivided_rows, "
    "round(CAST(sum(subdivided_rows) AS DOUBLE) / nullif(sum(silver_rows), 0), 1) AS ratio, count(error) AS errors "
    "FROM log GROUP BY 1, 2"))
def status_table(spark, sf):
    return K.status_report(V.import_log(spark, sf))


@query("a1_error_list", with_(
    "log", "SELECT state, county, status, error_at, error FROM log WHERE error IS NOT NULL"))
def error_list(spark, sf):
    return K.error_list(V.import_log(spark, sf))


@query("a5_never_loaded", with_(
    "log", "SELECT state, count(*) AS units FROM log WHERE bronze_at IS NULL GROUP BY state"))
def never_loaded(spark, sf):
    return K.never_loaded(V.import_log(spark, sf))


@query("t3_unit_listing", with_(
    "log", "SELECT state, county, fema_update_date, zip_size_mb, status FROM log"))
def unit_listing(spark, sf):
    return K.unit_listing(V.import_log(spark, sf))


@query("k14_listing_totals", with_(
    "log", "SELECT state, count(*) AS units, round(sum(zip_size_mb), 3) AS mb FROM log GROUP BY state"))
def listing_totals(spark, sf):
    return V.import_log(spark, sf).groupBy("state").agg(
        F.count("*").alias("units"), F.round(F.sum("zip_size_mb"), 3).alias("mb")
    )


@query("t4_smallest_two", with_(
    "log", "SELECT state, county, zip_size_mb, CAST(row_number() OVER (PARTITION BY state ORDER BY zip_size_mb NULLS LAST, county) AS INT) AS pick "
    "FROM log QUALIFY pick <= 2"))
def smallest_two(spark, sf):
    return K.smallest_units(V.import_log(spark, sf), 2)


@query("j9_load_differences", with_(
    "log", "SELECT state, county, 'missing' AS problem FROM log WHERE s = 3 AND k % 3 = 0 "
    "UNION ALL SELECT state, county, 'unexpected' FROM log WHERE s = 2 AND k % 3 = 1"))
def load_differences(spark, sf):
    log = V.import_log(spark, sf)
    k = F.expr(V.ID_TO_K)
    loaded = log.where(
        ((F.col("status") == "subdivided") & (k % 3 != 0))
        | ((F.col("status") == "silver") & (k % 3 == 1))
    )
    return P.load_differences(log, loaded)


@query("j10_missing_units", with_(
    "log feed", "SELECT state, county FROM feed EXCEPT SELECT state, county FROM log WHERE status = 'bronze'"))
def missing_units(spark, sf):
    waiting = K.worklist(V.import_log(spark, sf), "silver")
    return K.missing_units(V.feed(spark, sf), waiting)


@query("u1_key_difference", with_(
    "log feed", "SELECT state, county FROM log EXCEPT SELECT state, county FROM feed"))
def key_difference(spark, sf):
    return V.import_log(spark, sf).select(*K.KEY).subtract(V.feed(spark, sf).select(*K.KEY))


# ------------------------------------------------------------------ reports
@query("a2_validation_report", with_(
    "log silver zk", "SELECT (SELECT count(*) FROM silver) AS rows, CAST(0 AS BIGINT) AS invalid, "
    "(SELECT count(*) FROM silver WHERE risk IS NULL) AS null_risk, "
    "(SELECT count(DISTINCT (state, county)) FROM zk) AS units, "
    "(SELECT count(*) FROM log WHERE s = 3) AS missing, "
    "(SELECT count(DISTINCT (state, county)) FROM zk) AS unexpected"))
def validation_report(spark, sf):
    invalid = Q.structural_defect(F.col("rings")) != "none"
    return P.validation_report(V.silver(spark, sf), V.import_log(spark, sf), invalid)


@query("a10_area_by_risk", with_(
    "silver za", "SELECT risk, area, round(area * 100 / sum(area) OVER (), 3) AS percent FROM ("
    "SELECT risk, sum(area) AS area FROM silver JOIN za USING (k) GROUP BY risk)"))
def area_by_risk(spark, sf):
    return P.area_by_risk(V.silver(spark, sf), R.area(F.col("rings")))
