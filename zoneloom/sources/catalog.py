"""Catalog records out of portal pages, and reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneloom.functions import text as X

# fixed value: what a delivery link contains
LINK_MARKER = "Download/ProductsDownLoadServlet"


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every ``<a href="..">`` of a page with its 0-based ``position``."""
    keep = [c for c in pages.columns if c != html]
    found = F.regexp_extract_all(F.col(html), F.lit(r'<a[^>]+href="([^"]+)"'), F.lit(1))
    return pages.select(*keep, F.posexplode(found).alias("position", "href"))


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by ``order``; combines before the shuffle, so hot keys are cheap."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
    return picked.select(*[F.col(k) if k in keys else F.col(f"_row.{k}") for k in df.columns])


def download_rows(pages: DataFrame, html: str = "html", marker: str = LINK_MARKER) -> DataFrame:
    """``href, size_text, position`` of the marked links, taken table row by table row."""
    keep = [c for c in pages.columns if c != html]
    rows = pages.select(
        *keep,
        F.posexplode(
            F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
        ).alias("row_no", "row_html"),
    )
    cells = F.transform(
        F.regexp_extract_all("row_html", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)),
        lambda td: F.trim(F.regexp_replace(td, r"(?s)<[^>]*>", "")),
    )
    sizes = F.filter(cells, lambda c: X.size_mb(c).isNotNull())
    hrefs = F.filter(
        F.regexp_extract_all(
            "row_html", F.lit(r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"]*?)["'][\s>]"""), F.lit(1)
        ),
        lambda h: F.contains(h, F.lit(marker)),
    )
    return rows.select(
        *keep, "row_no", F.get(sizes, F.lit(0)).alias("size_text"),
        F.posexplode(hrefs).alias("link_no", "href"),
    ).withColumn("href", F.replace("href", F.lit("&amp;"), F.lit("&")))


def catalog_records(
    links: DataFrame,
    base_url: str,
    position: Column,
    state: str | None = None,
    county: str | None = None,
    county_wide_only: bool = True,
) -> DataFrame:
    """One record per (state, county): incomplete, unknown and repeated links are left out."""
    url = F.concat(F.lit(base_url), F.col("href"))
    fields = links.select(
        position.alias("position"),
        "size_text",
        url.alias("raw_url"),
        X.url_param(url, "DFIRMID").alias("id"),
        X.url_param(url, "state").alias("state_text"),
        X.url_param(url, "county").alias("county_text"),
        X.url_param(url, "fileName").alias("file_name"),
    ).where("id IS NOT NULL AND state_text IS NOT NULL AND county_text IS NOT NULL")
    codes = X.state_codes(links.sparkSession)
    records = (
        fields.join(
            F.broadcast(codes), F.upper(F.trim("state_text")) == F.col("state_name"), "inner"
        )
        .select(
            "position",
            "state",
            X.clean_county(F.col("county_text")).alias("county"),
            F.trim("county_text").alias("county_raw"),
            F.trim("id").alias("dfirm_id"),
            X.is_county_wide(F.col("id")).alias("county_wide"),
            X.delivery_date(F.col("file_name")).alias("fema_update_date"),
            X.size_mb(F.col("size_text")).alias("zip_size_mb"),
            X.base_name(F.col("file_name")).alias("zip_name"),
            X.encode_spaces(F.col("raw_url")).alias("url"),
        )
        .where("fema_update_date IS NOT NULL")
    )
    if county_wide_only:
        records = records.where("county_wide")
    if state:
        records = records.where(X.same_text(F.col("state"), state))
    if county:
        records = records.where(X.same_text(F.col("county"), county))
    return first_per_key(records, ["state", "county"], "position").drop("position")


def catalog_sizing(records: DataFrame) -> DataFrame:
    """Per state: county-wide deliveries, their MB, community rows and the largest delivery."""
    wide = F.col("county_wide")
    size = F.when(wide, F.coalesce("zip_size_mb", F.lit(0.0)))
    return records.groupBy("state").agg(
        F.count_if(wide).alias("county_wide"),
        F.round(F.sum(size), 3).alias("mb"),
        F.count_if(~wide).alias("community"),
        # ties go to the first name
        F.min_by("county", F.when(wide, F.struct(-size, F.col("county")))).alias("largest"),
        F.max(size).alias("largest_mb"),
    )


def catalog_facts(records: DataFrame, reference_date: Column, ages=(30, 90, 365)) -> DataFrame:
    """Totals, date span and the deliveries of the last n days, in one row."""
    recent = [
        F.count_if(F.col("fema_update_date") >= F.date_sub(reference_date, n)).alias(f"last_{n}")
        for n in ages
    ]
    return records.agg(
        F.count("*").alias("deliveries"),
        F.count_distinct("state").alias("states"),
        F.round(F.sum("zip_size_mb"), 3).alias("mb"),
        F.min("fema_update_date").alias("oldest"),
        F.max("fema_update_date").alias("newest"),
        *recent,
    )


def deliveries_by_date(records: DataFrame) -> DataFrame:
    """What changed last: deliveries per date, newest first."""
    return (
        records.groupBy("fema_update_date")
        .agg(F.count("*").alias("deliveries"), F.min("county").alias("first_county"))
        .orderBy(F.desc("fema_update_date"))
    )
