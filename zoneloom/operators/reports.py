"""Reports over zones, pieces, cells and measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneloom.functions import rings as R
from zoneloom.operators.control import KEY, completed

PIECE = ["state", "county", "zone_id", "piece_id"]


def extent(df: DataFrame, *by: str, box: str = "bbox") -> DataFrame:
    """Joint bounding box, overall or per group."""
    b = F.col(box)
    return df.groupBy(*by).agg(
        F.struct(
            F.min(b["xmin"]).alias("xmin"),
            F.min(b["ymin"]).alias("ymin"),
            F.max(b["xmax"]).alias("xmax"),
            F.max(b["ymax"]).alias("ymax"),
        ).alias("bbox")
    )


def vertices_by_unit(zones: DataFrame) -> DataFrame:
    """Rows and the largest polygon of each unit."""
    return zones.groupBy(*KEY).agg(
        F.count("*").alias("rows"), F.max("nverts").alias("max_vertices")
    )


def area_by_risk(zones: DataFrame, area: Column) -> DataFrame:
    """Area per risk class and its share of the total, in percent."""
    sums = zones.groupBy("risk").agg(F.sum(area).alias("area"))
    total = sums.agg(F.sum("area").alias("total"))
    return sums.withColumn(
        "percent", F.round(F.col("area") * 100 / F.nullif(total.scalar(), F.lit(0.0)), 3)
    )


def zones_by(pieces: DataFrame, *by: str) -> DataFrame:
    """Zones counted on their first piece, so cutting does not inflate the count."""
    return (
        pieces.where("piece_id = 0")
        .groupBy(*by)
        .agg(F.count("*").alias("zones"), F.count_if("sfha").alias("sfha_zones"))
    )


def load_differences(log: DataFrame, loaded: DataFrame, stage: str = "subdivided") -> DataFrame:
    """Units completed but not loaded, and loaded but not completed."""
    expected, got = completed(log, stage), loaded.select(*KEY).distinct()
    missing = expected.join(got, KEY, "left_anti").withColumn("problem", F.lit("missing"))
    extra = got.join(expected, KEY, "left_anti").withColumn("problem", F.lit("unexpected"))
    return missing.unionByName(extra)


def validation_report(pieces: DataFrame, log: DataFrame, invalid: Column) -> DataFrame:
    """Rows, invalid, unclassified, units, and the differences to the log, in one row."""
    counts = pieces.agg(
        F.count("*").alias("rows"),
        F.count_if(invalid).alias("invalid"),
        F.count_if(F.col("risk").isNull()).alias("null_risk"),
        F.count_distinct(F.struct(*KEY)).alias("units"),
    )
    gaps = load_differences(log, pieces).agg(
        F.count_if(F.col("problem") == "missing").alias("missing"),
        F.count_if(F.col("problem") == "unexpected").alias("unexpected"),
    )
    return counts.select("*", F.lit(1).alias("_one")).join(
        gaps.select("*", F.lit(1).alias("_one")), "_one"
    ).drop("_one")


def stage_counts(bronze: DataFrame, silver: DataFrame, invalid: Column) -> DataFrame:
    """Per unit: rows after normalization and geometries that were repaired."""
    was = bronze.groupBy(*KEY).agg(F.count_if(invalid).alias("silver_invalid_fixed"))
    rows = silver.groupBy(*KEY).agg(F.count("*").alias("silver_rows"))
    return rows.join(was, KEY)


def refresh_footprint(cells: DataFrame, index: DataFrame) -> DataFrame:
    """Files and bytes to rewrite when one unit gets a new delivery, for every unit.

    ``cells`` has ``state, county, cell`` per filed row, ``index`` has ``cell, bytes`` per file.
    """
    touched = cells.select(*KEY, "cell").distinct()
    return (
        touched.join(index.select("cell", "bytes"), "cell")
        .groupBy(*KEY)
        .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    )


def cell_overlap(cells: DataFrame, key: list[str]) -> DataFrame:
    """What filing under every cell costs: share in several cells, extra rows, most cells."""
    per_row = cells.groupBy(*key).agg(F.count("*").alias("n"))
    return per_row.agg(
        F.count("*").alias("pieces"),
        F.count_if(F.col("n") > 1).alias("in_several"),
        F.sum("n").alias("filed_rows"),
        F.max("n").alias("most_cells"),
    ).withColumns(
        {
            "several_percent": F.round(F.col("in_several") * 100 / F.col("pieces"), 2),
            "extra_percent": F.round(
                (F.col("filed_rows") - F.col("pieces")) * 100 / F.col("pieces"), 2
            ),
        }
    )


def index_summary(index: DataFrame) -> DataFrame:
    """Deliveries, states, zones and bytes from the file index alone."""
    return index.agg(
        F.count("*").alias("deliveries"),
        F.count_distinct("state").alias("states"),
        F.sum("rows").alias("zones"),
        F.sum("bytes").alias("bytes"),
    )


def classes_in_frame(zones: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Zones per class in a frame, by bounding box only."""
    b = F.col("bbox")
    return (
        zones.where((b["xmin"] <= box[2]) & (b["xmax"] >= box[0]))
        .where((b["ymin"] <= box[3]) & (b["ymax"] >= box[1]))
        .groupBy("risk")
        .agg(F.count("*").alias("zones"))
    )


def benchmark_rows(runs: DataFrame, by: list[str], lookups: int | None = None) -> DataFrame:
    """Median of the runs of each measurement, with the cost per lookup as a note."""
    median = F.round(F.percentile("elapsed_ms", 0.5), 1)
    out = runs.groupBy(*by).agg(
        median.alias("elapsed_ms"), F.max("rows").alias("rows"), F.count("*").alias("runs")
    )
    if lookups:
        cost = F.col("elapsed_ms") / lookups
        out = out.withColumn("notes", F.format_string("%.2f ms per lookup", cost))
    return out


def sample_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """``n`` rows picked by an integer hash of the key: same rows under any partitioning."""
    order = F.pmod(F.col(key) * 48271 + 11, F.lit(2147483647))
    return df.orderBy(order, key).limit(n)
