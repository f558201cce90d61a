"""The layer builds, each one job over all units it is given."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from zoneloom.functions import rings as R
from zoneloom.operators.normalize import ZONE_MAPPING, normalize
from zoneloom.operators.subdivide import piece_estimate, subdivide
from zoneloom.operators.validity import repair_zones
from zoneloom.sources import layout as L

UNIT = ["state", "county"]
ZONE = [*UNIT, "zone_id"]


def build_silver(
    bronze: DataFrame, root: str, mapping: dict = ZONE_MAPPING, counts: Observation | None = None
) -> DataFrame:
    """Bronze rows normalized, repaired and written by unit; returns what went to quarantine.

    ``counts`` takes ``rows, repaired, failed`` while the repair runs.
    """
    zones = normalize(bronze, mapping, geometry="rings").drop("srid")
    good, quarantine = repair_zones(zones, ZONE, keep=True, counts=counts)
    sizes = bronze.groupBy(*UNIT).agg(F.count("*").alias("n"))
    L.replace_units(R.with_measures(good.drop("repaired")), root, order=["zone_id"], sizes=sizes)
    return quarantine


def build_pieces(silver: DataFrame, root: str, cap: int = 100) -> None:
    """Zones cut to at most ``cap`` coordinates and written by unit."""
    size = F.col("nverts") if "nverts" in silver.columns else R.vertex_count(F.col("rings"))
    # counting the pieces would cut them twice; the estimate is enough to spot a huge unit
    sizes = silver.groupBy(*UNIT).agg(F.sum(piece_estimate(size, cap)).alias("n"))
    L.replace_units(
        subdivide(silver, ZONE, cap), root, order=["zone_id", "piece_id"], sizes=sizes
    )


def build_cells(pieces: DataFrame, root: str, size: float, curve_box=None, bits: int = 16):
    """The cell layout, and its index."""
    L.write_cells(pieces, root, size, curve_box, bits)
    return L.cell_index(pieces.sparkSession, root)
