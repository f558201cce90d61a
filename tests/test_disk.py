"""What stays on disk and what travels: shuffle files of stored tables, and the bytes of what is shuffled."""

import os
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import views as V
from zoneloom.llm import suffix_dedup
from zoneloom.operators import subdivide as S
from zoneloom.session import is_spread, settle, spread, workspace
from zoneloom.sources.layout import write_parquet


def shuffle_files(spark) -> set:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in dirs for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def stored(spark, how):
    rows = spark.range(0, 1000, 1, 3).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    if how == "settled":
        return settle(rows)
    path = workspace(spark, "written")
    write_parquet(rows, path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("how", ["settled", "written"])
def test_stored_tables_leave_no_shuffle_files(spark, how):
    before = shuffle_files(spark)
    out = stored(spark, how)
    for _ in range(50):  # they go in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert out.count() == 7 and out.agg(F.sum("s")).first()[0] == 499500


def test_strings_travel_compressed():
    text = b"the same line again and again " * 400
    blobs = [text, b"", np.random.default_rng(1).bytes(1000)]
    sent = suffix_dedup._squeezed(pa.array(blobs, pa.binary()))
    assert len(sent[0].as_py()) < len(text) / 20
    assert suffix_dedup._loosened(pa.chunked_array([sent])).to_pylist() == blobs


def test_geometry_that_was_dealt_out_is_not_dealt_again(spark, tmp_path):
    """the rings made behind the spreading of their keys were shuffled once more to be cut."""
    spark.range(40).selectExpr("id AS p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    zones = V.zones512(spark, str(tmp_path))
    assert is_spread(zones) and not is_spread(spark.range(40)) and not is_spread(spread(zones, "zone_id").groupBy("zone_id").count())
    cut = S.subdivide(zones, ["zone_id"])
    assert cut._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    numbered = S.subdivide(zones, ["zone_id"], inline_limit=200)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "FileScan parquet" in plan and "SortMergeJoin" not in plan
    both = [sorted((r.zone_id, r.piece_id) for r in df.select("zone_id", "piece_id").collect()) for df in (cut, numbered)]
    for rows in both:
        assert len(set(rows)) == len(rows) and len({z for z, _ in rows}) == 40
        n = {z: sum(1 for a, _ in rows if a == z) for z, _ in rows}
        assert all(p < n[z] for z, p in rows)
