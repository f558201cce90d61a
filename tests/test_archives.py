"""Archives in ranges: one archive over several tasks, whole or with an error."""

import io
import zipfile

from pyspark.sql import functions as F

from checks.deliveries import NAD83, shapefile
from zoneloom.sources import archive as A

SIZES = {"FLD_AR_ID": 12, "COUNTY": 24}
SCHEMA = "path string, content binary, source string"


def square(k, side=1.0):
    return [(k, 0.0), (k + side, 0.0), (k + side, side), (k, side), (k, 0.0)]


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for ext, data in members.items():
            z.writestr(f"x/S_FLD_HAZ_AR.{ext}", data)
    return out.getvalue()


def members(n, encoding="utf-8", cpg="UTF-8", shx=True):
    rows = [({"FLD_AR_ID": f"é{k}" if k % 3 else "", "COUNTY": "c"}, [square(float(k)), square(k + 0.25, 0.5)]) for k in range(n)]
    found = {**shapefile(rows, encoding, SIZES), "prj": NAD83}
    if cpg:
        found["cpg"] = cpg
    if not shx:
        del found["shx"]
    return found


def test_one_archive_is_decoded_by_several_tasks(spark):
    n = 1_000
    data = [("a", zipped(members(n)), "cache"), ("b", zipped(members(n, "latin1", None, shx=False)), "cache")]
    archives = spark.createDataFrame(data, SCHEMA)
    rows = A.read_archives(archives, ["FLD_AR_ID", "GONE"], range_bytes=16_000)
    tasks = rows.withColumn("t", F.spark_partition_id()).groupBy("path").agg(F.count_distinct("t").alias("t")).collect()
    assert {r.path: r.t > 1 for r in tasks} == {"a": True, "b": True}
    got = rows.select("path", "FLD_AR_ID", "GONE", "encoding", "file_row_number", F.col("rings")[0][0]["x"].alias("x"),
                      F.size("rings").alias("n")).collect()
    want = {(p, f"é{k}" if k % 3 else None, None, e, k, float(k), 2) for k in range(n)
            for p, e in (("a", "cpg:UTF-8 zip:cache"), ("b", "latin1-fallback zip:cache"))}
    assert len(got) == 2 * n and {tuple(r) for r in got} == want


def test_a_broken_archive_gives_its_error_and_no_rows(spark):
    whole = members(300)
    crossing = shapefile([({"FLD_AR_ID": "1", "COUNTY": "c"}, [square(0.0, 4.0), square(2.0, 4.0), square(3.0, 0.5)])], "utf-8", SIZES)
    cut = bytearray(zipped(whole))
    at = cut.find(b"S_FLD_HAZ_AR.shp") + 400
    cut[at] ^= 0xFF
    cases = {
        "table": zipped({**whole, "dbf": whole["dbf"][:-500]}),
        "layer": zipped({**whole, "shp": whole["shp"][:-40]}),
        "count": zipped({**whole, "shx": whole["shx"][:-8]}),
        "codec": zipped({**whole, "cpg": "no such code"}),
        "bytes": bytes(cut),
        "good": zipped({**crossing, "prj": NAD83}),
        "none": zipped({**whole, "shp": whole["shp"][:100], "shx": whole["shx"][:100],
                        "dbf": whole["dbf"][:4] + bytes(4) + whole["dbf"][8:97] + b"\x1a"}),
    }
    archives = spark.createDataFrame([(k, v, "cache") for k, v in cases.items()], SCHEMA)
    rows = A.read_archives(archives, ["FLD_AR_ID"], range_bytes=4_000).collect()
    errors = {r.path: r.error for r in rows if r.error}
    assert set(errors) == {"table", "layer", "count", "codec", "bytes"} and len(rows) == 6
    assert "ends early" in errors["table"] and "ends early" in errors["layer"]
    assert errors["count"] == "ValueError: 299 shapes but 300 table rows" and "no such code" in errors["codec"]
    # rings that cross have no shells and holes yet; repair finds them
    assert [len(r.rings) for r in rows if r.path == "good"] == [3]


def test_no_archives(spark):
    assert A.read_archives(spark.createDataFrame([], SCHEMA), ["FLD_AR_ID"]).count() == 0
