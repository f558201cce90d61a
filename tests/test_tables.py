"""Names, catalog pages, mapping and control table on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from zoneloom.functions import text as X
from zoneloom.operators import control as K
from zoneloom.operators import normalize as N
from zoneloom.sources import catalog as C

ROW = (
    '<tr><td><a href="Download/ProductsDownLoadServlet?DFIRMID={id}&state={st}&county={co}'
    '&fileName={id}_{d}.zip"><img/></a></td><td><a href="Download/ProductsDownLoadServlet?'
    "DFIRMID={id}&state={st}&county={co}&fileName={id}_{d}.zip\">{co}</a></td>"
    "<td> some day </td><td>{size}</td></tr>"
)
ROWS = [
    ("39049C", "OHIO", "FRANKLIN COUNTY", "20181203", "47MB"),
    ("390170", "OHIO", " CITY OF HILLIARD", "20170511", "2.5MB"),
    ("22095C", "LOUISIANA", "ST. JOHN PARISH", "20220914", "1.4GB"),
    ("66000C", "GUAM", "GUAM TERRITORY-WIDE", "20160727", "700KB"),
    ("24033C", "MARYLAND", "PRINCE GEORGE'S COUNTY", "20200229", "20 mb"),
    ("99999C", "ATLANTIS", "NOWHERE COUNTY", "20200229", "20MB"),
]


def records(spark, **options):
    html = "<table>" + "".join(
        ROW.format(id=i, st=s, co=c, d=d, size=z) for i, s, c, d, z in ROWS
    ) + "</table><a href='help.html'>help</a>"
    pages = spark.createDataFrame([(html,)], "html string")
    position = F.col("row_no") * 10 + F.col("link_no")
    return C.catalog_records(C.download_rows(pages), "http://h/", position, **options)


def test_catalog_page(spark):
    got = {r.county: r for r in records(spark).collect()}
    assert set(got) == {
        "Franklin", "St. John", "Guam Territory-Wide", "Prince George'S"
    }
    first = got["Franklin"]
    assert first.state == "OH" and first.zip_size_mb == 47.0
    assert first.fema_update_date == dt.date(2018, 12, 3)
    assert first.zip_name == "39049C_20181203.zip" and "%20" in first.url
    assert got["St. John"].zip_size_mb == 1.4 * 1024
    assert got["Guam Territory-Wide"].zip_size_mb == 700 / 1024


def test_catalog_filters(spark):
    assert records(spark, state="oh", county="franklin").count() == 1
    assert records(spark, county_wide_only=False).count() == 5


def test_incomplete_links_are_skipped(spark):
    html = ('<tr><td><a href="Download/ProductsDownLoadServlet?DFIRMID=1C&state=UTAH&county=&'
            'fileName=1C_20200101.zip">x</a></td></tr>')
    pages = spark.createDataFrame([(html,)], "html string")
    assert C.catalog_records(C.download_rows(pages), "", F.lit(1)).count() == 0


def test_title_case_like_the_catalog(spark):
    names = ["O'BRIEN-WIDE", "ST. JOHN 2ND", "DE LA cruz"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n", X.title_case(F.col("n")).alias("t")
    ).collect()
    assert {r.n: r.t for r in got} == {n: n.title() for n in names}


def test_risk_classes(spark):
    cases = {
        ("AREA NOT INCLUDED", None): "unmapped", ("AR/AE", None): "1 percent flood zone",
        ("A1-9", None): "1 percent flood zone", ("A1-30", None): "unmapped",
        ("A12", None): "unmapped", (" ae ", None): "1 percent flood zone",
        ("X", "0.2 PCT ANNUAL"): "0.2 percent flood zone", ("X", None): "minimal",
        ("B", None): "0.2 percent flood zone", ("D", None): "undetermined",
        ("OPEN WATER", None): "water", (None, None): "unmapped",
    }
    rows = [
        (i, "f", "d", z, s, None, "-9999", None, "OH", "c", dt.date(2020, 1, 1), want)
        for i, ((z, s), want) in enumerate(cases.items())
    ]
    df = spark.createDataFrame(
        rows,
        "file_row_number int, FLD_AR_ID string, DFIRM_ID string, FLD_ZONE string, "
        "ZONE_SUBTY string, SFHA_TF string, STATIC_BFE string, DUAL_ZONE string, state string, "
        "county string, fema_update_date date, want string",
    )
    mapping = {**N.ZONE_MAPPING, "context": [*N.ZONE_MAPPING["context"], "want"]}
    out = N.normalize(df, mapping).collect()
    assert [r.risk for r in out] == [r.want for r in out]
    assert all(r.static_bfe is None and r.sfha is None and r.dual_zone is False for r in out)


def test_mapping_text_names_every_target():
    sql = N.mapping_sql(N.ZONE_MAPPING, "bronze")
    for column in N.ZONE_MAPPING["columns"] + N.ZONE_MAPPING["derived"]:
        assert f"AS {column['name']}" in sql


def log_rows(spark, rows):
    df = spark.createDataFrame(
        rows, "state string, county string, fema_update_date date, status string, bronze_rows bigint"
    )
    return K.conform(df, K.empty_log(spark))


def feed_rows(spark, rows):
    return spark.createDataFrame(
        [(s, c, d, f"u-{c}", "1C", 5.0, "z") for s, c, d in rows],
        "state string, county string, fema_update_date date, url string, dfirm_id string, "
        "zip_size_mb double, zip_name string",
    )


def test_upsert_resets_only_newer(spark):
    d = dt.date
    log = log_rows(spark, [("OH", c, d(2020, 1, 1), "silver", 7) for c in ("old", "same", "new")])
    feed = feed_rows(spark, [("OH", "old", d(2019, 1, 1)), ("OH", "same", d(2020, 1, 1)),
                             ("OH", "new", d(2021, 1, 1)), ("OH", "more", d(2021, 1, 1))])
    got = {r.county: r for r in K.upsert(log, feed).collect()}
    assert {c: r.status for c, r in got.items()} == {
        "old": "silver", "same": "silver", "new": "new", "more": "new"
    }
    assert got["old"].source_url == "u-old" and got["old"].fema_update_date == d(2020, 1, 1)
    assert K.upsert_counters(log, feed).first().asDict() == {
        "inserted": 1, "updated": 3, "newer": 1
    }
    assert K.upsert(log, feed, update_only=True).count() == 3


def test_one_failure_stops_nobody(spark):
    log = log_rows(spark, [("OH", c, dt.date(2020, 1, 1), "new", None) for c in ("a", "b")])

    def work(units):
        bad = F.col("county") == "b"
        return units.select(
            "state", "county", F.lit(3).cast("bigint").alias("bronze_rows"),
            F.when(bad, F.repeat(F.lit("e"), 900)).alias("error"),
        )

    got = {r.county: r for r in K.run_stage(log, "bronze", work).collect()}
    assert got["a"].status == "bronze" and got["a"].bronze_rows == 3 and got["a"].error is None
    assert got["b"].status == "new" and len(got["b"].error) == 500 and got["b"].error_at


def test_log_store_keeps_versions(spark, tmp_path):
    store = K.LogStore(spark, str(tmp_path / "log"))
    log = log_rows(spark, [("OH", "a", dt.date(2020, 1, 1), "new", None)])
    store.save(log.drop("zip_name"), 1)
    store.save(store.load().withColumn("status", F.lit("bronze")), 2)
    assert store.last_version() == 2 and store.load().first().status == "bronze"


def test_scope_refuses_and_suggests(spark):
    log = log_rows(spark, [("OH", c, dt.date(2020, 1, 1), "new", None) for c in "abc"])
    log = log.withColumn("zip_size_mb", F.length("county") * F.ascii("county").cast("double"))
    try:
        K.scope(log, "OH")
    except K.ScopeRefused as refused:
        assert [r.county for r in refused.picks.orderBy("pick").collect()] == ["a", "b"]
    else:
        raise AssertionError("not refused")
