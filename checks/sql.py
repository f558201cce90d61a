"""Common table expressions of the SQL side, written out with edges as rows."""

from __future__ import annotations

from checks import views as V


def _bronze(names=None) -> str:
    cols = ", ".join(f"{sql} AS {n}" for n, sql in V.BRONZE.items() if not names or n in names)
    return (
        f"SELECT k, rn - 1 AS file_row_number, {cols} FROM "
        "(SELECT p_partkey AS k, row_number() OVER (ORDER BY p_partkey) AS rn FROM part)"
    )


def _hilbert(source: str, key: str, bits: int = V.BITS) -> str:
    top = (1 << bits) - 1
    sql = f"SELECT {key}, CAST(0 AS BIGINT) AS d, ix AS x, iy AS y FROM {source}"
    for b in range(bits - 1, -1, -1):
        sql = (
            f"SELECT {key}, d * 4 + xor(3 * rx, ry) AS d, "
            f"CASE WHEN ry = 1 THEN x WHEN rx = 1 THEN {top} - y ELSE y END AS x, "
            f"CASE WHEN ry = 1 THEN y WHEN rx = 1 THEN {top} - x ELSE x END AS y FROM "
            f"(SELECT *, (x >> {b}) & 1 AS rx, (y >> {b}) & 1 AS ry FROM ({sql}))"
        )
    return f"SELECT {key}, d AS hilbert FROM ({sql})"


def side(x: str, y: str) -> str:
    return f"((x2 - x1) * ({y} - y1) - ({x} - x1) * (y2 - y1))"


def crosses(x: str, y: str) -> str:
    return (
        f"(((y1 > {y}) <> (y2 > {y})) AND (({side(x, y)} > 0) = (y2 > y1)) AND {side(x, y)} <> 0)"
    )


def on_edge(x: str, y: str) -> str:
    return (
        f"({x} BETWEEN least(x1, x2) AND greatest(x1, x2) AND "
        f"{y} BETWEEN least(y1, y2) AND greatest(y1, y2) AND {side(x, y)} = 0)"
    )


def touches(x: str, y: str) -> str:
    """Aggregate over the edges of one zone: inside or on the border."""
    return f"(sum(CASE WHEN {crosses(x, y)} THEN 1 ELSE 0 END) % 2 = 1 OR bool_or({on_edge(x, y)}))"


def contains(x: str, y: str) -> str:
    return (
        f"(sum(CASE WHEN {crosses(x, y)} THEN 1 ELSE 0 END) % 2 = 1 "
        f"AND NOT bool_or({on_edge(x, y)}))"
    )


def edge_meets(x0: str, y0: str, x1: str, y1: str) -> str:
    c = ", ".join(side(a, b) for a in (x0, x1) for b in (y0, y1))
    return (
        f"(least(x1, x2) <= {x1} AND greatest(x1, x2) >= {x0} AND least(y1, y2) <= {y1} AND "
        f"greatest(y1, y2) >= {y0} AND least({c}) <= 0 AND greatest({c}) >= 0)"
    )


def box_meets(x0: str, y0: str, x1: str, y1: str) -> str:
    """Aggregate over the edges of one zone: meets the closed box."""
    return f"(bool_or({edge_meets(x0, y0, x1, y1)}) OR {touches(x0, y0)})"


_DX = "[" + ", ".join(map(str, V.DX)) + "]"
_DY = "[" + ", ".join(map(str, V.DY)) + "]"
_WEST = f"(k * 7919) % {V.SIDE}"
_SOUTH = f"(k * 104729) % {V.SIDE}"
_portal = ", ".join(f"{sql} AS {n}" for n, sql in V.PORTAL.items())

_title = (
    "array_to_string(list_transform(regexp_extract_all(lower({0}), '([a-z]+|[^a-z]+)'), "
    "lambda w: upper(w[1]) || w[2:]), '')"
)


def title(sql: str) -> str:
    return _title.format(sql)


_county = (
    "CASE WHEN county_name LIKE '%TERRITORY-WIDE%' THEN {t0} ELSE {t1} END"
).format(
    t0=title("trim(county_name)"),
    t1=title("regexp_replace(trim(county_name), ' +(COUNTY|PARISH)$', '')"),
)

CTES = {
    "zk": f"SELECT p_partkey AS k, p_partkey AS zone_id, {V.STATE} AS state, {V.COUNTY} AS county "
    "FROM (SELECT p_partkey, p_partkey AS k FROM part)",
    "v": f"SELECT k, i, CAST({_WEST} + ({_DX})[i + 1] * (1 + (k * 31 + i * 17) % 7) * 4 AS DOUBLE) AS x, "
    f"CAST({_SOUTH} + ({_DY})[i + 1] * (1 + (k * 31 + i * 17) % 7) * 4 AS DOUBLE) AS y "
    "FROM (SELECT p_partkey AS k, unnest(range(8)) AS i FROM part)",
    "e": "SELECT a.k, a.i, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 "
    "FROM v a JOIN v b ON a.k = b.k AND b.i = (a.i + 1) % 8",
    "z": "SELECT k, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM v GROUP BY k",
    "za": "SELECT k, sum(x1 * y2 - x2 * y1) / 2 AS area FROM e GROUP BY k",
    "p": f"SELECT o_orderkey, (o_orderkey * 48271) % {V.SIDE} + CAST(0.5 AS DOUBLE) AS x, "
    f"(o_orderkey * 69621) % {V.SIDE} + CAST(0.25 AS DOUBLE) AS y FROM orders",
    "hits": "SELECT o_orderkey, k FROM p JOIN z ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax "
    f"JOIN e USING (k) GROUP BY o_orderkey, k, x, y HAVING {touches('x', 'y')}",
    "b": f"SELECT c_custkey, CAST(x AS DOUBLE) AS bx0, CAST(y AS DOUBLE) AS by0, "
    "CAST(x + s AS DOUBLE) AS bx1, CAST(y + s AS DOUBLE) AS by1 FROM "
    f"(SELECT c_custkey, (c_custkey * 613) % {V.SIDE} AS x, (c_custkey * 977) % {V.SIDE} AS y, "
    "256 * (1 + c_custkey % 8) AS s FROM customer)",
    "cand": "SELECT k, ci, unnest(range(CAST(floor(ymin / 512) AS BIGINT), CAST(floor(ymax / 512) AS BIGINT) + 1)) AS cj, "
    "FROM (SELECT *, unnest(range(CAST(floor(xmin / 512) AS BIGINT), CAST(floor(xmax / 512) AS BIGINT) + 1)) AS ci FROM z)",
    "zc": "SELECT k, ci, cj FROM (SELECT k, ci, cj, x1, y1, x2, y2, ci * 512.0::DOUBLE AS qx0, cj * 512.0::DOUBLE AS qy0, "
    "(ci + 1) * 512.0::DOUBLE AS qx1, (cj + 1) * 512.0::DOUBLE AS qy1 FROM cand JOIN e USING (k)) "
    f"GROUP BY k, ci, cj, qx0, qy0, qx1, qy1 HAVING {box_meets('qx0', 'qy0', 'qx1', 'qy1')}",
    "bronze": _bronze(),
    "silver0": "SELECT k, state, county, fema_update_date, CAST(file_row_number AS INT) AS zone_id, "
    "FLD_AR_ID AS source_feature_id, DFIRM_ID AS dfirm_id, upper(trim(FLD_ZONE)) AS flood_zone, "
    "CASE WHEN trim(ZONE_SUBTY) <> '' THEN trim(ZONE_SUBTY) END AS zone_subtype, SFHA_TF = 'T' AS sfha, "
    "CASE WHEN STATIC_BFE IN ('-9999', 'n/a') THEN NULL ELSE CAST(STATIC_BFE AS DOUBLE) END AS static_bfe, "
    "CASE WHEN DUAL_ZONE = 'T' THEN true ELSE false END AS dual_zone FROM bronze",
    "silver": "SELECT *, CASE WHEN flood_zone = 'AREA NOT INCLUDED' THEN 'unmapped' "
    "WHEN flood_zone IN ('A','AO','AH','AE','A99','V','VE','AR') OR flood_zone LIKE 'A1-_' "
    "OR flood_zone LIKE 'V1-_' OR flood_zone LIKE 'AR/%' THEN '1 percent flood zone' "
    "WHEN flood_zone = 'B' OR (flood_zone = 'X' AND (zone_subtype LIKE '0.2 PCT%' OR "
    "zone_subtype LIKE '1 PCT%' OR zone_subtype LIKE 'AREA WITH REDUCED FLOOD RISK%')) "
    "THEN '0.2 percent flood zone' WHEN flood_zone IN ('C','X') THEN 'minimal' "
    "WHEN flood_zone = 'D' THEN 'undetermined' WHEN flood_zone = 'OPEN WATER' THEN 'water' "
    "ELSE 'unmapped' END AS risk, sfha AS floodplain, "
    "CASE WHEN dual_zone OR flood_zone LIKE 'AR/%' THEN flood_zone END AS subzone FROM silver0",
    "hc": f"SELECT k, least({V.SIDE - 1}, greatest(0, CAST(floor((xmin + xmax) / 2) AS BIGINT))) AS ix, "
    f"least({V.SIDE - 1}, greatest(0, CAST(floor((ymin + ymax) / 2) AS BIGINT))) AS iy FROM z",
    "hil": _hilbert("hc", "k"),
    "portal": f"SELECT k, {_portal} FROM (SELECT s_suppkey AS k FROM supplier)",
    "records": "SELECT k, state, county, county_raw, dfirm_id, county_wide, fema_update_date, "
    "zip_size_mb, zip_name, url, k // 4 AS n, (k // 4) % 4 AS s FROM ("
    "SELECT k, CASE state_name WHEN 'MASSACHUSETTS' THEN 'MA' WHEN 'LOUISIANA' THEN 'LA' "
    "WHEN 'UTAH' THEN 'UT' WHEN 'PUERTO RICO' THEN 'PR' WHEN 'NEW YORK' THEN 'NY' END AS state, "
    f"{_county} AS county, trim(county_name) AS county_raw, id AS dfirm_id, id LIKE '%C' AS county_wide, "
    "CAST(strptime(ymd, '%Y%m%d') AS DATE) AS fema_update_date, "
    "CASE WHEN size_text LIKE '%GB' THEN CAST(replace(size_text, 'GB', '') AS DOUBLE) * 1024 "
    "WHEN size_text LIKE '%KB' THEN CAST(replace(size_text, 'KB', '') AS DOUBLE) / 1024 "
    "ELSE CAST(replace(size_text, 'MB', '') AS DOUBLE) END AS zip_size_mb, "
    "concat(id, '_', ymd, '.zip') AS zip_name, "
    f"replace(concat('{V.BASE_URL}Download/ProductsDownLoadServlet?DFIRMID=', id, '&state=', state_name, "
    "'&county=', county_name, '&fileName=', id, '_', ymd, '.zip'), ' ', '%20') AS url FROM portal) "
    "WHERE state IS NOT NULL",
    "listed": "SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY state, county ORDER BY k) = 1",
    "wide": "SELECT * FROM records WHERE county_wide "
    "QUALIFY row_number() OVER (PARTITION BY state, county ORDER BY k) = 1",
    "log": "SELECT k, n, s, state, county, fema_update_date, url AS source_url, dfirm_id, zip_size_mb, zip_name, "
    + ", ".join(f"{sql} AS {c}" for c, sql in V.LOG.items())
    + " FROM wide",
    "feed": "SELECT state, county, CAST(fema_update_date + to_years(CAST(k % 3 - 1 AS INT)) AS DATE) AS fema_update_date, "
    "concat(url, '&again') AS url, dfirm_id, zip_size_mb + 1 AS zip_size_mb, zip_name "
    f"FROM listed WHERE {V.FEED_KEEP}",
    "inv": " UNION ALL ".join(
        f"SELECT state, county, '{s}' AS stage FROM wide WHERE {keep}"
        for s, keep in V.INVENTORY.items()
    ),
}
NEEDS = {
    "e": ["v"], "z": ["v"], "za": ["e"], "hits": ["p", "z", "e"], "cand": ["z"], "zc": ["cand", "e"],
    "silver0": ["bronze"], "silver": ["silver0"], "hc": ["z"], "hil": ["hc"],
    "records": ["portal"], "listed": ["records"], "wide": ["records"], "log": ["wide"],
    "feed": ["listed"], "inv": ["wide"],
}


def with_(names: str, select: str, **extra: str) -> str:
    """``WITH`` the named expressions and all they need, then extra ones, then the query."""
    wanted: set[str] = set()

    def need(name):
        if name not in wanted:
            for other in NEEDS.get(name, []):
                need(other)
            wanted.add(name)

    for name in names.split():
        need(name)
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in wanted]
    parts += [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {select}"
