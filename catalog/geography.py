"""Distances, projections and spatial joins."""

import math

from pyspark.sql import functions as F

from catalog.base import (
    CELL, CELLS_SQL, CLUBS_SQL, NATION, STOPS_SQL, ROADS_SQL, bucket_sql, cells, clubs, hav_sql, query, roads, spot,
    spot_sql, stops, table,
)
from placerank.functions import geo
from placerank.operators import spatial


@query(f"""
WITH {CELLS_SQL}, n AS (SELECT lpad(n_nationkey::VARCHAR, 2, '0') AS department, {spot_sql('n_nationkey', NATION, 'nlat', 'nlon')} FROM nation)
SELECT cell_id, round({hav_sql('lat', 'lon', 'nlat', 'nlon')}, 6) AS km, round({hav_sql('lat', 'lon', 'nlat', 'nlon')}, 6) AS km_sql
FROM cells JOIN n USING (department)""")
def haversine(spark, d):
    capitals = table(spark, d, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("department"),
        *[c.alias(f"n{n}") for n, c in spot("n_nationkey", NATION).items()],
    )
    geo.register_haversine(spark, "haversine_km")
    return cells(spark, d).join(capitals, "department").select(
        "cell_id", F.round(geo.haversine_km("lat", "lon", "nlat", "nlon"), 6).alias("km"),
        F.expr("round(haversine_km(lat, lon, nlat, nlon), 6)").alias("km_sql"),
    )


E2 = "0.006694380022903416e0"
def laea_sql(digits: int | None = None) -> str:
    """(c_custkey, lon, lat) of every customer's place on the metric grid, rounded if asked for."""
    lon, lat = (f"round({c}, {digits})" if digits else c for c in (LAEA_LON, LAEA_LAT))
    return f"{LAEA_STEPS}\nSELECT c_custkey, {lon} AS lon, {lat} AS lat FROM f"


LAEA_LON = "degrees(radians(10e0) + atan2(x * sin(cc), d * rho * cos(b0) * cos(cc) - d * d * y * sin(b0) * sin(cc)))"
LAEA_LAT = f"""degrees(beta + ({E2} / 3 + 31 * pow({E2}, 2) / 180 + 517 * pow({E2}, 3) / 5040) * sin(2 * beta)
    + (23 * pow({E2}, 2) / 360 + 251 * pow({E2}, 3) / 3780) * sin(4 * beta) + (761 * pow({E2}, 3) / 45360) * sin(6 * beta))"""
LAEA_STEPS = f"""
WITH k AS (SELECT sqrt({E2}) AS e, radians(52e0) AS phi0),
q AS (SELECT e, phi0, (1 - {E2}) * (1 / (1 - {E2}) - ln((1 - e) / (1 + e)) / (2 * e)) AS qp,
  (1 - {E2}) * (sin(phi0) / (1 - {E2} * sin(phi0) * sin(phi0)) - ln((1 - e * sin(phi0)) / (1 + e * sin(phi0))) / (2 * e)) AS q0 FROM k),
b AS (SELECT asin(q0 / qp) AS b0, 6378137e0 * sqrt(qp / 2) AS rq,
  6378137e0 * cos(phi0) / sqrt(1 - {E2} * sin(phi0) * sin(phi0)) AS m FROM q),
d AS (SELECT b0, rq, m / (rq * cos(b0)) AS d FROM b),
p AS (SELECT c_custkey, b0, rq, d, 3200000e0 + (c_custkey * 7919) % 900000 - 4321000e0 AS x,
  2100000e0 + (c_custkey * 6007) % 1000000 - 3210000e0 AS y FROM customer, d),
r AS (SELECT *, sqrt((x / d) * (x / d) + (d * y) * (d * y)) AS rho FROM p),
c AS (SELECT *, 2 * asin(rho / (2 * rq)) AS cc FROM r),
f AS (SELECT *, asin(cos(cc) * sin(b0) + d * y * sin(cc) * cos(b0) / rho) AS beta FROM c)"""


@query(laea_sql(7))
def laea_inverse(spark, d):
    k = F.col("c_custkey")
    xy = table(spark, d, "customer").select(
        "c_custkey", (3200000.0 + (k * 7919) % 900000).alias("x"), (2100000.0 + (k * 6007) % 1000000).alias("y")
    )
    out = geo.epsg3035_to_wgs84(xy, "x", "y", "lon", "lat")
    return out.select("c_custkey", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


def _m(p):
    return f"(cos({p}) / sqrt(1 - {E2} * sin({p}) * sin({p})))"


def _t(p):
    return f"(tan(pi() / 4 - {p} / 2) / pow((1 - e * sin({p})) / (1 + e * sin({p})), e / 2))"


_STEPS = ",\n".join(
    f"i{i + 1} AS (SELECT *, pi() / 2 - 2 * atan(t * pow((1 - e * sin(phi{i})) / (1 + e * sin(phi{i})), e / 2)) AS phi{i + 1} FROM i{i})"
    for i in range(5)
)
def lcc_sql(digits: int | None = None) -> str:
    """(s_suppkey, lon, lat) of every supplier's place on the metric grid, rounded if asked for."""
    lon, lat = (f"round({c}, {digits})" if digits else c for c in ("degrees(atan2(x, y) / n + radians(3e0))", "degrees(phi5)"))
    return f"{LCC_STEPS}\nSELECT s_suppkey, {lon} AS lon, {lat} AS lat FROM i5"


LCC_STEPS = f"""
WITH k AS (SELECT sqrt({E2}) AS e, radians(49e0) AS p1, radians(44e0) AS p2, radians(46.5e0) AS pf),
n AS (SELECT *, (ln({_m('p1')}) - ln({_m('p2')})) / (ln({_t('p1')}) - ln({_t('p2')})) AS n FROM k),
f AS (SELECT *, {_m('p1')} / (n * pow({_t('p1')}, n)) AS f FROM n),
g AS (SELECT *, 6378137e0 * f * pow({_t('pf')}, n) AS rf FROM f),
p AS (SELECT s_suppkey, e, n, f, 200000e0 + (s_suppkey * 7919) % 1000000 - 700000e0 AS x,
  rf - (6100000e0 + (s_suppkey * 6007) % 900000 - 6600000e0) AS y FROM supplier, g),
i0 AS (SELECT *, pow(sqrt(x * x + y * y) / (6378137e0 * f), 1 / n) AS t,
  pi() / 2 - 2 * atan(pow(sqrt(x * x + y * y) / (6378137e0 * f), 1 / n)) AS phi0 FROM p),
{_STEPS}"""


@query(lcc_sql(7))
def lcc_inverse(spark, d):
    k = F.col("s_suppkey")
    xy = table(spark, d, "supplier").select(
        "s_suppkey", (200000.0 + (k * 7919) % 1000000).alias("x"), (6100000.0 + (k * 6007) % 900000).alias("y")
    )
    out = geo.epsg2154_to_wgs84(xy, "x", "y", "lon", "lat")
    return out.select("s_suppkey", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


@query(f"""
WITH {CELLS_SQL} SELECT cell_id, {bucket_sql('lat', '0.05')} AS lat_b, {bucket_sql('lon', '0.05')} AS lon_b,
  floor(lat * 100 + 0.5)::BIGINT AS lat_key, floor(lon * 100 + 0.5)::BIGINT AS lon_key FROM cells""")
def grid_keys(spark, d):
    lat_b, lon_b = geo.grid_key("lat", "lon", 0.05)
    lat_k, lon_k = geo.round_key("lat", "lon", 2)
    return cells(spark, d).select(
        "cell_id", lat_b.alias("lat_b"), lon_b.alias("lon_b"), lat_k.alias("lat_key"), lon_k.alias("lon_key")
    )


@query(f"""
WITH {CELLS_SQL}, b AS (SELECT {bucket_sql('lat', '0.5')} + dy.x AS lat_b, {bucket_sql('lon', '0.5')} + dx.x AS lon_b
  FROM cells, (SELECT unnest([-2, -1, 0, 1, 2]) AS x) dy, (SELECT unnest([-2, -1, 0, 1, 2]) AS x) dx)
SELECT lat_b, lon_b, count(*) AS n FROM b GROUP BY ALL""")
def neighbor_expand(spark, d):
    lat_b, lon_b = geo.grid_key("lat", "lon", 0.5)
    keyed = cells(spark, d).select(lat_b.alias("lat_b"), lon_b.alias("lon_b"))
    # equal buckets are counted before they are copied to their neighbours
    counted = keyed.groupBy("lat_b", "lon_b").agg(F.count("*").alias("n"))
    return spatial.expand_neighbors(counted, 2).groupBy("lat_b", "lon_b").agg(F.sum("n").alias("n"))


def pairs_sql(places: str, deg: str, span: int, lat: str = "lat", lon: str = "lon", name: str = "p") -> str:
    """Candidate pairs under the bucket rule, written as a range condition."""
    return f"""{name} AS (SELECT c.cell_id, s.*, {hav_sql('c.lat', 'c.lon', f's.{lat}', f's.{lon}')} AS km FROM cells c JOIN {places} s
  ON abs({bucket_sql('c.lat', deg)} - {bucket_sql(f's.{lat}', deg)}) <= {span}
 AND abs({bucket_sql('c.lon', deg)} - {bucket_sql(f's.{lon}', deg)}) <= {span})"""


@query(f"""
WITH {CELLS_SQL}, {STOPS_SQL}, {pairs_sql('stops', '0.01', 1)}
SELECT c.cell_id, coalesce(x.n, 0) AS n_stops FROM cells c
LEFT JOIN (SELECT cell_id, count(DISTINCT osm_id) AS n FROM p WHERE km <= 1 GROUP BY 1) x USING (cell_id)""")
def count_within(spark, d):
    points = cells(spark, d).select("cell_id", "lat", "lon")
    near = spatial.count_within(
        points, stops(spark, d), point_id="cell_id", place_id="osm_id", radius_km=1.0, deg=0.01, span=1, within="n_stops"
    )
    return points.join(near, "cell_id", "left").select(
        "cell_id", F.coalesce(F.col("n_stops"), F.lit(0).cast("long")).alias("n_stops")
    )


@query(f"""
WITH {CELLS_SQL}, {STOPS_SQL}
SELECT c.cell_id, count(DISTINCT s.osm_id) AS n_stops FROM cells c LEFT JOIN stops s
  ON s.lat BETWEEN c.lat - 0.1 AND c.lat + 0.1 AND {hav_sql('c.lat', 'c.lon', 's.lat', 's.lon')} <= 8 GROUP BY 1""")
def count_within_exact(spark, d):
    points = cells(spark, d).select("cell_id", "lat", "lon")
    near = spatial.count_within(
        points, stops(spark, d), point_id="cell_id", place_id="osm_id", radius_km=8.0, deg=0.1, exact=True, within="n_stops"
    )
    return points.join(near, "cell_id", "left").select(
        "cell_id", F.coalesce(F.col("n_stops"), F.lit(0).cast("long")).alias("n_stops")
    )


@query(f"""
WITH {CELLS_SQL}, {ROADS_SQL}, {pairs_sql('roads', '0.02', 2, 'lat_center', 'lon_center')}
SELECT c.cell_id, round(x.km, 6) AS road_km FROM cells c LEFT JOIN (SELECT cell_id, min(km) AS km FROM p GROUP BY 1) x USING (cell_id)""")
def nearest_distance(spark, d):
    points = cells(spark, d).select("cell_id", "lat", "lon")
    near = spatial.nearest_distance(
        points, roads(spark, d), point_id="cell_id", deg=0.02, span=2, place=("lat_center", "lon_center"), nearest="road_km"
    )
    return points.join(near, "cell_id", "left").select("cell_id", F.round("road_km", 6).alias("road_km"))


@query(f"""
WITH {CELLS_SQL}, {CLUBS_SQL}, {pairs_sql('clubs', '0.05', 3)}
SELECT cell_id, round(min(km), 6) AS club_km, count(*) FILTER (km <= 5) AS n_clubs FROM p GROUP BY cell_id""")
def proximity(spark, d):
    near = spatial.proximity_metrics(
        cells(spark, d), clubs(spark, d), point_id="cell_id", deg=0.05, span=3, radius_km=5.0,
        nearest="club_km", within="n_clubs",
    )
    return near.select("cell_id", F.round("club_km", 6).alias("club_km"), "n_clubs")


@query(f"""
WITH {CELLS_SQL}, {CLUBS_SQL}, {pairs_sql('clubs', '0.05', 3)}
SELECT c.cell_id, p.club_id, round(p.km, 6) AS distance_km FROM cells c LEFT JOIN p USING (cell_id)""")
def neighbor_pairs(spark, d):
    places = clubs(spark, d).select("club_id", F.col("lat").alias("place_lat"), F.col("lon").alias("place_lon"))
    pairs = spatial.neighbor_join(cells(spark, d).select("cell_id", "lat", "lon"), places, 0.05, 3)
    return pairs.select("cell_id", "club_id", F.round("distance_km", 6).alias("distance_km"))


@query(f"""
WITH {CLUBS_SQL} SELECT a.club_id AS club_a, b.club_id AS club_b, round({hav_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')}, 6) AS distance_km
FROM clubs a JOIN clubs b ON a.club_id < b.club_id WHERE {hav_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 55""")
def radius_pairs(spark, d):
    pairs = spatial.within_radius_self_pairs(clubs(spark, d), 55.0, 0.5, key="club_id", names=("club_a", "club_b"))
    return pairs.select("club_a", "club_b", F.round("distance_km", 6).alias("distance_km"))
