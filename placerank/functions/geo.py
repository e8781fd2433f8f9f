"""Geography as plain Column arithmetic: distances, projections, grid keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placerank import fixed
from placerank.functions.text import col

# GRS80 ellipsoid (equal to WGS84 at centimetre level)
_A = 6378137.0
_E2 = 2 / 298.257222101 - (1 / 298.257222101) ** 2
_E = math.sqrt(_E2)


def chord_sql(dlat: str, dlon: str, cos1: str, cos2: str) -> str:
    """Haversine term for coordinate differences in degrees."""
    return f"(pow(sin(radians({dlat}) / 2), 2) + {cos1} * {cos2} * pow(sin(radians({dlon}) / 2), 2))"


def arc_km_sql(a: str) -> str:
    """Distance of a haversine term; rounding may lift it slightly over 1."""
    return f"{2 * fixed.EARTH_RADIUS_KM}D * asin(sqrt(CASE WHEN {a} > 1 THEN 1 ELSE {a} END))"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return arc_km_sql(chord_sql(f"({lat2} - {lat1})", f"({lon2} - {lon1})", f"cos(radians({lat1}))", f"cos(radians({lat2}))"))


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance in km between two points given by column names; null if any is null.

    Built from one SQL text: the formula has some forty nodes, each a call to the JVM otherwise.
    """
    return F.expr(haversine_sql(lat1, lon1, lat2, lon2))


def in_bbox(lat: str | Column, lon: str | Column, bbox=fixed.BBOX_STRICT) -> Column:
    """Inside the box, edges included."""
    lat_min, lat_max, lon_min, lon_max = bbox
    return col(lat).between(lat_min, lat_max) & col(lon).between(lon_min, lon_max)


def grid_key(lat: str | Column, lon: str | Column, deg: float) -> tuple[Column, Column]:
    """Integer bucket pair of a point on a grid of ``deg`` degrees."""
    return F.floor(col(lat) / deg).cast("int"), F.floor(col(lon) / deg).cast("int")


def round_key(lat: str | Column, lon: str | Column, digits: int) -> tuple[Column, Column]:
    """Coordinates rounded half up, as an equality key.

    floor(x * 10^n + 0.5) rather than round(): the key is a whole number, so equal on every engine.
    """
    scale = float(10**digits)
    return tuple(F.floor(col(c) * scale + 0.5).cast("long") for c in (lat, lon))


def _bound(df: DataFrame, keep: list[str], lon: str, lon_value: Column, lat: str, lat_value: Column) -> DataFrame:
    """The kept columns with the two values, as the one element of an array taken apart.

    A filter on them stays above; below, Spark would write all steps of a projection into it once per mention, too long
    for generated code.
    """
    pair = F.array(F.struct(lon_value.alias("lon"), lat_value.alias("lat")))
    return df.select(*keep, F.explode(pair).alias("_at")).select(*keep, F.col("_at.lon").alias(lon), F.col("_at.lat").alias(lat))


def epsg3035_to_wgs84(df: DataFrame, x: str, y: str, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Inverse Lambert azimuthal equal area (ETRS89-LAEA Europe), closed form with series."""
    phi0, lam0, fe, fn = math.radians(52.0), math.radians(10.0), 4321000.0, 3210000.0

    def q(phi: float) -> float:
        s = math.sin(phi)
        return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))

    qp = q(math.pi / 2)
    rq = _A * math.sqrt(qp / 2)
    beta0 = math.asin(q(phi0) / qp)
    sin0, cos0 = math.sin(beta0), math.cos(beta0)
    d = _A * math.cos(phi0) / math.sqrt(1 - _E2 * math.sin(phi0) ** 2) / (rq * cos0)
    k2 = _E2 / 3 + 31 * _E2**2 / 180 + 517 * _E2**3 / 5040
    k4 = 23 * _E2**2 / 360 + 251 * _E2**3 / 3780
    k6 = 761 * _E2**3 / 45360

    keep = df.columns
    easting, northing = F.col(x) - fe, F.col(y) - fn
    step = df.select("*", easting.alias("_x"), northing.alias("_y"))
    step = step.select("*", F.sqrt((F.col("_x") / d) ** 2 + (F.col("_y") * d) ** 2).alias("_rho"))
    step = step.select("*", (2 * F.asin(F.col("_rho") / (2 * rq))).alias("_c"))
    sin_beta = F.cos("_c") * sin0 + F.when(
        F.col("_rho") > 0, F.col("_y") * d * F.sin("_c") * cos0 / F.col("_rho")
    ).otherwise(F.lit(0.0))
    step = step.select("*", F.asin(sin_beta).alias("_beta"))
    lam = lam0 + F.atan2(
        F.col("_x") * F.sin("_c"),
        F.col("_rho") * (d * cos0) * F.cos("_c") - F.col("_y") * (d * d * sin0) * F.sin("_c"),
    )
    phi = (
        F.col("_beta")
        + k2 * F.sin(2 * F.col("_beta"))
        + k4 * F.sin(4 * F.col("_beta"))
        + k6 * F.sin(6 * F.col("_beta"))
    )
    return _bound(step, keep, lon, F.degrees(lam), lat, F.degrees(phi))


def epsg2154_to_wgs84(df: DataFrame, x: str, y: str, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Inverse Lambert conformal conic (RGF93 / Lambert-93), five iterations for the latitude."""
    phi1, phi2, phif, lamf = (math.radians(v) for v in (49.0, 44.0, 46.5, 3.0))
    fe, fn = 700000.0, 6600000.0

    def t(phi: float) -> float:
        s = _E * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (_E / 2)

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - _E2 * math.sin(phi) ** 2)

    n = (math.log(m(phi1)) - math.log(m(phi2))) / (math.log(t(phi1)) - math.log(t(phi2)))
    big_f = m(phi1) / (n * t(phi1) ** n)
    rf = _A * big_f * t(phif) ** n

    keep = df.columns
    step = df.select("*", (F.col(x) - fe).alias("_x"), (rf - (F.col(y) - fn)).alias("_y"))
    radius = F.sqrt(F.col("_x") ** 2 + F.col("_y") ** 2)
    step = step.select("*", F.pow(radius / (_A * big_f), 1 / n).alias("_t"))
    step = step.select("*", (math.pi / 2 - 2 * F.atan("_t")).alias("_phi0"))
    for i in range(5):
        s = F.sin(f"_phi{i}") * _E
        phi = math.pi / 2 - 2 * F.atan(F.col("_t") * F.pow((1 - s) / (1 + s), _E / 2))
        step = step.select("*", phi.alias(f"_phi{i + 1}"))
    lam = F.atan2(F.col("_x"), F.col("_y")) / n + lamf
    return _bound(step, keep, lon, F.degrees(lam), lat, F.degrees("_phi5"))


def register_haversine(spark: SparkSession, name: str = "haversine_km") -> None:
    """haversine_km(lat1, lon1, lat2, lon2) for SQL text, as a SQL function the optimizer inlines."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) "
        f"RETURNS DOUBLE RETURN {haversine_sql('lat1', 'lon1', 'lat2', 'lon2')}"
    )
