"""Registry and the roles the given tables play.

customer = grid cells, supplier = clubs, part = transport stops, orders = road axes, lineitem = property
sales, nation = departments, events = club events. Coordinates and codes follow from the integer keys by
whole-number arithmetic, so that Spark and the checking engine see the same doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with its SQL check if there is one."""

    def register(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# (latitude multiplier, longitude multiplier) per table
CELL, CLUB, STOP, ROAD, USER, NATION = (
    (7919, 10473), (3571, 5393), (4801, 2909), (5003, 7001), (2203, 4409), (1009, 1511),
)


def spot(key: str, multipliers: tuple[int, int]) -> dict[str, Column]:
    a, b = multipliers
    k = F.col(key).cast("long")
    return {"lat": 43.0 + (k * a) % 6007 / F.lit(1001.0), "lon": -1.0 + (k * b) % 8009 / F.lit(1001.0)}


def spot_sql(key: str, multipliers: tuple[int, int], lat: str = "lat", lon: str = "lon") -> str:
    a, b = multipliers
    k = f"{key}::BIGINT"
    return (
        f"43e0 + (({k} * {a}) % 6007) / 1001e0 AS {lat}, -1e0 + (({k} * {b}) % 8009) / 1001e0 AS {lon}"
    )


def hav_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 6371e0 * atan2(sqrt({a}), sqrt(greatest(0e0, 1 - {a}))))"


def bucket_sql(c: str, deg: str) -> str:
    return f"CAST(floor({c} / {deg}e0) AS INTEGER)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    department = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    return table(spark, sf_dir, "customer").select(
        k.alias("cell_id"),
        department.alias("department"),
        F.concat(department, F.lpad((k % 9).cast("string"), 3, "0")).alias("commune"),
        *[c.alias(n) for n, c in spot("c_custkey", CELL).items()],
        ((F.col("c_acctbal") + 1000) / 7.0).alias("income"),
        ((k * 37) % 101 / F.lit(101.0)).alias("target_share"),
    )


CELLS_SQL = f"""cells AS (
  SELECT c_custkey AS cell_id, lpad(c_nationkey::VARCHAR, 2, '0') AS department,
         lpad(c_nationkey::VARCHAR, 2, '0') || lpad((c_custkey % 9)::VARCHAR, 3, '0') AS commune,
         {spot_sql('c_custkey', CELL)}, (c_acctbal + 1000) / 7e0 AS income,
         ((c_custkey * 37) % 101) / 101e0 AS target_share
  FROM customer)"""


def clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("club_id"), F.col("s_name").alias("name"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("department"),
        *[c.alias(n) for n, c in spot("s_suppkey", CLUB).items()],
        F.when(F.col("s_acctbal") >= 0, (k % 14).cast("int")).alias("courts"),
        F.col("s_acctbal").alias("balance"),
    )


CLUBS_SQL = f"""clubs AS (
  SELECT s_suppkey AS club_id, s_name AS name, lpad(s_nationkey::VARCHAR, 2, '0') AS department,
         {spot_sql('s_suppkey', CLUB)},
         CASE WHEN s_acctbal >= 0 THEN (s_suppkey % 14)::INTEGER END AS courts, s_acctbal AS balance
  FROM supplier)"""


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("osm_id"), *[c.alias(n) for n, c in spot("p_partkey", STOP).items()]
    )


STOPS_SQL = f"stops AS (SELECT p_partkey AS osm_id, {spot_sql('p_partkey', STOP)} FROM part)"


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("osm_id"),
        *[c.alias(f"{n}_center") for n, c in spot("o_orderkey", ROAD).items()],
    )


ROADS_SQL = (
    f"roads AS (SELECT o_orderkey AS osm_id, {spot_sql('o_orderkey', ROAD, 'lat_center', 'lon_center')} "
    "FROM orders)"
)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("department"),
            F.lpad((F.col("l_partkey") % 7).cast("string"), 3, "0").alias("commune"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_m2"),
        )
    )


SALES_SQL = """sales AS (
  SELECT lpad(s_nationkey::VARCHAR, 2, '0') AS department, lpad((l_partkey % 7)::VARCHAR, 3, '0') AS commune,
         l_extendedprice / l_quantity AS price_m2
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
PRICES_SQL = SALES_SQL + """, prices AS (
  SELECT department, commune, quantile_disc(price_m2, 0.5) AS price_m2, count(*) AS n_sales
  FROM sales GROUP BY ALL)"""


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("cell_id"))
        .agg(F.count("*").cast("int").alias("demand_index"))
    )


DEMAND_SQL = """demand AS (
  SELECT o_custkey AS cell_id, count(*)::INTEGER AS demand_index
  FROM orders GROUP BY o_custkey)"""

# the library's default sketch size, at which approximate quantiles per group are exact on the tables checked here
ACCURACY = 10_000
