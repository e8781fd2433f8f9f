"""Aggregation, joins, de-duplication, ranking and set operations."""

from pyspark.sql import functions as F

from catalog.base import (
    ACCURACY, CELL, CELLS_SQL, CLUBS_SQL, PRICES_SQL, STOP, cells, clubs, query, sales, spot, spot_sql, table,
)
from placerank import fixed
from placerank.operators import dedupe, joins, rank, rollup as roll, sets, sketches, spatial, stats
from placerank.plans import score
from placerank.session import cut_lineage, new_path
from placerank.sources import readers, writers


@query("""
SELECT l_returnflag, l_suppkey, quantile_disc(l_extendedprice / l_quantity, 0.5) AS median, count(*) AS n
FROM lineitem GROUP BY ALL""")
def group_median(spark, d):
    priced = table(spark, d, "lineitem").select(
        "l_returnflag", "l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
    )
    return stats.median_by(priced, ["l_returnflag", "l_suppkey"], "price", ACCURACY)


@query("""
SELECT l_orderkey, count(*) AS n, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1""")
def first_per_group(spark, d):
    return stats.count_and_label(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL""")
def count_by(spark, d):
    return stats.count_by(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


@query("""
SELECT c_mktsegment, count(DISTINCT c_nationkey) AS n_distinct, count(*) FILTER (c_acctbal > 5000) AS n_rich
FROM customer GROUP BY 1""")
def distinct_by(spark, d):
    customers = table(spark, d, "customer")
    rich = customers.groupBy("c_mktsegment").agg(roll.count_where(F.col("c_acctbal") > 5000).alias("n_rich"))
    return roll.distinct_by(customers, ["c_mktsegment"], "c_nationkey").join(rich, "c_mktsegment")


@query("""
SELECT event_type, count(DISTINCT user_id) AS n_active, sum(CASE WHEN value < 50 THEN coalesce(event_id % 12, 0) ELSE 0 END)::BIGINT AS n_total,
  max(ts) AS last_time FROM events GROUP BY 1""")
def state_by_group(spark, d):
    rows = table(spark, d, "events").withColumn("courts", F.when(F.col("value") < 50, F.col("event_id") % 12))
    return roll.state_by_group(rows, "event_type", "user_id", "courts", "ts")


@query(f"""
WITH {CELLS_SQL} SELECT commune, department, count(*) AS n_cells, round(avg(income), 6) AS income_avg,
  round(avg(target_share), 6) AS share_avg, round(avg(lat), 6) AS lat_center, round(avg(lon), 6) AS lon_center
FROM cells GROUP BY commune, department HAVING count(*) >= 3""")
def zone_rollup(spark, d):
    out = roll.rollup(
        cells(spark, d), ["commune", "department"], count="n_cells", min_count=3, centroid=("lat", "lon"),
        averages={"income_avg": "income", "share_avg": "target_share"},
    )
    return out.withColumns({
        "income_avg": F.round("income_avg", 6),
        **{c: F.round(c, 6) for c in ("share_avg", "lat_center", "lon_center")},
    })


@query(f"""
WITH {CELLS_SQL} SELECT commune, min(department) AS department, count(*) AS n_cells, round(avg(target_share), 6) AS share_avg,
  max(income) AS income_max, round(avg(lat), 6) AS lat_center, round(avg(lon), 6) AS lon_center FROM cells GROUP BY commune""")
def commune_rollup(spark, d):
    out = roll.rollup(
        cells(spark, d), ["commune"], count="n_cells", labels={"department": "department"}, centroid=("lat", "lon"),
        averages={"share_avg": "target_share"}, maxima={"income_max": "income"},
    )
    return out.withColumns({c: F.round(c, 6) for c in ("share_avg", "lat_center", "lon_center")})


@query(f"""
WITH {CELLS_SQL} SELECT department, count(*) AS n, round(avg(target_share), 6) AS share_avg,
  quantile_disc(income, 0.9) AS income_p90 FROM cells GROUP BY department""")
def department_rollup(spark, d):
    out = roll.rollup(
        cells(spark, d), ["department"], averages={"share_avg": "target_share"},
        quantiles={"income_p90": ("income", 0.9)}, accuracy=ACCURACY,
    )
    return out.withColumn("share_avg", F.round("share_avg", 6))


@query("""
SELECT min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity, min(l_extendedprice) AS min_l_extendedprice,
  max(l_extendedprice) AS max_l_extendedprice, quantile_disc(l_extendedprice, 0.5) AS median FROM lineitem""")
def global_stats(spark, d):
    lines = table(spark, d, "lineitem")
    median = stats.global_median(lines, "l_extendedprice", exact=True).scalar()
    return stats.min_max(lines, ["l_quantity", "l_extendedprice"]).withColumn("median", median)


@query("""
SELECT count(*) AS n, min(o_totalprice) AS min, max(o_totalprice) AS max, quantile_disc(o_totalprice, 0.5) AS p50,
  quantile_disc(o_totalprice, 0.9) AS p90, quantile_disc(o_totalprice, 0.99) AS p99 FROM orders""")
def quantile_profile(spark, d):
    return stats.quantile_profile(table(spark, d, "orders"), "o_totalprice", exact=True)


@query("""
SELECT nullif(o_orderpriority, '5-LOW') AS priority, median(o_totalprice) AS o_totalprice,
  median(CASE WHEN o_orderpriority <> '2-HIGH' THEN o_custkey::DOUBLE END) AS o_custkey FROM orders GROUP BY 1""")
def group_median_exact(spark, d):
    rows = table(spark, d, "orders").select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"), "o_totalprice",
        F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_custkey").cast("double")).alias("o_custkey"),
    )
    return stats.exact_median_by(rows, ["priority"], ["o_totalprice", "o_custkey"])


@query("""
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.02), 6) AS l_extendedprice_low,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS l_extendedprice_mid, round(quantile_cont(l_extendedprice, 0.98), 6) AS l_extendedprice_high
FROM lineitem GROUP BY 1""")
def quantiles_exact(spark, d):
    out = stats.exact_quantiles(
        table(spark, d, "lineitem"), ["l_extendedprice"], {"low": 0.02, "mid": 0.5, "high": 0.98}, ["l_returnflag"],
        accuracy=1000,
    )
    return out.select("l_returnflag", *[F.round(c, 6).alias(c) for c in out.columns if c != "l_returnflag"])


@query("""
SELECT round(quantile_cont(o_totalprice / 500000, 0.02), 9) AS color_min, round(quantile_cont(o_totalprice / 500000, 0.98), 9) AS color_max FROM orders""")
def color_range(spark, d):
    scored = table(spark, d, "orders").select((F.col("o_totalprice") / 500000).alias("score"))
    out = stats.color_range(scored, "score")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query("""
SELECT 'price' AS name, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part
UNION ALL SELECT 'region unit', min(n_regionkey * 0 + 3)::DOUBLE, max(n_regionkey * 0 + 3)::DOUBLE + 1 FROM nation
UNION ALL SELECT 'region relative', min(n_regionkey * 0 + 3) - 0.03e0, max(n_regionkey * 0 + 3) + 0.03e0 FROM nation
UNION ALL SELECT 'none', 0e0, 100e0""")
def bounds(spark, d):
    three = table(spark, d, "nation").select((F.col("n_regionkey") * 0 + 3).alias("v"))
    rows = {
        "price": stats.bounds(table(spark, d, "part"), "p_retailprice"),
        "region unit": stats.bounds(three, "v"),
        "region relative": stats.bounds(three, "v", widen="relative"),
        "none": stats.bounds(three.filter("v > 5"), "v", fallback=(0.0, 100.0)),
    }
    return sets.union_all([b.select(F.lit(n).alias("name"), "lo", "hi") for n, b in rows.items()])


@query("""
SELECT 'cells' AS name, count(*) AS n FROM customer UNION ALL SELECT 'sales', count(*) FROM lineitem
UNION ALL SELECT 'departments', count(DISTINCT c_nationkey) FROM customer UNION ALL SELECT 'segments', count(DISTINCT c_mktsegment) FROM customer""")
def volumes(spark, d):
    customers = table(spark, d, "customer")
    return stats.volumes(
        {"cells": customers, "sales": table(spark, d, "lineitem")},
        {"departments": (customers, "c_nationkey"), "segments": (customers, "c_mktsegment")},
    )


@query("""
SELECT o_custkey, o_orderstatus, n, l_orderkey FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def join_inner(spark, d):
    counted = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return joins.join_keys(counted, orders, {"l_orderkey": "o_orderkey"}, "inner")


@query("""
SELECT c_custkey, c_name, coalesce(n, 0) AS n_orders FROM customer
LEFT JOIN (SELECT o_custkey * 2 AS c_custkey, count(*) AS n FROM orders GROUP BY 1) USING (c_custkey)""")
def join_left(spark, d):
    # odd keys find nothing, and large ones have no partner
    counted = table(spark, d, "orders").groupBy((F.col("o_custkey") * 2).alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return joins.enrich(table(spark, d, "customer").select("c_custkey", "c_name"), counted, "c_custkey", {"n_orders": 0})


@query("""
WITH a AS (SELECT o_custkey * 2 AS c_custkey, count(*) AS n_open FROM orders GROUP BY 1),
b AS (SELECT o_custkey * 3 AS c_custkey, max(o_totalprice) AS top_price FROM orders GROUP BY 1),
e AS (SELECT user_id AS c_custkey, count(*) AS n_events FROM events GROUP BY 1)
SELECT c_custkey, n_open, top_price, n_events FROM customer LEFT JOIN a USING (c_custkey) LEFT JOIN b USING (c_custkey) LEFT JOIN e USING (c_custkey)""")
def join_chain(spark, d):
    orders = table(spark, d, "orders")
    dims = [
        orders.groupBy((F.col("o_custkey") * 2).alias("c_custkey")).agg(F.count("*").alias("n_open")),
        orders.groupBy((F.col("o_custkey") * 3).alias("c_custkey")).agg(F.max("o_totalprice").alias("top_price")),
        table(spark, d, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n_events")),
    ]
    return joins.enrich_all(table(spark, d, "customer").select("c_custkey"), dims, "c_custkey")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey""")
def join_broadcast(spark, d):
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    nations = table(spark, d, "nation").select("n_nationkey", "n_name")
    return joins.enrich(joins.enrich(lines, suppliers, "l_suppkey"), nations, "n_nationkey").drop("l_suppkey", "n_nationkey")


@query(f"""
WITH {CELLS_SQL}, {PRICES_SQL} SELECT cell_id, coalesce(p.price_m2, (SELECT quantile_disc(price_m2, 0.5) FROM prices)) AS price_m2
FROM cells c LEFT JOIN prices p ON c.department = p.department AND substr(c.commune, 3, 3) = p.commune""")
def join_composite(spark, d):
    prices = cut_lineage(
        stats.median_by(sales(spark, d), ["department", "commune"], "price_m2", ACCURACY, "price_m2", "n_sales")
    )
    joins.assert_unique(prices, ["department", "commune"])
    return score.join_prices(cells(spark, d), prices, accuracy=ACCURACY).select("cell_id", "price_m2")


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows)


DEPARTMENTS_SQL = "dim(department, dname, region) AS (" + _values((c, n, r) for c, (n, r) in fixed.DEPARTMENTS.items()) + ")"


@query(f"""
WITH {CELLS_SQL}, {DEPARTMENTS_SQL} SELECT cell_id, department, coalesce(dname, 'Departement ' || department) AS department_name,
  coalesce(region, 'Autres') AS region FROM cells LEFT JOIN dim USING (department)""")
def dim_lookup(spark, d):
    dim = readers.dim_departments(spark).drop("region_order")
    return joins.lookup(
        cells(spark, d).select("cell_id", "department"), dim, "department",
        {"department_name": "Departement {}", "region": fixed.UNKNOWN_REGION},
    )


@query("WITH m(region, department) AS (" + _values((r, x) for r, xs in fixed.REGION_DEPARTMENTS.items() for x in xs) + f"""), {CELLS_SQL},
i AS (SELECT region, count(*) AS n_cells FROM cells JOIN m USING (department) GROUP BY 1)
SELECT region, department, n_cells FROM i JOIN m USING (region)""")
def map_explode_join(spark, d):
    mapping = readers.dim_region_departments(spark)
    flat = mapping.select("region", F.explode("departments").alias("department"))
    index = cells(spark, d).join(flat, "department").groupBy("region").agg(F.count("*").alias("n_cells"))
    return joins.project_to_members(index, mapping, "region", "departments", "department")


@query(f"""
WITH {CELLS_SQL}, z AS (SELECT commune, avg(lon) AS x, avg(lat) AS y FROM cells GROUP BY 1 HAVING count(*) >= 6)
SELECT cell_id, round(coalesce(x, lon), 6) AS lon, round(coalesce(y, lat), 6) AS lat FROM cells LEFT JOIN z USING (commune)""")
def attach_geometry(spark, d):
    zones = roll.rollup(
        cells(spark, d), ["commune"], min_count=6, centroid=("lon", "lat"), centroid_names=("geo_lon", "geo_lat")
    )
    placed = writers.with_geometry(cells(spark, d), zones, "commune", "lon", "lat")
    return placed.select("cell_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


REGISTRIES_SQL = f"""u AS (SELECT 'A' AS source, c_custkey AS id, {spot_sql('c_custkey', CELL)}, c_nationkey AS courts, true AS is_primary FROM customer
  UNION ALL SELECT 'B', p_partkey, {spot_sql('p_partkey', STOP)}, NULL, false FROM part),
k AS (SELECT *, floor(lat * 10 + 0.5) AS ky, floor(lon * 10 + 0.5) AS kx FROM u)"""


def _registries(spark, d):
    a = table(spark, d, "customer").select(
        F.lit("A").alias("source"), F.col("c_custkey").alias("id"), *[c.alias(n) for n, c in spot("c_custkey", CELL).items()],
        F.col("c_nationkey").alias("courts"), F.lit(True).alias("is_primary"),
    )
    b = table(spark, d, "part").select(
        F.lit("B").alias("source"), F.col("p_partkey").alias("id"), *[c.alias(n) for n, c in spot("p_partkey", STOP).items()],
        F.lit(False).alias("is_primary"),
    )
    return sets.union_all([a, b])


@query(f"""
WITH {REGISTRIES_SQL} SELECT source, id, lat, lon, courts FROM k
QUALIFY row_number() OVER (PARTITION BY ky, kx ORDER BY courts DESC NULLS LAST, source, id) = 1""")
def round_dedupe(spark, d):
    order = [F.col("courts").desc_nulls_last(), F.asc("source"), F.asc("id")]
    return dedupe.dedupe_spatial(_registries(spark, d), "lat", "lon", 1, order).drop("is_primary")


@query(f"""
WITH {REGISTRIES_SQL} SELECT source, id, lat, lon, courts FROM k
QUALIFY row_number() OVER (PARTITION BY ky, kx ORDER BY is_primary ASC, courts DESC NULLS LAST, id DESC) = 1""")
def priority_dedupe(spark, d):
    order = [F.asc("is_primary"), F.col("courts").desc_nulls_last(), F.desc("id")]
    return dedupe.dedupe_spatial(_registries(spark, d), "lat", "lon", 1, order).drop("is_primary")


@query("""
SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber) = 1""")
def best_match(spark, d):
    order = [F.col("l_extendedprice").desc_nulls_last(), F.asc("l_orderkey"), F.asc("l_linenumber")]
    lines = table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return dedupe.best_per(lines, ["l_partkey"], order)


@query("""
SELECT user_id, event_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_by_key(spark, d):
    return dedupe.latest_per(table(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", "ts", "event_id")


@query("""
SELECT id, label FROM (SELECT c_custkey AS id, c_name AS label, 0 AS r FROM customer
  UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier UNION ALL SELECT user_id, 'user ' || event_type, 2 FROM events)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY r DESC, label DESC) = 1""")
def keep_last(spark, d):
    frames = [
        table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label")),
        table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label")),
        table(spark, d, "events").select(F.col("user_id").alias("id"), F.concat(F.lit("user "), F.col("event_type")).alias("label")),
    ]
    return dedupe.keep_last(frames, ["id"], [F.desc("label")])


@query("""SELECT count(*) AS n, count(DISTINCT (c_custkey, c_name)) AS n_ids FROM customer""")
def stable_id(spark, d):
    ids = table(spark, d, "customer").select(dedupe.stable_id("c_custkey", "c_name").alias("id"))
    return ids.agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))


@query(f"""
WITH {CELLS_SQL}, {CLUBS_SQL}, b AS (SELECT *, floor(lat * 10 + 0.5) AS ky, floor(lon * 10 + 0.5) AS kx FROM cells
  QUALIFY row_number() OVER (PARTITION BY floor(lat * 10 + 0.5), floor(lon * 10 + 0.5) ORDER BY target_share DESC NULLS LAST, cell_id) = 1)
SELECT c.club_id, b.cell_id, b.target_share AS cell_share FROM clubs c
LEFT JOIN b ON floor(c.lat * 10 + 0.5) = ky AND floor(c.lon * 10 + 0.5) = kx""")
def nearest_cell_match(spark, d):
    grid = cells(spark, d).select("cell_id", F.col("lat").alias("cell_lat"), F.col("lon").alias("cell_lon"), F.col("target_share").alias("cell_share"))
    matched = spatial.match_cell(
        clubs(spark, d), grid, 1, [F.col("cell_share").desc_nulls_last(), F.asc("cell_id")], place_id="club_id"
    )
    return matched.select("club_id", "cell_id", "cell_share")


@query("""
SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey))::INTEGER AS rank FROM orders QUALIFY rank <= 1000""")
def topk_global(spark, d):
    return rank.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 1000)


@query("""
SELECT o_orderpriority, o_orderkey, o_totalprice, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey))::INTEGER AS rank
FROM orders QUALIFY rank <= 500""")
def topk_variants(spark, d):
    return rank.top_k_per(
        table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice"), ["o_orderpriority"],
        [F.desc("o_totalprice"), F.asc("o_orderkey")], 500,
    )


@query("""
WITH t AS (SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000)
SELECT *, (row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey))::INTEGER AS rank_all,
  (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey))::INTEGER AS rank_part FROM t""")
def dual_rank(spark, d):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    top = rank.head(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), order, 1000)
    return rank.dual_rank(top, order, ["o_orderpriority"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
  row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem""")
def rank_all(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return rank.global_rank(lines, order)


@query("""SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5""")
def order_limit(spark, d):
    return rank.head(table(spark, d, "customer").select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), F.asc("c_custkey")], 5)


@query("""
SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, NULL::VARCHAR AS phone FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, NULL, s_name FROM supplier""")
def union_by_name(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_name").alias("phone"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"))
    return sets.union_all([a, b])


@query("""
SELECT 'cell' AS kind, c_custkey AS id FROM customer UNION ALL SELECT 'club', s_suppkey FROM supplier UNION ALL SELECT 'stop', p_partkey FROM part""")
def union_n(spark, d):
    parts = {"cell": ("customer", "c_custkey"), "club": ("supplier", "s_suppkey"), "stop": ("part", "p_partkey")}
    return sets.union_all(
        [table(spark, d, t).select(F.lit(kind).alias("kind"), F.col(key).alias("id")) for kind, (t, key) in parts.items()]
    )


@query(f"""
WITH {CELLS_SQL}, {DEPARTMENTS_SQL}
SELECT department, 'missing' AS problem FROM (SELECT department FROM dim EXCEPT SELECT department FROM cells)
UNION ALL SELECT department, 'extra' FROM (SELECT department FROM cells EXCEPT SELECT department FROM dim)""")
def coverage_check(spark, d):
    return sets.coverage_check(cells(spark, d), "department", readers.dim_departments(spark))


@query("""SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem""")
def distinct_keys(spark, d):
    return sets.distinct_keys(table(spark, d, "lineitem"), "l_suppkey", "l_returnflag")


@query("""
SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS price_min, max(l_extendedprice) AS price_max, true AS p50_within, true AS p90_within
FROM lineitem GROUP BY 1""")
def sketch_table(spark, d):
    """Sketches per year of sale and flag, one year replayed, merged to the flag; the ranks of the answers are then counted exactly."""
    lines = table(spark, d, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("price"), F.year(F.col("l_shipdate").cast("date")).alias("year")
    )
    path, k, asked = new_path(spark, "sketches"), 4096, {"p50": 0.5, "p90": 0.9}
    sketches.write_parts(lines, path, "year", ["l_returnflag"], ["price"], k)
    sketches.write_part(lines.filter("year = 1995"), path, "1995", ["l_returnflag"], ["price"], k)
    found = sketches.quantiles(sketches.read_merged(spark, path, ["l_returnflag"]), asked, ["l_returnflag"])
    counts = [F.count_if(F.col("price") < F.col(f"price_{q}")).alias(f"{q}_below") for q in asked]
    counts += [F.count_if(F.col("price") <= F.col(f"price_{q}")).alias(f"{q}_upto") for q in asked]
    ranked = lines.join(found, "l_returnflag").groupBy("l_returnflag", "n", "price_min", "price_max").agg(*counts)
    error = 2 * sketches.rank_error(k)  # twice what 99 of 100 hold
    within = [
        ((F.col(f"{name}_below") / F.col("n") - error <= q) & (F.col(f"{name}_upto") / F.col("n") + error >= q)).alias(f"{name}_within")
        for name, q in asked.items()
    ]
    return ranked.select("l_returnflag", "n", "price_min", "price_max", *within)
