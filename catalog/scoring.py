"""Normalisation, sub-scores, the composite score and the exports made from it."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from catalog.base import (
    ACCURACY, CELLS_SQL, CLUBS_SQL, DEMAND_SQL, PRICES_SQL, ROADS_SQL, STOPS_SQL, cells, clubs, demand, query, roads,
    sales, stops, table,
)
from catalog.geography import pairs_sql
from placerank import fixed
from placerank.operators import stats
from placerank.operators.sets import union_all
from placerank.plans import access, exports, score
from placerank.session import cut_lineage, new_path
from placerank.sources.readers import read_geojson_document

CAP = 2100.0


def rounded(df, *keep, digits=6):
    """Doubles rounded, so that the order of floating-point sums does not show."""
    return df.select(
        *[F.round(c, digits).alias(c) if t in ("double", "float") and c not in keep else F.col(c) for c, t in df.dtypes]
    )


def norm_sql(x: str, lo: str, hi: str, degenerate: float) -> str:
    return f"CASE WHEN {hi} > {lo} THEN ({x} - {lo}) / ({hi} - {lo}) ELSE {degenerate}e0 END"


@query("""
SELECT c_custkey, (c_acctbal - lo) / (hi - lo) AS balance_norm, (c_nationkey - nlo) / (nhi - nlo) AS nation_norm FROM customer,
  (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, min(c_nationkey)::DOUBLE AS nlo, max(c_nationkey)::DOUBLE AS nhi FROM customer)""")
def minmax(spark, d):
    out = stats.minmax(
        table(spark, d, "customer"), {"c_acctbal": "balance_norm", "c_nationkey": "nation_norm"}, degenerate=0.5
    )
    return out.select("c_custkey", "balance_norm", "nation_norm")


@query("""SELECT c_custkey, 0.5e0 AS flat_norm, 0.0e0 AS empty_norm FROM customer""")
def minmax_degenerate(spark, d):
    df = table(spark, d, "customer").select(
        "c_custkey", (F.col("c_nationkey") * 0 + 3).alias("flat"),
        F.when(F.col("c_acctbal") > 1e9, F.col("c_acctbal")).alias("empty"),
    )
    out = stats.minmax(stats.minmax(df, {"flat": "flat_norm"}, 0.5), {"empty": "empty_norm"}, 0.0)
    return out.select("c_custkey", "flat_norm", "empty_norm")


ACCESS_SQL = f"""{STOPS_SQL}, {ROADS_SQL}, {pairs_sql('stops', '0.01', 1, name='ps')},
{pairs_sql('roads', '0.02', 2, 'lat_center', 'lon_center', name='pr')},
am AS (SELECT c.*, coalesce(s.n, 0) AS n_stops, r.km AS road0 FROM cells c
  LEFT JOIN (SELECT cell_id, count(DISTINCT osm_id) AS n FROM ps WHERE km <= 1 GROUP BY 1) s USING (cell_id)
  LEFT JOIN (SELECT cell_id, min(km) AS km FROM pr GROUP BY 1) r USING (cell_id)),
af AS (SELECT * EXCLUDE (road0), coalesce(road0, (SELECT coalesce(max(road0), 50) + 5 FROM am)) AS road_km FROM am),
an AS (SELECT af.*, {norm_sql('n_stops', 'sl', 'sh', 0.0)} AS n_stops_norm, {norm_sql('road_km', 'rl', 'rh', 0.0)} AS road_km_norm
  FROM af, (SELECT min(n_stops) AS sl, max(n_stops) AS sh, min(road_km) AS rl, max(road_km) AS rh FROM af)),
access AS (SELECT *, 0.6 * n_stops_norm + 0.4 * (1 - road_km_norm) AS access_score FROM an)"""


def scored_access(spark, d):
    metrics = access.access_metrics(cells(spark, d), stops(spark, d), roads(spark, d), unique_stops=True)
    return access.access_score(metrics)


@query(f"""
WITH {CELLS_SQL}, {ACCESS_SQL} SELECT cell_id, n_stops, round(road_km, 6) AS road_km, round(n_stops_norm, 6) AS n_stops_norm,
  round(road_km_norm, 6) AS road_km_norm, round(access_score, 6) AS access_score FROM access""")
def access_score(spark, d):
    return rounded(scored_access(spark, d).select("cell_id", "n_stops", "road_km", "n_stops_norm", "road_km_norm", "access_score"))


def competition_sql(source: str) -> str:
    return f"""{CLUBS_SQL}, {pairs_sql('clubs', '0.05', 3, name='pc')},
cm AS (SELECT c.*, coalesce(x.km, 50) AS club_km, coalesce(x.n, 0)::INTEGER AS n_clubs FROM {source} c
  LEFT JOIN (SELECT cell_id, min(km) AS km, count(*) FILTER (km <= 5) AS n FROM pc GROUP BY 1) x USING (cell_id)),
comp AS (SELECT cm.*, least(1, 1 - ({norm_sql('n_clubs', 'cl', 'ch', 0.5)}) + CASE WHEN club_km > 10 THEN 0.1e0 ELSE 0e0 END) AS competition_score
  FROM cm, (SELECT min(n_clubs) AS cl, max(n_clubs) AS ch FROM cm))"""


@query(f"""
WITH {CELLS_SQL}, {competition_sql('cells')} SELECT cell_id, round(club_km, 6) AS club_km, n_clubs, round(competition_score, 6) AS competition_score FROM comp""")
def competition_score(spark, d):
    out = score.competition_score(score.competition_metrics(cells(spark, d), clubs(spark, d)))
    return rounded(out.select("cell_id", "club_km", "n_clubs", "competition_score"))


def _prices(spark, d):
    """The price table is used twice, for the join and for its median."""
    return cut_lineage(
        stats.median_by(sales(spark, d), ["department", "commune"], "price_m2", ACCURACY, "price_m2", "n_sales")
    )


def property_sql(source: str) -> str:
    return f"""{PRICES_SQL},
pj AS (SELECT c.*, coalesce(p.price_m2, (SELECT quantile_disc(price_m2, 0.5) FROM prices)) AS price_m2
  FROM {source} c LEFT JOIN prices p ON c.department = p.department AND substr(c.commune, 3, 3) = p.commune),
prop AS (SELECT pj.*, {norm_sql('price_m2', 'pl', 'ph', 0.5)} AS price_m2_norm, 1 - ({norm_sql('price_m2', 'pl', 'ph', 0.5)}) AS property_score
  FROM pj, (SELECT min(price_m2) AS pl, max(price_m2) AS ph FROM pj) WHERE price_m2 <= {CAP})"""


@query(f"""
WITH {CELLS_SQL}, {property_sql('cells')} SELECT cell_id, round(price_m2, 6) AS price_m2, round(price_m2_norm, 6) AS price_m2_norm,
  round(property_score, 6) AS property_score FROM prop""")
def property_score(spark, d):
    priced = score.join_prices(cells(spark, d), _prices(spark, d), accuracy=ACCURACY)
    out = score.property_score(priced, cap=CAP)
    return rounded(out.select("cell_id", "price_m2", "price_m2_norm", "property_score"))


def demand_sql(source: str) -> str:
    return f"""{DEMAND_SQL},
dj AS (SELECT c.*, coalesce(m.demand_index, (SELECT quantile_disc(demand_index, 0.5) FROM demand)) AS demand_index
  FROM {source} c LEFT JOIN demand m USING (cell_id)),
dem AS (SELECT dj.*, {norm_sql('demand_index', 'dl', 'dh', 0.5)} AS demand_index_norm
  FROM dj, (SELECT min(demand_index) AS dl, max(demand_index) AS dh FROM dj))"""


@query(f"""
WITH {CELLS_SQL}, {demand_sql('cells')} SELECT cell_id, demand_index, round(demand_index_norm, 6) AS demand_index_norm FROM dem""")
def demand_factor(spark, d):
    out = score.demand_factor(score.join_demand(cells(spark, d), demand(spark, d), accuracy=ACCURACY))
    return rounded(out.select("cell_id", "demand_index", "demand_index_norm"))


COMPOSITE_SQL = f"""{CELLS_SQL}, {ACCESS_SQL},
inc AS (SELECT access.*, (income - il) / (ih - il) AS income_score FROM access, (SELECT min(income) AS il, max(income) AS ih FROM access)),
{competition_sql('inc')}, {property_sql('comp')}, {demand_sql('prop')},
scored AS (SELECT *, (0.30 * competition_score + 0.25 * access_score + 0.20 * property_score + 0.15 * income_score + 0.10 * target_share)
  * demand_index_norm AS score FROM dem)"""


def scored(spark, d, prices=None):
    """Cells with every sub-score and the composite score; all joins run before the one cut."""
    located = access.access_metrics(cells(spark, d), stops(spark, d), roads(spark, d), unique_stops=True, cut=False)
    joined = score.gather_metrics(located, clubs(spark, d), prices or _prices(spark, d), demand(spark, d), accuracy=ACCURACY)
    normed = stats.minmax(access.access_score(joined), {"income": "income_score"}, degenerate=0.0)
    return score.score_metrics(normed, cap=CAP)


@query(f"""
WITH {COMPOSITE_SQL} SELECT cell_id, commune, department, round(competition_score, 6) AS competition_score, round(access_score, 6) AS access_score,
  round(property_score, 6) AS property_score, round(income_score, 6) AS income_score, round(target_share, 6) AS target_share,
  round(demand_index_norm, 6) AS demand_index_norm, round(score, 6) AS score FROM scored""")
def composite_score(spark, d):
    out = scored(spark, d)
    return rounded(out.select(
        "cell_id", "commune", "department", "competition_score", "access_score", "property_score", "income_score",
        "target_share", "demand_index_norm", "score",
    ))


SENSITIVITY_SQL = ",\n".join(
    [COMPOSITE_SQL]
    + [
        f"""v_{name} AS (SELECT cell_id, '{name}' AS combo FROM scored ORDER BY round(({w[0]} * competition_score + {w[1]} * access_score
  + {w[2]} * property_score + {w[3]} * income_score + {w[4]} * target_share) * demand_index_norm, 9) DESC, cell_id LIMIT 500)"""
        for name, w in fixed.WEIGHT_SETS.items()
    ]
    + [
        "st AS (SELECT cell_id, count(DISTINCT combo) AS stability FROM ("
        + " UNION ALL ".join(f"FROM v_{name}" for name in fixed.WEIGHT_SETS)
        + ") GROUP BY 1)",
        "stable AS (SELECT scored.*, coalesce(stability, 0) AS stability FROM scored LEFT JOIN st USING (cell_id))",
    ]
)


def stable(spark, d, prices=None):
    base = scored(spark, d, prices)
    return score.with_stability(base, score.sensitivity(base, digits=9))


@query(f"WITH {SENSITIVITY_SQL} SELECT cell_id, stability FROM stable")
def sensitivity(spark, d):
    return stable(spark, d).select("cell_id", "stability")


TOP_SQL = f"""{SENSITIVITY_SQL},
top AS (SELECT *, (row_number() OVER (ORDER BY round(score, 9) DESC, cell_id))::INTEGER AS rank_score FROM stable QUALIFY rank_score <= 1000)"""


def top(spark, d, base=None):
    # rounded, so that cells equal but for the last bits rank by id on every engine
    return score.top_cells((base or stable(spark, d)).withColumn("score", F.round("score", 9)))


@query(f"""
WITH {TOP_SQL} SELECT commune, department, count(*) AS n_cells, round(avg(score), 6) AS score_avg, round(avg(competition_score), 6) AS competition_score_avg,
  round(avg(access_score), 6) AS access_score_avg, round(avg(property_score), 6) AS property_score_avg, round(avg(income_score), 6) AS income_score_avg,
  round(avg(target_share), 6) AS target_share_avg, round(avg(demand_index / 3e0), 6) AS demand_index_avg, round(avg(stability / 3e0), 6) AS stability_avg,
  round(avg(lat), 6) AS lat_center, round(avg(lon), 6) AS lon_center FROM top GROUP BY ALL HAVING count(*) >= 3""")
def top_zones(spark, d):
    best = top(spark, d).withColumns({c: F.col(c) / 3.0 for c in ("demand_index", "stability")})
    return rounded(score.zones(best))


def _ranked(spark, d, base=None):
    return exports.export_top(top(spark, d, base))


@query(f"""
WITH {TOP_SQL}, t AS (SELECT cell_id, commune, department, lat, lon, round(score, 9) AS score FROM top)
SELECT cell_id, commune, department, round(lat, 6) AS lat, round(lon, 6) AS lon, round(score, 6) AS score,
  (row_number() OVER (ORDER BY score DESC, cell_id))::INTEGER AS rank_national,
  (row_number() OVER (PARTITION BY department ORDER BY score DESC, cell_id))::INTEGER AS rank_department,
  CASE WHEN score > 0.75 THEN 'Premium' WHEN score > 0.65 THEN 'Excellent' WHEN score > 0.55 THEN 'Bon' ELSE 'Correct' END AS tier,
  commune || ' - ' || floor(score * 100 + 0.5)::BIGINT::VARCHAR || '%' AS label FROM t""")
def export_top(spark, d):
    return rounded(_ranked(spark, d))


EXPORT_SQL = f"""{SENSITIVITY_SQL},
ex AS (SELECT s.cell_id, s.commune, s.department, s.lat, s.lon, s.score::FLOAT::DOUBLE AS score,
  s.competition_score::FLOAT::DOUBLE AS competition_score, s.access_score::FLOAT::DOUBLE AS access_score,
  s.property_score::FLOAT::DOUBLE AS property_score, s.income_score::FLOAT::DOUBLE AS income_score, s.target_share::FLOAT::DOUBLE AS target_share,
  s.club_km::FLOAT::DOUBLE AS club_km, s.road_km::FLOAT::DOUBLE AS road_km, (m.c_custkey % 11)::FLOAT AS men_pauv, (m.c_custkey % 7)::FLOAT AS ind_18_24,
  (m.c_custkey % 13)::FLOAT AS ind_25_39, CASE WHEN m.c_custkey % 5 <> 1 THEN m.c_custkey % 5 ELSE 0 END::FLOAT AS i_pauv,
  s.stability::SMALLINT AS stability, s.demand_index::FLOAT AS demand_index, s.n_clubs::INTEGER AS n_clubs, s.price_m2::FLOAT::DOUBLE AS price_m2,
  coalesce(p.n_sales, -1)::INTEGER AS n_sales, m.c_nationkey::DOUBLE AS ind, m.c_acctbal::FLOAT::DOUBLE AS ind_snv, s.n_stops::FLOAT AS n_stops,
  CASE WHEN s.score > 0.8 THEN 'A+' WHEN s.score > 0.7 THEN 'A' WHEN s.score > 0.6 THEN 'B' WHEN s.score > 0.5 THEN 'C' ELSE 'D' END AS grade,
  CASE WHEN s.n_clubs = 0 THEN 'Zone blanche' WHEN s.n_clubs <= 2 THEN 'Faible' WHEN s.n_clubs <= 5 THEN 'Concurrentiel' ELSE 'Sature' END AS competition_label,
  (m.c_nationkey * 25)::INTEGER AS population
  FROM stable s JOIN customer m ON s.cell_id = m.c_custkey
  LEFT JOIN prices p ON s.department = p.department AND substr(s.commune, 3, 3) = p.commune)"""


def exported(spark, d, base=None):
    prices = _prices(spark, d)  # made once, for the score and for the counts of sales
    census = table(spark, d, "customer").select(
        F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").cast("double").alias("Ind"), F.col("c_acctbal").alias("Ind_snv"),
        (F.col("c_custkey") % 11).alias("Men_pauv"), (F.col("c_custkey") % 7).alias("Ind_18_24"), (F.col("c_custkey") % 13).alias("Ind_25_39"),
        F.when(F.col("c_custkey") % 5 != 1, F.col("c_custkey") % 5).cast("double").alias("I_pauv"),
    )
    return exports.export_cells(base or stable(spark, d, prices), prices, census)


# float32 columns, rounded as doubles well above their precision
EXPORT_DIGITS = {
    **dict.fromkeys(["score", "competition_score", "access_score", "property_score", "income_score", "target_share"], 4),
    **dict.fromkeys(["club_km", "road_km"], 3), **dict.fromkeys(["price_m2", "ind_snv"], 2), "lat": 6, "lon": 6,
}


@query(f"""
WITH {EXPORT_SQL} SELECT cell_id, commune, department, {", ".join(f"round({c}, {n}) AS {c}" for c, n in EXPORT_DIGITS.items())},
  stability, demand_index, n_clubs, n_sales, ind::FLOAT AS ind, men_pauv, ind_18_24, ind_25_39, i_pauv, n_stops, grade, competition_label, population FROM ex""")
def export_cells(spark, d):
    return exported(spark, d).withColumns({c: F.round(F.col(c).cast("double"), n) for c, n in EXPORT_DIGITS.items()})


@query(f"""
WITH {EXPORT_SQL} SELECT commune, min(department) AS department, count(*) AS n_cells, round(avg(score), 4) AS score_avg,
  round(max(score), 4) AS score_max, round(avg(access_score), 4) AS access_score_avg, round(avg(lat), 6) AS lat_center,
  round(avg(lon), 6) AS lon_center FROM ex GROUP BY commune""")
def export_communes(spark, d):
    out = exports.export_communes(exported(spark, d))
    return out.select(
        "commune", "department", "n_cells", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("score_avg", "score_max", "access_score_avg")],
        *[F.round(c, 6).alias(c) for c in ("lat_center", "lon_center")],
    )


@query(f"""
WITH {EXPORT_SQL} SELECT department, count(*) AS n_cells, round(avg(score), 4) AS score_avg, round(quantile_disc(score, 0.9), 4) AS score_p90,
  round(avg(price_m2), 2) AS price_m2_avg, round(avg(n_clubs / 3e0), 4) AS n_clubs_avg FROM ex GROUP BY department""")
def export_departments(spark, d):
    out = exports.export_departments(exported(spark, d), accuracy=ACCURACY)
    return out.select(
        "department", "n_cells", F.round("score_avg", 4).alias("score_avg"),
        F.round(F.col("score_p90").cast("double"), 4).alias("score_p90"),
        F.round("price_m2_avg", 2).alias("price_m2_avg"), F.round(F.col("n_clubs_avg") / 3, 4).alias("n_clubs_avg"),
    )


@query(f"""
WITH {EXPORT_SQL}, u AS (
  SELECT name, 'club' AS type, department, lat, lon, courts, 'A' AS source, true AS is_primary FROM clubs
  UNION ALL SELECT 'Stop ' || osm_id, 'stop', 'N/A', lat, lon, (osm_id % 5)::INTEGER, 'B', false FROM stops),
k AS (SELECT *, floor(lat * 1000 + 0.5) AS ky, floor(lon * 1000 + 0.5) AS kx FROM u
  QUALIFY row_number() OVER (PARTITION BY ky, kx ORDER BY is_primary DESC, courts DESC NULLS LAST, source, name) = 1),
z AS (SELECT *, floor(lat * 100 + 0.5) AS ky, floor(lon * 100 + 0.5) AS kx FROM ex
  QUALIFY row_number() OVER (PARTITION BY ky, kx ORDER BY score DESC, cell_id) = 1)
SELECT k.name, k.type, k.department, k.courts, k.source, k.is_primary, round(coalesce(z.score, 0), 4) AS zone_score,
  coalesce(z.n_clubs > 5, false) AS saturated, coalesce(round(z.ind_snv, 2), 0) AS zone_income FROM k
LEFT JOIN z ON floor(k.lat * 100 + 0.5) = z.ky AND floor(k.lon * 100 + 0.5) = z.kx""")
def export_clubs(spark, d):
    main = clubs(spark, d).select(
        "name", F.lit("club").alias("type"), F.lit(None).cast("string").alias("commune"), "department", "lat", "lon", "courts",
        F.lit("A").alias("source"),
    )
    annex = stops(spark, d).select(
        F.concat(F.lit("Stop "), F.col("osm_id").cast("string")).alias("name"), F.lit("stop").alias("type"),
        F.lit(None).cast("string").alias("commune"), F.lit(None).cast("string").alias("department"), "lat", "lon",
        (F.col("osm_id") % 5).cast("int").alias("courts"), F.lit("B").alias("source"),
    )
    out = exports.export_clubs(main, annex, exported(spark, d))
    return out.select(
        "name", "type", "department", "courts", "source", "is_primary",
        F.round(F.col("zone_score").cast("double"), 4).alias("zone_score"), "saturated",
        F.round(F.col("zone_income").cast("double"), 2).alias("zone_income"),
    )


@query(f"""
WITH {EXPORT_SQL}{TOP_SQL.removeprefix(SENSITIVITY_SQL)},
t AS (SELECT cell_id, commune, lat, lon FROM top),
z AS (SELECT commune, avg(lat) AS zlat, avg(lon) AS zlon FROM ex GROUP BY commune)
SELECT 'cells' AS name, count(*) AS n, round(sum(round(score, 4)), 3) AS total FROM ex
UNION ALL SELECT 'communes', count(DISTINCT commune), count(*)::DOUBLE FROM ex
UNION ALL SELECT 'communes csv', count(DISTINCT commune), count(*)::DOUBLE FROM ex
UNION ALL SELECT 'departments', count(DISTINCT department), count(*)::DOUBLE FROM ex
UNION ALL SELECT 'top', count(*), (count(*) * (count(*) + 1) / 2)::DOUBLE FROM t
UNION ALL SELECT 'top map', count(*), round(sum(round(coalesce(z.zlon, t.lon), 4)), 2) FROM t LEFT JOIN z USING (commune)""")
def write_exports(spark, d):
    """All export tables written to their folders and read back from them, one in folders per department, one also as CSV, and the map."""
    base = cut_lineage(stable(spark, d))  # scored once, for the cells and for the top list
    made = cut_lineage(exported(spark, d, base))
    best = cut_lineage(_ranked(spark, d, base))
    communes = exports.export_communes(made)
    root = new_path(spark, "exports")
    written = exports.write_exports(
        {"cells": made, "communes": communes, "departments": exports.export_departments(made, accuracy=ACCURACY), "top": best},
        root, partition={"cells": "department"}, csv=["communes"],
    )
    exports.write_top_geojson(best, f"{root}/map", communes)
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    points = read_geojson_document(spark, f"{root}/map", StructType([StructField("cell_id", LongType())]))
    tables = {
        "cells": (read("cells"), F.round(F.sum(F.round(F.col("score").cast("double"), 4)), 3)),
        "communes": (read("communes"), F.sum("n_cells")),
        "communes csv": (spark.read.option("header", True).csv(f"{root}/communes_csv"), F.sum("n_cells")),
        "departments": (read("departments"), F.sum("n_cells")),
        "top": (read("top"), F.sum("rank_national")),
        "top map": (points, F.round(F.sum(F.round("lon", 4)), 2)),
    }
    rows = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), total.cast("double").alias("total")) for name, (df, total) in tables.items()]
    if any(written[name] != n for name, n in ((t, read(t).count()) for t in written)):
        raise ValueError("the counts of write_exports are not those of its files")
    return union_all(rows)
