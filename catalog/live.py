"""Live clubs, competition pressure and the views of a dashboard."""

from pyspark.sql import functions as F

from catalog.base import CLUBS_SQL, USER, clubs, hav_sql, query, spot, spot_sql, table
from catalog.grouping import DEPARTMENTS_SQL
from catalog.scoring import rounded
from placerank import fixed
from placerank.operators import dedupe
from placerank.plans import live, views
from placerank.sources import readers

SINCE = "2024-01-30"


def base(spark, d):
    """Batch clubs with zone values; some have none, some a zero score."""
    b = F.col("balance")
    return live.normalize_base(
        clubs(spark, d).select(
            F.col("club_id").cast("string").alias("club_id"), "name", F.lit("Club").alias("type"), "department", "lat", "lon",
            F.col("courts").cast("double").alias("courts"), F.lit("registry").alias("source"),
            F.concat(F.lit("Ville "), F.col("department")).alias("commune"), (F.col("club_id") % 3 == 0).alias("saturated"),
            F.when(b >= 1000, b / 11000.0).otherwise(F.lit(0.0)).alias("zone_score"),
            F.when(b < 9000, b / 10000.0).alias("zone_access"), (b * 3).alias("zone_income"),
            F.when(b > 500, b / 4).alias("zone_price"), (b / 100).alias("zone_demand"), (b / 20000).alias("zone_target_share"),
        )
    )


BASE_SQL = f"""{CLUBS_SQL},
base AS (SELECT club_id::VARCHAR AS club_id, name, 'Club' AS type, 'Ville ' || department AS commune, department, lat, lon,
  courts::DOUBLE AS courts, 'registry' AS source, club_id % 3 = 0 AS saturated,
  CASE WHEN balance >= 1000 THEN balance / 11000 ELSE 0 END AS zone_score, CASE WHEN balance < 9000 THEN balance / 10000 END AS zone_access,
  balance * 3 AS zone_income, CASE WHEN balance > 500 THEN balance / 4 END AS zone_price, balance / 100 AS zone_demand,
  balance / 20000 AS zone_target_share, 'Batch' AS stream_source FROM clubs)"""


def current(spark, d):
    """Latest event of every user, 'error' being a deletion."""
    state = dedupe.latest_per(table(spark, d, "events"), "user_id", "ts", "event_id").filter("event_type <> 'error'")
    k = F.col("user_id")
    where = spot("user_id", USER)
    return state.select(
        F.concat(F.lit("u"), k.cast("string")).alias("club_id"), F.concat(F.lit("Live "), k.cast("string")).alias("name"),
        F.lit("Live city").alias("city"), F.lpad((k % 30).cast("string"), 2, "0").alias("department"),
        where["lat"].alias("latitude"), where["lon"].alias("longitude"),
        F.regexp_extract("props", r"(\d+)", 1).try_cast("int").alias("courts"),
        F.col("event_type").alias("event_time"), F.col("ts").alias("event_timestamp"),
    )


CURRENT_SQL = f"""cur AS (SELECT * FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
  WHERE event_type <> 'error' AND ts >= TIMESTAMP '{SINCE}'),
med AS (SELECT department, median(zone_score) AS zone_score, median(zone_access) AS zone_access, median(zone_income) AS zone_income,
  median(zone_price) AS zone_price, median(zone_demand) AS zone_demand, median(zone_target_share) AS zone_target_share FROM base GROUP BY 1),
live0 AS (SELECT 'u' || user_id AS club_id, 'Live ' || user_id AS name, 'Club streaming' AS type, 'Live city' AS commune,
  lpad((user_id % 30)::VARCHAR, 2, '0') AS department, {spot_sql('user_id', USER)}, regexp_extract(props, '(\\d+)', 1)::DOUBLE AS courts,
  'Kafka' AS source, false AS saturated FROM cur),
live AS (SELECT live0.*, m.* EXCLUDE (department), 'Streaming' AS stream_source FROM live0 LEFT JOIN med m ON live0.department = m.department)"""

LIVE_COLUMNS = ["club_id", "name", "type", "commune", "department", "courts", "source", "saturated", "stream_source", *live.ZONE_COLUMNS]


def _live(spark, d):
    state = current(spark, d)
    # an older copy of the same clubs, which the second one replaces
    return live.live_enrich([state.withColumn("name", F.lit("stale")), state], base(spark, d), since=SINCE)


@query(f"""
WITH {BASE_SQL}, {CURRENT_SQL} SELECT club_id, name, type, commune, department, courts, source, saturated, stream_source,
  round(zone_score, 6) AS zone_score, round(zone_access, 6) AS zone_access, round(zone_income, 6) AS zone_income, round(zone_price, 6) AS zone_price,
  round(zone_demand, 6) AS zone_demand, round(zone_target_share, 6) AS zone_target_share FROM live""")
def live_enrich(spark, d):
    return rounded(_live(spark, d).select(*LIVE_COLUMNS))


UNIFIED_SQL = f"""{BASE_SQL}, {CURRENT_SQL},
uni AS (SELECT club_id, name, type, commune, department, lat, lon, courts, source, saturated, zone_score, zone_access, zone_income,
    zone_price, zone_demand, zone_target_share, stream_source FROM base
  UNION ALL SELECT club_id, name, type, commune, department, lat, lon, courts, source, saturated, zone_score, zone_access, zone_income,
    zone_price, zone_demand, zone_target_share, stream_source FROM live)"""


def unified(spark, d):
    return live.unified_clubs(base(spark, d), _live(spark, d))


@query(f"""
WITH {UNIFIED_SQL} SELECT club_id, name, type, commune, department, courts, source, saturated, stream_source, round(zone_score, 6) AS zone_score FROM uni""")
def unified_clubs(spark, d):
    return rounded(unified(spark, d).select(
        "club_id", "name", "type", "commune", "department", "courts", "source", "saturated", "stream_source", "zone_score"
    ))


SCORE_BASE = """coalesce(CASE WHEN zone_score > 0 THEN zone_score END,
  (SELECT median(zone_score) FROM {t} WHERE zone_score > 0), 0.35)"""


@query(f"""WITH {BASE_SQL} SELECT club_id, round({SCORE_BASE.format(t='base')}, 6) AS score_base FROM base""")
def score_base(spark, d):
    return rounded(live.score_base(base(spark, d)).select("club_id", "score_base"))


def pressure_sql(name: str, targets: str, competitors: str, base_i: float, slope: float) -> str:
    """Every pair of a target and another competitor, as the definition has it."""
    km = hav_sql("t.lat", "t.lon", "c.lat", "c.lon")
    return f"""{name} AS (SELECT club_id, least(0.45, coalesce(sum(CASE WHEN km <= 55 THEN pow(greatest(1 - km / 55, 0), 1.25)
    * ({base_i} + {slope} * least(greatest(coalesce(courts, 2), 1), 12) / 12) END), 0)) AS pressure, min(CASE WHEN km <= 55 THEN km END) AS km
  FROM (SELECT t.club_id, c.courts, {km} AS km FROM {targets} t LEFT JOIN {competitors} c ON t.club_id <> c.club_id) GROUP BY 1)"""


@query(f"""
WITH {BASE_SQL}, {pressure_sql('bp', 'base', 'base', 0.002, 0.008)}
SELECT club_id, round(pressure, 6) AS base_pressure, round(km, 6) AS base_nearest_km FROM bp""")
def base_pressure(spark, d):
    return rounded(live.base_pressure(base(spark, d), club_id="club_id"))


@query(f"""
WITH {UNIFIED_SQL}, lv AS (SELECT * FROM uni WHERE stream_source = 'Streaming'), {pressure_sql('ep', 'uni', 'lv', 0.035, 0.16)}
SELECT club_id, round(pressure, 6) AS event_pressure, round(km, 6) AS event_nearest_km FROM ep""")
def event_pressure(spark, d):
    return rounded(live.event_pressure(unified(spark, d), club_id="club_id"))


LIVE_SCORE_SQL = f"""{UNIFIED_SQL}, lv AS (SELECT * FROM uni WHERE stream_source = 'Streaming'), bt AS (SELECT * FROM uni WHERE stream_source = 'Batch'),
{pressure_sql('bp', 'bt', 'bt', 0.002, 0.008)}, {pressure_sql('ep', 'uni', 'lv', 0.035, 0.16)},
ls AS (SELECT uni.*, {SCORE_BASE.format(t='uni')} AS score_base, least(0.45, coalesce(bp.pressure, 0) + ep.pressure) AS competition_pressure,
  ep.pressure AS event_pressure, least(bp.km, ep.km) AS distance_to_club_km FROM uni LEFT JOIN bp USING (club_id) JOIN ep USING (club_id)),
scored AS (SELECT *, least(1, greatest(0.02, score_base - competition_pressure)) AS score, 0 - event_pressure AS score_delta,
  event_pressure >= 0.008 AS score_impacted FROM ls)"""


def live_scored(spark, d):
    return live.live_score(unified(spark, d))


@query(f"""
WITH {LIVE_SCORE_SQL} SELECT club_id, stream_source, round(score_base, 6) AS score_base, round(competition_pressure, 6) AS competition_pressure,
  round(event_pressure, 6) AS event_pressure, round(distance_to_club_km, 6) AS distance_to_club_km, round(score, 6) AS score,
  round(score_delta, 6) AS score_delta, score_impacted FROM scored""")
def live_score(spark, d):
    return rounded(live_scored(spark, d).select(
        "club_id", "stream_source", "score_base", "competition_pressure", "event_pressure", "distance_to_club_km", "score",
        "score_delta", "score_impacted",
    ))


FACETS = dict(
    departments=[f"{i:02d}" for i in range(3, 28)], facet="any", keyword="club",
    ranges={"zone_access": (0.1, 0.95), "zone_price": (100.0, 2300.0)}, commune=" ville 1", saturated=False,
)
FACETS_SQL = """department BETWEEN '03' AND '27' AND (zone_access BETWEEN 0.1 AND 0.95 OR zone_access IS NULL)
  AND (zone_price BETWEEN 100 AND 2300 OR zone_price IS NULL) AND contains(lower(commune), 'ville 1') AND NOT saturated"""


@query(f"WITH {UNIFIED_SQL} SELECT club_id, commune, department FROM uni WHERE {FACETS_SQL}")
def facet_filter(spark, d):
    return views.facet_filter(unified(spark, d), **FACETS).select("club_id", "commune", "department")


@query(f"WITH {UNIFIED_SQL} SELECT club_id FROM uni WHERE stream_source = 'Batch' AND zone_price BETWEEN 500 AND 2000")
def facet_strict(spark, d):
    out = views.facet_filter(unified(spark, d), source="Batch", strict_ranges={"zone_price": (500.0, 2000.0)})
    return out.select("club_id")


@query(f"""
WITH {LIVE_SCORE_SQL} SELECT count(*) FILTER ({FACETS_SQL}) AS visible, count(*) FILTER (stream_source = 'Streaming') AS live,
  count(*) FILTER (score_impacted AND {FACETS_SQL}) AS impacted_visible, count(*) FILTER (score_impacted) AS impacted FROM scored""")
def kpis(spark, d):
    return views.kpis(live_scored(spark, d), **FACETS)


ORDER_SQL = "CASE region " + " ".join(f"WHEN '{r.replace(chr(39), chr(39) * 2)}' THEN {i}" for i, r in enumerate(fixed.REGION_ORDER) if r != "Autres") + " ELSE 1000000 END"


@query(f"""
WITH {DEPARTMENTS_SQL}, u AS (SELECT DISTINCT lpad(c_nationkey::VARCHAR, 2, '0') AS department FROM customer),
n AS (SELECT department, coalesce(region, 'Autres') AS region, coalesce(dname, 'Departement ' || department) || ' - ' || department AS label
  FROM u LEFT JOIN dim USING (department))
SELECT region, ({ORDER_SQL})::INTEGER AS region_order, department, label,
  (row_number() OVER (PARTITION BY region ORDER BY label, department))::INTEGER AS position FROM n""")
def region_groups(spark, d):
    used = table(spark, d, "customer").select(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("department"))
    return views.region_groups(used, readers.dim_departments(spark))
