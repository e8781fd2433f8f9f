"""Projections, filters and scalar functions."""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from catalog.base import ACCURACY, CELL, cells, query, spot, spot_sql, table
from placerank import fixed
from placerank.functions import codes, geo, scores, text
from placerank.operators import clean
from placerank.plans import views


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       try_cast(replace(CASE WHEN l_discount = 0 THEN 'n/a' ELSE replace(l_extendedprice::VARCHAR, '.', ',') END, ',', '.')
                AS DOUBLE) AS price
FROM lineitem""")
def decimal_parse(spark, d):
    price = F.col("l_extendedprice").cast("string")
    written = F.when(F.col("l_discount") == 0, F.lit("n/a")).otherwise(F.translate(price, ".", ","))
    return clean.project(
        table(spark, d, "lineitem"),
        {
            "l_orderkey": F.col("l_orderkey"), "l_linenumber": F.col("l_linenumber"),
            "l_partkey": F.col("l_partkey"), "price": text.decimal_comma(written),
        },
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity AS unit_price
FROM lineitem
WHERE l_returnflag = 'N' AND l_extendedprice > 0 AND l_quantity > 20 AND l_discount BETWEEN 0.01 AND 0.08""")
def unit_price_filter(spark, d):
    base = table(spark, d, "lineitem").filter(
        clean.all_of(F.col("l_returnflag") == "N", F.col("l_extendedprice") > 0, F.col("l_quantity") > 20)
    )
    kept = clean.filter_if(base, "l_discount" in base.columns, F.col("l_discount").between(0.01, 0.08))
    return kept.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        scores.safe_ratio("l_extendedprice", "l_quantity").alias("unit_price"),
    )


@query(f"""
SELECT cell_id, lat, lon FROM (SELECT c_custkey AS cell_id, {spot_sql('c_custkey', CELL)} FROM customer)
WHERE lat BETWEEN 44e0 AND 46.5e0 AND lon BETWEEN 0e0 AND 5e0""")
def bbox_filter(spark, d):
    return cells(spark, d).select("cell_id", "lat", "lon").filter(geo.in_bbox("lat", "lon", (44.0, 46.5, 0.0, 5.0)))


@query("""
SELECT p_partkey, p_name, p_brand FROM part
WHERE regexp_matches(p_name, '(?i)GEAR') AND starts_with(p_brand, 'Brand#1') AND p_type = 'ECONOMY'
  AND p_name IS NOT NULL AND p_name <> '[ND]'""")
def keyword_filter(spark, d):
    return table(spark, d, "part").filter(
        text.active_in_sector("p_brand", "p_type", "Brand#1", "ECONOMY", ["p_name"])
        & text.matches_keyword("p_name", "GEAR")
    ).select("p_partkey", "p_name", "p_brand")


KIND = "CASE p_type WHEN 'ECONOMY' THEN 'Court de Tennis' WHEN 'SMALL' THEN 'Piste' WHEN 'PROMO' THEN 'Club' ELSE p_type END"


def _kinds(spark, d):
    kind = (
        F.when(F.col("p_type") == "ECONOMY", "Court de Tennis").when(F.col("p_type") == "SMALL", "Piste")
        .when(F.col("p_type") == "PROMO", "Club").otherwise(F.col("p_type"))
    )
    return table(spark, d, "part").select(
        "p_partkey", F.concat(kind, F.lit(" "), F.col("p_name")).alias("type"), F.col("p_name").alias("name"),
        *[c.alias(n) for n, c in spot("p_partkey", CELL).items()],
    )


@query(f"""
SELECT p_partkey, contains(t, 'bolt') AS is_any, contains(t, 'tennis') AND contains(t, 'bolt') AS is_tennis,
       contains(t, 'piste') AND contains(t, 'bolt') AS is_court,
       contains(t, 'club') AND contains(t, 'bolt') AND NOT contains(t, 'tennis') AS is_club
FROM (SELECT p_partkey, lower({KIND} || ' ' || p_name) AS t FROM part)""")
def type_facets(spark, d):
    return _kinds(spark, d).select(
        "p_partkey",
        *[text.type_facet("type", "name", m, "bolt").alias(f"is_{m}") for m in ("any", "tennis", "court", "club")],
    )


@query(f"""
SELECT p_partkey FROM (SELECT p_partkey, p_name, {spot_sql('p_partkey', CELL)} FROM part)
WHERE regexp_matches(p_name, '(?i)Gizmo') AND lat BETWEEN 43.5e0 AND 48e0 AND lon BETWEEN 0e0 AND 6e0""")
def base_population(spark, d):
    return views.base_population(_kinds(spark, d), "Gizmo", (43.5, 48.0, 0.0, 6.0)).select("p_partkey")


CODE_SQL = """CASE WHEN c_custkey % 100 = 20 THEN '2a' || lpad((c_custkey % 1000)::VARCHAR, 3, '0')
  WHEN c_custkey % 100 = 96 THEN ' 2B' || lpad((c_custkey % 1000)::VARCHAR, 3, '0')
  WHEN c_custkey % 100 = 97 THEN '97' || (c_custkey % 8)::VARCHAR || lpad((c_custkey % 100)::VARCHAR, 2, '0')
  WHEN c_custkey % 100 = 98 THEN 'n/a' WHEN c_custkey % 100 = 99 THEN NULL
  ELSE lpad((c_custkey % 100)::VARCHAR, 2, '0') || lpad((c_custkey % 1000)::VARCHAR, 3, '0') END"""
GRID_SQL = """CASE c_mktsegment WHEN 'BUILDING' THEN 'CRS_' || lpad((c_nationkey)::VARCHAR, 2, '0') || '-X'
  WHEN 'MACHINERY' THEN 'FRMET' || lpad((c_nationkey)::VARCHAR, 2, '0') || 'B' ELSE 'CRS3035' END"""


def _codes(spark, d):
    k = F.col("c_custkey")

    def digits(c, n):
        return F.lpad(c.cast("string"), n, "0")

    code = (
        F.when(k % 100 == 20, F.concat(F.lit("2a"), digits(k % 1000, 3)))
        .when(k % 100 == 96, F.concat(F.lit(" 2B"), digits(k % 1000, 3)))
        .when(k % 100 == 97, F.concat(F.lit("97"), (k % 8).cast("string"), digits(k % 100, 2)))
        .when(k % 100 == 98, F.lit("n/a"))
        .when(k % 100 == 99, F.lit(None).cast("string"))
        .otherwise(F.concat(digits(k % 100, 2), digits(k % 1000, 3)))
    )
    dep = digits(F.col("c_nationkey"), 2)
    grid = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("CRS_"), dep, F.lit("-X")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("FRMET"), dep, F.lit("B")))
        .otherwise(F.lit("CRS3035"))
    )
    return table(spark, d, "customer").select("c_custkey", code.alias("code"), grid.alias("grid_id"))


@query(f"""
WITH c AS (SELECT c_custkey, {CODE_SQL} AS code, {GRID_SQL} AS grid_id FROM customer),
e AS (SELECT c_custkey, code,
  regexp_extract(upper(trim(code)), '^(2A|2B)', 1) AS corsica, regexp_extract(upper(trim(code)), '^(97[1-6])', 1) AS overseas,
  regexp_extract(upper(trim(code)), '^(0[1-9]|[1-8][0-9]|9[0-5])', 1) AS mainland,
  regexp_extract(grid_id, '(?:^|[_-])((?:0[1-9]|[1-8][0-9]|9[0-5]|2A|2B))(?:[_-]|$)', 1) AS grid1,
  regexp_extract(grid_id, '^FR(?:MET|DOM)?([0-9A-B]{{2,3}})', 1) AS grid2,
  regexp_extract(upper(code), '([0-9A-B]{{5}})', 1) AS five FROM c),
r AS (SELECT c_custkey, code, CASE WHEN corsica <> '' THEN corsica WHEN overseas <> '' THEN overseas
  WHEN mainland <> '' THEN mainland WHEN grid1 <> '' THEN grid1 WHEN grid2 <> '' THEN substr(grid2, 1, 2) END AS department,
  CASE WHEN length(five) = 5 THEN substr(five, 3, 3) END AS key3,
  CASE WHEN length(five) = 5 THEN substr(five, 3, 3) ELSE code END AS key3_raw FROM e)
SELECT c_custkey, department, key3, key3_raw,
  regexp_matches(department, '^(0[1-9]|[1-8][0-9]|9[0-5]|2A|2B)$') AS is_metropolitan,
  regexp_matches(department, '^(0[1-9]|[1-8][0-9]|9[0-5]|2A|2B|97[1-6])$') AS is_known FROM r""")
def code_extract(spark, d):
    return _codes(spark, d).select(
        "c_custkey", codes.department_of("code", "grid_id").alias("department"),
        codes.commune_key3("code").alias("key3"), codes.commune_key3("code", keep_raw=True).alias("key3_raw"),
    ).withColumns({"is_metropolitan": codes.valid_code("department"), "is_known": codes.valid_code("department", True)})


@query(f"""
SELECT cell_id, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE lat END AS lat,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE lon END AS lon
FROM (SELECT c_custkey AS cell_id, c_mktsegment, {spot_sql('c_custkey', CELL)} FROM customer)""")
def packed_coords(spark, d):
    where = spot("c_custkey", CELL)
    packed = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("inconnu"))
        .when(F.col("c_mktsegment") == "MACHINERY", where["lat"].cast("string"))
        .otherwise(F.concat_ws(",", where["lat"].cast("string"), where["lon"].cast("string")))
    )
    lat, lon = codes.split_point("packed")
    return table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), packed.alias("packed")).select(
        "cell_id", lat.alias("lat"), lon.alias("lon")
    )


@query("""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN (3000000 + c_custkey * 200)::VARCHAR ELSE 'given' END AS x,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE (2000000 + c_custkey * 200)::VARCHAR END AS y
FROM customer""")
def grid_id_coords(spark, d):
    k = F.col("c_custkey")
    full = F.concat(F.lit("CRS3035RES200mN"), (2000000 + k * 200).cast("string"), F.lit("E"), (3000000 + k * 200).cast("string"))
    no_n = F.concat(F.lit("CRS3035RES200m-E"), (3000000 + k * 200).cast("string"))
    ids = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "FURNITURE", no_n).otherwise(full).alias("grid_id"),
        F.when(F.col("c_acctbal") >= 0, F.lit("given")).alias("x"),
    )
    x, y = codes.coords_from_grid_id("grid_id", F.col("x"))
    return ids.select("c_custkey", x.alias("x"), y.alias("y"))


@query("""
SELECT p_partkey, coalesce(CASE WHEN regexp_matches(a, '(?i)bolt') THEN a END, CASE WHEN regexp_matches(b, '(?i)bolt') THEN b END,
  b, a, 'Lot ' || p_brand) AS name
FROM (SELECT p_partkey, p_brand, CASE WHEN p_size > 20 THEN upper(p_name) END AS a, CASE WHEN p_size < 30 THEN p_type || ' ' || p_name END AS b
      FROM (SELECT p_partkey, p_brand, p_size, p_type, CASE WHEN p_type <> 'PROMO' THEN p_name END AS p_name FROM part))""")
def name_priority(spark, d):
    name = F.when(F.col("p_type") != "PROMO", F.col("p_name"))
    named = table(spark, d, "part").select(
        "p_partkey", "p_brand", F.when(F.col("p_size") > 20, F.upper(name)).alias("a"),
        F.when(F.col("p_size") < 30, F.concat(F.col("p_type"), F.lit(" "), name)).alias("b"),
    )
    best = text.first_matching(["a", "b"], "bolt", ["b", "a"], F.concat(F.lit("Lot "), F.col("p_brand")))
    return named.select("p_partkey", best.alias("name"))


@query("""
WITH n AS (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(text)),
  '[àâä]', 'a', 'g'), '[éèêë]', 'e', 'g'), '[îï]', 'i', 'g'), '[ôö]', 'o', 'g'), '[ùûü]', 'u', 'g'), 'ç', 'c', 'g'),
  '[-_'']', ' ', 'g'), '[^a-z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g'), '^ | $', '', 'g')) AS t FROM documents)
SELECT doc_id, md5(t) AS digest, length(t)::INTEGER AS n_chars FROM n""")
def text_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize_text("text").alias("t")).select(
        "doc_id", F.md5("t").alias("digest"), F.length("t").alias("n_chars")
    )


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'fault' WHEN 'signup' THEN 'created' ELSE event_type END AS kind
FROM events""")
def alias_lookup(spark, d):
    return table(spark, d, "events").select(
        "event_id", text.lookup_alias("event_type", {"error": "fault", "signup": "created"}).alias("kind")
    )


@query("""
SELECT event_id, try_cast(nullif(regexp_extract(CASE WHEN value < 5 THEN 'none' ELSE props END, '(\\d+)', 1), '') AS INTEGER) AS first_number
FROM events WHERE event_type <> 'error'""")
def first_int(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", "event_type", F.when(F.col("value") < 5, F.lit("none")).otherwise(F.col("props")).alias("raw")
    )
    return clean.drop_value(rows, "event_type", "error").select("event_id", text.first_int("raw").alias("first_number"))


def _holes(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_nationkey") > 5, F.col("c_nationkey")).alias("nation"),
    )


HOLES = """h AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment, CASE WHEN c_nationkey > 5 THEN c_nationkey END AS nation
  FROM customer)"""


@query(f"WITH {HOLES} SELECT c_custkey, coalesce(balance, 0.5) AS balance, coalesce(segment, 'none') AS segment, nation FROM h")
def impute_constant(spark, d):
    return clean.impute_constant(_holes(spark, d), {"balance": 0.5, "segment": "none"})


@query(f"""WITH {HOLES} SELECT c_custkey, coalesce(balance, (SELECT quantile_disc(balance, 0.5) FROM h)) AS balance FROM h""")
def impute_median(spark, d):
    return clean.impute_stat(_holes(spark, d).select("c_custkey", "balance"), "balance", accuracy=ACCURACY)


@query(f"""WITH {HOLES} SELECT c_custkey, coalesce(balance, (SELECT max(balance) FROM h) + 5) AS balance FROM h""")
def impute_max_plus(spark, d):
    return clean.impute_stat(_holes(spark, d).select("c_custkey", "balance"), "balance", "max", offset=5.0, fallback=50.0)


@query(f"""WITH {HOLES} SELECT c_custkey, coalesce(balance, 0e0) AS balance, coalesce(segment, 'N/A') AS segment,
  coalesce(nation, -1) AS nation, 'registry' AS source, true AS is_primary FROM h""")
def provenance(spark, d):
    filled = clean.fill_by_class(_holes(spark, d), doubles=["balance"], ints=["nation"], strings=["segment"])
    return clean.with_provenance(filled, {"source": "registry", "is_primary": True})


@query("""
SELECT l_linenumber::SMALLINT AS l_linenumber, try_cast(l_orderkey * 7 AS SMALLINT) AS small_order, l_partkey::INTEGER AS l_partkey,
  l_extendedprice::FLOAT AS l_extendedprice, l_discount::FLOAT AS l_discount, l_orderkey FROM lineitem""")
def narrow_types(spark, d):
    wide = table(spark, d, "lineitem").select(
        "l_linenumber", (F.col("l_orderkey") * 7).alias("small_order"), "l_partkey", "l_extendedprice", "l_discount", "l_orderkey"
    )
    return clean.narrow(
        wide, {"float": ["l_extendedprice", "l_discount"], "smallint": ["l_linenumber", "small_order"], "int": ["l_partkey"]}
    )


@query("""
SELECT p_partkey AS part_id, p_name AS name, floor(p_retailprice * 25 + 0.5)::INTEGER AS population, p_size AS size FROM part""")
def final_schema(spark, d):
    renamed = clean.rename_map(
        table(spark, d, "part").withColumn("population", scores.scaled_int("p_retailprice", 25.0)),
        {"p_partkey": "part_id", "p_name": "name", "p_size": "size"},
    )
    return clean.select_existing(renamed, ["part_id", "name", "population", "absent", "size"])


@query("""
WITH s AS (SELECT c_custkey, (c_acctbal + 1000) / 11000e0 AS score, c_custkey % 8 AS n FROM customer)
SELECT c_custkey, CASE WHEN score > 0.8 THEN 'A+' WHEN score > 0.7 THEN 'A' WHEN score > 0.6 THEN 'B' WHEN score > 0.5 THEN 'C' ELSE 'D' END AS grade,
  CASE WHEN n = 0 THEN 'Zone blanche' WHEN n <= 2 THEN 'Faible' WHEN n <= 5 THEN 'Concurrentiel' ELSE 'Sature' END AS competition,
  CASE WHEN score > 0.75 THEN 'Premium' WHEN score > 0.65 THEN 'Excellent' WHEN score > 0.55 THEN 'Bon' ELSE 'Correct' END AS tier FROM s""")
def grade_labels(spark, d):
    s = table(spark, d, "customer").select(
        "c_custkey", ((F.col("c_acctbal") + 1000) / 11000.0).alias("score"), (F.col("c_custkey") % 8).alias("n")
    )
    return s.select(
        "c_custkey", scores.grade("score").alias("grade"), scores.competition_label("n").alias("competition"),
        scores.tier("score").alias("tier"),
    )


@query("""
SELECT c_custkey, c_mktsegment || ' - ' || floor((c_acctbal + 1000) / 11000e0 * 100e0 + 0.5)::BIGINT::VARCHAR || '%' AS label FROM customer""")
def percent_label(spark, d):
    share = (F.col("c_acctbal") + 1000) / 11000.0
    return table(spark, d, "customer").select("c_custkey", text.percent_label("c_mktsegment", share).alias("label"))


@query(f"WITH {HOLES} SELECT c_custkey, coalesce(nation > 12, false) AS saturated FROM h")
def flag(spark, d):
    return _holes(spark, d).select("c_custkey", scores.exceeds("nation", 12).alias("saturated"))


@query(f"""WITH {HOLES} SELECT c_custkey, (coalesce(balance, 0) + coalesce(nation, 0)) / nullif(nation, 7) AS share FROM h""")
def target_share(spark, d):
    return _holes(spark, d).select(
        "c_custkey",
        scores.share(["balance", F.col("nation").cast("double")], F.nullif(F.col("nation"), F.lit(7))).alias("share"),
    )


@query("""
SELECT c_custkey, least(1e0, c_custkey % 101 / 100e0 + CASE WHEN c_acctbal > 4000 THEN 0.1e0 ELSE 0e0 END) AS score FROM customer""")
def capped_bonus(spark, d):
    base = F.col("c_custkey") % 101 / F.lit(100.0)
    return table(spark, d, "customer").select(
        "c_custkey", scores.capped_bonus(base, F.col("c_acctbal") > 4000, fixed.FAR_CLUB_BONUS).alias("score")
    )


@query("""
SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN regexp_extract(props, '(\\d+)', 1)::INTEGER END AS k FROM events""")
def json_parse(spark, d):
    broken = F.when(F.col("event_type") == "error", F.substring("props", 2, 100)).otherwise(F.col("props"))
    rows = table(spark, d, "events").select("event_id", "event_type", broken.alias("raw"))
    return clean.flatten(clean.parse_json(rows, "raw", StructType([StructField("k", IntegerType())]), "parsed"), "parsed").drop("raw")


@query("""
SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '3-MEDIUM') AS is_on, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
  ELSE o_orderpriority IN ('1-URGENT', '3-MEDIUM') END AS is_known_on FROM orders""")
def bool_parse(spark, d):
    p = F.col("o_orderpriority")
    word = (
        F.when(p == "1-URGENT", " Oui ").when(p == "2-HIGH", "NO").when(p == "3-MEDIUM", "1")
        .when(p == "4-NOT SPECIFIED", "false").otherwise("peut-etre")
    )
    return table(spark, d, "orders").select("o_orderkey", word.alias("w")).select(
        "o_orderkey", text.parse_bool("w").alias("is_on"), text.parse_bool("w", default=None).alias("is_known_on")
    )
