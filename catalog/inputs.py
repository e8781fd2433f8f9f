"""Sources and sinks: the given tables written to the shared folder in another format and read back."""

from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType,
)

from catalog.base import (
    ACCURACY, CELL, CELLS_SQL, PRICES_SQL, ROAD, STOP, cells, query, sales, spot, spot_sql, table,
)
from catalog.grouping import _values
from placerank import fixed
from placerank.operators import clean, joins, sets, stats
from placerank.plans import census, clubs as club_plan, demand as demand_plan, exports, prices
from placerank.session import new_path
from placerank.sources import files, osm, readers, writers


def _write_csv(df, sep):
    """One file per task that has rows, so their number grows with the table."""
    path = new_path(df.sparkSession, "delimited")
    df.write.options(header=True, sep=sep).csv(path)
    return path


CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
TYPES = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}


def _typed(df):
    return clean.project(df, {c: F.col(c).try_cast(t) for c, t in TYPES.items()})


@query(CUSTOMER_SQL)
def csv_roundtrip(spark, d):
    path = _write_csv(table(spark, d, "customer"), "|")
    return _typed(readers.read_delimited(spark, [f"{path}/part-*.csv", f"{path}/*.csv"], sep="|", columns=list(TYPES)))


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_acctbal::VARCHAR AS c_acctbal, c_mktsegment FROM customer")
def header_schema(spark, d):
    path = _write_csv(table(spark, d, "customer"), ";")
    return readers.read_delimited(spark, f"{path}/*.csv", columns=["c_custkey", "c_acctbal", "c_mktsegment"])


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def typed_csv(spark, d):
    path = _write_csv(table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), ",")
    return readers.read_typed_csv(spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query("SELECT c_custkey::VARCHAR AS id, c_mktsegment AS segment, NULL::VARCHAR AS phone FROM customer")
def column_alias(spark, d):
    written = table(spark, d, "customer").select(F.col("c_custkey").alias("Id client"), F.col("c_mktsegment").alias("seg"))
    raw = readers.read_delimited(spark, f"{_write_csv(written, ',')}/*.csv")
    names = {"id": ["id", "Id client"], "segment": ["segment", "seg", "c_mktsegment"], "phone": ["phone", "tel"]}
    return clean.resolve_columns(raw, names, required=["id"])[0]


@query("SELECT s_suppkey, NULL::DOUBLE AS lat, NULL::DOUBLE AS lon, s_name, false AS has_gps FROM supplier")
def missing_column(spark, d):
    df, present = clean.with_missing(table(spark, d, "supplier").select("s_suppkey", "s_name"), {"lat": "double", "lon": "double"})
    return df.withColumn("has_gps", F.lit(present))


@query("SELECT s_suppkey::INTEGER AS id, s_name AS name, NULL::DOUBLE AS lat FROM supplier")
def conform_table(spark, d):
    path = new_path(spark, "annex")
    writers.write_table(table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("nom")), path)
    target = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("lat", DoubleType())])
    aliases = {"id": ["s_suppkey"], "name": ["nom"]}
    found = readers.read_or_empty(spark, files.first_existing(spark, [f"{path}-none", path]), target, aliases)
    return sets.union_all([found, readers.read_or_empty(spark, f"{path}-none", target, aliases)])


@query(f"WITH {CELLS_SQL} SELECT cell_id, department, commune, income FROM cells")
def partitioned_table(spark, d):
    path = new_path(spark, "cells")
    df = cells(spark, d).select("cell_id", "commune", "income", "department")
    writers.write_table(df, path, "department")
    return readers.read_table(spark, path, ["cell_id", "department", "commune", "income"], schema=df.schema)


@query(f"""WITH {CELLS_SQL} SELECT cell_id, commune, CASE WHEN income > 1000 THEN lon END AS lon, lat FROM cells WHERE income > 1000""")
def geojson_roundtrip(spark, d):
    path = new_path(spark, "geojson")
    df = cells(spark, d).withColumn("lon", F.when(F.col("income") > 1000, F.col("lon")))
    writers.write_geojson(df, path, "lon", "lat", ["cell_id", "commune"])
    properties = StructType([StructField("cell_id", LongType()), StructField("commune", StringType())])
    return readers.read_geojson_points(spark, path, properties)


def _nodes(spark, d):
    """Parts as map nodes: the type gives the tags, some have no location."""
    kind = F.col("p_type")

    def tag(*pairs):
        return F.create_map(*[F.lit(x) for x in pairs])

    tags = (
        F.when(kind == "ECONOMY", tag("highway", "bus_stop", "railway", "station"))
        .when(kind == "SMALL", tag("railway", "tram_stop"))
        .when(kind == "MEDIUM", tag("public_transport", "stop_position", "railway", "subway_entrance"))
        .when(kind == "PROMO", tag("public_transport", "stop_position"))
        .when(kind == "LARGE", tag("highway", "crossing"))
        .otherwise(tag("name", "x"))
    )
    where = spot("p_partkey", STOP)
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 3, where["lat"]).alias("lat"),
        F.when(F.col("p_size") > 3, where["lon"]).alias("lon"), tags.alias("tags"),
    )


NODES_SQL = f"""nodes AS (SELECT p_partkey AS id, CASE WHEN p_size > 3 THEN lat0 END AS lat, CASE WHEN p_size > 3 THEN lon0 END AS lon,
  CASE p_type WHEN 'ECONOMY' THEN 'bus_stop' WHEN 'SMALL' THEN 'tram_stop' WHEN 'MEDIUM' THEN 'subway_entrance' WHEN 'PROMO' THEN 'stop_position' END AS stop_type
  FROM (SELECT *, {spot_sql('p_partkey', STOP, 'lat0', 'lon0')} FROM part))"""


def _ways(spark, d):
    """Orders as ways over the parts of their lines: an order's few lines make its reference list."""
    refs = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("refs"))
    p = F.col("o_orderpriority")
    road = (
        F.when(p == "1-URGENT", "motorway").when(p == "2-HIGH", "trunk").when(p == "3-MEDIUM", "primary").otherwise("residential")
    )
    return table(spark, d, "orders").join(refs, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("id"), F.create_map(F.lit("highway"), road).alias("tags"), "refs"
    )


WAYS_SQL = """ways AS (SELECT o_orderkey AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'motorway' WHEN '2-HIGH' THEN 'trunk' WHEN '3-MEDIUM' THEN 'primary' END AS road_type,
  l_partkey AS node FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
axes AS (SELECT w.id AS osm_id, road_type, round(avg(lat), 9) AS lat_center, round(avg(lon), 9) AS lon_center
  FROM ways w JOIN nodes n ON w.node = n.id WHERE road_type IS NOT NULL AND lat IS NOT NULL GROUP BY ALL)"""


@query(f"WITH {NODES_SQL} SELECT id AS osm_id, stop_type, lat, lon FROM nodes WHERE stop_type IS NOT NULL AND lat IS NOT NULL")
def osm_stops(spark, d):
    return osm.osm_transport_stops(_nodes(spark, d))


@query(f"WITH {NODES_SQL}, {WAYS_SQL} SELECT * FROM axes")
def osm_roads(spark, d):
    axes = osm.osm_road_axes(_ways(spark, d), _nodes(spark, d))
    return axes.withColumns({c: F.round(c, 9) for c in ("lat_center", "lon_center")})


@query(f"""WITH {NODES_SQL}, {WAYS_SQL} SELECT (SELECT count(*) FROM nodes) AS nodes_seen, (SELECT count(DISTINCT id) FROM ways) AS ways_seen,
  (SELECT count(*) FROM nodes WHERE stop_type IS NOT NULL AND lat IS NOT NULL) AS stops_kept, (SELECT count(*) FROM axes) AS roads_kept,
  (SELECT count(DISTINCT id) FROM ways WHERE road_type IS NOT NULL) - (SELECT count(*) FROM axes) AS roads_without_nodes""")
def osm_stats(spark, d):
    return osm.osm_extract_stats(_nodes(spark, d), _ways(spark, d))


@query(f"""WITH {CELLS_SQL}, t AS (SELECT department, count(*) AS n FROM cells GROUP BY 1)
SELECT (SELECT count(*) FROM cells) AS written, department, n::VARCHAR AS n FROM t""")
def write_verified(spark, d):
    n = writers.write_verified(cells(spark, d), new_path(spark, "verified"), "department")
    path = new_path(spark, "csv")
    writers.write_csv_single(cells(spark, d).groupBy("department").agg(F.count("*").alias("n")), path)
    back = readers.read_delimited(spark, f"{path}/*.csv", sep=",")
    return back.select(F.lit(n).cast("long").alias("written"), "department", "n")


@query("""SELECT count(*) AS orders_rows, 0::BIGINT AS missing_rows, true AS has_size, min(o_totalprice) AS score_min, max(o_totalprice) AS score_max,
  quantile_disc(o_totalprice, 0.5) AS p50, quantile_disc(o_totalprice, 0.99) AS p99,
  (SELECT string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_totalprice DESC, o_orderkey) FROM (FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)) AS top5
FROM orders""")
def table_profile(spark, d):
    orders = table(spark, d, "orders")
    path = new_path(spark, "profile")
    writers.write_table(orders, f"{path}/orders")
    profile = exports.table_profile(
        spark, {"orders": f"{path}/orders", "missing": f"{path}/missing"}, orders, score="o_totalprice",
        tops={"top5": (orders, "o_orderkey", "o_totalprice")}, exact=True,
    )
    writers.write_profile(profile, f"{path}/metadata")
    back = spark.read.schema(profile.schema).json(f"{path}/metadata")
    return back.select(
        F.col("tables.orders.rows").alias("orders_rows"), F.col("tables.missing.rows").alias("missing_rows"),
        (F.col("tables.orders.size_mb") > 0).alias("has_size"), F.col("score_stats.min").alias("score_min"),
        F.col("score_stats.max").alias("score_max"), F.col("score_stats.p50").alias("p50"), F.col("score_stats.p99").alias("p99"),
        F.concat_ws(",", F.col("top5").cast("array<string>")).alias("top5"),
    )


@query("""
WITH s AS (SELECT lpad(s_nationkey::VARCHAR, 2, '0') AS department, lpad((l_partkey % 7)::VARCHAR, 3, '0') AS commune,
  l_extendedprice AS value, l_quantity * 10 AS surface FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'N')
SELECT department, commune, quantile_disc(value / surface, 0.5) AS price_m2, count(*) AS n_sales FROM s WHERE surface > 200 GROUP BY ALL""")
def price_plan(spark, d):
    """Sales files without coordinates, with decimal commas, to a price per commune."""
    def comma(c):
        return F.translate(c.cast("string"), ".", ",")

    raw = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_shipdate").cast("string").alias("Date mutation"), comma(F.col("l_extendedprice")).alias("Valeur fonciere"),
        F.lit("00000").alias("Code postal"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("Code departement"),
        F.lpad((F.col("l_partkey") % 7).cast("string"), 3, "0").alias("Code commune"),
        F.when(F.col("l_returnflag") == "N", F.lit(prices.SALE_KIND)).otherwise(F.lit("Maison")).alias("Type local"),
        comma(F.col("l_quantity") * 10).alias("Surface reelle bati"), F.col("l_tax").alias("Autre"),
    )
    loaded = prices.load_sales(spark, f"{_write_csv(raw, '|')}/*.csv")
    return prices.price_by_commune(prices.clean_sales(loaded), ACCURACY)


@query(f"""
WITH s AS (SELECT lpad(s_nationkey::VARCHAR, 2, '0') AS department, lpad((l_partkey % 7)::VARCHAR, 3, '0') AS commune,
  l_extendedprice AS value, l_quantity * 10 AS surface FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_returnflag = 'N' OR l_linenumber % 2 = 0),
k AS (SELECT * FROM s WHERE surface > 200)
SELECT department, commune, quantile_disc(value / surface, 0.5) AS price_m2, count(*) AS n_sales FROM k GROUP BY ALL""")
def price_vintages(spark, d):
    """Two vintages in one folder: the older without coordinates, the newer with some outside the country and another order of columns."""
    def comma(c):
        return F.translate(c.cast("string"), ".", ",")

    lines = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    older = {
        "Date mutation": F.col("l_shipdate").cast("string"), "Valeur fonciere": comma(F.col("l_extendedprice")), "Code postal": F.lit("00000"),
        "Code departement": F.lpad(F.col("s_nationkey").cast("string"), 2, "0"),
        "Code commune": F.lpad((F.col("l_partkey") % 7).cast("string"), 3, "0"), "Type local": F.lit(prices.SALE_KIND),
        "Surface reelle bati": comma(F.col("l_quantity") * 10),
    }
    here = F.col("l_linenumber") % 2 == 0
    newer = {"Longitude": F.when(here, "2,5").otherwise("-60,5"), "Latitude": F.when(here, "46,5").otherwise("5,5"), **older}
    path = new_path(spark, "vintages")
    for name, columns, rows in (("2020", older, lines.filter("l_returnflag = 'N'")), ("2021", newer, lines.filter("l_returnflag <> 'N'"))):
        rows.select(*[c.alias(n) for n, c in columns.items()]).write.options(header=True, sep="|").csv(f"{path}/{name}")
    loaded = prices.load_sales(spark, f"{path}/*/*.csv")
    return prices.price_by_commune(prices.clean_sales(loaded), ACCURACY)


@query("""
WITH c AS (SELECT c_custkey, lpad((c_custkey % 95 + 1)::VARCHAR, 2, '0') AS department, c_nationkey + 1 AS ind, c_acctbal AS income,
  c_custkey % 4 AS young, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey % 3 ELSE 0 END AS adult FROM customer
  WHERE c_acctbal > 0 AND c_mktsegment <> 'MACHINERY')
SELECT c_custkey::VARCHAR AS id, department, (young + adult) / ind::DOUBLE AS target_share, (income - lo) / (hi - lo) AS income_score
FROM c, (SELECT min(income) AS lo, max(income) AS hi FROM c)""")
def census_plan(spark, d):
    """Census files with other spellings and no coordinate columns, to located cells with features."""
    k = F.col("c_custkey")
    raw = table(spark, d, "customer").select(
        F.concat(F.lit("CRS3035RES200mN"), (2500000 + (k * 600) % 400000).cast("string"), F.lit("E"),
                 (3800000 + (k * 200) % 200000).cast("string"), F.lit("#"), k.cast("string")).alias("idcar_200m"),
        F.concat(F.lpad((k % 95 + 1).cast("string"), 2, "0"), F.lit("123")).alias("lcog_geo"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "0").otherwise("1").alias("i_est_200"),
        (F.col("c_nationkey") + 1).alias("ind"), F.translate(F.col("c_acctbal").cast("string"), ".", ",").alias("ind_snv"),
        (k % 4).alias("ind_18_24"), F.when(F.col("c_mktsegment") != "BUILDING", k % 3).alias("ind_25_39"),
    )
    loaded = census.load_census(spark, f"{_write_csv(raw, ';')}/*.csv")
    out = census.census_features(census.locate_census(census.clean_census(loaded)))
    return out.select(
        F.element_at(F.split("IdINSPIRE", "#"), -1).alias("id"), "department", "target_share", "income_score"
    )


@query("""
WITH e AS (SELECT l_suppkey AS inst, count(*)::INTEGER AS courts, min(p_name) AS type FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE contains(p_name, 'gear') GROUP BY 1),
a AS (SELECT s_name AS name, e.type, lpad((s_nationkey + 1)::VARCHAR, 2, '0') AS department, e.courts, 'registry' AS source,
  s_suppkey // 2 AS spot FROM supplier JOIN e ON s_suppkey = inst WHERE s_acctbal > 0),
b AS (SELECT CASE WHEN s_nationkey < 12 THEN 'Gear ' || s_name ELSE 'Unit gear ' || s_suppkey END AS name, 'Club' AS type,
  lpad((s_nationkey + 1)::VARCHAR, 2, '0') AS department, NULL::INTEGER AS courts, 'companies' AS source, s_suppkey AS id FROM supplier
  WHERE s_acctbal < 5000 AND s_nationkey <> 7),
d AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY spot ORDER BY courts DESC, source, name) = 1)
SELECT name, type, department, courts, source FROM d UNION ALL SELECT name, type, department, courts, source FROM b""")
def clubs_plan(spark, d):
    """Equipment counted per installation and companies by name, merged by position."""
    supplier = table(spark, d, "supplier")
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    equipment = lines.select(F.col("l_suppkey").cast("string").alias("installation_numero"), F.col("p_name").alias("type"))
    dep = F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0")
    key = F.col("s_suppkey")
    # two installations share a position; the companies lie further east
    half = F.floor(key / 2)
    place = F.concat_ws(
        ",", (44.0 + half % 5000 / F.lit(1000.0)).cast("string"), (F.floor(half / 5000) / F.lit(1000.0)).cast("string")
    )
    installations = supplier.select(
        key.cast("string").alias("numero"), F.col("s_name").alias("nom"), F.lit("Ville").alias("commune"), dep.alias("dep_code"),
        F.when(F.col("s_acctbal") > 0, place).otherwise("?").alias("coordonnees"),
    )
    x, y = "coordonneeLambertAbscisseEtablissement", "coordonneeLambertOrdonneeEtablissement"
    establishments = supplier.select(
        F.col("s_suppkey").cast("string").alias("siren"),
        F.when(F.col("s_acctbal") < 5000, "93.11Z").otherwise("47.11A").alias("activitePrincipaleEtablissement"),
        F.lit("A").alias("etatAdministratifEtablissement"),
        F.when(F.col("s_nationkey") == 7, "[ND]").otherwise((600000 + key * 150 % 300000).cast("string")).alias(x),
        (6300000 + F.floor(key / 2000) * 150).cast("string").alias(y),
        F.when(F.col("s_nationkey") < 12, F.concat(F.lit("Gear "), F.col("s_name"))).alias("enseigne1Etablissement"),
        F.lit("Autre").alias("denominationUsuelleEtablissement"), F.lit("Ville").alias("libelleCommuneEtablissement"),
        F.concat(dep, F.lit("001")).alias("codeCommuneEtablissement"),
    )
    units = supplier.select(
        F.col("s_suppkey").cast("string").alias("siren"), F.concat(F.lit("Unit gear "), key.cast("string")).alias("denominationUniteLegale"),
        F.lit(None).cast("string").alias("sigleUniteLegale"),
    )
    merged = club_plan.merge_clubs(
        club_plan.equipment_clubs(equipment, installations, "gear", "registry"),
        club_plan.company_clubs(establishments, units, "gear", "companies", "Club"),
    )
    return merged.select("name", "type", "department", "courts", "source")


REGION_ROWS = list(fixed.REGION_DEPARTMENTS)
MEMBERS_SQL = "m(region, department) AS (" + _values((r, x) for r, xs in fixed.REGION_DEPARTMENTS.items() for x in xs) + ")"
REGIONS_SQL = "r(i, region) AS (VALUES " + ", ".join(f"({i}, '{r}')" for i, r in enumerate(REGION_ROWS)) + ")"


@query(f"""
WITH {MEMBERS_SQL}, {REGIONS_SQL}, {CELLS_SQL},
t AS (SELECT c_custkey % 22 AS i, CASE WHEN min(c_custkey % 22) <> 5 THEN count(*) FILTER (c_acctbal > 2000) END AS n FROM customer GROUP BY 1),
x AS (SELECT region, coalesce(n, (SELECT quantile_disc(n, 0.5) FROM t))::INTEGER AS idx FROM t JOIN r USING (i)),
p AS (SELECT department, idx FROM x JOIN m USING (region))
SELECT cell_id, coalesce(idx, (SELECT quantile_disc(idx, 0.5) FROM x))::INTEGER AS demand_index FROM cells LEFT JOIN p USING (department)""", name="demand_plan")
def demand_plan_query(spark, d):
    """A messy regional index (accents, hyphens, header residue, gaps) to every cell."""
    names = spark.createDataFrame(list(enumerate(REGION_ROWS)), "i int, region string")
    counted = table(spark, d, "customer").groupBy((F.col("c_custkey") % 22).cast("int").alias("i")).agg(
        F.count_if(F.col("c_acctbal") > 2000).alias("n")
    )
    messy = F.when(F.col("region") == "centre", "Centre-Val de Loire").otherwise(
        F.translate(F.initcap("region"), " eE", "-éÉ")
    )
    raw = counted.join(names, "i").select(
        messy.alias("region_raw"), F.when(F.col("i") != 5, F.concat(F.lit("<"), F.col("n").cast("string"))).alias("indice_raw")
    )
    header = spark.range(1).select(F.lit("Region").alias("region_raw"), F.lit("padding").alias("indice_raw"))
    index = demand_plan.clean_index(raw.unionByName(header), accuracy=ACCURACY)
    mapping = readers.dim_region_departments(spark)
    by_department = demand_plan.index_by_department(index, mapping)
    return demand_plan.cells_with_demand(cells(spark, d), by_department, index, ACCURACY).select("cell_id", "demand_index")
