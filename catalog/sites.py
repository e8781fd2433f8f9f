"""The whole site ranking, from raw files written out of the given tables to the export tables read back."""

from pyspark.sql import functions as F

from catalog.base import CELLS_SQL, CLUBS_SQL, DEMAND_SQL, PRICES_SQL, ROADS_SQL, STOPS_SQL, query, table
from catalog.geography import laea_sql, lcc_sql
from catalog.inputs import MEMBERS_SQL, NODES_SQL, REGION_ROWS, REGIONS_SQL, WAYS_SQL, _nodes, _ways
from catalog.scoring import CAP, EXPORT_DIGITS, SENSITIVITY_SQL
from placerank.plans import prices, sites
from placerank.session import new_path


def raw_files(spark, d) -> sites.RawFiles:
    """Customers as census cells, lines as sales and equipment, suppliers as installations and companies, parts and orders as map data."""
    root = new_path(spark, "raw")

    def comma(c):
        return F.translate(c.cast("string"), ".", ",")

    def written(name, df, sep=";"):
        # one file per task that has rows, so their number grows with the table
        df.write.options(header=True, sep=sep).csv(f"{root}/{name}")
        return f"{root}/{name}/*.csv"

    def kept(name, df):
        df.write.parquet(f"{root}/{name}")
        return f"{root}/{name}"

    k = F.col("c_custkey")
    census = table(spark, d, "customer").select(
        F.concat(F.lit("CRS3035RES200mN"), (2100000 + (k * 6007) % 1000000).cast("string"), F.lit("E"),
                 (3200000 + (k * 7919) % 900000).cast("string"), F.lit("#"), k.cast("string")).alias("idcar_200m"),
        F.concat(F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lpad((k % 9).cast("string"), 3, "0")).alias("lcog_geo"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "0").otherwise("1").alias("i_est_200"), (F.col("c_nationkey") + 1).alias("ind"),
        comma(F.col("c_acctbal")).alias("ind_snv"), (k % 11).alias("men_pauv"), (k % 4).alias("ind_18_24"),
        F.when(F.col("c_mktsegment") != "BUILDING", k % 3).alias("ind_25_39"), F.when(k % 5 != 1, k % 5).alias("tx_pauv"),
    )
    lines, suppliers = table(spark, d, "lineitem"), table(spark, d, "supplier")
    dep = F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0")
    sales = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_shipdate").cast("string").alias("Date mutation"), comma(F.col("l_extendedprice") * 10).alias("Valeur fonciere"),
        F.lit("00000").alias("Code postal"), dep.alias("Code departement"), F.lpad((F.col("l_partkey") % 9).cast("string"), 3, "0").alias("Code commune"),
        F.when(F.col("l_returnflag") == "N", prices.SALE_KIND).otherwise("Maison").alias("Type local"),
        comma(F.col("l_quantity") * 10).alias("Surface reelle bati"),
    )
    equipment = lines.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("installation_numero"), F.col("p_name").alias("type")
    )
    s = F.col("s_suppkey")
    place = F.concat_ws(",", (44.0 + s * 7919 % 4001 / F.lit(1003.0)).cast("string"), (0.5 + s * 6007 % 5003 / F.lit(1003.0)).cast("string"))
    installations = suppliers.select(
        s.alias("numero"), F.col("s_name").alias("nom"), F.lit("Ville").alias("commune"), dep.alias("dep_code"),
        F.when(F.col("s_acctbal") > 0, place).otherwise("?").alias("coordonnees"),
    )
    establishments = suppliers.select(
        s.alias("siren"), F.when(F.col("s_acctbal") < 5000, "93.11Z").otherwise("47.11A").alias("activitePrincipaleEtablissement"),
        F.lit("A").alias("etatAdministratifEtablissement"),
        F.when(F.col("s_nationkey") == 7, "[ND]").otherwise((200000 + s * 7919 % 1000000).cast("string")).alias("coordonneeLambertAbscisseEtablissement"),
        (6100000 + s * 6007 % 900000).cast("string").alias("coordonneeLambertOrdonneeEtablissement"),
        F.when(F.col("s_nationkey") < 12, F.concat(F.lit("Gear "), F.col("s_name"))).alias("enseigne1Etablissement"),
        F.lit("Autre").alias("denominationUsuelleEtablissement"), F.lit("Ville").alias("libelleCommuneEtablissement"),
        F.concat(dep, F.lit("001")).alias("codeCommuneEtablissement"),
    )
    units = suppliers.select(
        s.alias("siren"), F.concat(F.lit("Unit gear "), s.cast("string")).alias("denominationUniteLegale"), F.lit(None).cast("string").alias("sigleUniteLegale")
    )
    names = spark.createDataFrame(list(enumerate(REGION_ROWS)), "i int, region string")
    counted = table(spark, d, "customer").groupBy((k % 22).cast("int").alias("i")).agg(F.count_if(F.col("c_acctbal") > 2000).alias("n"))
    messy = F.when(F.col("region") == "centre", "Centre-Val de Loire").otherwise(F.translate(F.initcap("region"), " eE", "-éÉ"))
    index = counted.join(names, "i").select(
        messy.alias("region_raw"), F.when(F.col("i") != 5, F.concat(F.lit("<"), F.col("n").cast("string"))).alias("indice_raw")
    )
    return sites.RawFiles(
        census=written("census", census), sales=written("sales", sales, "|"), equipment=written("equipment", equipment),
        installations=written("installations", installations), establishments=written("establishments", establishments),
        legal_units=written("units", units), demand=written("demand", index),
        nodes=kept("nodes", _nodes(spark, d)), ways=kept("ways", _ways(spark, d)),
    )


RAW_CELLS_SQL = f"""laea AS ({laea_sql()}),
cells AS (
  SELECT 'CRS3035RES200mN' || (2100000 + (c_custkey * 6007) % 1000000) || 'E' || (3200000 + (c_custkey * 7919) % 900000) || '#' || c_custkey AS cell_id,
    lpad((c_nationkey + 1)::VARCHAR, 2, '0') AS department, lpad((c_nationkey + 1)::VARCHAR, 2, '0') || lpad((c_custkey % 9)::VARCHAR, 3, '0') AS commune,
    lat, lon, c_acctbal AS income, c_nationkey + 1 AS ind, (c_custkey % 11)::FLOAT AS men_pauv, (c_custkey % 4)::FLOAT AS ind_18_24,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey % 3 ELSE 0 END::FLOAT AS ind_25_39,
    CASE WHEN c_custkey % 5 <> 1 THEN c_custkey % 5 ELSE 0 END::FLOAT AS i_pauv,
    (c_custkey % 4 + CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey % 3 ELSE 0 END) / (c_nationkey + 1)::DOUBLE AS target_share
  FROM customer JOIN laea USING (c_custkey)
  WHERE c_acctbal > 0 AND c_mktsegment <> 'MACHINERY' AND lat BETWEEN 41 AND 51.5 AND lon BETWEEN -5.5 AND 10.5)"""
RAW_CLUBS_SQL = f"""lcc AS ({lcc_sql()}),
eq AS (SELECT l_suppkey AS inst, count(*)::INTEGER AS courts FROM lineitem JOIN part ON l_partkey = p_partkey WHERE contains(p_name, 'gear') GROUP BY 1),
places AS (
  SELECT s_name AS name, 44e0 + s_suppkey * 7919 % 4001 / 1003e0 AS lat, 0.5e0 + s_suppkey * 6007 % 5003 / 1003e0 AS lon, courts, 'equipment' AS source
  FROM supplier JOIN eq ON s_suppkey = inst WHERE s_acctbal > 0
  UNION ALL
  SELECT CASE WHEN s_nationkey < 12 THEN 'Gear ' || s_name ELSE 'Unit gear ' || s_suppkey END, lat, lon, NULL, 'companies'
  FROM supplier JOIN lcc USING (s_suppkey) WHERE s_acctbal < 5000 AND s_nationkey <> 7),
clubs AS (SELECT * FROM places WHERE lat BETWEEN 41 AND 51.5 AND lon BETWEEN -5 AND 10
  QUALIFY row_number() OVER (PARTITION BY floor(lat * 1000 + 0.5), floor(lon * 1000 + 0.5) ORDER BY courts DESC NULLS LAST, source, name, lat, lon) = 1)"""
RAW_SALES_SQL = """sold AS (
  SELECT lpad((s_nationkey + 1)::VARCHAR, 2, '0') AS department, lpad((l_partkey % 9)::VARCHAR, 3, '0') AS commune,
    (l_extendedprice * 10) / (l_quantity * 10) AS price_m2
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'N' AND l_quantity * 10 > 200),
prices AS (SELECT department, commune, quantile_disc(price_m2, 0.5) AS price_m2, count(*) AS n_sales FROM sold GROUP BY ALL)"""
RAW_DEMAND_SQL = f"""{MEMBERS_SQL}, {REGIONS_SQL},
counted AS (SELECT c_custkey % 22 AS i, CASE WHEN min(c_custkey % 22) <> 5 THEN count(*) FILTER (c_acctbal > 2000) END AS n FROM customer GROUP BY 1),
indexed AS (SELECT region, coalesce(n, (SELECT quantile_disc(n, 0.5) FROM counted))::INTEGER AS idx FROM counted JOIN r USING (i)),
demand AS (SELECT cell_id, coalesce(idx, (SELECT quantile_disc(idx, 0.5) FROM indexed))::INTEGER AS demand_index
  FROM cells LEFT JOIN (SELECT department, idx FROM indexed JOIN m USING (region)) USING (department))"""
RAW_STOPS_SQL = f"{NODES_SQL}, stops AS (SELECT id AS osm_id, lat, lon FROM nodes WHERE stop_type IS NOT NULL AND lat IS NOT NULL)"
RAW_ROADS_SQL = f"""{WAYS_SQL.replace("round(avg(lat), 9)", "avg(lat)").replace("round(avg(lon), 9)", "avg(lon)")},
roads AS (SELECT osm_id, lat_center, lon_center FROM axes)"""


def _from_raw(sql: str) -> str:
    """The SQL of the score with its inputs taken from what the raw files hold."""
    for given, raw in (
        (CELLS_SQL, RAW_CELLS_SQL), (CLUBS_SQL, RAW_CLUBS_SQL), (PRICES_SQL, RAW_SALES_SQL), (DEMAND_SQL, RAW_DEMAND_SQL),
        (STOPS_SQL, RAW_STOPS_SQL), (ROADS_SQL, RAW_ROADS_SQL),
    ):
        if sql.count(given) != 1:
            raise ValueError(f"the score's SQL does not hold {given[:40]} once")
        sql = sql.replace(given, raw)
    return sql


@query(f"""
WITH {_from_raw(SENSITIVITY_SQL)},
ex AS (SELECT s.* EXCLUDE (ind, n_stops), s.ind::FLOAT AS ind, s.n_stops::FLOAT AS n_stops, s.income::FLOAT::DOUBLE AS ind_snv, coalesce(p.n_sales, -1)::INTEGER AS n_sales,
  (row_number() OVER (ORDER BY round(score, 9) DESC, cell_id))::INTEGER AS rank_national,
  count(*) OVER (PARTITION BY s.commune) AS commune_cells, count(*) OVER (PARTITION BY s.department) AS department_cells
  FROM stable s LEFT JOIN prices p ON s.department = p.department AND substr(s.commune, 3, 3) = p.commune)
SELECT cell_id, commune, department, {", ".join(f"round({c}::FLOAT::DOUBLE, {n}) AS {c}" for c, n in EXPORT_DIGITS.items() if c not in ("lat", "lon"))},
  round(lat, 6) AS lat, round(lon, 6) AS lon, stability::SMALLINT AS stability, demand_index::FLOAT AS demand_index, n_clubs::INTEGER AS n_clubs, n_sales,
  ind, men_pauv, ind_18_24, ind_25_39, i_pauv, n_stops, (ind * 25)::INTEGER AS population,
  CASE WHEN rank_national <= 1000 THEN rank_national END AS rank_national, commune_cells, department_cells, (SELECT count(*) FROM clubs) AS clubs FROM ex""")
def raw_to_exports(spark, d):
    """Nine raw files to the written exports: each exported cell with its place in the top list and the cells of its commune and department."""
    root = new_path(spark, "sites")
    sites.export_sites(spark, raw_files(spark, d), sites.Choices(keyword="gear", price_cap=CAP), root)
    cells, top, communes, departments, clubs = (
        spark.read.parquet(f"{root}/{name}") for name in ("cells", "top", "communes", "departments", "clubs")
    )
    out = (
        cells.withColumn("department", F.lpad(F.col("department").cast("string"), 2, "0"))
        .join(top.select("cell_id", "rank_national"), "cell_id", "left")
        .join(communes.select("commune", F.col("n_cells").cast("long").alias("commune_cells")), "commune", "left")
        .join(departments.select("department", F.col("n_cells").cast("long").alias("department_cells")), "department", "left")
        .withColumn("clubs", clubs.agg(F.count("*")).scalar())
    )
    rounded = {c: F.round(F.col(c).cast("double"), n) for c, n in EXPORT_DIGITS.items()}
    return out.withColumns(rounded).select(
        "cell_id", "commune", "department", *EXPORT_DIGITS, "stability", "demand_index", "n_clubs", "n_sales", "ind", "men_pauv", "ind_18_24",
        "ind_25_39", "i_pauv", "n_stops", "population", "rank_national", "commune_cells", "department_cells", "clubs",
    )
