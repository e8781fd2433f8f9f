"""Tables for dashboards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from placerank import fixed
from placerank.functions.codes import commune_key3
from placerank.functions.scores import competition_label, exceeds, grade, scaled_int, tier
from placerank.functions.text import percent_label
from placerank.operators.clean import fill_by_class, narrow, rename_map, select_existing
from placerank.operators.dedupe import dedupe_spatial, stable_id
from placerank.operators.joins import enrich_all, join_keys
from placerank.operators.rank import dual_rank, head
from placerank.operators.rollup import rollup
from placerank.operators.sets import union_all
from placerank.operators.spatial import match_cell
from placerank.operators.stats import quantile_profile
from placerank.sources.files import expand
from placerank.sources.writers import file_sizes, with_geometry, write_csv_single, write_geojson_document, write_verified

# Order and classes of the cell export. Counts stay int where the original has 16 bits: none is lost.
CELL_COLUMNS = [
    "cell_id", "commune", "department", "lat", "lon", "score", "competition_score", "access_score",
    "property_score", "income_score", "stability", "target_share", "demand_index", "club_km", "n_clubs",
    "price_m2", "n_sales", "ind", "ind_snv", "men_pauv", "ind_18_24", "ind_25_39", "i_pauv",
    "n_stops", "road_km", "grade", "competition_label", "population",
]
CELL_FLOATS = [
    "score", "competition_score", "access_score", "property_score", "income_score", "target_share",
    "demand_index", "club_km", "price_m2", "ind", "ind_snv", "men_pauv", "ind_18_24", "ind_25_39", "i_pauv", "n_stops", "road_km",
]
CELL_SHORTS = ["stability"]
CELL_INTS = ["n_clubs", "n_sales", "population"]
AVERAGED = [
    "score", "competition_score", "access_score", "property_score", "income_score", "target_share",
    "demand_index", "stability",
]


def export_cells(
    scored: DataFrame, prices: DataFrame, *metrics: DataFrame, cell_id: str = "cell_id",
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scored cells with their metric tables and sales, labels, filled nulls and narrow types."""
    df = enrich_all(scored, metrics, cell_id)
    df = rename_map(df, renames or {"Ind": "ind", "Ind_snv": "ind_snv", "Men_pauv": "men_pauv",
                                    "Ind_18_24": "ind_18_24", "Ind_25_39": "ind_25_39", "I_pauv": "i_pauv"})
    by = prices.select(F.col("department").alias("_dep"), F.col("commune").alias("_com"),
                       F.col("price_m2").alias("_price"), "n_sales")
    df = df.withColumn("_commune3", commune_key3("commune", keep_raw=True))
    df = join_keys(df, by, {"department": "_dep", "_commune3": "_com"}, "left")
    df = df.withColumns(
        {
            "price_m2": F.coalesce(F.col("price_m2"), F.col("_price")),
            "grade": grade("score"),
            "competition_label": competition_label("n_clubs"),
            "population": scaled_int("ind", fixed.POPULATION_PER_UNIT) if "ind" in df.columns else F.lit(None).cast("int"),
        }
    )
    df = select_existing(df, CELL_COLUMNS)
    have = set(df.columns)
    # filled before the types shrink: what does not fit must not pass for a missing value
    df = fill_by_class(df, doubles=CELL_FLOATS, ints=CELL_SHORTS + CELL_INTS, strings=["commune", "department"])
    return narrow(df, {t: [c for c in cols if c in have] for t, cols in
                       {"float": CELL_FLOATS, "smallint": CELL_SHORTS, "int": CELL_INTS}.items()})


def export_communes(cells: DataFrame) -> DataFrame:
    out = rollup(
        cells, ["commune"], count="n_cells", labels={"department": "department"},
        averages={f"{c}_avg": c for c in AVERAGED}, maxima={"score_max": "score"}, centroid=("lat", "lon"),
    )
    return fill_by_class(
        out, doubles=[f"{c}_avg" for c in AVERAGED] + ["score_max"], ints=["n_cells"], strings=["commune", "department"]
    )


def export_departments(cells: DataFrame, accuracy: int = 10000) -> DataFrame:
    averaged = [c for c in AVERAGED if c != "stability"] + ["price_m2", "ind_snv", "n_clubs"]
    averaged = [c for c in averaged if c in cells.columns]
    out = rollup(
        cells, ["department"], count="n_cells", averages={f"{c}_avg": c for c in averaged},
        quantiles={"score_p90": ("score", 0.9)}, accuracy=accuracy,
    )
    return fill_by_class(out, doubles=[f"{c}_avg" for c in averaged] + ["score_p90"], strings=["department"])


def export_top(top: DataFrame, *, cell_id: str = "cell_id") -> DataFrame:
    """The top cells with national and departmental rank, tier and label."""
    ranked = dual_rank(
        top.select(cell_id, "commune", "department", "lat", "lon", "score"),
        [F.desc_nulls_last("score"), F.asc(cell_id)], ["department"], "rank_national", "rank_department",
    )
    return ranked.withColumns({"tier": tier("score"), "label": percent_label("commune", "score")})


def write_top_geojson(top: DataFrame, path: str, zones: DataFrame | None = None, most: int = 10_000) -> None:
    """At most ``most`` top cells as one GeoJSON document, at the centre of their zone where there is one."""
    geometry = None
    if zones is not None:
        geometry = zones.select("commune", F.col("lon_center").alias("geo_lon"), F.col("lat_center").alias("geo_lat"))
    properties = [c for c in top.columns]
    placed = with_geometry(
        top.withColumns({"_lon": F.col("lon"), "_lat": F.col("lat")}), geometry, "commune", "_lon", "_lat"
    )
    write_geojson_document(placed, path, "_lon", "_lat", properties, most)


def export_clubs(main: DataFrame, annex: DataFrame, cells: DataFrame) -> DataFrame:
    """Clubs of both tables, one per position, with the best cell of their rounded position."""
    text = ["name", "type", "commune", "source", "department"]

    def prepared(df: DataFrame, primary: bool) -> DataFrame:
        return df.select(
            *[F.coalesce(F.col(c), F.lit("N/A")).alias(c) for c in text],
            F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"),
            F.col("courts").cast("int").alias("courts"), F.lit(primary).alias("is_primary"),
        )

    merged = union_all([prepared(main, True), prepared(annex, False)]).filter(
        F.col("lat").isNotNull() & F.col("lon").isNotNull()
    )
    order = [F.desc("is_primary"), F.col("courts").desc_nulls_last(),
             *[F.asc(c) for c in ("source", "name", "lat", "lon")]]
    clubs = dedupe_spatial(merged, "lat", "lon", 3, order).withColumn(
        "club_id", stable_id("source", "name", "lat", "lon")
    )
    zone = cells.select(
        F.col("lat").cast("double").alias("cell_lat"), F.col("lon").cast("double").alias("cell_lon"),
        F.col("score").alias("zone_score"), F.col("access_score").alias("zone_access"),
        F.col("ind_snv").alias("zone_income"), F.col("price_m2").alias("zone_price"),
        F.col("demand_index").alias("zone_demand"), F.col("target_share").alias("zone_target_share"),
        F.col("n_clubs").alias("zone_clubs"), F.col("cell_id").alias("_cell"),
    )
    matched = match_cell(
        clubs, zone, 2, [F.col("zone_score").desc_nulls_last(), F.asc("_cell")], place_id="club_id"
    )
    out = matched.withColumn("saturated", exceeds("zone_clubs", fixed.SATURATED_ABOVE)).drop(
        "cell_lat", "cell_lon", "_cell", "zone_clubs"
    )
    return fill_by_class(
        out, strings=text,
        doubles=["zone_score", "zone_access", "zone_income", "zone_price", "zone_demand", "zone_target_share"],
    )


def write_exports(tables: Mapping[str, DataFrame], root: str, partition: Mapping[str, str] | None = None,
                  csv: Sequence[str] = ()) -> dict[str, int]:
    """Write each table, and some also as CSV; returns the verified row counts."""
    counts = {}
    for name, df in tables.items():
        counts[name] = write_verified(df, f"{root}/{name}", (partition or {}).get(name))
        if name in csv:
            write_csv_single(df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}"), f"{root}/{name}_csv")
    return counts


def table_profile(
    spark: SparkSession, paths: Mapping[str, str], cells: DataFrame, *, score: str = "score",
    tops: Mapping[str, tuple[DataFrame, str, str]] | None = None, top: int = 5, accuracy: int = 10000,
    exact: bool = False,
) -> DataFrame:
    """One row: per-table rows and size, score statistics, and lists of top keys. A missing table counts 0.

    ``tops`` maps a name to (table, key column, order column).
    """
    row = quantile_profile(cells, score, accuracy=accuracy, exact=exact).select(F.struct("*").alias("score_stats"))
    infos = {}
    for name, path in paths.items():
        if expand(spark, f"{path.rstrip('/')}/*"):
            n = spark.read.parquet(path).agg(F.count("*").alias("n")).scalar()
            size = file_sizes(spark, path).select("bytes").scalar()
        else:
            n, size = F.lit(0).cast("long"), F.lit(0).cast("long")
        infos[name] = F.struct(
            F.lit(path).alias("path"), n.alias("rows"), F.round(size / (1024.0 * 1024.0), 2).alias("size_mb")
        )
    row = row.withColumn("tables", F.struct(*[info.alias(name) for name, info in infos.items()]))
    for name, (df, key, order) in (tops or {}).items():
        best = head(df.select(key, order), [F.desc_nulls_last(order), F.asc(key)], top)
        ordered = best.agg(
            F.transform(F.array_sort(F.collect_list(F.struct((-F.col(order)).alias("_o"), F.col(key).alias("_k")))),
                        lambda x: x["_k"]).alias("keys")
        )
        row = row.withColumn(name, ordered.scalar())
    return row.withColumn("generated_at", F.current_timestamp())
