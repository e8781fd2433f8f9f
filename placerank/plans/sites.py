"""The whole site ranking: raw files of six registries in, export tables out.

Every table that is needed more than once is written under the checkpoint folder: the located census (its ranges and its
rows), clubs (competition and export), prices (join, median and export), the cells with all metrics (ranges and rows) and the
scored cells (weight sets, top list and export). Each raw file is thus read and projected once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from placerank import fixed
from placerank.plans import access, census, clubs as club_plan, demand as demand_plan, exports, prices as price_plan, score
from placerank.session import cut_lineage
from placerank.sources import osm
from placerank.sources.readers import dim_region_departments, read_delimited

Patterns = str | Sequence[str]


@dataclass(frozen=True)
class RawFiles:
    """Patterns of delimited files; nodes and ways are folders of Parquet (see ``placerank.sources.osm``)."""

    census: Patterns
    sales: Patterns
    equipment: Patterns
    installations: Patterns
    establishments: Patterns
    legal_units: Patterns
    demand: Patterns
    nodes: str
    ways: str


@dataclass(frozen=True)
class Choices:
    """What the job looks for and how far it looks. ``digits`` rounds scores before they are ranked, so that ties are ties everywhere."""

    keyword: str
    kind: str = "Club"
    equipment_source: str = "equipment"
    company_source: str = "companies"
    price_cap: float = fixed.PRICE_CAP
    top: int = fixed.TOP_CELLS
    accuracy: int = 10000
    digits: int = 9


def load_cells(spark: SparkSession, raw: RawFiles) -> DataFrame:
    """Census cells as cell_id, commune, department, lat, lon, their counts, target_share and income_score."""
    cleaned = census.clean_census(census.load_census(spark, raw.census))
    features = census.census_features(census.locate_census(cleaned))
    return features.select(
        F.col("IdINSPIRE").alias("cell_id"), F.col("code_commune_insee").alias("commune"), "department", "lat", "lon",
        "Ind", "Ind_snv", "Men_pauv", "Ind_18_24", "Ind_25_39", "I_pauv", "target_share", "income_score",
    )


def load_clubs(spark: SparkSession, raw: RawFiles, choices: Choices) -> DataFrame:
    """Both registries of clubs, one club per rounded position."""
    equipment = club_plan.equipment_clubs(
        read_delimited(spark, raw.equipment), read_delimited(spark, raw.installations), choices.keyword, choices.equipment_source
    )
    companies = club_plan.company_clubs(
        read_delimited(spark, raw.establishments), read_delimited(spark, raw.legal_units), choices.keyword, choices.company_source, choices.kind
    )
    return cut_lineage(club_plan.merge_clubs(equipment, companies))


def load_prices(spark: SparkSession, raw: RawFiles, choices: Choices) -> DataFrame:
    sold = price_plan.clean_sales(price_plan.load_sales(spark, raw.sales))
    return cut_lineage(price_plan.price_by_commune(sold, choices.accuracy))


def add_demand(spark: SparkSession, cells: DataFrame, raw: RawFiles, choices: Choices) -> DataFrame:
    index = cut_lineage(demand_plan.clean_index(read_delimited(spark, raw.demand), accuracy=choices.accuracy))
    by_department = demand_plan.index_by_department(index, dim_region_departments(spark))
    return demand_plan.cells_with_demand(cells, by_department, index, choices.accuracy)


def score_sites(spark: SparkSession, raw: RawFiles, choices: Choices, clubs: DataFrame, prices: DataFrame) -> DataFrame:
    """Cells with every sub-score, the score and its stability, written once."""
    nodes, ways = spark.read.parquet(raw.nodes), spark.read.parquet(raw.ways)
    cells = add_demand(spark, load_cells(spark, raw), raw, choices)
    # no cell is met by its id here: demand comes by department and price by commune, so only the spatial joins shuffle the cells
    located = access.access_metrics(cells, osm.osm_transport_stops(nodes), osm.osm_road_axes(ways, nodes), unique_stops=True, cut=False)
    competing = score.competition_metrics(located, clubs)
    joined = cut_lineage(score.join_prices(competing, prices, accuracy=choices.accuracy))
    scored = cut_lineage(score.score_metrics(access.access_score(joined), cap=choices.price_cap))
    return cut_lineage(score.with_stability(scored, score.sensitivity(scored, digits=choices.digits)))


def rank_sites(spark: SparkSession, raw: RawFiles, choices: Choices) -> dict[str, DataFrame]:
    """The export tables by name: cells, communes, departments, top, zones, clubs."""
    clubs, prices = load_clubs(spark, raw, choices), load_prices(spark, raw, choices)
    scored = score_sites(spark, raw, choices, clubs, prices)
    cells = cut_lineage(exports.export_cells(scored, prices))
    best = cut_lineage(score.top_cells(scored.withColumn("score", F.round("score", choices.digits)), choices.top))
    return {
        "cells": cells,
        "communes": exports.export_communes(cells),
        "departments": exports.export_departments(cells, choices.accuracy),
        "top": exports.export_top(best),
        "zones": score.zones(best),
        "clubs": exports.export_clubs(clubs, clubs.limit(0), cells),
    }


def export_sites(spark: SparkSession, raw: RawFiles, choices: Choices, root: str) -> dict[str, int]:
    """Write all export tables under ``root``, the cells in folders per department, communes also as CSV, and the map of the top cells.

    Returns the verified row counts.
    """
    tables = rank_sites(spark, raw, choices)
    counts = exports.write_exports(tables, root, partition={"cells": "department"}, csv=["communes"])
    top, zones = (spark.read.schema(tables[t].schema).parquet(f"{root}/{t}") for t in ("top", "zones"))
    exports.write_top_geojson(top, f"{root}/map", zones, most=choices.top)
    return counts
