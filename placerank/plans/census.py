"""Census grid to located cells with income score and target share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from placerank import fixed
from placerank.functions.codes import coords_from_grid_id, department_of, valid_code
from placerank.functions.geo import epsg3035_to_wgs84, in_bbox
from placerank.functions.scores import share
from placerank.functions.text import decimal_comma
from placerank.operators.clean import resolve_columns
from placerank.operators.stats import minmax
from placerank.session import cut_lineage
from placerank.sources.readers import read_delimited

# Canonical column -> spellings found in the files, first present wins
CENSUS_COLUMNS = {
    "IdINSPIRE": ["IdINSPIRE", "idcar_200m"],
    "code_commune_insee": ["code_commune_insee", "lcog_geo", "Code commune", "code_commune"],
    "I_est_cr": ["I_est_cr", "i_est_200"],
    "Ind": ["Ind", "ind"],
    "Ind_snv": ["Ind_snv", "ind_snv"],
    "Men_pauv": ["Men_pauv", "men_pauv"],
    "Ind_18_24": ["Ind_18_24", "ind_18_24"],
    "Ind_25_39": ["Ind_25_39", "ind_25_39"],
    "I_pauv": ["I_pauv", "i_pauv", "tx_pauv"],
    "X_c": ["X_c", "x_c"],
    "Y_c": ["Y_c", "y_c"],
}
CENSUS_TEXT = ["IdINSPIRE", "code_commune_insee"]


def load_census(spark: SparkSession, patterns: str | Sequence[str]) -> DataFrame:
    """The canonical columns as strings, coordinates taken from the grid id if the files have none."""
    df, lost = resolve_columns(read_delimited(spark, patterns), CENSUS_COLUMNS, required=["IdINSPIRE"])
    if lost & {"X_c", "Y_c"}:
        x, y = coords_from_grid_id("IdINSPIRE", F.col("X_c"), F.col("Y_c"))
        df = df.withColumns({"X_c": x, "Y_c": y})
    return df


def clean_census(raw: DataFrame) -> DataFrame:
    """Typed cells that are certified, inhabited, with income and coordinates."""
    typed = raw.select(
        *CENSUS_TEXT, *[decimal_comma(c).alias(c) for c in raw.columns if c not in CENSUS_TEXT]
    )
    return typed.filter(
        (F.col("I_est_cr") == 1.0) & (F.col("Ind") > 0) & (F.col("Ind_snv") > 0)
        & F.col("X_c").isNotNull() & F.col("Y_c").isNotNull()
    )


def locate_census(cells: DataFrame) -> DataFrame:
    """WGS84 coordinates, cells within the country."""
    return epsg3035_to_wgs84(cells, "X_c", "Y_c", "lon", "lat").filter(in_bbox("lat", "lon", fixed.BBOX_WIDE))


def census_features(cells: DataFrame, cut: bool = True) -> DataFrame:
    """Target share, income score over all cells, and department; cells of a known department.

    With ``cut`` the cells are written to the checkpoint folder first: the income range and the rows both need them, and would
    otherwise parse and project the files twice.
    """
    shared = (cut_lineage(cells) if cut else cells).withColumn("target_share", share(["Ind_18_24", "Ind_25_39"], "Ind"))
    scored = minmax(shared, {"Ind_snv": "income_score"}, degenerate=0.0)
    return scored.withColumn("department", department_of("code_commune_insee", "IdINSPIRE")).filter(
        valid_code("department", overseas=True)
    )
