"""Two registries of places, brought to one schema and de-duplicated by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from placerank import fixed
from placerank.functions.codes import split_point, valid_code
from placerank.functions.geo import epsg2154_to_wgs84, in_bbox
from placerank.functions.text import active_in_sector, first_matching, matches_keyword
from placerank.operators.clean import with_provenance
from placerank.operators.dedupe import dedupe_spatial
from placerank.operators.joins import enrich, join_keys
from placerank.operators.sets import union_all
from placerank.operators.stats import count_and_label

CLUB_COLUMNS = ["name", "type", "commune", "department", "lat", "lon", "courts", "source"]


def equipment_clubs(equipment: DataFrame, installations: DataFrame, keyword: str, source: str) -> DataFrame:
    """Installations with equipment of the wanted type, counted.

    equipment: installation_numero, type; installations: numero, nom, commune, dep_code, coordonnees.
    """
    counted = count_and_label(
        equipment.filter(matches_keyword("type", keyword)), "installation_numero", "type", count="courts"
    )
    lat, lon = split_point("coordonnees")
    located = (
        installations.filter(valid_code("dep_code"))
        .select("numero", "nom", "commune", "dep_code", lat.alias("lat"), lon.alias("lon"))
        .filter(in_bbox("lat", "lon", fixed.BBOX_STRICT))
    )
    joined = join_keys(counted, located, {"installation_numero": "numero"}, "inner")
    out = joined.select(
        F.col("nom").alias("name"), "type", "commune", F.col("dep_code").alias("department"),
        "lat", "lon", F.col("courts").cast("int").alias("courts"),
    )
    return with_provenance(out, {"source": source})


def company_clubs(
    establishments: DataFrame, legal_units: DataFrame, keyword: str, source: str, kind: str,
    sector: str = "93.", default_name: str = "Club de Sport de ",
) -> DataFrame:
    """Active establishments of a sector whose best name mentions the keyword."""
    x, y = "coordonneeLambertAbscisseEtablissement", "coordonneeLambertOrdonneeEtablissement"
    picked = establishments.filter(
        active_in_sector("activitePrincipaleEtablissement", "etatAdministratifEtablissement", sector, "A", [x, y])
    ).withColumns({"_px": F.col(x).try_cast("double"), "_py": F.col(y).try_cast("double")})
    located = epsg2154_to_wgs84(picked, "_px", "_py", "lon", "lat").filter(in_bbox("lat", "lon", fixed.BBOX_STRICT))
    named = enrich(located, legal_units.select("siren", "denominationUniteLegale", "sigleUniteLegale"), "siren")
    name = first_matching(
        ["enseigne1Etablissement", "denominationUsuelleEtablissement", "denominationUniteLegale"],
        keyword,
        ["denominationUniteLegale", "sigleUniteLegale", "enseigne1Etablissement", "denominationUsuelleEtablissement"],
        F.concat(F.lit(default_name), F.col("libelleCommuneEtablissement")),
    )
    out = named.select(
        name.alias("name"), F.lit(kind).alias("type"), F.col("libelleCommuneEtablissement").alias("commune"),
        F.substring("codeCommuneEtablissement", 1, 2).alias("department"), "lat", "lon",
        F.lit(None).cast("int").alias("courts"),
    ).filter(matches_keyword("name", keyword))
    return with_provenance(out, {"source": source})


def merge_clubs(*registries: DataFrame, digits: int = 3) -> DataFrame:
    """One club per rounded position, most courts first, in a known department."""
    order = [F.col("courts").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ("source", "name", "lat", "lon")]]
    return dedupe_spatial(union_all(registries), "lat", "lon", digits, order).filter(valid_code("department"))
