"""A regional search-interest index projected to departments and cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from placerank import fixed
from placerank.functions.text import first_int, lookup_alias, normalize_text
from placerank.operators.clean import drop_value, impute_stat
from placerank.operators.joins import enrich, project_to_members
from placerank.operators.stats import one_row


def clean_index(
    raw: DataFrame, region: str = "region_raw", index: str = "indice_raw", aliases=fixed.REGION_ALIASES,
    accuracy: int = 1000,
) -> DataFrame:
    """(region_raw, region, demand_index): names normalised, missing values set to the median."""
    parsed = raw.select(
        F.col(region).alias("region_raw"),
        lookup_alias(normalize_text(region), aliases).alias("region"),
        first_int(index).alias("demand_index"),
    )
    return impute_stat(
        drop_value(parsed, "region", "region"), "demand_index", fallback=fixed.DEMAND_FALLBACK, accuracy=accuracy
    )


def index_by_department(index: DataFrame, mapping: DataFrame) -> DataFrame:
    """(region, demand_index, department)."""
    return project_to_members(index.select("region", "demand_index"), mapping, "region", "departments", "department")


def cells_with_demand(cells: DataFrame, by_department: DataFrame, index: DataFrame, accuracy: int = 1000) -> DataFrame:
    """Every cell with the index of its department, or the median of the regions."""
    median = one_row(index, m=F.percentile_approx("demand_index", 0.5, accuracy))["m"]
    joined = enrich(cells, by_department.select("department", "demand_index"), "department")
    return joined.withColumn(
        "demand_index", F.coalesce(F.col("demand_index"), median, F.lit(fixed.DEMAND_FALLBACK)).cast("int")
    )
