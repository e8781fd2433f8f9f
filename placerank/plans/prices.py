"""Property sales to a price per square metre and commune."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from placerank import fixed
from placerank.functions.geo import in_bbox
from placerank.functions.scores import safe_ratio
from placerank.functions.text import decimal_comma
from placerank.operators.clean import with_missing
from placerank.operators.stats import median_by
from placerank.sources.readers import read_delimited

# Columns of the sales files and the kind of premises kept
SALE_COLUMNS = [
    "Date mutation", "Valeur fonciere", "Code postal", "Code departement", "Code commune", "Type local",
    "Surface reelle bati", "Longitude", "Latitude",
]
SALE_KIND = "Local industriel. commercial ou assimilé"
MIN_SURFACE = 200.0


def load_sales(spark: SparkSession, patterns: str | Sequence[str]) -> DataFrame:
    """The sales columns as strings, and has_gps: whether the row's file has coordinates. Vintages may have different headers."""
    raw = read_delimited(spark, patterns, sep="|", columns=SALE_COLUMNS, present={"has_gps": ["Longitude", "Latitude"]})
    raw, _ = with_missing(raw, {"Longitude": "string", "Latitude": "string"})
    return raw.select(*SALE_COLUMNS, "has_gps")


def clean_sales(raw: DataFrame, kind: str = SALE_KIND, min_surface: float = MIN_SURFACE) -> DataFrame:
    """Typed sales of the wanted kind, above the surface, with a price per m2; within the country where the file has coordinates."""
    typed = raw.filter(F.col("Type local") == kind).select(
        F.col("Date mutation").alias("sale_date"),
        F.col("Code postal").alias("postal_code"),
        F.col("Code departement").alias("department"),
        F.col("Code commune").alias("commune"),
        decimal_comma("Valeur fonciere").alias("value"),
        decimal_comma("Surface reelle bati").alias("surface"),
        decimal_comma("Longitude").alias("lon"),
        decimal_comma("Latitude").alias("lat"),
        "has_gps",
    )
    kept = typed.filter((F.col("value") > 0) & (F.col("surface") > min_surface))
    kept = kept.filter(~F.col("has_gps") | in_bbox("lat", "lon", fixed.BBOX_STRICT)).drop("has_gps")
    return kept.withColumn("price_m2", safe_ratio("value", "surface"))


def price_by_commune(sales: DataFrame, accuracy: int = 10000) -> DataFrame:
    """(department, commune, price_m2, n_sales), most traded first."""
    return median_by(sales, ["department", "commune"], "price_m2", accuracy, median="price_m2", count="n_sales")
