"""What a dashboard asks of the club table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from placerank import fixed
from placerank.functions.geo import in_bbox
from placerank.functions.text import matches_keyword, parse_bool, type_facet
from placerank.operators.joins import lookup
from placerank.plans.live import LIVE


def facets(
    *, departments: Sequence[str] | None = None, source: str | None = None, facet: str = "all", keyword: str = "",
    ranges: Mapping[str, tuple[float, float]] | None = None,
    strict_ranges: Mapping[str, tuple[float, float]] | None = None,
    commune: str | None = None, saturated: bool | None = None,
) -> Column:
    """One condition from any of the facets. ``ranges`` let nulls pass, ``strict_ranges`` do not."""
    keep = F.lit(True)
    if departments:
        keep = keep & F.col("department").isin(*departments)
    if source:
        keep = keep & (F.col("stream_source") == source)
    if facet == "streaming":
        keep = keep & (F.col("stream_source") == LIVE)
    elif facet != "all":
        keep = keep & type_facet("type", "name", facet, keyword)
    for c, (lo, hi) in (ranges or {}).items():
        keep = keep & (F.col(c).between(lo, hi) | F.col(c).isNull())
    for c, (lo, hi) in (strict_ranges or {}).items():
        keep = keep & F.col(c).between(lo, hi)
    if commune and commune.strip():
        keep = keep & F.lower(F.coalesce(F.col("commune"), F.lit(""))).contains(commune.strip().lower())
    if saturated is not None:
        keep = keep & (parse_bool("saturated", default=None) == F.lit(saturated))
    return F.coalesce(keep, F.lit(False))


def facet_filter(df: DataFrame, **kw) -> DataFrame:
    return df.filter(facets(**kw))


def base_population(df: DataFrame, keyword: str, bbox=fixed.BBOX_WIDE) -> DataFrame:
    """Places that mention the keyword in name or type, within the box."""
    mentions = matches_keyword(F.coalesce(F.col("name"), F.lit("")), keyword) | matches_keyword(
        F.coalesce(F.col("type"), F.lit("")), keyword
    )
    return df.filter(mentions & in_bbox("lat", "lon", bbox))


def kpis(df: DataFrame, **kw) -> DataFrame:
    """Visible, live and impacted counts in one pass over the table."""
    visible = facets(**kw)
    impacted = F.coalesce(F.col("score_impacted"), F.lit(False))
    return df.agg(
        F.count_if(visible).alias("visible"),
        F.count_if(F.col("stream_source") == LIVE).alias("live"),
        F.count_if(visible & impacted).alias("impacted_visible"),
        F.count_if(impacted).alias("impacted"),
    )


def region_groups(df: DataFrame, dim: DataFrame, code: str = "department") -> DataFrame:
    """Codes in use by region, labelled '<name> - <code>', regions and labels in order.

    dim: code, department_name, region, region_order. Rows instead of lists, so no group is gathered.
    """
    used = df.select(code).filter(F.col(code).isNotNull()).distinct()
    named = lookup(
        used, dim, code,
        {"department_name": fixed.UNKNOWN_DEPARTMENT + "{}", "region": fixed.UNKNOWN_REGION, "region_order": 1_000_000},
    )
    label = F.concat(F.col("department_name"), F.lit(" - "), F.col(code))
    place = Window.partitionBy("region").orderBy("label", code)
    return named.withColumn("label", label).select(
        "region", "region_order", code, "label", F.row_number().over(place).alias("position")
    ).orderBy("region_order", "region", "position")
