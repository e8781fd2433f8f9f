"""Accessibility of cells: stops within a radius and distance to the nearest major road."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from placerank import fixed
from placerank.functions.scores import invert, normalize
from placerank.operators.spatial import count_within, nearest_distance
from placerank.operators.stats import with_stats
from placerank.session import cut_lineage


def access_metrics(
    cells: DataFrame, stops: DataFrame, roads: DataFrame, *, cell_id: str = "cell_id",
    stop: tuple[str, str] = ("lat", "lon"), road: tuple[str, str] = ("lat_center", "lon_center"), exact: bool = False,
    unique_stops: bool = False, cut: bool = True,
) -> DataFrame:
    """The cells with n_stops (0 if none) and road_km (null if no road is near).

    ``unique_stops`` says that no stop id repeats, as in a table of map nodes. With ``cut`` the two
    spatial joins run once and their result is kept in the checkpoint folder; the score needs it
    twice, for the ranges and for the rows.
    """
    near_stops = count_within(
        cells, stops, point_id=cell_id, place_id="osm_id", radius_km=fixed.STOP_RADIUS_KM,
        deg=fixed.STOP_GRID_DEG, span=fixed.STOP_SPAN, exact=exact, place=stop, within="n_stops",
        unique_ids=unique_stops,
    )
    near_road = nearest_distance(
        cells, roads, point_id=cell_id, deg=fixed.ROAD_GRID_DEG, span=fixed.ROAD_SPAN, place=road, nearest="road_km",
    )
    out = (
        cells.join(near_stops, cell_id, "left").join(near_road, cell_id, "left")
        .withColumn("n_stops", F.coalesce(F.col("n_stops"), F.lit(0).cast("long")))
    )
    return cut_lineage(out) if cut else out


def access_score(
    df: DataFrame, stops: str = "n_stops", road: str = "road_km", weights: tuple[float, float] = fixed.ACCESS_WEIGHTS,
    fallback_km: float = fixed.ROAD_DISTANCE_FALLBACK_KM, penalty_km: float = fixed.ROAD_DISTANCE_PENALTY_KM,
) -> DataFrame:
    """Fill missing roads with the greatest distance plus a penalty, normalise both and weigh them.

    One pass over the table gives all statistics: the bounds after filling follow from those before.
    """
    with_row = with_stats(
        df,
        lo_stops=F.min(stops).cast("double"), hi_stops=F.max(stops).cast("double"),
        lo_road=F.min(road), hi_road=F.max(road), unknown=F.count_if(F.col(road).isNull()),
    )
    fill = F.coalesce(F.col("_stats.hi_road"), F.lit(fallback_km)) + penalty_km
    lo_road = F.coalesce(F.col("_stats.lo_road"), fill)
    hi_road = F.when(F.col("_stats.unknown") > 0, fill).otherwise(F.col("_stats.hi_road"))
    filled = with_row.withColumn(road, F.coalesce(F.col(road), fill))
    normed = filled.withColumns(
        {
            f"{stops}_norm": normalize(stops, F.col("_stats.lo_stops"), F.col("_stats.hi_stops"), 0.0),
            f"{road}_norm": normalize(road, lo_road, hi_road, 0.0),
        }
    ).drop("_stats")
    score = weights[0] * F.col(f"{stops}_norm") + weights[1] * invert(f"{road}_norm")
    return normed.withColumn("access_score", score)
