"""Live clubs beside the batch clubs: the score of a place drops with the pressure around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from placerank import fixed
from placerank.functions.geo import in_bbox
from placerank.functions.scores import clip, nearest_of
from placerank.operators.clean import with_missing
from placerank.operators.dedupe import keep_last, stable_id
from placerank.operators.joins import null_safe_join
from placerank.operators.sets import union_all
from placerank.operators.spatial import Pressure, competition_pressure, competition_pressures
from placerank.operators.stats import exact_median_by, exact_quantiles
from placerank.session import cut_lineage

BATCH, LIVE = "Batch", "Streaming"
ZONE_COLUMNS = ["zone_score", "zone_access", "zone_income", "zone_price", "zone_demand", "zone_target_share"]
CLUB_TYPES = {
    "club_id": "string", "name": "string", "type": "string", "commune": "string", "department": "string",
    "lat": "double", "lon": "double", "courts": "double", "source": "string", "saturated": "boolean",
    "event_time": "string", **dict.fromkeys(ZONE_COLUMNS, "double"),
}


def normalize_base(clubs: DataFrame) -> DataFrame:
    """Batch clubs with every expected column; the name serves as id where there is none."""
    df, _ = with_missing(clubs, CLUB_TYPES)
    return df.select(
        F.coalesce(F.col("club_id").cast("string"), F.col("name"), F.lit("")).alias("club_id"),
        *[F.col(c).try_cast(t).alias(c) for c, t in CLUB_TYPES.items() if c != "club_id"],
        F.lit(BATCH).alias("stream_source"),
    )


def live_enrich(
    states: Sequence[DataFrame], base: DataFrame, since: str | None = None, *, time: str = "event_timestamp",
    source: str = "Kafka", kind: str = "Club streaming",
) -> DataFrame:
    """Live clubs since a moment, with the median zone values of the batch clubs of their department.

    ``states`` hold the latest event per club; the last one that has a club wins.
    """
    def shaped(state: DataFrame) -> DataFrame:
        fresh = state if since is None else state.filter(F.col(time) >= F.lit(since).cast(state.schema[time].dataType))
        return fresh.select(
            F.col("club_id").cast("string").alias("club_id"), "name", F.lit(kind).alias("type"),
            F.col("city").alias("commune"), "department",
            F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"),
            F.col("courts").cast("double").alias("courts"), F.lit(source).alias("source"),
            F.lit(False).alias("saturated"), F.col("event_time").cast("string").alias("event_time"),
            F.lit(LIVE).alias("stream_source"),
        )

    clubs = keep_last([shaped(s) for s in states], ["club_id"], [F.col("event_time").desc_nulls_last()])
    return null_safe_join(clubs, exact_median_by(base, ["department"], ZONE_COLUMNS), ["department"], "left")


def unified_clubs(base: DataFrame, live: DataFrame) -> DataFrame:
    """Batch and live clubs within the country, missing texts named.

    ``place_id`` tells rows apart, as two batch clubs may share a name.
    """
    texts = {"department": "N/A", "commune": "N/A", "name": "Sans nom", "type": "N/A", "stream_source": BATCH}
    kept = union_all([base, live]).fillna(texts).filter(in_bbox("lat", "lon", fixed.BBOX_WIDE))
    return kept.withColumn("place_id", stable_id("stream_source", "club_id", "name", "lat", "lon"))


def score_base(df: DataFrame, score: str = "zone_score", out: str = "score_base", default: float = fixed.SCORE_DEFAULT) -> DataFrame:
    """A positive score, else the median of the positive ones, else the default."""
    positive = df.filter(F.col(score) > 0)
    median = exact_quantiles(positive, [score], {"median": 0.5}).scalar()
    return df.withColumn(
        out, F.coalesce(F.when(F.col(score) > 0, F.col(score)), median, F.lit(default))
    )


def base_pressure(clubs: DataFrame, *, club_id: str = "place_id", **kw) -> DataFrame:
    """(place_id, base_pressure, base_nearest_km) among the batch clubs."""
    batch = clubs.filter(F.col("stream_source") == BATCH)
    return competition_pressure(
        batch, batch, target_id=club_id, competitor_id=club_id, intensity=fixed.BASE_INTENSITY,
        pressure="base_pressure", nearest="base_nearest_km", **kw,
    )


def event_pressure(clubs: DataFrame, *, club_id: str = "place_id", **kw) -> DataFrame:
    """(place_id, event_pressure, event_nearest_km) of the live clubs on all clubs."""
    live = clubs.filter(F.col("stream_source") == LIVE)
    return competition_pressure(
        clubs, live, target_id=club_id, competitor_id=club_id, intensity=fixed.LIVE_INTENSITY,
        pressure="event_pressure", nearest="event_nearest_km", **kw,
    )


def live_score(clubs: DataFrame, *, club_id: str = "place_id", cut: bool = True, **kw) -> DataFrame:
    """Scores of all clubs under batch and live pressure. ``club_id`` must be unique over both sources.

    One join of pairs serves both pressures. The clubs are needed four times over; with ``cut`` they are computed once, into the checkpoint folder.
    """
    if cut:
        clubs = cut_lineage(clubs)
    batch, live = (F.col("stream_source") == kind for kind in (BATCH, LIVE))
    both = competition_pressures(
        clubs, clubs, [
            Pressure(batch, fixed.BASE_INTENSITY, "base_pressure", "base_nearest_km"),
            Pressure(live, fixed.LIVE_INTENSITY, "event_pressure", "event_nearest_km"),
        ], target_id=club_id, competitor_id=club_id, **kw,
    )
    pressed = score_base(clubs).join(both, club_id, "left")
    # batch clubs press on each other only
    pressed = pressed.withColumns({c: F.when(batch, F.col(c)) for c in ("base_pressure", "base_nearest_km")})
    zero = F.lit(0.0)
    by_event = F.coalesce(F.col("event_pressure"), zero)
    total = clip(F.coalesce(F.col("base_pressure"), zero) + by_event, 0.0, fixed.PRESSURE_MAX)
    return pressed.withColumns(
        {
            "event_pressure": by_event,
            "competition_pressure": total,
            "distance_to_club_km": nearest_of("base_nearest_km", "event_nearest_km"),
            "score": clip(F.col("score_base") - total, fixed.SCORE_MIN, fixed.SCORE_MAX),
            "score_delta": zero - by_event,
            "score_impacted": by_event >= fixed.SCORE_DELTA_VISIBLE,
        }
    ).drop("base_pressure", "base_nearest_km", "event_nearest_km")
