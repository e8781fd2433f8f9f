"""Transport stops and road axes from map nodes and ways held in tables.

nodes: id, lat, lon, tags map<string,string>; ways: id, tags map<string,string>, refs array<bigint>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values: (tag, value) pairs that make a node a stop, first match wins
STOP_TAGS = [
    ("highway", "bus_stop"),
    ("railway", "station"),
    ("railway", "tram_stop"),
    ("railway", "subway_entrance"),
    ("public_transport", "stop_position"),
]
# Road classes that make a way an axis
ROAD_CLASSES = ("motorway", "trunk", "primary")


def _tag(name: str) -> Column:
    return F.try_element_at("tags", F.lit(name))


def _valid_location() -> Column:
    return F.col("lat").between(-90.0, 90.0) & F.col("lon").between(-180.0, 180.0)


def _stop_type() -> Column:
    return F.coalesce(*[F.when(_tag(k) == v, F.lit(v)) for k, v in STOP_TAGS])


def osm_transport_stops(nodes: DataFrame) -> DataFrame:
    return (
        nodes.filter(_valid_location())
        .select(F.col("id").alias("osm_id"), _stop_type().alias("stop_type"), "lat", "lon")
        .filter(F.col("stop_type").isNotNull())
    )


def _axes(ways: DataFrame) -> DataFrame:
    return ways.select("id", _tag("highway").alias("road_type"), "refs").filter(
        F.col("road_type").isin(*ROAD_CLASSES)
    )


def osm_road_axes(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Mean position of the located nodes of each major road; a node listed twice counts twice.

    The references are counted per way and node before the join, and the weighted sums combine
    before the last shuffle, so a node shared by very many ways sends them as one group of rows only.
    """
    members = (
        _axes(ways).select("id", "road_type", F.explode("refs").alias("node"))
        .groupBy("id", "road_type", "node").agg(F.count("*").alias("times"))
    )
    located = nodes.filter(_valid_location()).select(F.col("id").alias("node"), "lat", "lon")
    times = F.col("times")
    return (
        members.join(located, "node")
        .groupBy("id", "road_type")
        .agg(
            (F.sum(F.col("lat") * times) / F.sum(times)).alias("lat_center"),
            (F.sum(F.col("lon") * times) / F.sum(times)).alias("lon_center"),
        )
        .withColumnRenamed("id", "osm_id")
    )


def osm_extract_stats(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """One row: nodes and ways seen, stops and roads kept, roads without a located node.

    Nodes and ways are each counted in one pass, and read once more for the join that tells which roads are kept.
    """
    counted = nodes.agg(
        F.count("*").alias("nodes_seen"), F.count_if(_valid_location() & _stop_type().isNotNull()).alias("stops_kept")
    )
    seen = ways.agg(
        F.struct(F.count("*").alias("ways"), F.count_if(_tag("highway").isin(*ROAD_CLASSES)).alias("axes")).alias("s")
    ).scalar()
    roads = osm_road_axes(ways, nodes).agg(F.count("*").alias("n")).scalar()
    # each scalar stands in the plan once
    row = counted.select("nodes_seen", "stops_kept", seen.alias("_seen"), roads.alias("roads_kept"))
    return row.select(
        "nodes_seen", F.col("_seen.ways").alias("ways_seen"), "stops_kept", "roads_kept",
        (F.col("_seen.axes") - F.col("roads_kept")).alias("roads_without_nodes"),
    )
