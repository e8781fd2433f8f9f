"""Counts of an extract: each table in few passes, extracts without nodes or ways."""

import pytest

from placerank.sources import osm

NODES = "id long, lat double, lon double, tags map<string,string>"
WAYS = "id long, tags map<string,string>, refs array<bigint>"


def stats(spark, nodes, ways):
    return osm.osm_extract_stats(spark.createDataFrame(nodes, NODES), spark.createDataFrame(ways, WAYS)).collect()[0].asDict()


def test_counts_of_an_extract(spark):
    nodes = [
        (1, 48.0, 2.0, {"highway": "bus_stop"}), (2, 48.0, 2.0, {"name": "x"}), (3, None, 2.0, {"railway": "station"}),
        (4, 95.0, 2.0, {"railway": "station"}), (5, 48.0, 2.0, None),
    ]
    ways = [
        (10, {"highway": "motorway"}, [1, 2, 2]), (11, {"highway": "primary"}, [3, 99]), (12, {"highway": "residential"}, [1]),
        (13, None, [1]), (14, {"highway": "trunk"}, None),
    ]
    assert stats(spark, nodes, ways) == {
        "nodes_seen": 5, "ways_seen": 5, "stops_kept": 1, "roads_kept": 1, "roads_without_nodes": 2
    }


@pytest.mark.parametrize("nodes, ways", [([], []), ([(1, 48.0, 2.0, {})], []), ([], [(10, {"highway": "trunk"}, [1])])])
def test_extracts_without_nodes_or_ways(spark, nodes, ways):
    got = stats(spark, nodes, ways)
    assert got == {
        "nodes_seen": len(nodes), "ways_seen": len(ways), "stops_kept": 0, "roads_kept": 0, "roads_without_nodes": len(ways)
    }


def test_each_table_is_read_twice(spark, tmp_path):
    for name, schema in (("nodes", NODES), ("ways", WAYS)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    nodes, ways = (spark.read.parquet(str(tmp_path / name)) for name in ("nodes", "ways"))
    plan = osm.osm_extract_stats(nodes, ways)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4
