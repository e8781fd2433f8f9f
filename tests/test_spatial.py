"""Spatial operators against all pairs on small fixtures, with copies and crowded buckets."""

import numpy as np
import pytest

from placerank import fixed
from placerank.operators import spatial


def km(lat1, lon1, lat2, lon2):
    p1, l1, p2, l2 = (np.radians(x) for x in (lat1, lon1, lat2, lon2))
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin((l2 - l1) / 2) ** 2
    return 2 * 6371 * np.arcsin(np.sqrt(a))


def make(seed, n, m, spread=0.3, lat0=48.0, digits=4):
    """Points and places; a third of the places are copies of one position, and one bucket is crowded."""
    rng = np.random.default_rng(seed)

    def cloud(k):
        wide = np.column_stack([lat0 + rng.random(k) * spread, 2.0 + rng.random(k) * spread])
        tight = np.column_stack([lat0 + 0.101 + rng.random(k) * 0.004, 2.101 + rng.random(k) * 0.004])
        return np.round(np.vstack([wide, tight]), digits)

    points, places = cloud(n), cloud(m)
    places[: m // 3] = places[0]
    points[:3] = places[0]
    return points, places


def frames(spark, points, places):
    p = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id int, lat double, lon double")
    q = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(places)], "pid int, lat double, lon double")
    return p, q


def brute(points, places, deg, span, radius):
    b1, b2 = np.floor(points / deg).astype(int), np.floor(places / deg).astype(int)
    near = (np.abs(b1[:, None, :] - b2[None, :, :]) <= span).all(axis=2)
    d = km(points[:, None, 0], points[:, None, 1], places[None, :, 0], places[None, :, 1])
    return near, d, np.where(near & (d <= radius), 1, 0).sum(axis=1), np.where(near, d, np.inf).min(axis=1)


@pytest.mark.parametrize("seed,deg,span,radius,fine", [(1, 0.01, 1, 1.0, 16), (2, 0.05, 3, 5.0, 4), (3, 0.05, 1, 0.4, 8), (4, 0.02, 2, 0.7, 2), (5, 0.05, 1, 0.05, 1)])
def test_proximity_equals_all_pairs(spark, seed, deg, span, radius, fine):
    points, places = make(seed, 60, 120)
    _, _, count, nearest = brute(points, places, deg, span, radius)
    p, q = frames(spark, points, places)
    got = {
        r["id"]: r for r in
        spatial.proximity_metrics(p, q, point_id="id", deg=deg, span=span, radius_km=radius, fine=fine).collect()
    }
    for i in range(len(points)):
        if np.isinf(nearest[i]):
            assert i not in got
        else:
            assert got[i]["n_within"] == count[i]
            assert got[i]["nearest_km"] == pytest.approx(nearest[i], abs=1e-9)


@pytest.mark.parametrize("lat0", [48.0, -0.1, 69.0])
def test_exact_mode_sees_every_place_within_the_radius(spark, lat0):
    points, places = make(7, 50, 100, lat0=lat0)
    _, d, _, _ = brute(points, places, 0.01, 10**6, 3.0)
    p, q = frames(spark, points, places)
    got = {
        r["id"]: (r["n_within"], r["nearest_km"]) for r in
        spatial.proximity_metrics(p, q, point_id="id", deg=0.01, radius_km=3.0, exact=True).collect()
    }
    for i in range(len(points)):
        n, nearest = got.get(i, (0, None))
        assert n == (d[i] <= 3.0).sum()
        assert nearest is None if d[i].min() > 3.0 else nearest == pytest.approx(d[i].min(), abs=1e-9)


def test_count_within_counts_a_moving_id_once(spark):
    points = np.array([[48.0, 2.0], [48.5, 2.5], [48.9, 2.9]])
    p, _ = frames(spark, points, points)
    q = spark.createDataFrame(
        [(1, 48.001, 2.0), (1, 48.002, 2.0), (1, 48.501, 2.5), (2, 48.003, 2.0), (2, 48.003, 2.0), (3, None, 2.0), (4, 48.5, 2.501)],
        "pid int, lat double, lon double",
    )
    got = {r["id"]: r["n"] for r in spatial.count_within(
        p, q, point_id="id", place_id="pid", radius_km=1.0, deg=0.01, span=1, within="n").collect()}
    assert got == {0: 2, 1: 2}


def test_within_radius_pairs(spark):
    points, places = make(11, 40, 40)
    p, q = frames(spark, points, places)
    pairs = spatial.within_radius_pairs(
        p, q.toDF("pid", "qlat", "qlon"), 2.0, 0.02, left=("lat", "lon"), right=("qlat", "qlon")
    )
    d = km(points[:, None, 0], points[:, None, 1], places[None, :, 0], places[None, :, 1])
    assert {(r["id"], r["pid"]) for r in pairs.select("id", "pid").collect()} == set(zip(*map(lambda x: x.tolist(), np.where(d <= 2.0))))


@pytest.mark.parametrize("deg,lat0", [(0.02, 48.0), (0.5, 66.0)])
def test_self_pairs_are_made_once(spark, deg, lat0):
    points, _ = make(12, 60, 6, lat0=lat0)
    p, _ = frames(spark, points, points)
    p = p.unionByName(spark.createDataFrame([(None, lat0, 2.0), (999, None, 2.0)], "id int, lat double, lon double"))
    got = [(r["a"], r["b"]) for r in spatial.within_radius_self_pairs(p, 2.0, deg, key="id").collect()]
    d = km(points[:, None, 0], points[:, None, 1], points[None, :, 0], points[None, :, 1])
    assert sorted(got) == sorted((i, j) for i, j in zip(*np.where(d <= 2.0)) if i < j)
    # before the distance is known there are hardly more candidates than half of all
    plan = spatial.within_radius_self_pairs(p, 2.0, deg, key="id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


@pytest.mark.parametrize("fine", [1, 2, 8])
def test_pressure_equals_all_pairs(spark, fine):
    points, _ = make(5, 30, 6, spread=2.0)
    points[10:14] = points[10]  # clubs at one position press on each other at distance 0
    courts = [None if i % 5 == 0 else float(i % 20) for i in range(len(points))]
    df = spark.createDataFrame(
        [(i, float(a), float(b), c) for i, ((a, b), c) in enumerate(zip(points, courts))], "id int, lat double, lon double, courts double"
    )
    got = {r["id"]: r for r in spatial.competition_pressure(
        df, df, target_id="id", competitor_id="id", intensity=fixed.BASE_INTENSITY, cap=9.0, fine=fine).collect()}
    load = np.array([0.002 + 0.008 * min(max(2.0 if c is None else c, 1.0), 12.0) / 12 for c in courts])
    d = km(points[:, None, 0], points[:, None, 1], points[None, :, 0], points[None, :, 1])
    np.fill_diagonal(d, np.inf)
    factor = np.where(d <= 55, np.clip(1 - d / 55, 0, None) ** 1.25, 0) * load[None, :]
    for i in range(len(points)):
        assert got[i]["pressure"] == pytest.approx(factor[i].sum(), abs=1e-9)
        inside = d[i][d[i] <= 55]
        assert (got[i]["nearest_km"] is None) if not len(inside) else got[i]["nearest_km"] == pytest.approx(inside.min(), abs=1e-9)


def test_match_keeps_places_without_cell(spark):
    from pyspark.sql import functions as F

    places = spark.createDataFrame([(1, 48.001, 2.001), (2, 40.0, 1.0)], "id int, lat double, lon double")
    cells = spark.createDataFrame([(48.0, 2.0, 0.3), (48.002, 2.0, 0.9), (48.002, 2.0, None)], "cell_lat double, cell_lon double, s double")
    got = {r["id"]: r["s"] for r in spatial.match_cell(places, cells, 2, [F.col("s").desc_nulls_last()], place_id="id").collect()}
    assert got == {1: 0.9, 2: None}


def city(n, seed, width=0.3):
    """n positions of one crowded bucket"""
    rng = np.random.default_rng(seed)
    return np.column_stack([48.0 + rng.random(n) * width, 2.0 + rng.random(n) * width])


def compared(spark, points, places, deg=1.0, **kw):
    """Rows of positions that the points are compared with."""
    from pyspark.sql import functions as F

    p, q = frames(spark, points, places)
    positions = q.select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.lit(1).cast("long").alias("_w"))
    buckets, several = spatial._place_tree(positions, deg, 8, ["_w"])
    tree = spatial._surroundings(buckets, spatial._around(deg, 1, None, False))
    rows = spatial._opened(spatial._with_bucket(p, "id", "lat", "lon", deg), tree, several, ["_w"], **kw)
    return rows.filter(F.col("_lat").isNotNull())


def test_comparisons_do_not_grow_with_a_city(spark):
    """While a bucket's places double, the nearest one is looked for among a few positions, and a circle opens those near its edge only."""
    points = city(60, 1, 0.05)
    nearest, cut = {}, {}
    for n in (1000, 2000, 4000):
        places = city(n, 2, 0.05)
        nearest[n] = compared(spark, points, places, 0.05, nearest=True, radius_km=None, count=None).count() / 60
        cut[n] = compared(spark, points, places, 0.05, nearest=False, radius_km=1.0, count="_w").count() / 60 / n
    assert nearest[4000] < 4
    assert max(cut.values()) < 0.02


def test_pressure_opens_few_beyond_the_radius(spark):
    from pyspark.sql import functions as F

    from placerank.functions.geo import haversine_km

    rows = compared(spark, city(40, 3, 2.0), city(4000, 4, 2.0), nearest=False, radius_km=20.0, count=None)
    n = rows.count()
    hits = rows.filter(haversine_km("_plat", "_plon", "_lat", "_lon") <= 20.0).count()
    assert 0 < hits <= n < 1.5 * hits


def test_lists_of_a_tree_are_bounded(spark):
    """However crowded a bucket is, its row lists at most fine squared cells of as many parts."""
    from pyspark.sql import functions as F

    places = city(20000, 5)
    _, q = frames(spark, places[:1], places)
    buckets, several = spatial._place_tree(q.selectExpr("lat AS _lat", "lon AS _lon", "1L AS _w"), 1.0, 4, ["_w"])
    (row,) = buckets.select(F.size("node.cells").alias("cells"), F.expr("array_max(transform(node.cells, c -> size(c.parts)))").alias("parts"), "node._w").collect()
    assert row.cells <= 16 and row.parts <= 16 and row._w == 20000 and several.count() > 15000


def test_near_the_pole_and_across_the_meridian(spark):
    """Boxes are in space, so bounds hold where longitudes do not: the result is that of all pairs seen."""
    rng = np.random.default_rng(8)
    points = np.column_stack([89.5 + rng.random(30) * 0.4, rng.random(30) * 0.9])
    places = np.column_stack([89.5 + rng.random(200) * 0.4, rng.random(200) * 0.9])
    _, _, count, nearest = brute(points, places, 1.0, 1, 10.0)
    p, q = frames(spark, points, places)
    got = {r["id"]: r for r in spatial.proximity_metrics(p, q, point_id="id", deg=1.0, span=1, radius_km=10.0).collect()}
    assert all(got[i]["n_within"] == count[i] and got[i]["nearest_km"] == pytest.approx(nearest[i], abs=1e-9) for i in range(30))


def test_both_pressures_of_live_clubs_share_one_join(spark):
    from placerank.plans import live

    rows = [(str(i), f"c{i}", 48.0 + i / 100, 2.0, float(i % 9), [live.BATCH, live.LIVE][i % 3 == 0], 0.5) for i in range(30)]
    clubs = spark.createDataFrame(rows, "place_id string, name string, lat double, lon double, courts double, stream_source string, zone_score double")
    got = {r["place_id"]: r for r in live.live_score(clubs, cut=False).collect()}
    base = {r["place_id"]: r for r in live.base_pressure(clubs).collect()}
    event = {r["place_id"]: r for r in live.event_pressure(clubs).collect()}
    for i, r in got.items():
        both = (base[i]["base_pressure"] if i in base else 0.0) + event[i]["event_pressure"]
        assert r["competition_pressure"] == pytest.approx(min(both, fixed.PRESSURE_MAX)) and r["event_pressure"] == pytest.approx(event[i]["event_pressure"])
    plan = live.live_score(clubs, cut=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(node") == 1


def test_only_boxes_are_copied_to_the_buckets_around(spark):
    """What a bucket sends to its neighbours is one box and its counts, however many places it holds."""
    _, q = frames(spark, city(1, 5), city(3000, 5))
    buckets, _ = spatial._place_tree(q.selectExpr("lat AS _lat", "lon AS _lon", "1L AS _w"), 1.0, 8, ["_w"])
    near = spatial._surroundings(buckets, spatial._around(1.0, 3, None, False)).near
    held = near.schema["_near"].dataType.elementType
    assert "cells" not in held.names and all(f.dataType.typeName() != "array" for f in held)
    assert near.count() == 49


def test_joins_of_the_tree_are_dealt_before_they_are_chosen(spark):
    """A join chosen by the size of the files would broadcast all copies and lists."""
    points, places = make(1, 60, 120)
    p, q = frames(spark, points, places)
    got = spatial.proximity_metrics(p, q, point_id="id", deg=0.05, span=3, radius_km=5.0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [lat_b") == 1 and plan.count("RepartitionByExpression [_by") == 1
    assert plan.count("RepartitionByExpression [_sy") == 1 and "LeftSemi" not in plan


def test_lists_and_boxes_of_a_tree_are_not_dealt(spark):
    """What goes between tasks is a row per part, once for all readers of the tree; lists are made where they are read."""
    points, places = make(1, 60, 120)
    places = np.vstack([places, places + 1e-5])  # some parts of several positions
    p, q = frames(spark, points, places)
    buckets, _ = spatial._place_tree(q.selectExpr("lat AS _lat", "lon AS _lon", "1L AS _w"), 0.05, 8, ["_w"])
    plan = buckets._jdf.queryExecution().sparkPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(plan) if "Exchange" in line]
    assert dealt and max(i for i, line in enumerate(plan) if "collect_list" in line) < min(dealt)
    for kw in ({"within": None}, {"radius_km": 5.0}):
        got = spatial.proximity_metrics(p, q, point_id="id", deg=0.05, span=3, **kw)
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange hashpartitioning(_hy") - plan.count("ReusedExchange [_hy") == 1, plan


@pytest.mark.parametrize("most", [7, 10**6])
def test_pairs_of_a_crowded_bucket_are_dealt_to_many_tasks(spark, monkeypatch, most):
    from pyspark.sql import functions as F

    monkeypatch.setattr(spatial, "PAIRS_PER_TASK", most)
    points, places = make(13, 40, 50)
    p, q = frames(spark, points, places)
    p = p.unionByName(spark.createDataFrame([(900, 10.0, 10.0), (901, None, 2.0)], "id int, lat double, lon double"))
    near, d, _, _ = brute(points, places, 0.05, 1, 1.0)
    pairs = spatial.neighbor_join(p, q.toDF("pid", "place_lat", "place_lon"), 0.05, 1)
    got = pairs.select("id", "pid", F.spark_partition_id().alias("task")).collect()
    alone = [i for i in range(len(points)) if not near[i].any()] + [900, 901]
    assert sorted((r.id, -1 if r.pid is None else r.pid) for r in got) == sorted([(int(i), int(j)) for i, j in zip(*np.where(near))] + [(i, -1) for i in alone])
    # the pairs of the most crowded bucket
    home = np.floor(points / 0.05).astype(int)
    values, number = np.unique(home, axis=0, return_counts=True)
    there = {i for i in range(len(points)) if (home[i] == values[number.argmax()]).all()}
    assert len({r.task for r in got if r.id in there}) >= (3 if most == 7 else 1)

    selves = [(r["a"], r["b"]) for r in spatial.within_radius_self_pairs(p.filter("id < 900"), 5.0, 0.05, key="id").collect()]
    e = km(points[:, None, 0], points[:, None, 1], points[None, :, 0], points[None, :, 1])
    assert sorted(selves) == sorted((i, j) for i, j in zip(*np.where(e <= 5.0)) if i < j)
    both = spatial.within_radius_pairs(p, q.toDF("pid", "qlat", "qlon"), 2.0, 0.02, left=("lat", "lon"), right=("qlat", "qlon"))
    assert sorted((r["id"], r["pid"]) for r in both.collect()) == sorted(zip(*map(lambda x: x.tolist(), np.where(d <= 2.0))))


def dealt_rows(df):
    """Rows that go between tasks while a query is run, by the metrics of its exchanges."""
    df.collect()

    def children(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return [node.executedPlan()]
        if kind.endswith("QueryStageExec"):
            return [node.plan()]
        return [node.children().apply(i) for i in range(node.children().size())]

    total, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        left += children(node)
    return total


def test_pairs_of_a_pressure_are_not_dealt(spark):
    """What goes between tasks grows with the places, their pairs with the square of them."""
    dealt = {}
    for n in (500, 1000):
        p, _ = frames(spark, city(n, 9, 0.4), city(1, 9))
        p = p.selectExpr("*", "2D AS courts")
        dealt[n] = dealt_rows(spatial.competition_pressure(
            p, p, target_id="id", competitor_id="id", intensity=fixed.BASE_INTENSITY, cap=9.0))
    assert dealt[1000] < 2.5 * dealt[500] and dealt[1000] < 40 * 1000  # of over 900 000 pairs


@pytest.mark.parametrize("block", [7, 50])
def test_pressure_of_a_crowded_bucket_in_blocks(spark, monkeypatch, block):
    """Blocks of spots and of places meet once each; a target outside of all and one without a position have no pressure."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(spatial, "BLOCK", block)
    targets, places = make(21, 40, 60, spread=1.5, lat0=47.8)
    load = np.array([0.002 + 0.008 * max(i % 15, 1) / 12 if i % 15 <= 12 else 0.01 for i in range(len(places))])
    live = np.arange(len(places)) % 3 == 0
    p, q = frames(spark, targets, places)
    p = p.unionByName(spark.createDataFrame([(900, 10.0, 10.0), (901, None, 2.0), (None, 48.0, 2.0)], "id int, lat double, lon double"))
    q = q.selectExpr("pid + 1000 AS pid", "lat", "lon", "CAST(pid % 15 AS DOUBLE) AS courts", "pid % 3 = 0 AS live")
    q = q.unionByName(spark.createDataFrame([(9000, None, 2.0, 3.0, True)], q.schema))
    classes = [spatial.Pressure(F.lit(True), fixed.BASE_INTENSITY, "all", "all_km"), spatial.Pressure(F.col("live"), (0.0, 1.0), "live", "live_km")]
    got = {r["id"]: r for r in spatial.competition_pressures(
        p, q, classes, target_id="id", competitor_id="pid", radius_km=20.0, cap=10**6).collect()}
    d = km(targets[:, None, 0], targets[:, None, 1], places[None, :, 0], places[None, :, 1])
    decay = np.where(d <= 20, np.clip(1 - d / 20, 0, None) ** 1.25, 0)
    every, lively = (decay * load).sum(axis=1), (decay * (np.minimum(np.maximum(np.arange(len(places)) % 15, 1), 12) / 12) * live).sum(axis=1)
    for i in range(len(targets)):
        assert got[i]["all"] == pytest.approx(every[i], abs=1e-9) and got[i]["live"] == pytest.approx(lively[i], abs=1e-9)
        for name, seen in (("all_km", d[i] <= 20), ("live_km", (d[i] <= 20) & live)):
            assert (got[i][name] is None) if not seen.any() else got[i][name] == pytest.approx(d[i][seen].min(), abs=1e-9)
    assert len(got) == len(targets) + 3 and all(got[i]["all"] == 0 and got[i]["all_km"] is None for i in (900, 901))


def test_kpis_of_dense_live_clubs_deal_no_pairs(spark):
    from placerank.plans import live, views

    places = city(600, 10, 0.3)
    rows = [(str(i), f"c{i}", float(a), float(b), float(i % 9), [live.BATCH, live.LIVE][i % 3 == 0], 0.5) for i, (a, b) in enumerate(places)]
    clubs = spark.createDataFrame(rows, "place_id string, name string, lat double, lon double, courts double, stream_source string, zone_score double")
    got = views.kpis(live.live_score(clubs, cut=False))
    assert dealt_rows(got) < 60 * 600  # of nearly 360 000 pairs
    (row,) = got.collect()
    assert (row.visible, row.live, row.impacted_visible, row.impacted) == (600, 200, 600, 600)
