"""Statistics, ranking, de-duplication and joins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from placerank.operators import dedupe, joins, rank, sets, stats


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    groups = {"a": np.round(rng.normal(size=3000), 2), "b": np.array([5.0]), "c": np.repeat([1.0, 2.0], 700), None: rng.random(801)}
    rows = [(g, float(v), None if i % 4 else float(v) * 2) for g, vs in groups.items() for i, v in enumerate(vs)]
    rows += [("none", None, float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    qs = {"lo": 0.02, "mid": 0.5, "hi": 0.98}
    got = {r["g"]: r for r in stats.exact_quantiles(df, ["x", "y"], qs, ["g"], accuracy=100).collect()}
    assert set(got) == {"a", "b", "c", None, "none"}
    for g, vs in groups.items():
        for name, q in qs.items():
            assert got[g][f"x_{name}"] == pytest.approx(np.quantile(vs, q))
            assert got[g][f"y_{name}"] == pytest.approx(np.quantile(vs[::4] * 2, q))
    assert got["none"]["x_mid"] is None and got["none"]["y_mid"] is None
    whole = np.concatenate(list(groups.values()))
    row = stats.exact_quantiles(df, ["x"], qs, accuracy=100).collect()
    assert len(row) == 1 and row[0]["x_hi"] == pytest.approx(np.quantile(whole, 0.98))


def test_quantiles_of_one_group_of_a_million_values(spark):
    """No window orders a group, and the values of a wide bracket lie in many ranges."""
    df = spark.range(1_000_000, numPartitions=8).selectExpr("(id * 7919) % 1000003 / 7D AS x", "'one' AS g")
    want = np.quantile((np.arange(1_000_000) * 7919) % 1000003 / 7, [0.02, 0.5, 0.98])
    for accuracy in (10000, 20):  # at 20 nearly all values lie in a bracket
        out = stats.exact_quantiles(df, ["x"], {"lo": 0.02, "mid": 0.5, "hi": 0.98}, ["g"], accuracy=accuracy)
        assert [out.collect()[0][f"x_{n}"] for n in ("lo", "mid", "hi")] == pytest.approx(want)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_range" in line for line in windows)


def test_a_missed_bracket_is_an_error(spark):
    df = spark.range(100_000).selectExpr("id * 1D AS x")
    with pytest.raises(Exception, match="outside the bracket"):
        stats.exact_quantiles(df, ["x"], {"mid": 0.7321}, accuracy=10, margin=0.0).collect()


def test_dual_rank_orders_no_table_in_one_task(spark):
    rng = np.random.default_rng(6)
    rows = [(i, None if i % 5 == 0 else int(rng.integers(0, 3)) * (i % 3 == 0), int(rng.integers(0, 40))) for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, g int, s int").repartition(16)
    out = rank.dual_rank(df, [F.desc("s"), F.asc("id")], ["g"])
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    per, want = {}, {}
    for i, r in enumerate(order):
        per[r[1]] = per.get(r[1], 0) + 1
        want[r[0]] = (i + 1, per[r[1]])
    assert {r.id: (r.rank_all, r.rank_part) for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert all("_range" in line for line in plan.splitlines() if "row_number" in line and "Window [" in line)


def test_exact_quantiles_without_interpolation(spark):
    values = np.random.default_rng(3).integers(0, 400, 5000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    r = stats.quantile_profile(df, "x", (0.0, 0.07, 0.5, 1.0), exact=True).collect()[0]
    # in whole numbers, as 0.07 * 5000 is a little more than 350
    wanted = [min(v for v in values if np.sum(values <= v) * 100 >= percent * len(values)) for percent in (0, 7, 50, 100)]
    assert (r["n"], r["p0"], r["p7"], r["p50"], r["p100"]) == (5001, *wanted)
    assert stats.global_median(df, "x", exact=True).collect()[0]["median"] == wanted[2]
    assert stats.quantile_profile(df.limit(0), "x", exact=True).collect()[0].asDict() == {"n": 0, "min": 0.0, "max": 0.0, "p50": 0.0, "p90": 0.0, "p99": 0.0}


def test_quantiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert stats.exact_quantiles(df, ["x"], {"mid": 0.5}).agg(F.max("x_mid")).collect()[0][0] is None
    assert stats.quantile_profile(df, "x").collect()[0].asDict() == {"n": 0, "min": 0.0, "max": 0.0, "p50": 0.0, "p90": 0.0, "p99": 0.0}


def test_color_range(spark):
    def of(*xs):
        df = spark.createDataFrame([(x,) for x in xs], "x double")
        return tuple(stats.color_range(df, "x").collect()[0])

    assert of(0.5, 0.5) == pytest.approx((0.48, 0.52))
    assert of(0.99) == pytest.approx((0.97, 1.0))
    assert of(0.0, 1.0) == pytest.approx((0.02, 0.98))
    assert of() == (0.0, 1.0)


def test_minmax_stays_in_range(spark):
    df = spark.createDataFrame([(float(x), 4) for x in np.random.default_rng(1).normal(size=50)], "x double, y int")
    out = stats.minmax(df, {"x": "xn", "y": "yn"}, degenerate=0.5).collect()
    assert min(r["xn"] for r in out) == 0.0 and max(r["xn"] for r in out) == 1.0
    assert {r["yn"] for r in out} == {0.5}


def test_ranks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 4)), float(rng.integers(0, 30))) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, g int, s double").repartition(20)
    order = [F.desc("s"), F.asc("id")]
    expected = [r[0] for r in sorted(rows, key=lambda r: (-r[2], r[0]))]
    got = {r["rank"]: r["id"] for r in rank.global_rank(df, order).collect()}
    assert [got[i + 1] for i in range(len(rows))] == expected
    assert [r["id"] for r in rank.top_k(df, order, 7).orderBy("rank").collect()] == expected[:7]
    per = rank.top_k_per(df, ["g"], order, 11, branches=3).collect()
    for g in range(4):
        mine = [r[0] for r in sorted(rows, key=lambda r: (-r[2], r[0])) if r[1] == g][:11]
        assert [r["id"] for r in sorted(per, key=lambda r: r["rank"]) if r["g"] == g] == mine


def test_top_k_per_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    plan = rank.top_k_per(df, ["g"], [F.desc("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedupe_is_a_total_order(spark):
    rows = [("A", 1, 48.0001, 2.0, None), ("B", 2, 48.0002, 2.0, 3), ("B", 3, 48.0, 2.0, 3), ("A", 4, 49.0, 2.0, None)]
    df = spark.createDataFrame(rows, "source string, id int, lat double, lon double, courts int")
    order = [F.col("courts").desc_nulls_last(), F.asc("source"), F.asc("id")]
    for parts in (1, 4):
        got = {r["id"] for r in dedupe.dedupe_spatial(df.repartition(parts), "lat", "lon", 3, order).collect()}
        assert got == {2, 4}


def test_keep_last(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string")
    b = spark.createDataFrame([(2, "b", 9)], "id int, v string, w int")
    assert {(r["id"], r["v"], r["w"]) for r in dedupe.keep_last([a, b], ["id"]).collect()} == {(1, "a", None), (2, "b", 9)}


def test_coverage(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "k string"), spark.createDataFrame([("y",), ("z",)], "k string")
    assert {tuple(r) for r in sets.coverage_check(a, "k", b).collect()} == {("z", "missing"), ("x", "extra")}
    with pytest.raises(ValueError):
        sets.assert_coverage(a, "k", b)
    with pytest.raises(ValueError):
        joins.assert_unique(a.union(a), ["k"])


def test_a_join_of_a_large_table_is_not_hinted(spark):
    df = spark.range(10).toDF("k")
    plan = joins.enrich(df, df.withColumn("v", F.lit(1)), "k")._jdf.queryExecution().analyzed().toString()
    assert "hint" not in plan.lower()


def test_exact_quantiles_do_not_deal_the_table_by_group(spark):
    """The values are bracketed where they are read: only the runs between are exchanged, so no task reads a whole group."""
    from placerank.operators import stats

    df = spark.range(20000).selectExpr("id % 2 AS g", "pmod(hash(id), 5000) AS x")
    planned = []
    real = stats._with_ends
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")  # the table is above it, its brackets are not
    try:
        stats._with_ends = lambda runs, *a: planned.append(runs._jdf.queryExecution().sparkPlan().toString()) or real(runs, *a)
        stats.exact_quantiles(df, ["x"], {"m": 0.5}).collect()
        stats.exact_quantiles(df, ["x"], {"m": 0.5}, ["g"]).collect()
    finally:
        stats._with_ends = real
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in planned) and len(planned) == 2
