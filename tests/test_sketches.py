"""Sketches as columns: merged sketches against exact ranks, parts that are replayed, groups without values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from placerank.operators import sketches

QS = {"p10": 0.1, "p50": 0.5, "p99": 0.99}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    n = 60_000
    # a third of all rows has one key; heavy ties in y
    keys = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 9, n))
    pdf = {"g": keys, "day": rng.integers(0, 5, n), "x": rng.lognormal(3, 2, n), "y": rng.integers(0, 4, n).astype(float)}
    return spark.createDataFrame(__import__("pandas").DataFrame(pdf)), pdf


def off(values, found, q):
    """How far q lies outside the ranks that the value found covers."""
    low, high = np.mean(values < found), np.mean(values <= found)
    return max(low - q, q - high, 0.0)


@pytest.mark.parametrize("k", [200, 1000])
def test_merged_sketches_keep_their_rank_error(rows, k):
    df, plain = rows
    fine = sketches.sketch_by(df, ["g", "day"], ["x", "y"], k)
    got = sketches.quantiles(sketches.merge_by(fine, ["g"]), QS, ["g"]).collect()
    assert len(got) == 9
    for r in got:
        mine = plain["g"] == r["g"]
        assert r["n"] == r["x_n"] == mine.sum()
        assert (r["x_min"], r["x_max"]) == (plain["x"][mine].min(), plain["x"][mine].max())
        for c in ("x", "y"):
            for name, q in QS.items():
                assert off(plain[c][mine], r[f"{c}_{name}"], q) <= 2 * sketches.rank_error(k)


def test_small_groups_are_exact(spark):
    df = spark.createDataFrame([(i % 3, float(i)) for i in range(300)], "g int, x double")
    for r in sketches.quantiles(sketches.sketch_by(df, ["g"], ["x"], 200), {"p50": 0.5}, ["g"]).collect():
        assert r["x_p50"] == sorted(range(r["g"], 300, 3))[49]


def test_groups_without_values(spark):
    rows = [("a", None), ("a", float("nan")), (None, 2.0), (None, None), ("b", 5.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    merged = sketches.merge_by(sketches.sketch_by(df, ["g"], ["x"]), ["g"])
    got = {r["g"]: r for r in sketches.quantiles(merged, {"p50": 0.5}, ["g"]).collect()}
    assert (got["a"]["n"], got["a"]["x_n"], got["a"]["x_min"], got["a"]["x_p50"]) == (2, 0, None, None)
    assert (got[None]["n"], got[None]["x_n"], got[None]["x_p50"]) == (2, 1, 2.0)
    whole = sketches.quantiles(sketches.merge_by(sketches.sketch_by(df, ["g"], ["x"]), []), {"p50": 0.5}).collect()
    assert [(r["n"], r["x_n"], r["x_max"]) for r in whole] == [(5, 2, 5.0)]
    none = sketches.quantiles(sketches.sketch_by(df.limit(0), [], ["x"]), {"p50": 0.5}).collect()
    assert [(r["n"], r["x_p50"]) for r in none] == [(0, None)]


def test_a_share_of_values(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    assert sketches.share_at_most(sketches.sketch_by(df, [], ["x"]), "x", 24.0).first()["share"] == pytest.approx(0.25)


def test_a_replayed_part_takes_the_place_of_its_first_run(spark, rows, tmp_path):
    df, plain = rows
    path = str(tmp_path / "parts")
    sketches.write_parts(df, path, "day", ["g"], ["x"])
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "parts").glob("part=*/*.parquet")}
    sketches.write_part(df.filter("day = 3"), path, "3", ["g"], ["x"])
    kept = [f for f in files if "part=3" not in str(f)]
    assert kept and all(f.stat().st_mtime_ns == files[f] for f in kept)
    assert sketches.read_merged(spark, path).first()["n"] == len(plain["x"])
    some = sketches.read_merged(spark, path, ["g"], F.col("part").isin("1", "2"))
    assert some.agg(F.sum("n")).first()[0] == np.isin(plain["day"], (1, 2)).sum()


def test_a_hot_key_is_combined_before_the_shuffle(rows):
    df, _ = rows
    plan = sketches.sketch_by(df, ["g"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in plan
