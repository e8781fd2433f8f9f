"""Writers that must keep every row, whatever the batch size."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from placerank.session import new_path
from placerank.sources import readers, writers

KEY = StructType([StructField("id", LongType())])


def test_geojson_keeps_all_rows_of_one_partition(spark):
    df = spark.range(25_000).select("id", (F.col("id") / 1000.0).alias("lon"), F.lit(45.0).alias("lat")).coalesce(1)
    path = new_path(spark, "geojson")
    writers.write_geojson(df, path, "lon", "lat", ["id"])
    assert sorted(readers.read_geojson_points(spark, path, KEY).collect()) == sorted(df.collect())


def test_geojson_document_is_bounded(spark):
    df = spark.range(50).select("id", (F.col("id") / 10.0).alias("lon"), F.lit(45.0).alias("lat"))
    path = new_path(spark, "document")
    writers.write_geojson_document(df, path, "lon", "lat", ["id"], 50)
    assert sorted(readers.read_geojson_document(spark, path, KEY).collect()) == sorted(df.collect())
    with pytest.raises(ValueError):
        writers.write_geojson_document(df, path, "lon", "lat", ["id"], 49)


def test_rows_are_counted_while_they_are_written(spark, monkeypatch):
    """The table is computed once: the accumulator sees every row once, also behind the exchange of a partitioned write."""
    made = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(1000, numPartitions=4).selectExpr("id", "id % 3 AS g").mapInArrow(once, "id long, g long")
    for by in (None, "g"):
        made.value = 0
        assert writers.write_verified(df, new_path(spark, "verified"), by) == 1000 and made.value == 1000
    monkeypatch.setattr(writers, "write_table", lambda df, path, by=None, seen=None: df.observe(seen, F.count(F.lit(1)).alias("n")).limit(9).write.parquet(path))
    with pytest.raises(ValueError, match="9 rows"):
        writers.write_verified(df, new_path(spark, "verified"))


def test_first_lines_of_many_files_take_no_job(spark):
    """Headers that differ, are compressed, quoted or marked; the scan itself is planned without a job."""
    from placerank.sources.files import expand, first_line
    from placerank.sources.readers import read_delimited

    path = new_path(spark, "headers")
    for i in range(12):
        head = ["a;b", "b;a", '"a";"c"'][i % 3]
        spark.createDataFrame([(head,), (f"{i};x",)], "value string").coalesce(1).write.option("compression", ["none", "gzip"][i % 2]).text(f"{path}/{i}")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = read_delimited(spark, f"{path}/*/part*")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert sorted(df.columns) == ["a", "b", "c"]
    got = {tuple(r) for r in df.select("a", "b", "c").collect()}
    assert got == {tuple({0: (str(i), "x", None), 1: ("x", str(i), None), 2: (str(i), None, "x")}[i % 3]) for i in range(12)}
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/none")
    assert {first_line(spark, p) for p in expand(spark, f"{path}/none/part*")} <= {None}
