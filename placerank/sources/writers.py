"""Batch writers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from placerank.functions.text import col


def write_table(
    df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None, rows_per_file: int = 5_000_000,
    mode: str = "overwrite", seen: Observation | None = None,
) -> None:
    """Parquet, optionally in folders per partition value; ``seen`` counts the rows in the tasks that write them.

    ``rebalance`` gathers each partition value into few files, and adaptive execution splits a value
    that holds much of the table over several tasks (a plain repartition would give it one).
    """
    keys = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
    dealt = df.hint("rebalance", *keys) if keys else df
    if seen is not None:
        # above the exchange: a task that writes counts once, however often a lost executor's work is repeated
        dealt = dealt.observe(seen, F.count(F.lit(1)).alias("n"))
    if not keys:
        dealt.write.mode(mode).parquet(path)
        return
    (
        dealt.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).parquet(path)
    )


def write_verified(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None) -> int:
    """Write, and compare the rows observed on the way with those the Parquet footers name; the table is not computed again."""
    seen = Observation("written")
    write_table(df, path, partition_by, seen=seen)
    found = df.sparkSession.read.schema(df.schema).parquet(path).count()
    if found != seen.get["n"]:
        raise ValueError(f"{path} holds {found} rows, {seen.get['n']} were written")
    return found


def write_csv_single(df: DataFrame, path: str) -> None:
    """One CSV file with a header, through one task: for aggregates, which are small by construction."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header, one per task: for tables of any size."""
    df.write.mode("overwrite").option("header", True).csv(path)


def geojson_feature(lon: str | Column, lat: str | Column, properties: Sequence[str]) -> Column:
    """One point feature as JSON text; null properties are kept."""
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit("Point").alias("type"), F.array(col(lon), col(lat)).alias("coordinates")).alias("geometry"),
            F.struct(*properties).alias("properties"),
        ),
        {"ignoreNullFields": "false"},
    )


def to_geojson_features(df: DataFrame, lon: str, lat: str, properties: Sequence[str]) -> DataFrame:
    """One JSON text per row with a location."""
    return df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(
        geojson_feature(lon, lat, properties).alias("feature")
    )


def with_geometry(df: DataFrame, geometry: DataFrame | None, on: str, lon: str, lat: str,
                  geo: tuple[str, str] = ("geo_lon", "geo_lat")) -> DataFrame:
    """The location of the row's group where one is known, else the row's own."""
    if geometry is None:
        return df
    out = df.join(geometry.select(on, *geo), on, "left")
    return out.withColumns(
        {lon: F.coalesce(F.col(geo[0]), F.col(lon)), lat: F.coalesce(F.col(geo[1]), F.col(lat))}
    ).drop(*geo)


def write_geojson(df: DataFrame, path: str, lon: str, lat: str, properties: Sequence[str]) -> None:
    """One GeoJSON Feature per line, whatever the table's size; read_geojson_points reads them back."""
    to_geojson_features(df, lon, lat, properties).write.mode("overwrite").text(path)


def write_geojson_document(df: DataFrame, path: str, lon: str, lat: str, properties: Sequence[str], most: int) -> None:
    """One FeatureCollection for a top-k report of at most ``most`` rows; more rows are an error, none is left out."""
    few = df.limit(most + 1).agg(F.count("*").alias("n"))
    body = to_geojson_features(df.limit(most + 1), lon, lat, properties).agg(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.collect_list("feature")), F.lit("]}")).alias("value")
    )
    if few.first()[0] > most:
        raise ValueError(f"more than {most} rows for one document")
    body.coalesce(1).write.mode("overwrite").text(path)


def write_profile(df: DataFrame, path: str) -> None:
    """A one-row metadata document as JSON."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(bytes, files) of a Parquet folder, from the file metadata of the scan."""
    files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"), F.count("*").alias("files"))
