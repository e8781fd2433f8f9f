"""Batch and stream readers. Schemas are given or taken from the header; nothing is inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from placerank import fixed
from placerank.operators.clean import conform
from placerank.operators.sets import union_all
from placerank.sources.files import exists, expand, first_line

#: first lines that are waited for at a time
HEADERS_AT_ONCE = 16


def header_columns(spark: SparkSession, path: str, sep: str | None = None, encoding: str = "UTF-8") -> tuple[list[str], str]:
    """Column names and separator of a delimited file; ';' when the header has one, else ','."""
    line = first_line(spark, path, encoding)
    if line is None:
        raise ValueError(f"{path} is empty")
    line = line.lstrip("\ufeff").rstrip("\r")
    sep = sep or (";" if ";" in line else ",")
    return [name.strip('"') for name in line.split(sep)], sep


def read_delimited(
    spark: SparkSession, patterns: str | Sequence[str], sep: str | None = None,
    columns: Sequence[str] | None = None, encoding: str = "UTF-8",
    present: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Delimited files as strings, whose headers may differ from file to file.

    Files of one header are read together and the groups are united by name; a column that a file lacks is null in its
    rows. ``present`` adds flags: name -> columns, true in the rows of files that have all of them. Only the first line of
    each file is read beforehand, of many files at a time and without a Spark job.
    """
    paths = expand(spark, patterns)
    if not paths:
        raise FileNotFoundError(f"no file matches {patterns}")
    groups: dict[tuple, list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(lambda path: header_columns(spark, path, sep, encoding), paths))
    for path, (names, found) in zip(paths, headers):
        groups.setdefault((found, *names), []).append(path)

    def group(key: tuple, files: list[str]) -> DataFrame:
        schema = StructType([StructField(n, StringType(), True) for n in key[1:]])
        options = dict(header=True, sep=key[0], encoding=encoding, enforceSchema=False)
        flags = {name: F.lit(set(needed) <= set(key[1:])) for name, needed in (present or {}).items()}
        df = spark.read.schema(schema).options(**options).csv(files)
        # its own columns first, so that the scan reads no others
        df = df.select(*[F.col(f"`{c}`") for c in columns if c in key[1:]]) if columns else df
        return df.withColumns(flags) if flags else df

    out = union_all([group(key, files) for key, files in groups.items()])
    order = [c for c in columns if c in out.columns] + list(present or {}) if columns else out.columns
    return out.select(*[F.col(f"`{c}`") for c in order])


def read_typed_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, sep: str = ",") -> DataFrame:
    """CSV with a header and a given schema; a field that does not parse is null."""
    return spark.read.schema(schema).options(header=True, sep=sep, encoding="UTF-8", mode="PERMISSIVE").csv(path)


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | Mapping[str, str] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """A Parquet table, projected and renamed (``columns`` may map input to output names).

    Partition values keep their text ('01' stays '01') with a schema, or with the session setting
    that ``get_spark`` makes.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if columns is None:
        return df
    if isinstance(columns, Mapping):
        return df.select(*[F.col(c).alias(out) for c, out in columns.items()])
    return df.select(*columns)


def read_or_empty(
    spark: SparkSession, path: str, schema: StructType, aliases: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """A table that may be missing or differ in its columns, brought to the schema."""
    if not expand(spark, f"{path.rstrip('/')}/*"):
        return spark.createDataFrame([], schema)
    return conform(spark.read.parquet(path), schema, aliases)


def _geojson_feature(properties: StructType) -> StructType:
    return StructType(
        [
            StructField("properties", properties),
            StructField("geometry", StructType([StructField("coordinates", ArrayType(DoubleType()))])),
        ]
    )


def _geojson_rows(features: DataFrame) -> DataFrame:
    return features.select(
        "properties.*",
        F.get("geometry.coordinates", 0).alias("lon"),
        F.get("geometry.coordinates", 1).alias("lat"),
    )


def read_geojson_points(spark: SparkSession, path: str, properties: StructType) -> DataFrame:
    """Points, one Feature per line, to rows: the properties, then lon and lat."""
    return _geojson_rows(spark.read.schema(_geojson_feature(properties)).json(path))


def read_geojson_document(spark: SparkSession, path: str, properties: StructType) -> DataFrame:
    """The points of files that are one FeatureCollection each, over any number of lines."""
    schema = StructType([StructField("features", ArrayType(_geojson_feature(properties)))])
    features = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    return _geojson_rows(features.select("f.*"))


def dim_region_departments(spark: SparkSession, mapping: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(region, departments array)."""
    rows = list((mapping or fixed.REGION_DEPARTMENTS).items())
    return spark.createDataFrame(rows, "region string, departments array<string>")


def dim_departments(spark: SparkSession) -> DataFrame:
    """(department, name, region) with the position of the region in the usual order."""
    order = {region: i for i, region in enumerate(fixed.REGION_ORDER)}
    rows = [(code, name, region, order[region]) for code, (name, region) in fixed.DEPARTMENTS.items()]
    return spark.createDataFrame(rows, "department string, department_name string, region string, region_order int")


def read_events(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """Streaming messages as (value, timestamp).

    Kafka starts at the earliest offset and goes on when messages have expired. The 'text' format
    reads one message per line from files, with the time of reading as timestamp.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest").option("failOnDataLoss", "false")
    reader = reader.options(**options)
    raw = reader.load(path) if path else reader.load()
    if "timestamp" not in raw.columns:
        raw = raw.withColumn("timestamp", F.current_timestamp())
    return raw.select("value", "timestamp")


def has_data(spark: SparkSession, path: str) -> bool:
    return exists(spark, path) and bool(expand(spark, f"{path.rstrip('/')}/*"))
