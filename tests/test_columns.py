"""Column builders and cleaning operators on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from placerank import fixed
from placerank.functions import codes, geo, scores, text
from placerank.operators import clean
from placerank.sources import readers


def values(df, column="v"):
    return [r[column] for r in df.collect()]


def frame(spark, column_type, items):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {column_type}").coalesce(1)


def test_decimal_comma(spark):
    df = frame(spark, "string", ["12,5", "7", "", None, "abc", " 3.25 ", "1 000,5"])
    assert values(df.select(text.decimal_comma("x").alias("v"))) == [12.5, 7.0, None, None, None, 3.25, None]


def test_first_int(spark):
    df = frame(spark, "string", ["<12>", "a 7 b 9", "", None, "none", "99999999999"])
    assert values(df.select(text.first_int("x").alias("v"))) == [12, 7, None, None, None, None]


def test_normalize_text(spark):
    df = frame(spark, "string", ["  Île-de-France ", "Provence-Alpes-Côte d'Azur", "Rhône_Alpes!!", "ŒUVRE", "  -- ", None])
    assert values(df.select(text.normalize_text("x").alias("v"))) == [
        "ile de france", "provence alpes cote d azur", "rhone alpes", "uvre", "", None,
    ]


def test_parse_bool(spark):
    df = frame(spark, "string", ["TRUE", " oui ", "1", "no", "0", "maybe", None])
    assert values(df.select(text.parse_bool("x").alias("v"))) == [True, True, True, False, False, False, False]
    assert values(df.select(text.parse_bool("x", default=None).alias("v"))) == [True, True, True, False, False, None, None]


@pytest.mark.parametrize(
    "code,grid,expected",
    [
        ("2a041", None, "2A"), (" 2B033", None, "2B"), ("97411", None, "97" "4"), ("97911", "FRMET75X", "75"), ("01004", None, "01"),
        ("n/a", "CRS_38_X", "38"), (None, "FRDOM971", "97"), ("00123", "nothing", None), (None, None, None),
    ],
)
def test_department(spark, code, grid, expected):
    df = spark.createDataFrame([(code, grid)], "code string, grid string")
    assert values(df.select(codes.department_of("code", "grid").alias("v"))) == [expected]


def test_commune_key(spark):
    df = frame(spark, "string", ["24534", "2a041", "x", None])
    assert values(df.select(codes.commune_key3("x").alias("v"))) == ["534", "041", None, None]
    assert values(df.select(codes.commune_key3("x", keep_raw=True).alias("v"))) == ["534", "041", "x", None]


def test_split_point(spark):
    df = frame(spark, "string", ["48.5,2.25", "48.5", "a,b", None, "1,2,3"])
    lat, lon = codes.split_point("x")
    assert [tuple(r) for r in df.select(lat, lon).collect()] == [
        (48.5, 2.25), (48.5, None), (None, None), (None, None), (1.0, 2.0),
    ]


def test_labels(spark):
    df = frame(spark, "double", [0.81, 0.8, 0.7, 0.6, 0.5, None])
    assert values(df.select(scores.grade("x").alias("v"))) == ["A+", "A", "B", "C", "D", "D"]
    counts = frame(spark, "int", [0, 1, 2, 3, 5, 6])
    assert values(counts.select(scores.competition_label("x").alias("v"))) == [
        "Zone blanche", "Faible", "Faible", "Concurrentiel", "Concurrentiel", "Sature",
    ]


def test_percent_label_rounds_halves_up(spark):
    df = spark.createDataFrame([("c", 0.125), ("c", 0.5)], "c string, s double").coalesce(1)
    assert values(df.select(text.percent_label("c", "s").alias("v"))) == ["c - 13%", "c - 50%"]


def test_size_factor(spark):
    df = frame(spark, "double", [None, float("nan"), 0.0, 6.0, 40.0])
    assert values(df.select(scores.size_factor("x").alias("v"))) == [2 / 12, 2 / 12, 1 / 12, 0.5, 1.0]


def test_haversine(spark):
    df = spark.createDataFrame([(48.8566, 2.3522, 43.2965, 5.3698), (1.0, 2.0, 1.0, 2.0), (0.0, 0.0, 0.0, 180.0), (None, 0.0, 0.0, 0.0)],
                               "a double, b double, c double, d double").coalesce(1)
    got = values(df.select(geo.haversine_km("a", "b", "c", "d").alias("v")))
    assert got[0] == pytest.approx(660.48, abs=0.1)
    assert got[1] == 0.0
    assert got[2] == pytest.approx(math.pi * 6371)
    assert got[3] is None


def test_published_projection_points(spark):
    laea = spark.createDataFrame([(3962799.45, 2999718.85), (4321000.0, 3210000.0)], "x double, y double").coalesce(1)
    got = geo.epsg3035_to_wgs84(laea, "x", "y").collect()
    assert (got[0]["longitude"], got[0]["latitude"]) == pytest.approx((5.0, 50.0), abs=1e-6)
    # the latitude series is cut after sin(6 beta), worth some 3e-9 degrees
    assert (got[1]["longitude"], got[1]["latitude"]) == pytest.approx((10.0, 52.0), abs=1e-8)
    lcc = spark.createDataFrame([(700000.0, 6600000.0), (652469.02, 6862035.26)], "x double, y double").coalesce(1)
    got = geo.epsg2154_to_wgs84(lcc, "x", "y").collect()
    assert (got[0]["longitude"], got[0]["latitude"]) == pytest.approx((3.0, 46.5), abs=1e-9)
    assert (got[1]["longitude"], got[1]["latitude"]) == pytest.approx((2.3522, 48.8566), abs=2e-4)


def test_lookup_tables_are_whole(spark):
    expected = {f"{i:02d}" for i in range(1, 96) if i != 20} | {"2A", "2B"}
    assert {c for cs in fixed.REGION_DEPARTMENTS.values() for c in cs} == expected
    assert set(fixed.DEPARTMENTS) == expected
    assert {r for _, r in fixed.DEPARTMENTS.values()} <= set(fixed.REGION_ORDER)
    assert readers.dim_departments(spark).count() == 96


def test_resolve_columns(spark):
    df = spark.createDataFrame([("a", "b")], "`Code commune` string, ind string")
    out, lost = clean.resolve_columns(df, {"code": ["code", "Code commune"], "n": ["Ind", "ind"], "z": ["z"]}, required=["code"])
    assert (out.columns, lost) == (["code", "n", "z"], {"z"})
    with pytest.raises(ValueError):
        clean.resolve_columns(df, {"z": ["z"]}, required=["z"])


def test_impute(spark):
    df = frame(spark, "double", [1.0, None, 3.0, 10.0])
    assert values(clean.impute_stat(df, "x"), "x") == [1.0, 3.0, 3.0, 10.0]
    assert values(clean.impute_stat(df, "x", "max", offset=5.0), "x") == [1.0, 15.0, 3.0, 10.0]
    empty = frame(spark, "double", [None, None])
    assert values(clean.impute_stat(empty, "x", "max", offset=5.0, fallback=50.0), "x") == [55.0, 55.0]


def test_narrow_overflow_is_null(spark):
    df = frame(spark, "int", [7, 40000])
    assert values(clean.narrow(df, {"smallint": ["x"]}), "x") == [7, None]


def test_conform(spark):
    df = spark.createDataFrame([("n", "x", 5)], "Nom string, lat string, extra int")
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    target = StructType([StructField("name", StringType()), StructField("lat", DoubleType()), StructField("z", DoubleType())])
    assert clean.conform(df, target, {"name": ["Nom"]}).collect()[0] == ("n", None, None)
