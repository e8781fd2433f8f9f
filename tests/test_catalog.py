"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.check import compare, oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toArrow()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got.num_columns > 0
        return
    assert compare(got, duck.execute(sql).to_arrow_table()) is None


@pytest.mark.parametrize("name", ["census_plan", "clubs_plan", "laea_inverse", "lcc_inverse"])
def test_projections_stay_in_generated_code(spark, name):
    spark.conf.set("spark.sql.codegen.fallback", "false")  # code that does not compile is then an error
    try:
        assert entry.queries()[name](spark, SF_DIR).toArrow().num_rows > 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
