"""Run registered queries in Spark and their SQL in DuckDB, and compare whole results."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(dtype) -> str:
    import pyarrow.types as pt

    if pt.is_large_string(dtype) or pt.is_string(dtype):
        return "string"
    if pt.is_timestamp(dtype):
        return "timestamp"
    return str(dtype)


def _rows(tbl, names):
    def plain(v):
        if isinstance(v, float) and math.isnan(v):
            return None
        return v

    cols = [tbl.column(n).to_pylist() for n in names]
    return sorted((tuple(map(plain, r)) for r in zip(*cols)), key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) if not isinstance(v, (list, dict)) else (False, "x", str(v)) for v in r))


def compare(spark_table, duck_table) -> str | None:
    """None if equal, else what differs."""
    a, b = sorted(spark_table.column_names), sorted(duck_table.column_names)
    if a != b:
        return f"columns {a} / {b}"
    kinds = [(n, _kind(spark_table.schema.field(n).type), _kind(duck_table.schema.field(n).type)) for n in a]
    odd = [k for k in kinds if k[1] != k[2]]
    if odd:
        return f"types {odd}"
    if spark_table.num_rows != duck_table.num_rows:
        return f"rows {spark_table.num_rows} / {duck_table.num_rows}"
    x, y = _rows(spark_table, a), _rows(duck_table, a)
    wrong = [(p, q) for p, q in zip(x, y) if p != q]
    return f"{len(wrong)} of {len(x)} rows differ, first {wrong[0]} (columns {a})" if wrong else None


def main(sf: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = oracle(sf_dir)
    queries, sqls, bad = entry.queries(), entry.oracle_sql(), 0
    for name in names or queries:
        start = time.time()
        try:
            got = queries[name](spark, sf_dir).toArrow()
        except Exception as e:  # report and go on with the other queries
            print(f"FAIL {name}: {str(e)[:600]}")
            bad += 1
            continue
        took = time.time() - start
        if name not in sqls:
            print(f"  -- {name}: {got.num_rows} rows, no SQL, {took:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            want = res.to_arrow_table() if hasattr(res, "to_arrow_table") else res.fetch_arrow_table()
            problem = compare(got, want)
        except Exception as e:
            problem = f"SQL: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else '  ok'} {name}: {got.num_rows} rows, {took:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:])))
