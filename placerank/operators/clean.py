"""Schema repair, imputation, typing and projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from placerank.operators.stats import one_row


def project(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Rename, cast and compute in one select."""
    return df.select(*[e.alias(name) for name, e in exprs.items()])


def all_of(*conditions: Column) -> Column:
    keep = conditions[0]
    for c in conditions[1:]:
        keep = keep & c
    return keep


def filter_if(df: DataFrame, present: bool, condition: Column) -> DataFrame:
    """Apply a filter only when its source columns were there."""
    return df.filter(condition) if present else df


def with_missing(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, bool]:
    """Add absent columns as typed nulls; the flag tells whether all were present."""
    absent = {name: F.lit(None).cast(t) for name, t in types.items() if name not in df.columns}
    return (df.withColumns(absent) if absent else df), not absent


def resolve_columns(
    df: DataFrame, candidates: Mapping[str, Sequence[str]], required: Sequence[str] = (), missing_type: str = "string"
) -> tuple[DataFrame, set[str]]:
    """Canonical names from the first candidate present; the set names the columns that had none."""
    have = set(df.columns)
    source = {name: next((c for c in options if c in have), None) for name, options in candidates.items()}
    lost = {name for name, c in source.items() if c is None}
    if lost & set(required):
        raise ValueError(f"no column found for {sorted(lost & set(required))}, have {sorted(have)}")
    return (
        df.select(
            *[
                F.col(f"`{c}`").alias(name) if c else F.lit(None).cast(missing_type).alias(name)
                for name, c in source.items()
            ]
        ),
        lost,
    )


def conform(df: DataFrame, target: StructType, aliases: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Bring a heterogeneous table to a target schema: renamed, cast, missing columns null."""
    aliases, have = aliases or {}, set(df.columns)
    out = []
    for field in target.fields:
        name = next((c for c in (field.name, *aliases.get(field.name, ())) if c in have), None)
        source = F.col(f"`{name}`").try_cast(field.dataType) if name else F.lit(None).cast(field.dataType)
        out.append(source.alias(field.name))
    return df.select(*out)


def drop_value(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column differs from the value (null rows go too, as in SQL)."""
    return df.filter(F.col(column) != value)


def impute_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def impute_stat(
    df: DataFrame, column: str, stat: str = "median", offset: float = 0.0, fallback: float | None = None,
    source: DataFrame | None = None, source_column: str | None = None, accuracy: int = 10000,
) -> DataFrame:
    """Fill nulls with the median or maximum (plus an offset) of a column, or with the fallback.

    The statistic is a one-row scalar subquery: nothing is collected to the driver.
    """
    of = F.col(source_column or column)
    agg = F.percentile_approx(of, 0.5, accuracy) if stat == "median" else F.max(of)
    value = one_row(df if source is None else source, v=agg)["v"]
    if fallback is not None:
        value = F.coalesce(value, F.lit(fallback))
    filled = F.coalesce(F.col(column), value + offset if offset else value)
    return df.withColumn(column, filled.cast(df.schema[column].dataType))


def fill_by_class(
    df: DataFrame, doubles: Sequence[str] = (), ints: Sequence[str] = (), strings: Sequence[str] = (),
    double: float = 0.0, integer: int = -1, string: str = "N/A",
) -> DataFrame:
    """One fillna over the named columns, by class."""
    values = {**dict.fromkeys(doubles, double), **dict.fromkeys(ints, integer), **dict.fromkeys(strings, string)}
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def narrow(df: DataFrame, types: Mapping[str, Sequence[str]]) -> DataFrame:
    """Cast lists of columns to smaller types in one select; an overflow becomes null."""
    to = {c: t for t, cols in types.items() for c in cols}
    return df.select(*[F.col(c).try_cast(to[c]).alias(c) if c in to else F.col(c) for c in df.columns])


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns in the given order, skipping absent ones."""
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])


def with_provenance(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def parse_json(df: DataFrame, column: str, schema: StructType | str, into: str) -> DataFrame:
    """JSON text to a struct; a malformed text gives null fields."""
    return df.withColumn(into, F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"}))


def flatten(df: DataFrame, struct: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select(*[F.col(c) for c in df.columns if c != struct], F.col(f"{struct}.*"))
