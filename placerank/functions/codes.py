"""Administrative codes and coordinates packed in text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from placerank import fixed
from placerank.functions.text import col


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    """The captured text, null (not '') when nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def valid_code(c: str | Column, overseas: bool = False) -> Column:
    return col(c).rlike(fixed.DEPARTMENT_PATTERN_OVERSEAS if overseas else fixed.DEPARTMENT_PATTERN)


def department_of(code: str | Column, grid_id: str | Column | None = None) -> Column:
    """Department of a commune code, else the one written in the grid id, else null."""
    code = F.upper(F.trim(col(code)))
    candidates = [
        _found(code, r"^(2A|2B|97[1-6]|0[1-9]|[1-8][0-9]|9[0-5])"),
    ]
    if grid_id is not None:
        grid = col(grid_id)
        candidates += [
            _found(grid, r"(?:^|[_-])(0[1-9]|[1-8][0-9]|9[0-5]|2A|2B)(?:[_-]|$)"),
            F.substring(_found(grid, r"^FR(?:MET|DOM)?([0-9A-B]{2,3})"), 1, 2),
        ]
    return F.coalesce(*candidates)


def commune_key3(code: str | Column, keep_raw: bool = False, pad: bool = False) -> Column:
    """Last three characters of the first five-character commune code, to meet sales tables.

    Without a match: null, or the raw code with ``keep_raw``. ``pad`` fills short raw codes with zeros.
    """
    raw = col(code)
    key = F.substring(_found(F.upper(raw), fixed.COMMUNE_PATTERN), 3, 3)
    if not keep_raw:
        return key
    return F.coalesce(key, F.lpad(raw, 3, "0") if pad else raw)


def split_point(c: str | Column, sep: str = ",") -> tuple[Column, Column]:
    """'lat,lon' -> two doubles; a missing or malformed part is null."""
    parts = F.split(col(c), sep)
    return F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double")


def coords_from_grid_id(
    grid_id: str | Column, x: Column | None = None, y: Column | None = None
) -> tuple[Column, Column]:
    """(x, y) text from an id like '...N2345000E3456000', where the given columns are null."""
    grid = col(grid_id)
    from_id = _found(grid, r"E([0-9]+)"), _found(grid, r"N([0-9]+)E")
    given = [c if c is not None else F.lit(None).cast("string") for c in (x, y)]
    return F.coalesce(given[0], from_id[0]), F.coalesce(given[1], from_id[1])
