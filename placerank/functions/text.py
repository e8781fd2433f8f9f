"""Text and number parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from placerank import fixed


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_comma(c: str | Column) -> Column:
    """'1234,5' -> 1234.5; null when the text is not a number (never an ANSI error)."""
    return F.translate(col(c), ",", ".").try_cast("double")


def first_int(c: str | Column) -> Column:
    """The first run of digits as an int; null when there is none or it overflows."""
    return F.regexp_extract(F.coalesce(col(c), F.lit("")), r"(\d+)", 1).try_cast("int")


# Accented letters and their plain form, then characters read as a blank
_ACCENTED = "àâäéèêëîïôöùûüç" + "-_'"
_PLAIN = "aaaeeeeiioouuuc" + "   "


def normalize_text(c: str | Column) -> Column:
    """Trimmed lower case without accents; separators and other signs become one blank."""
    plain = F.translate(F.lower(F.trim(col(c))), _ACCENTED, _PLAIN)
    return F.trim(F.regexp_replace(plain, r"[^a-z0-9]+", " "))


def lookup_alias(c: str | Column, aliases: Mapping[str, str]) -> Column:
    """The alias of a value, or the value itself."""
    if not aliases:
        return col(c)
    pairs = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    # try_element_at: a missing key is null, also under ANSI
    return F.coalesce(F.try_element_at(pairs, col(c)), col(c))


def matches_keyword(c: str | Column, keyword: str) -> Column:
    """Case-insensitive regular expression match."""
    return col(c).rlike(f"(?i){keyword}")


def first_matching(
    cols: Sequence[str | Column], keyword: str, fallbacks: Sequence[str | Column], default: Column
) -> Column:
    """The first candidate that mentions the keyword, else the first non-null fallback, else the default."""
    mentions = [F.when(matches_keyword(c, keyword), col(c)) for c in cols]
    return F.coalesce(*mentions, *[col(c) for c in fallbacks], default)


def active_in_sector(
    activity: str | Column, state: str | Column, prefix: str, active: str,
    required: Sequence[str | Column] = (), sentinel: str = "[ND]",
) -> Column:
    """Activity code under a prefix, active state, and required fields neither null nor the sentinel."""
    keep = col(activity).startswith(prefix) & (col(state) == active)
    for c in required:
        keep = keep & col(c).isNotNull() & (col(c) != sentinel)
    return keep


def parse_bool(c: str | Column, default: bool | None = False) -> Column:
    """true/1/yes/oui and false/0/no/non in any case; anything else is the default."""
    word = F.lower(F.trim(col(c).cast("string")))
    return (
        F.when(word.isin(*fixed.TRUE_WORDS), F.lit(True))
        .when(word.isin(*fixed.FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(default).cast("boolean"))
    )


def percent_label(prefix: str | Column, share: str | Column) -> Column:
    """'<prefix> - NN%', halves rounded up."""
    return F.concat(col(prefix), F.lit(" - "), F.format_string("%.0f%%", col(share) * 100.0))


def type_facet(kind: str | Column, name: str | Column, mode: str, keyword: str) -> Column:
    """Facets over the type or the name of a place, each word looked for without case.

    all; any (keyword); tennis (tennis and keyword); court (piste and keyword);
    club (club and keyword but not tennis).
    """
    if mode == "all":
        return F.lit(True)

    def on(c: Column) -> Column:
        text = F.lower(F.coalesce(c, F.lit("")))
        has = text.contains(keyword.lower())
        if mode == "any":
            return has
        if mode == "tennis":
            return text.contains("tennis") & has
        if mode == "court":
            return text.contains("piste") & has
        if mode == "club":
            return text.contains("club") & has & ~text.contains("tennis")
        raise ValueError(f"unknown facet {mode!r}")

    return on(col(kind)) | on(col(name))
