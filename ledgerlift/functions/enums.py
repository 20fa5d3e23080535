"""Free text to the registry's closed value lists."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlift.functions import fixed_values as fixed
from ledgerlift.functions.text import ColumnOrName, blank_to_null, clean, col


def map_enum(
    c: ColumnOrName,
    synonyms: Mapping[str, str],
    valid: Sequence[str] = (),
    otherwise: str | Column | None = None,
) -> Column:
    """Synonym, else a valid value in upper case, else `otherwise`.

    ``otherwise="upper"`` keeps unknown text in upper case; any other string is the default.
    """
    text = blank_to_null(c)
    branches = []
    if synonyms:
        table = F.create_map(*[F.lit(x) for pair in synonyms.items() for x in pair])
        branches.append(F.try_element_at(table, F.lower(text)))
    if valid:
        branches.append(F.when(F.upper(text).isin(*valid), F.upper(text)))
    if isinstance(otherwise, Column):
        branches.append(otherwise)
    elif otherwise == "upper":
        branches.append(F.upper(text))
    elif otherwise is not None:
        branches.append(F.lit(otherwise))
    return F.coalesce(*branches)


def application_type(c: ColumnOrName) -> Column:
    return map_enum(c, fixed.APPLICATION_TYPE_SYNONYMS, otherwise="upper")


def installation_type(c: ColumnOrName) -> Column:
    cleaned = clean(c)
    return F.coalesce(map_enum(cleaned, fixed.INSTALLATION_TYPE_SYNONYMS, otherwise="upper"), F.lit("NEW"))


def water_application_type(c: ColumnOrName) -> Column:
    return map_enum(c, fixed.WATER_TYPE_SYNONYMS, fixed.WATER_TYPE_VALID)


def license_type(c: ColumnOrName) -> Column:
    return map_enum(c, fixed.LICENSE_TYPE_SYNONYMS, fixed.LICENSE_TYPE_VALID)


def experience_type(c: ColumnOrName) -> Column:
    return map_enum(clean(c), fixed.EXPERIENCE_SYNONYMS, otherwise="EMPLOYED")


def experience_key(c: ColumnOrName) -> Column:
    """Stored experience type with `-` and blanks unified, for comparison."""
    return F.translate(F.upper(F.trim(col(c))), "- ", "__")


def nationality(c: ColumnOrName) -> Column:
    text = F.lower(F.trim(col(c)))
    return F.when(text == fixed.NATIONAL.lower(), F.lit(fixed.NATIONAL)).when(
        text.like("%non%tanzanian%"), F.lit(fixed.FOREIGN)
    )


def parse_bool(c: ColumnOrName) -> Column:
    """TRUE/1/YES/Y in any case; everything else, missing included, is false."""
    return F.coalesce(F.upper(F.trim(col(c))).isin(*fixed.TRUE_WORDS), F.lit(False))


def capacity_unit(c: ColumnOrName) -> Column:
    return map_enum(c, fixed.CAPACITY_UNITS)


def voltage_level(c: ColumnOrName, sector: str | None = None) -> Column:
    default = fixed.ELECTRICITY_VOLTAGE if sector == "ELECTRICITY" else None
    return map_enum(c, {}, fixed.VOLTAGE_LEVELS, default)


def derived_license_type(sector: ColumnOrName, category_type: ColumnOrName, current: ColumnOrName) -> Column:
    """Licence type implied by sector and category type; installation licences keep theirs."""
    sector, category_type, current = F.trim(col(sector)), col(category_type), col(current)
    chain = F.when(
        (sector == "ELECTRICITY") & (current == fixed.INSTALLATION_LICENSE), F.lit(fixed.INSTALLATION_LICENSE)
    )
    for (s, kind), value in fixed.LICENSE_TYPE_BY_SECTOR.items():
        chain = chain.when((sector == s) & (category_type == kind), F.lit(value))
    return chain.otherwise(current)


def imported_license_type(sector: ColumnOrName, category_type: ColumnOrName) -> Column:
    """As above for newly imported rows, where water and electricity ignore the category type."""
    sector, category_type = F.trim(col(sector)), col(category_type)
    chain = F.when(sector == "WATER_SUPPLY", F.lit("LICENSE_WATER")).when(
        sector == "ELECTRICITY", F.lit("LICENSE_ELECTRICITY_SUPPLY")
    )
    for (s, kind), value in fixed.LICENSE_TYPE_BY_SECTOR.items():
        if s in ("PETROLEUM", "NATURAL_GAS"):
            chain = chain.when((sector == s) & (category_type == kind), F.lit(value))
    return chain


def sector_of(c: ColumnOrName, otherwise: Column | None = None) -> Column:
    """Sector whose word list first matches the text."""
    text = F.lower(col(c))
    (first, words), *rest = fixed.SECTOR_WORDS
    chain = F.when(text.rlike(_any_of(words)), F.lit(first))
    for sector, words in rest:
        chain = chain.when(text.rlike(_any_of(words)), F.lit(sector))
    return chain if otherwise is None else chain.otherwise(otherwise)


def _any_of(words: Sequence[str]) -> str:
    return "|".join(re.escape(w).replace(r"\ ", " ") for w in words)
