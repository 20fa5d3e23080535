"""Dates that arrive in many layouts, or as spreadsheet day serials."""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlift.functions import fixed_values as fixed
from ledgerlift.functions.text import ColumnOrName, clean, col

_FIELD = {
    "Y": r"([0-9]{4})",
    "m": r"(1[0-2]|0?[1-9])",
    "d": r"(3[01]|[12][0-9]|0?[1-9])",
    "H": r"(?:2[0-3]|[01]?[0-9])",
    "M": r"(?:[0-5]?[0-9])",
    "S": r"(?:6[01]|[0-5]?[0-9])",
    "f": r"(?:[0-9]{1,6})",
}


def _pattern(layout: str) -> tuple[str, list[str]]:
    """Pattern of a layout and its year, month and day fields in order of appearance."""
    pattern, order = "", []
    for literal, field in re.findall(r"([^%]*)(?:%([A-Za-z]))?", layout):
        pattern += re.escape(literal).replace(r"\ ", r"\s+")
        if field:
            pattern += _FIELD[field]
            if field in "Ymd":
                order.append(field)
    return pattern, order


@functools.cache
def _layouts(formats: tuple[str, ...]) -> list[tuple[str, str]]:
    """(pattern, replacement that yields ISO order) per date part, in order of first use.

    Layouts that differ only in what follows the date share one pattern.
    """
    endings: dict[str, list[str]] = {}
    for fmt in formats:
        day, ending = re.fullmatch(r"(%[Ymd][^%]%[Ymd][^%]%[Ymd])(.*)", fmt).groups()
        endings.setdefault(day, []).append(_pattern(ending)[0])
    out = []
    for day, tails in endings.items():
        pattern, order = _pattern(day)
        iso = "-".join(f"${order.index(field) + 1}" for field in "Ymd")
        out.append((f"^{pattern}(?:{'|'.join(tails)})$", iso))
    return out


def serial_date(c: ColumnOrName, above: float = 1000) -> Column:
    """Spreadsheet day serial to date; numbers at or below `above` are not serials."""
    number = col(c).try_cast("double")
    days = F.when((number > above) & (number <= fixed.SERIAL_MAX), F.floor(number).cast("int"))
    return F.date_add(F.lit(fixed.SERIAL_EPOCH).cast("date"), days)


def parse_date(
    c: ColumnOrName,
    formats: Sequence[str] = fixed.DATES_APPLICATION,
    serial: bool = True,
    serial_above: float = 1000,
    dialect: str | None = "general",
) -> Column:
    """First layout that yields a real calendar date, then the serial; else NULL.

    Pass ``dialect=None`` for a column that has been cleaned before.  A layout is tried only where its shape matches, and the cast is a `try_cast`, so no
    parser exception is raised per row.
    """
    text = col(c) if dialect is None else clean(c, dialect)
    tries = []
    for pattern, iso in _layouts(tuple(formats)):
        tries.append(F.when(text.rlike(pattern), F.regexp_replace(text, pattern, iso).try_cast("date")))
    if serial:
        tries.append(serial_date(text, serial_above))
    return F.coalesce(*tries)


def iso_date(c: ColumnOrName) -> Column:
    """Date from ISO text, alone or before a time of day; anything else is NULL."""
    text = F.trim(col(c))
    return F.when(text.rlike(f"{fixed.ISO_DATE_PREFIX}(?:[T ][0-9]{{2}}:.*)?$"), F.substring(text, 1, 10).try_cast("date"))


def reminder_date(expiry: ColumnOrName, months: int = 6) -> Column:
    return F.add_months(col(expiry), -months)
