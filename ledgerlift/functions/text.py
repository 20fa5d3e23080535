"""Text cleaning: null markers, blanks, labels used for matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlift.functions import fixed_values as fixed

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Trim every kind of white space at both ends, not only blanks."""
    return F.btrim(col(c), F.lit(fixed.WHITE_SPACE))


def clean(c: ColumnOrName, dialect: str = "general") -> Column:
    """Trimmed text, or NULL when it is one of the dialect's null markers."""
    text = strip(c)
    return F.when(~F.lower(text).isin(*fixed.NULL_MARKERS[dialect]), text)


def blank_to_null(c: ColumnOrName) -> Column:
    """Trimmed text, or NULL when blank or the bulk-load null token."""
    text = F.trim(col(c))
    return F.when((text != "") & (text != "\\N"), text)


def key_text(c: ColumnOrName) -> Column:
    """Case- and blank-insensitive form used on both sides of a lookup."""
    return F.nullif(F.lower(F.trim(col(c))), F.lit(""))


def label_key(c: ColumnOrName) -> Column:
    """Loose lookup form: CamelCase split, separators to blanks, no full stops or commas."""
    spaced = F.regexp_replace(col(c), "([a-z0-9])([A-Z])", "$1 $2")
    words = F.regexp_replace(spaced, r"[_\-\s]+", " ")
    return F.nullif(F.lower(F.trim(F.translate(words, ".,", ""))), F.lit(""))


def class_code(c: ColumnOrName) -> Column:
    """`class  a` and `A` both become `A`."""
    return F.regexp_replace(F.upper(strip(c)), r"^CLASS\s+", "")


def first_present(*columns: ColumnOrName, dialect: str = "general") -> Column:
    """First value that survives cleaning."""
    return F.coalesce(*[clean(c, dialect) for c in columns])


def capped(c: ColumnOrName, length: int) -> Column:
    """Text cut to the width of a target column, for a caller whose target has such a limit."""
    return F.nullif(F.substring(F.trim(col(c)), 1, length), F.lit(""))


def joined(*columns: ColumnOrName, sep: str = " ") -> Column:
    """Concatenation in which a missing part counts as empty."""
    parts = [F.coalesce(F.trim(col(c)), F.lit("")) for c in columns]
    return F.concat_ws(sep, *parts)


def upper_or(c: ColumnOrName, default: str | None = None, dialect: str = "user") -> Column:
    value = F.upper(clean(c, dialect))
    return value if default is None else F.coalesce(value, F.lit(default))
